"""Planned departures matched with the departures that happened, stream against stream.

Both sides carry a watermark and the condition bounds the time between them, so Spark
knows how long a row can still find a partner: the state of a planned departure goes
when the watermark passes its last possible departure, that of an actual one when it passes the last
plan it could belong to. A planned departure without a partner leaves once, with nulls, at that moment.
The stream has one watermark, the lesser of the two sides', so neither side runs ahead of the other's
rows. The same function joins bounded frames (there watermarks do nothing).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tardy.operators.aggregate import WATERMARK_DELAY

EARLY, LATE = "20 minutes", "8 hours"


def match_departures(planned: DataFrame, actual: DataFrame, early: str = EARLY, late: str = LATE,
                     watermark: str = WATERMARK_DELAY) -> DataFrame:
    """Every planned departure of an aircraft with each actual one from ``early`` before to
    ``late`` after it (left outer).

    ``planned``: TAIL_NUMBER, planned_ts and further columns; ``actual``: TAIL_NUMBER, actual_ts and
    further ones. A null TAIL_NUMBER has no partner."""
    p = planned.withWatermark("planned_ts", watermark)
    a = actual.withWatermark("actual_ts", watermark).withColumnRenamed("TAIL_NUMBER", "actual_tail")
    same = F.col("TAIL_NUMBER") == F.col("actual_tail")
    near = F.col("actual_ts").between(F.col("planned_ts") - F.expr(f"interval {early}"), F.col("planned_ts") + F.expr(f"interval {late}"))
    return p.join(a, same & near, "left").drop("actual_tail")
