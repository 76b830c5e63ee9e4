"""Gold aggregation: daily (batch) and sliding event-time windows (batch or stream)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tardy.functions.metrics import ALL_METRICS, aggregate_metrics
from tardy.schema import BATCH_LABEL, GOLD_KEYS, STREAM_LABEL

# The gold grain by codes only; the names are functions of the codes (the
# dimension guard proves the keys unique), so they can be attached afterwards.
CODE_KEYS = ["FL_DATE", "AIRLINE", "ORIGIN_AIRPORT"]

# Stream window geometry and lateness bound.
WINDOW_SIZE = "15 minutes"
WINDOW_SLIDE = "5 minutes"
WATERMARK_DELAY = "30 minutes"


def daily_gold(features: DataFrame, metrics: list[str] = ALL_METRICS,
               label: str | None = BATCH_LABEL, processed_at: bool = False,
               keys: list[str] = GOLD_KEYS) -> DataFrame:
    """Statistics per FL_DATE x airline x origin (partial + final hash aggregate)."""
    out = aggregate_metrics(features.groupBy(*keys), metrics)
    if label is not None:
        out = out.withColumn("aggregation_type", F.lit(label))
    if processed_at:
        out = out.withColumn("processed_at", F.current_timestamp())
    return out


def statistics_columns(features: DataFrame, *others: str) -> DataFrame:
    """What the statistics need of the rows, and ``others``."""
    needed = {"DEPARTURE_DELAY", "is_delayed", "is_on_time", "delay_category", "is_weekend", "is_rush_hour",
              "DISTANCE", "AIR_TIME", "CANCELLED", "DIVERTED", *others}
    return features.select(*[c for c in features.columns if c in needed])


SESSION_GAP = "30 minutes"


def session_gold(features: DataFrame, gap: str = SESSION_GAP, keys: list[str] = ["AIRLINE"],
                 metrics: list[str] = ALL_METRICS, time_col: str = "event_ts") -> DataFrame:
    """Statistics per session x ``keys``: a session takes up every row that comes less than
    ``gap`` after another one of it, so rows that arrive late can join two sessions into one.

    Works on batch and streaming frames (for a stream, set the watermark on ``time_col`` first; a
    session leaves when the watermark passes its end). Sessions are merged per task before
    the shuffle, so a hot key ships its sessions, not its rows. Bounds are wall-clock TIMESTAMP_NTZ; the
    end is ``gap`` after the last row."""
    grouped = statistics_columns(features, time_col, *keys).groupBy(F.session_window(time_col, gap).alias("session"), *keys)
    return aggregate_metrics(grouped, metrics).withColumns({
        "session_start": F.col("session.start").cast("timestamp_ntz"),
        "session_end": F.col("session.end").cast("timestamp_ntz"),
    }).drop("session")


def window_gold(features: DataFrame, size: str = WINDOW_SIZE, slide: str = WINDOW_SLIDE,
                metrics: list[str] = ALL_METRICS, label: str | None = STREAM_LABEL,
                processed_at: bool = False, time_col: str = "event_ts",
                keys: list[str] = GOLD_KEYS) -> DataFrame:
    """Statistics per sliding window x FL_DATE x airline x origin.

    Works on batch and streaming frames (for a stream, set the watermark on
    ``time_col`` first). Every row lands in size/slide windows, so only the
    columns the statistics need are kept before the window expansion.
    Window bounds are returned as wall-clock TIMESTAMP_NTZ in the session zone,
    the same clock the event time was parsed from."""
    grouped = statistics_columns(features, time_col, *keys).groupBy(F.window(time_col, size, slide).alias("time_window"), *keys)
    out = aggregate_metrics(grouped, metrics)
    out = out.withColumns({
        "window_start": F.col("time_window.start").cast("timestamp_ntz"),
        "window_end": F.col("time_window.end").cast("timestamp_ntz"),
    }).drop("time_window")
    if label is not None:
        out = out.withColumn("aggregation_type", F.lit(label))
    if processed_at:
        out = out.withColumn("processed_at", F.current_timestamp())
    return out


# Statistics of gold rows that add up, so that coarser grains follow from them alone.
_SUMS = ["num_flights", "num_delayed", "num_on_time", "num_early_ontime", "num_minor_delay", "num_moderate_delay",
         "num_severe_delay", "num_extreme_delay", "num_weekend_flights", "num_rush_hour_flights"]


def gold_grains(gold: DataFrame, grains: list[list[str]]) -> DataFrame:
    """Coarser grains of daily gold rows, all from one pass: an Expand gives each row once per
    grain, with the columns outside it null and a grouping id (bit i from the left: column i is outside),
    and a partial aggregate folds them before the shuffle. Counts are summed, extremes
    kept, rates made from the counts."""
    columns = list(dict.fromkeys(c for g in grains for c in g))
    sums = [F.sum(c).cast("long").alias(c) for c in _SUMS]
    out = gold.groupingSets([[F.col(c) for c in g] for g in grains], *columns).agg(
        F.grouping_id().alias("grain"), *sums, F.min("min_dep_delay").alias("min_dep_delay"), F.max("max_dep_delay").alias("max_dep_delay"))
    return out.withColumns({"delay_rate": F.col("num_delayed") / F.col("num_flights"), "on_time_rate": F.col("num_on_time") / F.col("num_flights")})
