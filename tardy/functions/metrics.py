"""The 24 delay statistics, defined once and shared by the daily batch and the
sliding-window stream.

The three percentiles come from ONE ``percentile_approx`` sketch per group
(an array of quantiles) instead of three sketches; they are split into columns
after the aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tardy.functions.flags import DELAY_CATEGORIES

# Quantiles reported and their output names.
PERCENTILES = [(0.5, "median_dep_delay"), (0.9, "p90_dep_delay"), (0.95, "p95_dep_delay")]
PERCENTILE_ACCURACY = 10000  # Spark's default accuracy
_PCT = "_dep_delay_quantiles"

# Output names of the severity counts, in category order.
SEVERITY_COUNTS = [
    "num_early_ontime", "num_minor_delay", "num_moderate_delay",
    "num_severe_delay", "num_extreme_delay",
]

# Output column groups (names as in the gold table, in gold order).
CORE = ["num_flights", "avg_dep_delay", "min_dep_delay", "max_dep_delay"]
PCTS = [name for _, name in PERCENTILES]
RATES = ["num_delayed", "num_on_time", "delay_rate", "on_time_rate"]
SEVERITY = SEVERITY_COUNTS
TIME_PATTERNS = ["num_weekend_flights", "num_rush_hour_flights",
                 "avg_delay_rush_hour", "avg_delay_weekend"]
OPERATIONAL = ["avg_distance", "avg_air_time", "num_cancelled", "num_diverted"]
ALL_METRICS = CORE + PCTS + RATES + SEVERITY + TIME_PATTERNS + OPERATIONAL

METRIC_GROUPS = {
    "core": CORE,
    "percentiles": PCTS,
    "rates": RATES,
    "severity": SEVERITY,
    "time_patterns": TIME_PATTERNS,
    "operational": OPERATIONAL,
    "all": ALL_METRICS,
}


def _aggregates(delay: str = "DEPARTURE_DELAY") -> dict[str, Column]:
    d = F.col(delay)
    aggs: dict[str, Column] = {
        "num_flights": F.count(F.lit(1)),
        "avg_dep_delay": F.avg(d),
        "min_dep_delay": F.min(d),
        "max_dep_delay": F.max(d),
        "num_delayed": F.sum("is_delayed"),
        "num_on_time": F.sum("is_on_time"),
        "delay_rate": F.avg("is_delayed"),
        "on_time_rate": F.avg("is_on_time"),
        "num_weekend_flights": F.sum("is_weekend"),
        "num_rush_hour_flights": F.sum("is_rush_hour"),
        "avg_delay_rush_hour": F.avg(F.when(F.col("is_rush_hour") == 1, d)),
        "avg_delay_weekend": F.avg(F.when(F.col("is_weekend") == 1, d)),
        "avg_distance": F.avg("DISTANCE"),
        "avg_air_time": F.avg("AIR_TIME"),
        "num_cancelled": F.sum("CANCELLED").cast("long"),
        "num_diverted": F.sum("DIVERTED").cast("long"),
    }
    for name, label in zip(SEVERITY_COUNTS, DELAY_CATEGORIES):
        aggs[name] = F.sum(F.when(F.col("delay_category") == label, 1).otherwise(0))
    return aggs


def aggregate_metrics(grouped, metrics: list[str] = ALL_METRICS,
                      delay: str = "DEPARTURE_DELAY") -> DataFrame:
    """Apply the chosen statistics to a ``GroupedData``; result columns = keys + metrics."""
    table = _aggregates(delay)
    exprs = [table[m].alias(m) for m in metrics if m in table]
    wanted_pcts = [(q, n) for q, n in PERCENTILES if n in metrics]
    if wanted_pcts:
        exprs.append(
            F.percentile_approx(delay, [q for q, _ in wanted_pcts], PERCENTILE_ACCURACY).alias(_PCT)
        )
    out = grouped.agg(*exprs)
    if wanted_pcts:
        out = out.withColumns(
            {n: F.col(_PCT)[i] for i, (_, n) in enumerate(wanted_pcts)}
        ).drop(_PCT)
    keys = [c for c in out.columns if c not in metrics]
    return out.select(*keys, *[m for m in metrics])
