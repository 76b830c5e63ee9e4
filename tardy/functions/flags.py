"""Business flags and categories derived per flight (added after the silver write)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Thresholds (minutes) and labels of the delay rules.
DELAYED_AFTER = 15
CATEGORY_UPPER_BOUNDS = [
    (0, "Early/On-time"),
    (15, "Minor"),
    (60, "Moderate"),
    (180, "Severe"),
]
CATEGORY_ABOVE = "Extreme"
DELAY_CATEGORIES = [label for _, label in CATEGORY_UPPER_BOUNDS] + [CATEGORY_ABOVE]

# DAY_OF_WEEK uses Monday = 1, so 6 and 7 are the weekend.
WEEKEND_DAYS = (6, 7)
# Rush hours, inclusive ranges of the departure hour.
RUSH_HOURS = ((6, 9), (16, 19))
# Time-of-day buckets (inclusive hour ranges); anything else is Night.
TIME_OF_DAY = [((5, 11), "Morning"), ((12, 16), "Afternoon"), ((17, 20), "Evening")]
TIME_OF_DAY_ELSE = "Night"
# Seasons by month; anything else is Fall.
SEASONS = [((12, 1, 2), "Winter"), ((3, 4, 5), "Spring"), ((6, 7, 8), "Summer")]
SEASON_ELSE = "Fall"


def _first_match(pairs: list[tuple[Column, str]], default: str) -> Column:
    expr = None
    for cond, label in pairs:
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(default)


def flag_columns(delay: str = "DEPARTURE_DELAY", dow: str = "DAY_OF_WEEK",
                 hour: str = "DEP_HOUR", month: str = "MONTH") -> dict[str, Column]:
    d, h = F.col(delay), F.col(hour)
    return {
        "is_delayed": F.when(d > DELAYED_AFTER, 1).otherwise(0),
        "is_on_time": F.when(d <= DELAYED_AFTER, 1).otherwise(0),
        "delay_category": _first_match(
            [(d <= bound, label) for bound, label in CATEGORY_UPPER_BOUNDS], CATEGORY_ABOVE
        ),
        "is_weekend": F.when(F.col(dow).isin(*WEEKEND_DAYS), 1).otherwise(0),
        "is_rush_hour": F.when(
            h.between(*RUSH_HOURS[0]) | h.between(*RUSH_HOURS[1]), 1
        ).otherwise(0),
        "time_of_day": _first_match(
            [(h.between(lo, hi), label) for (lo, hi), label in TIME_OF_DAY], TIME_OF_DAY_ELSE
        ),
        "season": _first_match(
            [(F.col(month).isin(*months), label) for months, label in SEASONS], SEASON_ELSE
        ),
    }


def add_flags(df: DataFrame) -> DataFrame:
    """is_delayed, is_on_time, delay_category, is_weekend, is_rush_hour, time_of_day,
    season — one projection. Needs DEP_HOUR (see ``clock.add_calendar_columns``)."""
    if "DEP_HOUR" not in df.columns:
        from tardy.functions.clock import clock_hour

        df = df.withColumn("DEP_HOUR", clock_hour())
    return df.withColumns(flag_columns())
