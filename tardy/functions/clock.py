"""Dates and clock times built from the YEAR / MONTH / DAY / HHMM columns.

Spark 4 runs with ANSI mode on: ``to_date('2015-2-30')`` and
``to_timestamp('... 24:00:00')`` raise. The ``try_`` forms return null instead,
which is the behaviour the pipeline relies on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flight_date(year: Column | str = "YEAR", month: Column | str = "MONTH",
                day: Column | str = "DAY") -> Column:
    """FL_DATE. Null when any part is null (``concat_ws`` would silently skip it)
    or when the parts are not a calendar date."""
    y, m, d = _c(year), _c(month), _c(day)
    text = F.concat_ws("-", y.cast("string"), m.cast("string"), d.cast("string"))
    return F.when(y.isNotNull() & m.isNotNull() & d.isNotNull(), F.try_to_date(text))


def clock_hour(hhmm: Column | str = "SCHEDULED_DEPARTURE") -> Column:
    """Hour of an HHMM clock value: trunc(HHMM / 100) as int (2400 gives 24)."""
    return (_c(hhmm) / 100).cast("int")


def clock_minute(hhmm: Column | str = "SCHEDULED_DEPARTURE") -> Column:
    return (_c(hhmm) % 100).cast("int")


def event_time(year: Column | str = "YEAR", month: Column | str = "MONTH",
               day: Column | str = "DAY", hhmm: Column | str = "SCHEDULED_DEPARTURE") -> Column:
    """Event timestamp ``YYYY-MM-DD HH:MM:00`` in the session time zone.

    Null for clock values that are not times of day (24:00, minute 75) and for
    null parts, so such rows drop out of event-time processing.
    """
    # Fixed value: the pattern of the event timestamp.
    text = F.format_string(
        "%04d-%02d-%02d %02d:%02d:00",
        _c(year), _c(month), _c(day), clock_hour(hhmm), clock_minute(hhmm),
    )
    return F.try_to_timestamp(text)


def add_calendar_columns(df: DataFrame) -> DataFrame:
    """FL_DATE and DEP_HOUR (the two columns the silver layer carries)."""
    return df.withColumns({"FL_DATE": flight_date(), "DEP_HOUR": clock_hour()})


def add_event_time(df: DataFrame, drop_invalid: bool = True) -> DataFrame:
    """event_ts from the scheduled departure; rows without a valid time dropped."""
    out = df.withColumn("event_ts", event_time())
    return out.filter(F.col("event_ts").isNotNull()) if drop_invalid else out
