"""Facts joined with the row of a dimension that was valid at their time.

A range condition alone would plan as a nested-loop join of all facts with all versions of all codes.
Time is cut into buckets instead: a version is repeated once for each bucket that its range touches
(clipped to the facts' own time span, so an open end costs no more than the span), a fact has exactly
one bucket, and code and bucket join by equality; the range is checked on what meets. The bucket also
splits a hot code: its facts spread over as many keys as they span buckets, and AQE
splits a bucket of one that is still too large.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET_SECONDS = 7 * 86_400


def _bucket(time: Column, seconds: int) -> Column:
    return F.floor(F.unix_seconds(time) / seconds)


def valid_at(facts: DataFrame, versions: DataFrame, code: str, time: str, version_code: str,
             valid_from: str = "valid_from", valid_to: str = "valid_to", bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Every fact with each version of its code whose range [``valid_from``, ``valid_to``) holds its time
    (left outer). Null bounds are open; ``time`` may be a date or a timestamp; the versions' columns must
    not clash with the facts'."""
    at = F.col(time).cast("timestamp")
    first, last = facts.agg(F.min(at), F.max(at)).first()
    if first is None:  # no fact has a time: no version can be valid
        versions = versions.where(F.lit(False))
    start = F.greatest(F.col(valid_from).cast("timestamp"), F.lit(first).cast("timestamp"))
    end = F.least(F.col(valid_to).cast("timestamp"), F.lit(last).cast("timestamp"))
    touched = versions.withColumns({"_start": start, "_end": end}).where("_start <= _end")
    buckets = F.sequence(_bucket(F.col("_start"), bucket_seconds), _bucket(F.col("_end"), bucket_seconds))
    spread = touched.withColumn("_bucket", F.explode(buckets)).drop("_start", "_end")
    inside = ((F.col(valid_from).isNull() | (F.col(valid_from).cast("timestamp") <= at))
              & (F.col(valid_to).isNull() | (F.col(valid_to).cast("timestamp") > at)))
    placed = facts.withColumn("_fact_bucket", _bucket(at, bucket_seconds))
    same = (F.col(code) == F.col(version_code)) & (F.col("_fact_bucket") == F.col("_bucket"))
    return placed.join(spread, same & inside, "left").drop("_bucket", "_fact_bucket")


def as_of(facts: DataFrame, versions: DataFrame, code: str, time: str, version_code: str, valid_from: str = "valid_from",
          bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Every fact with the latest version of its code that began at or before its time: a version is valid until the next begins."""
    from pyspark.sql import Window

    following = F.lead(valid_from).over(Window.partitionBy(version_code).orderBy(valid_from))
    return valid_at(facts, versions.withColumn("_until", following), code, time, version_code, valid_from, "_until", bucket_seconds).drop("_until")
