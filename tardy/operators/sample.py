"""Uniform random sample of exactly n rows, a bounded reservoir cut by random keys.

Every row gets a random key, a hash of the seed and of the row's identity; the sample is the
n rows with the least keys. Keys of different tasks can be compared, so reservoirs of
tasks merge by a bound alone: with N rows in all, the n least keys lie below about n / N of
the key space. The scan itself drops the rows above that bound (plus eight standard
deviations), so all tasks together keep about ``n + 8 * sqrt(n)`` rows, whatever the input's size
and however often equal rows occur; nothing else of it is shuffled, sorted or held. The
kept slice is written once to the shared scratch folder and counted; its few surplus rows
are cut exactly. A slice that came out short (about once in 10^15 samples) is drawn anew with a wider bound.

Identity: columns that tell all rows apart, if there are any (the sample is then the same for any
layout of the files, and SQL can state it), else a row's place in the scan. Rows that are equal in all columns can
be told apart by a copy number (``numbered_copies``): the sample of values is then the same for any layout, too.
"""

from __future__ import annotations

import math
import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tardy.session import materialize

_PREFIX_HEX = 15                      # 60 bits of the digest, fits a signed long
_KEY_SPACE = 16 ** _PREFIX_HEX


def encoded(value: Column) -> Column:
    """Length and text of a value, '-' for null: no two lists of values read alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def sample_hash(seed: int | str, identity: list[str], copy: str | None = None) -> Column:
    number = [F.col(copy).cast("string")] if copy else []
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *(encoded(F.col(c)) for c in identity), *number))


COPY = "_sample_copy"
# Copies numbered by one row of the expansion: a value of any number of rows is spread over the tasks.
COPY_BLOCK = 100_000


def numbered_copies(df: DataFrame, block: int = COPY_BLOCK) -> DataFrame:
    """The rows of ``df`` with ``COPY``: 0, 1, ... among the rows equal in all columns (null equals null).

    Equal rows are counted (partial counts per task) and written out again in blocks of ``block`` copies, so
    neither a sort of the input nor a task with all rows of a frequent value is needed."""
    counts = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    first = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1, F.lit(block).cast("long")))
    blocks = counts.withColumn("_first", first)
    last = F.least(F.col("_copies"), F.col("_first") + block) - 1
    # A number of tasks of its own: the blocks are few bytes, which AQE would gather in one task before they grow.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return blocks.repartition(tasks, *df.columns, "_first").select(*df.columns, F.explode(F.sequence("_first", last)).alias(COPY))


KEY = ["_sample_key", "_sample_tie", "_sample_place"]


def keyed(df: DataFrame, seed: int | str, identity: list[str] | None, copy: str | None = None) -> DataFrame:
    """Adds ``KEY``: the random key (0 to 2^60) and what breaks its ties."""
    rows = df.withColumn("_sample_place", F.monotonically_increasing_id())
    if identity:
        rows = rows.withColumn("_sample_tie", sample_hash(seed, identity, copy))
        return rows.withColumn("_sample_key", F.conv(F.substring("_sample_tie", 1, _PREFIX_HEX), 16, 10).cast("long"))
    random_key = F.shiftrightunsigned(F.xxhash64(F.lit(str(seed)), "_sample_place"), 4)
    return rows.withColumn("_sample_key", random_key).withColumn("_sample_tie", F.col("_sample_place"))


def below(df: DataFrame, share: float, seed: int | str, identity: list[str] | None, copy: str | None = None) -> DataFrame:
    """The rows whose key lies in the first ``share`` of the key space: a narrow filter of the scan."""
    return keyed(df, seed, identity, copy).filter(F.col("_sample_key") < F.lit(int(share * _KEY_SPACE)))


def sample_exact_n(df: DataFrame, n: int, identity: list[str] | None = None, seed: int | str | None = None,
                   copies: bool = False) -> DataFrame:
    """Exactly ``min(n, count(df))`` rows, each row equally likely; another sample each
    time if ``seed`` is None. ``copies``: ``identity`` is all columns, and equal rows are told apart by a copy number."""
    if copies and sorted(identity or []) != sorted(df.columns):
        raise ValueError("copies are numbered among rows equal in all columns: identity must be all columns")
    seed = random.SystemRandom().randrange(1 << 62) if seed is None else seed
    total = df.count()
    if total <= n:
        return df
    rows, copy = (numbered_copies(df), COPY) if copies else (df, None)
    share = min(1.0, (n + 8 * math.sqrt(n) + 16) / total)
    while True:
        kept = materialize(below(rows, share, seed, identity, copy), "sample-slice")
        surplus = kept.count() - n
        if surplus >= 0:
            break
        share = min(1.0, share * 2)
    if surplus:
        # About 8 * sqrt(n) keys: the least of the greatest ones is the bound.
        key = F.struct(*KEY)
        greatest = kept.select(key.alias("k")).orderBy(F.col("k").desc()).limit(surplus)
        kept = kept.filter(key < greatest.agg(F.min("k")).scalar())
    return kept.select(*df.columns)
