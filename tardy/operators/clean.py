"""Data-quality rules, the one-pass rejection report and deterministic dedup."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tardy.schema import DEDUP_KEYS

# Exclusive bounds of a plausible departure delay (minutes).
DELAY_LOWER_EXCLUSIVE = -60
DELAY_UPPER_EXCLUSIVE = 1000


def quality_rules(require_destination: bool = True) -> list[tuple[str, Column]]:
    """(name, keep-condition) in evaluation order. A null condition means reject.

    The stream job does not require a destination (it never joins it)."""
    rules = [
        ("cancelled", F.col("CANCELLED") == 0),
        ("diverted", F.col("DIVERTED") == 0),
        ("missing_airline", F.col("AIRLINE").isNotNull()),
        ("missing_origin", F.col("ORIGIN_AIRPORT").isNotNull()),
        ("missing_destination", F.col("DESTINATION_AIRPORT").isNotNull()),
        ("missing_delay", F.col("DEPARTURE_DELAY").isNotNull()),
        ("delay_too_low", F.col("DEPARTURE_DELAY") > DELAY_LOWER_EXCLUSIVE),
        ("delay_too_high", F.col("DEPARTURE_DELAY") < DELAY_UPPER_EXCLUSIVE),
    ]
    if not require_destination:
        rules = [r for r in rules if r[0] != "missing_destination"]
    return rules


def apply_quality_filters(df: DataFrame, require_destination: bool = True) -> DataFrame:
    """Keep rows passing every rule (one Filter; Catalyst pushes the simple ones
    into the scan)."""
    return df.filter(reduce(lambda a, b: a & b, [c for _, c in quality_rules(require_destination)]))


def rejection_report(df: DataFrame, require_destination: bool = True) -> DataFrame:
    """One row: total_rows, rows lost to each rule (first failing rule wins), kept_rows.

    A single aggregate pass (partial + final), whatever the input size. When
    the input carries the CSV reader's ``_corrupt_record`` column, the rows
    with a malformed field (kept, that field null) are counted too."""
    passed = F.lit(True)
    exprs = [F.count(F.lit(1)).alias("total_rows")]
    for name, cond in quality_rules(require_destination):
        ok = F.coalesce(cond, F.lit(False))
        exprs.append(F.count_if(passed & ~ok).alias(f"rejected_{name}"))
        passed = passed & ok
    exprs.append(F.count_if(passed).alias("kept_rows"))
    if "_corrupt_record" in df.columns:
        exprs.append(F.count_if(F.col("_corrupt_record").isNotNull()).alias("malformed_rows"))
    return df.agg(*exprs)


def dedup_first(df: DataFrame, keys: list[str] = DEDUP_KEYS,
                order_by: list[Column | str] | None = None) -> DataFrame:
    """One row per key (null equals null), the survivor being the first row in
    ``order_by`` (default: every non-key column ascending, nulls first), so the
    result is the same on every run and every partitioning.

    ``row_number() = 1`` plans as WindowGroupLimit: each map task keeps only its
    first row per key before the shuffle, so a key holding a large share of the
    rows sends at most one row per map task."""
    if order_by is None:
        order_by = [c for c in df.columns if c not in keys]
    order = [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order_by]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


# The dedup key with its most selective columns first (same set as DEDUP_KEYS,
# so the same result): the sort behind the window then settles most
# comparisons on its 8-byte key prefix instead of the near-constant YEAR.
DEDUP_SORT_KEYS = ["FLIGHT_NUMBER", "SCHEDULED_DEPARTURE", "ORIGIN_AIRPORT", "TAIL_NUMBER",
                   "DAY", "MONTH", "YEAR"]
assert sorted(DEDUP_SORT_KEYS) == sorted(DEDUP_KEYS)


def clean_flights(df: DataFrame, require_destination: bool = True, dedup: bool = True,
                  dedup_order: list[Column | str] | None = None) -> DataFrame:
    """Normalised fact -> quality filters -> (batch only) dedup."""
    out = apply_quality_filters(df, require_destination)
    return dedup_first(out, DEDUP_SORT_KEYS, dedup_order).select(*out.columns) if dedup else out
