"""Left-join enrichment with airline and airport dimensions, and its diagnostics.

Dimensions are broadcast only after a bounded size check (``limit(n + 1)``),
and their keys are checked for uniqueness: a repeated code would silently
multiply fact rows in a left join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest dimension we broadcast (rows; a few tens of MB for these narrow
# tables, shipped once per executor). Airline / airport dimensions are tens to
# thousands of rows; above the bound the planner's shuffle join (with AQE
# skew-join splitting) is used instead.
MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 64 << 20


class DuplicateDimensionKey(ValueError):
    pass


def guarded_dimension(dim: DataFrame, key: str, max_rows: int = MAX_BROADCAST_ROWS,
                      check_unique: bool = True) -> DataFrame:
    """Return ``dim`` broadcast-hinted if it has at most ``max_rows`` rows and
    ``MAX_BROADCAST_BYTES`` of values.

    The probe reads at most ``max_rows + 1`` rows. Null keys never match, so
    they are not counted as duplicates."""
    probe = (
        dim.limit(max_rows + 1)
        .agg(F.count(F.lit(1)).alias("n"), F.count(key).alias("k"),
             F.count_distinct(key).alias("d"),
             F.sum(sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in dim.columns), F.lit(0))).alias("bytes"))
        .first()
    )
    small = probe["n"] <= max_rows
    if check_unique:
        if small:
            dup = probe["k"] != probe["d"]
        else:
            dup = dim.groupBy(key).count().filter("count > 1").limit(1).count() > 0
        if dup:
            raise DuplicateDimensionKey(f"dimension key {key!r} is not unique")
    return F.broadcast(dim) if small and (probe["bytes"] or 0) <= MAX_BROADCAST_BYTES else dim


def enrich_flights(df: DataFrame, airlines: DataFrame, airports: DataFrame,
                   with_destination: bool = True, guard: bool = True) -> DataFrame:
    """fact ⟕ airlines (AIRLINE) ⟕ airports as origin [⟕ airports as destination].

    ``airlines`` / ``airports`` are the normalised dimensions from
    ``functions.codes``. The stream job joins only airline and origin."""
    if guard:
        airlines = guarded_dimension(airlines, "AIRLINE_CODE")
        airports = guarded_dimension(airports, "AIRPORT_CODE")

    def role(prefix: str, city: str, state: str) -> DataFrame:
        return airports.select(
            F.col("AIRPORT_CODE").alias(f"{prefix}_AIRPORT_CODE"),
            F.col("AIRPORT_NAME").alias(f"{prefix}_AIRPORT_NAME"),
            F.col("CITY_NAME").alias(city),
            F.col("STATE_CODE").alias(state),
        )

    out = df.join(airlines, F.col("AIRLINE") == F.col("AIRLINE_CODE"), "left")
    out = out.join(role("ORIGIN", "ORIGIN_CITY", "ORIGIN_STATE"),
                   F.col("ORIGIN_AIRPORT") == F.col("ORIGIN_AIRPORT_CODE"), "left")
    if with_destination:
        out = out.join(role("DEST", "DEST_CITY", "DEST_STATE"),
                       F.col("DESTINATION_AIRPORT") == F.col("DEST_AIRPORT_CODE"), "left")
    return out


def attach_names(gold: DataFrame, airlines: DataFrame, airports: DataFrame,
                 guard: bool = True) -> DataFrame:
    """Add AIRLINE_NAME and the origin's name / city / state to rows keyed by
    AIRLINE and ORIGIN_AIRPORT codes (e.g. statistics aggregated by code).

    Same result as joining before aggregating — keys are unique — but the
    join touches one row per group instead of one per fact, and the names
    stay out of shuffle and state keys."""
    if guard:
        airlines = guarded_dimension(airlines, "AIRLINE_CODE")
        airports = guarded_dimension(airports, "AIRPORT_CODE")
    origin = airports.select(
        F.col("AIRPORT_CODE").alias("_origin_code"),
        # The names of the joined columns.
        F.col("AIRPORT_NAME").alias("ORIGIN_AIRPORT_NAME"),
        F.col("CITY_NAME").alias("ORIGIN_CITY"),
        F.col("STATE_CODE").alias("ORIGIN_STATE"),
    )
    return (
        gold.join(airlines, F.col("AIRLINE") == F.col("AIRLINE_CODE"), "left")
        .join(origin, F.col("ORIGIN_AIRPORT") == F.col("_origin_code"), "left")
        .drop("AIRLINE_CODE", "_origin_code")
    )


def diagnostic_counts() -> list[Column]:
    """total_rows, origin_missing, dest_missing (rows without a match) as aggregates."""
    return [
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("ORIGIN_AIRPORT_NAME").isNull()).alias("origin_missing"),
        F.count_if(F.col("DEST_AIRPORT_NAME").isNull()).alias("dest_missing"),
    ]


def enrichment_diagnostics(enriched: DataFrame) -> DataFrame:
    """The counts as one row, computed in one aggregate pass."""
    return enriched.agg(*diagnostic_counts())


_SIDES = [
    ("origin", "ORIGIN_AIRPORT", "ORIGIN_AIRPORT_NAME"),
    ("destination", "DESTINATION_AIRPORT", "DEST_AIRPORT_NAME"),
]


def unmatched_codes(enriched: DataFrame) -> DataFrame:
    """(side, code) for every fact row and side whose code found no airport —
    both sides from one pass over the rows."""
    sides = F.explode(F.array(*[
        F.struct(F.lit(side).alias("side"), F.col(code).alias("code"),
                 F.col(name).isNull().alias("missing"))
        for side, code, name in _SIDES
    ]))
    missing = F.col("ORIGIN_AIRPORT_NAME").isNull() | F.col("DEST_AIRPORT_NAME").isNull()
    return enriched.filter(missing).select(sides.alias("s")).select("s.*").filter("missing").drop("missing")


def unmatched_code_counts(enriched: DataFrame) -> DataFrame:
    """(side, code, num_rows) for every code that found no airport, per side."""
    return unmatched_codes(enriched).groupBy("side", "code").agg(F.count(F.lit(1)).alias("num_rows"))


def unmatched_code_examples(enriched: DataFrame, limit: int = 50) -> DataFrame:
    """(side, code): up to ``limit`` distinct unmatched codes per side, lowest codes first.

    Distinct (partial per task) then ``row_number() <= limit`` per side, which
    plans as a partial WindowGroupLimit: each task ships at most ``limit`` codes
    per side, however many distinct codes there are."""
    from pyspark.sql import Window

    w = Window.partitionBy("side").orderBy(F.col("code").asc_nulls_first())
    return (
        unmatched_codes(enriched).distinct()
        .withColumn("_rn", F.row_number().over(w))
        .filter(F.col("_rn") <= limit)
        .drop("_rn")
    )
