"""Exact percentiles by distributed selection, and stored sketches for approximate ones.

Exact: rows are first counted per key and value (map-side combine: a key of any number of rows is as
many rows as it has values). The counts are dealt over tasks by ranges of (key, value), so the values of a
hot key lie in several tasks, each a stretch of its order. The sums of each stretch (a row per key and
task) tell how many rows lie before it; running counts within a stretch then tell which value holds a wanted
rank. No group is ever in one task.

Sketches: a KLL sketch of the delays and a HyperLogLog sketch of the aircraft are kept per day and
airline, a few kilobytes each. Longer periods are merged from them without reading a fact again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tardy.session import materialize


def exact_percentiles(df: DataFrame, keys: list[str], value: str, quantiles: list[float]) -> DataFrame:
    """``keys``, quantile, value: the least value with at least quantile * n of the key's n non-null values up to it."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    dealt = counts.repartitionByRange(*keys, value).withColumn("_stretch", F.spark_partition_id())
    dealt = materialize(dealt, "percentile-counts")
    sums = dealt.groupBy(*keys, "_stretch").agg(F.sum("_n").alias("_sum"))
    earlier = Window.partitionBy(*keys).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*keys, F.col("_stretch").alias("_of"), F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"), "_sum",
                       F.sum("_sum").over(Window.partitionBy(*keys)).alias("_total"))
    # The stretches that hold a wanted rank, with the ranks: only their values are looked at.
    rank = F.greatest(F.ceil(F.col("quantile") * F.col("_total")), F.lit(1))
    asked = sums.withColumn("quantile", F.explode(F.array(*map(F.lit, quantiles)))).withColumn("_rank", rank)
    asked = asked.where((F.col("_rank") > F.col("_before")) & (F.col("_rank") <= F.col("_before") + F.col("_sum")))
    asked = asked.select(*(F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)), "_of", "_before", "quantile", "_rank")
    same = [F.col("_stretch") == F.col("_of"), *(F.col(k).eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(keys))]
    held = dealt.join(asked.drop("_before", "quantile", "_rank").distinct(), same, "left_semi")
    up_to = F.sum("_n").over(Window.partitionBy(*keys, "_stretch").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = held.withColumn("_up_to", up_to).join(asked, same)
    place = F.col("_rank") - F.col("_before")
    return found.where((place <= F.col("_up_to")) & (place > F.col("_up_to") - F.col("_n"))).select(*keys, "quantile", value)


#: Size parameters: rank error of a KLL sketch about 2.3 / k; relative error of HyperLogLog about 1.04 / 2^(bits / 2).
KLL_K, HLL_BITS = 400, 12


def day_sketches(df: DataFrame, keys: list[str], value: str = "DEPARTURE_DELAY", counted: str = "TAIL_NUMBER") -> DataFrame:
    """A row per ``keys`` with num_rows, delays (KLL, binary) and aircraft (HyperLogLog, binary)."""
    return df.groupBy(*keys).agg(F.count(value).alias("num_rows"), F.kll_sketch_agg_double(value, F.lit(KLL_K)).alias("delays"),
                                 F.hll_sketch_agg(counted, F.lit(HLL_BITS)).alias("aircraft"))


def merged_sketches(sketches: DataFrame, keys: list) -> DataFrame:
    """The sketches of longer periods or of fewer keys, from stored ones alone."""
    return sketches.groupBy(*keys).agg(F.sum("num_rows").alias("num_rows"), F.kll_merge_agg_double("delays").alias("delays"),
                                       F.hll_union_agg("aircraft").alias("aircraft"))


def sketch_quantiles(sketches: DataFrame, quantiles: list[float]) -> DataFrame:
    """Quantile and value per row of sketches, and the estimated number of aircraft."""
    asked = F.array(*map(F.lit, quantiles))
    pairs = F.explode(F.arrays_zip(asked.alias("quantile"), F.kll_sketch_get_quantile_double("delays", asked).alias("value"))).alias("pair")
    kept = [c for c in sketches.columns if c not in ("delays", "aircraft")]
    rows = sketches.select(*kept, F.hll_sketch_estimate("aircraft").alias("num_aircraft"), pairs)
    return rows.select(*kept, "num_aircraft", "pair.quantile", "pair.value")
