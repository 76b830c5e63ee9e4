"""Catalogue queries over versions of a dimension, percentiles, sketches and coarser grains, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tardy.functions.codes import normalize_flight_codes
from tardy.operators.aggregate import gold_grains
from tardy.operators.clean import apply_quality_filters
from tardy.operators.intervals import as_of, valid_at
from tardy.operators.percentiles import day_sketches, exact_percentiles, merged_sketches, sketch_quantiles
from tardy.plans import batch
from tardy.plans import oracle as O
from tardy.functions.clock import add_calendar_columns
from tardy.session import scratch_path
from tardy.sinks import parquet as sinks
from tardy.sources import testdata

ROW_KEY = testdata.FLIGHTS_ROW_KEY
# Asked quantiles, the share of rows of the hot key, bounds of the sketches' errors.
QUANTILES = (0.0, 0.01, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0)
HOT_KEY = "case when SRC_PART % 10 < 8 then 'most' else AIRLINE end"
RANK_ERROR, DISTINCT_ERROR = 0.02, 0.05
GRAINS = [["FL_DATE"], ["AIRLINE"], ["ORIGIN_AIRPORT"], []]


def clean_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_calendar_columns(apply_quality_filters(normalize_flight_codes(testdata.flights(spark, sf_dir))))


def q_interval_airline_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flights with the airline's name on their date; names change several times a year, some dates have none."""
    versions = testdata.airline_versions(spark, sf_dir)
    return valid_at(clean_rows(spark, sf_dir), versions, "AIRLINE", "FL_DATE", "VERSION_CODE").select(*ROW_KEY, "AIRLINE", "FL_DATE", "VERSION_NAME")


def q_asof_airline_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flights with the last name that their airline took on or before their date."""
    versions = testdata.airline_versions(spark, sf_dir).where("valid_from is not null").drop("valid_to")
    return as_of(clean_rows(spark, sf_dir), versions, "AIRLINE", "FL_DATE", "VERSION_CODE").select(*ROW_KEY, "AIRLINE", "FL_DATE", "VERSION_NAME")


def q_exact_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact delay percentiles, one key with most of the rows."""
    rows = clean_rows(spark, sf_dir).withColumn("key", F.expr(HOT_KEY))
    return exact_percentiles(rows, ["key"], "DEPARTURE_DELAY", list(QUANTILES)).withColumnRenamed("DEPARTURE_DELAY", "value")


def q_stored_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches kept per day and airline, read back, merged to quarters; whether their quantiles and
    distinct counts lie within the sketches' bounds."""
    rows, path = clean_rows(spark, sf_dir), scratch_path(spark, "sketches")
    day_sketches(rows, ["FL_DATE", "AIRLINE"]).write.partitionBy("FL_DATE").parquet(path)
    merged = merged_sketches(spark.read.parquet(path), [F.quarter("FL_DATE").alias("quarter")])
    asked = sketch_quantiles(merged, list(QUANTILES))
    exact = rows.groupBy(F.quarter("FL_DATE").alias("quarter"), "DEPARTURE_DELAY").agg(F.count(F.lit(1)).alias("n"))
    tails = rows.groupBy(F.quarter("FL_DATE").alias("quarter")).agg(F.count_distinct("TAIL_NUMBER").alias("tails"))
    n = lambda cond: F.sum(F.when(cond, F.col("n")).otherwise(0))
    ranked = asked.join(exact, "quarter").groupBy("quarter", "quantile", "num_rows", "num_aircraft").agg(
        n(F.col("DEPARTURE_DELAY") < F.col("value")).alias("below"), n(F.col("DEPARTURE_DELAY") <= F.col("value")).alias("upto"))
    slack, rank = F.col("num_rows") * RANK_ERROR + 1, F.col("quantile") * F.col("num_rows")
    within = (F.col("below") - slack <= rank) & (F.col("upto") + slack >= rank)
    near = F.abs(F.col("num_aircraft") - F.col("tails")) <= DISTINCT_ERROR * F.col("tails")
    return ranked.join(tails, "quarter").select(F.col("quarter").cast("long").alias("quarter"), "quantile", "num_rows", within.alias("rank_within_bound"), near.alias("distinct_within_bound"))


def q_gold_grains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days, airlines, origins and the whole from the written gold rows, in one pass."""
    gold = scratch_path(spark, "gold")
    batch.run_batch(spark, batch.testdata_inputs(spark, sf_dir), scratch_path(spark, "silver"), gold)
    return gold_grains(sinks.read_gold(spark, gold), GRAINS)


QUERIES = {
    "interval_airline_names": q_interval_airline_names,
    "asof_airline_names": q_asof_airline_names,
    "exact_percentiles": q_exact_percentiles,
    "stored_sketches": q_stored_sketches,
    "gold_grains": q_gold_grains,
}
DATED = {"interval_airline_names", "asof_airline_names", "gold_grains"}

_KEYS = ", ".join(f"c.{k}" for k in ROW_KEY)
_VERSIONS = f"(select * from ({testdata.duckdb_sql(testdata.VERSIONS_SQL)}))"
_DATED = "(select *, make_date(YEAR, MONTH, DAY) as FL_DATE from clean)"
_QUANTILES = f"(select unnest([{', '.join(f'{q}::double' for q in QUANTILES)}]) as quantile)"
ORACLE = {
    "interval_airline_names": O.with_batch(f"""
select {_KEYS}, c.AIRLINE, c.FL_DATE, VERSION_NAME
from {_DATED} c left join {_VERSIONS} v on c.AIRLINE = VERSION_CODE
  and (valid_from is null or valid_from <= c.FL_DATE) and (valid_to is null or valid_to > c.FL_DATE)"""),
    "asof_airline_names": O.with_batch(f"""
select {_KEYS}, c.AIRLINE, c.FL_DATE, VERSION_NAME
from {_DATED} c asof left join (select * from {_VERSIONS} where valid_from is not null) v on c.AIRLINE = VERSION_CODE and c.FL_DATE >= valid_from"""),
    "exact_percentiles": O.with_batch(f"""
select key, quantile, min(DEPARTURE_DELAY) as value
from (select {HOT_KEY} as key, DEPARTURE_DELAY, count(*) over (partition by key order by DEPARTURE_DELAY) as up_to, count(*) over (partition by key) as n from clean), {_QUANTILES}
where up_to >= ceil(quantile * n) group by key, quantile"""),
    "stored_sketches": O.with_batch(f"""
select quarter(FL_DATE) as quarter, quantile, count(*) as num_rows, true as rank_within_bound, true as distinct_within_bound
from {_DATED}, {_QUANTILES} group by all"""),
    "gold_grains": O.with_batch("""
select FL_DATE, AIRLINE, ORIGIN_AIRPORT, grouping_id(FL_DATE, AIRLINE, ORIGIN_AIRPORT) as grain, count(*) as num_flights,
  cast(sum(is_delayed) as bigint) as num_delayed, cast(sum(is_on_time) as bigint) as num_on_time,
  count_if(delay_category = 'Early/On-time') as num_early_ontime, count_if(delay_category = 'Minor') as num_minor_delay,
  count_if(delay_category = 'Moderate') as num_moderate_delay, count_if(delay_category = 'Severe') as num_severe_delay,
  count_if(delay_category = 'Extreme') as num_extreme_delay, cast(sum(is_weekend) as bigint) as num_weekend_flights,
  cast(sum(is_rush_hour) as bigint) as num_rush_hour_flights, min(DEPARTURE_DELAY) as min_dep_delay, max(DEPARTURE_DELAY) as max_dep_delay,
  avg(is_delayed) as delay_rate, avg(is_on_time) as on_time_rate
from features group by grouping sets ((FL_DATE), (AIRLINE), (ORIGIN_AIRPORT), ())"""),
}
