"""Adapters from the shared test tables (``/root/testdata/sf*/``) to the pipeline's inputs.

The reference ships no data; FIXTURES.md §2 derives the flights fact, the two
dimensions and the stream fact from the TPC-H-like tables. The SQL texts are
portable: Spark runs them with DataFrame arguments (no global temp views), and
the DuckDB oracle runs the same text against its registered views.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FLIGHTS_SQL = """
select cast(year(dt) as int) as YEAR, cast(month(dt) as int) as MONTH, cast(day(dt) as int) as DAY,
  cast((3 + k) % 7 + 1 as int) as DAY_OF_WEEK,
  case when l_suppkey % 43 = 0 then null else concat(case when l_suppkey % 2 = 0 then ' c' else 'C' end, cast(l_suppkey % 14 as string), ' ') end as AIRLINE,
  cast(l_orderkey as string) as FLIGHT_NUMBER,
  case when l_orderkey % 29 = 0 then null else concat('T', cast((l_orderkey + l_linenumber) % 500 as string)) end as TAIL_NUMBER,
  concat(case when l_orderkey % 2 = 0 then 'n' else ' N' end, cast((l_orderkey * 7 + l_linenumber) % 27 as string)) as ORIGIN_AIRPORT,
  case when l_partkey % 53 = 0 then null else concat('n', cast((l_partkey * 3 + l_linenumber) % 27 as string)) end as DESTINATION_AIRPORT,
  cast(((l_orderkey * 7 + l_linenumber * 13) % 25) * 100 + (l_orderkey * 17) % 60 as int) as SCHEDULED_DEPARTURE,
  case when (l_partkey + l_linenumber) % 71 = 0 then null
       when l_partkey % 97 = 0 then cast(900 + (l_orderkey * 3) % 300 as double)
       when l_partkey % 5 = 0 then cast((l_orderkey * 37 + l_linenumber * 101) % 400 as double)
       else cast(-80 + (l_orderkey * 11 + l_partkey * 3 + l_linenumber * 101) % 130 as double) end as DEPARTURE_DELAY,
  case when l_partkey % 31 = 0 then null else cast(30 + l_quantity * 5 as double) end as AIR_TIME,
  cast(100 + (l_partkey * 13) % 2500 as double) as DISTANCE,
  cast(case when l_partkey % 89 = 0 then 1 else 0 end as int) as DIVERTED,
  cast(case when l_partkey % 61 = 0 then 1 else 0 end as int) as CANCELLED,
  l_linenumber as SRC_LINE, l_partkey as SRC_PART, l_suppkey as SRC_SUPP, l_extendedprice as SRC_PRICE
from (select *, (l_orderkey % 24) * 15 as k, date '2015-01-15' + cast((l_orderkey % 24) * 15 as int) as dt
      from {lineitem}) t
"""

AIRLINES_SQL = """
select concat('C', cast(s_suppkey as string)) as IATA_CODE, s_name as AIRLINE
from {supplier}
"""  # facts use C0 to C13

AIRPORTS_SQL = """
select concat('N', cast(n_nationkey as string)) as IATA_CODE, n_name as AIRPORT,
  concat('CITY_', cast(n_nationkey as string)) as CITY, r_name as STATE
from {nation} join {region} on n_regionkey = r_regionkey
"""

FLIGHTS_STREAM_SQL = """
select cast(year(ts) as int) as YEAR, cast(month(ts) as int) as MONTH, cast(day(ts) as int) as DAY,
  cast((day(ts) - 1) % 7 + 1 as int) as DAY_OF_WEEK,
  concat('c', cast(user_id % 14 as string)) as AIRLINE, cast(event_id as string) as FLIGHT_NUMBER,
  concat('T', cast(user_id as string)) as TAIL_NUMBER,
  concat(' n', cast(user_id % 27 as string)) as ORIGIN_AIRPORT, concat('N', cast(event_id % 27 as string)) as DESTINATION_AIRPORT,
  cast(hour(ts) * 100 + minute(ts) as int) as SCHEDULED_DEPARTURE,
  case when event_id % 71 = 0 then null else cast(floor(value) - 20 as double) end as DEPARTURE_DELAY,
  case when event_id % 31 = 0 then null else cast(30 + event_id % 300 as double) end as AIR_TIME,
  cast(100 + event_id % 2500 as double) as DISTANCE,
  cast(case when event_id % 89 = 0 then 1 else 0 end as int) as DIVERTED,
  cast(case when event_type = 'error' and event_id % 3 = 0 then 1 else 0 end as int) as CANCELLED
from {events}
"""

# The stream fixture dealt into files that arrive one after the other, a part of about eight days each.
# Some flights come a part too late (behind any watermark), some of the last minutes of a part
# come with the next one, within the watermark's delay.
STREAM_PARTS = 4
DEALT_SQL = f"""
select *, least({STREAM_PARTS - 1}, part + case when too_late or straddles then 1 else 0 end) as delivered
from (select *, least({STREAM_PARTS - 1}, cast(floor((DAY - 1) / 8) as int)) as part,
    cast(FLIGHT_NUMBER as bigint) % 13 = 0 and (DAY - 1) % 8 < 6 and DAY <= {8 * (STREAM_PARTS - 1)} as too_late,
    cast(FLIGHT_NUMBER as bigint) % 2 = 1 and (DAY - 1) % 8 = 7 and SCHEDULED_DEPARTURE >= 2335 as straddles
  from ({FLIGHTS_STREAM_SQL}) f) d
"""

# Planned departures of the stream fixture, and those that happened (some flights never leave), each with
# the part in which its file arrives.
_EVENT_TS = "make_timestamp(YEAR, MONTH, DAY, cast(floor(SCHEDULED_DEPARTURE / 100) as int), SCHEDULED_DEPARTURE % 100, 0)"
PLANNED_SQL = f"""
select TAIL_NUMBER, FLIGHT_NUMBER, {_EVENT_TS} as planned_ts, least({STREAM_PARTS - 1}, cast(floor((DAY - 1) / 8) as int)) as delivered
from ({FLIGHTS_STREAM_SQL}) f
"""
ACTUAL_SQL = f"""
select TAIL_NUMBER, FLIGHT_NUMBER as ACTUAL_FLIGHT, actual_ts,
  case when actual_ts < timestamp '2024-01-01 00:00:00' then 0 when month(actual_ts) > 1 then {STREAM_PARTS - 1} else least({STREAM_PARTS - 1}, cast(floor((day(actual_ts) - 1) / 8) as int)) end as delivered
from (select *, {_EVENT_TS} + cast(DEPARTURE_DELAY as int) * interval '1' minute as actual_ts
  from ({FLIGHTS_STREAM_SQL}) f where CANCELLED = 0 and DEPARTURE_DELAY is not null) a
"""

# Names that airlines have for some months each: the first from ever, the last for good; every fifth airline has none in summer.
VERSIONS_SQL = " union all ".join(f"""
select concat('C', cast(s_suppkey as string)) as VERSION_CODE, concat(s_name, ' v{v}') as VERSION_NAME,
  {f"date '2015-01-01' + cast({v} * 90 + s_suppkey % 7 as int)" if v else "cast(null as date)"} as valid_from,
  {f"date '2015-01-01' + cast({v + 1} * 90 + s_suppkey % 7 as int)" if v < 3 else "cast(null as date)"} as valid_to
from {{supplier}}{" where s_suppkey % 5 <> 0" if v == 2 else ""}""" for v in range(4))

# Row identity of the flights fixture (unique per lineitem row) and of the stream fixture.
FLIGHTS_ROW_KEY = ["FLIGHT_NUMBER", "SRC_LINE", "SRC_PART", "SRC_SUPP"]
STREAM_ROW_KEY = ["FLIGHT_NUMBER"]


# Fact tables: scanned in parallel even when stored as one unsplittable row group.
FACT_TABLES = {"lineitem", "events"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df) if name in FACT_TABLES else df


def spread(df: DataFrame) -> DataFrame:
    """Spread the rows over the cluster's cores when the scan yields fewer
    splits than cores (e.g. one Parquet row group). Large inputs already have
    more splits than cores and are returned unchanged (no extra shuffle).

    Hash of all columns: deterministic on task retry without the local sort a
    round-robin repartition needs, and not skewed by any single column."""
    try:
        target = df.sparkSession.sparkContext.defaultParallelism
        splits = df.rdd.getNumPartitions()
    except Exception:  # no RDD view (e.g. Spark Connect): leave the scan as it is
        return df
    if splits >= target:
        return df
    return df.repartition(target, *[F.col(c) for c in df.columns])


def _run(spark: SparkSession, sf_dir: str, sql: str, *names: str) -> DataFrame:
    return spark.sql(sql, **{n: table(spark, sf_dir, n) for n in names})


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flights fact (15 reference columns + SRC_* provenance) derived from ``lineitem``."""
    return _run(spark, sf_dir, FLIGHTS_SQL, "lineitem")


def airlines_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airline dimension as it would come from its CSV (IATA_CODE, AIRLINE)."""
    return _run(spark, sf_dir, AIRLINES_SQL, "supplier")


def airports_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airport dimension as it would come from its CSV (IATA_CODE, AIRPORT, CITY, STATE)."""
    return _run(spark, sf_dir, AIRPORTS_SQL, "nation", "region")


def flights_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream-side flights derived from ``events`` (January 2024)."""
    return _run(spark, sf_dir, FLIGHTS_STREAM_SQL, "events")


def flights_stream_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream fixture with every seventh event delivered twice."""
    rows = flights_stream(spark, sf_dir)
    return rows.unionByName(rows.where("cast(FLIGHT_NUMBER as bigint) % 7 = 0"))


def flights_stream_dealt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream fixture with part, too_late, straddles and delivered (the part it arrives in)."""
    return _run(spark, sf_dir, DEALT_SQL, "events")


def departures(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(planned, actual) departures of the stream fixture with ``delivered``."""
    return _run(spark, sf_dir, PLANNED_SQL, "events"), _run(spark, sf_dir, ACTUAL_SQL, "events")


def airline_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VERSION_CODE, VERSION_NAME, valid_from, valid_to (null: open)."""
    return _run(spark, sf_dir, VERSIONS_SQL, "supplier")


def duckdb_sql(sql: str) -> str:
    """The same fixture text for the DuckDB oracle, where tables are plain views."""
    return sql.format(lineitem="lineitem", supplier="supplier", nation="nation",
                      region="region", events="events")
