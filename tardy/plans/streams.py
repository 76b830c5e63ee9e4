"""Catalogue queries of the stateful stream operators, and their SQL.

Their input arrives as files in parts (``testdata.DEALT_SQL``); a streaming query is started for each part,
reads it as a micro-batch of its own and ends, so state, watermark and side outputs go through a restart
each time. Parts are written by as many tasks as the rows have, and read likewise.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from tardy.functions.clock import add_event_time
from tardy.functions.codes import airline_dimension, normalize_flight_codes
from tardy.functions.metrics import ALL_METRICS
from tardy.operators.aggregate import SESSION_GAP, WATERMARK_DELAY, session_gold
from tardy.operators.enrich import guarded_dimension
from tardy.plans import oracle as O
from tardy.schema import FLIGHT_SCHEMA
from tardy.session import materialize, scratch_path
from tardy.sources import testdata
from tardy.sources.csv import conform, read_flights_stream, write_csv
from tardy.streaming.dimension import VersionedDimension, named_batch_writer
from tardy.streaming.joins import EARLY, LATE, match_departures
from tardy.streaming.late import LateSplit
from tardy.streaming.pipeline import stream_rows
from tardy.streaming.running import EXPIRY_MINUTES, running_delay


DEALT_SCHEMA = T.StructType([*FLIGHT_SCHEMA.fields, T.StructField("delivered", T.IntegerType())])


def parts(rows: DataFrame) -> list[DataFrame]:
    """The rows of each part, without ``delivered``; the whole is written once, by part, so that each part reads its own rows."""
    held = materialize(rows, "stream-parts", partition_by=["delivered"])
    return [held.where(F.col("delivered") == i).drop("delivered") for i in range(testdata.STREAM_PARTS)]


def to_the_end(writer: DataStreamWriter) -> None:
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()


def arriving_flights(spark: SparkSession, sf_dir: str, run: Callable[[DataFrame], DataStreamWriter]) -> None:
    """The dealt stream fixture as CSV files, part by part; ``run`` makes the query over the file stream."""
    base = scratch_path(spark, "stream-in")
    for i, part in enumerate(parts(conform(testdata.flights_stream_dealt(spark, sf_dir), DEALT_SCHEMA))):
        write_csv(part, f"{base}/part_{i}")
        to_the_end(run(read_flights_stream(spark, f"{base}/*", max_files_per_trigger=None)))


def to_files(rows: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    return rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)


def q_stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of an airline's flights, merged in state over four parts; rows that come a part too late are dropped."""
    out, checkpoint = scratch_path(spark, "sessions"), scratch_path(spark, "sessions-ckpt")
    arriving_flights(spark, sf_dir, lambda flights: to_files(session_gold(stream_rows(flights, watermark=WATERMARK_DELAY)), out, checkpoint))
    return spark.read.parquet(out)


def q_stream_running_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flights and mean delay of an airline's run so far, from keyed state that expires."""
    out, checkpoint = scratch_path(spark, "running"), scratch_path(spark, "running-ckpt")
    arriving_flights(spark, sf_dir, lambda flights: to_files(running_delay(stream_rows(flights)), out, checkpoint))
    return spark.read.parquet(out).withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz"))


def q_stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row with a time, with its micro-batch and whether the watermark had passed it."""
    split, checkpoint = LateSplit(scratch_path(spark, "late-split")), scratch_path(spark, "late-split-ckpt")
    arriving_flights(spark, sf_dir, lambda flights: split.sink(add_event_time(normalize_flight_codes(flights)), checkpoint))
    return split.read(spark).select("FLIGHT_NUMBER", "batch_id", "late", F.col("event_ts").cast("timestamp_ntz").alias("event_ts"))


# The airline that the first version lacks, and the part before which the second one is published.
NEW_AIRLINE, PUBLISHED_BEFORE = "C3", 2


def q_stream_dimension_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with the airline's name; a missing airline is published in mid-stream and has its name from then on."""
    airlines = airline_dimension(testdata.airlines_raw(spark, sf_dir))
    dimension, out = VersionedDimension(scratch_path(spark, "airlines-versions")), scratch_path(spark, "named")
    checkpoint, started = scratch_path(spark, "named-ckpt"), []

    def attach(rows: DataFrame, names: DataFrame) -> DataFrame:
        return rows.join(guarded_dimension(names, "AIRLINE_CODE"), F.col("AIRLINE") == F.col("AIRLINE_CODE"), "left").drop("AIRLINE_CODE")

    def run(flights: DataFrame) -> DataStreamWriter:
        if not started:
            dimension.publish(airlines.where(F.col("AIRLINE_CODE") != NEW_AIRLINE))
        if len(started) == PUBLISHED_BEFORE:
            dimension.publish(airlines)
        started.append(1)
        rows = stream_rows(flights).select("FLIGHT_NUMBER", "AIRLINE")
        return rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(named_batch_writer(dimension, out, attach))

    arriving_flights(spark, sf_dir, run)
    return spark.read.parquet(out).drop("stream", "batch_id")


def q_stream_planned_actual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planned departures joined to actual ones, both streams; the last part also brings the first one's files again, too late."""
    out, checkpoint = scratch_path(spark, "departures"), scratch_path(spark, "departures-ckpt")
    sides = [(f"{scratch_path(spark, 'departures-in')}", parts(rows)) for rows in testdata.departures(spark, sf_dir)]
    for i in range(testdata.STREAM_PARTS):
        for base, dealt in sides:
            dealt[i].write.parquet(f"{base}/part_{i}")
            if i == testdata.STREAM_PARTS - 1:
                dealt[0].write.parquet(f"{base}/again")
        planned, actual = (spark.readStream.schema(dealt[0].schema).parquet(f"{base}/*") for base, dealt in sides)
        to_the_end(to_files(match_departures(planned, actual), out, checkpoint))
    return spark.read.parquet(out).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("planned_ts", "actual_ts")})


QUERIES = {
    "stream_planned_actual": q_stream_planned_actual,
    "stream_sessions": q_stream_sessions,
    "stream_running_delay": q_stream_running_delay,
    "stream_late_rows": q_stream_late_rows,
    "stream_dimension_refresh": q_stream_dimension_refresh,
}


_DEALT = f""",
dealt as ({testdata.duckdb_sql(testdata.DEALT_SQL)}),
in_time as (select * from dealt where not too_late)"""
#: What the watermark has passed when a finite stream ends.
_PASSED = f"(select max(event_ts) from s_features) - interval {WATERMARK_DELAY}"
_GAP, _EXPIRY = f"interval {SESSION_GAP}", f"interval {EXPIRY_MINUTES} minutes"

ORACLE = {
    "stream_sessions": O.with_stream(f"""
select AIRLINE, min(event_ts) as session_start, max(event_ts) + {_GAP} as session_end, {O.metric_list(ALL_METRICS)}
from (select *, count(*) filter (starts) over (partition by AIRLINE order by event_ts, FLIGHT_NUMBER) as session
      from (select *, event_ts - lag(event_ts) over (partition by AIRLINE order by event_ts, FLIGHT_NUMBER) > {_GAP} is distinct from false as starts from s_features))
group by AIRLINE, session having session_end <= {_PASSED}""", ALL_METRICS, source="in_time", extra=_DEALT),
    "stream_running_delay": O.with_stream(f"""
select AIRLINE, FLIGHT_NUMBER, event_ts, count(*) over so_far as run_flights, avg(DEPARTURE_DELAY) over so_far as run_avg_delay
from (select *, count(*) filter (starts) over (partition by AIRLINE order by event_ts, FLIGHT_NUMBER) as run
      from (select *, event_ts - lag(event_ts) over (partition by AIRLINE order by event_ts, FLIGHT_NUMBER) > {_EXPIRY} is distinct from false as starts from s_features))
where event_ts <= {_PASSED}
window so_far as (partition by AIRLINE, run order by event_ts, FLIGHT_NUMBER rows unbounded preceding)""", ALL_METRICS, source="in_time", extra=_DEALT),
    "stream_late_rows": f"""
with f as (select FLIGHT_NUMBER, delivered, {testdata._EVENT_TS} as event_ts from ({testdata.duckdb_sql(testdata.DEALT_SQL)})),
seen as (select delivered, max(max(event_ts)) over (order by delivered rows between unbounded preceding and 1 preceding) as greatest from f group by delivered)
select FLIGHT_NUMBER, cast(delivered as bigint) as batch_id, coalesce(event_ts <= greatest - interval {WATERMARK_DELAY}, false) as late, event_ts
from f join seen using (delivered)""",
    "stream_dimension_refresh": O.with_stream(f"""
select FLIGHT_NUMBER, AIRLINE, case when AIRLINE <> '{NEW_AIRLINE}' or delivered >= {PUBLISHED_BEFORE} then AIRLINE_NAME end as AIRLINE_NAME,
  cast(case when delivered >= {PUBLISHED_BEFORE} then 1 else 0 end as bigint) as dimension_version
from s_features""", ALL_METRICS, source="dealt", extra=_DEALT),
    "stream_planned_actual": f"""
with p as ({testdata.duckdb_sql(testdata.PLANNED_SQL)}), a as ({testdata.duckdb_sql(testdata.ACTUAL_SQL)}),
passed as (select least((select max(planned_ts) from p), (select max(actual_ts) from a)) - interval {WATERMARK_DELAY} as t)
select p.TAIL_NUMBER, p.FLIGHT_NUMBER, p.planned_ts, a.ACTUAL_FLIGHT, a.actual_ts
from p left join a on p.TAIL_NUMBER = a.TAIL_NUMBER and a.actual_ts between p.planned_ts - interval {EARLY} and p.planned_ts + interval {LATE}
where a.TAIL_NUMBER is not null or p.planned_ts + interval {LATE} < (select t from passed)""",
}
