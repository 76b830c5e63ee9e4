"""Query catalogue: one Spark callable (spark, sf_dir) -> DataFrame per operator,
and the DuckDB SQL that states the same result (see ``plans.oracle``).

Every query reads the shared test tables in full (through the fixture adapters
in ``sources.testdata``); queries that exercise sinks or streams write to a
fresh folder under the session's checkpoint directory and return a batch read
of what was written.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tardy.functions.clock import add_event_time
from tardy.functions.codes import airline_dimension, airport_dimension, normalize_flight_codes
from tardy.functions.metrics import METRIC_GROUPS, PERCENTILE_ACCURACY
from tardy.operators.chunks import export_chunks
from tardy.operators.clean import apply_quality_filters, rejection_report
from tardy.operators.enrich import (
    enrichment_diagnostics,
    unmatched_code_counts,
    unmatched_code_examples,
)
from tardy.operators.sample import sample_exact_n
from tardy.plans import analytics, batch, streams
from tardy.plans import oracle as O
from tardy.schema import FLIGHT_SCHEMA
from tardy.session import plan_settings, scratch_path
from tardy.sinks import parquet as sinks
from tardy.sinks.audit import enrichment_log_lines, write_lines
from tardy.sources import testdata
from tardy.sources.csv import (
    conform,
    read_dimension_csv,
    read_flights_csv,
    read_flights_stream,
    write_csv,
)
from tardy.streaming.pipeline import StreamJob, latest_window_values, replay_chunks, stream_features

Query = Callable[[SparkSession, str], DataFrame]

FIXTURE_COLUMNS = [
    "YEAR", "MONTH", "DAY", "DAY_OF_WEEK", "AIRLINE", "FLIGHT_NUMBER", "TAIL_NUMBER",
    "ORIGIN_AIRPORT", "DESTINATION_AIRPORT", "SCHEDULED_DEPARTURE", "DEPARTURE_DELAY",
    "AIR_TIME", "DISTANCE", "DIVERTED", "CANCELLED", "SRC_LINE", "SRC_PART", "SRC_SUPP",
    "SRC_PRICE",
]
DIM_COLUMNS = [
    "AIRLINE_CODE", "AIRLINE_NAME", "ORIGIN_AIRPORT_CODE", "ORIGIN_AIRPORT_NAME", "ORIGIN_CITY",
    "ORIGIN_STATE", "DEST_AIRPORT_CODE", "DEST_AIRPORT_NAME", "DEST_CITY", "DEST_STATE",
]
FEATURE_COLUMNS = ["is_delayed", "is_on_time", "delay_category", "is_weekend", "is_rush_hour",
                   "time_of_day", "season"]

# The FL_DATE range read by the partition-pruning query.
# Codes of unmatched_codes_many that no airport has.
STRANGE_CODE = "concat('Z', cast(SRC_PART % 400 as string))"
# Last month of the second run of silver_rerun; quantiles of percentile_rank_error.
RERUN_MONTH = 5
# Months of the dates that silver_rerun_dates runs again.
RERUN_DATES = (3, 4)
RANKS = (0.05, 0.25, 0.5, 0.75, 0.9, 0.95)
PRUNE_FROM, PRUNE_TO = "2015-04-01", "2015-06-30"


# ---------------------------------------------------------------- batch stages

def q_gold_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch.gold(batch.testdata_inputs(spark, sf_dir))


def _agg_group(group: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return batch.gold(batch.testdata_inputs(spark, sf_dir), METRIC_GROUPS[group], label=None)
    run.__name__ = f"q_agg_{group}"
    return run


def q_normalize_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_flight_codes(testdata.flights(spark, sf_dir))


def q_quality_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_quality_filters(normalize_flight_codes(testdata.flights(spark, sf_dir)))


def q_rejection_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejection_report(normalize_flight_codes(testdata.flights(spark, sf_dir)))


def q_dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch.cleaned(batch.testdata_inputs(spark, sf_dir))


def q_enrich_left_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch.enriched(batch.testdata_inputs(spark, sf_dir))


def q_enrichment_diagnostics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrichment_diagnostics(batch.enriched(batch.testdata_inputs(spark, sf_dir)))


def q_enrich_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unmatched_code_counts(batch.enriched(batch.testdata_inputs(spark, sf_dir)))


def q_unmatched_codes_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unmatched_code_examples(batch.enriched(batch.testdata_inputs(spark, sf_dir)), 50)


def q_unmatched_codes_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with far more unmatched codes on one side than are shown."""
    rows = batch.enriched(batch.testdata_inputs(spark, sf_dir))
    strange = F.col("SRC_LINE") > 3
    return unmatched_code_examples(rows.withColumns({
        "DESTINATION_AIRPORT": F.when(strange, F.expr(STRANGE_CODE)).otherwise(F.col("DESTINATION_AIRPORT")),
        "DEST_AIRPORT_NAME": F.when(~strange, F.col("DEST_AIRPORT_NAME"))}), 50)


def q_derive_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch.features(batch.testdata_inputs(spark, sf_dir))


def q_event_time_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    flights = normalize_flight_codes(testdata.flights(spark, sf_dir))
    return add_event_time(flights).select(
        *testdata.FLIGHTS_ROW_KEY, "YEAR", "MONTH", "DAY", "SCHEDULED_DEPARTURE",
        F.col("event_ts").cast("timestamp_ntz").alias("event_ts"),
    )


# ---------------------------------------------------------------- sources / sinks

def q_csv_fact_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "flights-csv")
    write_csv(conform(testdata.flights(spark, sf_dir), FLIGHT_SCHEMA), path)
    return read_flights_csv(spark, path)


def q_dim_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "airports-csv")
    write_csv(testdata.airports_raw(spark, sf_dir), path)
    return airport_dimension(read_dimension_csv(spark, path))


def q_dim_scan_airlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "airlines-csv")
    write_csv(testdata.airlines_raw(spark, sf_dir), path)
    return airline_dimension(read_dimension_csv(spark, path))


def q_silver_partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "silver")
    sinks.write_silver(batch.enriched(batch.testdata_inputs(spark, sf_dir)), path)
    return sinks.read_silver(spark, path)


def q_gold_partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver, gold = scratch_path(spark, "silver"), scratch_path(spark, "gold")
    batch.run_batch(spark, batch.testdata_inputs(spark, sf_dir), silver, gold)
    return sinks.read_gold(spark, gold).drop("processed_at", "load_id", *sinks.WINDOW_BOUNDS)


def q_warehouse_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch job's second target, written twice (a rerun replaces it) and read back."""
    silver, gold, warehouse = (scratch_path(spark, n) for n in ("silver", "gold", "warehouse"))
    inputs = batch.testdata_inputs(spark, sf_dir)
    for _ in range(2):
        batch.run_batch(spark, inputs, silver, gold, warehouse_path=warehouse)
    return sinks.read_gold(spark, warehouse).drop("processed_at", "load_id", *sinks.WINDOW_BOUNDS)


def q_silver_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch job on all rows, then on the rows up to RERUN_MONTH into the same
    folders: rows of silver and flights of gold per date are those of the second run."""
    silver, gold = scratch_path(spark, "silver"), scratch_path(spark, "gold")
    inputs = batch.testdata_inputs(spark, sf_dir)
    batch.run_batch(spark, inputs, silver, gold)
    part = batch.Inputs(inputs.flights.where(F.col("MONTH") <= RERUN_MONTH), inputs.airlines, inputs.airports)
    batch.run_batch(spark, part, silver, gold)
    rows = sinks.read_silver(spark, silver).groupBy("FL_DATE").agg(F.count(F.lit(1)).alias("silver_rows"))
    flights = sinks.read_gold(spark, gold).groupBy("FL_DATE").agg(F.sum("num_flights").alias("gold_flights"))
    return rows.join(flights, "FL_DATE", "full")


def _rerun_part(flights: DataFrame) -> DataFrame:
    """The rows of two months as a later delivery has them: one month thinned, the other all cancelled."""
    second = flights.where(F.col("MONTH").isin(*RERUN_DATES) & ((F.col("MONTH") != RERUN_DATES[0]) | (F.col("SRC_LINE") <= 3)))
    return second.withColumn("CANCELLED", F.when(F.col("MONTH") == RERUN_DATES[1], 1).otherwise(F.col("CANCELLED")))


def q_silver_rerun_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch job on all rows, then over the dates of two months only: these are replaced, or
    gone where no row is left, the others stay; in silver, gold and the warehouse table alike."""
    silver, gold, table = scratch_path(spark, "silver"), scratch_path(spark, "gold"), _fresh_table()
    inputs = batch.testdata_inputs(spark, sf_dir)
    targets = {"warehouse_table": table, "warehouse_location": scratch_path(spark, "warehouse")}
    batch.run_batch(spark, inputs, silver, gold, **targets)
    part = batch.Inputs(_rerun_part(inputs.flights), inputs.airlines, inputs.airports)
    batch.run_batch(spark, part, silver, gold, only_its_dates=True, **targets)
    rows = sinks.read_silver(spark, silver).groupBy("FL_DATE").agg(F.count(F.lit(1)).alias("silver_rows"))
    flights = sinks.read_gold(spark, gold).groupBy("FL_DATE").agg(F.sum("num_flights").alias("gold_flights"))
    stored = spark.table(table).groupBy("FL_DATE").agg(F.sum("num_flights").alias("table_flights"))
    return rows.join(flights, "FL_DATE", "full").join(stored, "FL_DATE", "full")


def _fresh_table() -> str:
    return f"gold_{uuid.uuid4().hex[:12]}"


def q_stream_warehouse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch and stream gold in one table of the catalogue, the batch job run twice: each
    row once."""
    target = {"warehouse_table": _fresh_table(), "warehouse_location": scratch_path(spark, "warehouse")}
    inputs = batch.testdata_inputs(spark, sf_dir)
    for _ in range(2):
        batch.run_batch(spark, inputs, scratch_path(spark, "silver"), scratch_path(spark, "gold"), **target)
    _run_stream(spark, sf_dir, **target)
    return spark.table(target["warehouse_table"]).drop("processed_at", "load_id")


def q_flights_per_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per flight date; FL_DATE leaves as a DATE here."""
    return batch.enriched(batch.testdata_inputs(spark, sf_dir)).groupBy("FL_DATE").agg(F.count(F.lit(1)).alias("num_rows"))


def q_percentile_rank_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The percentile sketch on large groups: whether each value's rank lies within the
    sketch's bound (1 / accuracy, plus ties) of the asked one."""
    rows = apply_quality_filters(normalize_flight_codes(testdata.flights(spark, sf_dir))).select(
        (F.col("SRC_LINE") % 2).alias("half"), F.col("DEPARTURE_DELAY").alias("delay"))
    asked = F.array(*map(F.lit, RANKS))
    sketch = rows.groupBy("half").agg(F.percentile_approx("delay", list(RANKS), PERCENTILE_ACCURACY).alias("p"))
    sketch = sketch.select("half", F.posexplode("p").alias("i", "value")).withColumn("quantile", F.element_at(asked, F.col("i") + 1))
    # Ranks from counts per distinct value.
    counts = rows.groupBy("half", "delay").agg(F.count(F.lit(1)).alias("n"))
    ranked = sketch.join(counts, "half").groupBy("half", "quantile", "value").agg(
        F.sum("n").alias("total"), F.sum(F.when(F.col("delay") < F.col("value"), F.col("n")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("delay") <= F.col("value"), F.col("n")).otherwise(0)).alias("upto"))
    slack = F.col("total") / PERCENTILE_ACCURACY + 1
    within = (F.col("below") - slack <= F.col("quantile") * F.col("total")) & (F.col("upto") + slack >= F.col("quantile") * F.col("total"))
    return ranked.select("half", "quantile", F.col("total").alias("num_rows"), within.alias("within_bound"))


def q_partition_pruned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "silver")
    sinks.write_silver(batch.enriched(batch.testdata_inputs(spark, sf_dir)), path)
    return (
        sinks.read_silver(spark, path)
        .filter(F.col("FL_DATE").between(F.lit(PRUNE_FROM).cast("date"), F.lit(PRUNE_TO).cast("date")))
        .select("FL_DATE", *testdata.FLIGHTS_ROW_KEY, "ORIGIN_AIRPORT", "DEPARTURE_DELAY")
    )


# ---------------------------------------------------------------- windows

def q_gold_window_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch.stream_window_gold(batch.testdata_inputs(spark, sf_dir, stream=True))


def _stream_input(spark: SparkSession, sf_dir: str) -> str:
    """Write the stream fixture as CSV files (the job's input format) to a fresh folder."""
    path = scratch_path(spark, "stream-in")
    with plan_settings(spark):
        write_csv(conform(testdata.flights_stream(spark, sf_dir), FLIGHT_SCHEMA), path)
    return path


def _run_stream(spark: SparkSession, sf_dir: str, **paths: str) -> StreamJob:
    """Replay the whole stream fixture through the streaming job (availableNow)."""
    inputs = batch.testdata_inputs(spark, sf_dir, stream=True)
    job = StreamJob(input_dir=_stream_input(spark, sf_dir),
                    checkpoint=scratch_path(spark, "stream-ckpt"),
                    max_files_per_trigger=None, **paths)
    job.run_available(spark, inputs.airlines, inputs.airports)
    return job


def q_gold_window_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream fixture as files in event order, a part per micro-batch, with a restart after
    each; the last part also brings the rows of the first again, all too late."""
    dealt = testdata.flights_stream_dealt(spark, sf_dir).withColumn("delivered", F.col("part"))
    parts = streams.parts(conform(dealt, streams.DEALT_SCHEMA))
    inputs = batch.testdata_inputs(spark, sf_dir, stream=True)
    base = scratch_path(spark, "stream-in")
    job = StreamJob(input_dir=f"{base}/*", checkpoint=scratch_path(spark, "stream-ckpt"),
                    gold_path=scratch_path(spark, "gold"), max_files_per_trigger=None)
    for i, part in enumerate(parts):
        again = [parts[0]] if i == len(parts) - 1 else []
        for j, rows in enumerate([part, *again]):
            write_csv(rows, f"{base}/part_{i}_{j}")
        job.run_available(spark, inputs.airlines, inputs.airports)
    return sinks.read_gold(spark, job.gold_path).drop("processed_at", "load_id")


def q_gold_two_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams with checkpoints of their own, each with half of the flights, into one
    gold folder: all rows of both."""
    inputs = batch.testdata_inputs(spark, sf_dir, stream=True)
    rows = conform(testdata.flights_stream(spark, sf_dir), FLIGHT_SCHEMA)
    gold = scratch_path(spark, "gold")
    for half in range(2):
        path = scratch_path(spark, "stream-in")
        write_csv(rows.where(F.col("FLIGHT_NUMBER").cast("long") % 2 == half), path)
        StreamJob(input_dir=path, checkpoint=scratch_path(spark, "stream-ckpt"), gold_path=gold,
                  max_files_per_trigger=None).run_available(spark, inputs.airlines, inputs.airports)
    return sinks.read_gold(spark, gold).drop("processed_at", "load_id")


def q_stream_two_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed windows (gold) and the last value of every window (update log) from one job."""
    job = _run_stream(spark, sf_dir, gold_path=scratch_path(spark, "gold"), update_log_path=scratch_path(spark, "updates"))
    closed = sinks.read_gold(spark, job.gold_path).drop("processed_at", "load_id").withColumn("view", F.lit("closed"))
    latest = latest_window_values(spark.read.parquet(job.update_log_path)).withColumn("view", F.lit("latest"))
    return closed.unionByName(latest)


def q_window_update_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = _run_stream(spark, sf_dir, update_log_path=scratch_path(spark, "updates"))
    return latest_window_values(spark.read.parquet(job.update_log_path))


def q_gold_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch and stream gold rows in one folder, read back as one table."""
    gold = scratch_path(spark, "gold")
    batch.run_batch(spark, batch.testdata_inputs(spark, sf_dir), scratch_path(spark, "silver"), gold)
    _run_stream(spark, sf_dir, gold_path=gold)
    return sinks.read_gold(spark, gold).drop("processed_at", "load_id")


# ---------------------------------------------------------------- dataset preparation

# Sample size (the sampler's default) and seed. Rows per chunk file.
SAMPLE_N, SAMPLE_SEED = 50_000, 42
CHUNK_ROWS = 3_000
# State partitions of a replay: a micro-batch has one chunk's rows, three windows each.
REPLAY_STATE_PARTITIONS = 2


# Columns that many flights share, one of them with nulls, and the rows sampled of them.
REPEATED, REPEATED_N = ["MONTH", "AIRLINE", "DAY_OF_WEEK"], 2_500


def stream_order() -> list:
    """Event order of the stream fixture (flight number breaks ties)."""
    return ["YEAR", "MONTH", "DAY", "SCHEDULED_DEPARTURE", F.col("FLIGHT_NUMBER").cast("long")]


def q_sample_exact_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact-n sample of the flights fact, written as gzip CSV and read back."""
    flights = testdata.flights(spark, sf_dir)
    sample = sample_exact_n(flights, SAMPLE_N, testdata.FLIGHTS_ROW_KEY, SAMPLE_SEED)
    path = scratch_path(spark, "sample-csv")
    write_csv(sample, path, compression="gzip")
    return read_flights_csv(spark, path, schema=flights.schema)


def q_sample_repeated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact-n sample of rows that repeat (a few hundred different ones), counted by value."""
    rows = testdata.flights(spark, sf_dir).select(*REPEATED)
    sample = sample_exact_n(rows, REPEATED_N, REPEATED, SAMPLE_SEED, copies=True)
    return sample.groupBy(*REPEATED).agg(F.count(F.lit(1)).alias("num_rows"))


def q_chunk_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream fixture split into CSV chunks of CHUNK_ROWS rows in event order;
    per chunk: rows, first / last departure slot, checksum of flight numbers."""
    path = scratch_path(spark, "chunks")
    export_chunks(conform(testdata.flights_stream(spark, sf_dir), FLIGHT_SCHEMA), path,
                  CHUNK_ROWS, stream_order())
    slot = (F.col("YEAR").cast("long") * 100_000_000 + F.col("MONTH") * 1_000_000
            + F.col("DAY") * 10_000 + F.col("SCHEDULED_DEPARTURE"))
    return (
        read_flights_csv(spark, path)
        .groupBy(F.col("chunk_id").cast("long").alias("chunk_id"))
        .agg(F.count(F.lit(1)).alias("num_rows"), F.min(slot).alias("first_slot"),
             F.max(slot).alias("last_slot"),
             F.sum(F.col("FLIGHT_NUMBER").cast("long")).alias("flight_number_sum"))
    )


def q_replay_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export the stream fixture as chunks, replay them one by one (one chunk
    per micro-batch, in order) into the running stream, read the gold rows."""
    chunks = scratch_path(spark, "chunks")
    rows = conform(testdata.flights_stream(spark, sf_dir), FLIGHT_SCHEMA)
    export_chunks(rows, chunks, CHUNK_ROWS, stream_order())
    ids = range(-(-rows.count() // CHUNK_ROWS))
    inputs = batch.testdata_inputs(spark, sf_dir, stream=True)
    # One folder, listed by the driver; a glob over many is listed by a Spark job for each micro-batch.
    job = StreamJob(input_dir=scratch_path(spark, "replay-in"), checkpoint=scratch_path(spark, "replay-ckpt"),
                    gold_path=scratch_path(spark, "gold"), max_files_per_trigger=1, state_partitions=REPLAY_STATE_PARTITIONS,
                    archive_dir=scratch_path(spark, "replay-done"))
    replay_chunks(spark, chunks, ids, job, inputs.airlines, inputs.airports)
    return sinks.read_gold(spark, job.gold_path).drop("processed_at", "load_id")


def q_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream form of the dedup (dropDuplicatesWithinWatermark) over the whole
    stream fixture with every seventh event delivered twice; the surviving rows are written by a Parquet file sink."""
    inputs = batch.testdata_inputs(spark, sf_dir, stream=True)
    out = scratch_path(spark, "stream-dedup")
    path = scratch_path(spark, "stream-in")
    write_csv(conform(testdata.flights_stream_repeated(spark, sf_dir), FLIGHT_SCHEMA), path)
    source = read_flights_stream(spark, path, max_files_per_trigger=None)
    rows = stream_features(source, inputs.airlines, inputs.airports, dedup_within="30 minutes")
    q = (
        rows.select(*testdata.STREAM_ROW_KEY, "FL_DATE", "AIRLINE", "ORIGIN_AIRPORT",
                    "DEPARTURE_DELAY", F.col("event_ts").cast("timestamp_ntz").alias("event_ts"))
        .writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", scratch_path(spark, "stream-dedup-ckpt"))
        .trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return spark.read.parquet(out)


def q_enrichment_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enrichment diagnostic as text lines (counts + up to 50 codes per side)."""
    path = scratch_path(spark, "enrichment-log")
    write_lines(enrichment_log_lines(batch.enriched(batch.testdata_inputs(spark, sf_dir))), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


QUERIES: dict[str, Query] = {
    "gold_daily": q_gold_daily,
    **{f"agg_{g}": _agg_group(g) for g in
       ["core", "percentiles", "rates", "severity", "time_patterns", "operational"]},
    "normalize_codes": q_normalize_codes,
    "quality_filters": q_quality_filters,
    "rejection_report": q_rejection_report,
    "dedup_first": q_dedup_first,
    "enrich_left_joins": q_enrich_left_joins,
    "enrichment_diagnostics": q_enrichment_diagnostics,
    "enrich_unmatched": q_enrich_unmatched,
    "unmatched_codes_topk": q_unmatched_codes_topk,
    "unmatched_codes_many": q_unmatched_codes_many,
    "derive_features": q_derive_features,
    "event_time_parse": q_event_time_parse,
    "csv_fact_scan": q_csv_fact_scan,
    "dim_scan": q_dim_scan,
    "dim_scan_airlines": q_dim_scan_airlines,
    "silver_partitioned_roundtrip": q_silver_partitioned_roundtrip,
    "gold_partitioned_roundtrip": q_gold_partitioned_roundtrip,
    "partition_pruned_scan": q_partition_pruned_scan,
    "warehouse_roundtrip": q_warehouse_roundtrip,
    "silver_rerun": q_silver_rerun,
    "silver_rerun_dates": q_silver_rerun_dates,
    "stream_warehouse": q_stream_warehouse,
    "flights_per_date": q_flights_per_date,
    "percentile_rank_error": q_percentile_rank_error,
    "gold_window_batch": q_gold_window_batch,
    "gold_two_streams": q_gold_two_streams,
    "stream_two_views": q_stream_two_views,
    "sample_repeated_rows": q_sample_repeated_rows,
    "gold_window_stream": q_gold_window_stream,
    "window_update_mode": q_window_update_mode,
    "gold_unified": q_gold_unified,
    "sample_exact_n": q_sample_exact_n,
    "chunk_export": q_chunk_export,
    "replay_chunks": q_replay_chunks,
    "stream_dedup": q_stream_dedup,
    "enrichment_log": q_enrichment_log,
    **streams.QUERIES,
    **analytics.QUERIES,
}


# ---------------------------------------------------------------- oracle SQL

_FIX = ", ".join(FIXTURE_COLUMNS)
_ROW_KEY = ", ".join(testdata.FLIGHTS_ROW_KEY)


def _sample_order(keys: list[str], copy: str | None = None) -> str:
    """The hash that orders the sample's rows: length and text of each key, '-' for null; then the copy number, if any."""
    parts = [f"coalesce(length(cast({k} as varchar)) || ':' || cast({k} as varchar), '-')" for k in keys]
    parts += [f"cast({copy} as varchar)"] if copy else []
    return f"md5(concat_ws('|', '{SAMPLE_SEED}', {', '.join(parts)}))"


ORACLE: dict[str, str] = {
    "gold_daily": O.daily_gold_sql(METRIC_GROUPS["all"]),
    **{f"agg_{g}": O.daily_gold_sql(METRIC_GROUPS[g], label=False) for g in
       ["core", "percentiles", "rates", "severity", "time_patterns", "operational"]},
    "normalize_codes": O.with_batch(f"select {_FIX} from normalized"),
    "quality_filters": O.with_batch(f"select {_FIX} from clean"),
    "rejection_report": O.with_batch("""
select count(*) as total_rows,
  count_if(not coalesce(CANCELLED = 0, false)) as rejected_cancelled,
  count_if(coalesce(CANCELLED = 0, false) and not coalesce(DIVERTED = 0, false)) as rejected_diverted,
  count_if(CANCELLED = 0 and DIVERTED = 0 and AIRLINE is null) as rejected_missing_airline,
  count_if(CANCELLED = 0 and DIVERTED = 0 and AIRLINE is not null and ORIGIN_AIRPORT is null)
    as rejected_missing_origin,
  count_if(CANCELLED = 0 and DIVERTED = 0 and AIRLINE is not null and ORIGIN_AIRPORT is not null
    and DESTINATION_AIRPORT is null) as rejected_missing_destination,
  count_if(CANCELLED = 0 and DIVERTED = 0 and AIRLINE is not null and ORIGIN_AIRPORT is not null
    and DESTINATION_AIRPORT is not null and DEPARTURE_DELAY is null) as rejected_missing_delay,
  count_if(CANCELLED = 0 and DIVERTED = 0 and AIRLINE is not null and ORIGIN_AIRPORT is not null
    and DESTINATION_AIRPORT is not null and DEPARTURE_DELAY <= -60) as rejected_delay_too_low,
  count_if(CANCELLED = 0 and DIVERTED = 0 and AIRLINE is not null and ORIGIN_AIRPORT is not null
    and DESTINATION_AIRPORT is not null and DEPARTURE_DELAY > -60 and DEPARTURE_DELAY >= 1000)
    as rejected_delay_too_high,
  count_if(CANCELLED = 0 and DIVERTED = 0 and AIRLINE is not null and ORIGIN_AIRPORT is not null
    and DESTINATION_AIRPORT is not null and DEPARTURE_DELAY > -60 and DEPARTURE_DELAY < 1000)
    as kept_rows
from normalized"""),
    "dedup_first": O.with_batch(f"select {_FIX} from dedup"),
    "enrich_left_joins": O.with_batch(f"select {_FIX}, {', '.join(DIM_COLUMNS)}, FL_DATE, DEP_HOUR from enriched"),
    "enrichment_diagnostics": O.with_batch("""
select count(*) as total_rows, count_if(ORIGIN_AIRPORT_NAME is null) as origin_missing,
  count_if(DEST_AIRPORT_NAME is null) as dest_missing
from enriched"""),
    "enrich_unmatched": O.with_batch("""
select 'origin' as side, ORIGIN_AIRPORT as code, count(*) as num_rows
from enriched where ORIGIN_AIRPORT_NAME is null group by all
union all
select 'destination' as side, DESTINATION_AIRPORT as code, count(*) as num_rows
from enriched where DEST_AIRPORT_NAME is null group by all"""),
    "unmatched_codes_topk": O.with_batch("""
select * from (select distinct 'origin' as side, ORIGIN_AIRPORT as code from enriched
               where ORIGIN_AIRPORT_NAME is null order by code nulls first limit 50)
union all
select * from (select distinct 'destination' as side, DESTINATION_AIRPORT as code from enriched
               where DEST_AIRPORT_NAME is null order by code nulls first limit 50)"""),
    "unmatched_codes_many": O.with_batch(f"""
select * from (select distinct 'origin' as side, ORIGIN_AIRPORT as code from enriched
               where ORIGIN_AIRPORT_NAME is null order by code nulls first limit 50)
union all
select * from (select distinct 'destination' as side, case when SRC_LINE > 3 then {STRANGE_CODE} else DESTINATION_AIRPORT end as code from enriched
               where SRC_LINE > 3 or DEST_AIRPORT_NAME is null order by code nulls first limit 50)"""),
    "derive_features": O.with_batch(
        f"select {_FIX}, {', '.join(DIM_COLUMNS)}, FL_DATE, DEP_HOUR, {', '.join(FEATURE_COLUMNS)} from features"),
    "event_time_parse": O.with_batch(f"""
select * from (
  select {_ROW_KEY}, YEAR, MONTH, DAY, SCHEDULED_DEPARTURE,
    try_strptime(printf('%04d-%02d-%02d %02d:%02d:00', YEAR, MONTH, DAY,
                        cast(trunc(SCHEDULED_DEPARTURE / 100) as int),
                        cast(SCHEDULED_DEPARTURE % 100 as int)), '%Y-%m-%d %H:%M:%S') as event_ts
  from normalized) where event_ts is not null"""),
    "csv_fact_scan": O.with_batch(O.conformed_flights_select("flights")),
    "dim_scan": O.with_batch("select * from airports"),
    "dim_scan_airlines": O.with_batch("select * from airlines"),
    "silver_partitioned_roundtrip": O.with_batch(
        f"select {_FIX}, {', '.join(DIM_COLUMNS)}, FL_DATE, DEP_HOUR from enriched"),
    "gold_partitioned_roundtrip": O.daily_gold_sql(METRIC_GROUPS["all"]),
    "partition_pruned_scan": O.with_batch(f"""
select FL_DATE, {_ROW_KEY}, ORIGIN_AIRPORT, DEPARTURE_DELAY from enriched
where FL_DATE between date '{PRUNE_FROM}' and date '{PRUNE_TO}'"""),
    "gold_window_batch": O.with_stream("select * from s_gold", METRIC_GROUPS["all"]),
    "gold_window_stream": O.with_stream(O.CLOSED_WINDOWS, METRIC_GROUPS["all"]),
    "window_update_mode": O.with_stream("select * from s_gold", METRIC_GROUPS["all"]),
    "gold_unified": O.with_batch_and_stream(
        f"select {O.GOLD_KEYS_SQL}, {', '.join(METRIC_GROUPS['all'])}, 'daily_batch' as aggregation_type\n"
        f"from (select {O.GOLD_KEYS_SQL}, {O.metric_list(METRIC_GROUPS['all'])} from features group by all)\n"
        f"union all by name ({O.CLOSED_WINDOWS})", METRIC_GROUPS["all"]),
    "sample_exact_n": O.with_batch(f"""
select * from flights
order by {_sample_order(testdata.FLIGHTS_ROW_KEY)}
limit {SAMPLE_N}"""),
    "sample_repeated_rows": O.with_batch(f"""
select {', '.join(REPEATED)}, count(*) as num_rows from (
  select * from (select {', '.join(REPEATED)}, row_number() over (partition by {', '.join(REPEATED)}) - 1 as nth from flights)
  order by {_sample_order(REPEATED, "nth")} limit {REPEATED_N})
group by all"""),
    "warehouse_roundtrip": O.daily_gold_sql(METRIC_GROUPS["all"]),
    "silver_rerun": O.with_batch(f"""
select FL_DATE, count(*) as silver_rows, count(*) as gold_flights from enriched where month(FL_DATE) <= {RERUN_MONTH} group by FL_DATE"""),
    "silver_rerun_dates": " union all ".join(f"(select * from ({sql}))" for sql in (
        O.with_batch(f"""
select FL_DATE, count(*) as silver_rows, count(*) as gold_flights, count(*) as table_flights
from enriched where month(FL_DATE) not in {RERUN_DATES} group by FL_DATE"""),
        O.with_batch("""
select FL_DATE, count(*) as silver_rows, count(*) as gold_flights, count(*) as table_flights from enriched group by FL_DATE""",
                     source="part", extra=f""",
part as (select * from flights where MONTH = {RERUN_DATES[0]} and SRC_LINE <= 3)"""))),
    "flights_per_date": O.with_batch("select FL_DATE, count(*) as num_rows from enriched group by FL_DATE"),
    "percentile_rank_error": O.with_batch(f"""
select SRC_LINE % 2 as half, quantile, count(*) as num_rows, true as within_bound
from clean, (select unnest([{', '.join(f'{q}::double' for q in RANKS)}]) as quantile) group by all"""),
    "gold_two_streams": " union all by name ".join(f"(select * from ({O.with_stream(O.CLOSED_WINDOWS, METRIC_GROUPS['all'], source='half', extra=f""",
half as (select * from flights_stream where cast(FLIGHT_NUMBER as bigint) % 2 = {i})""")}))" for i in range(2)),
    "stream_two_views": O.with_stream(
        f"select *, 'closed' as \"view\" from ({O.CLOSED_WINDOWS}) union all by name select *, 'latest' as \"view\" from s_gold", METRIC_GROUPS["all"]),
    "chunk_export": O.with_batch(f"""
select chunk_id, count(*) as num_rows, min(slot) as first_slot, max(slot) as last_slot,
  cast(sum(cast(FLIGHT_NUMBER as bigint)) as bigint) as flight_number_sum
from (select cast(YEAR as bigint) * 100000000 + MONTH * 1000000 + DAY * 10000 + SCHEDULED_DEPARTURE as slot,
        FLIGHT_NUMBER,
        (row_number() over (order by YEAR, MONTH, DAY, SCHEDULED_DEPARTURE, cast(FLIGHT_NUMBER as bigint)) - 1)
          // {CHUNK_ROWS} as chunk_id
      from flights_stream)
group by chunk_id"""),
    "replay_chunks": O.with_stream(O.CLOSED_WINDOWS, METRIC_GROUPS["all"]),
    "stream_dedup": O.with_stream(
        "select FLIGHT_NUMBER, FL_DATE, AIRLINE, ORIGIN_AIRPORT, DEPARTURE_DELAY, event_ts from ("
        "select *, row_number() over (partition by YEAR, MONTH, DAY, FLIGHT_NUMBER, TAIL_NUMBER, "
        "ORIGIN_AIRPORT, SCHEDULED_DEPARTURE order by event_ts) as rn from s_features) where rn = 1",
        METRIC_GROUPS["all"]),
    "enrichment_log": O.with_batch("""
select 'total_rows=' || count(*) as line from enriched
union all select 'origin_missing=' || count_if(ORIGIN_AIRPORT_NAME is null) from enriched
union all select 'dest_missing=' || count_if(DEST_AIRPORT_NAME is null) from enriched
union all select 'origin_missing_examples:'
union all select 'dest_missing_examples:'
union all select coalesce(code, 'None') from (
  select distinct ORIGIN_AIRPORT as code from enriched where ORIGIN_AIRPORT_NAME is null
  order by code nulls first limit 50)
union all select coalesce(code, 'None') from (
  select distinct DESTINATION_AIRPORT as code from enriched where DEST_AIRPORT_NAME is null
  order by code nulls first limit 50)"""),
    **streams.ORACLE,
    **analytics.ORACLE,
}
# Both targets of the gold rows hold the same.
ORACLE["stream_warehouse"] = ORACLE["gold_unified"]


# Presentation of the catalogue's results: DATE columns leave as ISO-8601 text
# on both sides. Python clients map DATE differently (Spark: datetime.date,
# DuckDB/pandas: Timestamp at midnight), which would make equal values render
# differently; text compares exactly. The library's tables keep DATE.
DATE_TEXT_SPARK, DATE_TEXT_SQL = "yyyy-MM-dd", "%Y-%m-%d"
DATE_OUTPUTS = {  # queries whose result has FL_DATE (checked by tests/test_catalogue.py)
    "gold_daily", "agg_core", "agg_percentiles", "agg_rates", "agg_severity",
    "agg_time_patterns", "agg_operational", "enrich_left_joins", "derive_features",
    "silver_partitioned_roundtrip", "gold_partitioned_roundtrip", "partition_pruned_scan",
    "gold_window_batch", "gold_window_stream", "window_update_mode", "gold_unified",
    "replay_chunks", "stream_dedup", "warehouse_roundtrip", "silver_rerun", "gold_two_streams",
    "stream_two_views", "silver_rerun_dates", "stream_warehouse", *analytics.DATED,
}
# FL_DATE stays a DATE here.
DATE_KEPT = {"flights_per_date"}


def presented(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = query(spark, sf_dir)
        dates = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DateType)]
        return df.withColumns({c: F.date_format(c, DATE_TEXT_SPARK) for c in dates}) if dates else df
    run.__name__ = query.__name__
    return run


def queries() -> dict[str, Query]:
    return {name: q if name in DATE_KEPT else presented(q) for name, q in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, sql in ORACLE.items():
        if name not in QUERIES:
            continue
        sql = O.bigint_counts(sql)
        if name in DATE_OUTPUTS:
            sql = (f"select * replace (strftime(FL_DATE, '{DATE_TEXT_SQL}') as FL_DATE)\n"
                   f"from (\n{sql}\n) presented")
        out[name] = sql
    return out
