"""The file-stream job: CSV files -> same cleaning as batch (minus destination
rule and dedup) -> event time -> airline / origin enrichment -> flags ->
watermark + sliding window -> the 24 statistics -> gold.

One streaming query with one ``foreachBatch`` sink serves every target of closed
windows (gold Parquet, an optional warehouse path), so the source is read and the
window state kept once, not once per sink. The view of changing windows (update log,
console) has another output mode and is a second query with a checkpoint of its own.
``foreachBatch`` is at-least-once; every write is keyed by the streaming query's id and
the micro-batch id through dynamic partition overwrite, so a replayed batch replaces
its own rows instead of adding them again, and never those of another stream.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tardy.functions.clock import add_calendar_columns, add_event_time
from tardy.functions.codes import normalize_flight_codes
from tardy.functions.flags import add_flags
from tardy.operators.aggregate import CODE_KEYS, WATERMARK_DELAY, window_gold
from tardy.operators.clean import clean_flights, dedup_first
from tardy.operators.enrich import attach_names, enrich_flights, guarded_dimension
from tardy.schema import DEDUP_KEYS, GOLD_KEYS, STREAM_LABEL
from tardy.session import checkpoint_writer, plan_settings
from tardy.sinks import parquet as sinks
from tardy.sinks import table
from tardy.sources.csv import read_flights_stream

WINDOW_KEYS = ["window_start", "window_end", *GOLD_KEYS]


def stream_rows(flights: DataFrame, dedup_within: str | None = None, watermark: str | None = None) -> DataFrame:
    """Row pipeline of the stream job without the dimension joins; works on
    streaming and bounded frames.

    ``dedup_within`` (e.g. "30 minutes") turns on the stream form of the batch
    dedup: ``dropDuplicatesWithinWatermark`` on the dedup key. A stream has one
    watermark; it is set here, ``dedup_within`` if given, else ``watermark``."""
    clean = clean_flights(normalize_flight_codes(flights), require_destination=False, dedup=False)
    timed = add_event_time(clean)
    if dedup_within or watermark:
        timed = timed.withWatermark("event_ts", dedup_within or watermark)
    if dedup_within:
        timed = timed.dropDuplicatesWithinWatermark(DEDUP_KEYS)
    return add_flags(add_calendar_columns(timed))


def stream_features(flights: DataFrame, airlines: DataFrame, airports: DataFrame,
                    dedup_within: str | None = None) -> DataFrame:
    """Stream rows joined to the airline and origin dimensions (per row)."""
    rows = stream_rows(flights, dedup_within)
    return enrich_flights(rows, airlines, airports, with_destination=False)


def windowed_gold(features: DataFrame, watermark: str = WATERMARK_DELAY) -> DataFrame:
    """Window statistics of rows that already carry the names (7-column grain)."""
    return window_gold(features.withWatermark("event_ts", watermark))


def windowed_gold_by_code(rows: DataFrame, airlines: DataFrame, airports: DataFrame,
                          watermark: str | None = WATERMARK_DELAY) -> DataFrame:
    """Window statistics keyed by codes, names attached to the aggregated rows.
    ``watermark``: None if the rows have theirs already.

    Same output as ``windowed_gold(stream_features(...))``; the state keys hold
    codes only and the joins run once per emitted window row."""
    marked = rows.withWatermark("event_ts", watermark) if watermark else rows
    by_code = window_gold(marked, keys=CODE_KEYS, label=None)
    return attach_names(by_code, airlines, airports).withColumn("aggregation_type", F.lit(STREAM_LABEL))


def query_id(batch: DataFrame) -> str:
    """The id of the streaming query that runs this micro-batch. It is kept in the
    checkpoint: the same after a restart, another one for another checkpoint."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def gold_batch_writer(gold_path: str | None, warehouse_path: str | None = None,
                      warehouse_table: str | None = None, warehouse_location: str | None = None):
    """foreachBatch body for append mode: each closed window is written once
    per micro-batch, under load_id = <query id>-<batch id>, to every target."""

    def write(batch: DataFrame, batch_id: int) -> None:
        load_id = f"{query_id(batch)}-{batch_id:012d}"
        targets = [t for t in (gold_path, warehouse_path, warehouse_table) if t]
        few_tasks = sinks.in_few_tasks(batch)
        if "processed_at" not in batch.columns:
            batch = batch.withColumn("processed_at", F.current_timestamp())
        if targets == [gold_path] and few_tasks:  # read once: nothing to keep
            sinks.write_gold(batch, gold_path, load_id=load_id, as_they_lie=True)
            return
        # The targets and the count that sizes the writing tasks read the micro-batch once.
        rows = batch.persist()
        try:
            for path in filter(None, (gold_path, warehouse_path)):
                sinks.write_gold(rows, path, load_id=load_id, adaptive=False, as_they_lie=few_tasks)
            if warehouse_table:
                table.insert_gold(rows, warehouse_table, load_id, adaptive=False, location=warehouse_location)
        finally:
            rows.unpersist()

    return write


def update_writer(path: str | None, console_rows: int = 0):
    """foreachBatch body for update mode: changed windows per micro-batch, written
    partitioned by stream and batch_id (a replay overwrites its own partition);
    ``console_rows`` > 0 prints that many of them."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if console_rows > 0:
            print(f"-- micro-batch {batch_id}")
            batch.show(console_rows, truncate=True)
        if path:
            (
                batch.withColumn("stream", F.lit(query_id(batch))).withColumn("batch_id", F.lit(batch_id).cast("long"))
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("stream", "batch_id")
                .parquet(path)
            )

    return write


def latest_window_values(updates: DataFrame) -> DataFrame:
    """Last emitted value of every window x key from the update log of one stream."""
    return dedup_first(updates.drop("stream"), WINDOW_KEYS, [F.col("batch_id").desc()]).drop("batch_id")


class StreamRun:
    """The queries of a started job, handled as one: if one fails, all stop."""

    POLL_SECONDS = 0.5

    def __init__(self, queries: list[StreamingQuery], bounded: bool = True) -> None:
        self.queries = queries
        self.bounded = bounded

    @property
    def isActive(self) -> bool:
        return any(q.isActive for q in self.queries)

    def awaitTermination(self) -> None:
        """Returns when all queries have read what was there (``bounded``), else when the first
        one ends, whichever it is; the others are stopped then. A failure of any stops all and is raised."""
        running = list(self.queries)
        try:
            while running:
                for q in list(running):
                    if q.awaitTermination(self.POLL_SECONDS):
                        running.remove(q)
                        if not self.bounded:
                            return
        finally:
            if running:
                self.stop()

    def processAllAvailable(self) -> None:
        for q in self.queries:
            q.processAllAvailable()

    def stop(self) -> None:
        for q in self.queries:
            q.stop()

    def exception(self):
        return next((e for q in self.queries if (e := q.exception()) is not None), None)

    @property
    def recentProgress(self) -> list:
        return [p for q in self.queries for p in q.recentProgress]

    @property
    def lastProgress(self):
        """Of the first query; ``recentProgress`` has that of all."""
        return self.queries[0].lastProgress


@dataclass
class StreamJob:
    input_dir: str
    checkpoint: str
    gold_path: str | None = None
    warehouse_path: str | None = None
    warehouse_table: str | None = None
    warehouse_location: str | None = None
    update_log_path: str | None = None
    max_files_per_trigger: int | None = 10
    watermark: str = WATERMARK_DELAY
    available_now: bool = True
    processing_time: str | None = None
    dedup_within: str | None = None
    console_rows: int = 0
    input_glob: str | None = None
    # Where files go that have been read, so that the input folder's listing, made for each micro-batch, stays short.
    archive_dir: str | None = None
    # Stateful micro-batches run without AQE: the number of state partitions is
    # fixed when the checkpoint is created. None = the session's shuffle partitions.
    state_partitions: int | None = None

    def start(self, spark: SparkSession, airlines: DataFrame, airports: DataFrame) -> StreamRun:
        if self.state_partitions is None:
            with plan_settings(spark), checkpoint_writer(spark, self.checkpoint):  # a query keeps the settings that it starts with
                return self._start(spark, airlines, airports)
        key = "spark.sql.shuffle.partitions"
        previous = spark.conf.get(key)
        spark.conf.set(key, str(self.state_partitions))
        try:
            with plan_settings(spark), checkpoint_writer(spark, self.checkpoint):
                return self._start(spark, airlines, airports)
        finally:
            spark.conf.set(key, previous)

    def _start(self, spark: SparkSession, airlines: DataFrame, airports: DataFrame) -> StreamRun:
        source = read_flights_stream(spark, self.input_dir,
                                     max_files_per_trigger=self.max_files_per_trigger,
                                     glob=self.input_glob, archive=self.archive_dir)
        rows = stream_rows(source, self.dedup_within, self.watermark)
        gold = windowed_gold_by_code(rows, airlines, airports, watermark=None)
        outputs = []
        if self.gold_path or self.warehouse_path or self.warehouse_table:
            outputs.append(("append", self.checkpoint, gold_batch_writer(
                self.gold_path, self.warehouse_path, self.warehouse_table, self.warehouse_location)))
        if self.update_log_path or self.console_rows > 0:
            if self.dedup_within:
                raise ValueError("changing windows can't be shown behind a dedup: Spark runs it in append mode only")
            place = f"{self.checkpoint.rstrip('/')}-updates" if outputs else self.checkpoint
            outputs.append(("update", place, update_writer(self.update_log_path, self.console_rows)))
        if not outputs:
            raise ValueError("the job has no output: set gold_path, warehouse_path, warehouse_table, update_log_path or console_rows")
        run = StreamRun([], bounded=self.available_now)
        for mode, checkpoint, body in outputs:
            # The layer's layout is part of the query's plan, not made anew from Python for each micro-batch.
            emitted = sinks.gold_layout(gold.withColumn("processed_at", F.current_timestamp())) if mode == "append" else gold
            writer = emitted.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(body)
            if self.available_now:
                writer = writer.trigger(availableNow=True)
            elif self.processing_time:
                writer = writer.trigger(processingTime=self.processing_time)
            run.queries.append(writer.start())
        return run

    def run_available(self, spark: SparkSession, airlines: DataFrame, airports: DataFrame) -> None:
        """Process everything in the input folder, then stop (bounded replay)."""
        q = self.start(spark, airlines, airports)
        try:
            q.awaitTermination() if self.available_now else q.processAllAvailable()
        finally:
            if q.isActive:
                q.stop()
        if q.exception() is not None:
            raise RuntimeError(f"stream failed: {q.exception()}")


NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"


def replay_chunks(spark: SparkSession, chunks_path: str, chunk_ids: Iterable[int], job: StreamJob,
                  airlines: DataFrame, airports: DataFrame) -> None:
    """Timed replay of exported chunks: chunk i comes into the stream's input folder only after
    chunk i-1 has been processed, like files uploaded one by one.

    The chunks are copied beside the input folder by one Spark job and released by renaming, so a release
    costs no job. While chunks follow, the next one's micro-batch closes the windows that the last one's
    passed; the last chunk is run to its end, with the micro-batch without rows that closes the rest.

    Each micro-batch joins the dimensions, so those of their rows that the chunks match are kept for all."""
    from tardy.sources.csv import read_flights_csv, write_csv

    ids = list(chunk_ids)
    base = job.input_dir.rstrip("*").rstrip("/")
    staged = f"{base}-staged"
    chunks = read_flights_csv(spark, chunks_path).where(F.col("chunk_id").isin(ids))
    write_csv(chunks, staged, partition_by=["chunk_id"])
    codes = normalize_flight_codes(chunks)

    def matched(dimension: DataFrame, key: str, code: str) -> DataFrame:
        guarded_dimension(dimension, key)  # the keys of all its rows are checked
        return dimension.join(codes.select(F.col(code).alias(key)).distinct(), key, "left_semi").select(*dimension.columns).persist()

    airlines, airports = matched(airlines, "AIRLINE_CODE", "AIRLINE"), matched(airports, "AIRPORT_CODE", "ORIGIN_AIRPORT")
    try:
        _replay(spark, staged, base, ids, job, airlines, airports)
    finally:
        airlines.unpersist()
        airports.unpersist()


def _replay(spark: SparkSession, staged: str, base: str, ids: list[int], job: StreamJob,
            airlines: DataFrame, airports: DataFrame) -> None:
    fs, place = sinks._files(spark, base)
    fs.mkdirs(place)

    def release(i: int) -> None:
        _, folder = sinks._files(spark, f"{staged}/chunk_id={i}")
        for file in fs.listStatus(folder):
            if not fs.rename(file.getPath(), sinks._files(spark, f"{base}/chunk_{i:05d}-{file.getPath().getName()}")[1]):
                raise OSError(f"chunk {i} was not released")

    job.available_now = False
    before = spark.conf.get(NO_DATA)
    spark.conf.set(NO_DATA, "false")
    try:
        q = job.start(spark, airlines, airports)
    finally:
        spark.conf.set(NO_DATA, before)
    try:
        for i in ids[:-1]:
            release(i)
            q.processAllAvailable()
    finally:
        q.stop()
    if q.exception() is not None:
        raise RuntimeError(f"stream failed: {q.exception()}")
    for i in ids[-1:]:
        release(i)
    job.available_now = True
    job.run_available(spark, airlines, airports)
