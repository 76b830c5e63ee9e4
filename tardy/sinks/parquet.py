"""Partitioned Parquet sinks for the silver and gold layers.

* A batch run replaces its layer: silver as a whole, and the batch part of gold
  (its own ``aggregation_type`` folder). A run that is meant for some dates only
  says so (``only_its_dates``) and replaces exactly the dates of its input; those
  of which no row is left are removed.
* Instead of a fixed ``repartition(4, FL_DATE)`` the rows are clustered by the
  partition columns with a REBALANCE hint: AQE sizes the write tasks, and a
  date holding a large share of the rows is split over several tasks instead of
  landing in one.
* Gold rows of the batch job and of the stream share one folder and one schema
  (batch rows have null window bounds). Stream rows carry the id of their
  streaming query and micro-batch in ``load_id``, so a replayed micro-batch
  overwrites its own partitions (exactly-once output from an at-least-once
  ``foreachBatch``) and never those of another stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tardy.operators.enrich import diagnostic_counts

SILVER_PARTITIONS = ["FL_DATE"]
GOLD_PARTITIONS = ["aggregation_type", "FL_DATE", "load_id"]
BATCH_LOAD_ID = "batch"
WINDOW_BOUNDS = ["window_start", "window_end"]
MAX_RECORDS_PER_FILE = 100_000


# Tasks that write one date of a micro-batch, at least.
STREAM_WRITERS = 4


def clustered(df: DataFrame, partition_cols: list[str], adaptive: bool = True, as_they_lie: bool = False) -> DataFrame:
    """Rows gathered by partition. ``adaptive``: REBALANCE hint (AQE sizes tasks and splits hot values).
    Stateful micro-batches run without AQE, where the hint is ignored; their output is hash-clustered
    instead, a date over as many tasks as the rows of the micro-batch's largest date ask for.
    ``as_they_lie``: not at all, for rows in few tasks (``in_few_tasks``) or gathered before."""
    if as_they_lie:
        return df
    cols = [F.col(c) for c in partition_cols]
    if adaptive:
        return df.hint("rebalance", *cols)
    return df.repartition(*cols, F.pmod(F.xxhash64("AIRLINE", "ORIGIN_AIRPORT"), F.lit(stream_writers(df))))


def in_few_tasks(batch: DataFrame) -> bool:
    """Whether a micro-batch lies in ``STREAM_WRITERS`` tasks at most, and a shuffle of it would have no more."""
    if int(batch.sparkSession.conf.get("spark.sql.shuffle.partitions")) > STREAM_WRITERS:
        return False
    return batch._jdf.queryExecution().toRdd().getNumPartitions() <= STREAM_WRITERS


def stream_writers(batch: DataFrame, rows_per_task: int = MAX_RECORDS_PER_FILE) -> int:
    """Tasks that write one date of a (persisted) micro-batch."""
    if batch.count() <= STREAM_WRITERS * rows_per_task:  # no date asks for more
        return STREAM_WRITERS
    most = batch.groupBy("FL_DATE").count().agg(F.max("count")).first()[0] or 0
    return max(STREAM_WRITERS, -(-most // rows_per_task))


NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def _folder(partition_cols: list[str]) -> Column:
    """The folder of a row's partition, relative to the table's."""
    return F.concat_ws("/", *(F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit(NULL_PARTITION))) for c in partition_cols))


def _partitioned_overwrite(df: DataFrame, path: str, partition_cols: list[str],
                           max_records_per_file: int = MAX_RECORDS_PER_FILE, adaptive: bool = True,
                           replace_all: bool = False, counts: list[Column] = (), as_they_lie: bool = False) -> dict:
    """Replaces the partitions that the rows have; ``replace_all``: then removes all others of ``path``.

    The rows are written beside the old ones and take their place when the write is complete (Spark's
    dynamic overwrite), so a write that fails loses nothing; a full overwrite would delete first.
    Returns ``counts`` (aggregates) and ``folders`` (a value per partition) as observed by the tasks that write;
    nothing is observed where neither is asked for."""
    rows = clustered(df, partition_cols, adaptive, as_they_lie)
    observed = Observation() if replace_all or counts else None
    if observed:
        rows = rows.observe(observed, *counts, F.collect_set(_folder(partition_cols)).alias("folders"))
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(*partition_cols)
        .parquet(path)
    )
    found = observed.get if observed else {}
    if replace_all:
        written = set(found["folders"])
        delete_folders(df.sparkSession, path, [f for f in _folders(df.sparkSession, path, len(partition_cols)) if f not in written])
    return found


def _files(spark: SparkSession, place: str) -> tuple:
    """(file system, path) as the cluster's storage sees them."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _folders(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Relative names of the partition folders, ``depth`` levels down."""
    names = [""]
    for _ in range(depth):
        found = []
        for name in names:
            fs, place = _files(spark, f"{path}/{name}" if name else path)
            found += [f"{name}/{f.getPath().getName()}".lstrip("/") for f in fs.listStatus(place)
                      if f.isDirectory() and "=" in f.getPath().getName()]
        names = found
    return names


def delete_folders(spark: SparkSession, path: str, names: list[str]) -> None:
    for name in names:
        fs, place = _files(spark, f"{path}/{name}")
        fs.delete(place, True)


def write_silver(enriched: DataFrame, path: str, only_its_dates: bool = False, as_they_lie: bool = False) -> dict:
    """Silver: enriched flights, one folder per FL_DATE. Replaces the layer, or with
    ``only_its_dates`` the dates that the rows have. ``as_they_lie``: the rows are gathered by date already. Returns the diagnostics' counts and the
    dates written (``yyyy-MM-dd``, a value per date)."""
    found = _partitioned_overwrite(enriched, path, SILVER_PARTITIONS, replace_all=not only_its_dates, counts=diagnostic_counts(), as_they_lie=as_they_lie)
    dates = [f.removeprefix("FL_DATE=") for f in found.pop("folders")]
    return found | {"dates": [d for d in dates if d != NULL_PARTITION]}


def drop_dates(spark: SparkSession, path: str, dates: list[str]) -> None:
    """Removes the FL_DATE folders of some dates (``yyyy-MM-dd``), where they exist."""
    delete_folders(spark, path, [f"FL_DATE={d}" for d in dates])


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def gold_layout(gold: DataFrame) -> DataFrame:
    """Gold rows in the layer's one schema: window bounds first (null in batch rows), the
    other columns by name, so a read needs the footer of one file only."""
    bounds = [F.col(c) if c in gold.columns else F.lit(None).cast("timestamp_ntz").alias(c) for c in WINDOW_BOUNDS]
    stamp = [] if "processed_at" in gold.columns else [F.current_timestamp().alias("processed_at")]
    rest = sorted(c for c in gold.columns if c not in (*WINDOW_BOUNDS, *GOLD_PARTITIONS))
    partitions = [c for c in GOLD_PARTITIONS if c in gold.columns]
    if gold.columns == [*WINDOW_BOUNDS, *rest, *partitions] and "processed_at" in rest:
        return gold  # laid out already
    return gold.select(*bounds, *rest, *stamp, *partitions)


def write_gold(gold: DataFrame, path: str, load_id: str = BATCH_LOAD_ID,
               adaptive: bool = True, as_they_lie: bool = False) -> None:
    """Gold rows (batch or one stream micro-batch) under (aggregation_type, FL_DATE, load_id);
    replaces the partitions that the rows have."""
    _partitioned_overwrite(gold_layout(gold).withColumn("load_id", F.lit(load_id)), path, GOLD_PARTITIONS,
                           adaptive=adaptive, as_they_lie=as_they_lie)


def replace_gold(gold: DataFrame, path: str, label: str, load_id: str = BATCH_LOAD_ID) -> None:
    """Replaces all gold rows of one ``aggregation_type``; those of others stay."""
    rows = gold_layout(gold.drop("aggregation_type")).withColumn("load_id", F.lit(load_id))
    _partitioned_overwrite(rows, f"{path}/aggregation_type={label}", GOLD_PARTITIONS[1:], replace_all=True)


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """All gold rows; stream rows carry window bounds, batch rows null there."""
    return spark.read.parquet(path)
