"""Gold as a partitioned table of the session's catalogue, filled by the batch job and the stream.

The table has the layout of the gold folder (``sinks.parquet.gold_layout``), so both targets hold the same rows.
A batch run replaces its ``aggregation_type`` as a whole (a static partition of the overwrite), or the
dates it has; a stream micro-batch replaces the partitions of its ``load_id``. A rerun or a replay
thus adds nothing, and other jobs' partitions stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tardy.sinks.parquet import BATCH_LOAD_ID, GOLD_PARTITIONS, clustered, gold_layout


@contextmanager
def overwriting(spark: SparkSession, mode: str) -> Iterator[None]:
    """The session's overwrite mode for a while (inserts into a table take it from there alone)."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, mode)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def table_rows(gold: DataFrame, load_id: str) -> DataFrame:
    return gold_layout(gold.withColumn("load_id", F.lit(load_id)))


def ensure_gold_table(rows: DataFrame, table: str, location: str | None = None) -> None:
    """Creates the table for such rows unless it exists; ``location`` makes it an external one."""
    spark = rows.sparkSession
    if spark.catalog.tableExists(table):
        return
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    place = "" if location is None else f" LOCATION '{location}'"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet PARTITIONED BY ({', '.join(GOLD_PARTITIONS)}){place}")


def insert_gold(gold: DataFrame, table: str, load_id: str = BATCH_LOAD_ID, adaptive: bool = True, location: str | None = None) -> None:
    """Replaces the partitions that the rows have."""
    rows = table_rows(gold, load_id)
    ensure_gold_table(rows, table, location)
    by_name = clustered(rows, GOLD_PARTITIONS, adaptive).select(*gold.sparkSession.table(table).columns)
    with overwriting(gold.sparkSession, "dynamic"):
        by_name.write.mode("overwrite").insertInto(table)


def replace_gold_rows(gold: DataFrame, table: str, label: str, load_id: str = BATCH_LOAD_ID, location: str | None = None) -> None:
    """Replaces all rows of one ``aggregation_type``; those of others stay."""
    spark = gold.sparkSession
    rows = table_rows(gold, load_id)
    ensure_gold_table(rows, table, location)
    columns = [c for c in spark.table(table).columns if c != "aggregation_type"]
    others = ", ".join(c for c in GOLD_PARTITIONS if c != "aggregation_type")
    with overwriting(spark, "static"):
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (aggregation_type = '{label}', {others}) SELECT {', '.join(f'`{c}`' for c in columns)} FROM {{rows}}",
                  rows=clustered(rows, GOLD_PARTITIONS))


def empty_dates(spark: SparkSession, table: str, label: str, dates: list[str], load_id: str = BATCH_LOAD_ID) -> None:
    """Overwrites the partitions of some dates (``yyyy-MM-dd``) of one ``aggregation_type`` with no rows."""
    fields = [f for f in spark.table(table).schema.fields if f.name not in GOLD_PARTITIONS]
    nothing = ", ".join(f"cast(null as {f.dataType.simpleString()}) as `{f.name}`" for f in fields)
    with overwriting(spark, "static"):
        for date in dates:
            spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (aggregation_type = '{label}', FL_DATE = '{date}', load_id = '{load_id}') SELECT {nothing} WHERE false")
