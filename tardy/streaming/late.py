"""A side output for late rows, from the same stream.

Spark drops what comes behind the watermark inside its stateful operators, and only counts it.
``LateSplit`` stands in front of them as a sink of micro-batches: each row goes to one table, in the partition
``late=false`` or ``late=true`` of its micro-batch. The rule is that of the stateful operators: a row is late in a
micro-batch if its time is at or before the greatest event time of all micro-batches before, less the delay. Every
input row is in exactly one of the two; a row without a time counts as on time.

A micro-batch is written in one pass (the greatest event time is observed while the rows are written). Its mark, the greatest
event time so far, is a row keyed by query and micro-batch like the rows themselves, so a
micro-batch that is run again after a failure finds the mark of the one before, decides alike
and replaces its own rows. After a restart the marks go on: they and the query's id live with the table and the checkpoint.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tardy.operators.aggregate import WATERMARK_DELAY
from tardy.streaming.pipeline import query_id

ROWS, MARKS = "rows", "marks"
_MARK = "stream string, batch_id long, greatest long"


@dataclass
class LateSplit:
    """Writes rows with ``time_col`` under ``path``: rows/ by stream, batch_id and late, marks/ beside it."""

    path: str
    time_col: str = "event_ts"
    watermark: str = WATERMARK_DELAY

    def _mark(self, spark: SparkSession, stream: str, batch_id: int) -> int | None:
        """Greatest event time (microseconds) up to a micro-batch, one row."""
        if batch_id < 0:
            return None
        place = f"{self.path}/{MARKS}/stream={stream}/batch_id={batch_id}"
        return spark.read.schema("greatest long").parquet(place).first()[0]

    def write(self, batch: DataFrame, batch_id: int) -> None:
        spark, stream = batch.sparkSession, query_id(batch)
        greatest = self._mark(spark, stream, batch_id - 1)
        micros = F.unix_micros(F.col(self.time_col).cast("timestamp"))
        late = F.lit(False)
        if greatest is not None:
            bound = F.timestamp_micros(F.lit(greatest)) - F.expr(f"interval {self.watermark}")
            late = F.coalesce(F.col(self.time_col).cast("timestamp") <= bound, F.lit(False))
        seen = Observation()
        marked = batch.withColumns({"stream": F.lit(stream), "batch_id": F.lit(batch_id).cast("long"), "late": late})
        self._replace(marked.observe(seen, F.max(micros).alias("greatest")), ROWS, "stream", "batch_id", "late")
        own = seen.get["greatest"]
        greatest = max((x for x in (greatest, own) if x is not None), default=None)
        self._replace(spark.createDataFrame([(stream, batch_id, greatest)], _MARK), MARKS, "stream", "batch_id")

    def _replace(self, rows: DataFrame, name: str, *by: str) -> None:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(f"{self.path}/{name}")

    def sink(self, rows: DataFrame, checkpoint: str) -> DataStreamWriter:
        return rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(self.write)

    def read(self, spark: SparkSession, late: bool | None = None) -> DataFrame:
        """The rows written so far: all, or one side."""
        rows = spark.read.parquet(f"{self.path}/{ROWS}")
        rows = rows.withColumns({"batch_id": F.col("batch_id").cast("long"), "late": F.col("late").cast("boolean")})
        return rows if late is None else rows.where(F.col("late") == late).drop("late")
