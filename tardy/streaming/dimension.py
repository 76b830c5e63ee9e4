"""A dimension that changes while a stream runs.

A dimension read once at the start of a query never changes for it. ``VersionedDimension`` is a
folder of whole versions, numbered in the order of publishing; a version counts once its write is complete.
Each micro-batch reads the newest version when it starts and notes its number under the query's and the micro-batch's
id before it writes anything, so a micro-batch that runs again uses the version that it used first,
and a code published in mid-stream has its name from the next micro-batch on.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tardy.streaming.pipeline import query_id



@dataclass
class VersionedDimension:
    path: str

    def versions(self, spark: SparkSession) -> list[int]:
        """Numbers of the complete versions: one folder each."""
        fs, top = self._files(spark, f"{self.path}/versions")
        if not fs.exists(top):
            return []
        folders = [f.getPath() for f in fs.listStatus(top)]
        done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        return sorted(int(f.getName().split("=")[1]) for f in folders if fs.exists(done(f, "_SUCCESS")))

    @staticmethod
    def _files(spark: SparkSession, place: str) -> tuple:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place)
        return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path

    def publish(self, rows: DataFrame) -> int:
        """Writes the whole dimension as the next version (one publisher at a time)."""
        number = max(self.versions(rows.sparkSession), default=-1) + 1
        rows.write.mode("overwrite").parquet(f"{self.path}/versions/version={number}")
        return number

    def read(self, spark: SparkSession, version: int) -> DataFrame:
        return spark.read.parquet(f"{self.path}/versions/version={version}")

    def of_batch(self, batch: DataFrame, batch_id: int) -> tuple[int, DataFrame]:
        """(version, rows) for a micro-batch: the noted version, else the newest one, noted now."""
        spark, stream = batch.sparkSession, query_id(batch)
        note = f"{self.path}/notes/stream={stream}/batch_id={batch_id}"
        fs, place = self._files(spark, f"{note}/_SUCCESS")
        if fs.exists(place):
            version = spark.read.schema("version long").parquet(note).first()[0]
        else:
            version = max(self.versions(spark))
            spark.createDataFrame([(version,)], "version long").write.mode("overwrite").parquet(note)
        return version, self.read(spark, version)


def named_batch_writer(dimension: VersionedDimension, path: str, attach: Callable[[DataFrame, DataFrame], DataFrame]):
    """foreachBatch body: rows with the names of the micro-batch's version of the dimension, and the version, by
    stream and batch_id (a replay replaces its own)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        version, rows = dimension.of_batch(batch, batch_id)
        named = attach(batch, rows).withColumns({"dimension_version": F.lit(version).cast("long"), "stream": F.lit(query_id(batch)), "batch_id": F.lit(batch_id).cast("long")})
        named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("stream", "batch_id").parquet(path)

    return write
