"""CSV readers (fact with declared schema, header-named dimensions, file stream)
and the matching CSV writer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tardy.schema import FLIGHT_SCHEMA


CORRUPT_COLUMN = "_corrupt_record"


def read_flights_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType = FLIGHT_SCHEMA,
    enforce_schema: bool = False,
    keep_corrupt: bool = False,
) -> DataFrame:
    """Fact CSV folder (or file, gzip by extension) with a header and a declared schema.

    ``enforceSchema=false`` makes Spark check header names against the schema,
    so a file whose columns are in another order fails instead of binding by
    position. Malformed fields (e.g. ``2354.0`` in an int column) become null
    and the row is kept; with ``keep_corrupt`` the raw line of such rows is
    kept in ``_corrupt_record`` so reports can count them.
    """
    if keep_corrupt:
        schema = T.StructType(schema.fields + [T.StructField(CORRUPT_COLUMN, T.StringType())])
    reader = (
        spark.read.option("header", True)
        .option("enforceSchema", enforce_schema)
        .option("mode", "PERMISSIVE")
        .schema(schema)
    )
    if keep_corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    return reader.csv(path)


def read_dimension_csv(spark: SparkSession, path: str) -> DataFrame:
    """Dimension CSV: header names, every column a string (no inference pass)."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


def read_flights_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType = FLIGHT_SCHEMA,
    max_files_per_trigger: int | None = 10,
    glob: str | None = None,
    archive: str | None = None,
) -> DataFrame:
    """Unbounded CSV file stream: each new file in ``folder`` is read once, then moved under ``archive`` if given."""
    reader = (
        spark.readStream.option("header", True)
        .option("enforceSchema", False)
        .schema(schema)
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.csv(folder)


def conform(df: DataFrame, schema: T.StructType = FLIGHT_SCHEMA) -> DataFrame:
    """Project ``df`` onto ``schema``: missing columns become typed nulls, extra ones drop."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def write_csv(df: DataFrame, path: str, mode: str = "error", compression: str | None = None,
              partition_by: list[str] | None = None) -> None:
    """CSV with header that keeps leading / trailing blanks (Spark trims them on write by default)."""
    writer = (
        df.write.mode(mode)
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )
    if compression:
        writer = writer.option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)
