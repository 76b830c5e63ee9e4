"""Text-log and audit sinks.

* The enrichment diagnostic is built as a small DataFrame of lines by Spark
  (counts from one aggregate, examples from a bounded top-k per side) and
  written as a text file, instead of collecting to the driver.
* ``guarded_write`` records the outcome of a write (ok / failed + traceback)
  as a row in an audit table, then re-raises a failure, so a broken silver or
  gold write can no longer pass silently.
"""

from __future__ import annotations

import traceback
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tardy.operators.enrich import enrichment_diagnostics, unmatched_code_examples


def enrichment_log_lines(enriched: DataFrame, examples: int = 50, counts: dict | None = None) -> DataFrame:
    """(line_no, line): total_rows=…, origin_missing=…, dest_missing=…, then the
    example codes of each side under a header line. ``counts``: known already, else computed."""
    # The texts of the log's lines.
    names = ["total_rows", "origin_missing", "dest_missing"]
    known = enrichment_diagnostics(enriched) if counts is None else enriched.sparkSession.createDataFrame(
        [tuple(counts[n] for n in names)], ", ".join(f"{n} long" for n in names))
    head = known.select(F.explode(F.array(*(
        F.struct(F.lit(i).alias("line_no"), F.concat(F.lit(f"{n}="), F.col(n).cast("string")).alias("line")) for i, n in enumerate(names)
    ))).alias("l")).select("l.*")
    spark = enriched.sparkSession
    headers = spark.createDataFrame(
        [(3, "origin_missing_examples:"), (1000 + examples, "dest_missing_examples:")],
        "line_no int, line string")
    codes = unmatched_code_examples(enriched, examples)
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy("side").orderBy(F.col("code").asc_nulls_first()))
    ex = codes.select(
        (F.when(F.col("side") == "origin", F.lit(3)).otherwise(F.lit(1000 + examples)) + rank).alias("line_no"),
        F.coalesce(F.col("code"), F.lit("None")).alias("line"),
    )
    return head.unionByName(headers).unionByName(ex)


def write_lines(lines: DataFrame, path: str) -> None:
    """One text file, lines in ``line_no`` order (the input is small and bounded)."""
    lines.repartition(1).sortWithinPartitions("line_no").select("line").write.mode("overwrite").text(path)


def guarded_write(spark: SparkSession, step: str, write: Callable[[], None], audit_path: str) -> None:
    """Run ``write``; append (step, status, error, at) to the audit table; re-raise on failure."""
    def note(error: str | None) -> None:
        spark.createDataFrame(
            [(step, "failed" if error else "ok", error)], "step string, status string, error string"
        ).withColumn("at", F.current_timestamp()).write.mode("append").parquet(audit_path)

    try:
        write()
    except Exception as failure:  # record, then raise; the cause stays even if recording fails
        try:
            note(traceback.format_exc())
        finally:
            raise RuntimeError(f"{step} write failed; see audit table {audit_path}\n{failure}") from failure
    note(None)
