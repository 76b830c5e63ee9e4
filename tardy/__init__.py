"""tardy — trip-delay analytics as composable PySpark DataFrame operators.

Layout:
  sources/    CSV / Parquet / file-stream readers and the test-table adapters
  functions/  Column expressions: code normalisation, dates and clock times,
              business flags, the shared list of delay statistics
  operators/  DataFrame -> DataFrame steps: quality filters, dedup, enrichment,
              gold aggregation, sampling, chunk export
  sinks/      partitioned, idempotent Parquet writes
  streaming/  the file-stream job: watermark + sliding window + foreachBatch sink
  plans/      end-to-end batch plan and the query catalogue used by
              ``__spark_entry__``
"""

__version__ = "0.1.0"
