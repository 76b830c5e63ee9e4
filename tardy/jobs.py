"""Command-line jobs: the batch job, the stream job, the exact-n sampler and the
chunk splitter, with every path a parameter (nothing hard-coded) and no
resource settings (those belong to spark-submit).

    python -m tardy.jobs batch  --flights DIR --airlines CSV --airports CSV --silver DIR --gold DIR
    python -m tardy.jobs stream --input DIR --airlines CSV --airports CSV --gold DIR --checkpoint DIR
    python -m tardy.jobs sample --input CSV --output DIR --sample-size 50000 [--seed 7] [--compress]
    python -m tardy.jobs split  --input CSV --output-dir DIR --rows-per-file 50000 [--max-files 20]
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tardy.functions.codes import airline_dimension, airport_dimension
from tardy.operators.chunks import export_chunks
from tardy.operators.sample import sample_exact_n
from tardy.plans.batch import Inputs, run_batch
from tardy.session import LOCAL_CONF, materialize
from tardy.sources.csv import read_dimension_csv, read_flights_csv, write_csv
from tardy.streaming.pipeline import StreamJob


def _dimensions(spark: SparkSession, airlines: str, airports: str):
    return (airline_dimension(read_dimension_csv(spark, airlines)),
            airport_dimension(read_dimension_csv(spark, airports)))


def cmd_batch(spark: SparkSession, a: argparse.Namespace) -> dict:
    airlines, airports = _dimensions(spark, a.airlines, a.airports)
    inputs = Inputs(read_flights_csv(spark, a.flights), airlines, airports)
    return run_batch(spark, inputs, a.silver, a.gold, warehouse_path=a.warehouse,
                     log_path=a.log, audit_path=a.audit, only_its_dates=a.only_its_dates,
                     warehouse_table=a.warehouse_table)


def cmd_stream(spark: SparkSession, a: argparse.Namespace) -> dict:
    airlines, airports = _dimensions(spark, a.airlines, a.airports)
    job = StreamJob(input_dir=a.input, checkpoint=a.checkpoint, gold_path=a.gold,
                    warehouse_path=a.warehouse, warehouse_table=a.warehouse_table,
                    update_log_path=a.update_log, max_files_per_trigger=a.max_files_per_trigger,
                    available_now=a.available_now, processing_time=a.processing_time,
                    console_rows=a.console_rows, state_partitions=a.state_partitions)
    q = job.start(spark, airlines, airports)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return {"batches": len(q.recentProgress)}


def cmd_sample(spark: SparkSession, a: argparse.Namespace) -> dict:
    raw = spark.read.option("header", True).csv(a.input)  # every column as text
    sample = sample_exact_n(raw, a.sample_size, seed=a.seed)
    write_csv(sample, a.output, compression="gzip" if a.compress else None)
    return {"written": a.output}


def cmd_split(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Any columns; in the order of the files' own rows, or by ``--order`` with that as tie-breaker."""
    raw = spark.read.option("header", True).csv(a.input)
    place = ["_file", "_block", "_line"]
    placed = materialize(raw.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                                    F.monotonically_increasing_id().alias("_line")), "split-rows")
    order = [F.col(c) for c in (a.order.split(",") if a.order else [])] + place
    export_chunks(placed, a.output_dir, a.rows_per_file, order, a.max_files, drop=tuple(place))
    return {"written": a.output_dir}


def parser() -> argparse.ArgumentParser:
    # Option names and defaults of the sampler, the splitter and the stream.
    p = argparse.ArgumentParser(prog="tardy.jobs")
    sub = p.add_subparsers(dest="cmd", required=True)

    b = sub.add_parser("batch", help="raw flights -> silver -> gold")
    b.add_argument("--flights", required=True)
    b.add_argument("--airlines", required=True)
    b.add_argument("--airports", required=True)
    b.add_argument("--silver", required=True)
    b.add_argument("--gold", required=True)
    b.add_argument("--warehouse")
    b.add_argument("--log")
    b.add_argument("--audit")
    b.add_argument("--warehouse-table", help="table of the session's catalogue")
    b.add_argument("--only-its-dates", action="store_true", help="replace the dates of the input, not the whole layer")

    s = sub.add_parser("stream", help="CSV file stream -> sliding-window gold")
    s.add_argument("--input", required=True)
    s.add_argument("--airlines", required=True)
    s.add_argument("--airports", required=True)
    s.add_argument("--gold", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--warehouse")
    s.add_argument("--warehouse-table", help="table of the session's catalogue")
    s.add_argument("--update-log", help="folder of the changing windows")
    s.add_argument("--max-files-per-trigger", type=int, default=10)
    s.add_argument("--available-now", action="store_true")
    s.add_argument("--processing-time")
    s.add_argument("--console-rows", type=int, default=0)
    s.add_argument("--state-partitions", type=int)

    m = sub.add_parser("sample", help="exactly n uniformly chosen rows of a CSV")
    m.add_argument("--input", required=True)
    m.add_argument("--output", required=True)
    m.add_argument("--sample-size", type=int, default=50000)
    m.add_argument("--seed", type=int)
    m.add_argument("--compress", action="store_true")

    c = sub.add_parser("split", help="numbered CSV chunks of n rows for stream replay")
    c.add_argument("--input", required=True)
    c.add_argument("--output-dir", required=True)
    c.add_argument("--rows-per-file", type=int, default=50000)
    c.add_argument("--max-files", type=int)
    c.add_argument("--order", help="comma-separated order columns (default: the files' own order)")
    return p


COMMANDS = {"batch": cmd_batch, "stream": cmd_stream, "sample": cmd_sample, "split": cmd_split}


JOB_SETTINGS = {k for k in LOCAL_CONF if k.startswith(("spark.sql.codegen.", "spark.sql.objectHashAggregate.", "spark.sql.streaming.stateStore.", "spark.sql.streaming.sessionWindow."))}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = parser().parse_args(argv)
    session = spark or SparkSession.builder.appName(f"tardy-{args.cmd}").getOrCreate()
    for key, value in LOCAL_CONF.items():  # SQL settings that the plans were made for, where the cluster sets none
        if key in JOB_SETTINGS and key not in dict(session.sparkContext.getConf().getAll()):
            session.conf.set(key, value)
    result = COMMANDS[args.cmd](session, args)
    print(json.dumps(result, default=str))
    return result


if __name__ == "__main__":
    main(sys.argv[1:])
