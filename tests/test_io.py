"""Sources and sinks: CSV schema binding, round trips, idempotent partitioned writes."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tardy.plans import batch
from tardy.schema import FLIGHT_SCHEMA
from tardy.session import scratch_path
from tardy.sinks import parquet as sinks
from tardy.sources.csv import read_flights_csv, write_csv


def _write_text(spark, path, lines):
    spark.createDataFrame([(l,) for l in lines], "value string").coalesce(1).write.text(path)


def test_header_order_mismatch_fails(spark):
    names = [f.name for f in FLIGHT_SCHEMA.fields]
    swapped = names[:]
    swapped[0], swapped[1] = swapped[1], swapped[0]
    path = scratch_path(spark, "csv-swapped")
    _write_text(spark, path, [",".join(swapped), ",".join(["1"] * len(names))])
    with pytest.raises(Exception):
        read_flights_csv(spark, path).collect()


def test_malformed_int_becomes_null(spark):
    names = [f.name for f in FLIGHT_SCHEMA.fields]
    row = ["2015", "1", "5", "1", "AA", "12", "T1", "JFK", "LAX", "2354.0"] + [""] * (len(names) - 10)
    path = scratch_path(spark, "csv-malformed")
    _write_text(spark, path, [",".join(names), ",".join(row)])
    r = read_flights_csv(spark, path).first()
    assert r["SCHEDULED_DEPARTURE"] is None and r["YEAR"] == 2015 and r["AIRLINE"] == "AA"


def test_csv_round_trip_keeps_blanks(spark, flights_df):
    df = flights_df([{"AIRLINE": " c1 ", "ORIGIN_AIRPORT": " N3"}])
    path = scratch_path(spark, "csv-blanks")
    write_csv(df, path)
    r = read_flights_csv(spark, path).first()
    assert (r["AIRLINE"], r["ORIGIN_AIRPORT"]) == (" c1 ", " N3")


def test_silver_rerun_is_idempotent_and_pruned(spark):
    inputs = batch.testdata_inputs(spark, SF_SMALL)
    path = scratch_path(spark, "silver")
    enriched = batch.enriched(inputs)
    sinks.write_silver(enriched, path)
    n1 = sinks.read_silver(spark, path).count()
    sinks.write_silver(enriched, path)
    assert sinks.read_silver(spark, path).count() == n1 == enriched.count()
    pruned = sinks.read_silver(spark, path).filter(F.col("FL_DATE") == F.lit("2015-01-15").cast("date"))
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(FL_DATE" in plan


def test_gold_overwrite_keeps_other_producers(spark):
    inputs = batch.testdata_inputs(spark, SF_SMALL)
    silver, gold = scratch_path(spark, "silver"), scratch_path(spark, "gold")
    batch.run_batch(spark, inputs, silver, gold)
    one = sinks.read_gold(spark, gold).count()
    # a stream-like producer writes into the same folder under its own partitions
    sample = sinks.read_gold(spark, gold).limit(5).withColumn("aggregation_type", F.lit("streaming_15min"))
    extra = spark.createDataFrame(sample.collect(), sample.schema).drop("load_id")
    sinks.write_gold(extra, gold, load_id="s000000000000")
    batch.run_batch(spark, inputs, silver, gold)  # rerun: replaces only daily_batch partitions
    g = sinks.read_gold(spark, gold)
    assert g.filter("aggregation_type = 'daily_batch'").count() == one
    assert g.filter("aggregation_type = 'streaming_15min'").count() == 5


def test_write_and_read_plans_push_filters(spark):
    path = f"{SF_SMALL}/lineitem.parquet"
    df = spark.read.parquet(path).filter(F.col("l_quantity") > 10).select("l_orderkey")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,10.0)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_guarded_write_records_and_raises(spark):
    from tardy.sinks.audit import guarded_write

    audit = scratch_path(spark, "audit")
    guarded_write(spark, "ok-step", lambda: None, audit)

    def boom():
        raise OSError("disk full")

    with pytest.raises(RuntimeError, match="boom-step write failed"):
        guarded_write(spark, "boom-step", boom, audit)
    rows = {r["step"]: r for r in spark.read.parquet(audit).collect()}
    assert rows["ok-step"]["status"] == "ok" and rows["ok-step"]["error"] is None
    assert rows["boom-step"]["status"] == "failed" and "disk full" in rows["boom-step"]["error"]


def test_batch_job_writes_log_and_warehouse(spark):
    inputs = batch.testdata_inputs(spark, SF_SMALL)
    paths = {n: scratch_path(spark, n) for n in ("silver", "gold", "wh", "log", "audit")}
    diag = batch.run_batch(spark, inputs, paths["silver"], paths["gold"], warehouse_path=paths["wh"],
                           log_path=paths["log"], audit_path=paths["audit"])
    lines = [r[0] for r in spark.read.text(paths["log"]).collect()]
    assert lines[0] == f"total_rows={diag['total_rows']}"
    assert lines[3] == "origin_missing_examples:" and "dest_missing_examples:" in lines
    assert sinks.read_gold(spark, paths["wh"]).count() == sinks.read_gold(spark, paths["gold"]).count()
    assert {r[0] for r in spark.read.parquet(paths["audit"]).select("status").collect()} == {"ok"}


def test_gold_row_survives_a_second_write(spark):
    """A gold row without a date is written twice under one load id and read once."""
    row = spark.sql("select cast(null as date) as FL_DATE, 'Q7' as AIRLINE, 'N3' as ORIGIN_AIRPORT, 41L as num_flights, 'probe' as aggregation_type")
    path = scratch_path(spark, "gold-twice")
    for _ in range(2):
        sinks.write_gold(row, path, load_id="same")
    back = sinks.read_gold(spark, path).select("FL_DATE", "AIRLINE", "num_flights", "load_id").collect()
    assert [tuple(r) for r in back] == [(None, "Q7", 41, "same")]


def test_squares_parquet_write(spark):
    path = scratch_path(spark, "squares")
    spark.range(3, 12).selectExpr("id", "id * id as square").write.parquet(path)
    assert spark.read.parquet(path).where("square = id * id").agg(F.sum("square")).first()[0] == 3 * 3 + sum(i * i for i in range(4, 12))


def _files_per_leaf(path: str) -> dict[str, int]:
    import os

    out = {}
    for root, _dirs, files in os.walk(path.removeprefix("file:")):
        n = sum(1 for f in files if f.endswith(".parquet"))
        if n:
            out[root] = n
    return out


def test_partitioned_writes_are_clustered(spark):
    """Silver (AQE rebalance) writes one file per partition folder at this size, stream
    gold (hash clustering inside the stateful micro-batch, where AQE is off) one per
    writer of a date: not one per upstream task, and a date isn't one task's."""
    from tardy.plans import catalogue

    path = scratch_path(spark, "silver")
    sinks.write_silver(batch.enriched(batch.testdata_inputs(spark, SF_SMALL)), path)
    silver_files = _files_per_leaf(path)
    assert len(silver_files) >= 20 and max(silver_files.values()) == 1
    gold = catalogue._run_stream(spark, SF_SMALL, gold_path=scratch_path(spark, "gold")).gold_path
    gold_files = _files_per_leaf(gold)
    assert len(gold_files) >= 20 and 1 < max(gold_files.values()) <= sinks.STREAM_WRITERS


def test_malformed_rows_are_counted(spark):
    from tardy.functions.codes import normalize_flight_codes
    from tardy.operators.clean import rejection_report

    names = [f.name for f in FLIGHT_SCHEMA.fields]
    good = ["2015", "1", "5", "1", "AA", "12", "T1", "JFK", "LAX", "700"] + [""] * (len(names) - 10)
    bad = good[:9] + ["2354.0"] + good[10:]
    good[names.index("DEPARTURE_DELAY")] = bad[names.index("DEPARTURE_DELAY")] = "5.0"
    good[names.index("CANCELLED")] = bad[names.index("CANCELLED")] = "0"
    good[names.index("DIVERTED")] = bad[names.index("DIVERTED")] = "0"
    path = scratch_path(spark, "csv-corrupt")
    _write_text(spark, path, [",".join(names), ",".join(good), ",".join(bad)])
    df = read_flights_csv(spark, path, keep_corrupt=True).cache()
    r = rejection_report(normalize_flight_codes(df)).first().asDict()
    assert r["total_rows"] == 2 and r["kept_rows"] == 2 and r["malformed_rows"] == 1
