"""The command-line jobs end to end on CSV inputs written from the small tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tardy import jobs
from tardy.schema import FLIGHT_SCHEMA
from tardy.session import scratch_path
from tardy.sinks import parquet as sinks
from tardy.sources import testdata
from tardy.sources.csv import conform, write_csv


def _csv_inputs(spark):
    paths = {n: scratch_path(spark, n) for n in ("flights", "airlines", "airports")}
    write_csv(conform(testdata.flights(spark, SF_SMALL), FLIGHT_SCHEMA), paths["flights"])
    write_csv(testdata.airlines_raw(spark, SF_SMALL).coalesce(1), paths["airlines"])
    write_csv(testdata.airports_raw(spark, SF_SMALL).coalesce(1), paths["airports"])
    return paths


def test_batch_job_cli(spark):
    p = _csv_inputs(spark)
    silver, gold = scratch_path(spark, "silver"), scratch_path(spark, "gold")
    diag = jobs.main(["batch", "--flights", p["flights"], "--airlines", p["airlines"],
                      "--airports", p["airports"], "--silver", silver, "--gold", gold], spark)
    assert diag["total_rows"] == sinks.read_silver(spark, silver).count() > 0
    g = sinks.read_gold(spark, gold)
    assert g.count() > 0 and g.agg(F.sum("num_flights")).first()[0] == diag["total_rows"]


def test_sample_and_split_cli(spark):
    p = _csv_inputs(spark)
    out = scratch_path(spark, "sample")
    jobs.main(["sample", "--input", p["flights"], "--output", out, "--sample-size", "500",
               "--seed", "7", "--compress"], spark)
    assert spark.read.option("header", True).csv(out).count() == 500
    chunks = scratch_path(spark, "chunks")
    jobs.main(["split", "--input", p["flights"], "--output-dir", chunks, "--rows-per-file", "1000",
               "--max-files", "3"], spark)
    counts = {r[0]: r[1] for r in spark.read.option("header", True).csv(chunks)
              .groupBy("chunk_id").count().collect()}
    assert counts == {0: 1000, 1: 1000, 2: 1000}


def test_stream_job_cli(spark):
    src = scratch_path(spark, "stream-in")
    write_csv(conform(testdata.flights_stream(spark, SF_SMALL), FLIGHT_SCHEMA), src)
    p = _csv_inputs(spark)
    gold = scratch_path(spark, "gold")
    jobs.main(["stream", "--input", src, "--airlines", p["airlines"], "--airports", p["airports"],
               "--gold", gold, "--checkpoint", scratch_path(spark, "ckpt"), "--available-now"], spark)
    assert sinks.read_gold(spark, gold).filter("aggregation_type = 'streaming_15min'").count() > 0


def test_batch_and_stream_jobs_run_under_their_plan_settings(spark, flights_df, tmp_path, monkeypatch):
    """A session that sets none of them has them while the jobs run, and none afterwards; what it sets itself stays."""
    from tardy.functions.codes import airline_dimension, airport_dimension
    from tardy.plans import batch
    from tardy.sinks import parquet as sinks
    from tardy.sources.csv import read_flights_csv, write_csv
    from tardy.streaming import pipeline

    limit, fallback = "spark.sql.codegen.hugeMethodLimit", "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"
    session = spark.newSession()
    session.conf.unset(limit)
    session.conf.set(fallback, "77")
    plain, seen = session.conf.get(limit), []
    write_silver = sinks.write_silver
    monkeypatch.setattr(sinks, "write_silver", lambda rows, *a: seen.append((session.conf.get(limit), session.conf.get(fallback))) or write_silver(rows, *a))
    flights = str(tmp_path / "flights")
    write_csv(flights_df([{"DAY": 5}, {"DAY": 6}]), flights)
    airlines = airline_dimension(session.createDataFrame([("AA", "A")], "IATA_CODE string, AIRLINE string"))
    airports = airport_dimension(session.createDataFrame([("N1", "N", "C", "S")], "IATA_CODE string, AIRPORT string, CITY string, STATE string"))
    batch.run_batch(session, batch.Inputs(read_flights_csv(session, flights), airlines, airports), str(tmp_path / "silver"), str(tmp_path / "gold"))
    assert seen == [("8000", "77")]
    assert (session.conf.get(limit), session.conf.get(fallback)) == (plain, "77")

    in_stream = []
    writer = pipeline.gold_batch_writer
    monkeypatch.setattr(pipeline, "gold_batch_writer", lambda *a: lambda rows, i: in_stream.append(rows.sparkSession.conf.get(limit)) or writer(*a)(rows, i))
    pipeline.StreamJob(input_dir=flights, checkpoint=str(tmp_path / "ckpt"), gold_path=str(tmp_path / "stream")).run_available(session, airlines, airports)
    assert set(in_stream) == {"8000"}
    assert session.conf.get(limit) == plain


def test_batch_run_holds_one_shuffle_of_the_rows_at_a_time(spark, tmp_path, monkeypatch):
    """No shuffle of the rows carries names, none is held when the statement has ended, and the stored rows are gone at the end;
    silver has one file a date at this size and the rows of the plain query."""
    import glob

    from tardy.plans import batch
    from tardy.session import SHUFFLE_CLEANUP, scratch_root

    inputs = batch.testdata_inputs(spark, SF_SMALL)
    want = batch.enriched(inputs)
    seen, write_silver = [], sinks.write_silver

    def noted(rows, *a, **k):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        seen.append((spark.conf.get(SHUFFLE_CLEANUP), -1 < plan.find("Join") < plan.find("RebalancePartitions"), "Window" in plan))
        return write_silver(rows, *a, **k)

    monkeypatch.setattr(sinks, "write_silver", noted)
    silver = str(tmp_path / "silver")
    for _ in range(2):
        batch.run_batch(spark, inputs, silver, str(tmp_path / "gold"))
    assert seen == [("true", True, False)] * 2 and SHUFFLE_CLEANUP not in spark.conf.getAll
    assert not glob.glob(f"{scratch_root(spark).removeprefix('file:')}/clean-*")
    got = sinks.read_silver(spark, silver).select(*want.columns)
    assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0
    assert all(len(glob.glob(f"{d}/*.parquet")) == 1 for d in glob.glob(f"{silver}/FL_DATE=*"))
