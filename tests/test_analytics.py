"""Versions by time, exact percentiles, sketches, coarser grains, tables and dimension versions."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tardy.operators import percentiles
from tardy.operators.intervals import as_of, valid_at
from tardy.plans import batch
from tardy.session import scratch_path
from tardy.sinks import parquet as sinks
from tardy.sinks import table
from tardy.streaming.dimension import VersionedDimension, named_batch_writer


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def day(n: int) -> dt.date:
    return dt.date(2020, 1, 1) + dt.timedelta(days=n)


FACTS, VERSIONS = "id int, code string, on date", "version_code string, name string, valid_from date, valid_to date"


def test_versions_valid_at(spark):
    r = random.Random(1)
    versions = [(c, f"{c}{i}", None if i == 0 else day(20 * i), None if i == 5 else day(20 * i + r.randint(0, 30))) for c in "abc" for i in range(6)]
    versions += [(None, "x", None, None), ("d", "never", day(5), day(5)), ("a", "backwards", day(9), day(3))]
    facts = [(i, r.choice(["a", "a", "a", "b", "c", "d", None]), None if i % 50 == 0 else day(r.randint(-10, 140))) for i in range(400)]
    want = []
    for i, c, t in facts:
        found = [n for vc, n, a, b in versions if c is not None and vc == c and t is not None and (a is None or a <= t) and (b is None or t < b)]
        want += [(i, c, t, n) for n in found or [None]]
    f, v = spark.createDataFrame(facts, FACTS), spark.createDataFrame(versions, VERSIONS)
    for seconds in (86_400, 7 * 86_400, 10**9):
        got = valid_at(f, v, "code", "on", "version_code", bucket_seconds=seconds).select("id", "code", "on", "name")
        assert rows_of(got) == sorted(want, key=str)
    assert valid_at(f.limit(0), v, "code", "on", "version_code").count() == 0


def test_versions_as_of(spark):
    v = spark.createDataFrame([("a", "one", day(10)), ("a", "two", day(20)), ("b", "b", day(0))], "version_code string, name string, valid_from date")
    f = spark.createDataFrame([(i, "a", day(i)) for i in (5, 10, 19, 20, 99)], FACTS)
    assert [r[-1] for r in rows_of(as_of(f, v, "code", "on", "version_code").select("id", "name").orderBy("id"))] == ["one", "one", "two", None, "two"]


def test_the_join_is_no_nested_loop(spark):
    """Not even without broadcasts: an equality of code and bucket; a hot code has a key per bucket."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        f = spark.range(5000).selectExpr("cast(id as int) as id", "'a' as code", "date '2020-01-01' + cast(id % 140 as int) as on")
        v = spark.createDataFrame([("a", "one", day(0), day(200))], VERSIONS)
        joined = valid_at(f, v, "code", "on", "version_code")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
        assert joined.where("name = 'one'").count() == 5000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("n", [1, 2, 19, 4000])
def test_exact_percentiles(spark, n):
    r = random.Random(n)
    values = [("hot" if i % 3 else r.choice(["a", None]), None if i % 17 == 5 else float(r.choice([r.randint(0, 9), r.randint(0, 100_000)]))) for i in range(n)]
    asked = [0.0, 0.1, 0.5, 0.95, 1.0]
    want = []
    for key in {k for k, _ in values}:
        own = sorted(v for k, v in values if k == key and v is not None)
        want += [(key, q, next(v for i, v in enumerate(own) if i + 1 >= q * len(own))) for q in asked if own]
    df = spark.createDataFrame(values, "key string, v double").repartition(4)
    assert rows_of(percentiles.exact_percentiles(df, ["key"], "v", asked)) == sorted(want, key=str)


def test_a_hot_key_is_counted_in_many_tasks(spark):
    df = spark.range(50_000).selectExpr("'hot' as key", "cast(id * 7919 % 50000 as double) as v")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # it would join such small stretches
    try:
        counts = df.groupBy("key", "v").count().repartitionByRange("key", "v").groupBy(F.spark_partition_id()).count()
        assert counts.count() >= 4
        assert rows_of(percentiles.exact_percentiles(df, ["key"], "v", [0.1, 0.5])) == [("hot", 0.1, 4_999.0), ("hot", 0.5, 24_999.0)]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert rows_of(percentiles.exact_percentiles(df, ["key"], "v", [0.5])) == [("hot", 0.5, 24_999.0)]


def test_sketches_merge_without_the_facts(spark):
    r = random.Random(2)
    rows = [(day(i % 60), r.choice("ab"), r.gauss(0, 100), f"T{i % 3000}") for i in range(24_000)] + [(day(1), "c", None, None)]
    df = spark.createDataFrame(rows, "on date, airline string, delay double, tail string")
    path = scratch_path(spark, "sketches")
    percentiles.day_sketches(df, ["on", "airline"], "delay", "tail").write.parquet(path)
    whole = percentiles.merged_sketches(spark.read.parquet(path), [F.lit(1).alias("all")])
    delays = sorted(d for _, _, d, _ in rows if d is not None)
    for q in percentiles.sketch_quantiles(whole, [0.01, 0.5, 0.99]).collect():
        rank = sum(d <= q["value"] for d in delays) / len(delays)
        assert abs(rank - q["quantile"]) < 0.02 and abs(q["num_aircraft"] - 3000) < 150 and q["num_rows"] == 24_000


def test_grains_come_from_one_scan(spark):
    from tardy.operators.aggregate import gold_grains

    gold = batch.gold(batch.testdata_inputs(spark, SF_SMALL))
    path = scratch_path(spark, "gold")
    gold.write.parquet(path)
    grains = gold_grains(spark.read.parquet(path), [["FL_DATE"], ["AIRLINE"], []])
    plan = grains._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1 and "Expand" in plan
    totals = {r["grain"]: r["n"] for r in grains.groupBy("grain").agg(F.sum("num_flights").alias("n")).collect()}
    assert len(totals) == 3 and len(set(totals.values())) == 1


# ---------------------------------------------------------------- table, dates, counts beside the write

def test_table_holds_each_row_once(spark):
    name, place = "gold_probe", scratch_path(spark, "table")
    row = spark.sql("select date '2015-01-01' as FL_DATE, 'A' as AIRLINE, 'N' as ORIGIN_AIRPORT, 4L as num_flights, 'daily_batch' as aggregation_type")
    stream = row.withColumn("aggregation_type", F.lit("stream"))
    try:
        for _ in range(2):
            table.replace_gold_rows(row, name, "daily_batch", location=place)
            table.insert_gold(stream, name, "q-1", location=place)
        table.insert_gold(stream, name, "q-2", adaptive=False, location=place)
        got = rows_of(spark.table(name).select("aggregation_type", "load_id", "num_flights"))
        assert got == [("daily_batch", "batch", 4), ("stream", "q-1", 4), ("stream", "q-2", 4)]
        table.replace_gold_rows(row.withColumn("FL_DATE", F.lit(day(1))), name, "daily_batch")
        assert spark.table(name).where("aggregation_type = 'daily_batch'").count() == 1
        table.empty_dates(spark, name, "daily_batch", ["2020-01-02", "2031-01-01"])
        assert spark.table(name).where("aggregation_type = 'daily_batch'").count() == 0 and spark.table(name).count() == 2
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_silver_counts_are_taken_while_it_is_written(spark, monkeypatch):
    """The report equals the aggregate over silver, and no aggregate is run for it."""
    from tardy.sinks import audit

    inputs = batch.testdata_inputs(spark, SF_SMALL)
    want = audit.enrichment_diagnostics(batch.enriched(inputs)).first().asDict()

    def never(*_):
        raise AssertionError("silver read again for the counts")

    monkeypatch.setattr(audit, "enrichment_diagnostics", never)
    log = scratch_path(spark, "log")
    assert batch.run_batch(spark, inputs, scratch_path(spark, "silver"), scratch_path(spark, "gold"), log_path=log) == want
    assert spark.read.text(log).first()[0] == f"total_rows={want['total_rows']}"


def test_a_write_that_fails_loses_nothing(spark):
    """Rows of the run before stay until the new ones are complete; then nothing of the old is left."""
    row = "date '2015-01-01' + cast(id % {n} as int) as FL_DATE, 'A' as AIRLINE, 'N' as ORIGIN_AIRPORT, cast({m} as long) as num_flights"
    broken = F.expr("case when num_flights = 2 and day(FL_DATE) = 2 then raise_error('broken row') else num_flights end").cast("long")
    old, new = (spark.range(0, 60, 1, 4).selectExpr(*row.format(n=n, m=m).split(", ")) for n, m in ((5, 1), (3, 2)))
    names = [c.alias(n) for c, n in ((F.lit("x"), "ORIGIN_AIRPORT_NAME"), (F.lit("y"), "DEST_AIRPORT_NAME"))]
    silver, gold = scratch_path(spark, "silver"), scratch_path(spark, "gold")
    writes = {silver: lambda rows: sinks.write_silver(rows.select("*", *names), silver),
              f"{gold}/aggregation_type=daily_batch": lambda rows: sinks.replace_gold(rows, gold, "daily_batch")}
    for path, write in writes.items():
        write(old)
        with pytest.raises(Exception, match="broken row"):
            write(new.withColumn("num_flights", broken))
        assert spark.read.parquet(path).groupBy("num_flights").count().collect() == [(1, 60)]
        write(new)
        got = spark.read.parquet(path)
        assert got.select("FL_DATE").distinct().count() == 3 and got.groupBy("num_flights").count().collect() == [(2, 60)]


def test_writers_of_a_date_follow_its_rows(spark):
    rows = spark.range(1000).selectExpr("case when id < 900 then date '2015-01-01' else date '2015-01-02' end as FL_DATE")
    assert sinks.stream_writers(rows, rows_per_task=100) == 9
    assert sinks.stream_writers(rows) == sinks.stream_writers(rows.limit(0)) == sinks.STREAM_WRITERS


# ---------------------------------------------------------------- dimension versions

def test_a_replayed_micro_batch_keeps_its_version(spark):
    schema, folder = "code string", scratch_path(spark, "codes")
    dimension, out, checkpoint = VersionedDimension(scratch_path(spark, "dim")), scratch_path(spark, "named"), scratch_path(spark, "ckpt")
    names = lambda *pairs: spark.createDataFrame(list(pairs), "dim_code string, name string")
    attach = lambda rows, dim: rows.join(dim, F.col("code") == F.col("dim_code"), "left").drop("dim_code")
    fails = []

    def writer(batch_rows, batch_id):
        named_batch_writer(dimension, out, attach)(batch_rows, batch_id)
        if batch_id == 1 and not fails:
            fails.append(1)
            raise RuntimeError("after the write")

    def run(code):
        if code:
            spark.createDataFrame([(code,)], schema).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(schema).parquet(folder)
        stream.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()

    assert dimension.publish(names(("A", "old"))) == 0
    run("A")
    assert dimension.publish(names(("A", "new"), ("B", "b"))) == 1
    with pytest.raises(Exception, match="after the write"):
        run("A")
    dimension.publish(names(("A", "newest")))
    run(None)  # the same micro-batch again: with version 1
    run("B")
    got = rows_of(spark.read.parquet(out).select("batch_id", "code", "name", "dimension_version"))
    assert got == [(0, "A", "old", 0), (1, "A", "new", 1), (2, "B", None, 2)]
