"""Exact-n sampling and chunk export."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tardy.operators.chunks import assign_chunks, export_chunks
from tardy.operators.sample import COPY, below, numbered_copies, sample_exact_n
from tardy.plans import catalogue
from tardy.session import scratch_path
from tardy.sources import testdata
from tardy.sources.csv import read_flights_csv


def _keys(df):
    return sorted(tuple(r) for r in df.select(*testdata.FLIGHTS_ROW_KEY).collect())


def test_sample_exact_size_subset_and_reproducible(spark):
    flights = testdata.flights(spark, SF_SMALL)
    total = flights.count()
    s1 = sample_exact_n(flights, 1000, testdata.FLIGHTS_ROW_KEY, seed=7)
    assert s1.count() == 1000
    assert s1.subtract(flights).count() == 0
    s2 = sample_exact_n(flights.repartition(5), 1000, testdata.FLIGHTS_ROW_KEY, seed=7)
    assert _keys(s1) == _keys(s2)  # independent of partitioning
    s3 = sample_exact_n(flights, 1000, testdata.FLIGHTS_ROW_KEY, seed=8)
    assert _keys(s1) != _keys(s3)
    assert sample_exact_n(flights, total + 10, testdata.FLIGHTS_ROW_KEY).count() == total


def test_sample_widens_a_short_slice(spark):
    df = spark.range(300).withColumn("k", F.col("id").cast("string"))
    assert sample_exact_n(df, 299, ["k"], seed=1).count() == 299


def test_chunk_positions_follow_order(spark):
    df = spark.range(0, 5000, 1, 7).withColumn("v", (F.col("id") * 7919) % 5000)
    out = assign_chunks(df, 700, ["v"]).select("v", "row_index", "chunk_id").collect()
    assert sorted(r["row_index"] for r in out) == list(range(5000))
    assert all(r["row_index"] == r["v"] for r in out)  # v is a permutation of 0..4999
    sizes = {}
    for r in out:
        sizes[r["chunk_id"]] = sizes.get(r["chunk_id"], 0) + 1
    assert sizes == {**{i: 700 for i in range(7)}, 7: 100}


def test_chunk_export_caps_files(spark):
    stream = testdata.flights_stream(spark, SF_SMALL)
    path = scratch_path(spark, "chunks")
    export_chunks(stream, path, 100, ["YEAR", "MONTH", "DAY", "SCHEDULED_DEPARTURE",
                                      F.col("FLIGHT_NUMBER").cast("long")], max_chunks=3)
    back = spark.read.option("header", True).csv(path)
    counts = {r[0]: r[1] for r in back.groupBy("chunk_id").count().collect()}
    assert counts == {0: 100, 1: 100, 2: 100}


def test_sample_of_repeated_rows(spark):
    """Three values, two of them null somewhere, 1,000 rows: every row counts, none is taken as a block."""
    df = spark.range(1000).selectExpr("case when id % 3 = 0 then 'x' when id % 3 = 1 then null else 'y' end as a",
                                      "case when id % 3 = 1 then 'x' end as b")
    got = {(r["a"], r["b"]): r["n"] for r in sample_exact_n(df, 300, seed=5).groupBy("a", "b").agg(F.count("*").alias("n")).collect()}
    assert sum(got.values()) == 300 and len(got) == 3 and all(70 <= n <= 130 for n in got.values())
    assert _ids(sample_exact_n(spark.range(1000), 50, ["id"])) != _ids(sample_exact_n(spark.range(1000), 50, ["id"]))


def _ids(df):
    return sorted(r[0] for r in df.collect())


def test_sample_of_an_identity_that_rows_share(spark):
    """Still exactly n rows, each once."""
    df = spark.range(600).selectExpr("id % 4 as k", "id")
    for n in (100, 299):
        got = sample_exact_n(df, n, ["k"], seed=2)
        assert got.count() == n == got.select("id").distinct().count()


def test_sample_of_billions_of_equal_rows(spark):
    """More equal rows than an array holds, in two passes that keep next to nothing."""
    rows = spark.range(0, 2_200_000_000, 1, 8).select(F.lit("x").alias("v"))
    got = sample_exact_n(rows, 10, seed=1)
    assert [r["v"] for r in got.collect()] == ["x"] * 10


def test_sample_shuffles_none_of_the_input(spark):
    """The rows are cut in the scan: a narrow plan with the key's bound, and few rows behind it."""
    path = scratch_path(spark, "sample-input")
    spark.range(400_000).selectExpr("id", "id % 7 as k").write.parquet(path)
    rows = spark.read.parquet(path)
    for identity in (None, ["id"]):
        slice_ = below(rows, 0.01, 3, identity)
        plan = slice_._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Sort" not in plan and "Python" not in plan
        assert 3_500 < slice_.count() < 4_500


def test_sample_is_unbiased_by_place(spark):
    """Of 12 samples of 500 from 2,000 rows each row is in about a quarter."""
    df = spark.range(0, 2000, 1, 4)
    hits = [0] * 2000
    for seed in range(12):
        for r in sample_exact_n(df, 500, seed=seed).collect():
            hits[r["id"]] += 1
    assert sum(hits) == 6000 and max(hits) <= 12
    quarters = [sum(hits[i:i + 500]) for i in range(0, 2000, 500)]
    assert all(1300 <= q <= 1700 for q in quarters) and hits.count(0) < 150 and hits.count(3) > 400


def test_sample_keeps_columns_named_like_its_own(spark):
    df = spark.range(100).selectExpr("id as _key", "id as _tie")
    got = sample_exact_n(df, 20, ["_key"], seed=4)
    assert got.columns == ["_key", "_tie"] and got.where("_key = _tie").count() == 20


def test_capped_split_sorts_little(spark):
    from tardy.operators.chunks import bounded_prefix

    df = spark.range(200_000).selectExpr("(id * 7919) % 200000 as t", "id")
    rows = bounded_prefix(df, 5000, ["t", "id"])
    assert 5000 <= rows.count() < 20_000 and rows.where("t < 5000").count() == 5000
    assert bounded_prefix(df, 190_000, ["t"]).count() == 200_000
    assert bounded_prefix(df.limit(0), 10, ["t"]).count() == 0


def test_row_position_with_a_hot_order_value(spark):
    """A third of the rows share one order value; the tie-breaker keeps the
    order total, so positions are exact and no range partition takes them all."""
    from tardy.operators.chunks import with_row_position

    n = 6000
    df = spark.range(n).withColumn("t", F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id")))
    out = with_row_position(df, ["t", "id"])
    rows = out.select("t", "id", "row_index").collect()
    expected = {i: pos for pos, (_, i) in enumerate(sorted((r["t"], r["id"]) for r in rows))}
    assert all(r["row_index"] == expected[r["id"]] for r in rows)
    # the range partitioning it uses splits the hot value by the tie-breaker
    ranged = df.repartitionByRange(8, F.col("t"), F.col("id"))
    sizes = ranged.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < n / 4


def test_sample_is_roughly_uniform(spark):
    flights = testdata.flights(spark, SF_SMALL)
    total = flights.count()
    share = flights.filter(F.col("SRC_LINE") <= 2).count() / total
    s = sample_exact_n(flights, 2000, testdata.FLIGHTS_ROW_KEY, seed=11)
    got = s.filter(F.col("SRC_LINE") <= 2).count() / 2000
    assert abs(got - share) < 0.05


def test_copies_of_equal_rows_are_numbered(spark):
    """Every row has a number of its own among its equals, in blocks that end anywhere; nulls are equals."""
    df = spark.range(1000).selectExpr("case when id < 700 then 'x' when id < 995 then null else 'y' end as a")
    got = {}
    for r in numbered_copies(df, block=64).collect():
        got.setdefault(r["a"], []).append(r[COPY])
    assert {k: sorted(v) for k, v in got.items()} == {"x": list(range(700)), None: list(range(295)), "y": list(range(5))}


def test_sample_of_equal_rows_by_copies(spark):
    """Rows that repeat in all columns: exactly n, near each value's share, the same for any layout."""
    df = spark.range(1000).selectExpr("case when id % 3 = 0 then 'x' when id % 3 = 1 then null else 'y' end as a")
    count = lambda rows: {r["a"]: r["n"] for r in rows.groupBy("a").agg(F.count("*").alias("n")).collect()}
    got = count(sample_exact_n(df, 300, ["a"], seed=5, copies=True))
    assert sum(got.values()) == 300 and all(70 <= n <= 130 for n in got.values()) and len(got) == 3
    assert got == count(sample_exact_n(df.repartition(7), 300, ["a"], seed=5, copies=True))
    assert sample_exact_n(df, 2000, ["a"], seed=5, copies=True).count() == 1000


def test_sample_repeated_rows_draws_among_copies():
    """The query's SQL numbers the copies of each value over all rows before it draws."""
    sql = catalogue.oracle_sql()["sample_repeated_rows"]
    assert "row_number() over (partition by MONTH, AIRLINE, DAY_OF_WEEK) - 1 as nth from flights" in sql
