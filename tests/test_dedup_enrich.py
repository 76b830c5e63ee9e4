"""Deterministic dedup, guarded enrichment, and their physical plans."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tardy.functions.codes import airline_dimension, airport_dimension
from tardy.operators.clean import dedup_first
from tardy.operators.enrich import DuplicateDimensionKey, enrich_flights, guarded_dimension
from tardy.plans import batch


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_survivor_is_first_in_order_and_null_equals_null(flights_df):
    df = flights_df([
        {"TAIL_NUMBER": None, "DEPARTURE_DELAY": 30.0},
        {"TAIL_NUMBER": None, "DEPARTURE_DELAY": 10.0},
        {"TAIL_NUMBER": "T9", "DEPARTURE_DELAY": 5.0},
    ])
    out = {(r["TAIL_NUMBER"], r["DEPARTURE_DELAY"]) for r in dedup_first(df).collect()}
    assert out == {(None, 10.0), ("T9", 5.0)}


def test_dedup_independent_of_partitioning_and_idempotent(spark):
    inputs = batch.testdata_inputs(spark, SF_SMALL)
    a = batch.cleaned(inputs)
    b = batch.cleaned(batch.Inputs(inputs.flights.repartition(7).sortWithinPartitions(F.rand(3)),
                                   inputs.airlines, inputs.airports))
    ra, rb = sorted(map(tuple, a.collect()), key=str), sorted(map(tuple, b.collect()), key=str)
    assert ra == rb
    assert sorted(map(tuple, dedup_first(a).collect()), key=str) == ra


def test_dedup_limits_rows_before_the_shuffle(spark):
    plan = _plan(batch.cleaned(batch.testdata_inputs(spark, SF_SMALL)))
    # partial WindowGroupLimit sits below the exchange: a hot key ships one row per task
    assert plan.index("WindowGroupLimit") < plan.rindex("Exchange hashpartitioning")
    assert "Partial" in plan


def test_duplicate_dimension_key_is_rejected(spark):
    dim = spark.createDataFrame([("AA", "x"), ("AA", "y"), (None, "z")], "AIRLINE_CODE string, AIRLINE_NAME string")
    with pytest.raises(DuplicateDimensionKey):
        guarded_dimension(dim, "AIRLINE_CODE")
    ok = spark.createDataFrame([("AA", "x"), (None, "z"), (None, "w")], "AIRLINE_CODE string, AIRLINE_NAME string")
    guarded_dimension(ok, "AIRLINE_CODE")  # null keys never match, not duplicates


def test_large_dimension_is_not_broadcast(spark):
    dim = spark.range(50).select(F.col("id").cast("string").alias("AIRLINE_CODE"), F.lit("n").alias("AIRLINE_NAME"))
    hinted = guarded_dimension(dim, "AIRLINE_CODE", max_rows=10)
    fact = spark.range(1000).select(F.col("id").cast("string").alias("AIRLINE"))
    plan = fact.join(hinted, F.col("AIRLINE") == F.col("AIRLINE_CODE"), "left")
    assert "broadcast" not in str(plan._jdf.queryExecution().logical()).lower()


def test_enrichment_is_left_outer_broadcast(spark):
    inputs = batch.testdata_inputs(spark, SF_SMALL)
    enriched = batch.enriched(inputs)
    plan = _plan(enriched)
    assert plan.count("BroadcastHashJoin") >= 3 and "LeftOuter" in plan
    assert enriched.count() == batch.cleaned(inputs).count()  # left joins keep every fact


def test_dimensions_are_normalised(spark):
    raw = spark.createDataFrame([(" aa ", " Alpha  ")], "IATA_CODE string, AIRLINE string")
    assert airline_dimension(raw).first().asDict() == {"AIRLINE_CODE": "AA", "AIRLINE_NAME": "Alpha"}
    raw = spark.createDataFrame([(" jfk", " Kennedy ", " NYC ", " NY ", "US")],
                                "IATA_CODE string, AIRPORT string, CITY string, STATE string, COUNTRY string")
    assert airport_dimension(raw).first().asDict() == {
        "AIRPORT_CODE": "JFK", "AIRPORT_NAME": "Kennedy", "CITY_NAME": "NYC", "STATE_CODE": "NY"}


def test_stream_enrichment_has_no_destination_join(spark, flights_df):
    inputs = batch.testdata_inputs(spark, SF_SMALL)
    out = enrich_flights(flights_df([{}]), inputs.airlines, inputs.airports, with_destination=False)
    assert "DEST_AIRPORT_NAME" not in out.columns and "ORIGIN_AIRPORT_NAME" in out.columns


def test_hot_key_holding_a_third_of_the_rows(spark, flights_df):
    """A third of the rows share one dedup key (and one gold group); results
    equal a brute-force computation, whatever the partitioning."""
    from tardy.functions.clock import add_calendar_columns
    from tardy.functions.flags import add_flags
    from tardy.operators.aggregate import daily_gold

    hot = [{"FLIGHT_NUMBER": "HOT", "DEPARTURE_DELAY": float(50 - i % 50)} for i in range(600)]
    cold = [{"FLIGHT_NUMBER": str(i), "DEPARTURE_DELAY": float(i % 70), "ORIGIN_AIRPORT": f"N{i % 5}"}
            for i in range(1200)]
    df = flights_df(hot + cold).repartition(6)
    d = dedup_first(df)
    survivors = d.filter("FLIGHT_NUMBER = 'HOT'").collect()
    assert len(survivors) == 1 and survivors[0]["DEPARTURE_DELAY"] == 1.0  # smallest delay wins
    assert d.count() == 1 + 1200
    named = add_flags(add_calendar_columns(df)).withColumns({
        "AIRLINE_NAME": F.lit("a"), "ORIGIN_AIRPORT_NAME": F.lit("o"),
        "ORIGIN_CITY": F.lit("c"), "ORIGIN_STATE": F.lit("s")})
    g = {r["ORIGIN_AIRPORT"]: r for r in daily_gold(named).collect()}
    expect_n1 = 600 + sum(1 for r in cold if r["ORIGIN_AIRPORT"] == "N1")
    assert g["N1"]["num_flights"] == expect_n1
    assert sum(r["num_flights"] for r in g.values()) == 1800


@pytest.mark.parametrize("name", ["gold_daily", "dedup_first", "enrich_left_joins", "gold_window_batch",
                                  "rejection_report", "enrichment_diagnostics"])
def test_no_single_partition_exchange_over_data(spark, name):
    from tardy.plans import catalogue

    lines = _plan(catalogue.QUERIES[name](spark, SF_SMALL)).splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            # allowed only above a partial aggregate: one row per task, not the data
            assert "partial_" in lines[i + 1], "\n".join(lines[i:i + 3])
