"""Boundary cases of the cleaning rules, derived columns and statistics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tardy.functions.clock import add_event_time, clock_hour, flight_date
from tardy.functions.codes import normalize_flight_codes
from tardy.functions.flags import add_flags
from tardy.operators.aggregate import daily_gold
from tardy.operators.clean import apply_quality_filters, rejection_report

DELAYS = [-60.0, -59.0, 0.0, 1.0, 15.0, 16.0, 60.0, 61.0, 180.0, 181.0, 999.0, 1000.0, None]


def test_delay_bounds_are_exclusive(flights_df):
    df = flights_df([{"DEPARTURE_DELAY": d, "FLIGHT_NUMBER": str(i)} for i, d in enumerate(DELAYS)])
    kept = sorted(r[0] for r in apply_quality_filters(df).select("DEPARTURE_DELAY").collect())
    assert kept == [-59.0, 0.0, 1.0, 15.0, 16.0, 60.0, 61.0, 180.0, 181.0, 999.0]


def test_delay_categories_and_flags(flights_df):
    df = flights_df([{"DEPARTURE_DELAY": d, "FLIGHT_NUMBER": str(i)} for i, d in enumerate(DELAYS[1:-2])])
    rows = {r["DEPARTURE_DELAY"]: r for r in add_flags(df).collect()}
    assert rows[0.0]["delay_category"] == "Early/On-time"
    assert rows[1.0]["delay_category"] == "Minor"
    assert rows[15.0]["delay_category"] == "Minor" and rows[15.0]["is_delayed"] == 0
    assert rows[16.0]["delay_category"] == "Moderate" and rows[16.0]["is_delayed"] == 1
    assert rows[60.0]["delay_category"] == "Moderate"
    assert rows[61.0]["delay_category"] == "Severe"
    assert rows[180.0]["delay_category"] == "Severe"
    assert rows[181.0]["delay_category"] == "Extreme"
    assert all(r["is_delayed"] + r["is_on_time"] == 1 for r in rows.values())


def test_null_flags_reject(flights_df):
    df = flights_df([
        {"CANCELLED": None}, {"CANCELLED": 1}, {"DIVERTED": None}, {"AIRLINE": None},
        {"ORIGIN_AIRPORT": None}, {"DESTINATION_AIRPORT": None}, {"DEPARTURE_DELAY": None},
        {"AIRLINE": "   "},  # blank code: trimmed to '' which is not null -> kept
    ])
    out = apply_quality_filters(normalize_flight_codes(df)).collect()
    assert [r["AIRLINE"] for r in out] == [""]
    stream_rules = apply_quality_filters(normalize_flight_codes(df), require_destination=False)
    assert stream_rules.count() == 2  # the stream keeps the row without destination


def test_rejection_report_first_failing_rule(flights_df):
    df = flights_df([
        {"CANCELLED": 1, "DIVERTED": 1}, {"DIVERTED": 1, "AIRLINE": None},
        {"AIRLINE": None, "DEPARTURE_DELAY": None}, {"DEPARTURE_DELAY": -60.0},
        {"DEPARTURE_DELAY": 1000.0}, {},
    ])
    r = rejection_report(normalize_flight_codes(df)).first().asDict()
    assert r["total_rows"] == 6 and r["kept_rows"] == 1
    assert r["rejected_cancelled"] == 1 and r["rejected_diverted"] == 1
    assert r["rejected_missing_airline"] == 1 and r["rejected_delay_too_low"] == 1
    assert r["rejected_delay_too_high"] == 1
    parts = sum(v for k, v in r.items() if k.startswith("rejected_"))
    assert parts + r["kept_rows"] == r["total_rows"]


def test_normalisation_is_idempotent(flights_df):
    df = flights_df([{"AIRLINE": " aa ", "ORIGIN_AIRPORT": "jfk ", "DESTINATION_AIRPORT": " n2"}])
    once = normalize_flight_codes(df)
    twice = normalize_flight_codes(once)
    assert once.collect() == twice.collect()
    r = once.first()
    assert (r["AIRLINE"], r["ORIGIN_AIRPORT"], r["DESTINATION_AIRPORT"]) == ("AA", "JFK", "N2")


def test_flight_date_guards(spark):
    df = spark.createDataFrame(
        [(2015, 1, 5), (2015, 2, 30), (None, 5, 5), (2015, None, 5), (2015, 1, None)],
        "y int, m int, d int")
    got = [r[0] for r in df.select(flight_date("y", "m", "d")).collect()]
    assert got == [dt.date(2015, 1, 5), None, None, None, None]


def test_event_time_rejects_non_clock_values(flights_df):
    df = flights_df([{"SCHEDULED_DEPARTURE": v, "FLIGHT_NUMBER": str(v)} for v in (2400, 775, 2359, 5)])
    out = add_event_time(df).select("SCHEDULED_DEPARTURE",
                                    F.col("event_ts").cast("timestamp_ntz").alias("ts")).collect()
    got = {r[0]: r[1] for r in out}
    assert set(got) == {2359, 5}
    assert got[2359] == dt.datetime(2015, 1, 5, 23, 59) and got[5] == dt.datetime(2015, 1, 5, 0, 5)
    # the batch job keeps such rows; DEP_HOUR of 2400 is 24 (-> Night, not rush hour)
    h = {r[0]: r[1] for r in df.select("SCHEDULED_DEPARTURE", clock_hour()).collect()}
    assert h[2400] == 24 and h[775] == 7


def test_weekend_rush_hour_time_of_day_season(flights_df):
    df = flights_df([
        {"DAY_OF_WEEK": 6, "SCHEDULED_DEPARTURE": 600, "MONTH": 12, "FLIGHT_NUMBER": "a"},
        {"DAY_OF_WEEK": 7, "SCHEDULED_DEPARTURE": 1959, "MONTH": 3, "FLIGHT_NUMBER": "b"},
        {"DAY_OF_WEEK": 1, "SCHEDULED_DEPARTURE": 1000, "MONTH": 7, "FLIGHT_NUMBER": "c"},
        {"DAY_OF_WEEK": 5, "SCHEDULED_DEPARTURE": 2400, "MONTH": 10, "FLIGHT_NUMBER": "d"},
    ])
    r = {x["FLIGHT_NUMBER"]: x for x in add_flags(df).collect()}
    assert (r["a"]["is_weekend"], r["a"]["is_rush_hour"], r["a"]["time_of_day"], r["a"]["season"]) == (1, 1, "Morning", "Winter")
    assert (r["b"]["is_weekend"], r["b"]["is_rush_hour"], r["b"]["time_of_day"], r["b"]["season"]) == (1, 1, "Evening", "Spring")
    assert (r["c"]["is_weekend"], r["c"]["is_rush_hour"], r["c"]["time_of_day"], r["c"]["season"]) == (0, 0, "Morning", "Summer")
    assert (r["d"]["is_rush_hour"], r["d"]["time_of_day"], r["d"]["season"]) == (0, "Night", "Fall")


def test_gold_statistics_properties(flights_df):
    rows = [{"DEPARTURE_DELAY": float(d), "FLIGHT_NUMBER": str(i),
             "SCHEDULED_DEPARTURE": 600 + 100 * (i % 14), "DAY_OF_WEEK": 1 + i % 7}
            for i, d in enumerate(range(-50, 400, 7))]
    df = add_flags(normalize_flight_codes(flights_df(rows)).withColumns({
        "FL_DATE": flight_date(), "DEP_HOUR": clock_hour(), "AIRLINE_NAME": F.lit("x"),
        "ORIGIN_AIRPORT_NAME": F.lit("o"), "ORIGIN_CITY": F.lit("c"), "ORIGIN_STATE": F.lit("s")}))
    g = daily_gold(df).first().asDict()
    n = g["num_flights"]
    assert n == len(rows)
    assert g["num_delayed"] + g["num_on_time"] == n
    assert sum(g[k] for k in ["num_early_ontime", "num_minor_delay", "num_moderate_delay",
                              "num_severe_delay", "num_extreme_delay"]) == n
    assert g["min_dep_delay"] <= g["median_dep_delay"] <= g["p90_dep_delay"] <= g["p95_dep_delay"] <= g["max_dep_delay"]
    assert abs(g["delay_rate"] + g["on_time_rate"] - 1.0) < 1e-12
    assert g["num_cancelled"] == 0 and g["num_diverted"] == 0
    # percentile_approx equals the discrete percentile on small groups
    vals = sorted(r["DEPARTURE_DELAY"] for r in rows)
    import math
    assert g["median_dep_delay"] == vals[math.ceil(0.5 * n) - 1]
    assert g["p90_dep_delay"] == vals[math.ceil(0.9 * n) - 1]
