"""Property tests: random fact rows through the rules, against a plain-Python
statement of the same rules."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tardy.functions.codes import normalize_flight_codes
from tardy.functions.flags import add_flags
from tardy.operators.clean import apply_quality_filters, rejection_report

codes = st.one_of(st.none(), st.sampled_from(["aa", " AA ", "", "   ", "n1", "N2 "]))
flags01 = st.one_of(st.none(), st.sampled_from([0, 1]))
delays = st.one_of(st.none(), st.integers(-120, 1200).map(float))
rows = st.lists(st.fixed_dictionaries({
    "AIRLINE": codes, "ORIGIN_AIRPORT": codes, "DESTINATION_AIRPORT": codes,
    "DEPARTURE_DELAY": delays, "CANCELLED": flags01, "DIVERTED": flags01,
    "SCHEDULED_DEPARTURE": st.integers(0, 2400),
}), min_size=1, max_size=40)


def keep(r: dict) -> bool:
    return (r["CANCELLED"] == 0 and r["DIVERTED"] == 0 and r["AIRLINE"] is not None
            and r["ORIGIN_AIRPORT"] is not None and r["DESTINATION_AIRPORT"] is not None
            and r["DEPARTURE_DELAY"] is not None and -60 < r["DEPARTURE_DELAY"] < 1000)


def category(d: float) -> str:
    if d <= 0:
        return "Early/On-time"
    if d <= 15:
        return "Minor"
    if d <= 60:
        return "Moderate"
    if d <= 180:
        return "Severe"
    return "Extreme"


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows)
def test_rules_match_plain_python(spark, flights_df, sample):
    data = [{**r, "FLIGHT_NUMBER": str(i)} for i, r in enumerate(sample)]
    df = normalize_flight_codes(flights_df(data))
    kept = {r["FLIGHT_NUMBER"]: r for r in add_flags(apply_quality_filters(df)).collect()}
    expected = {r["FLIGHT_NUMBER"] for r in data if keep(r)}
    assert set(kept) == expected
    for r in kept.values():
        assert r["delay_category"] == category(r["DEPARTURE_DELAY"])
        assert r["is_delayed"] == (1 if r["DEPARTURE_DELAY"] > 15 else 0)
    rep = rejection_report(df).first().asDict()
    assert rep["kept_rows"] == len(expected) and rep["total_rows"] == len(data)
    assert sum(v for k, v in rep.items() if k.startswith("rejected_")) + rep["kept_rows"] == len(data)


dedup_rows = st.lists(st.fixed_dictionaries({
    "TAIL_NUMBER": st.one_of(st.none(), st.sampled_from(["T1", "T2"])),
    "SCHEDULED_DEPARTURE": st.sampled_from([700, 705]),
    "DEPARTURE_DELAY": st.one_of(st.none(), st.integers(-5, 5).map(float)),
    "AIR_TIME": st.one_of(st.none(), st.sampled_from([50.0, 60.0])),
    "DISTANCE": st.integers(1, 1000).map(float),
}), min_size=1, max_size=30)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(dedup_rows)
def test_dedup_matches_brute_force(spark, flights_df, sample):
    from tardy.operators.clean import dedup_first
    from tardy.schema import DEDUP_KEYS

    df = flights_df(sample)
    cols = df.columns
    rest = [c for c in cols if c not in DEDUP_KEYS]
    def canon(t):
        return tuple((x is None, str(x)) for x in t)

    got = sorted((tuple(r) for r in dedup_first(df).select(*cols).collect()), key=canon)

    def order_key(r):  # ascending, nulls first, over the non-key columns in schema order
        return tuple((r[c] is not None, r[c] if r[c] is not None else 0) for c in rest)

    groups: dict = {}
    for r in (row.asDict() for row in df.collect()):
        k = tuple(r[c] for c in DEDUP_KEYS)
        if k not in groups or order_key(r) < order_key(groups[k]):
            groups[k] = r
    expected = sorted((tuple(r[c] for c in cols) for r in groups.values()), key=canon)
    assert got == expected
