from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tardy.session import local_session

    s = local_session(4, app="tardy-tests", **{"spark.sql.shuffle.partitions": "8"})
    yield s
    s.stop()


@pytest.fixture()
def flights_df(spark):
    """Build a flights frame on the declared 31-column schema from a few dicts."""
    from tardy.schema import FLIGHT_SCHEMA
    from tardy.sources.csv import conform

    base = dict(YEAR=2015, MONTH=1, DAY=5, DAY_OF_WEEK=1, AIRLINE="AA", FLIGHT_NUMBER="1",
                TAIL_NUMBER="T1", ORIGIN_AIRPORT="N1", DESTINATION_AIRPORT="N2",
                SCHEDULED_DEPARTURE=700, DEPARTURE_DELAY=0.0, AIR_TIME=100.0, DISTANCE=500.0,
                DIVERTED=0, CANCELLED=0)

    def make(rows: list[dict]):
        full = [{**base, **r} for r in rows]
        fields = [f for f in FLIGHT_SCHEMA.fields if f.name in base]
        from pyspark.sql import types as T

        df = spark.createDataFrame([tuple(r[f.name] for f in fields) for r in full],
                                   T.StructType(fields))
        return conform(df, FLIGHT_SCHEMA)

    return make
