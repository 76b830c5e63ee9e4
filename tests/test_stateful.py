"""Stream-stream join, sessions, running state, late rows and the handling of several queries."""

from __future__ import annotations

import datetime as dt
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tardy.functions.metrics import ALL_METRICS
from tardy.operators.aggregate import session_gold
from tardy.session import scratch_path
from tardy.streaming.joins import match_departures
from tardy.streaming.late import LateSplit
from tardy.streaming.pipeline import StreamRun
from tardy.streaming.running import Running, running_delay, running_delay_batch


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(f"2024-01-01 {text}")


class Feed:
    """A folder of Parquet files that a stream reads, and the query over it, started anew for each delivery."""

    def __init__(self, spark, schema: str):
        self.spark, self.schema = spark, schema
        self.folder, self.out, self.checkpoint = (scratch_path(spark, n) for n in ("feed", "feed-out", "feed-ckpt"))

    def deliver(self, rows):
        self.spark.createDataFrame(rows, self.schema).repartition(2).write.mode("append").parquet(self.folder)

    def stream(self):
        return self.spark.readStream.schema(self.schema).parquet(self.folder)

    def run(self, df):
        q = df.writeStream.format("parquet").option("path", self.out).option("checkpointLocation", self.checkpoint).trigger(availableNow=True).start()
        q.awaitTermination()
        return q

    def result(self):
        return sorted(map(tuple, self.spark.read.parquet(self.out).collect()), key=str)


# ---------------------------------------------------------------- stream-stream join

def test_departures_match_once_and_leave_state(spark):
    planned = Feed(spark, "TAIL_NUMBER string, planned_ts timestamp")
    actual = Feed(spark, "TAIL_NUMBER string, actual_ts timestamp")
    sizes = []
    for p, a in [([("T1", at("08:00")), ("T2", at("08:00")), (None, at("08:00"))], [("T1", at("08:20")), ("T9", at("08:05"))]),
                 ([("T3", at("11:00"))], [("T1", at("08:55")), ("T3", at("11:05"))]),  # a second partner of T1
                 ([("T4", at("20:00"))], [("T4", at("20:30")), ("T2", at("07:00"))]),  # T2's is too late, behind the watermark
                 ([("T5", at("23:00"))], [("T5", at("23:10"))])]:
        planned.deliver(p)
        actual.deliver(a)
        q = planned.run(match_departures(planned.stream(), actual.stream(), late="1 hour"))
        sizes.append(sum(o["numRowsTotal"] for o in q.lastProgress["stateOperators"]))
    got = planned.result()
    want = [("T1", at("08:00"), at("08:20")), ("T1", at("08:00"), at("08:55")), ("T2", at("08:00"), None), (None, at("08:00"), None),
            ("T3", at("11:00"), at("11:05")), ("T4", at("20:00"), at("20:30")), ("T5", at("23:00"), at("23:10"))]
    assert got == sorted(want, key=str)
    assert sizes[-1] <= 4  # only the last hours' rows are held
    bounded = match_departures(*(spark.read.parquet(f.folder) for f in (planned, actual)), late="1 hour")
    late = [r for r in map(tuple, bounded.collect()) if r[2] != at("07:00")]
    assert sorted(late, key=str) == got


# ---------------------------------------------------------------- sessions

FLAGS = "AIRLINE string, event_ts timestamp, DEPARTURE_DELAY double, is_delayed int, is_on_time int, delay_category string, is_weekend int, is_rush_hour int, DISTANCE double, AIR_TIME double, CANCELLED int, DIVERTED int"


def flagged(airline, text, delay):
    return airline, at(text), float(delay), 0, 1, "Minor", 0, 0, 100.0, 10.0, 0, 0


def test_sessions_merge_in_state(spark):
    feed = Feed(spark, FLAGS)
    emitted = []
    for rows in [[flagged("A", "08:00", 1), flagged("A", "08:50", 2), flagged("B", "08:00", 5)],
                 [flagged("A", "08:25", 3), flagged("A", "09:00", 7)],  # joins 08:00 and 08:50: one session now
                 [flagged("A", "12:00", 4), flagged("A", "08:10", 9)],
                 [flagged("A", "08:10", 99), flagged("A", "15:00", 4)]]:  # 08:10 is too late here
        feed.deliver(rows)
        feed.run(session_gold(feed.stream().withWatermark("event_ts", "1 hour"), "30 minutes"))
        emitted.append(len(feed.result()))
    rows = spark.read.parquet(feed.out).select("AIRLINE", "session_start", "session_end", "num_flights", "avg_dep_delay", "max_dep_delay", "median_dep_delay")
    assert sorted(map(tuple, rows.collect())) == [("A", at("08:00"), at("09:30"), 5, 4.4, 9.0, 3.0), ("A", at("12:00"), at("12:30"), 1, 4.0, 4.0, 4.0),
                                                  ("B", at("08:00"), at("08:30"), 1, 5.0, 5.0, 5.0)]
    assert emitted[0] == 0 and emitted[-1] == 3


def test_sessions_of_a_bounded_frame(spark):
    r = np.random.default_rng(4)
    minutes = np.sort(r.choice(1400, 60, replace=False))
    df = spark.createDataFrame([("A", at("00:00") + dt.timedelta(minutes=int(m)), float(m), 0, 1, "Minor", 0, 0, 1.0, 1.0, 0, 0) for m in minutes], FLAGS)
    want, start = [], 0
    for i in range(1, len(minutes) + 1):
        if i == len(minutes) or minutes[i] - minutes[i - 1] > 30:
            want.append((int(minutes[start]), i - start))
            start = i
    got = session_gold(df.repartition(5), metrics=ALL_METRICS).collect()
    assert sorted(((r["session_start"] - at("00:00")).seconds // 60, r["num_flights"]) for r in got) == want


def test_sessions_merge_before_the_shuffle(spark):
    """In a stream, tasks ship the sessions of a hot key, not its rows."""
    assert spark.conf.get("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition") == "true"


# ---------------------------------------------------------------- running state

def brute_running(rows, expiry):
    n = total = 0
    last, out = None, []
    for ts, i, delay in sorted(rows):
        if last is None or ts - last > expiry:
            n = total = 0
        n, total, last = n + 1, total + delay, ts
        out.append((i, ts, n, total / n))
    return out


def test_running_in_any_arrival_order():
    r = np.random.default_rng(1)
    for trial in range(30):
        n = int(r.integers(1, 60))
        rows = [(int(t), str(i), float(d)) for i, (t, d) in enumerate(zip(r.integers(0, 300, n), r.integers(-5, 50, n)))]
        order = sorted(rows, key=lambda x: x[0] + r.integers(0, 20))
        state, got, watermark = None, [], -1
        for i in range(0, n, 7):
            running = Running(25, state)
            part = order[i:i + 7]
            running.add(np.array([x[0] for x in part]), np.array([x[1] for x in part], object), np.array([x[2] for x in part]))
            watermark = max(watermark, max(x[0] for x in order[:i + 7]) - 20)
            got += running.up_to(watermark).itertuples(index=False, name=None)
            state = running.state()
        got += Running(25, state).up_to(1000).itertuples(index=False, name=None)
        assert got == brute_running(rows, 25)


def test_running_state_survives_restarts_and_expires(spark):
    feed = Feed(spark, "AIRLINE string, FLIGHT_NUMBER string, event_ts timestamp, DEPARTURE_DELAY double")
    all_rows, held = [], []
    for rows in [[("A", "1", at("08:00"), 10.0), ("A", "2", at("08:40"), 20.0), ("B", "3", at("08:10"), 5.0)],
                 [("A", "4", at("08:30"), 30.0), ("A", "5", at("09:30"), 0.0)],  # 08:30 comes after 08:40, in time
                 [("A", "6", at("14:00"), 7.0), (None, "7", at("14:00"), 1.0)],
                 [("A", "8", at("14:10"), 9.0), ("B", "9", at("20:00"), 2.0)],
                 [("C", "10", at("23:00"), 2.0)]]:
        all_rows += rows
        feed.deliver(rows)
        q = feed.run(running_delay(feed.stream(), expiry_minutes=120, watermark="30 minutes"))
        held.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])
    frame = spark.createDataFrame(all_rows, feed.schema)
    want = sorted((tuple(r) for r in running_delay_batch(frame).where("event_ts <= timestamp '2024-01-01 22:30:00'").collect()), key=str)
    assert feed.result() == want and len(want) == 9
    assert held[-1] == 1  # the runs of A and B are over, C waits for the watermark


# ---------------------------------------------------------------- late rows

def test_late_rows_are_kept_apart(spark):
    feed = Feed(spark, "id long, event_ts timestamp")
    split = LateSplit(scratch_path(spark, "split"))
    deliveries = [[(1, at("08:00")), (2, at("09:00"))], [(3, at("08:31")), (4, at("08:30")), (5, at("08:00")), (6, None)],
                  [(7, None)], [(8, at("12:00"))], [(9, at("11:30")), (10, at("11:31"))]]
    for i, rows in enumerate(deliveries):
        feed.deliver(rows)
        split.sink(feed.stream(), feed.checkpoint).trigger(availableNow=True).start().awaitTermination()
        assert split.read(spark).count() == sum(map(len, deliveries[:i + 1]))
    got = {r["id"]: (r["batch_id"], r["late"]) for r in split.read(spark).collect()}
    assert {i for i, (_, late) in got.items() if late} == {4, 5, 9}
    assert {i: b for i, (b, _) in got.items()} == {r[0]: b for b, rows in enumerate(deliveries) for r in rows}
    assert split.read(spark, late=True).columns == ["id", "event_ts", "stream", "batch_id"]


def test_a_micro_batch_that_runs_again_replaces_its_rows(spark):
    feed = Feed(spark, "id long, event_ts timestamp")
    fails = []

    class Failing(LateSplit):
        def write(self, batch, batch_id):
            super().write(batch, batch_id)
            if batch_id == 1 and not fails:
                fails.append(1)
                raise RuntimeError("after the write")

    split = Failing(scratch_path(spark, "split"))
    start = lambda: split.sink(feed.stream(), feed.checkpoint).trigger(availableNow=True).start()
    feed.deliver([(1, at("09:00"))])
    start().awaitTermination()
    feed.deliver([(2, at("08:00")), (3, at("13:00"))])  # 13:00 is no part of what 08:00 is held against
    with pytest.raises(Exception, match="after the write"):
        start().awaitTermination()
    start().awaitTermination()
    assert sorted((r["id"], r["batch_id"], r["late"]) for r in split.read(spark).collect()) == [(1, 0, False), (2, 1, True), (3, 1, False)]


# ---------------------------------------------------------------- several queries

def rate(spark, body):
    source = spark.readStream.format("rate").option("rowsPerSecond", 5).load()
    return source.writeStream.option("checkpointLocation", scratch_path(spark, "rate-ckpt")).foreachBatch(body).start()


@pytest.mark.parametrize("failing", [0, 1])
def test_a_failure_of_any_query_ends_the_wait(spark, failing):
    def fail(batch, batch_id):
        raise RuntimeError("no room")

    queries = [rate(spark, fail if i == failing else lambda batch, batch_id: None) for i in range(2)]
    began = time.time()
    with pytest.raises(Exception, match="no room"):
        StreamRun(queries, bounded=False).awaitTermination()
    assert time.time() - began < 60 and not any(q.isActive for q in queries)


def test_an_unbounded_run_ends_with_its_first_query(spark):
    queries = [rate(spark, lambda batch, batch_id: None) for _ in range(2)]
    queries[1].stop()
    StreamRun(queries, bounded=False).awaitTermination()
    assert not any(q.isActive for q in queries)


def test_a_part_reads_its_own_rows(spark):
    """Parts are folders: the scan of one reads no file of another, and rows without a part are in none."""
    from tardy.plans.streams import parts

    rows = spark.range(400).selectExpr("id", "cast(case when id % 5 < 4 then id % 5 end as int) as delivered")
    for i, part in enumerate(parts(rows)):
        assert part.columns == ["id"] and sorted(r["id"] for r in part.collect()) == [n for n in range(400) if n % 5 == i]
        assert all(f"/delivered={i}/" in f for f in part.select("_metadata.file_path").distinct().toPandas()["file_path"])
        assert "PartitionFilters: [isnotnull(delivered" in part._jdf.queryExecution().executedPlan().toString()
