"""Structured Streaming: late data, restart from checkpoint, stream dedup."""

from __future__ import annotations

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tardy.plans import batch
from tardy.schema import FLIGHT_SCHEMA
from tardy.session import scratch_path
from tardy.sinks import parquet as sinks
from tardy.sources.csv import read_flights_stream
from tardy.streaming.pipeline import StreamJob, gold_batch_writer, latest_window_values, stream_features, windowed_gold

HEADER = ",".join(f.name for f in FLIGHT_SCHEMA.fields)


def _csv_line(day: int, hhmm: int, flight: str, delay: float = 10.0) -> str:
    vals = {"YEAR": "2024", "MONTH": "1", "DAY": str(day), "DAY_OF_WEEK": "3", "AIRLINE": "C1",
            "FLIGHT_NUMBER": flight, "TAIL_NUMBER": "T1", "ORIGIN_AIRPORT": "N1",
            "DESTINATION_AIRPORT": "N2", "SCHEDULED_DEPARTURE": str(hhmm),
            "DEPARTURE_DELAY": str(delay), "AIR_TIME": "60.0", "DISTANCE": "300.0",
            "DIVERTED": "0", "CANCELLED": "0"}
    return ",".join(vals.get(f.name, "") for f in FLIGHT_SCHEMA.fields)


def _local(path: str) -> str:
    return path.removeprefix("file:")


def _put(folder: str, name: str, lines: list[str]) -> None:
    folder = _local(folder)
    os.makedirs(folder, exist_ok=True)
    tmp = os.path.join(folder, f".{name}.tmp")  # hidden until complete
    with open(tmp, "w") as fh:
        fh.write("\n".join([HEADER, *lines]) + "\n")
    os.link(tmp, os.path.join(folder, name))


def _dims(spark):
    inputs = batch.testdata_inputs(spark, SF_SMALL)
    return inputs.airlines, inputs.airports


# Five one-row files, one micro-batch each, times 10:02, 12:00, 10:03, 10:04, 14:00.
# With no-data micro-batches (Spark's default, and the reference's setting with
# uploads 10 s apart) the watermark advances to 11:30 right after 12:00 arrives,
# closing 10:02's windows alone; 10:03 and 10:04 are then late (3 rows each).
# Without no-data batches a window only closes when data arrives: 10:03 still
# joins 10:02 (lateness is judged by the previous batch's watermark), 10:04 is
# dropped, and 12:00's windows never close.
TRUTH = {
    "true": ([("09:50", 1), ("09:55", 1), ("10:00", 1), ("11:50", 1), ("11:55", 1), ("12:00", 1)],
             [0, 0, 3, 3, 0]),
    "false": ([("09:50", 2), ("09:55", 2), ("10:00", 2)], [0, 0, 0, 3, 0]),
}


@pytest.mark.parametrize("no_data_batches", ["true", "false"])
def test_late_data_truth_table(spark, no_data_batches):
    expected_rows, expected_dropped = TRUTH[no_data_batches]
    src = scratch_path(spark, "late-in")
    gold = scratch_path(spark, "late-gold")
    os.makedirs(_local(src))
    airlines, airports = _dims(spark)
    stream = read_flights_stream(spark, src, max_files_per_trigger=1)
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", no_data_batches)
    try:
        q = (
            windowed_gold(stream_features(stream, airlines, airports))
            .writeStream.outputMode("append")
            .option("checkpointLocation", scratch_path(spark, "late-ckpt"))
            .foreachBatch(gold_batch_writer(gold))
            .start()
        )
    finally:
        spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")
    dropped = []
    try:
        for i, hhmm in enumerate([1002, 1200, 1003, 1004, 1400]):
            _put(src, f"f{i}.csv", [_csv_line(10, hhmm, str(i))])
            q.processAllAvailable()
            time.sleep(1.0)  # let a pending no-data batch run before the next file
            q.processAllAvailable()
            batches = [p for p in q.recentProgress if p["numInputRows"] > 0]
            dropped.append(sum(o.get("numRowsDroppedByWatermark", 0)
                               for o in batches[-1].get("stateOperators", [])))
    finally:
        q.stop()
    rows = sinks.read_gold(spark, gold).select("window_start", "num_flights").collect()
    got = sorted((r[0].strftime("%H:%M"), r[1]) for r in rows)
    assert got == expected_rows
    assert dropped == expected_dropped


def test_restart_from_checkpoint_adds_nothing_then_continues(spark):
    src, gold, ckpt = (scratch_path(spark, n) for n in ("rs-in", "rs-gold", "rs-ckpt"))
    airlines, airports = _dims(spark)
    _put(src, "a.csv", [_csv_line(10, 1000 + i, f"a{i}") for i in range(10)])
    _put(src, "b.csv", [_csv_line(10, 1300, "b0")])
    job = StreamJob(input_dir=src, checkpoint=ckpt, gold_path=gold)
    job.run_available(spark, airlines, airports)
    first = sinks.read_gold(spark, gold).count()
    assert first > 0
    job.run_available(spark, airlines, airports)  # same checkpoint, no new files
    assert sinks.read_gold(spark, gold).count() == first
    _put(src, "c.csv", [_csv_line(10, 1700, "c0")])
    job.run_available(spark, airlines, airports)
    assert sinks.read_gold(spark, gold).count() > first


def test_each_event_lands_in_three_windows(spark, flights_df):
    inputs = batch.testdata_inputs(spark, SF_SMALL)
    df = flights_df([{"YEAR": 2024, "SCHEDULED_DEPARTURE": 1005, "AIRLINE": "C1"}])
    from tardy.operators.aggregate import window_gold

    g = window_gold(stream_features(df, inputs.airlines, inputs.airports))
    starts = sorted(r[0] for r in g.select("window_start").collect())
    assert starts == [dt.datetime(2024, 1, 5, 9, 55), dt.datetime(2024, 1, 5, 10, 0),
                      dt.datetime(2024, 1, 5, 10, 5)]


def test_stream_dedup_within_watermark(spark):
    src, out = scratch_path(spark, "dd-in"), scratch_path(spark, "dd-out")
    airlines, airports = _dims(spark)
    _put(src, "a.csv", [_csv_line(10, 1000, "7", 5.0), _csv_line(10, 1000, "7", 5.0),
                        _csv_line(10, 1001, "8")])
    stream = read_flights_stream(spark, src)
    q = (
        stream_features(stream, airlines, airports, dedup_within="30 minutes")
        .select("FLIGHT_NUMBER")
        .writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", scratch_path(spark, "dd-ckpt"))
        .trigger(availableNow=True).start()
    )
    q.awaitTermination()
    assert sorted(r[0] for r in spark.read.parquet(out).collect()) == ["7", "8"]


def test_single_query_serves_all_sinks(spark):
    src, gold, wh = (scratch_path(spark, n) for n in ("ms-in", "ms-gold", "ms-wh"))
    airlines, airports = _dims(spark)
    _put(src, "a.csv", [_csv_line(10, 1000 + i, f"a{i}") for i in range(5)] + [_csv_line(10, 1400, "z")])
    StreamJob(input_dir=src, checkpoint=scratch_path(spark, "ms-ckpt"), gold_path=gold,
              warehouse_path=wh).run_available(spark, airlines, airports)
    a = sinks.read_gold(spark, gold).drop("processed_at")
    b = sinks.read_gold(spark, wh).drop("processed_at")
    assert a.count() > 0 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert set(r[0] for r in a.select("aggregation_type").distinct().collect()) == {"streaming_15min"}
    assert a.filter(F.col("load_id").rlike("^[0-9a-f-]{36}-[0-9]{12}$")).count() == a.count()


def test_two_streams_share_a_folder(spark):
    """A fresh checkpoint starts its micro-batches at 0 again; it must not replace another stream's rows."""
    gold, counts = scratch_path(spark, "two-gold"), []
    airlines, airports = _dims(spark)
    for i, (first, last) in enumerate((("a", 1400), ("b", 1500))):
        src = scratch_path(spark, "two-in")
        _put(src, "a.csv", [_csv_line(10 + i, 1000 + k, f"{first}{k}") for k in range(5)] + [_csv_line(10 + i, last, f"z{i}")])
        StreamJob(input_dir=src, checkpoint=scratch_path(spark, "two-ckpt"), gold_path=gold).run_available(spark, airlines, airports)
        counts.append(sinks.read_gold(spark, gold).count())
    assert counts[1] == 2 * counts[0] > 0


def test_job_with_dedup(spark):
    src, gold = scratch_path(spark, "dd-in"), scratch_path(spark, "dd-gold")
    airlines, airports = _dims(spark)
    _put(src, "a.csv", [_csv_line(10, 1000, "a"), _csv_line(10, 1000, "a"), _csv_line(10, 1000, "b"), _csv_line(10, 1400, "z")])
    StreamJob(input_dir=src, checkpoint=scratch_path(spark, "dd-ckpt"), gold_path=gold, dedup_within="30 minutes").run_available(spark, airlines, airports)
    assert {r[0] for r in sinks.read_gold(spark, gold).select("num_flights").collect()} == {2}


def test_gold_and_update_log_together(spark, capsys):
    src, gold, log = (scratch_path(spark, n) for n in ("gu-in", "gu-gold", "gu-log"))
    airlines, airports = _dims(spark)
    _put(src, "a.csv", [_csv_line(10, 1000, "a"), _csv_line(10, 1400, "z")])
    StreamJob(input_dir=src, checkpoint=scratch_path(spark, "gu-ckpt"), gold_path=gold, update_log_path=log, console_rows=3).run_available(spark, airlines, airports)
    closed, latest = sinks.read_gold(spark, gold), latest_window_values(spark.read.parquet(log))
    assert 0 < closed.count() < latest.count() == 6
    assert "-- micro-batch" in capsys.readouterr().out
    with pytest.raises(ValueError, match="no output"):
        StreamJob(input_dir=src, checkpoint=scratch_path(spark, "gu-ckpt")).start(spark, airlines, airports)


def test_console_preview_inside_the_single_sink(spark, capsys):
    src, gold = scratch_path(spark, "cp-in"), scratch_path(spark, "cp-gold")
    airlines, airports = _dims(spark)
    _put(src, "a.csv", [_csv_line(10, 1000, "a"), _csv_line(10, 1400, "z")])
    StreamJob(input_dir=src, checkpoint=scratch_path(spark, "cp-ckpt"), gold_path=gold,
              console_rows=5).run_available(spark, airlines, airports)
    assert "-- micro-batch" in capsys.readouterr().out


def test_state_partitions_are_fixed_per_query(spark):
    src, gold = scratch_path(spark, "sp-in"), scratch_path(spark, "sp-gold")
    airlines, airports = _dims(spark)
    _put(src, "a.csv", [_csv_line(10, 1000, "a"), _csv_line(10, 1400, "z")])
    job = StreamJob(input_dir=src, checkpoint=scratch_path(spark, "sp-ckpt"), gold_path=gold,
                    state_partitions=3)
    q = job.start(spark, airlines, airports)
    q.awaitTermination()
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"  # session untouched
    agg = [o for o in q.lastProgress["stateOperators"]]
    assert agg and agg[0]["numShufflePartitions"] == 3


def test_replay_runs_a_micro_batch_per_chunk(spark):
    """Chunks in order, a micro-batch each and one that closes the rest, with the rows of one run over all files;
    the exported chunks stay."""
    from tardy.operators.chunks import export_chunks
    from tardy.plans import catalogue
    from tardy.sources import testdata
    from tardy.sources.csv import conform
    from tardy.streaming.pipeline import replay_chunks

    inputs = batch.testdata_inputs(spark, SF_SMALL, stream=True)
    rows = conform(testdata.flights_stream(spark, SF_SMALL), FLIGHT_SCHEMA)
    chunks, ckpt = scratch_path(spark, "chunks"), scratch_path(spark, "replay-ckpt")
    size = -(-rows.count() // 4)
    export_chunks(rows, chunks, size, catalogue.stream_order())
    job = StreamJob(input_dir=scratch_path(spark, "replay-in"), checkpoint=ckpt, gold_path=scratch_path(spark, "gold"),
                    max_files_per_trigger=1, state_partitions=2)
    replay_chunks(spark, chunks, range(4), job, inputs.airlines, inputs.airports)
    assert len([f for f in os.listdir(f"{ckpt.removeprefix('file:')}/commits") if f.isdigit()]) == 5
    assert spark.read.option("header", True).csv(chunks).count() == rows.count()
    whole = catalogue._run_stream(spark, SF_SMALL, gold_path=scratch_path(spark, "gold"))
    got, want = (sinks.read_gold(spark, p).drop("processed_at", "load_id") for p in (job.gold_path, whole.gold_path))
    assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0


def _chunk_job(spark, rows, size):
    from tardy.operators.chunks import export_chunks
    from tardy.plans import catalogue

    chunks = scratch_path(spark, "chunks")
    export_chunks(rows, chunks, size, catalogue.stream_order())
    return chunks, StreamJob(input_dir=scratch_path(spark, "replay-in"), checkpoint=scratch_path(spark, "replay-ckpt"), gold_path=scratch_path(spark, "gold"),
                             max_files_per_trigger=1, state_partitions=2, archive_dir=scratch_path(spark, "replay-done"))


def test_replay_micro_batches_do_no_needless_work(spark, flights_df, monkeypatch):
    """A micro-batch in few tasks is neither kept, counted nor shuffled again; files that have been read leave the
    listed folder; the checkpoint on local files is written by renames."""
    from tardy.session import CHECKPOINT_WRITER, LOCAL_CHECKPOINT_WRITER
    from tardy.streaming import pipeline

    rows = flights_df([{"DAY": d, "SCHEDULED_DEPARTURE": h * 100, "FLIGHT_NUMBER": str(h), "AIRLINE": a}
                       for d in (5, 6) for h in (7, 9, 11) for a in ("AA", "ZZ")])
    chunks, job = _chunk_job(spark, rows, 3)
    airlines, airports = _dims(spark)
    monkeypatch.setattr(sinks, "stream_writers", lambda *a: pytest.fail("counted"))
    writers, body = [], pipeline.sinks.write_gold

    def seen(batch, *a, **k):
        writers.append(batch.sparkSession.conf.get(CHECKPOINT_WRITER, None))
        assert not batch.is_cached
        return body(batch, *a, **k)

    monkeypatch.setattr(pipeline.sinks, "write_gold", seen)
    pipeline.replay_chunks(spark, chunks, range(4), job, airlines, airports)
    monkeypatch.undo()
    assert writers == [LOCAL_CHECKPOINT_WRITER] * 5 and CHECKPOINT_WRITER not in spark.conf.getAll
    place = job.input_dir.removeprefix("file:")
    assert len([f for f in os.listdir(place) if f.endswith(".csv")]) <= 2  # the last ones
    got = sinks.read_gold(spark, job.gold_path)
    assert got.agg({"num_flights": "sum"}).first()[0] == 3 * 10  # the last two flights' windows are still open


def test_replay_checks_the_whole_dimension(spark, flights_df):
    """A code that comes twice in a dimension is an error, even if no chunk has it."""
    from tardy.operators.enrich import DuplicateDimensionKey
    from tardy.streaming.pipeline import replay_chunks

    chunks, job = _chunk_job(spark, flights_df([{"FLIGHT_NUMBER": str(i)} for i in range(4)]), 2)
    _, airports = _dims(spark)
    airlines = spark.createDataFrame([("AA", "a"), ("QQ", "q"), ("QQ", "r")], "AIRLINE_CODE string, AIRLINE_NAME string")
    with pytest.raises(DuplicateDimensionKey):
        replay_chunks(spark, chunks, range(2), job, airlines, airports)
