"""A running delay per key, with state that expires.

Keyed state holds what the next row needs: number and sum of the delays of the present run, its last event, and the rows
that the watermark hasn't passed. Rows are taken up in event order whatever order they arrive in: they
wait in the state until the watermark passes them (an event-time timer wakes the key then), and no later arrival can come
before them. A run ends when the key has had no event for ``expiry``: the
timer drops the state, and the next event starts a run of its own. A key's state is thus the
rows within the watermark's delay and five numbers.

Late rows (at or behind the watermark) are dropped by Spark before they get here; ``streaming.late``
keeps them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tardy.operators.aggregate import WATERMARK_DELAY

EXPIRY_MINUTES = 120
STATE = "n long, total double, last long, waiting_ts array<long>, waiting_id array<string>, waiting_delay array<double>"


class Running:
    """The rows of one key, taken up in order. Times are milliseconds."""

    def __init__(self, expiry: int, state: tuple | None) -> None:
        self.expiry = expiry
        self.n, self.total, self.last, *waiting = state or (0, 0.0, 0, [], [], [])
        self.ts, self.id, self.delay = np.array(waiting[0], np.int64), np.array(waiting[1], object), np.array(waiting[2], float)

    def add(self, ts: np.ndarray, ids: np.ndarray, delay: np.ndarray) -> None:
        self.ts, self.id, self.delay = np.append(self.ts, ts), np.append(self.id, ids), np.append(self.delay, delay)

    def up_to(self, watermark: int) -> pd.DataFrame:
        """What the rows up to the watermark say: the run's rows and mean delay so far at each."""
        order = np.lexsort((self.id, self.ts))
        due = order[self.ts[order] <= watermark]
        ts, ids, delay = self.ts[due], self.id[due], self.delay[due]
        rest = np.setdiff1d(np.arange(len(self.ts)), due)
        self.ts, self.id, self.delay = self.ts[rest], self.id[rest], self.delay[rest]
        if not len(ts):
            return pd.DataFrame({"id": [], "ts": [], "n": [], "mean": []})
        # A row starts a run if nothing came within the expiry before it.
        starts = np.diff(ts, prepend=ts[0]) > self.expiry
        starts[0] = self.n == 0 or ts[0] - self.last > self.expiry
        run = np.cumsum(starts)
        first = np.searchsorted(run, run)  # of each row the first row of its run here
        sums = np.concatenate(([0.0], np.cumsum(delay)))
        n = np.arange(len(ts)) - first + 1 + np.where(run == 0, self.n, 0)
        total = sums[1:] - sums[first] + np.where(run == 0, self.total, 0.0)
        self.n, self.total, self.last = int(n[-1]), float(total[-1]), int(ts[-1])
        return pd.DataFrame({"id": ids, "ts": ts, "n": n, "mean": total / n})

    def state(self) -> tuple:
        return self.n, self.total, self.last, self.ts.tolist(), self.id.tolist(), self.delay.tolist()

    def wakes(self) -> int:
        """When the key is needed next: at its first waiting row, else when the run expires.
        (A timer wakes a key once the watermark is behind it, hence one less.)"""
        return int(self.ts.min()) - 1 if len(self.ts) else self.last + self.expiry


def running_delay(rows: DataFrame, key: str = "AIRLINE", expiry_minutes: int = EXPIRY_MINUTES,
                  watermark: str | None = WATERMARK_DELAY) -> DataFrame:
    """``key``, FLIGHT_NUMBER, event_ts, run_flights, run_avg_delay: of each streamed row of a key the flights and the mean delay
    of its run up to it. ``watermark``: None if the rows have theirs already."""
    expiry = expiry_minutes * 60_000

    def work(group: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentWatermarkMs()
        running = Running(expiry, state.get if state.exists else None)
        if not state.hasTimedOut:
            for frame in frames:
                running.add(frame["ts"].to_numpy(), frame["FLIGHT_NUMBER"].to_numpy(object), frame["DEPARTURE_DELAY"].to_numpy())
        done = running.up_to(now)
        wakes = running.wakes()
        if len(running.ts) or wakes > now:
            state.update(running.state())
            state.setTimeoutTimestamp(max(wakes, now))
        else:
            state.remove()
        if len(done):
            yield pd.DataFrame({key: group[0], "FLIGHT_NUMBER": done["id"], "ts": done["ts"], "run_flights": done["n"], "run_avg_delay": done["mean"]})

    marked = rows.withWatermark("event_ts", watermark) if watermark else rows
    narrow = marked.select(key, "FLIGHT_NUMBER", "event_ts", F.unix_millis("event_ts").alias("ts"), "DEPARTURE_DELAY")
    out = f"{key} string, FLIGHT_NUMBER string, ts long, run_flights long, run_avg_delay double"
    made = narrow.groupBy(key).applyInPandasWithState(work, out, STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return made.select(key, "FLIGHT_NUMBER", F.timestamp_millis("ts").alias("event_ts"), "run_flights", "run_avg_delay")


def running_delay_batch(rows: DataFrame, key: str = "AIRLINE", expiry_minutes: int = EXPIRY_MINUTES) -> DataFrame:
    """The same over a bounded frame, by windows."""
    in_order = Window.partitionBy(key).orderBy("event_ts", "FLIGHT_NUMBER")
    gap = F.unix_millis("event_ts") - F.unix_millis(F.lag("event_ts").over(in_order))
    runs = rows.withColumn("_run", F.sum(F.when(gap <= expiry_minutes * 60_000, 0).otherwise(1)).over(in_order))
    so_far = Window.partitionBy(key, "_run").orderBy("event_ts", "FLIGHT_NUMBER").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return runs.select(key, "FLIGHT_NUMBER", "event_ts", F.count("*").over(so_far).alias("run_flights"), F.avg("DEPARTURE_DELAY").over(so_far).alias("run_avg_delay"))
