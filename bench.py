"""Benchmark the headline queries.

Runs on ``local[$BENCH_CPUS]`` against ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1). Each query is executed in full through the ``noop``
sink (no rows collected to the driver). After one untimed warm-up pass over
all queries (reported as ``cold_sec``), the time per query is the median of
``$BENCH_REPEAT`` warm runs. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tardy.plans import catalogue  # noqa: E402
from tardy.session import local_session  # noqa: E402

HEADLINE = [
    "gold_daily",
    "enrich_left_joins",
    "silver_partitioned_roundtrip",
    "enrichment_diagnostics",
    "gold_window_batch",
    "gold_window_stream",
    "sample_exact_n",
    "chunk_export",
]


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    catalogue.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def stream_stats(spark, sf_dir: str) -> dict:
    """Throughput and state size of the stream job on the whole stream fixture."""
    from tardy.plans import batch
    from tardy.session import scratch_path
    from tardy.streaming.pipeline import StreamJob

    inputs = batch.testdata_inputs(spark, sf_dir, stream=True)
    job = StreamJob(input_dir=catalogue._stream_input(spark, sf_dir),
                    checkpoint=scratch_path(spark, "bench-ckpt"),
                    gold_path=scratch_path(spark, "bench-gold"), max_files_per_trigger=None)
    t0 = time.perf_counter()
    q = job.start(spark, inputs.airlines, inputs.airports)
    q.awaitTermination()
    wall = time.perf_counter() - t0
    progress = q.recentProgress
    rows = sum(p["numInputRows"] for p in progress)
    trigger_ms = sum(p["durationMs"].get("triggerExecution", 0) for p in progress)
    state = [o["numRowsTotal"] for p in progress for o in p.get("stateOperators", [])]
    return {
        "input_rows": rows,
        "micro_batches": len(progress),
        "rows_per_sec_trigger": round(rows / (trigger_ms / 1000), 1) if trigger_ms else None,
        "rows_per_sec_wall": round(rows / wall, 1),
        "peak_state_rows": max(state) if state else 0,
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    wanted = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    spark = local_session(cpus, app="tardy-bench",
                          **{"spark.sql.shuffle.partitions": str(cpus)})
    cold = {q: run_once(spark, q, sf_dir) for q in wanted}  # JVM / JIT / codegen warm-up pass
    per_query, runs = {}, {}
    for q in wanted:
        times = [run_once(spark, q, sf_dir) for _ in range(repeat)]
        per_query[q] = round(statistics.median(times), 3)
        runs[q] = [round(t, 2) for t in times]
    stream = stream_stats(spark, sf_dir) if "gold_window_stream" in wanted else None
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_total_median_sec",
        "value": round(sum(per_query.values()), 3),
        "unit": "sec",
        "queries": per_query,
        "cold_sec": {k: round(v, 3) for k, v in cold.items()},
        "runs": runs,
        "stream": stream,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
        "repeat": repeat,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
