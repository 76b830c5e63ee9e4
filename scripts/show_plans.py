"""Print the physical operator trees of the headline queries (expressions
trimmed), as recorded in docs/PLANS.md.

Usage: python scripts/show_plans.py [sf_dir] > docs/PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tardy.plans import batch, catalogue  # noqa: E402
from tardy.session import local_session, scratch_path  # noqa: E402
from tardy.streaming.pipeline import StreamJob  # noqa: E402

_KEEP = re.compile(r"^([ :|+\-]*)(\*\(\d+\) )?([A-Za-z][A-Za-z ]*?)(?=[\[( ]|$)(.*)$")


def tree(plan: str, width: int = 110) -> str:
    out = []
    for line in plan.split("== Initial Plan ==")[0].splitlines():
        m = _KEEP.match(line)
        if not m:
            continue
        prefix, codegen, name, rest = m.groups()
        detail = ""
        for tag in ("PartitionFilters: [", "PushedFilters: [", "ReadSchema: "):
            if tag in rest:
                start = rest.index(tag)
                end = rest.find("]", start) + 1 if tag.endswith("[") else rest.find(", ", start)
                detail += " " + rest[start:end if end > start else None][:90]
        if name.startswith(("Exchange", "WindowGroupLimit", "BroadcastHashJoin")):
            detail = " " + rest[:70] + detail
        limit = width + 200 if name.startswith("FileScan") else width
        out.append((prefix + (codegen or "") + name.strip() + detail)[:limit])
    return "\n".join(out)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    print("# Physical plans of the headline queries\n")
    print(f"Generated by `scripts/show_plans.py` on `{sf}` (local[8], AQE on; final adaptive")
    print("plans after execution). Expressions are trimmed; `*(n)` marks whole-stage codegen.\n")
    for name in ["gold_daily", "dedup_first", "enrichment_diagnostics", "gold_window_batch",
                 "partition_pruned_scan"]:
        df = catalogue.QUERIES[name](spark, sf)
        df.collect()  # run it, so the adaptive plan below is the final one
        print(f"## {name}\n\n```\n{tree(df._jdf.queryExecution().executedPlan().toString())}\n```\n")
    inputs = batch.testdata_inputs(spark, sf, stream=True)
    job = StreamJob(input_dir=catalogue._stream_input(spark, sf),
                    checkpoint=scratch_path(spark, "plan-ckpt"),
                    gold_path=scratch_path(spark, "plan-gold"), max_files_per_trigger=None)
    q = job.start(spark, inputs.airlines, inputs.airports)
    q.awaitTermination()
    plan = q._jsq.explainInternal(False)
    print(f"## gold_window_stream (last micro-batch)\n\n```\n{tree(plan)}\n```")


if __name__ == "__main__":
    main()
