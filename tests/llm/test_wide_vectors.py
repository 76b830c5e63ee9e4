"""Top-k search over vectors of more dimensions than the default, against every pair."""

from __future__ import annotations

import random

from tardy.llm import topk


def test_all_dimensions_count(spark):
    r = random.Random(5)
    vectors = {i: [r.choice((-1.0, 1.0)) for _ in range(100 if i % 3 else 90)] for i in range(60)}
    vectors |= {60 + i: [1.0] * 64 + [r.choice((-1.0, 1.0)) for _ in range(36)] for i in range(40)}  # alike in the first 64
    made = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    bits = {i: [x > 0 for x in v] + [False] * (100 - len(v)) for i, v in vectors.items()}
    want = set()
    for q in (x for x in vectors if x % 10 == 0):
        near = sorted((sum(a != b for a, b in zip(bits[q], bits[v])), v) for v in vectors if v != q)[:5]
        want |= {(q, rank, v, d) for rank, (d, v) in enumerate(near, 1)}
    assert {tuple(x) for x in topk.search(made, k=5, every=10).collect()} == want
