"""Vector codes against a plain-Python statement of the contract and every entry of a codebook."""

from __future__ import annotations

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import edge
from tardy.llm import quantize


def brute(rows, rounds=2, entries=64, parts=16):
    """rows: (vec_id, vector, label) -> the sorted results and the codebooks."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    longest = -(-max((len(v) for _, v, _ in kept), default=0) // parts) * parts
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    ints = [[math.floor(256 * x) for x in v] + [0] * (longest - len(v)) for _, v, _ in kept]
    width = longest // parts
    cut = [[tuple(v[p * width:(p + 1) * width]) for p in range(parts)] for v in ints]
    books = [[v[p] for v in cut[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, y)), e) for e, y in enumerate(books[p]))

    for _ in range(rounds):
        groups = defaultdict(list)
        for v in cut:
            for p, x in enumerate(v):
                groups[p, nearest(p, x)[1]].append(x)
        for (p, e), xs in groups.items():
            books[p][e] = tuple(sum(c) // len(xs) for c in zip(*xs))
    found = [[nearest(p, x) for p, x in enumerate(v)] for v in cut]
    error = [sum(d for d, _ in f) for f in found]
    by_label = defaultdict(int)
    for (_, _, label), e in zip(kept, error):
        by_label[label] += e
    digest = hashlib.sha256(",".join(str(x) for b in books for y in b for x in y).encode()).hexdigest()
    return edge.by_nulls((r[0], "".join(f"{e:02x}" for _, e in f), e, by_label[r[2]], digest) for r, f, e in zip(kept, found, error))


def vectors(spark, rows, kind="float"):
    made = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")
    return made.select("*", *(F.lit(i).alias(c) for i, c in enumerate(edge.CLASHING) if c != "embedding")).repartition(3)


def single(x):
    return float(np.float32(x))


def some(n, seed, dims=32):
    r = random.Random(seed)
    return [(i, [single(r.gauss(0, 0.4)) for _ in range(dims)], r.choice((1, 1, 1, 2, None))) for i in range(n)]


def test_codes(spark):
    rows = some(300, 1)
    same = rows[7][1]
    rows += [(900 + i, same, 5) for i in range(120)]  # a group of copies
    rows += [(7, rows[8][1], 1), (7, same, 1), (None, rows[3][1], None), (None, None, None), (1000, None, 1), (1001, [0.0] * 31 + [None], 1),
             (1002, [float("nan")] * 32, 1), (1003, [float("inf")] + [0.0] * 31, 1), (1004, [0.5] * 20, 2), (1005, [], 2), (-5, [single(-0.001)] * 32, 2)]
    assert edge.collected(quantize.codes_digest(vectors(spark, rows))) == brute(rows)


@pytest.mark.parametrize("n", [1, 5])
def test_few_rows(spark, n):
    rows = [(None if n == 1 else i, [0.25 * i] * 16, None) for i in range(n)]
    assert edge.collected(quantize.codes_digest(vectors(spark, rows))) == brute(rows)


def test_empty_vectors_and_tables(spark):
    rows = [(1, [], 1), (2, [], 1)]
    assert edge.collected(quantize.codes_digest(vectors(spark, rows))) == brute(rows)
    assert quantize.codes_digest(vectors(spark, [])).count() == 0


def test_too_large(spark):
    with pytest.raises(Exception, match="too large"):
        quantize.train(vectors(spark, [(1, [1e30] * 16, 1)]))


def test_joined_labels_beyond_the_bound(spark, monkeypatch):
    rows = some(60, 3)
    monkeypatch.setattr(quantize, "BROADCAST_LABELS", 0)
    assert edge.collected(quantize.codes_digest(vectors(spark, rows, "double"))) == brute(rows)


@pytest.mark.parametrize("spread", [0, 1, 3, 40, 100_000])
def test_nearest_is_exact(spread):
    """Ties, equal entries, far parts and every kind of first radius."""
    r = np.random.default_rng(spread)
    for n, width in ((1, 1), (3, 4), (64, 4), (64, 2), (64, 0)):
        entries = r.integers(-spread, spread + 1, (n, width))
        x = r.integers(-3 * spread, 3 * spread + 1, (500, width))
        distance = ((x[:, None] - entries[None]) ** 2).sum(2)
        entry, best = quantize.Slices(entries).nearest(x)
        assert (entry == distance.argmin(1)).all() and (best == distance.min(1)).all()


def test_cubes_rule_most_entries_out():
    r = np.random.default_rng(2)
    part = quantize.Slices(r.integers(-128, 128, (64, 4)))
    masks = part.within(r.integers(-128, 128, (2000, 4)), np.full(2000, part.radius))
    assert np.mean([int(m).bit_count() for m in masks]) < 12


def test_decoded(spark):
    made = vectors(spark, some(80, 4))
    books = quantize.train(made)
    coded = quantize.encode(made, books)
    error = {r["vec_id"]: r["error"] for r in coded.collect()}
    near = {r["vec_id"]: r["embedding"] for r in quantize.decode(coded, books).collect()}
    for i, v, _ in some(80, 4):
        assert sum((math.floor(256 * x) - round(256 * y)) ** 2 for x, y in zip(v, near[i])) == error[i]
