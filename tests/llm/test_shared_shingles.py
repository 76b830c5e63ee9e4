"""The filter of sets without a partner, the sketch's size, and which copy stays however rows are dealt."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import edge
from tardy.llm import jaccard


@pytest.mark.parametrize("top", [1, 200, 70_000, (1 << 30) - 1])
def test_differences_in_few_bytes(top):
    rests = np.sort(np.random.default_rng(top).integers(0, top + 1, 500)).astype("<u4")
    packed = jaccard.planes(rests)
    assert (jaccard.from_planes(packed) == rests).all() and len(packed) <= 1 + 500 * ((top.bit_length() + 7) // 8)


@pytest.mark.parametrize("chunk", [200, 1_000_000])
def test_shared_counts_are_exact(spark, monkeypatch, chunk):
    """Against a count over all sets; with chunks so small that copies lie in several."""
    monkeypatch.setattr(jaccard, "CHUNK_SHINGLES", chunk)
    rows = [r for r in edge.texts() if r[1] and r[1].strip()]
    docs = edge.documents(spark, rows)
    keys = jaccard.counted_keys(jaccard.document_keys(docs, 5)).cache()
    sets = {}
    for _, text, _ in rows:
        hashes, of, sequence = jaccard.shingle_sets(pa.array([text.encode()]), 5)
        sets[int(sequence.view(np.int64)[0])] = set(hashes.tolist())
    uid_of = {(r["chunk"], r["place"]): r["uid"] for r in keys.where("place is not null").collect()}
    seen = Counter(h for u in uid_of.values() for h in sets[u])
    got = {(r["chunk"], r["place"]): r["shared"] for r in jaccard.shared_counts(keys).collect()}
    assert set(uid_of.values()) == set(sets)
    assert {k: got.get(k, 0) for k in uid_of} == {k: sum(seen[h] > 1 for h in sets[u]) for k, u in uid_of.items()}


def test_only_sets_that_may_link_meet(spark):
    base = edge.passage(1, 120)
    shared = edge.passage(2, 30)
    rows = [(1, base, "a"), (2, edge.edited(base, 1, 1), "a")] + [(10 + i, edge.passage(50 + i, 100) + " " + shared, "b") for i in range(30)]
    docs = edge.documents(spark, rows)
    keys = jaccard.counted_keys(jaccard.document_keys(docs, 5)).cache()
    bitmap = jaccard.partnered(keys, 75, 100)
    level = jaccard.rarity_levels(jaccard.sketch_rows(docs, bitmap, 5))
    may = {r["uid"] for r in jaccard.prefixes(docs, bitmap, level, 5, 75, 100).collect()}
    uid = {r["doc_id"]: r["uid"] for r in keys.where("uid is not null").collect()}
    assert may == {uid[1], uid[2]}  # a passage that thirty texts share makes no candidates


def test_the_sketch_is_as_large_as_its_texts(spark):
    """Over many small tasks: rows of pairs, not whole rows of slots."""
    rows = [(i, edge.passage(i, 60), "a") for i in range(400)]
    docs = edge.documents(spark, rows).repartition(100)
    everything = np.full(jaccard.FILTER_BITS // 32, 0xFFFFFFFF, "<u4")
    sketch = jaccard.sketch_rows(docs, everything, 5)
    assert sketch.agg(F.sum(F.octet_length("counts"))).first()[0] < sum(len(t) for _, t, _ in rows)
    dense = sum(np.bincount((jaccard.shingle_sets(pa.array([t.encode()]), 5)[0] & np.uint64(jaccard.SKETCH_SLOTS - 1)).astype(np.int64), minlength=jaccard.SKETCH_SLOTS) for _, t, _ in rows)
    got = np.zeros(jaccard.SKETCH_SLOTS, np.int64)
    for r in sketch.collect():
        got[r["slot"] * jaccard.SKETCH_ROW:][:jaccard.SKETCH_ROW] += jaccard.slot_counts(r["counts"])
    assert (got == dense).all()


def test_the_copy_that_stays_does_not_depend_on_partitions(spark):
    text = edge.passage(3, 80)
    rows = spark.range(400).select(F.lit(5).cast("long").alias("doc_id"), F.lit(text).alias("text"), ((F.col("id") * 7919) % 400 + 3).alias("source"))
    other = spark.createDataFrame([(6, edge.edited(text, 1, 1), 0), (7, None, 9), (7, None, 8)], "doc_id long, text string, source long")
    for parts in (1, 7, 40):
        got = jaccard.one_of_each(rows.unionByName(other).repartition(parts))
        assert sorted((r["doc_id"], r["source"]) for r in got.collect()) == [(5, 3), (7, 8), (7, 9)]


def test_columns_of_any_name(spark):
    names = ("row", "key", "kept_id", "kept_key", "choose", "nth", "_own_key", "copies", "component", "a.b")
    docs = spark.createDataFrame([(1, edge.passage(1, 40)), (2, edge.passage(1, 40)), (3, None)], "doc_id long, text string")
    docs = docs.select("*", *(F.lit(i).alias(n) for i, n in enumerate(names)))
    got = jaccard.one_of_each(docs)
    assert got.columns == docs.columns and sorted(r["doc_id"] for r in got.collect()) == [1, 3]
