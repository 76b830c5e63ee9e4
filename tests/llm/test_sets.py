"""Near duplicates, repeated windows and decontamination against plain-Python statements."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pytest

import edge
from tardy.llm import decontam, jaccard, repeats


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute_components(rows):
    sets = []
    for _, text, _ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    group = list(range(len(rows)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                group[root(i)] = root(j)
    least = {}
    for i, (doc_id, _, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return [(r[0], len(s), least.get(root(i)) if s else r[0]) for i, (r, s) in enumerate(zip(rows, sets))]


def chains(n=60):
    """Texts that link only through each other, and clusters that share a passage."""
    rows, text = [], edge.passage(100, 80)
    for i in range(n):
        rows.append((1000 + i, text, "c"))
        text = edge.edited(text, 500 + i, 2)
    shared = edge.passage(200, 30)
    for c in range(12):
        base = shared + " " + edge.passage(300 + c, 25)
        rows += [(2000 + 10 * c + i, edge.edited(base, 7 * c + i, i % 3), "c") for i in range(6)]
    return rows


@pytest.mark.parametrize("batch", [3, 10_000])
def test_components(spark, batch):
    rows = edge.texts() + chains()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = edge.collected(jaccard.components_of(edge.documents(spark, rows)))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [tuple(r) for r in got] == edge.by_nulls([(i, n, c) for i, n, c in brute_components(rows)])


def test_components_with_tiny_bounds(spark, monkeypatch):
    """Parts, nodes and blocks of two or three rows, and shuffles instead of broadcasts, change nothing."""
    rows = edge.texts() + chains()
    for name, value in (("PART_SETS", 3), ("NODE_SETS", 2), ("BLOCK_ROOTS", 2), ("BROADCAST_ROWS", 0)):
        monkeypatch.setattr(jaccard, name, value)
    for f, defaults in ((jaccard.verified, (3,)), (jaccard.tree_candidates, (2,)), (jaccard.root_pairs, (2,)), (jaccard.small_side, (0,))):
        monkeypatch.setattr(f, "__defaults__", defaults)
    got = edge.collected(jaccard.components_of(edge.documents(spark, rows)))
    assert [tuple(r) for r in got] == edge.by_nulls(brute_components(rows))


def test_one_of_each(spark):
    rows = edge.texts()
    kept = jaccard.one_of_each(edge.documents(spark, rows))
    assert kept.columns == edge.documents(spark, rows).columns
    got = Counter((r["doc_id"], r["text"]) for r in kept.select("doc_id", "text").collect())
    found = brute_components(rows)
    blank = Counter((i, t) for (i, t, _), (_, n, _) in zip(rows, found) if not n)
    firsts = {c for _, n, c in found if n and c is not None}
    assert all(got[k] == n for k, n in blank.items())
    assert sorted(i for (i, t), n in got.items() for _ in range(n) if (i, t) not in blank and i is not None) == sorted(firsts)


def brute_repeats(rows, window):
    data = [(t or "").encode() for _, t, _ in rows]
    seen = Counter(d[s:s + window] for d in data for s in range(len(d) - window + 1))
    out = []
    for (doc_id, _, _), d in zip(rows, data):
        gone = bytearray(len(d))
        for s in range(len(d) - window + 1):
            if seen[d[s:s + window]] > 1:
                gone[s:s + window] = b"\1" * window
        runs = len(re.findall(rb"\x01+", bytes(gone)))
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((doc_id, len(d), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("window,hot", [(200, 4096), (64, 2)])
def test_repeats(spark, monkeypatch, window, hot):
    monkeypatch.setattr(repeats, "PIECE_BYTES", 20_000)
    monkeypatch.setattr(repeats, "SORT_SEGMENTS", 5)
    rows = edge.texts()
    got = edge.collected(repeats.repeats_digest(edge.documents(spark, rows), window=window, hot_segments=hot))
    assert [tuple(r) for r in got] == edge.by_nulls(brute_repeats(rows, window))


def brute_windows(rows, items):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))

    windows = {}
    for item, text in items:
        w = words(text)
        for s in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[s:s + 10]), set()).add("" if item is None else str(item))
    out = []
    for doc_id, text, _ in rows:
        w = words(text)
        hit, found = set(), set()
        for s in range(len(w)):
            for n in {len(x) for x in windows}:
                key = tuple(w[s:s + n])
                if len(key) == n and key in windows:
                    hit |= set(range(s, s + n))
                    found |= windows[key]
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


@pytest.mark.parametrize("block", [100_000, 20])
def test_contamination(spark, block):
    base, shared = edge.passage(1, 120), edge.passage(2, 70)
    items = [(1, " ".join(base.split()[20:45])), (2, " ".join(shared.split()[5:15]).upper() + "!"), (3, "One-two"), (4, None), (5, ""), (None, "ha ha ha"),
             (6, edge.passage(77, 30)), (7, " ".join(base.split()[20:45])), (10, "ünï cödé " * 7)]
    rows = edge.texts()
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, words int")
    got = edge.collected(decontam.contamination_digest(edge.documents(spark, rows), bench, block_windows=block))
    assert [tuple(r) for r in got] == edge.by_nulls(brute_windows(rows, items))


def test_empty_tables(spark):
    none = edge.documents(spark, []).limit(0)
    bench = spark.createDataFrame([], "item_id long, text string")
    assert jaccard.components_of(none).count() == 0 == repeats.repeats_digest(none).count()
    assert decontam.contamination_digest(none, bench).count() == 0
    found = decontam.contamination_digest(edge.documents(spark), bench)
    assert found.where("contaminated or n_items > 0").count() == 0 and found.count() == len(edge.texts())
