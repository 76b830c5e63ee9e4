"""Mixing, top-k search and web archives against plain-Python statements."""

from __future__ import annotations

import hashlib
import random
import re
from base64 import b32encode
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import edge
from tardy.llm import mixing, topk, warc


def brute_targets(sizes, weights=(3.0, 1.0, 2.0)):
    """Shares by weight; what is above twice a source's size is shared among the others, again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, free, left = {}, set(names), 1.5 * sum(sizes.values())
    while free:
        total = sum(weight[s] for s in free)
        above = {s for s in free if left * weight[s] / total > 2 * sizes[s]}
        if not above:
            return target | {s: left * weight[s] / total for s in free}
        for s in above:
            target[s] = 2.0 * sizes[s]
        left -= sum(target[s] for s in above)
        free -= above
    return target


def test_mix(spark):
    rows = edge.texts() + [(500 + i, edge.passage(i, 5 + 37 * i % 200), s) for i, s in enumerate(["hot"] * 120 + ["a", "b", "c", None] * 15)]
    docs = edge.documents(spark, rows)
    got = mixing.words_taken(docs, block_words=16).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    target = brute_targets(sizes)
    by_size = {sizes[s]: s for s in sizes}
    assert len(by_size) == len(sizes)
    taken = defaultdict(int)
    for r in got:
        s = by_size[r["source_size"]]
        assert r["target"] == pytest.approx(target[s]) and 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - target[s]) <= max(0.05 * target[s], 40), s
    again = mixing.words_taken(docs.repartition(2), block_words=16).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)


def test_mix_slots_and_texts(spark):
    rows = [(i, edge.passage(i, 3 + i % 90), "ab"[i % 3 == 0]) for i in range(200)]
    docs = edge.documents(spark, rows)
    mix = mixing.mix_sources(docs, block_words=32, shard_slots=64)
    targets = {r["source"]: r for r in mix.targets.collect()}
    slots = mix.slots.collect()
    assert sorted(r["slot"] for r in slots) == list(range(sum(t["owed"] for t in targets.values())))
    assert all(r["shard"] == r["slot"] // 64 for r in slots)
    for source, t in targets.items():
        own = [(r["epoch"], r["block"]) for r in slots if r["source"] == source]
        assert len(own) == len(set(own)) == t["owed"]  # a block once in each epoch
        whole = t["owed"] // t["blocks"]
        assert all(sum(e == x for e, _ in own) == t["blocks"] for x in range(whole))
    words = {i: t.split() for i, t, _ in rows}
    pieces = mixing.mix_texts(docs, mix).collect()
    assert all(r["words"] == words[r["doc_id"]][r["first_word"]:r["first_word"] + r["n_words"]] and r["words"] for r in pieces)
    per = defaultdict(int)
    for r in pieces:
        per[r["slot"]] += r["n_words"]
    assert max(per.values()) == 32


def test_mix_of_nothing(spark):
    assert mixing.words_taken(edge.documents(spark, []).limit(0)).count() == 0
    blank = mixing.words_taken(edge.documents(spark, [(1, None, None), (2, " ", "a"), (2, " ", "a")])).collect()
    assert sorted((r["doc_id"], r["size"], r["source_size"], r["target"], r["taken"]) for r in blank) == [(1, 0, 0, 0, 0), (2, 0, 0, 0, 0), (2, 0, 0, 0, 0)]


def brute_topk(rows, k, every, dims):
    codes = [(i, [x is not None and x > 0 for x in (e + [None] * dims)[:dims]]) for i, e in rows if i is not None and e is not None]
    out = []
    for q in sorted({i for i, _ in codes if i % every == 0}):
        best: dict = {}
        for _, own in (c for c in codes if c[0] == q):
            for i, code in codes:
                if i != q:
                    d = sum(a != b for a, b in zip(own, code))
                    best[i] = min(d, best.get(i, d))
        near = sorted((d, i) for i, d in best.items())[:k]
        out += [(q, r, i, d) for r, (d, i) in enumerate(near, 1)]
    return out


@pytest.mark.parametrize("k,dims", [(3, 24), (10, 12)])
def test_topk(spark, k, dims):
    r = random.Random(k)
    rows = [(i, [r.gauss(0, 1) for _ in range(dims)]) for i in range(80)]
    rows += [(100 + i, rows[7][1]) for i in range(40)]  # a group of copies
    rows += [(None, [1.0] * dims), (200, None), (201, []), (202, [None] * dims), (203, [1.0, None]), (10, [1.0] * dims), (10, [1.0] * dims)]
    made = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("code", F.lit(1)).withColumn("distance", F.lit("x"))
    got = topk.search(made, k=k, every=10, dims=dims, segment_bits=8)
    assert sorted(map(tuple, got.collect())) == brute_topk(rows, k, 10, dims)
    assert topk.search(made.limit(0)).count() == 0
    assert topk.search(made.limit(1), every=1).count() == 0


def pages():
    rows = [(1, "http://www.B.example.com:80/x/?b=2&a=1#f", "same"), (2, "https://b.example.com/x?a=1&b=2", "same"), (3, None, "same"), (4, "http://a.org/\r\nX: y", None),
            (5, "http://a.org", ""), (6, "u", "é\r\n\r\nWARC/1.1\r\n\r\n" * 3), (6, "u", "other"), (7, "v", "x" * 300_000), (8, "v", "dup"), (8, "v", "dup"), (None, "w", "dup"),
            (None, "w", "alone"), (9, "http://a.org/?q", "dup")]
    return rows


def brute_pages(rows, least):
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        top = max((p for p, _, h in rows if p is not None and (h or "").encode() == data), default=None)
        refers = top if len(data) >= least and top is not None and page != top else None
        out.append((page, len(data), b32encode(hashlib.sha1(data).digest()).decode(), "response" if refers is None else "revisit", refers))
    return out


@pytest.mark.parametrize("least", [0, 4])
def test_archives(spark, least, monkeypatch):
    made = spark.createDataFrame(pages(), "page_id long, url string, html string").withColumn("digest", F.lit(1)).withColumn("captured", F.lit(2)).repartition(3)
    found = warc.capture_histories(made, least_bytes=least, file_records=2)
    rows = found.collect()
    got = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows]
    assert edge.by_nulls(got) == edge.by_nulls(brute_pages(pages(), least))
    assert len({(r["archive"], r["offset"]) for r in rows}) == len(rows) and len({r["archive"] for r in rows}) > 3
    assert warc.capture_histories(made.limit(0)).count() == 0


def test_global_order(spark):
    r = random.Random(4)
    made = spark.createDataFrame([(i, f"http://h{r.randint(0, 9)}.example.com/p{r.randint(0, 30)}", f"{i}") for i in range(400)], "page_id long, url string, html string")
    runs = warc.read_runs(spark, (path := warc.scratch_path(spark, "w"), warc.write_archives(made.repartition(4), path, file_records=30))[0])
    rows = sorted(warc.merge_runs(runs, range_rows=50).collect(), key=lambda x: (x["range"], x["place"]))
    assert len(rows) == 400 and len({x["range"] for x in rows}) > 4
    keys = [(x["url_key"], x["timestamp"], x["page_id"]) for x in rows]
    assert keys == sorted(keys)


def test_loser_tree():
    r = random.Random(9)
    for n in (0, 1, 2, 3, 7, 16):
        runs = []
        for k in range(n):
            own = [(str(r.randint(0, 5)), str(r.randint(0, 3)), r.choice([None, 1, 2]), "", "", "", "", "", f"a{k}", i, 0) for i in range(r.randint(0, 20))]
            runs.append(sorted(own, key=warc.capture_order))
        assert list(warc.LoserTree(runs)) == sorted((x for run in runs for x in run), key=warc.capture_order)


def test_url_keys():
    assert warc.url_key("http://www.B.example.com:80/x/?b=2&a=1#f") == warc.url_key("https://b.example.com/x?a=1&b=2") == "com,example,b)/x?a=1&b=2"
    assert warc.url_key("http://a.org") == warc.url_key("http://a.org/") == "org,a)/"
    assert warc.url_key(None) == warc.url_key("") == "" and warc.url_key("http://u@h.com:8080/A") == "com,h:8080)/a"


def test_payload_digest_hashes_a_payload_few_times(spark):
    """Base 32 of the SHA-1 as Python has it, empty payloads and leading zeros included, from an expression that names the hash once a group."""
    import hashlib
    from base64 import b32encode

    from pyspark.sql import functions as F
    from tardy.llm.warc import sha1_base32

    texts = ["", "a", "\u00e4\u4e2d"] + [f"page {i}" for i in range(2000)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", sha1_base32(F.col("t").cast("binary")).alias("d"))
    assert {r["t"]: r["d"] for r in rows.collect()} == {t: b32encode(hashlib.sha1(t.encode()).digest()).decode() for t in texts}
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("sha1(") <= 4
