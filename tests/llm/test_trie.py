"""The conversation trie against dictionaries of whole prefixes, and the parentheses against a scan."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import edge
from tardy.llm import trie


def rebuilt(rows):
    """conv_id -> the turns (role, text) of the rebuilt conversation."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            own[conv].append(((turn is not None, turn or 0, tie), (role, text)))
    own = {c: [t for _, t in sorted(x)] for c, x in own.items()}
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        made[c] = own.get(base, [])[:h] + turns[h:]
    return made


def brute(convs):
    members, ends, kids = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                kids[tuple(turns[:d - 1])].add(tuple(turns[:d]))
        ends[tuple(turns)].append(c)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        saved[node] = sum(saved[k] for k in kids[node]) + ((len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0)
    return edge.by_nulls((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(kids[n]), leaves[n], saved[n],
                          hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest()) for n, m in members.items())


def conversations(spark, rows):
    made = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return made.select("*", *(F.lit(i).alias(c) for i, c in enumerate(edge.CLASHING))).repartition(3)


def some(n, seed, deep=12):
    r, rows = random.Random(seed), []
    for c in range(n):
        rows += [(c, t, r.choice(("user", "assistant")), r.choice(("ja", "nein", "ü" * r.randint(0, 5)))) for t in range(r.randint(1, deep))]
    return rows


def result(df):
    return edge.collected(df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"))


def test_trie(spark):
    rows = some(80, 1)
    rows += [(200 + i, t, "user", "same") for i in range(40) for t in range(10)]  # a group of copies
    rows += [(301, 0, None, None), (302, None, "user", None), (302, None, "user", None), (302, 3, "a", "b"), (302, 3, "a", "c"), (303, 1, "", ""),
             (None, 0, "user", "x"), (None, None, None, None), (-8, 0, "user", "ja"), (-5, 0, "user", "ja"), (401, 0, "user", "long " * 20_000)]
    assert result(trie.rebuilt_trie(conversations(spark, rows))) == brute(rebuilt(rows))


@pytest.mark.parametrize("shard_nodes", [1, 7, 60])
def test_spines_of_many_shards_merge(spark, shard_nodes):
    rows = some(150, 2, 6) + [(500 + i, t, "user", f"{t}") for i in range(30) for t in range(20 + i % 3)]
    turns, convs = trie.rebuilt(conversations(spark, rows))
    assert result(trie.trie_nodes(turns, convs, shard_nodes)) == brute(rebuilt(rows))


def test_hot_nodes_beyond_the_broadcast(spark):
    rows = [(c, t, "user", "hot" if t == 0 or c % 3 == 0 else f"{c % 7}") for c in range(60) for t in range(10)]
    turns, _ = trie.rebuilt(conversations(spark, rows))
    nodes = trie.chained(turns).cache()
    want = edge.collected(trie.with_shared(nodes))
    got = trie.with_shared(nodes, 5)
    assert edge.collected(got) == want


def test_nothing(spark):
    assert trie.rebuilt_trie(conversations(spark, [])).count() == 0
    assert trie.rebuilt_trie(conversations(spark, [(None, 1, "user", "x")])).count() == 0
    one = [(7, 0, "user", "x")]
    assert result(trie.rebuilt_trie(conversations(spark, one))) == brute(rebuilt(one))


@pytest.mark.parametrize("n", [1, 5, 63, 64, 65, 1000, 20_000])
def test_findclose(n):
    r, bits, open_now, left = random.Random(n), [], 0, n
    while left or open_now:
        if left and (not open_now or r.random() < 0.55):
            bits.append(1)
            open_now, left = open_now + 1, left - 1
        else:
            bits.append(0)
            open_now -= 1
    stack, want = [], {}
    for i, b in enumerate(bits):
        if b:
            stack.append(i)
        else:
            want[stack.pop()] = i
    opens = np.flatnonzero(bits)
    assert trie.Parentheses(np.array(bits, np.uint8)).findclose(opens).tolist() == [want[i] for i in opens.tolist()]
