"""Packing against best fit one piece at a time, and token ids against the tokenizers library."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import edge
from tardy.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(packing.tokenizer_file())


def one_by_one(lengths, limit):
    """Best-fit decreasing, a piece at a time over a plain list: the rooms that are left."""
    rooms = []
    for length in sorted(lengths, reverse=True):
        fits = [(room, i) for i, room in enumerate(rooms) if room >= length]
        if fits:
            rooms[min(fits)[1]] -= length
        else:
            rooms.append(limit - length)
    return sorted(rooms)


@pytest.mark.parametrize("limit", [1, 16, 50, 64])
def test_plan_is_best_fit_decreasing(limit):
    r = random.Random(limit)
    for n in (0, 1, 4, 90, 700):
        counts = Counter(min(limit, 1 + int(r.expovariate(3 / limit))) if n % 2 else r.randint(1, limit) for _ in range(n))
        plan = packing.best_fit(counts, limit)
        held = defaultdict(list)
        for length, number in counts.items():
            for sequence, offset in zip(*plan.place(np.full(number, length), np.arange(number))):
                held[int(sequence)].append((int(offset), length))
        for pieces in held.values():
            at = 0
            for offset, length in sorted(pieces):
                assert offset == at
                at += length
        assert sorted(limit - sum(n for _, n in x) for x in held.values()) == one_by_one(counts.elements(), limit)
        assert set(held) == set(range(plan.sequences))


def test_plan_size_is_that_of_the_histogram():
    plan = packing.best_fit({length: 10**12 + length for length in range(1, 1025)})
    assert len(plan.rank) < 10_000 and plan.sequences * 1024 >= sum(n * (10**12 + n) for n in range(1, 1025))


TEXTS = ["", " ", "\n" * 3000 + "x", " " * 100_000, "a" * 50_000, "<|endoftext|> a <|endoftext|><|endoftext|>b", "don't WE'LL 'tis 123456 ١٢٣",
         "ünï cödé 日本語 \U0001f600 é \x00\x01    x", "a  b   c\t\n d \r\n "]


def test_ids_are_those_of_the_library(tokenizer):
    r = random.Random(3)
    texts = TEXTS + ["".join(chr(r.choice((32, 10, 9, 39, 48, 65, 97, 0xE9, 0x4E2D, 0x1F600, 0xA0, 0x2003))) for _ in range(200)) for _ in range(100)]
    with open(packing.tokenizer_file(), encoding="utf-8") as f:
        encoder = packing.Encoder(f.read())
    for text in texts + [t for _, t, _ in edge.texts() if t]:
        assert encoder.ids(text).tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 2], text[:40]


@pytest.mark.parametrize("limit", [7, 1024])
def test_packed(spark, tokenizer, limit):
    rows = edge.texts() + [(400 + i, t, "hot") for i, t in enumerate(TEXTS[:3] * 20)]
    packed = packing.pack(edge.documents(spark, rows), limit, with_ids=True)
    want = Counter()
    for doc_id, text, _ in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        ends = packing.bounds(len(ids), limit)
        assert all(b - a == limit for a, b in zip(ends[1:], ends[2:])) and 0 < ends[1] <= limit
        want.update((doc_id, i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()), tuple(ids[a:b])) for i, (a, b) in enumerate(zip(ends, ends[1:])))
    got = packed.collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], tuple(r["ids"])) for r in got) == want
    held = defaultdict(dict)
    for r in got:
        assert r["offset"] not in held[r["sequence_id"]]
        held[r["sequence_id"]][r["offset"]] = r["ids"]
    joined = {q: [x for at in sorted(parts) for x in parts[at]] for q, parts in held.items()}
    assert all(sum(len(parts[a]) for a in parts if a < at) == at for parts in held.values() for at in parts)
    assert sorted(limit - len(ids) for ids in joined.values()) == one_by_one([r["length"] for r in got], limit)
    assert {r["sequence_id"]: list(r["ids"]) for r in packing.sequences(packed).collect()} == joined


def test_nothing_to_pack(spark):
    assert packing.pack(edge.documents(spark, []).limit(0)).count() == 0
