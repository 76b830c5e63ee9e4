"""Repeated windows of more bytes than 8 bits hold windows of a segment."""

from __future__ import annotations

import edge
import pytest
from tardy.llm import repeats
from test_sets import brute_repeats


def test_long_windows(spark):
    shared = edge.passage(70, 400)
    rows = [(i, edge.passage(80 + i, 90) + shared + edge.passage(90 + i, 90), "s") for i in range(4)] + [(9, edge.passage(99, 500), "s")]
    got = edge.collected(repeats.repeats_digest(edge.documents(spark, rows), window=900))
    assert [tuple(r) for r in got] == edge.by_nulls(brute_repeats(rows, 900))


def test_bits():
    most = 254 + repeats.gram_bytes(300)  # 255 windows hold one gram
    assert repeats.place_bits(repeats.WINDOW) == 8 and repeats.place_bits(most) == 8 and repeats.place_bits(most + 1) == 9
    with pytest.raises(ValueError):
        repeats.place_bits(1 << 17)


@pytest.mark.parametrize("window", [16, 40, 64, 127, 128])
def test_short_windows(spark, window):
    rows = edge.texts()
    got = edge.collected(repeats.repeats_digest(edge.documents(spark, rows), window=window))
    assert [tuple(r) for r in got] == edge.by_nulls(brute_repeats(rows, window))
