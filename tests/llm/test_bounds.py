"""What tasks hold doesn't follow the data: windows of very many items, turns in small slices."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

import edge
from tardy.llm import chat, decontam


def test_a_window_of_very_many_items(spark):
    text = edge.passage(1, 10)
    bench = spark.range(100_000).select(F.col("id").alias("item_id"), F.lit(text).alias("text"))
    docs = edge.documents(spark, [(1, f"so {text} it", "a"), (2, edge.passage(2, 30), "a"), (3, text, "a"), (None, None, None)])
    want = hashlib.sha256(",".join(sorted(map(str, range(100_000)))).encode()).hexdigest()
    got = {r["doc_id"]: r for r in decontam.contamination_digest(docs, bench).collect()}
    assert got[1]["n_items"] == got[3]["n_items"] == 100_000 and got[1]["items_sha256"] == got[3]["items_sha256"] == want
    assert (got[1]["n_hit"], got[2]["n_hit"], got[2]["n_items"], got[None]["n_items"]) == (10, 0, 0, 0)
    without = {r["doc_id"]: r["n_hit"] for r in decontam.contamination(docs, bench, with_items=False).collect()}
    assert without == {i: r["n_hit"] for i, r in got.items()}


@pytest.mark.parametrize("size", [1, 60])
def test_turns_in_small_slices(spark, monkeypatch, size):
    rows = [(c, t, ("user", "assistant", "tool")[t % 3], edge.passage(10 * c + t, 1 + 7 * t % 40)) for c in range(6) for t in range(9)] + [(9, None, None, None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(2)
    want = edge.collected(chat.chat_digest(spark, turns))
    monkeypatch.setattr(chat, "SLICE_TEXT", size)
    monkeypatch.setattr(chat, "SLICE_IDS", size)
    assert edge.collected(chat.chat_digest(spark, turns)) == want and len(want) == 8
