"""Rows that every operator must handle: nulls in any column, empty, blank and very
long texts, ties and repeated rows, and extra columns whose names the operators use inside."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

CLASHING = ("key", "uid", "n", "size", "spans", "score", "hits", "start", "token", "starts", "items", "n_words", "k_doc_id", "pick", "at", "block",
            "conv", "ids", "position", "digest", "url_key", "rank", "code", "distance", "_text", "slot", "toxic", "component")


def passage(seed: int, words: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 9))) for _ in range(words))


def edited(text: str, seed: int, edits: int) -> str:
    r = random.Random(seed)
    words = text.split(" ")
    for _ in range(edits):
        words[r.randrange(len(words))] = passage(r.randrange(1 << 30), 1)
    return " ".join(words)


def texts() -> list[tuple[int | None, str | None, str | None]]:
    base, shared = passage(1, 120), passage(2, 70)
    rows = [(1, base, "b"), (2, base, "a"), (3, base.upper(), "a"), (4, edited(base, 1, 2), None), (5, edited(base, 2, 4), "ä"),
            (6, edited(base, 3, 12), "b"), (7, None, "b"), (8, "", "a"), (9, " \t\n\x0b", None), (10, "one two", "b"), (11, "ONE  two\n", "b"),
            (12, "one two three four five", "b"), (None, passage(3, 30), None), (None, None, None), (None, base, "b"), (13, passage(4, 30_000), "z"),
            (14, passage(5, 40) + " " + shared + " " + passage(6, 30), "a"), (15, passage(7, 10) + "\n" + shared + "\n" + passage(8, 50), "b"),
            (16, shared, "a"), (16, shared, "a"), (17, "ha " * 300, "b"), (18, "ünï cödé " * 60, "ä"), (19, passage(9, 5) + "\x00\x01" + passage(9, 3), "b")]
    for i in range(20, 32):
        rows.append((i, edited(base, i, i % 5), "b"))
    return rows


def documents(spark, rows=None):
    """A table like documents, with extra columns."""
    rows = texts() if rows is None else rows
    made = spark.createDataFrame([(i, t, None if i is None or i % 2 else "en", s, None if t is None else len(t)) for i, t, s in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    return made.select("*", *(F.lit(i).alias(c) for i, c in enumerate(CLASHING))).repartition(3)


def collected(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is not None, str(type(x)), x if x is not None else 0) for x in r))


def by_nulls(rows) -> list[tuple]:
    return sorted(rows, key=lambda r: tuple((x is not None, str(type(x)), x if x is not None else 0) for x in r))
