"""Benchmark decontamination: a prefix-filtered join of item windows with documents.

Method
    A window is ``window_words`` consecutive words of an item (an item of fewer, but
    not none, is one window). A window occurs in a document only if all its words do,
    so with containment 1 the necessary prefix of its words, ordered by rarity, is its
    rarest one. Counts of the windows' words over all documents give that order. The
    documents' words are joined with the prefix words; each match proposes one start
    for the window. Length and position bounds (the window must lie within the
    document, and its second rarest word must stand where the window has it) cut the
    proposals, and the rest are verified word by word on the text.

    The benchmark is a stated query set: its distinct windows are handled in blocks of
    at most ``block_windows``, one pass over the documents to count and one to join per
    block. So what is shipped to the tasks has a fixed bound, at any benchmark size.

Words: maximal runs of digits, a-z and non-ASCII characters after A-Z are lower-cased.

Defined cases
    Null texts have no words: as documents they are never hit, as items they have no
    window. Items with a null item_id count as one item whose id reads ''. Items with
    equal windows are all reported. Repeated rows are rows of their own. An empty
    benchmark or table gives zero hits or no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tardy.llm.words import ALPHANUMERIC, slices, words_of
from tardy.session import materialize

WINDOW_WORDS = 10
BLOCK_WINDOWS = 100_000
#: Java form of the fixed word pattern.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_column(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(f"({WORD})"), F.lit(1))


def item_windows(benchmark: DataFrame, window_words: int = WINDOW_WORDS) -> tuple[DataFrame, DataFrame]:
    """(window_id, words) of the distinct windows, and (window_id, item) of the items that have them."""
    words = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                             words_column(F.col("text")).alias("w")).where("size(w) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window_words + 1, F.lit(1)))
    cut = words.select("item", F.explode(F.transform(starts, lambda s: F.slice("w", s, window_words))).alias("words"))
    windows = materialize(cut.select("words").distinct().withColumn("window_id", F.monotonically_increasing_id()), "decontam-windows")
    return windows, cut.join(windows, "words").select("window_id", "item").distinct()


class Windows:
    """A block of windows, ready for the tasks."""

    def __init__(self, rows: list) -> None:
        self.words = [tuple(w.encode() for w in r["words"]) for r in rows]
        self.ids = [r["window_id"] for r in rows]
        vocabulary = sorted({w for words in self.words for w in words})
        self.hashes = words_of(pa.array([b" ".join(vocabulary)], pa.binary()), ALPHANUMERIC).hashes()
        order = np.argsort(self.hashes)
        self.sorted_hashes = self.hashes[order]
        self.place = {w: int(p) for p, w in zip(np.argsort(order), vocabulary)}  # in sorted_hashes

    def number(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each word in the vocabulary, or -1."""
        if not len(self.sorted_hashes):
            return np.full(len(hashes), -1)
        at = np.searchsorted(self.sorted_hashes, hashes)
        at[at == len(self.sorted_hashes)] = 0
        return np.where(self.sorted_hashes[at] == hashes, at, -1)

    def order(self, counts: np.ndarray) -> None:
        """For each window its two rarest words: (place, offset), ties by place and offset."""
        self.by_first: dict[int, list[tuple[int, int, int, int]]] = {}
        for k, words in enumerate(self.words):
            ranked = sorted((int(counts[self.place[w]]), self.place[w], i) for i, w in enumerate(words))
            (_, first, i), (_, second, j) = ranked[0], ranked[min(1, len(ranked) - 1)]
            self.by_first.setdefault(first, []).append((k, i, second, j))
        self.firsts = np.zeros(len(self.sorted_hashes), bool)
        self.firsts[list(self.by_first)] = True


def window_word_counts(docs: DataFrame, windows: Windows) -> np.ndarray:
    """Over all documents, how often each word of the block's vocabulary occurs."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(windows.sorted_hashes), np.int64)
        for rows in slices(batches, "text"):
            found = windows.number(words_of(rows.column(0), ALPHANUMERIC).hashes())
            total += np.bincount(found[found >= 0], minlength=len(total))
        place = np.flatnonzero(total)
        yield pa.record_batch({"place": place, "n": total[place]})

    rows = docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(count, "place long, n long")
    counts = np.zeros(len(windows.sorted_hashes), np.int64)
    for r in rows.groupBy("place").agg(F.sum("n").alias("n")).collect():  # at most the block's vocabulary
        counts[r["place"]] = r["n"]
    return counts


FOUND = "n_words long, starts array<int>, lengths array<int>, windows array<long>"


def join_windows(docs: DataFrame, windows: Windows, kept: list[str]) -> DataFrame:
    """The ``kept`` columns, n_words, and the verified occurrences of windows: first
    words in the document, lengths in words, and the ids of the windows."""
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "_words_text"):
            words = words_of(rows.column(0), ALPHANUMERIC)
            number = windows.number(words.hashes())
            found: list[list[tuple[int, int]]] = [[] for _ in range(rows.num_rows)]
            ids: list[set[int]] = [set() for _ in range(rows.num_rows)]
            known = np.flatnonzero(number >= 0)
            matches = known[windows.firsts[number[known]]]
            of = np.searchsorted(words.first, matches, side="right") - 1
            for at, doc in zip(matches.tolist(), of.tolist()):
                low, high = int(words.first[doc]), int(words.first[doc + 1])
                for k, i, second, j in windows.by_first[int(number[at])]:
                    start, want = at - i, windows.words[k]
                    if start < low or start + len(want) > high or number[start + j] != second:
                        continue
                    if all(words.text(start + x) == w for x, w in enumerate(want)):
                        found[doc].append((start - low, len(want)))
                        ids[doc].add(windows.ids[k])
            names = [*kept, "n_words", "starts", "lengths", "windows"]
            yield pa.record_batch([*rows.columns[1:], pa.array(words.counts, pa.int64()),
                                   *(pa.array([[x[c] for x in f] for f in found], pa.list_(pa.int32())) for c in (0, 1)),
                                   pa.array([sorted(x) for x in ids], pa.list_(pa.int64()))], names=names)

    rows = docs.select(F.col("text").cast("binary").alias("_words_text"), *kept)
    schema = ", ".join(f"`{n}` {kind}" for n, kind in rows.drop("_words_text").dtypes)
    return rows.mapInArrow(join, f"{schema}, {FOUND}")


def hit_words(starts: Column, lengths: Column) -> Column:
    """How many words the occurrences cover; they are merged in order of their starts."""
    pairs = F.array_sort(F.arrays_zip(starts.alias("s"), lengths.alias("n")))
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("hit"))
    return F.aggregate(pairs, zero, lambda a, x: F.struct(
        F.greatest(a["end"], x["s"] + x["n"]).alias("end"),
        (a["hit"] + F.greatest(x["s"] + x["n"] - F.greatest(a["end"], x["s"]), F.lit(0))).alias("hit")))["hit"]


def contamination(docs: DataFrame, benchmark: DataFrame, kept: tuple[str, ...] = ("doc_id",), window_words: int = WINDOW_WORDS,
                  block_windows: int = BLOCK_WINDOWS, with_items: bool = True) -> DataFrame:
    """The ``kept`` columns of the documents with n_words, n_hit (words inside an
    occurrence of a window) and, ``with_items``, items (sorted ids, as strings, of the items with
    occurring windows); one row per document."""
    cut, items = item_windows(benchmark, window_words)
    total = cut.count()
    blocks = 1 if total <= block_windows else -(-total // (block_windows // 2))  # hashed: half of the bound on average
    names = list(dict.fromkeys(kept))
    none = {"n_words": F.lit(0).cast("long"), "starts": F.array().cast("array<int>"), "lengths": F.array().cast("array<int>"),
            "windows": F.array().cast("array<long>")}
    rows = docs.select(F.col("text").alias("_text"), *(F.col(n).alias(f"k_{n}") for n in names))
    for b in range(blocks):
        part = cut if blocks == 1 else cut.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == b)
        windows = Windows(part.collect())
        texts = rows.withColumnRenamed("_text", "text")
        windows.order(window_word_counts(texts, windows))
        before = [c for c in rows.columns if c.startswith(("k_", "all_"))]
        text = [] if b == blocks - 1 else ["text"]  # further blocks read it again
        rows = join_windows(texts, windows, [*before, *text])
        for c in none:
            old = F.col(f"all_{c}") if b else none[c]
            new = F.col(c) if c == "n_words" else F.concat(old, F.col(c))
            rows = rows.withColumn(f"all_{c}", new)
        rows = rows.drop(*none).withColumnRenamed("text", "_text")
        if text:
            rows = materialize(rows, "decontam-block")
    found = rows.select(*(f"k_{n}" for n in names), F.col("all_n_words").alias("n_words"),
                        hit_words(F.col("all_starts"), F.col("all_lengths")).alias("n_hit"), F.col("all_windows").alias("windows"))
    own = [F.col(f"k_{n}").alias(n) for n in names]
    if not with_items:
        return found.select(*own, "n_words", "n_hit")
    found = materialize(found.withColumn("number", F.monotonically_increasing_id()), "decontam-found")
    hits = found.select("number", F.explode("windows").alias("window_id")).join(items, "window_id")
    per = hits.groupBy("number").agg(F.sort_array(F.collect_set("item")).alias("items"))
    return found.join(per, "number", "left").select(*own, "n_words", "n_hit", F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def contamination_digest(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = contamination(docs, benchmark, **options)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


#: DuckDB: every position of every document against the windows of that length.
SQL = r"""
WITH item AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item, array_to_string(w[s:s + 9], ' ') AS txt, least(len(w), 10) AS n
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM item WHERE len(w) > 0)),
doc AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
spot AS (
  SELECT r, n, s, array_to_string(w[s:s + n - 1], ' ') AS txt
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM doc, (SELECT DISTINCT n FROM win))),
occ AS (SELECT spot.r, spot.s, spot.n, win.item FROM spot JOIN win USING (n, txt)),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM occ) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM occ) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (r) LEFT JOIN its USING (r)
"""
