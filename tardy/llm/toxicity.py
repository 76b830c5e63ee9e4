"""Toxicity scores from a learned lexicon, matched with misspellings in context.

Method
    ``train`` learns a lexicon from labelled rows: words, and stems (the first
    characters of words), that occur almost only in toxic documents. ``Lexicon`` keeps
    it as a trie. A Levenshtein automaton of each word (its reachable positions as bit
    sets, one per number of edits) runs along the trie, so one walk finds every term
    within ``max_edits`` edits; stems match exactly. As one edit leaves one half of a
    term untouched, only words that start or end like a half of a term are walked.

    Each hit is scored in its context window: its term's precision, lowered when the
    hit is a misspelling and when it stands within quotation marks that open and close
    inside the window. Both are learned too, from training documents that have hits of
    that kind only: a misspelling that is an ordinary word weighs little. A document's score joins its hits as independent evidence
    over the rate of toxic documents among those without hits.

The labelled rows are a sample of at most about ``train_rows`` rows by a hash of
doc_id. A term is in at least ``LEAST_SHARE`` of the sample's toxic rows, so the lexicon, and with it
what the tasks get, is bounded by the sample: 1 / ``LEAST_SHARE`` times the words of a toxic row, on average.
Scores use the whole text and nothing but the text.

Defined cases
    A null or empty text gets the score of a document without hits. Labels that are
    null or of unknown documents are ignored; a doc_id labelled twice counts as toxic
    if any of its labels says so. Without labelled rows every score is 0.5 of the
    smoothed prior. Null doc_ids read as '' in the fold. Repeated rows are scored alike.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tardy.llm.words import ALPHANUMERIC, Words, mix64, slices, weights, words_of
from tardy.session import materialize

TRAIN_ROWS = 20_000
THRESHOLD = 0.3
HELD_OUT_FOLD = 2
STEM_LENGTHS = (4, 5, 6, 7, 8)
#: A term occurs in at least so many toxic rows, and in at least this share of them.
LEAST_DOCS, LEAST_SHARE = 5, 0.01
LEAST_PRECISION = 0.9
#: Precision of a misspelling, and factor of a quoted hit, that no training document has.
UNSEEN, UNSEEN_QUOTED = 0.5, 0.25
#: Near copies in the sample: documents that share a band of min-hashes of five-word shingles.
SHINGLE, BANDS, BAND_ROWS = 5, 4, 3
MAX_EDITS = 1
LEAST_FUZZY_LENGTH = 5
WINDOW_BYTES = 160
#: Marks that open and close a quotation.
QUOTES = (('"', '"'), ("“", "”"), ("„", "“"), ("«", "»"), ("»", "«"), ("‘", "’"))


def fold(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4


class Lexicon:
    """A trie over the terms. ``weights``: term -> precision; a term that ends in '*' is a stem."""

    def __init__(self, weights: dict[str, float], max_edits: int = MAX_EDITS) -> None:
        self.weights, self.max_edits = weights, max_edits
        self.words: dict = {}
        self.stems: dict = {}
        starts: set[bytes] = set()
        ends: set[bytes] = set()
        for term in weights:
            stem = term.endswith("*")
            text = term[:-1] if stem else term
            node = self.stems if stem else self.words
            for c in text:
                node = node.setdefault(c, {})
            node[""] = term
            half = len(text) if stem or len(text) < LEAST_FUZZY_LENGTH else len(text) // 2
            starts.add(text[:half].encode()[:8])
            if not stem and half < len(text):
                ends.add(text[half:].encode()[-8:])
        self.starts, self.ends = (self._by_length(x) for x in (starts, ends))

    @staticmethod
    def _by_length(parts: set[bytes]) -> dict[int, np.ndarray]:
        """Parts by length in bytes, as little-endian numbers."""
        lengths = {len(p) for p in parts if p}
        return {n: np.array(sorted(int.from_bytes(p, "little") for p in parts if len(p) == n), np.uint64) for n in lengths}

    def candidates(self, words: Words, which: np.ndarray) -> np.ndarray:
        """Those of the words (by number) that start or end like a half of a term."""
        start, end = words.start[which], words.end[which]
        place = np.arange(8)
        head = start[:, None] + place
        tail = end[:, None] - 1 - place
        data = words.data
        heads = np.where(head < end[:, None], data[np.minimum(head, len(data) - 1)], 0).astype(np.uint8)
        tails = np.where(tail >= start[:, None], data[np.maximum(tail, 0)], 0).astype(np.uint8)
        first = np.ascontiguousarray(heads).view("<u8").ravel()
        last = np.ascontiguousarray(tails[:, ::-1]).view("<u8").ravel()
        found = np.zeros(len(which), bool)
        for n, values in self.starts.items():
            found |= np.isin(first & np.uint64((1 << 8 * n) - 1), values)
        for n, values in self.ends.items():
            found |= np.isin(last >> np.uint64(64 - 8 * n), values)
        return which[found]

    def match(self, word: str) -> tuple[str, int] | None:
        """The best term for the word and its edits: a whole word first, then a stem, then misspellings by edits and precision."""
        best: tuple[int, float, str] | None = None
        goal = 1 << len(word)
        every = (goal << 1) - 1
        at: dict[str, int] = {}
        for i, c in enumerate(word):
            at[c] = at.get(c, 0) | 1 << i
        edits = self.max_edits if len(word) >= LEAST_FUZZY_LENGTH - 1 else 0
        stack = [(self.words, tuple((1 << e + 1) - 1 & every for e in range(edits + 1)))]
        while stack:
            node, state = stack.pop()
            if "" in node:
                term = node[""]
                for e, reached in enumerate(state):
                    if reached & goal and (not e or len(term) >= LEAST_FUZZY_LENGTH):
                        rank = (e, -self.weights[term], term)
                        best = rank if best is None or rank < best else best
                        break
            for c, child in node.items():
                if c:
                    after, below, same = [], 0, at.get(c, 0)
                    for e, reached in enumerate(state):
                        now = (reached & same) << 1
                        if e:  # c for another character; c left out; a character too many
                            now |= state[e - 1] << 1 | state[e - 1] | below << 1
                        below = now & every
                        after.append(below)
                    if after[-1]:
                        stack.append((child, tuple(after)))
        if best and not best[0]:
            return best[2], 0
        node, stem = self.stems, None
        for c in word:
            node = node.get(c)
            if node is None:
                break
            stem = node.get("", stem)
        return (stem, 0) if stem else best and (best[2], best[0])


def quoted(data: bytes, start: int, end: int, window: int = WINDOW_BYTES) -> bool:
    """Whether a quotation opens before and closes after the place, both within the window."""
    before = data[max(0, start - window):start].decode(errors="ignore")
    after = data[end:end + window].decode(errors="ignore")
    for opens, closes in QUOTES:
        if opens == closes:
            inside = before.count(opens) % 2 == 1 and closes in after
        else:
            inside = before.rfind(opens) > before.rfind(closes) and closes in after
        if inside:
            return True
    return False


@dataclass
class Hit:
    term: str
    edits: int
    quoted: bool
    word: int


class Matcher:
    """Finds the hits of the texts of a slice; remembers words that it has walked."""

    def __init__(self, lexicon: Lexicon, remember: int = 200_000) -> None:
        self.lexicon, self.remember = lexicon, remember
        self.seen: dict[bytes, tuple[str, int] | None] = {}

    def hits(self, column: pa.Array) -> list[list[Hit]]:
        words = words_of(column, ALPHANUMERIC)
        out: list[list[Hit]] = [[] for _ in range(len(column))]
        if not len(words.start) or not self.lexicon.weights:
            return out
        places = self.lexicon.candidates(words, np.arange(len(words.start)))
        docs = np.searchsorted(words.first, places, side="right") - 1
        for place, doc in zip(places.tolist(), docs.tolist()):
            raw = words.text(place)
            if raw not in self.seen:
                if len(self.seen) >= self.remember:
                    self.seen.clear()
                self.seen[raw] = self.lexicon.match(raw.decode(errors="replace"))
            if found := self.seen[raw]:
                low, high = int(words.first[doc]), int(words.first[doc + 1])
                # The window stays within the document: from its first word to its last.
                text = words.data[words.start[low]:words.end[high - 1]]
                shift = int(words.start[low])
                a, b = int(words.start[place]) - shift, int(words.end[place]) - shift
                near = text[max(0, a - WINDOW_BYTES):b + WINDOW_BYTES].tobytes()
                skip = max(0, a - WINDOW_BYTES)
                out[doc].append(Hit(*found, quoted(near, a - skip, b - skip), place - low))
        return out


@dataclass
class Model:
    """What scoring needs: the terms' precisions, the share of toxic documents among those
    without hits, each term's precision when misspelled, and the factor of quoted hits."""

    weights: dict[str, float] = field(default_factory=dict)
    base: float = 0.5
    fuzzy: dict[str, float] = field(default_factory=dict)
    quote: float = UNSEEN_QUOTED
    max_edits: int = MAX_EDITS

    def score(self, hits: list[Hit]) -> float:
        rest = 1 - self.base
        for h in hits:
            rest *= 1 - (self.fuzzy.get(h.term, UNSEEN) if h.edits else self.weights[h.term]) * (self.quote if h.quoted else 1)
        return min(1.0, max(0.0, 1 - rest))


def training_rows(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """text (binary), toxic and id (a hash of the text) of a sample of at most about
    ``train_rows`` labelled rows outside the held-out fold, each text once."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != HELD_OUT_FOLD))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    total = known.count()
    parts = max(1, -(-total // train_rows))
    sample = known.where(F.pmod(F.xxhash64("doc_id", F.lit("train")), F.lit(parts)) == 0)
    texts = docs.where(F.col("text").isNotNull()).select("doc_id", F.col("text").cast("binary").alias("text"))
    rows = texts.join(F.broadcast(sample), "doc_id")  # the sample has a bound, and a few bytes a row
    return rows.groupBy(F.xxhash64("text").alias("id")).agg(F.first("text").alias("text"), (F.max("toxic") > 0).alias("toxic"))


def representatives(rows: DataFrame) -> set[int]:
    """The ids of one row of each group of near copies in the (bounded) sample, so that
    the words of a much copied document don't count as many documents."""
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salts = weights(BANDS * BAND_ROWS, 5)
        for batch in slices(batches, "text"):
            words = words_of(batch.column(0), ALPHANUMERIC)
            h = words.hashes()
            bands = np.zeros((batch.num_rows, BANDS), np.int64)
            for d in range(batch.num_rows):
                own = h[words.first[d]:words.first[d + 1]]
                k = min(SHINGLE, len(own))
                if not k:
                    continue
                with np.errstate(over="ignore"):
                    grams = sum(own[i:len(own) - k + 1 + i] * w for i, w in enumerate(weights(k, 6)))
                    least = np.array([mix64(grams ^ s).min() for s in salts]).reshape(BANDS, BAND_ROWS)
                    bands[d] = mix64((least * weights(BAND_ROWS, 7)).sum(axis=1)).view(np.int64)
            yield pa.record_batch([batch.column(1), *(pa.array(bands[:, b]) for b in range(BANDS))], names=["id", *(f"b{b}" for b in range(BANDS))])

    found = rows.select("text", "id").mapInArrow(sketch, "id long, " + ", ".join(f"b{b} long" for b in range(BANDS))).collect()
    parent = {r["id"]: r["id"] for r in found}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    first: dict[tuple[int, int], int] = {}
    for r in found:
        for b in range(BANDS):
            x, y = root(r["id"]), root(first.setdefault((b, r[f"b{b}"]), r["id"]))
            parent[max(x, y)] = min(x, y)
    return {x for x in parent if root(x) == x}


def feature_counts(rows: DataFrame, ids: set[int], stem_lengths: tuple[int, ...] = STEM_LENGTHS) -> DataFrame:
    """feature, toxic, clean: in how many rows of each kind, of those in ``ids``, a word
    or a stem (ending in '*') occurs."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            batch = batch.filter(pa.array([x in ids for x in batch.column(2).to_pylist()]))
            words = words_of(batch.column(0), ALPHANUMERIC)
            toxic = batch.column(1).to_pylist()
            n = (Counter(), Counter())
            for d in range(batch.num_rows):
                own = {words.text(w).decode(errors="replace") for w in range(words.first[d], words.first[d + 1])}
                n[toxic[d]].update(own)
                n[toxic[d]].update({w[:k] + "*" for w in own for k in stem_lengths if len(w) >= k})
            names = list(n[0].keys() | n[1].keys())
            yield pa.record_batch({"feature": pa.array(names, pa.string()), "toxic": pa.array([n[1][x] for x in names], pa.int64()),
                                   "clean": pa.array([n[0][x] for x in names], pa.int64())})

    found = rows.select("text", "toxic", "id").mapInArrow(count, "feature string, toxic long, clean long")
    return found.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def learn_terms(counts: DataFrame, least_docs: int, least_precision: float = LEAST_PRECISION) -> dict[str, float]:
    """The terms and their smoothed precisions. A stem gives way to a longer one that
    keeps nine tenths of its toxic rows, or to a word that does; a word or stem that a
    shorter stem covers is left out."""
    precision = (F.col("toxic") + F.lit(0.5)) / (F.col("toxic") + F.col("clean") + F.lit(1.0))
    good = counts.where(F.col("toxic") >= least_docs).withColumn("p", precision).where(F.col("p") >= least_precision)
    rows = good.orderBy(F.col("toxic").desc(), "feature").collect()  # bounded by the sample of labelled rows
    toxic = {r["feature"]: r["toxic"] for r in rows}
    best: dict[str, int] = {}  # for each prefix, the most rows that a longer stem or a word has
    for term, n in toxic.items():
        text = term.removesuffix("*")
        for k in range(1, len(text) + (not term.endswith("*"))):
            best[text[:k]] = max(best.get(text[:k], 0), n)
    stems = {t[:-1] for t, n in toxic.items() if t.endswith("*") and best.get(t[:-1], 0) < 0.9 * n}

    def covered(term: str) -> bool:
        text = term.removesuffix("*")
        return any(text[:k] in stems for k in range(1, len(text) + (not term.endswith("*"))))

    return {r["feature"]: float(r["p"]) for r in rows
            if (not r["feature"].endswith("*") or r["feature"][:-1] in stems) and not covered(r["feature"])}


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, max_edits: int = MAX_EDITS) -> Model:
    rows = materialize(training_rows(docs, labels, train_rows), "toxicity-train")
    ids = representatives(rows)
    toxic = {r["id"] for r in rows.where("toxic").select("id").collect()} & ids
    least = max(LEAST_DOCS, round(LEAST_SHARE * len(toxic)))
    model = Model(learn_terms(feature_counts(rows, ids), least), max_edits=max_edits)

    def kinds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What the best hit of each row is: plain, quoted, none, or a misspelling of some term."""
        matcher = Matcher(Lexicon(model.weights, max_edits))
        for batch in slices(batches, "text"):
            kind, toxic = [], []
            for hits, bad in zip(matcher.hits(batch.column(0)), batch.column(1).to_pylist()):
                best = {"plain" if not h.quoted else "quoted" for h in hits if not h.edits}
                of = {"plain"} if "plain" in best else best or {f"~{h.term}" for h in hits} or {"none"}
                kind += of
                toxic += [bad] * len(of)
            yield pa.record_batch({"kind": pa.array(kind, pa.string()), "toxic": pa.array(toxic, pa.bool_())})

    seen = rows.select("text", "toxic").mapInArrow(kinds, "kind string, toxic boolean").groupBy("kind").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("toxic").alias("bad")).collect()  # at most a row per term
    share = {r["kind"]: (r["bad"] + 0.5) / (r["n"] + 1) for r in seen}
    model.base = min(share.get("none", 0.5), 0.5)
    model.quote = share.get("quoted", UNSEEN_QUOTED)
    model.fuzzy = {k[1:]: p for k, p in share.items() if k.startswith("~")}
    return model


def score_documents(docs: DataFrame, model: Model, kept: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``kept`` columns, score, and hits (term, word number, edits, quoted); one row per document."""
    names = list(dict.fromkeys(kept))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(Lexicon(model.weights, model.max_edits))
        kind = pa.list_(pa.struct([("term", pa.string()), ("word", pa.int32()), ("edits", pa.int32()), ("quoted", pa.bool_())]))
        for batch in slices(batches, "_scored_text"):
            found = matcher.hits(batch.column(0))
            scores = pa.array([model.score(h) for h in found], pa.float64())
            hits = pa.array([[{"term": x.term, "word": x.word, "edits": x.edits, "quoted": x.quoted} for x in h] for h in found], kind)
            yield pa.record_batch([*batch.columns[1:], scores, hits], names=[*(f"k_{n}" for n in names), "score", "hits"])

    rows = docs.select(F.col("text").cast("binary").alias("_scored_text"), *(F.col(n).alias(f"k_{n}") for n in names))
    schema = "".join(f"`{n}` {kind}, " for n, kind in rows.drop("_scored_text").dtypes)
    scored = rows.mapInArrow(score, schema + "score double, hits array<struct<term string, word int, edits int, quoted boolean>>")
    return scored.select(*(F.col(f"`k_{n}`").alias(n) for n in names), "score", "hits")


def toxicity_scores(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, score, predicted, n_hits."""
    scored = score_documents(docs, train(docs, labels, **options))
    return scored.select("doc_id", (fold(F.col("doc_id")) == HELD_OUT_FOLD).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), F.size("hits").alias("n_hits"))
