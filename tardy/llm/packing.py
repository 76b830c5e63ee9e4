"""Best-fit packing of tokenised documents into sequences of a fixed length.

Method
    Best-fit decreasing: pieces are placed from the longest to the shortest, each into the
    open sequence with the least room that still takes it; a segment tree over the remaining
    capacities (0 to ``limit``) finds that room in logarithmic time. What best-fit decreasing
    does depends on lengths only, so pieces of one length are placed a run at a time: the
    tightest room r takes r // length of them in a row before any other sequence can be
    tighter, and all sequences that have the same room r take them alike. The plan is what
    placing the pieces one by one gives, yet it is made from a histogram of at most ``limit``
    rows, whatever the number of documents, and has at most about 1.5 * limit^2 runs.

    On Spark: tasks tokenise, cut and number their pieces per length (the numbers restart in
    each task); the narrow piece rows are written once. Counts per (task, length) give each task's
    first number of a length; a piece's number of its length over all tasks finds its run in
    the shipped plan by binary search, and with it the sequence and the place there. Tokens
    never move between tasks for the plan; ``sequences`` joins them by sequence at the end.

Tokens: a document is the ids of its text under the byte-level vocabulary of ``tokenizer``
    (the JSON file of the tokenizers library, without the ids that its post-processor adds), then ``END``.
    The ids are those that the tokenizers library gives; they are made by tiktoken from the
    vocabulary in the same file, which takes a fifth of the time (a test compares the two).

Only documents of more than ``limit`` tokens are cut: into pieces of ``limit`` tokens, but
the first has what is left over.

Defined cases
    A null or empty text is the one token ``END``. Rows with equal or null doc_ids are documents of
    their own. Pieces of one length are interchangeable: which of them lies where follows
    the order of tasks and rows; the number of sequences doesn't depend on it. An empty
    table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tardy.llm.chat import CUTS
from tardy.llm.words import slices
from tardy.session import materialize

LIMIT = 1024
END = 2
TOKENIZER = "byte_bpe_50k.json"


def tokenizer_file(name: str = TOKENIZER) -> str:
    """The place of a vocabulary file of the public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Token ids of texts under a byte-level vocabulary (the JSON text of a tokenizers file)."""

    def __init__(self, tokenizer: str) -> None:
        import tiktoken

        made = json.loads(tokenizer)
        added = {t["content"]: t["id"] for t in made["added_tokens"]}
        # The file writes bytes as printable characters: those that are printable stand for themselves.
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        ranks = {bytes(byte[c] for c in token): i for token, i in made["model"]["vocab"].items() if token not in added}
        self.encoding = tiktoken.Encoding("packing", pat_str=CUTS, mergeable_ranks=ranks, special_tokens=added)

    def ids(self, text: str) -> np.ndarray:
        return np.array([*self.encoding.encode(text, allowed_special="all", disallowed_special=()), END], "<u4")


def bounds(n: int, limit: int) -> list[int]:
    """Where the pieces of n tokens start, and n."""
    return [0, *range(n % limit or limit, n, limit), n] if n > limit else [0, n]


class Rooms:
    """Open sequences by remaining capacity: stacks of ranges of sequences and a segment
    tree that says which capacities have any."""

    def __init__(self, limit: int) -> None:
        self.leaves = 1 << limit.bit_length()
        self.any = bytearray(2 * self.leaves)
        self.ranges: list[list[tuple[int, int]]] = [[] for _ in range(limit + 1)]

    def push(self, room: int, first: int, n: int) -> None:
        self.ranges[room].append((first, n))
        at = self.leaves + room
        while at and not self.any[at]:
            self.any[at] = 1
            at >>= 1

    def pop(self, room: int) -> tuple[int, int]:
        taken = self.ranges[room].pop()
        if not self.ranges[room]:
            at = self.leaves + room
            self.any[at] = 0
            at >>= 1
            while at:
                self.any[at] = self.any[2 * at] | self.any[2 * at + 1]
                at >>= 1
        return taken

    def tightest(self, length: int) -> int | None:
        """The least capacity of ``length`` or more that an open sequence has."""
        at = self.leaves + length
        while not self.any[at]:  # up to the first subtree to the right that has any
            while at & 1:
                at >>= 1
            if not at:
                return None
            at += 1
        while at < self.leaves:
            at = 2 * at if self.any[2 * at] else 2 * at + 1
        return at - self.leaves


@dataclass
class Plan:
    """Runs: pieces number ``rank`` on of ``length`` go ``each`` to a sequence, from sequence
    ``first`` on, from the place ``offset`` on. Ordered by length, rank."""

    length: np.ndarray
    rank: np.ndarray
    first: np.ndarray
    each: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of pieces by length and number of their length."""
        key = (length.astype(np.int64) << 48) + rank
        run = np.searchsorted((self.length << 48) + self.rank, key, side="right") - 1
        nth, each = rank - self.rank[run], self.each[run]
        return self.first[run] + nth // each, self.offset[run] + nth % each * length


def best_fit(counts: dict[int, int], limit: int = LIMIT) -> Plan:
    """The plan of best-fit decreasing for so many pieces of each length."""
    rooms, runs, made = Rooms(limit), [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = rooms.tightest(length)
            if room is None:
                room, first, n = limit, made, -(-left // (limit // length))
                made += n
            else:
                first, n = rooms.pop(room)
            each = room // length
            full = min(n, left // each)
            if full:
                runs.append((length, rank, first, each, limit - room))
                rooms.push(room - each * length, first, full)
                rank, left, first, n = rank + full * each, left - full * each, first + full, n - full
            if n and left:  # fewer than a sequence takes
                runs.append((length, rank, first, left, limit - room))
                rooms.push(room - left * length, first, 1)
                left, first, n = 0, first + 1, n - 1
            if n:
                rooms.push(room, first, n)
    runs.sort()
    return Plan(*(np.array(c, np.int64) for c in (zip(*runs) if runs else [()] * 5)), made)


def numbered(length: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Numbers per length, going on from ``seen``, which is brought up to date."""
    order = np.argsort(length, kind="stable")
    ordered = length[order]
    rank = np.empty(len(length), np.int64)
    rank[order] = np.arange(len(length)) - np.searchsorted(ordered, ordered) + seen[ordered]
    seen += np.bincount(length, minlength=len(seen))
    return rank


def cut_documents(documents: DataFrame, limit: int = LIMIT, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, task and nth (of its length in the task), with ``ids`` if wanted."""
    with open(tokenizer or tokenizer_file(), encoding="utf-8") as f:
        vocabulary = f.read()
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = "piece int, start long, length long, ids_crc32 long, task int, nth long" + (", ids array<int>" if with_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seen, task = Encoder(vocabulary), np.zeros(limit + 1, np.int64), TaskContext.get().partitionId()
        for batch in slices(batches, "text"):
            ids = [encoder.ids(t.as_py()) for t in batch.column(1)]
            at = [bounds(len(x), limit) for x in ids]
            pieces = [x[a:b] for x, ends in zip(ids, at) for a, b in zip(ends, ends[1:])]
            counts = [len(ends) - 1 for ends in at]
            length = np.array([len(p) for p in pieces], np.int64)
            columns = [batch.column(0).take(pa.array(np.repeat(np.arange(len(ids)), counts))),
                       pa.array(np.concatenate([np.arange(n) for n in counts]), pa.int32()),
                       pa.array(np.concatenate([ends[:-1] for ends in at]), pa.int64()), pa.array(length),
                       pa.array([zlib.crc32(p) for p in pieces], pa.int64()), pa.array(np.full(len(pieces), task), pa.int32()),
                       pa.array(numbered(length, seen))]
            if with_ids:
                ends = np.concatenate(([0], np.cumsum(length))).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(pieces).astype(np.int32))))
            yield pa.record_batch(columns, names=["doc_id", *(c.split()[0] for c in kind.split(", "))])

    return rows.mapInArrow(cut, f"doc_id {dict(rows.dtypes)['doc_id']}, {kind}")


def pack(documents: DataFrame, limit: int = LIMIT, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids): a row per piece."""
    pieces = materialize(cut_documents(documents, limit, tokenizer, with_ids), "packing-pieces")
    counts = materialize(pieces.groupBy("task", "length").agg(F.count("*").alias("n")), "packing-counts")
    # A row per length: ``limit`` at most.
    plan = best_fit({r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}, limit)
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = pieces.join(before, ["task", "length"]).withColumn("rank", F.col("before") + F.col("nth")).drop("before", "nth", "task")
    wanted = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *(["ids"] if with_ids else [])]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = dict(zip(batch.schema.names, batch.columns))
            sequence, offset = plan.place(column["length"].to_numpy(), column["rank"].to_numpy())
            column |= {"sequence_id": pa.array(sequence), "offset": pa.array(offset)}
            yield pa.record_batch([column[c] for c in wanted], names=wanted)

    types = dict(ranked.dtypes) | {"sequence_id": "bigint", "offset": "bigint"}
    return ranked.mapInArrow(place, ", ".join(f"{c} {types[c]}" for c in wanted))


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids: the packed sequences, of pieces ``with_ids``. A sequence has ``limit`` tokens at most."""
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten(F.col("parts.ids")).alias("ids"))
