"""N-gram Jaccard join with signature trees: groups of near-duplicate documents.

Two documents link when the Jaccard similarity of their sets of word shingles is at
least ``num / den``; components are what links reach. The join is exact (up to equal
64-bit hashes of different shingles).

Method
    1. A text is a set of shingle hashes; texts with the same word sequence are one
       set, known by a hash of the sequence. A set that links shares ``num / den`` of its
       shingles with another one at least. So shingles are first counted exactly: tasks
       send sorted blocks of hashes, a few bytes each, range by range, and get back how
       many of a set's hashes occur elsewhere. Sets with too few of them have no partner
       and are done.
    2. Any two sets that link share one of their first n - ceil(t n) + 1 shingles in
       any common order. The order is by rarity, from a count sketch of a fixed number
       of slots over the sets that are left. So sets meet on rare shingles and a passage that
       many documents share makes no candidates. Shingles in one set only meet nobody.
    3. Shingles on which the same sets meet are one group of sets. Each group is first
       verified against the least of it (its hub). That links nearly all copies of a
       text by as many checks as copies, not by all pairs, and gives components to
       start from.
    4. What is left are pairs of different components that meet on a shingle. The
       components are signature trees: a root, nodes of up to ``node_sets`` sets and the
       sets themselves, each with a size range and the OR of its sets' token bitmaps. A
       dual traversal (a join per level) keeps the pairs of roots, nodes and sets whose
       greatest possible overlap reaches what their sizes need; sets of one component
       are never compared again. The surviving pairs of sets are verified.

Hot groups
    Copies of a text are one set before anything is shuffled by shingle (a task emits a
    set once). A hub's checks are salted into parts of up to ``part_sets`` sets. Roots
    that meet on one shingle are compared in blocks of ``block_roots``, each pair of
    blocks in a task of its own; blocks are cut in order of size, and pairs of blocks
    with incompatible sizes are not made.

Defined cases
    Null, empty and blank texts have an empty set and are their own component. Rows with
    equal doc_ids are rows of their own, with their text's component. The component id
    is the least non-null doc_id; null if there is none, also for an empty text's null
    doc_id. An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tardy.llm.words import NOT_BLANK, mix64, slices, weights, words_of
from tardy.session import materialize

SHINGLE = 5
NUM, DEN = 75, 100
#: Hashes are told apart by so many bits when it is counted which of them sets share; a range of them is
#: one group (of 4 bytes per hash of a chunk and range while it is read).
RANGE_BITS, REST_BITS = 10, 30
#: Hashes of a chunk of sets, and bytes of counts that a reducer holds.
CHUNK_SHINGLES, FLUSH_BYTES = 1_000_000, 32 << 20
#: Bits of the filter of texts that may have a partner (4 MB).
FILTER_BITS = 1 << 25
#: Slots of the count sketch, and how many of them make a row.
SKETCH_SLOTS, SKETCH_ROW = 1 << 22, 1 << 10
#: Rarity levels: so many to a doubling of the count.
LEVELS = 64
#: Bits of a set's signature.
BITS = 2048
PART_SETS, NODE_SETS, BLOCK_ROOTS = 2000, 32, 512
#: Rows of a few numbers that a join may broadcast (about 50 MB); more are shuffled.
BROADCAST_ROWS = 250_000


def shingle_sets(column: pa.Array, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, text of each hash, hash of the word sequence of each text). A text of
    fewer words than a shingle, but not none, has its whole sequence as one."""
    words = words_of(column, NOT_BLANK)
    h, counts, first = words.hashes(), words.counts, words.first
    n = len(counts)
    if not len(h):
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.zeros(n, np.uint64)
    of = np.repeat(np.arange(n), counts)
    place = np.arange(len(h)) - first[:-1][of]
    with np.errstate(over="ignore"):
        # The sequence: each word's hash mixed with its place, summed up.
        ordered = mix64(h ^ mix64(place.astype(np.uint64) + np.uint64(1)))
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(ordered, dtype=np.uint64)))
        sequence = mix64(total[first[1:]] - total[first[:-1]] + counts.astype(np.uint64))
        grams = np.zeros(max(0, len(h) - shingle + 1), np.uint64)
        for i, w in enumerate(weights(shingle, 1)):
            grams += h[i:len(h) - shingle + 1 + i] * w if len(grams) else np.uint64(0)
    whole = place[:len(grams)] + shingle <= counts[of[:len(grams)]]
    short = np.flatnonzero((counts > 0) & (counts < shingle))
    hashes = np.concatenate((mix64(grams[whole]), mix64(sequence[short] ^ np.uint64(0x5851F42D4C957F2D))))
    return hashes, np.concatenate((of[:len(grams)][whole], short)), sequence


def distinct_shingles(hashes: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct hashes: (hash, text), in order of text and hash."""
    order = np.lexsort((hashes, of))
    hashes, of = hashes[order], of[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
    return hashes[fresh], of[fresh]


def document_keys(docs: DataFrame, shingle: int) -> DataFrame:
    """A row per document (doc_id, key: hash of its text, uid: of its words, n: size of its set; chunk and
    place if it is the first of its set in the chunk; a range below 0) and, for each chunk of sets and range of
    hashes, a block: the sorted rests of the hashes in the range and the sets (places) that have them."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, chunk, seen, held, size, sets = TaskContext.get().partitionId(), 0, set(), [], 0, 0
        for rows in slices(batches, "text"):
            hashes, of, sequence = shingle_sets(rows.column(2), shingle)
            hashes, of = distinct_shingles(hashes, of)
            uid, n = sequence.view(np.int64), np.bincount(of, minlength=rows.num_rows)
            new = np.zeros(rows.num_rows, bool)
            for i, u in enumerate(uid.tolist()):
                if n[i] and u not in seen:
                    seen.add(u)
                    new[i] = True
            place = sets + np.cumsum(new) - 1
            keep = new[of]
            held.append((hashes[keep] >> np.uint64(64 - RANGE_BITS - REST_BITS), place[of[keep]].astype(np.uint32)))
            size, sets = size + len(held[-1][0]), sets + int(new.sum())
            own = pa.array(np.full(rows.num_rows, task << 20 | chunk), pa.int64())
            dealt = pa.array(-1 - np.arange(rows.num_rows) % (1 << RANGE_BITS), pa.int32())
            yield as_batch([rows.column(0), rows.column(1), pa.array(uid), pa.array(n, pa.int64()), own, pa.array(place, pa.int64(), mask=~new), dealt, None, None])
            if size >= CHUNK_SHINGLES:
                yield from blocks(held, task << 20 | chunk)
                chunk, seen, held, size, sets = chunk + 1, set(), [], 0, 0
        yield from blocks(held, task << 20 | chunk)

    def blocks(held: list, chunk: int) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        ids, place = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(ids, kind="stable")
        ids, place = ids[order], place[order]
        which = (ids >> np.uint64(REST_BITS)).astype(np.int64)
        rest = (ids & np.uint64((1 << REST_BITS) - 1)).astype("<u4")
        short = place.astype("<u2") if len(place) and place.max() < 1 << 16 else place.astype("<u4")
        used, first = np.unique(which, return_index=True)
        last = np.append(first[1:], len(which))
        for at in range(0, len(used), 256):
            part = [(int(used[i]), planes(rest[first[i]:last[i]]), short[first[i]:last[i]].tobytes()) for i in range(at, min(at + 256, len(used)))]
            columns = [pa.array([p[0] for p in part], pa.int32()), *(pa.array([p[j] for p in part], pa.binary()) for j in (1, 2))]
            yield as_batch([*[None] * 4, pa.array([chunk] * len(part), pa.int64()), None, *columns])

    def as_batch(columns: list) -> pa.RecordBatch:
        rows = len(next(c for c in columns if c is not None))
        return pa.record_batch([pa.nulls(rows, t) if c is None else c for c, t in zip(columns, types)], names=names)

    names = ["doc_id", "key", "uid", "n", "chunk", "place", "range", "rests", "places"]
    types = [*[pa.int64()] * 6, pa.int32(), pa.binary(), pa.binary()]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(scan, "doc_id long, key long, uid long, n long, chunk long, place long, range int, rests binary, places binary")


def planes(sorted_rests: np.ndarray) -> bytes:
    """Sorted 4-byte numbers as differences, in as many bytes each as the greatest needs (that number first)."""
    steps = np.diff(sorted_rests, prepend=sorted_rests[:1] * 0)
    width = max(1, (int(steps.max()).bit_length() + 7) // 8)
    return bytes([width]) + steps.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width].tobytes()


def from_planes(packed: bytes) -> np.ndarray:
    width = packed[0]
    steps = np.zeros(((len(packed) - 1) // width, 4), np.uint8)
    steps[:, :width] = np.frombuffer(packed, np.uint8, offset=1).reshape(-1, width)
    return np.cumsum(steps.view("<u4").ravel(), dtype=np.uint32)


def counted_keys(scanned: DataFrame) -> DataFrame:
    """The rows of the documents, and partial counts per chunk (counts: of each place how many of the set's
    hashes occur more than once, or seem to, by ``RANGE_BITS + REST_BITS`` bits). The blocks are
    shuffled as they are made; reducers read them range by range and add up per chunk what they find."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        now, open_range = None, []
        for batch in batches:
            ranges = batch.column(6).to_numpy()
            documents = batch.filter(pa.array(ranges < 0))
            if documents.num_rows:
                yield pa.RecordBatch.from_arrays([*documents.columns[:6], pa.nulls(documents.num_rows, pa.binary())], names=names)
            for i in np.flatnonzero(ranges >= 0).tolist():
                if ranges[i] != now:
                    add(open_range, totals)
                    now, open_range = ranges[i], []
                open_range.append((batch.column(4)[i].as_py(), batch.column(7)[i].as_py(), batch.column(8)[i].as_py()))
            if sum(t.nbytes for t in totals.values()) > FLUSH_BYTES:
                yield as_batch(totals)
                totals = {}
        add(open_range, totals)
        yield as_batch(totals)

    def add(blocks: list, totals: dict) -> None:
        if not blocks:
            return
        rests = [from_planes(b) for _, b, _ in blocks]
        every = np.sort(np.concatenate(rests))
        twice = np.unique(every[1:][every[1:] == every[:-1]])
        if not len(twice):
            return
        for (chunk, _, places), own in zip(blocks, rests):
            at = np.searchsorted(twice, own)
            hit = twice[np.minimum(at, len(twice) - 1)] == own
            kind = "<u2" if len(places) == 2 * len(own) else "<u4"
            found = np.bincount(np.frombuffer(places, kind)[hit])
            old = totals.get(chunk, np.empty(0, np.int64))
            if len(old) < len(found):
                old = np.concatenate((old, np.zeros(len(found) - len(old), np.int64)))
            old[:len(found)] += found
            totals[chunk] = old

    def as_batch(totals: dict) -> pa.RecordBatch:
        nothing = [pa.nulls(len(totals), pa.int64())]
        return pa.record_batch([*nothing * 4, pa.array(list(totals), pa.int64()), *nothing, pa.array([t.astype("<u4").tobytes() for t in totals.values()], pa.binary())], names=names)

    names = ["doc_id", "key", "uid", "n", "chunk", "place", "counts"]
    dealt = scanned.repartition("range").sortWithinPartitions("range")
    return dealt.mapInArrow(count, "doc_id long, key long, uid long, n long, chunk long, place long, counts binary")


def shared_counts(keys: DataFrame) -> DataFrame:
    """chunk, place, shared: the counts of all reducers, summed."""
    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums = None, np.empty(0, np.int64)
        for batch in batches:
            for chunk, counts in zip(*(c.to_pylist() for c in batch.columns)):
                own = np.frombuffer(counts, "<u4").astype(np.int64)
                if chunk != now:
                    yield as_rows(now, sums)
                    now, sums = chunk, np.empty(0, np.int64)
                if len(sums) < len(own):
                    sums = np.concatenate((sums, np.zeros(len(own) - len(sums), np.int64)))
                sums[:len(own)] += own
        yield as_rows(now, sums)

    def as_rows(chunk: int | None, sums: np.ndarray) -> pa.RecordBatch:
        place = np.flatnonzero(sums)
        return pa.record_batch({"chunk": pa.array(np.full(len(place), chunk or 0), pa.int64()), "place": pa.array(place, pa.int64()), "shared": pa.array(sums[place], pa.int64())})

    partial = keys.where("counts is not null").select("chunk", "counts").repartition("chunk").sortWithinPartitions("chunk")
    return partial.mapInArrow(total, "chunk long, place long, shared long")


def partnered(keys: DataFrame, num: int, den: int) -> np.ndarray:
    """A bitmap over hashes of texts: set for one text of each set that may link. A set that links has
    num / den of its hashes in another one at least, so all others have no partner. The bitmap has a fixed
    number of bits; where several texts share one, too many pass, never too few."""
    firsts = keys.where("place is not null").select("chunk", "place", "key", "n")
    may = firsts.join(shared_counts(keys), ["chunk", "place"]).where(F.col("shared") * den >= F.col("n") * num)
    bits = may.select(F.col("key").bitwiseAND(F.lit(FILTER_BITS - 1)).alias("bit"))
    words = bits.groupBy(F.expr("cast(shiftright(bit, 5) as int)").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(bit & 31 as int)))").alias("bits"))
    found = words.groupBy(F.shiftright("word", 10).alias("row")).agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("of"))  # 1,024 words at most
    bitmap = np.zeros(FILTER_BITS // 32, "<u4")
    for r in found.select("of.word", "of.bits").toLocalIterator():
        bitmap[r["word"]] = np.array(r["bits"], np.uint64).astype("<u4")
    return bitmap


def passing(rows: pa.RecordBatch, bitmap: np.ndarray, key: int) -> pa.RecordBatch:
    """The rows whose key (a column of hashes) the bitmap has."""
    bit = rows.column(key).to_numpy() & (FILTER_BITS - 1)
    return rows.filter(pa.array((bitmap[bit >> 5] >> (bit & 31).astype("<u4")) & 1 == 1))


def sketch_rows(docs: DataFrame, bitmap: np.ndarray, shingle: int) -> DataFrame:
    """slot, counts: the count sketch of each task over the texts that pass, rows without a count left out
    and others as (slot, count) pairs where that is shorter."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots: list[np.ndarray] = []
        total = None
        for rows in slices((passing(b, bitmap, 0) for b in batches), "text"):
            hashes, _, _ = shingle_sets(rows.column(1), shingle)
            slots.append((hashes & np.uint64(SKETCH_SLOTS - 1)).astype(np.uint32))
            if sum(map(len, slots)) >= SKETCH_SLOTS:
                total = (0 if total is None else total) + np.bincount(np.concatenate(slots), minlength=SKETCH_SLOTS)
                slots = []
        if total is None:
            own, n = np.unique(np.concatenate(slots or [np.empty(0, np.uint32)]), return_counts=True)
        else:
            total += np.bincount(np.concatenate(slots or [np.empty(0, np.uint32)]), minlength=SKETCH_SLOTS)
            own, n = np.flatnonzero(total), total[total > 0]
        own, n = own.astype(np.int64), np.minimum(n, 65_535).astype("<u2")
        used, first = np.unique(own // SKETCH_ROW, return_index=True)
        last = np.append(first[1:], len(own))
        counts = []
        for a, b in zip(first, last):
            if 4 * (b - a) < 2 * SKETCH_ROW:
                counts.append(np.stack(((own[a:b] % SKETCH_ROW).astype("<u2"), n[a:b])).tobytes())
            else:
                dense = np.zeros(SKETCH_ROW, "<u2")
                dense[own[a:b] % SKETCH_ROW] = n[a:b]
                counts.append(dense.tobytes())
        yield pa.record_batch({"slot": pa.array(used, pa.int32()), "counts": pa.array(counts, pa.binary())})

    rows = docs.select(F.xxhash64("text").alias("key"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(scan, "slot int, counts binary")


def slot_counts(counts: bytes) -> np.ndarray:
    """A row of the sketch."""
    if len(counts) == 2 * SKETCH_ROW:
        return np.frombuffer(counts, "<u2").astype(np.int64)
    slot, n = np.frombuffer(counts, "<u2").reshape(2, -1)
    row = np.zeros(SKETCH_ROW, np.int64)
    row[slot] = n
    return row


def rarity_levels(sketch: DataFrame) -> np.ndarray:
    """The level of each of the ``SKETCH_SLOTS`` slots, two bytes each; counts are summed up
    in the tasks. Other shingles of a slot add about the same to all; levels are fine enough
    to see what is above that."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for slot, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[slot] = sums.get(slot, 0) + slot_counts(counts)
        levels = [np.minimum(LEVELS * np.log2(c + 1), 4095).astype("<u2").tobytes() for c in sums.values()]
        yield pa.record_batch({"slot": pa.array(list(sums), pa.int32()), "counts": pa.array(levels, pa.binary())})

    rows = sketch.repartition("slot").mapInArrow(add, "slot int, counts binary")
    level = np.zeros(SKETCH_SLOTS, np.uint16)
    for r in rows.collect():  # SKETCH_SLOTS numbers of two bytes
        level[r["slot"] * SKETCH_ROW:(r["slot"] + 1) * SKETCH_ROW] = np.frombuffer(r["counts"], "<u2")
    return level


def ranked(hashes: np.ndarray, of: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct shingles in the common order: (number, text). The number is
    the rarity level in the top 12 bits and 51 bits of the hash, so it is the same everywhere."""
    slot = (hashes & np.uint64(SKETCH_SLOTS - 1)).astype(np.int64)
    number, of = distinct_shingles((level[slot].astype(np.uint64) << np.uint64(51)) | (hashes >> np.uint64(13)), of)
    return number.view(np.int64), of


def prefixes(docs: DataFrame, bitmap: np.ndarray, level: np.ndarray, shingle: int, num: int, den: int) -> DataFrame:
    """token, uid, n: the necessary prefix of each set that may have a partner, once per task and set."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for rows in slices((passing(b, bitmap, 0) for b in batches), "text"):
            hashes, of, sequence = shingle_sets(rows.column(1), shingle)
            uid = sequence.view(np.int64)
            new = np.zeros(rows.num_rows, bool)
            for i, u in enumerate(uid.tolist()):
                if u not in seen:
                    seen.add(u)
                    new[i] = True
            keep = new[of]
            token, of = ranked(hashes[keep], of[keep], level)
            n = np.bincount(of, minlength=rows.num_rows)
            start = np.concatenate(([0], np.cumsum(n)))[:-1]
            length = n - -(-n * num // den) + 1
            mine = np.arange(len(of)) - start[of] < length[of]
            yield pa.record_batch({"token": token[mine], "uid": uid[of[mine]], "n": n[of[mine]].astype(np.int32)})

    rows = docs.select(F.xxhash64("text").alias("key"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(cut, "token long, uid long, n int")


def meetings(entries: DataFrame) -> DataFrame:
    """token, hub, hub_n, uid, n of the sets that meet on a shingle: two different ones
    at least. The hub is the least uid; its own row is there too. Reads each partition
    once, in order, and holds one row."""
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, hub, hub_n, last, told = None, None, None, None, True
        for batch in batches:
            t, u, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            if not len(t):
                continue
            if token is not None:  # the first of the group that is open goes in front
                t, u, n = np.concatenate(([token], t)), np.concatenate(([hub], u)), np.concatenate(([hub_n], n))
            head = np.ones(len(t), bool)
            head[1:] = t[1:] != t[:-1]
            at = np.maximum.accumulate(np.where(head, np.arange(len(t)), 0))
            before = np.concatenate(([u[0]], u[:-1]))
            if last is not None and len(u) > 1:
                before[1] = last
            other = (u != u[at]) & (u != before)
            if token is not None:
                other[0] = False
            # A hub's own row comes with the first other set of its group.
            first = np.zeros(len(t), bool)
            firsts = np.flatnonzero(other)
            if len(firsts):
                lead = np.ones(len(firsts), bool)
                lead[1:] = at[firsts[1:]] != at[firsts[:-1]]
                if token is not None and told and at[firsts[0]] == 0:
                    lead[0] = False
                first[at[firsts[lead]]] = True
            out = np.flatnonzero(other | first)
            yield pa.record_batch({"token": t[out], "hub": u[at[out]], "hub_n": n[at[out]].astype(np.int32), "uid": u[out], "n": n[out].astype(np.int32)})
            g = at[-1]
            told = bool((other & (at == g)).any()) or (told and g == 0 and token is not None)
            token, hub, hub_n, last = t[-1], u[g], n[g], u[-1]

    dealt = entries.repartition("token").sortWithinPartitions("token", "uid")
    return dealt.mapInArrow(walk, "token long, hub long, hub_n int, uid long, n int")


def distinct_groups(meets: DataFrame) -> DataFrame:
    """The meetings without the shingles on which the same sets meet as on another one:
    a passage has many shingles, but few different groups of sets that have them."""
    groups = meets.groupBy("token").agg(F.count(F.lit(1)).alias("k"), F.min("uid").alias("first"), *(
        F.bit_xor(F.xxhash64("uid", F.lit(i))).alias(f"x{i}") for i in range(2)))
    keep = groups.groupBy("k", "first", "x0", "x1").agg(F.min("token").alias("token")).select("token")
    return meets.join(keep, "token", "left_semi")


def small_side(frame: DataFrame, bound: int = BROADCAST_ROWS) -> DataFrame:
    """For a join with texts: broadcast if it has ``bound`` rows of a few numbers at most, else shuffled."""
    return F.broadcast(frame) if frame.limit(bound + 1).count() <= bound else frame


def candidate_texts(docs: DataFrame, uids: DataFrame, keys: DataFrame) -> DataFrame:
    """uid, text (binary) of the wanted sets, each from the document with the least doc_id that has it."""
    wanted = keys.where("uid is not null").join(uids, "uid", "left_semi").groupBy("uid").agg(F.min(F.struct("doc_id", "key")).alias("of"))
    wanted = materialize(wanted.select("uid", F.col("of.doc_id").alias("of_id"), F.col("of.key").alias("key")), "jaccard-wanted")
    texts = docs.select(F.xxhash64("text").alias("key"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    found = texts.join(small_side(wanted), (texts.key == wanted.key) & texts.doc_id.eqNullSafe(wanted.of_id))
    return found.select("uid", "text")


def own_sets(column: pa.Array, shingle: int) -> list[np.ndarray]:
    """The sorted distinct hashes of each text."""
    hashes, of, _ = shingle_sets(column, shingle)
    hashes, of = distinct_shingles(hashes, of)
    return np.split(hashes, np.searchsorted(of, np.arange(1, len(column))))


def signatures(texts: DataFrame, shingle: int) -> DataFrame:
    """uid, n, signature (bitmap of the set), slack (shingles beyond one per bit)."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "text"):
            n, bitmaps, slack = [], [], []
            for own in own_sets(rows.column(1), shingle):
                bits = np.zeros(BITS, bool)
                bits[(own & np.uint64(BITS - 1)).astype(np.int64)] = True
                n.append(len(own))
                bitmaps.append(np.packbits(bits).tobytes())
                slack.append(len(own) - int(bits.sum()))
            yield pa.record_batch([rows.column(0), pa.array(n, pa.int32()), pa.array(bitmaps, pa.binary()), pa.array(slack, pa.int32())],
                                  names=["uid", "n", "signature", "slack"])

    return texts.select("uid", "text").mapInArrow(sign, "uid long, n int, signature binary, slack int")


def verified(pairs: DataFrame, texts: DataFrame, shingle: int, num: int, den: int, part_sets: int = PART_SETS) -> DataFrame:
    """Of the pairs (a, b), distinct, those whose sets link. The pairs of an a are dealt in
    parts of about ``part_sets``; a task holds the set of one a and reads its partners by."""
    parts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / F.lit(part_sets)).cast("int").alias("parts"))
    members = pairs.join(parts, "a").select(F.col("b").alias("uid"), "a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("second"))
    heads = parts.select(F.col("a").alias("uid"), "a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("second"))
    roles = materialize(heads.unionByName(members), "jaccard-roles")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, own = None, np.empty(0, np.uint64)
        for rows in slices(batches, "text"):
            left, right = [], []
            uid, a, part, second = (rows.column(i).to_pylist() for i in range(4))
            for i, mine in enumerate(own_sets(rows.column(4), shingle)):
                if not second[i]:
                    head, own = (a[i], part[i]), mine
                    continue
                if head != (a[i], part[i]):
                    raise ValueError("a pair without its first set")
                at = np.searchsorted(own, mine)
                both = int((own[np.minimum(at, len(own) - 1)] == mine).sum()) if len(own) else 0
                if den * both >= num * (len(own) + len(mine) - both):
                    left.append(a[i])
                    right.append(uid[i])
            yield pa.record_batch({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})

    dealt = texts.join(small_side(roles), "uid").repartition("a", "part").sortWithinPartitions("a", "part", "second")
    return dealt.select("uid", "a", "part", "second", "text").mapInArrow(compare, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """uid, comp (the least uid that links reach) of all uids in links. Every round each
    uid's neighbours are hung on the least of them (Kiveris et al. 2014: large star,
    small star), written out, until nothing changes."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    edges = materialize(edges, "jaccard-edges")

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = state(edges)
    while True:
        # Large star: the greater neighbours of u are hung on its least neighbour (or itself).
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        large = materialize(large, "jaccard-edges")
        # Small star: the lesser neighbours of u and u itself are hung on the least.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()
        edges = materialize(small, "jaccard-edges")
        before, now = now, state(edges)
        if now == before:
            break
    tops = edges.select(F.col("v").alias("uid")).distinct().select("uid", F.col("uid").alias("comp"))
    return edges.select(F.col("u").alias("uid"), F.col("v").alias("comp")).unionByName(tops)


def overlap_bound(sizes_a, bits_a, slack_a, sizes_b, bits_b, slack_b) -> np.ndarray:
    """Greatest possible overlap of members of a and b, element by element: the shared
    bits, and the shingles that one side has beyond one per bit."""
    shared = POPCOUNT[bits_a & bits_b].sum(axis=-1, dtype=np.int64)
    return np.minimum(shared + np.minimum(slack_a, slack_b), np.minimum(sizes_a, sizes_b))


POPCOUNT = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def may_link(low_a, high_a, bits_a, slack_a, low_b, high_b, bits_b, slack_b, num: int, den: int) -> np.ndarray:
    """Whether any member of a may link with any of b. J >= num / den needs an overlap of
    num (x + y) / (den + num) and sizes within num / den."""
    sizes = (den * high_a >= num * low_b) & (den * high_b >= num * low_a)
    most = overlap_bound(high_a, bits_a, slack_a, high_b, bits_b, slack_b)
    return sizes & (most * (den + num) >= num * (low_a + low_b))


def nodes_of(members: DataFrame, by: list[str]) -> DataFrame:
    """by, low, high, signature (OR), slack: tree nodes over the members (signature, n, slack) of each group."""
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, low, high, slack, bits = None, 0, 0, 0, None
        for batch in batches:
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(len(by)))))
            n, s = batch.column(len(by)).to_pylist(), batch.column(len(by) + 1).to_pylist()
            own = batch.column(len(by) + 2).to_pylist()
            out = []
            for k, size, more, signature in zip(keys, n, s, own):
                mine = np.frombuffer(signature, np.uint8)
                if k != now:
                    if now is not None:
                        out.append((*now, low, high, slack, bits.tobytes()))
                    now, low, high, slack, bits = k, size, size, more, mine
                else:
                    low, high, slack, bits = min(low, size), max(high, size), max(slack, more), bits | mine
            yield as_batch(out)
        yield as_batch([] if now is None else [(*now, low, high, slack, bits.tobytes())])

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [*[pa.int64()] * len(by), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
        return pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=[*by, "low", "high", "slack", "signature"])

    dealt = members.select(*(F.col(c).cast("long").alias(c) for c in by), "n", "slack", "signature").repartition(*by).sortWithinPartitions(*by)
    return dealt.mapInArrow(join, ", ".join(f"{c} long" for c in by) + ", low int, high int, slack int, signature binary")


def side(frame: DataFrame, name: str, keys: list[str]) -> DataFrame:
    return frame.select(*(F.col(k).alias(f"{name}_{k}") for k in keys), *(F.col(c).alias(f"{name}_{c}") for c in ("low", "high", "slack", "signature")))


def pruned(pairs: DataFrame, keys: list[str], num: int, den: int) -> DataFrame:
    """The pairs (sides a and b) that may link, without their signatures."""
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(keys)
        for batch in batches:
            column = lambda i: batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64)
            bits = lambda i: np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            if not batch.num_rows:
                continue
            good = may_link(column(k), column(k + 1), bits(k + 3), column(k + 2), column(k + 4), column(k + 5), bits(k + 7), column(k + 6), num, den)
            yield pa.RecordBatch.from_arrays(batch.columns[:k], names=keys).filter(pa.array(good))

    columns = [f"{s}_{c}" for s in "ab" for c in ("low", "high", "slack", "signature")]
    return pairs.select(*keys, *columns).mapInArrow(keep, ", ".join(f"{c} long" for c in keys))


def packed_nodes(placed: DataFrame) -> DataFrame:
    """comp, node and the node's sets in equally long lists: uids, sizes, slacks, signatures (one after the other)."""
    rows = placed.groupBy("comp", "node").agg(F.collect_list(F.struct("uid", "n", "slack", "signature")).alias("sets"))  # node_sets at most
    return rows.select("comp", "node", F.col("sets.uid").alias("uids"), F.col("sets.n").alias("sizes"),
                       F.col("sets.slack").alias("slacks"), F.col("sets.signature").alias("signatures"))


def leaf_pairs(nodes: DataFrame, packed: DataFrame, num: int, den: int) -> DataFrame:
    """a, b: the pairs of sets of the pairs of nodes (a_comp, a_node, b_comp, b_node) that may link."""
    lists = ("uids", "sizes", "slacks", "signatures")
    for s in "ab":
        own = packed.select(F.col("comp").alias(f"{s}_comp"), F.col("node").alias(f"{s}_node"), *(F.col(c).alias(f"{s}_{c}") for c in lists))
        nodes = nodes.join(own, [f"{s}_comp", f"{s}_node"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = [], []
            for row in range(batch.num_rows):
                (a, low_a, slack_a, bits_a), (b, low_b, slack_b, bits_b) = (
                    [*(np.array(batch.column(i + j)[row].as_py(), np.int64) for j in range(3)),
                     np.frombuffer(b"".join(batch.column(i + 3)[row].as_py()), np.uint8).reshape(-1, BITS // 8)] for i in (0, 4))
                for i in range(len(a)):
                    good = may_link(low_a[i], low_a[i], bits_a[i], slack_a[i], low_b, low_b, bits_b, slack_b, num, den)
                    left += [int(a[i])] * int(good.sum())
                    right += b[good].tolist()
            yield pa.record_batch({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})

    return nodes.select(*(f"{s}_{c}" for s in "ab" for c in lists)).mapInArrow(compare, "a long, b long")


def root_pairs(met: DataFrame, roots: DataFrame, num: int, den: int, block_roots: int = BLOCK_ROOTS) -> DataFrame:
    """a_comp, b_comp: different components that meet on a shingle and whose roots may
    link. The roots on a shingle are cut into blocks in order of size; every pair of
    blocks of compatible sizes is compared in one group."""
    order = Window.partitionBy("token").orderBy("low", "comp")
    blocked = met.join(roots, "comp").withColumn("block", F.floor((F.row_number().over(order) - 1) / block_roots).cast("int"))
    range_of = blocked.groupBy("token", "block").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    x, y = range_of.alias("x"), range_of.alias("y")
    fits = (F.col("x.token") == F.col("y.token")) & (F.col("x.block") <= F.col("y.block")) & (
        F.col("x.high") * den >= F.col("y.low") * num) & (F.col("y.high") * den >= F.col("x.low") * num)
    tasks = x.join(y, fits).select(F.col("x.token").alias("token"), F.col("x.block").alias("i"), F.col("y.block").alias("j"))
    ends = tasks.select("token", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("block"))
    dealt = ends.join(blocked, ["token", "block"]).repartition("token", "i", "j").sortWithinPartitions("token", "i", "j", "block", "comp")

    def traverse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs(key: tuple, rows: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
            comp, low, high, slack, block = (np.array([r[i] for r in rows], np.int64) for i in (0, 1, 2, 3, 5))
            bits = np.frombuffer(b"".join(r[4] for r in rows), np.uint8).reshape(len(rows), -1)
            left, right = np.flatnonzero(block == key[1]), np.flatnonzero(block == key[2])
            a, b = [], []
            for i in left:
                others = right[comp[right] > comp[i]] if key[1] == key[2] else right[comp[right] != comp[i]]
                good = others[may_link(low[i], high[i], bits[i], slack[i], low[others], high[others], bits[others], slack[others], num, den)]
                a.append(np.minimum(comp[i], comp[good]))
                b.append(np.maximum(comp[i], comp[good]))
            return np.concatenate(a or [np.empty(0, np.int64)]), np.concatenate(b or [np.empty(0, np.int64)])

        now, rows = None, []
        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns)):
                if r[:3] != now:
                    if rows:
                        yield pa.record_batch(dict(zip(("a_comp", "b_comp"), pairs(now, rows))))
                    now, rows = r[:3], []
                rows.append(r[3:])
        if rows:
            yield pa.record_batch(dict(zip(("a_comp", "b_comp"), pairs(now, rows))))

    found = dealt.select("token", "i", "j", "comp", "low", "high", "slack", "signature", "block").mapInArrow(traverse, "a_comp long, b_comp long")
    return found.distinct()


def star_candidates(stars: DataFrame, signed: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (hub, set) that their signatures don't rule out."""
    leaf = signed.select("uid", F.col("n").alias("low"), F.col("n").alias("high"), "slack", "signature")
    pairs = stars.select(F.col("a").alias("a_uid"), F.col("b").alias("b_uid"))
    pairs = pairs.join(side(leaf, "a", ["uid"]), "a_uid").join(side(leaf, "b", ["uid"]), "b_uid")
    return pruned(pairs, ["a_uid", "b_uid"], num, den).select(F.col("a_uid").alias("a"), F.col("b_uid").alias("b")).distinct()


def tree_candidates(meets: DataFrame, signed: DataFrame, comps: DataFrame, num: int, den: int, node_sets: int = NODE_SETS) -> DataFrame:
    """a, b: the pairs of sets of different components that the dual traversal can't rule out."""
    met = meets.select("token", "uid").join(comps, "uid", "left").select("token", F.coalesce("comp", "uid").alias("comp"))
    mixed = met.groupBy("token").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x != y").select("token")
    met = materialize(met.join(mixed, "token", "left_semi").distinct(), "jaccard-met")
    involved = meets.select("uid").distinct().join(comps, "uid", "left").withColumn("comp", F.coalesce("comp", "uid"))
    involved = materialize(involved.join(met.select("comp").distinct(), "comp", "left_semi"), "jaccard-involved")
    order = Window.partitionBy("comp").orderBy("n", "uid")
    placed = signed.join(involved, "uid").withColumn("node", F.floor((F.row_number().over(order) - 1) / node_sets))
    placed = materialize(placed, "jaccard-placed")
    nodes = materialize(nodes_of(placed, ["comp", "node"]), "jaccard-nodes")
    roots = nodes_of(nodes.select("comp", F.col("low").alias("n"), "slack", "signature").unionByName(
        nodes.select("comp", F.col("high").alias("n"), "slack", "signature")), ["comp"])
    pairs = materialize(root_pairs(met, roots, num, den), "jaccard-roots")
    keys = ["comp", "node"]
    down = pairs.join(side(nodes, "a", keys), "a_comp").join(side(nodes, "b", keys), "b_comp")
    down = pruned(down, ["a_comp", "a_node", "b_comp", "b_node"], num, den)
    return leaf_pairs(down, packed_nodes(placed), num, den).distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, num: int = NUM, den: int = DEN) -> DataFrame:
    """doc_id, key (hash of the text), component (null without words), n_shingles,
    component_id; one row per document."""
    keys = materialize(counted_keys(document_keys(docs, shingle)), "jaccard-keys")
    bitmap = partnered(keys, num, den)
    entries = prefixes(docs, bitmap, rarity_levels(sketch_rows(docs, bitmap, shingle)), shingle, num, den)
    meets = materialize(distinct_groups(materialize(meetings(entries), "jaccard-all-meets")), "jaccard-meets")
    texts = materialize(candidate_texts(docs, meets.select("uid").distinct(), keys), "jaccard-texts")
    sizes = (F.col("n") * den >= F.col("hub_n") * num) & (F.col("hub_n") * den >= F.col("n") * num)
    stars = meets.where(sizes & (F.col("uid") != F.col("hub"))).select(F.col("hub").alias("a"), F.col("uid").alias("b")).distinct()
    signed = materialize(signatures(texts, shingle), "jaccard-signed")
    stars = materialize(star_candidates(stars, signed, num, den), "jaccard-stars")
    links = materialize(verified(stars, texts, shingle, num, den), "jaccard-links")
    comps = materialize(components(links), "jaccard-comps")
    pairs = materialize(tree_candidates(meets, signed, comps, num, den), "jaccard-pairs")
    more = materialize(verified(pairs, texts, shingle, num, den), "jaccard-links")
    if not more.isEmpty():
        comps = components(links.unionByName(more))
    rows = keys.where("uid is not null").join(comps, "uid", "left").withColumn(
        "component", F.when(F.col("n") > 0, F.coalesce("comp", "uid")))
    least = rows.where("n > 0").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    columns = ["doc_id", "key", "component", F.col("n").alias("n_shingles")]
    return rows.where("n > 0").join(least, "component").select(*columns, "component_id").unionByName(
        rows.where("n = 0").select(*columns, F.col("doc_id").alias("component_id")))


def components_of(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_shingles, component_id; one row per document."""
    return near_duplicates(docs, **options).select("doc_id", "n_shingles", "component_id")


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each component: that with the least doc_id (null last),
    then the least hash of its text, then the least of its other columns (maps don't count), however the
    rows are dealt. Documents without words all stay. ``docs`` may have columns of any names."""
    found = near_duplicates(docs, **options)
    first = found.where("component is not null").groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")).alias("kept"))
    copies = found.groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("copies"))
    one = first.select("kept.doc_id", "kept.key").join(copies.withColumnRenamed("doc_id", "of_id"), "key").where(F.col("doc_id").eqNullSafe(F.col("of_id")))
    keep = one.select(F.col("doc_id").alias("kept_id"), F.col("key").alias("kept_key"), (F.col("copies") > 1).alias("choose"))
    keep = keep.unionByName(found.where("component is null").select(
        F.col("doc_id").alias("kept_id"), F.col("key").alias("kept_key"), F.lit(False).alias("choose")).distinct())
    keep = materialize(keep, "jaccard-kept")
    # The rows are one struct column: their own names can't clash with those used here.
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    rows = docs.select(whole, F.xxhash64("text").alias("key"), F.col("doc_id").cast("long").alias("doc_id"))
    rows = rows.join(small_side(keep), (F.col("key") == F.col("kept_key")) & F.col("doc_id").eqNullSafe(F.col("kept_id")))
    others = [F.col("row")[c] for c, t in docs.dtypes if c != "text" and "map<" not in t]
    nth = F.row_number().over(Window.partitionBy("key", "doc_id").orderBy(*others))  # of rows with equal ids and texts only
    chosen = rows.where("choose").withColumn("nth", nth).where("nth = 1")
    return rows.where("not choose").select("row.*").unionByName(chosen.select("row.*"))


#: DuckDB: all pairs that share a shingle, counted; components by transitive closure.
SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
sh AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN []
    ELSE list_transform(range(1, greatest(len(ws) - 4, 1) + 1), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS s FROM w),
flat AS (SELECT doc_id, unnest(s) AS g FROM sh),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM flat a JOIN flat b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (
  SELECT x, y FROM shared JOIN sh p ON p.doc_id = x JOIN sh q ON q.doc_id = y
  WHERE 100 * k >= 75 * (len(p.s) + len(q.s) - k)),
near AS (SELECT x AS u, y AS v FROM link UNION ALL SELECT y, x FROM link),
reach AS (SELECT doc_id AS u, doc_id AS v FROM sh UNION SELECT reach.u, near.v FROM reach JOIN near ON near.u = reach.v)
SELECT sh.doc_id, len(s)::BIGINT AS n_shingles, m AS component_id
FROM sh JOIN (SELECT u, min(v) AS m FROM reach GROUP BY u) ON u = doc_id
"""
