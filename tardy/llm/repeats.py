"""Suffix-array deduplication: every byte inside a repeated window of ``WINDOW`` bytes.

Only the order of suffixes through their first ``WINDOW`` bytes matters: two suffixes
are in one group of it exactly if their windows are equal. So a most-significant-digit
radix sort of that depth is done, and groups of one suffix are dropped as soon as a
pass has split them off.

Method
    1. First pass, as routing: a window's digit is the hash of its least 64-byte gram
       (in the order of 40 bits of the hash, the leftmost of equals). It depends on the
       window's bytes only, so equal windows have the same digit and have it at the
       same offset. Windows next to each other mostly share the gram; such a run is a
       segment: one row of a few numbers for about 70 windows, with a digest of its bytes.
    2. Segments with the same gram and the same bytes repeat whole. A task emits each
       different segment once (the others of the task are known to repeat), and these
       rows are shuffled once, by gram. Grams of only one segment are done: nothing else
       starts with that digit.
    3. Of the other grams each distinct segment's bytes are fetched once, and the windows
       of each gram are sorted by further passes of eight bytes, on the bytes themselves.
       What is left after the last pass repeats.
    4. A gram with more than ``hot_segments`` distinct segments isn't sorted in one task:
       its windows are counted by a 128-bit digest, with map-side combine.

Texts of documents aren't shuffled unless they hold a repeated gram; long texts are cut
into pieces that overlap by a window, so a task's memory doesn't grow with a text.

Defined cases
    A null text is empty: 0 bytes, nothing removed. Matches never cross documents. A
    document whose text occurs twice is repeated in both. Rows with equal doc_ids are
    documents of their own. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tardy.llm.words import binary_buffers, mix64
from tardy.session import materialize

WINDOW = 200
PIECE_BYTES = 2 << 20
HOT_SEGMENTS = 4096
#: Distinct segments that are sorted at once, at least, if there are as many.
SORT_SEGMENTS = 1500
#: Documents whose texts may be picked by a broadcast of their ids; more are shuffled.
BROADCAST_ROWS = 250_000
_BASE = np.uint64(0xD1342543DE82EF95)


def gram_bytes(window: int) -> int:
    """Bytes of a gram: 64, or less (16 times a power of two) for short windows. The longer, the fewer grams
    unrelated texts share, and the more segments there are: one to about (window - gram) / 2 windows."""
    if window < 16:
        raise ValueError(f"a window of {window} bytes is too short")
    return 64 if window >= 128 else 32 if window >= 64 else 16


def eights(data: np.ndarray) -> np.ndarray:
    """For each byte the number that it and the next seven are (zeros beyond the end)."""
    padded = np.concatenate((data, np.zeros(16, np.uint8)))
    out = np.empty(len(data) + 8, np.uint64)
    for o in range(8):
        own = np.frombuffer(padded[o:o + (len(padded) - o) // 8 * 8].tobytes(), "<u8")
        out[o::8] = own[:len(out[o::8])]
    return out[:len(data)]


def powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


def sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` keys in a row."""
    span, least = 1, keys
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    return np.minimum(least[:len(least) - (width - span)], least[width - span:]) if width > span else least


def segments_of(data: np.ndarray, ends: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """(text, first window, windows, offset of the gram in the first window, gram's hash,
    digest of all their bytes) of each segment of the texts data[ends[t]:ends[t + 1]]."""
    none = tuple(np.empty(0, np.int64) for _ in range(4)) + tuple(np.empty(0, np.uint64) for _ in range(2))
    if len(data) < window:
        return none
    gram = gram_bytes(window)
    eight = eights(data)
    with np.errstate(over="ignore"):
        h, span = mix64(eight[:-8] * _BASE + mix64(eight[8:]))[:len(data) - 15], 16
        while span < gram:
            h, span = mix64(h[:-span] * _BASE + h[span:]), 2 * span
    place = np.arange(len(h), dtype=np.uint64)
    least = sliding_least((h & ~np.uint64((1 << 24) - 1)) | place, window - gram + 1)[:len(data) - window + 1]
    anchor = (least & np.uint64((1 << 24) - 1)).astype(np.int64)
    lengths = np.diff(ends)
    text = np.repeat(np.arange(len(lengths)), np.maximum(lengths - window + 1, 0))
    if not len(text):
        return none
    per = np.maximum(lengths - window + 1, 0)
    start = np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per) + ends[:-1][text]
    anchor = anchor[start]
    head = np.ones(len(start), bool)
    head[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(head)
    n = np.diff(np.concatenate((first, [len(start)])))
    begin, gram_at = start[first], anchor[first]
    stop = begin + n - 1 + window - gram + 1  # of the grams
    with np.errstate(over="ignore"):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * powers(len(h), _BASE), dtype=np.uint64)))
        inverse = powers(len(h), np.uint64(pow(int(_BASE), -1, 1 << 64)))
        digest = mix64((sums[stop] - sums[begin]) * inverse[begin] + mix64((n * 1024 + gram_at - begin).astype(np.uint64)))
    return text[first], begin, n, gram_at - begin, h[gram_at], digest


def pieces(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.RecordBatch]]:
    """(bytes, ends, row of each text, its offset in the row's text, batch): the texts
    of column ``text``, long ones in pieces that overlap by window - 1 bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, ends = binary_buffers(batch.column(batch.schema.get_field_index("text")))
        row = 0
        while row < batch.num_rows:
            to = max(row + 1, int(np.searchsorted(ends, ends[row] + PIECE_BYTES, side="right")) - 1)
            if to == row + 1 and ends[to] - ends[row] > PIECE_BYTES:
                for at in range(int(ends[row]), max(int(ends[to]) - window + 1, int(ends[row]) + 1), PIECE_BYTES):
                    stop = min(at + PIECE_BYTES + window - 1, int(ends[to]))
                    yield data[at:stop], np.array([0, stop - at]), np.array([row]), np.array([at - int(ends[row])]), batch
            else:
                yield data[ends[row]:ends[to]], ends[row:to + 1] - ends[row], np.arange(row, to), np.zeros(to - row, np.int64), batch
            row = to


def with_ref(docs: DataFrame) -> DataFrame:
    """doc_id, ref (a number of the document), text (binary). The doc_id serves if it is unique and
    never null; else a hash of doc_id and text, which rows that are equal in both share."""
    ids = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    plain = ids.where("n > 1 or doc_id is null").isEmpty()
    ref = F.col("doc_id").cast("long") if plain else F.xxhash64("doc_id", "text")
    return docs.select("doc_id", ref.alias("ref"), F.col("text").cast("binary").alias("text"))


PLACE = "place"  # of a segment in its document: first window, windows and offset of the gram in one number


def place_bits(window: int) -> int:
    """Bits of the number of windows and of the offset, each at most window - gram + 1."""
    bits = max(8, (window - gram_bytes(window) + 1).bit_length())
    if bits > 16:  # the first window is below 2^31
        raise ValueError(f"a window of {window} bytes is too long")
    return bits


def unpacked(place: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    low = (1 << bits) - 1
    return place >> 2 * bits, place >> bits & low, place & low


def segment_rows(texts: DataFrame, window: int) -> DataFrame:
    """gram, digest, ref, place, copies: each different segment of a task once; and, without
    a gram, ref, start, stop of the segments that the same task has twice. So a segment of
    any number of copies is a row per task at most before anything is shuffled."""
    bits = place_bits(window)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[np.ndarray, ...]] = []
        for data, ends, row, offset, batch in pieces(batches, window):
            text, begin, n, at, gram, digest = segments_of(data, ends, window)
            ref = batch.column(0).to_numpy()[row[text]]
            found.append((gram.view(np.int64), digest.view(np.int64), ref, begin - ends[:-1][text] + offset[text] << 2 * bits | n << bits | at))
        if not found:
            return
        gram, digest, ref, place = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((digest, gram))
        gram, digest, ref, place = (x[order] for x in (gram, digest, ref, place))
        head = np.ones(len(gram), bool)
        head[1:] = (gram[1:] != gram[:-1]) | (digest[1:] != digest[:-1])
        copies = np.bincount(np.cumsum(head) - 1) if len(gram) else np.empty(0, np.int64)
        for part in np.array_split(np.flatnonzero(head), 1 + len(copies) // 100_000):
            own = copies[np.cumsum(head)[part] - 1]
            yield as_batch([gram[part], digest[part], ref[part], place[part], own, None, None])
        again = np.flatnonzero(np.repeat(copies > 1, copies))
        for part in np.array_split(again, 1 + len(again) // 100_000):
            start, n, _ = unpacked(place[part], bits)
            yield as_batch([None, None, ref[part], None, None, start, start + n - 1 + window])

    def as_batch(columns: list) -> pa.RecordBatch:
        rows = len(columns[2])
        return pa.record_batch([pa.nulls(rows, pa.int64()) if c is None else pa.array(c, pa.int64()) for c in columns], names=names)

    names = ["gram", "digest", "ref", PLACE, "copies", "start", "stop"]
    return texts.select("ref", "text").mapInArrow(cut, ", ".join(f"{n} long" for n in names))


def fetched(texts: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """The wanted segments (ref, place, gram, times) with their ``bytes``."""
    bits = place_bits(window)
    of = wanted.groupBy("ref").agg(F.collect_list(F.struct(PLACE, "gram", "times")).alias("of"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                rows = []
                for ref, text, own in zip(part.column(0).to_pylist(), part.column(1), part.column(2)):
                    text = text.as_buffer()
                    for r in own.as_py():
                        start, n, _ = unpacked(r[PLACE], bits)
                        rows.append((ref, r[PLACE], r["gram"], r["times"], text.slice(start, n + window - 1).to_pybytes()))
                yield pa.record_batch([pa.array([r[i] for r in rows], kind) for i, kind in enumerate((*[pa.int64()] * 4, pa.binary()))],
                                      names=["ref", PLACE, "gram", "times", "bytes"])

    found = texts.join(of, "ref").select("ref", "text", "of")
    return found.mapInArrow(cut, f"ref long, {PLACE} long, gram long, times long, bytes binary")


def repeated_windows(gram: np.ndarray, n: np.ndarray, at: np.ndarray, contents: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray]:
    """(segment, window) of the windows that some other segment of the same gram has at
    the same offset from the gram: passes of eight bytes, groups of one dropped after each."""
    data = np.frombuffer(b"".join(contents), np.uint8)
    base = np.concatenate(([0], np.cumsum([len(c) for c in contents])))[:-1]
    eight = eights(data)
    segment = np.repeat(np.arange(len(n)), n)
    number = np.arange(len(segment)) - np.repeat(np.cumsum(n) - n, n)
    start = base[segment] + number
    same_gram = np.unique(gram, return_inverse=True)[1][segment]
    group = same_gram * np.int64(4096) + (number - at[segment] + 2048)
    for place in range(0, window, 8):
        if not len(group):
            break
        digit = eight[start + min(place, window - 8)]
        order = np.lexsort((digit, group))
        g, d = group[order], digit[order]
        change = np.ones(len(g), bool)
        change[1:] = (g[1:] != g[:-1]) | (d[1:] != d[:-1])
        label = np.cumsum(change) - 1
        many = np.bincount(label)[label] > 1
        kept = order[many]
        group, segment, number, start = label[many], segment[kept], number[kept], start[kept]
    order = np.lexsort((number, segment))
    return segment[order], number[order]


COVER = "ref long, start long, stop long"


def ranges_of(segment: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, first window, last window) of the runs of windows."""
    if not len(segment):
        return segment, number, number
    head = np.ones(len(segment), bool)
    head[1:] = (segment[1:] != segment[:-1]) | (number[1:] != number[:-1] + 1)
    first = np.flatnonzero(head)
    last = np.concatenate((first[1:], [len(segment)])) - 1
    return segment[first], number[first], number[last]


def sorted_covers(contents: DataFrame, window: int) -> DataFrame:
    """ref, start, stop: the bytes under repeated windows of segments that occur once."""
    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            for at in range(0, batch.num_rows, SORT_SEGMENTS):
                held.append(batch.slice(at, SORT_SEGMENTS))
                rows += held[-1].num_rows
                if rows >= 2 * SORT_SEGMENTS:
                    whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                    gram = whole.column(2).to_numpy()
                    cut = int(np.searchsorted(gram, gram[-1]))  # the last gram may go on
                    if cut:
                        yield covers(whole.slice(0, cut))
                        held = [whole.slice(cut)]
                        rows -= cut
        if held:
            yield covers(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    def covers(rows: pa.RecordBatch) -> pa.RecordBatch:
        ref, place, gram, times = (rows.column(i).to_numpy() for i in range(4))
        start, n, at = unpacked(place, place_bits(window))
        segment, first, last = ranges_of(*repeated_windows(gram, n, at, rows.column(4).to_pylist(), window))
        once = times[segment] == 1
        segment, first, last = segment[once], first[once], last[once]
        return pa.record_batch({"ref": ref[segment], "start": start[segment] + first, "stop": start[segment] + last + window})

    return contents.repartition("gram").sortWithinPartitions("gram").mapInArrow(sort, COVER)


def counted_covers(contents: DataFrame, window: int) -> DataFrame:
    """The same for grams of very many distinct segments: windows are counted by digest."""
    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in range(0, batch.num_rows, 1000):
                out: list[tuple] = []
                for ref, place, gram, times, content in zip(*(c.to_pylist() for c in batch.slice(chunk, 1000).columns)):
                    start, n, at = unpacked(place, place_bits(window))
                    out += [(ref, start + w, gram, w - at, hashlib.md5(content[w:w + window]).digest(), times) for w in range(n)]
                kinds = (*[pa.int64()] * 4, pa.binary(), pa.int64())
                yield pa.record_batch([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=["ref", "start", "gram", "offset", "window", "times"])

    windows = materialize(contents.mapInArrow(explode, "ref long, start long, gram long, offset long, window binary, times long"), "repeats-windows")
    many = windows.groupBy("gram", "offset", "window").agg(F.count(F.lit(1)).alias("seen")).where("seen > 1")
    found = windows.where("times = 1").join(many, ["gram", "offset", "window"], "left_semi")
    return found.select("ref", "start", (F.col("start") + window).alias("stop"))


def picked(texts: DataFrame, refs: DataFrame) -> DataFrame:
    """The texts of the documents in ``refs``: by a broadcast of up to ``BROADCAST_ROWS`` numbers, else shuffled."""
    small = refs.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return texts.select("ref", "text").join(F.broadcast(refs) if small else refs, "ref", "left_semi")


def repeated_spans(texts: DataFrame, window: int = WINDOW, hot_segments: int = HOT_SEGMENTS) -> DataFrame:
    """ref, start, stop of bytes under repeated windows; ranges may overlap. ``texts``: of ``with_ref``."""
    rows = materialize(segment_rows(texts, window), "repeats-segments")
    same, gram = Window.partitionBy("gram", "digest"), Window.partitionBy("gram")
    # One shuffle of the different segments, by gram; the windows share its order.
    kinds = rows.where("gram is not null").select("gram", "digest", "ref", PLACE, "copies").repartition("gram")
    kinds = kinds.withColumn("times", F.sum("copies").over(same)).withColumn("nth", F.row_number().over(same.orderBy("digest")))
    kinds = kinds.withColumn("kinds", F.sum(F.when(F.col("nth") == 1, 1).otherwise(0)).over(gram))
    shared = materialize(kinds.where("times > 1 or kinds > 1"), "repeats-shared")
    bits = place_bits(window)
    start = F.shiftright(PLACE, 2 * bits)
    stop = start + F.shiftright(PLACE, bits).bitwiseAND(F.lit((1 << bits) - 1)) - 1 + window
    covers = rows.where("gram is null").select("ref", "start", "stop").unionByName(
        shared.where("times > 1 and copies = 1").select("ref", start.alias("start"), stop.alias("stop")))
    wanted = shared.where("kinds > 1 and nth = 1").select("ref", PLACE, "gram", "times", "kinds")
    of = materialize(wanted.select("ref").distinct(), "repeats-wanted")
    contents = fetched(picked(texts, of), wanted, window)
    hot_grams = wanted.where(F.col("kinds") > hot_segments).select("gram").distinct()
    number = hot_grams.limit(BROADCAST_ROWS + 1).count()
    if not number:
        return covers.unionByName(sorted_covers(contents, window))
    # Both ways read the same texts: their segments are cut out once.
    contents = materialize(contents, "repeats-contents")
    hot_grams = F.broadcast(hot_grams) if number <= BROADCAST_ROWS else hot_grams
    few, many = (contents.join(hot_grams, "gram", how).select(*contents.columns) for how in ("left_anti", "left_semi"))
    return covers.unionByName(sorted_covers(few, window)).unionByName(counted_covers(many, window))


def without_repeats(texts: DataFrame, **options) -> DataFrame:
    """ref, spans (maximal removed runs), kept (the bytes that remain) of each document that
    loses bytes. ``texts``: of ``with_ref``."""
    covers = repeated_spans(texts, **options)
    per = materialize(covers.groupBy("ref").agg(F.collect_list(F.struct("start", "stop")).alias("ranges")), "repeats-ranges")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                spans, kept = [], []
                for text, ranges in zip(part.column(1), part.column(2)):
                    data = np.frombuffer(text.as_buffer(), np.uint8)
                    pairs = np.array([(r["start"], r["stop"]) for r in ranges.as_py()], np.int64)
                    depth = np.zeros(len(data) + 1, np.int32)
                    np.add.at(depth, pairs[:, 0], 1)
                    np.add.at(depth, pairs[:, 1], -1)
                    gone = np.cumsum(depth[:-1]) > 0
                    edge = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).astype(np.int8)))
                    spans.append([{"start": a, "stop": b} for a, b in edge.reshape(-1, 2).tolist()])
                    kept.append(data[~gone].tobytes())
                yield pa.record_batch([part.column(0), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                                       pa.array(kept, pa.binary())], names=["ref", "spans", "kept"])

    return picked(texts, per.select("ref")).join(per, "ref").select("ref", "text", "ranges").mapInArrow(
        remove, "ref long, spans array<struct<start: long, stop: long>>, kept binary")


def repeats_digest(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    texts = with_ref(docs)
    cut = without_repeats(texts, **options).select(
        F.col("ref").alias("c_ref"), F.octet_length("kept").cast("long").alias("n_kept"),
        F.size("spans").cast("long").alias("n_cut"), F.sha2("kept", 256).alias("cut_sha256"))
    cut = materialize(cut, "repeats-cut").dropDuplicates(["c_ref"])
    text = F.coalesce(F.col("text"), F.lit("").cast("binary"))
    rows = texts.select(F.col("doc_id").cast("long").alias("doc_id"), "ref", F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("whole_sha256"))
    rows = rows.join(cut, F.col("ref") == F.col("c_ref"), "left")
    return rows.select("doc_id", "n_bytes", (F.col("n_bytes") - F.coalesce("n_kept", "n_bytes")).alias("n_removed"),
                       F.coalesce("n_cut", F.lit(0)).cast("long").alias("n_spans"), F.coalesce("cut_sha256", "whole_sha256").alias("kept_sha256"))


#: DuckDB: the digest of every window of every text, as hex strings.
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT r, s, md5(substr(h, 2 * s + 1, {2 * WINDOW})) AS m FROM (SELECT r, h, unnest(range(0, length(h) // 2 - {WINDOW - 1})) AS s FROM d)),
hit AS (SELECT r, s FROM w WHERE m IN (SELECT m FROM w GROUP BY m HAVING count(*) > 1)),
step AS (SELECT r, s, CASE WHEN s <= lag(s) OVER (PARTITION BY r ORDER BY s) + {WINDOW} THEN 0 ELSE 1 END AS fresh FROM hit),
run AS (SELECT r, s, sum(fresh) OVER (PARTITION BY r ORDER BY s) AS k FROM step),
span AS (SELECT r, min(s) AS a, max(s) + {WINDOW} AS b FROM run GROUP BY r, k),
gap AS (
  SELECT r, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS x, a AS y FROM span
  UNION ALL SELECT r, max(b), NULL FROM span GROUP BY r),
kept AS (
  SELECT r, string_agg(substr(h, 2 * x + 1, 2 * (coalesce(y, length(h) // 2) - x)), '' ORDER BY x) AS k FROM gap JOIN d USING (r) GROUP BY r),
per AS (SELECT r, sum(b - a) AS n_removed, count(*) AS n_spans FROM span GROUP BY r)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM d LEFT JOIN kept USING (r) LEFT JOIN per USING (r)
"""
