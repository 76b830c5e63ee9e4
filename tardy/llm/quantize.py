"""Vector code compression: product codes with exact nearest entries by slice-and-intersect bitmasks.

Method
    Components become integers, floor(256 * x). A vector is cut into 16 equal consecutive
    parts; each part position has a codebook of at most 64 entries. The codebooks start as
    the parts of the 64 smallest vec_ids; each round assigns all parts to their nearest
    entries and replaces each entry by the floor of its parts' mean. A code is the entry
    numbers of a vector's parts.

    The nearest entry is found by slice and intersect: in each dimension the entries'
    coordinates are sorted, and the k-th prefix mask has a bit for each of the first k
    entries. The entries within a radius of a coordinate are a range of the sorted ones, so
    their mask is the XOR of two prefix masks; the AND over the dimensions is the set of
    entries in the cube around the part. If the nearest of them is no further than the radius,
    nothing outside the cube is nearer or as near: it is exact. Otherwise the radius becomes
    that distance (or doubles if the cube was empty) and the part is searched once more. The
    first radius is a typical distance between neighbouring entries.

    On Spark: an assignment pass is narrow. A training pass ships (part, entry, position)
    sums, 64 rows a dimension and task, whatever the task reads; what the driver gets are
    the codebooks, 64 entries of a vector's length. Errors are summed per label with
    map-side combine and joined back; the sums are broadcast only up to ``BROADCAST_LABELS`` labels.

Defined cases
    Rows whose vector is null or has a null or non-finite component go. Null vec_ids come
    after all others when the codebooks start, equal vec_ids in the order of their vectors;
    repeated rows all count. With fewer than 64 rows there are as many entries. Shorter
    vectors count as filled up with zeros to the longest one's length, and that to a multiple
    of 16. Components so large that a vector's error could pass a long raise an error. Labels that are
    null are one label. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tardy.session import materialize

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
BROADCAST_LABELS = 100_000
_FAR = np.iinfo(np.int64).max


class Slices:
    """The entries of one part position (a matrix of integers, 64 rows at most)."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        n, width = entries.shape
        bits = np.uint64(1) << np.arange(n, dtype=np.uint64)
        self.all = np.bitwise_or.reduce(bits) if n else np.uint64(0)
        order = np.argsort(entries, axis=0, kind="stable")
        self.coordinates = [entries[order[:, j], j] for j in range(width)]
        self.prefix = [np.concatenate(([np.uint64(0)], np.bitwise_or.accumulate(bits[order[:, j]]))) for j in range(width)]
        apart = ((entries[:, None] - entries[None]) ** 2).sum(2)
        nearest = np.where(apart > 0, apart, _FAR).min(1, initial=_FAR)
        near = nearest[nearest < _FAR]
        self.radius = isqrt(int(np.median(near))) + 1 if len(near) else 1

    def within(self, x: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Masks of the entries in the cubes of ``radius`` around the rows of x."""
        mask = np.full(len(x), self.all)
        for j, coordinates in enumerate(self.coordinates):
            low = np.searchsorted(coordinates, x[:, j] - radius, side="left")
            high = np.searchsorted(coordinates, x[:, j] + radius, side="right")
            mask &= self.prefix[j][high] ^ self.prefix[j][low]
        return mask

    def verified(self, x: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of the nearest of each row's candidates, the lowest of equal ones."""
        best, entry = np.full(len(x), _FAR), np.zeros(len(x), np.int64)
        rows, rest = np.flatnonzero(mask), mask[mask != 0]
        while len(rows):
            low = rest & (~rest + np.uint64(1))
            candidate = np.frexp(low.astype(np.float64))[1] - 1  # exact: one bit
            distance = ((x[rows] - self.entries[candidate]) ** 2).sum(1)
            better = distance < best[rows]
            best[rows[better]], entry[rows[better]] = distance[better], candidate[better]
            rest ^= low
            rows, rest = rows[rest != 0], rest[rest != 0]
        return entry, best

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each row of x, exact."""
        best, entry = np.empty(len(x), np.int64), np.empty(len(x), np.int64)
        todo, radius = np.arange(len(x)), np.full(len(x), self.radius)
        while len(todo):
            mask = self.within(x[todo], radius)
            found, distance = self.verified(x[todo], mask)
            done = (mask != 0) & (distance <= radius * radius)
            entry[todo[done]], best[todo[done]] = found[done], distance[done]
            # A cube of the candidate's distance holds all that may be nearer.
            reach = np.sqrt(np.where(mask != 0, distance, 0).astype(np.float64)).astype(np.int64) + 1
            radius = np.where(mask != 0, reach, 2 * radius)[~done]
            todo = todo[~done]
        return entry, best


def kept_vectors(vectors: DataFrame) -> DataFrame:
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.col("embedding").isNotNull() & finite).withColumn("embedding", F.col("embedding").cast("array<double>"))


def in_parts(column: pa.ListArray, width: int) -> np.ndarray:
    """The integers of the vectors of an Arrow column, filled up with zeros: vector, part, position."""
    dims = PARTS * width
    sizes = np.asarray(column.value_lengths(), np.int64)
    flat = np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False))
    if len(flat) and np.abs(flat).max() > isqrt(_FAR // dims) // 2:
        raise ValueError("a component is too large: the error of a code must fit in a long")
    made = np.zeros((len(column), dims), np.int64)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    made[np.repeat(np.arange(len(column)), sizes), at] = flat.astype(np.int64)
    return made.reshape(len(column), PARTS, width)


def start(vectors: DataFrame) -> np.ndarray:
    """The first codebooks: part, entry, position."""
    kept = kept_vectors(vectors)
    longest = kept.agg(F.max(F.size("embedding"))).first()[0] or 0
    width = -(-longest // PARTS)
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").select("embedding").limit(ENTRIES).collect()
    return in_parts(pa.array([r["embedding"] for r in first], pa.list_(pa.float64())), width).transpose(1, 0, 2)


def refined(vectors: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """The codebooks after one round over all vectors."""
    _, entries, width = codebooks.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [Slices(c) for c in codebooks]
        total, count = np.zeros(codebooks.shape, np.int64), np.zeros((PARTS, entries), np.int64)
        for batch in batches:
            x = in_parts(batch.column(0), width)
            for p, part in enumerate(parts):
                entry, _ = part.nearest(x[:, p])
                np.add.at(total[p], entry, x[:, p])
                count[p] += np.bincount(entry, minlength=entries)
        p, e = np.nonzero(count)
        position = np.tile(np.arange(width), len(p))
        p, e = np.repeat(p, width), np.repeat(e, width)
        yield pa.record_batch([pa.array(c, pa.int64()) for c in (p, e, position, total[p, e, position], count[p, e])], names=["part", "entry", "position", "total", "n"])

    found = kept_vectors(vectors).select("embedding").mapInArrow(sums, "part long, entry long, position long, total long, n long")
    means = found.groupBy("part", "entry", "position").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    new = codebooks.copy()
    for r in means.collect():  # a row per number in the codebooks
        new[r["part"], r["entry"], r["position"]] = int(r["total"]) // r["n"]
    return new


def train(vectors: DataFrame, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks: part, entry, position."""
    codebooks = start(vectors)
    for _ in range(rounds):
        codebooks = refined(vectors, codebooks)
    return codebooks


def encode(vectors: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """vec_id, label, code (hex, two digits a part), error."""
    width = codebooks.shape[2]

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [Slices(c) for c in codebooks]
        for batch in batches:
            x = in_parts(batch.column(2), width)
            found = [part.nearest(x[:, p]) for p, part in enumerate(parts)]
            digits = np.stack([f[0] for f in found], 1).astype(np.uint8).tobytes().hex()
            codes = pa.array([digits[i:i + 2 * PARTS] for i in range(0, len(digits), 2 * PARTS)], pa.string())
            yield pa.record_batch([batch.column(0), batch.column(1), codes, pa.array(sum(f[1] for f in found))], names=["vec_id", "label", "code", "error"])

    rows = kept_vectors(vectors).select("vec_id", "label", "embedding")
    types = dict(rows.dtypes)
    return rows.mapInArrow(code, f"vec_id {types['vec_id']}, label {types['label']}, code string, error long")


def decode(coded: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """vec_id, embedding: the vectors that the codes stand for."""
    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = np.frombuffer(bytes.fromhex("".join(batch.column(1).to_pylist())), np.uint8).reshape(-1, PARTS)
            vectors = np.concatenate([codebooks[p][numbers[:, p]] for p in range(PARTS)], 1) / SCALE
            ends = np.arange(len(vectors) + 1, dtype=np.int32) * vectors.shape[1]
            yield pa.record_batch([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(vectors.ravel()))], names=["vec_id", "embedding"])

    return coded.select("vec_id", "code").mapInArrow(entries, f"vec_id {dict(coded.dtypes)['vec_id']}, embedding array<double>")


def codebooks_sha256(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def codes_digest(vectors: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256."""
    codebooks = train(vectors)
    coded = materialize(encode(vectors, codebooks), "codes")
    labels = materialize(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "code-labels")
    if labels.count() <= BROADCAST_LABELS:
        labels = F.broadcast(labels)
    joined = coded.join(labels.withColumnRenamed("label", "of_label"), F.col("label").eqNullSafe(F.col("of_label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(codebooks_sha256(codebooks)).alias("codebooks_sha256"))


def _assigned(codebook: str) -> str:
    distance = "list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - y[i]) * (x[i] - y[i])))"
    return f"SELECT id, p, any_value(x) AS x, min({{'d': {distance}::BIGINT, 'e': e}}) AS m FROM parts JOIN {codebook} USING (p) GROUP BY id, p"


def _refined(codebook: str, assigned: str) -> str:
    return f"""SELECT c.p, c.e, coalesce(n.y, c.y) AS y FROM {codebook} c LEFT JOIN (
    SELECT p, e, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS y FROM (
      SELECT p, e, i, sum(z) AS s, count(*) AS n FROM (
        SELECT p, m.e AS e, unnest(range(1, len(x) + 1)) AS i, unnest(x) AS z FROM {assigned}) GROUP BY p, e, i) GROUP BY p, e) n USING (p, e)"""


#: DuckDB, for vectors of one length that is a multiple of 16: every part against every entry.
SQL = f"""
WITH k AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS id, vec_id, label,
    list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (SELECT id, p, v[p * len(v) // {PARTS} + 1:(p + 1) * len(v) // {PARTS}] AS x FROM k, (SELECT unnest(range({PARTS})) AS p)),
c0 AS (SELECT p, id - 1 AS e, x AS y FROM parts WHERE id <= {ENTRIES}),
a0 AS ({_assigned("c0")}), c1 AS ({_refined("c0", "a0")}),
a1 AS ({_assigned("c1")}), c2 AS ({_refined("c1", "a1")}),
a2 AS ({_assigned("c2")}),
coded AS (SELECT id, string_agg(format('{{:02x}}', m.e), '' ORDER BY p) AS code, sum(m.d)::BIGINT AS error FROM a2 GROUP BY id),
books AS (SELECT sha256(string_agg(z::VARCHAR, ',' ORDER BY p, e, i)) AS codebooks_sha256 FROM (SELECT p, e, unnest(y) AS z, unnest(range(len(y))) AS i FROM c2))
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM k JOIN coded USING (id), books
"""
