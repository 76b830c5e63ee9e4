"""Exact top-k search over binary codes by incremental multi-index hashing.

Method
    A vector's code has one bit per dimension: 1 where it is above 0. A code is cut
    into segments of ``segment_bits``. If two codes differ in fewer than
    segments * (r + 1) bits, some segment differs in at most r. Round r joins the
    queries' segment values at distance r (all flips of r bits) with the index of
    (segment, value) and verifies the whole codes' distances of what meets. A query is
    done when its k-th verified distance is below segments * (r + 1): nothing that no
    segment has shown within radius r can be nearer. Only open queries enter the next
    round, so the radii grow as far as needed and no further.

    Vectors with the same code are one entry of the index, with a list of their k + 1
    least ids: a result never takes more of one code, so this loses nothing and a group
    of copies of any size is one row. Queries with the same code are searched once.
    The k best of a round are kept per query by a partial window before the shuffle.

Result: of each query (every vector whose id is divisible by ``every``) the k nearest
other vectors by (distance, id), exact.

Defined cases
    Null vectors and null ids are not in the index and not queries. A null element or a
    missing one counts as bit 0. All elements count: ``dims`` is the longest vector's length
    (a given ``dims`` ignores elements beyond it; the SQL states ``DIMS``). Equal ids are one
    vector of each of its codes. With fewer than k other vectors all are returned. An
    empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tardy.session import materialize

K = 10
EVERY = 100
DIMS, SEGMENT_BITS = 64, 16


def segments(embedding: Column, dims: int = DIMS, segment_bits: int = SEGMENT_BITS) -> Column:
    """The code: an array of segment values."""
    def value(first: int) -> Column:
        bits = [F.when(F.get(embedding, F.lit(i)) > 0, F.lit(1 << (i - first))).otherwise(0) for i in range(first, min(first + segment_bits, dims))]
        return sum(bits[1:], bits[0])

    return F.array(*(value(first).cast("int") for first in range(0, dims, segment_bits)))


def distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def flips(bits: int, radius: int) -> Column:
    """All values of ``bits`` bits with ``radius`` ones, as one array literal."""
    values = [sum(1 << i for i in chosen) for chosen in combinations(range(bits), radius)]
    return F.from_json(F.lit(str(values)), "array<int>")


def code_index(vectors: DataFrame, k: int, dims: int = DIMS, segment_bits: int = SEGMENT_BITS) -> DataFrame:
    """code, ids (the k + 1 least): a row per code."""
    coded = vectors.where("vec_id is not null and embedding is not null").select(
        F.col("vec_id").cast("long").alias("vec_id"), segments(F.col("embedding"), dims, segment_bits).alias("code"))
    order = Window.partitionBy("code").orderBy("vec_id")
    least = coded.withColumn("nth", F.dense_rank().over(order)).where(F.col("nth") <= k + 1)
    return least.groupBy("code").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))


def by_segment(codes: DataFrame) -> DataFrame:
    """Adds segment and value: a row per code and segment."""
    return codes.select("*", F.posexplode("code").alias("segment", "value"))


def search(vectors: DataFrame, k: int = K, every: int = EVERY, dims: int | None = None, segment_bits: int = SEGMENT_BITS) -> DataFrame:
    """query_id, rank (1 to k), vec_id, distance. Without ``dims`` the longest vector has them, ``DIMS`` at least."""
    if dims is None:
        dims = max(DIMS, vectors.agg(F.max(F.size("embedding"))).first()[0] or 0)
    count = -(-dims // segment_bits)
    index = materialize(code_index(vectors, k, dims, segment_bits), "topk-index")
    wanted = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.col("vec_id") % every == 0))
    queries = materialize(wanted.select(F.col("vec_id").cast("long").alias("query_id"),
                                        segments(F.col("embedding"), dims, segment_bits).alias("code")).distinct(), "topk-queries")
    # A code's ids may hold the query itself, hence k + 1 ids per query code.
    entries = by_segment(index.withColumn("n", F.size("ids")))
    best = None
    open_codes = queries.select(F.col("code").alias("q_code")).distinct()
    for radius in range(segment_bits + 1):
        probes = open_codes.select("q_code", F.posexplode("q_code").alias("segment", "q_value"))
        probes = probes.withColumn("flip", F.explode(flips(segment_bits, radius)))
        probes = probes.select("q_code", "segment", F.col("q_value").bitwiseXOR(F.col("flip")).alias("value"))
        # The flips multiply the probes beyond what the planner expects of the few queries: no broadcast.
        found = probes.hint("merge").join(entries, ["segment", "value"]).select("q_code", "code", "ids", "n", distance(F.col("q_code"), F.col("code")).alias("distance"))
        found = found.dropDuplicates(["q_code", "code"]) if best is None else found.unionByName(
            best.join(open_codes, "q_code", "left_semi")).dropDuplicates(["q_code", "code"])
        # Codes in order of distance until k + 1 ids lie before: no later one can be in a result.
        order = Window.partitionBy("q_code").orderBy("distance")
        top = found.withColumn("nth", F.rank().over(order)).where(F.col("nth") <= k + 1).drop("nth")
        before = F.coalesce(F.sum("n").over(order.rangeBetween(Window.unboundedPreceding, -1)), F.lit(0))
        top = top.withColumn("before", before).where(F.col("before") <= k).drop("before")
        kept = top if best is None else top.unionByName(best.join(open_codes, "q_code", "left_anti"))
        best = materialize(kept, "topk-best")
        # The distance by which k others are certain (the query may be one of the ids).
        best_sum = best.withColumn("sum", F.sum("n").over(order.rangeBetween(Window.unboundedPreceding, Window.currentRow)))
        reach = best_sum.where(F.col("sum") > k).groupBy("q_code").agg(F.min("distance").alias("kth"))
        covered = reach.where(F.col("kth") < count * (radius + 1)).select("q_code")
        open_codes = materialize(open_codes.join(covered, "q_code", "left_anti"), "topk-open")
        if open_codes.isEmpty():
            break
    near = queries.join(best, queries["code"] == best["q_code"]).select("query_id", "distance", F.explode("ids").alias("vec_id"))
    near = near.where("vec_id != query_id").groupBy("query_id", "vec_id").agg(F.min("distance").alias("distance"))
    order = Window.partitionBy("query_id").orderBy("distance", "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "distance")


#: DuckDB: every query against every vector.
SQL = f"""
WITH v AS (SELECT vec_id, embedding AS e FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
d AS (
  SELECT q.vec_id AS query_id, v.vec_id,
    list_sum(list_transform(range(1, {DIMS + 1}), lambda i: (coalesce(q.e[i] > 0, false) <> coalesce(v.e[i] > 0, false))::INTEGER)) AS distance
  FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % {EVERY} = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM d)
SELECT query_id, rank::INTEGER AS rank, vec_id, distance::INTEGER AS distance FROM r WHERE rank <= {K}
"""
