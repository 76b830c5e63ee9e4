"""A prefix trie over conversations, by balanced parentheses.

Method
    A node is a distinct sequence of first turns; it is known by two 64-bit numbers that
    combine the digests of its turns with their depths, so all conversations through a node have
    the same numbers there, and a node's conversations are counted by grouping. Nodes of one conversation
    only (the tail behind the last turn that it shares) need no tree; they are made row by row.

    The shared nodes are a trie of paths, one per distinct last shared node. The paths are sorted (a path is its nodes'
    numbers, so this is a depth-first order) and dealt over shards by ranges. A shard writes its trie as
    balanced parentheses: ``Parentheses`` keeps the excess of each block in a range min-max
    tree, and findclose gives where a node's subtree ends. Leaves in it are counted by the rank of leaf
    pairs "()", and cumulative arrays give savings, both as a difference of two prefix sums.

    The first and the last path of a shard are its spines: their nodes may go on in other
    shards. A shard finishes all others; what these bring to a spine's node (children, leaves,
    savings) goes with the spine into the next level, whose rows are the spines of
    all shards, at most two of each. There the same work merges them, level by level, until
    one shard holds the rest. Each level has a fraction of the rows of the one before.

Result: per node the least member's conv_id, depth, the parent's conv_id, n_convs (members), n_children,
n_leaves and saved_tokens of the subtree (of each node (n_convs - 1) times the bytes of its last text)
and ends_sha256, the digest of the ids of the members that end there.

Defined cases
    Null roles and texts count as empty. Turns of one number are in order of the digests of role and text;
    repeated rows are turns of their own. Rows without a conv_id are not in the trie. A conversation
    without turns is a member of the root alone. An empty table gives an empty result (no root). Extra columns are ignored.
    A digest of the ends of a node is sequential, and so are the turns of one conversation: these stream
    through one task in order, in constant memory, as narrow rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tardy.session import materialize

SHARD_NODES = 1 << 15
BROADCAST_ROWS = 100_000
NODE = ["depth", "p1", "p2"]
_NONE = np.iinfo(np.int64).max


class Parentheses:
    """A sequence of balanced parentheses (1 opens) with a range min-max tree over the excess of its blocks."""

    BLOCK, AT_ONCE = 64, 1 << 13

    def __init__(self, bits: np.ndarray) -> None:
        blocks = -(-len(bits) // self.BLOCK)
        self.excess = np.full(blocks * self.BLOCK, _NONE, np.int64)
        self.excess[:len(bits)] = np.cumsum(2 * bits.astype(np.int64) - 1)
        self.leaves = 1 << max(blocks - 1, 0).bit_length()
        self.least = np.full(2 * self.leaves, _NONE, np.int64)
        self.least[self.leaves:self.leaves + blocks] = self.excess.reshape(blocks, self.BLOCK).min(1, initial=_NONE)
        level = self.leaves
        while level > 1:
            pairs = self.least[level:2 * level].reshape(-1, 2)
            self.least[level // 2:level] = pairs.min(1)
            level //= 2

    def _first_in_block(self, block: np.ndarray, after: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Of each query the first place in its block behind ``after`` where the excess is ``target`` or less, or -1."""
        place = block[:, None] * self.BLOCK + np.arange(self.BLOCK)
        hit = (self.excess[place] <= target[:, None]) & (place > after[:, None])
        first = hit.argmax(1)
        return np.where(hit[np.arange(len(block)), first], block * self.BLOCK + first, -1)

    def findclose(self, opens: np.ndarray) -> np.ndarray:
        """Where the parentheses at ``opens`` are closed, for all of them at once."""
        parts = [self._findclose(opens[i:i + self.AT_ONCE]) for i in range(0, len(opens), self.AT_ONCE)]
        return np.concatenate(parts) if parts else np.empty(0, np.int64)

    def _findclose(self, opens: np.ndarray) -> np.ndarray:
        target, block = self.excess[opens] - 1, opens // self.BLOCK
        found = self._first_in_block(block, opens, target)
        rest = np.flatnonzero(found < 0)
        at, target = self.leaves + block[rest], target[rest]
        climbing = np.ones(len(rest), bool)
        while climbing.any():  # up, until a subtree to the right goes as low
            up = climbing & ((at & 1 == 1) | (self.least[np.minimum(at + 1, 2 * self.leaves - 1)] > target))
            at = np.where(up, at >> 1, np.where(climbing, at + 1, at))
            climbing = up
        while (inner := at < self.leaves).any():  # down, to the first block that does
            left = 2 * at
            down = np.where(self.least[np.minimum(left, 2 * self.leaves - 1)] <= target, left, left + 1)
            at = np.where(inner, down, at)
        found[rest] = self._first_in_block(at - self.leaves, opens[rest], target)
        return found


def chained(turns: DataFrame) -> DataFrame:
    """conv_id, depth, p1, p2 (the numbers of the node that the turn leads to), n_bytes."""
    so_far = Window.partitionBy("conv_id").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    number = [F.bit_xor(F.xxhash64(F.lit(i), "digest", "depth")).over(so_far).alias(f"p{i}") for i in (1, 2)]
    return turns.select("conv_id", "depth", *number, "n_bytes")


def with_shared(nodes: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Adds n (conversations through the node) and first (the least) where a node has two or more, else null."""
    counted = nodes.groupBy(*NODE).agg(F.count("*").alias("n"), F.min("conv_id").alias("first")).where("n > 1")
    shared = materialize(counted, "trie-shared")
    if shared.count() <= broadcast_rows:
        return nodes.join(F.broadcast(shared), NODE, "left")
    # Fewer than ``broadcast_rows`` nodes can have more than that share of the rows; no other one is hot.
    share = nodes.count() / broadcast_rows
    hot = F.broadcast(shared.where(F.col("n") > share))
    others = nodes.join(hot, NODE, "left_anti").join(shared.where(F.col("n") <= share).hint("merge"), NODE, "left")
    return nodes.join(hot, NODE).unionByName(others)


def last_shared(marked: DataFrame, convs: DataFrame, root: Column) -> DataFrame:
    """conv_id, total (turns), and depth, p1, p2, first of the last node that it shares (0, 0, 0, ``root`` for the root)."""
    node = F.max(F.when(F.col("n").isNotNull(), F.struct("depth", "p1", "p2", "first")))
    ends = convs.join(marked.groupBy("conv_id").agg(F.max("depth").alias("total"), node.alias("last")), "conv_id", "left")
    zero = F.lit(0).cast("long")
    return ends.select("conv_id", F.coalesce("total", zero).alias("total"), *(F.coalesce(f"last.{c}", zero).alias(c) for c in NODE),
                       F.coalesce("last.first", root).alias("first"))


def paths(marked: DataFrame, ends: DataFrame, root: Column) -> DataFrame:
    """path (the nodes from the root on) and what the path's nodes have besides its nodes:
    children, leaves, saved. A row per distinct last shared node."""
    tails = F.sum((F.col("total") > F.col("depth")).cast("long"))
    last = ends.groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), tails.alias("tails"))
    node = F.struct("depth", "p1", "p2", F.col("first").alias("conv"), "n", "n_bytes")
    nodes = marked.where("n is not null").join(last.select("conv_id"), "conv_id").groupBy("conv_id").agg(F.sort_array(F.collect_list(node)).alias("nodes"))
    below = F.transform(F.coalesce("nodes", F.array()), lambda x: F.struct(*(x[c].alias(c) for c in PATH)))
    made = last.join(nodes, "conv_id", "left").select(F.concat(F.array(root), below).alias("path"), "tails")
    size = F.size("path")
    only_last = F.concat(F.array_repeat(F.lit(0).cast("long"), size - 1), F.array("tails"))
    return made.select("path", only_last.alias("children"), only_last.alias("leaves"), F.array_repeat(F.lit(0).cast("long"), size).alias("saved"))


PATH = ["p1", "p2", "conv", "n", "n_bytes"]
OWN = ["children", "leaves", "saved"]
CLOSED = ["depth", "p1", "p2", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
_PATH_TYPE = pa.list_(pa.struct([(c, pa.int64()) for c in PATH]))
SHARD = ", ".join([*(f"{c} long" for c in CLOSED), f"path array<struct<{', '.join(f'{c}: long' for c in PATH)}>>", *(f"{c} array<long>" for c in OWN)])


class Shard:
    """The trie of some sorted paths, given as flat arrays with the paths' lengths. ``whole``: its spines are finished too."""

    def __init__(self, sizes: np.ndarray, path: dict[str, np.ndarray], own: dict[str, np.ndarray], whole: bool) -> None:
        self.sizes, self.path = sizes, path
        self.ends = np.concatenate(([0], np.cumsum(sizes)))
        row = np.repeat(np.arange(len(sizes)), sizes)
        depth = np.arange(len(row)) - self.ends[row]
        # A node is known if the row before has the same one at this depth; then it has all above it.
        before = self.ends[row] - np.where(row > 0, sizes[row - 1], 0) + depth
        known = (row > 0) & (depth < sizes[row - 1])
        before = np.where(known, before, 0)
        known &= (path["p1"][before] == path["p1"]) & (path["p2"][before] == path["p2"])
        # Preorder: the new nodes as they come.
        flat = np.flatnonzero(~known)
        number = np.cumsum(~known) - 1
        order = np.lexsort((row, depth))
        latest = np.maximum.accumulate(np.where(known[order], 0, np.arange(len(order))))
        self.node = np.empty(len(row), np.int64)
        self.node[order] = number[order][latest]
        self.depth, self.flat = depth[flat], flat
        self.parent = np.where(self.depth > 0, self.node[flat - 1], -1)
        self.own = {c: np.zeros(len(flat), np.int64) for c in OWN}
        for c in OWN:
            np.add.at(self.own[c], self.node, own[c])
        # Each row closes what it doesn't share with the one before, then opens its own.
        new = np.bincount(row[flat], minlength=len(sizes))
        closes = np.concatenate(([0], (sizes[:-1] - (sizes - new)[1:])))
        opens = np.arange(len(flat)) + np.cumsum(closes)[row[flat]]
        bits = np.zeros(2 * len(flat) + 1, np.uint8)
        bits[opens] = 1
        closed = Parentheses(bits[:-1]).findclose(opens)
        self.until = np.arange(len(flat)) + (closed - opens + 1) // 2
        self.open = np.zeros(len(flat), bool)
        if not whole:
            self.open[self.node[:sizes[0]]] = True
            self.open[self.node[self.ends[-2]:]] = True
        inside = self.parent[self.parent >= 0]
        self.children = self.own["children"] + np.bincount(inside, minlength=len(flat))
        leaf_pairs = (bits[opens + 1] == 0) & (self.children == 0) & ~self.open
        self.leaves = self._below(self.own["leaves"] + leaf_pairs)
        self.saved = self._below(self.own["saved"] + np.where(self.open, 0, (path["n"][flat] - 1) * path["n_bytes"][flat]))

    def _below(self, values: np.ndarray) -> np.ndarray:
        """Sums over subtrees from the cumulative array."""
        total = np.concatenate(([0], np.cumsum(values)))
        return total[self.until] - total[:-1]

    def closed(self) -> list[np.ndarray]:
        """The columns of ``CLOSED`` of the finished nodes, the root's parent as -1 in a mask of its own."""
        done = np.flatnonzero(~self.open)
        at = self.flat[done]
        parent = np.where(self.depth[done] > 0, self.path["conv"][at - 1], 0)
        return [self.depth[done], self.path["p1"][at], self.path["p2"][at], self.path["conv"][at], parent, self.path["n"][at],
                self.children[done], self.leaves[done], self.saved[done]]

    def spines(self) -> Iterator[tuple[slice, list[np.ndarray]]]:
        """The first and the last path (its place in the flat arrays) with what finished nodes bring to their nodes."""
        if not self.open.any():
            return
        brought = {c: self.own[c].copy() for c in OWN}
        top = np.flatnonzero(~self.open & (self.depth > 0))
        top = top[self.open[self.parent[top]]]
        for c, values in (("children", np.ones(len(top), np.int64)), ("leaves", self.leaves[top]), ("saved", self.saved[top])):
            np.add.at(brought[c], self.parent[top], values)
        for row in sorted({0, len(self.sizes) - 1}):
            place = slice(self.ends[row], self.ends[row + 1])
            nodes = self.node[place]
            yield place, [brought[c][nodes] for c in OWN]
            for c in OWN:
                brought[c][nodes] = 0  # once only


def level(rows: DataFrame, whole: bool, shards: int) -> DataFrame:
    """The finished nodes (columns of ``CLOSED``) and the spines (path and on) of the paths."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]  # a shard: bounded by its number of nodes
        if not held:
            return
        table = pa.Table.from_batches(held)
        column = {c: table.column(c).combine_chunks() for c in ["path", *OWN]}
        sizes = np.asarray(column["path"].value_lengths(), np.int64)
        nodes = column["path"].flatten()
        path = {c: nodes.field(c).to_numpy(zero_copy_only=False) for c in PATH}
        own = {c: column[c].flatten().to_numpy(zero_copy_only=False) for c in OWN}
        shard = Shard(sizes, path, own, whole)
        done = shard.closed()
        made = [pa.array(c, pa.int64()) for c in done]
        made[4] = pa.array(done[4], pa.int64(), mask=done[0] == 0)
        made += [pa.nulls(len(done[0]), t) for t in (_PATH_TYPE, *[pa.list_(pa.int64())] * 3)]
        yield pa.record_batch(made, names=names)
        for place, brought in shard.spines():
            size = pa.array([0, place.stop - place.start], pa.int32())
            spine = pa.StructArray.from_arrays([pa.array(path[c][place]) for c in PATH], names=PATH)
            lists = [pa.ListArray.from_arrays(size, spine).cast(_PATH_TYPE), *(pa.ListArray.from_arrays(size, pa.array(b)) for b in brought)]
            yield pa.record_batch([*(pa.nulls(1, pa.int64()) for _ in CLOSED), *lists], names=names)

    names = [*CLOSED, "path", *OWN]
    dealt = rows.coalesce(1) if whole else rows.repartitionByRange(shards, "path")
    return dealt.sortWithinPartitions("path").mapInArrow(work, SHARD)


def shared_nodes(rows: DataFrame, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """The finished nodes of all levels."""
    done = None
    while True:
        n, nodes = rows.agg(F.count("*"), F.sum(F.size("path"))).first()
        whole = n <= 8 or nodes <= shard_nodes
        made = materialize(level(rows, whole, min(n // 8, -(-nodes // shard_nodes)) if not whole else 1), "trie-level")
        closed = made.where("path is null").select(*CLOSED)
        done = closed if done is None else done.unionByName(closed)
        if whole:
            return done
        rows = made.where("path is not null").select("path", *OWN)


def ends_of(ends: DataFrame) -> DataFrame:
    """depth, p1, p2, ends_sha256 of the shared nodes where conversations end."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            done = []
            keys = [tuple(k) for k in zip(*(c.to_pylist() for c in batch.columns[:3]))]
            ids = batch.column(3).to_pylist()
            at = 0
            while at < len(keys):
                to = at + 1
                while to < len(keys) and keys[to] == keys[at]:
                    to += 1
                joined = ",".join(map(str, ids[at:to]))
                if keys[at] == node:
                    digest.update(f",{joined}".encode())
                else:
                    if node:
                        done.append((*node, digest.hexdigest()))
                    node, digest = keys[at], hashlib.sha256(joined.encode())
                at = to
            yield as_batch(done)
        yield as_batch([(*node, digest.hexdigest())] if node else [])

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        return pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=[*NODE, "ends_sha256"])

    here = ends.where("total = depth").select(*NODE, "conv_id")
    return here.repartition(*NODE).sortWithinPartitions(*NODE, "conv_id").mapInArrow(read, "depth long, p1 long, p2 long, ends_sha256 string")


def trie_nodes(turns: DataFrame, convs: DataFrame, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """The trie of conversations. ``turns``: conv_id, depth (from 1 on), digest, n_bytes; ``convs``: each conv_id once."""
    nodes = materialize(chained(turns), "trie-turns")
    marked = materialize(with_shared(nodes), "trie-marked")
    n_convs, least = convs.agg(F.count("*"), F.min("conv_id")).first()
    long = lambda x: F.lit(x).cast("long")
    root = F.struct(*(long(x).alias(c) for c, x in zip(PATH, (0, 0, least, n_convs, 0))))
    ends = materialize(last_shared(marked, convs, long(least)), "trie-ends")
    shared = shared_nodes(materialize(paths(marked, ends, root), "trie-paths"), shard_nodes)
    nothing = F.sha2(F.lit(""), 256)
    shared = shared.join(ends_of(ends), NODE, "left").withColumn("ends_sha256", F.coalesce("ends_sha256", nothing))
    last = ends.select("conv_id", "total", F.col("depth").alias("shared_depth"), F.col("first").alias("shared_conv"))
    own = marked.where("n is null").select("conv_id", "depth").join(last, "conv_id")
    at_end = F.col("depth") == F.col("total")
    tails = own.select(
        "conv_id", "depth", F.when(F.col("depth") == F.col("shared_depth") + 1, F.col("shared_conv")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        long(1).alias("n_convs"), F.when(at_end, long(0)).otherwise(long(1)).alias("n_children"), long(1).alias("n_leaves"), long(0).alias("saved_tokens"),
        F.when(at_end, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(nothing).alias("ends_sha256"))
    return tails.unionByName(shared.drop("p1", "p2"))


#: The rebuilt conversations: up to 8 turns of the first of each 5.
FAMILY, HEADS = 5, 9


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, convs) with the first h turns of conversation c - c % 5 instead of c's own first h; h = crc32(c) % 9."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    said = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", said.alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest")
    placed = materialize(rows.select("conv_id", "digest", "n_bytes", F.row_number().over(order).cast("long").alias("place")), "trie-placed")
    ids = placed.where("place = 1").select("conv_id", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"), (F.crc32(F.col("conv_id").cast("string")) % HEADS).alias("h"))
    heads = placed.where((F.col("conv_id") % FAMILY == 0) & (F.col("place") < HEADS)).groupBy(F.col("conv_id").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("place", "digest", "n_bytes"))).alias("heads"))
    convs = materialize(ids.join(heads, "base", "left").withColumn("heads", F.expr("slice(coalesce(heads, array()), 1, cast(h as int))")), "trie-convs")
    taken = convs.select("conv_id", F.explode("heads").alias("x")).select("conv_id", F.col("x.place").alias("depth"), "x.digest", "x.n_bytes")
    own = placed.join(convs.select("conv_id", "h", F.size("heads").alias("taken")), "conv_id").where("place > h")
    own = own.select("conv_id", (F.col("taken") + F.col("place") - F.col("h")).alias("depth"), "digest", "n_bytes")
    return taken.unionByName(own), convs.select("conv_id")


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    return trie_nodes(*rebuilt(conversations))


_CRC32 = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""
#: DuckDB: nodes by digests of whole prefixes, subtrees by all ancestors of each node.
SQL = f"""
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, d) AS place, d, strlen(text) AS n_bytes FROM (
    SELECT conv_id, turn, coalesce(text, '') AS text, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS d
    FROM conversations WHERE conv_id IS NOT NULL)),
c AS (SELECT conv_id, conv_id - conv_id % {FAMILY} AS base, {_CRC32} % {HEADS} AS h FROM (SELECT DISTINCT conv_id FROM t)),
m AS (SELECT c.conv_id, base, h, count(t.place) AS taken FROM c LEFT JOIN t ON t.conv_id = base AND place <= h GROUP BY c.conv_id, base, h),
r AS (SELECT m.conv_id, place AS depth, d, n_bytes FROM m JOIN t ON t.conv_id = base AND place <= h
  UNION ALL SELECT m.conv_id, taken + place - h, d, n_bytes FROM m JOIN t ON t.conv_id = m.conv_id AND place > h),
p AS (SELECT conv_id, depth, n_bytes, sha256(string_agg(d, '') OVER (PARTITION BY conv_id ORDER BY depth)) AS key FROM r UNION ALL SELECT conv_id, 0, 0, '' FROM c),
n AS (SELECT depth, key, min(conv_id) AS conv_id, count(*) AS n_convs, max(n_bytes) AS n_bytes FROM p GROUP BY depth, key),
up AS (SELECT n.depth, n.key, p.key AS parent FROM n JOIN p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1),
kids AS (SELECT depth - 1 AS depth, parent AS key, count(*) AS n_children FROM up GROUP BY depth, parent),
below AS (
  SELECT p.depth, p.key, count(*) FILTER (k.key IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.n_bytes) AS saved_tokens
  FROM n LEFT JOIN kids k ON k.depth = n.depth AND k.key = n.key JOIN p ON p.conv_id = n.conv_id AND p.depth <= n.depth GROUP BY p.depth, p.key),
ends AS (
  SELECT depth, key, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256
  FROM p WHERE depth = (SELECT max(depth) FROM p q WHERE q.conv_id = p.conv_id) GROUP BY depth, key)
SELECT n.conv_id, n.depth, f.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves::BIGINT AS n_leaves,
  saved_tokens::BIGINT AS saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM n LEFT JOIN up USING (depth, key) LEFT JOIN n f ON f.depth = n.depth - 1 AND f.key = up.parent
LEFT JOIN kids k ON k.depth = n.depth AND k.key = n.key JOIN below b ON b.depth = n.depth AND b.key = n.key LEFT JOIN ends e ON e.depth = n.depth AND e.key = n.key
"""
