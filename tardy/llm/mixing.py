"""Mixing sources to target weights, by blocks of words (DataFrame functions only).

Method
    1. ``source_targets``: words per source, weights by the source's rank in code
       point order (null last), targets by filling every source to the same level per
       unit of weight, but to ``max_epochs`` times its words at most.
    2. ``pack``: the documents of a source lie end to end on a line of words that is
       cut into blocks of ``block_words`` words. A document's place is a two-level
       running sum: documents are hashed to chunks, chunk totals are summed up over
       the chunks of a source, documents within their chunk. No task gets a whole
       source.
    3. ``draw_slots``: the output is a row of slots, ``shard_slots`` to a shard. Each
       slot draws its source by a hash of its number, in proportion to the blocks that
       the sources owe, so the source counts of a shard are a multinomial draw. As the
       draws of all shards together may miss the totals by chance, a slot whose
       ordinal within its source is beyond what the source owes is settled: the r-th
       such slot goes to the r-th block owed but not drawn. So every source gives
       exactly what it owes and no document exceeds ``max_epochs`` copies.
    4. Ordinal i of a source is mapped to block ``(a * i + b) mod n`` in epoch
       ``i div n`` (an affine permutation of the source's n blocks, ``a`` prime to n),
       and slots and blocks are joined by (source, block).

Defined cases
    A null text has 0 words and is taken 0 times, as is any document without words.
    A null source is a source of its own, last in order. Rows with the same doc_id
    are documents of their own. An empty table gives an empty result. Extra columns
    of ``documents`` are ignored. Equal inputs give equal results: every choice is a
    hash of the data and ``seed``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tardy.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
#: Weights by rank of the source, repeating.
WEIGHTS = (3.0, 1.0, 2.0)
BUDGET = 1.5
MAX_EPOCHS = 2.0
BLOCK_WORDS = 128
SHARD_SLOTS = 4096
CHUNK_DOCS = 4096
SEED = 7
#: Equal pieces of the drawing range; turns "which source does this draw hit" into an equi-join.
DRAW_CELLS = 1024
#: Primes tried as the factor of a permutation; one that doesn't divide n is prime to n.
#: The product of any fifteen exceeds 2^63, so one always fits.
FACTORS = (1000003, 999983, 999979, 999961, 999959, 999953, 999931, 999917, 999907, 999883,
           999863, 999853, 999809, 999773, 999769, 999763)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(n: Column, *of: Column) -> Column:
    """A pseudorandom integer in [0, n)."""
    return F.pmod(F.xxhash64(*of), n)


def document_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, pick (a hash that orders documents)."""
    return docs.select(
        F.col("doc_id"), F.col("source"), word_count(F.col("text")).alias("size"),
        F.xxhash64("doc_id", "text", F.lit(SEED)).alias("pick"))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET,
                   max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """source, source_size, docs, weight, target; one row per source.

    A source is at its cap when filling all sources to the level at which it is
    full doesn't take more than the budget; the others share the rest by weight.
    The windows run over one row per source."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    ranked = totals.withColumn("weight", weight)
    everything = Window.partitionBy()
    by_level = Window.orderBy(F.col("level")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    filled = (
        ranked.withColumn("cap", F.col("source_size") * F.lit(max_epochs))
        .withColumn("level", F.col("cap") / F.col("weight"))
        .withColumn("wanted", F.sum("source_size").over(everything) * F.lit(budget))
        .withColumn("full", F.sum("cap").over(by_level) + F.col("level") * (
            F.sum("weight").over(everything) - F.sum("weight").over(by_level)) <= F.col("wanted")))
    free = F.sum(F.when(~F.col("full"), F.col("weight"))).over(everything)
    left = F.col("wanted") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(everything), F.lit(0.0))
    target = F.when(F.col("full"), F.col("cap")).otherwise(F.least(left * F.col("weight") / free, F.col("cap")))
    return filled.select("source", "source_size", "docs", "weight", target.alias("target"))


def with_blocks(targets: DataFrame, block_words: int = BLOCK_WORDS, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """Adds ``blocks`` (the source's blocks), ``owed`` (the blocks it gives) and the
    running sum ``base`` of ``owed`` over the sources in order."""
    blocks = F.ceil(F.col("source_size") / F.lit(block_words)).cast("long")
    owed = F.least(F.round(F.col("blocks") * F.col("target") / F.col("source_size")),
                   F.col("blocks") * F.lit(max_epochs)).cast("long")
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    return (
        targets.withColumn("blocks", blocks)
        .withColumn("owed", F.when(F.col("source_size") > 0, owed).otherwise(F.lit(0).cast("long")))
        .withColumn("base", F.sum("owed").over(by_name) - F.col("owed")))


def pack(sizes: DataFrame, targets: DataFrame, block_words: int = BLOCK_WORDS, chunk_docs: int = CHUNK_DOCS) -> DataFrame:
    """The pieces that block borders cut the documents into: the columns of
    ``sizes`` and ``targets`` with block, first_word (in the document) and n_words."""
    placed = sizes.where("size > 0").join(targets, sizes.source.eqNullSafe(targets.source)).drop(targets.source)
    chunks = F.ceil(F.col("docs") / F.lit(chunk_docs)).cast("long")
    placed = placed.withColumn("chunk", F.pmod(F.col("pick"), chunks))
    sums = placed.groupBy("source", "chunk").agg(F.sum("size").alias("chunk_size"))
    over_chunks = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("c_source"), F.col("chunk").alias("c_chunk"),
                       F.coalesce(F.sum("chunk_size").over(over_chunks), F.lit(0)).alias("chunk_at"))
    within = Window.partitionBy("source", "chunk").orderBy("pick", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, -1)
    placed = placed.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
    placed = placed.join(sums, placed.source.eqNullSafe(sums.c_source) & (placed.chunk == sums.c_chunk))
    at = F.col("chunk_at") + F.col("inside")
    width = F.lit(block_words).cast("long")
    pieces = placed.withColumn("at", at).withColumn(
        "block", F.explode(F.sequence(F.floor(at / width), F.floor((at + F.col("size") - 1) / width))))
    start = F.greatest(F.col("at"), F.col("block") * width)
    end = F.least(F.col("at") + F.col("size"), (F.col("block") + 1) * width)
    return (pieces.withColumn("first_word", start - F.col("at")).withColumn("n_words", end - start)
            .drop("chunk", "inside", "chunk_at", "c_source", "c_chunk", "docs"))


def draw_slots(targets: DataFrame, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """slot, shard, source, ordinal: one row per output slot, each source's ordinals
    running from 0 to owed - 1 without a gap. ``targets``: of ``with_blocks``, written."""
    spark = targets.sparkSession
    total = targets.agg(F.coalesce(F.sum("owed"), F.lit(0))).first()[0]
    n = F.lit(max(total, 1)).cast("long")
    cells = min(DRAW_CELLS, max(total, 1))
    width = -(-max(total, 1) // cells)
    owing = targets.where("owed > 0").select("source", "owed", "base").withColumn(
        "cell", F.explode(F.sequence(F.floor(F.col("base") / width), F.floor((F.col("base") + F.col("owed") - 1) / width))))
    slots = spark.range(total).withColumnRenamed("id", "slot")
    slots = slots.withColumn("shard", F.floor(F.col("slot") / shard_slots)).withColumn(
        "hit", draw(n, F.col("slot"), F.lit(seed))).withColumn("cell", F.floor(F.col("hit") / width))
    drawn = slots.join(owing, "cell").where("hit >= base and hit < base + owed").select("slot", "shard", "source", "owed", "base")
    # Ordinals: the shards' source counts summed up over the shards, then the order within the shard.
    counts = drawn.groupBy("source", "shard").agg(F.count(F.lit(1)).alias("n"))
    over_shards = Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(F.col("source").alias("n_source"), F.col("shard").alias("n_shard"),
                           F.coalesce(F.sum("n").over(over_shards), F.lit(0)).alias("before"))
    in_shard = Window.partitionBy("source", "shard").orderBy("slot")
    drawn = drawn.withColumn("nth", F.row_number().over(in_shard) - 1)
    drawn = drawn.join(counts, drawn.source.eqNullSafe(counts.n_source) & (drawn.shard == counts.n_shard))
    drawn = drawn.withColumn("ordinal", F.col("before") + F.col("nth"))
    return drawn.select("slot", "shard", "source", "ordinal", "owed")


def settle(drawn: DataFrame, targets: DataFrame) -> DataFrame:
    """Gives the slots that a source drew beyond what it owes to the sources that
    drew too few. The r-th surplus slot (by source and ordinal) gets the r-th missing
    ordinal; both are numbered by running sums over one row per source."""
    gone = drawn.groupBy("source").agg(F.count(F.lit(1)).alias("drawn"))
    state = targets.select("source", "owed").join(
        gone.select(F.col("source").alias("g_source"), "drawn"), F.col("source").eqNullSafe(F.col("g_source")), "left")
    over = F.greatest(F.coalesce(F.col("drawn"), F.lit(0)) - F.col("owed"), F.lit(0))
    short = F.greatest(F.col("owed") - F.coalesce(F.col("drawn"), F.lit(0)), F.lit(0))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    state = state.withColumn("over", over).withColumn("short", short).select(
        F.col("source").alias("s_source"), "owed", "short",
        (F.sum("over").over(by_name) - F.col("over")).alias("over_at"),
        (F.sum("short").over(by_name) - F.col("short")).alias("short_at"))
    surplus = drawn.where("ordinal >= owed").join(
        state.select("s_source", "over_at"), F.col("source").eqNullSafe(F.col("s_source"))).select(
        "slot", "shard", (F.col("over_at") + F.col("ordinal") - F.col("owed")).alias("r"))
    missing = state.where("short > 0").withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("short") - 1)))
    missing = missing.select(F.col("s_source").alias("source"), (F.col("owed") - F.col("short") + F.col("k")).alias("ordinal"),
                             (F.col("short_at") + F.col("k")).alias("r"))
    settled = surplus.join(missing, "r").select("slot", "shard", "source", "ordinal")
    return drawn.where("ordinal < owed").select("slot", "shard", "source", "ordinal").unionByName(settled)


def permuted(slots: DataFrame, targets: DataFrame, seed: int = SEED) -> DataFrame:
    """slot, shard, source, block, epoch."""
    n = F.col("blocks")
    factor = F.coalesce(*[F.when(n % p != 0, F.lit(p).cast("long")) for p in FACTORS])
    rules = targets.where("owed > 0").select(
        F.col("source").alias("p_source"), "blocks", factor.alias("factor"), draw(n, F.col("source"), F.lit(seed + 1)).alias("shift"))
    joined = slots.join(rules, F.col("source").eqNullSafe(F.col("p_source")))
    place = F.col("ordinal") % n
    # factor < 2^20; the remainders keep the product within 2^63 for up to 2^43 blocks a source.
    block = (F.col("factor") % n * place + F.col("shift")) % n
    return joined.select("slot", "shard", "source", block.alias("block"), F.floor(F.col("ordinal") / n).alias("epoch"))


@dataclass
class Mix:
    """sizes: a row per document; targets: a row per source; pieces: the documents cut
    at block borders, by (source, block); slots: a row per output slot with its shard,
    source, block and epoch. Pieces and slots joined by (source, block) are the mix."""

    sizes: DataFrame
    targets: DataFrame
    pieces: DataFrame
    slots: DataFrame


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET,
                max_epochs: float = MAX_EPOCHS, block_words: int = BLOCK_WORDS,
                shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> Mix:
    sizes = materialize(document_sizes(docs), "mix-sizes")
    targets = materialize(with_blocks(source_targets(sizes, weights, budget, max_epochs), block_words, max_epochs), "mix-targets")
    drawn = materialize(draw_slots(targets, shard_slots, seed), "mix-drawn")
    return Mix(sizes, targets, pack(sizes, targets, block_words), permuted(settle(drawn, targets), targets, seed))


def mix_texts(docs: DataFrame, mix: Mix) -> DataFrame:
    """The mix with its words: shard, slot, epoch, source, doc_id, first_word, n_words,
    words; a slot's pieces in order of (slot, block_word)."""
    words = docs.select(F.col("doc_id"), F.xxhash64("doc_id", "text", F.lit(SEED)).alias("pick"),
                        F.regexp_extract_all(F.col("text"), F.lit(f"({WORD})"), F.lit(1)).alias("words"))
    taken = mix.pieces.select("source", "block", "doc_id", "pick", "at", "first_word", "n_words").join(
        mix.slots.withColumnRenamed("source", "t_source").withColumnRenamed("block", "t_block"),
        F.col("source").eqNullSafe(F.col("t_source")) & (F.col("block") == F.col("t_block")))
    words = words.select(F.col("pick").alias("w_pick"), F.col("doc_id").alias("w_doc_id"), "words").dropDuplicates(["w_pick", "w_doc_id"])
    return taken.join(words, (F.col("pick") == F.col("w_pick")) & F.col("doc_id").eqNullSafe(F.col("w_doc_id"))).select(
        "shard", "slot", "epoch", "source", "doc_id", "first_word", "n_words",
        (F.col("at") + F.col("first_word")).alias("block_word"),
        F.expr("slice(words, cast(first_word + 1 as int), cast(n_words as int))").alias("words"))


def words_taken(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken: what ``mix_sources`` takes of each document."""
    mix = mix_sources(docs, **options)
    uses = mix.slots.groupBy("source", "block").agg(F.count(F.lit(1)).alias("uses"))
    uses = uses.select(F.col("source").alias("u_source"), F.col("block").alias("u_block"), "uses")
    used = mix.pieces.join(uses, F.col("source").eqNullSafe(F.col("u_source")) & (F.col("block") == F.col("u_block")), "left")
    columns = ["doc_id", "size", "source_size", "target"]
    taken = used.groupBy("source", "at", *columns).agg(F.sum(F.col("n_words") * F.coalesce("uses", F.lit(0))).alias("taken"))
    targets = mix.targets.select(F.col("source").alias("t_source"), "source_size", "target")
    empty = mix.sizes.where("size = 0").join(targets, F.col("source").eqNullSafe(F.col("t_source")))
    return taken.select(*columns, "taken").unionByName(empty.select(*columns, F.lit(0).cast("long").alias("taken")))
