"""The corpus pipeline: from raw documents to a training mix.

``STAGES`` are (name, function) in order. Each function takes (spark, docs, sf_dir)
and returns the documents that it keeps, with the columns of ``docs``; the last one
returns the mix. The result of a stage is written as Parquet and read again as the
next one's documents, so a lost executor repeats one stage's tasks at most.

1. toxicity: documents that score as toxic go.
2. near duplicates: of each group of near copies the document with the least doc_id stays.
3. decontamination: documents with a benchmark window go.
4. secrets: secrets in a text are replaced by a mark (n_chars follows the text).
5. mixing: what the mix takes of each document that is left.

Null texts pass stages 1 to 4 unchanged and are taken 0 times; empty and very long texts are
like any others. Rows that are equal in doc_id and text are one document to stage 2: the first in
order of the other columns stays, however the rows are dealt. Rows without words all stay. Columns of any other
names pass through. An empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tardy.llm import decontam, jaccard, mixing, secrets, toxicity
from tardy.session import materialize


def prefixed(docs: DataFrame) -> DataFrame:
    """``text`` beside all columns under names of their own: an operator's columns can't clash with them."""
    return docs.select(F.col("text"), *(F.col(f"`{c}`").alias(f"d_{c}") for c in docs.columns))


def restored(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*(F.col(f"`d_{c}`").alias(c) for c in docs.columns))


#: Bytes of an Arrow batch of texts; a task holds a few of them, in the JVM and in Python.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Lowers the session's bound of Arrow batches (64 MB by default, or 10,000 rows) for the stages' texts."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score_documents(prefixed(docs), model, kept=tuple(f"d_{c}" for c in docs.columns))
    return restored(scored.where(F.col("score") < toxicity.THRESHOLD), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return jaccard.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontam.contamination(prefixed(docs), benchmark, kept=tuple(f"d_{c}" for c in docs.columns), with_items=False)
    return restored(found.where("n_hit = 0"), docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    clean = docs.withColumn("text", secrets.redact(F.col("text")))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return clean


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.words_taken(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("mixing", mix),
]

#: The learned lexicon, the token counts and the pseudorandom mix have no SQL; tests
#: hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
