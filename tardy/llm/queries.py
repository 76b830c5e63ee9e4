"""The registered queries of this subpackage, and their DuckDB SQL where SQL can
express the result. Each query applies its operator, with the operator's default
(production) parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tardy.llm import chat, decontam, jaccard, licenses, mixing, packing, quantize, repeats, secrets, topk, toxicity, trie, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets_digest(table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_digest(table(spark, sf_dir, "documents"))


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.components_of(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeats_digest(table(spark, sf_dir, "documents"))


def op7_warc_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_records(table(spark, sf_dir, "pages"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_digest(spark, table(spark, sf_dir, "conversations")).drop("n_tokens")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.words_taken(table(spark, sf_dir, "documents"))


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.rebuilt_trie(table(spark, sf_dir, "conversations"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quantize.codes_digest(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_license_scan": op2_license_scan,
    "op3_exact_topk": op3_exact_topk,
    "op4_ngram_jaccard": op4_ngram_jaccard,
    "op5_toxicity": op5_toxicity,
    "op6_repeated_windows": op6_repeated_windows,
    "op7_warc_captures": op7_warc_captures,
    "op8_chat_format": op8_chat_format,
    "op9_decontaminate": op9_decontaminate,
    "op10_mix_sources": op10_mix_sources,
    "op11_best_fit_packing": op11_best_fit_packing,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_vector_codes": op13_vector_codes,
}

ORACLE_SQL: dict[str, str] = {
    "op2_license_scan": licenses.sql(),
    "op3_exact_topk": topk.SQL,
    "op4_ngram_jaccard": jaccard.SQL,
    "op6_repeated_windows": repeats.SQL,
    "op7_warc_captures": warc.SQL,
    "op8_chat_format": chat.SQL,
    "op9_decontaminate": decontam.SQL,
    "op12_conversation_trie": trie.SQL,
    "op13_vector_codes": quantize.SQL,
}
