"""The pipeline's stages give a task one Python worker: workers stay for later stages, so each more costs memory in all of them."""

from __future__ import annotations

import re

import corpus_pipeline
import edge
from pyspark.sql import functions as F
from tardy.llm import secrets

ROWS = [(1, "a token=abcdefgh b " + "f" * 30, "s"), (2, None, "s"), (3, "", "s"), (4, "clean", "s"), (4, "clean", "s"), (None, "Zk9fQ2xW7pLr8sTb1vNcY4hG é password: 'abc' token=0123456789", None),
        (5, "/services/configuration/documentation/Zk9fQ2xW7pLr8sTb/database " * 3, "s"), (6, "token=" + "0a1b2c" * 5 + "\U0001F600 AKIA" + "B" * 20, "s")]


def test_secrets_stage_has_one_python_function(spark):
    docs = edge.documents(spark, ROWS).withColumn("n_chars", F.length("text"))
    plan = corpus_pipeline.redact_secrets(spark, docs, "")._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"EvalPython|MapInArrow|MapInPandas", plan)) == 1, plan


def test_redaction_in_one_pass_is_the_same(spark):
    docs = edge.documents(spark, ROWS)
    both = docs.select(secrets.redact(F.col("text")).alias("one"), secrets.redact(F.col("text"), secrets.secret_spans(F.col("text"))).alias("two"), "text").collect()
    assert len(both) == len(ROWS)
    for r in both:
        assert r["one"] == r["two"]
    assert sum(r["one"] != r["text"] for r in both) == 4
