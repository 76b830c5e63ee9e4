"""Random strings in paths, key=value runs, beside words and among other kinds of spans."""

from __future__ import annotations

import random
import string

import edge
import pytest
from tardy.llm import secrets
from pyspark.sql import functions as F

ALNUM = string.ascii_letters + string.digits
AROUND = ("{}", "/services/configuration/documentation/{}", "session_identifier={}", "/services/configuration/documentation/{}/settings/production/database",
          "/users/550e8400-e29b-41d4-a716-446655440000/documentation/{}", "region=production/session_identifier={}")


@pytest.fixture(scope="module")
def tokens():
    with open(secrets.VOCABULARY, "rb") as f:
        return secrets.tokens_counter(f.read())


def share(tokens, alphabet: str, around: str, n: int) -> float:
    """The share of 200 random strings that one random span covers."""
    r, hit = random.Random(n), 0
    for _ in range(200):
        made = "".join(r.choice(alphabet) for _ in range(n))
        text = f"See {around.format(made)} for more"
        at = text.index(made)
        hit += any(k == "random" and a <= at and at + n <= b for k, a, b in secrets.spans_of(text, tokens))
    return hit / 200


@pytest.mark.parametrize("n", [16, 20, 24, 32, 40])
@pytest.mark.parametrize("around", AROUND)
def test_words_beside_a_secret(tokens, around, n):
    assert share(tokens, ALNUM, around, n) >= 0.97


@pytest.mark.parametrize("around", AROUND[:3])
def test_letter_runs(tokens, around):
    assert share(tokens, string.ascii_lowercase, around, 16) >= 0.8
    assert share(tokens, string.ascii_lowercase, around, 32) >= 0.9


@pytest.mark.parametrize("around", ("/services/configuration/documentation/{}", "/configuration/{}/documentation"))
def test_base64_in_a_path(tokens, around):
    assert share(tokens, ALNUM + "+/", around, 40) >= 0.9


def test_words_without_a_separator(tokens):
    r = random.Random(1)
    for _ in range(100):
        made = "".join(r.choice(ALNUM) for _ in range(24))
        text = f"ServiceConfigurationDocumentationProduction9{made}"
        assert any(a < len(text) and b > len(text) - 16 for _, a, b in secrets.spans_of(text, tokens)), text


def test_other_spans_in_the_run(tokens):
    made = "Zk9fQ2xW7pLr8sTb1vNcY4hG"
    text = f"/store/{'0a1b2c' * 5}/{made}/x"
    assert [(k, text[a:b]) for k, a, b in secrets.spans_of(text, tokens)] == [("hex", "0a1b2c" * 5), ("random", made)]


def test_words_are_kept(tokens):
    for known in ("/services/configuration/documentation/d41d8cd98f00b204e9800998ecf8427e/x1", "internationalization/responsibilities", "geschwindigkeitsbegrenzung",
                  "/users/550e8400-e29b-41d4-a716-446655440000/documentation/settings", "/usr/lib/python3/site-packages/configuration/module2",
                  "https/example/com/2024/01/02/some-title-of-an-article"):
        assert [x for x in secrets.spans_of(known, tokens) if x[0] == "random"] == [], known


def test_redacted_in_a_path(spark):
    made = "Zk9fQ2xW7pLr8sTb"
    docs = edge.documents(spark, [(1, f"a /services/configuration/documentation/{made}/database b", "s")])
    got = [r[0] for r in docs.select(secrets.redact(F.col("text"), secrets.secret_spans(F.col("text")))).collect()]
    assert got == ["a /services/configuration/documentation/[SECRET]/database b"]
