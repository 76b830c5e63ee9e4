"""Secret scans: pattern spans, and random strings shown by their token efficiency.

Method
    A byte-pair vocabulary spends few tokens on the words and identifiers it was made
    from and many on strings without structure. Runs of ``RUN`` are candidates. Known
    digests (hex of a standard digest length) and identifiers (words joined by
    separators, numbers, UUIDs, words with a number at the end) are excluded; of the
    rest, those with fewer than ``max_chars_per_token`` characters per token under a
    tiktoken vocabulary are spans of kind ``random``, unless they overlap a span of a
    pattern kind. A run of 16 or more letters is a word only if it has that many
    characters per token itself. Readable words beside a secret make a whole run
    efficient, so the parts of a run that is no span itself are tested the same way:
    neighbouring pieces (between separators) that are no identifiers, and where they mix
    words with something else the single pieces and the windows of 16 characters. The pattern
    kinds (``assign``, ``access``, ``hex``) are the leftmost non-overlapping matches of
    fixed patterns and are always kept.

The vocabulary file is read on the driver and shipped to the tasks with the function
(under 1 MB), so executors need no file. Texts are scanned whole, row by row; a task
holds one Arrow batch.

Defined cases
    A null text counts as empty and has no spans. Repeated rows are rows of their own.
    Null doc_ids and extra columns pass through. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

# The pattern kinds in order, their patterns and least lengths.
ASSIGN = re.compile(
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a maximal run of at least 24
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
KINDS = ("assign", "access", "hex", "random")
#: Fixed value: how the vocabulary cuts a text before merging.
CUTS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""

MAX_CHARS_PER_TOKEN = 2.0
RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}")
HEX_DIGEST = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)\Z")
DIGEST_LENGTHS = frozenset((32, 40, 48, 56, 64, 96, 128))
#: Identifiers: UUIDs; numbers and words joined by separators, each word with at most a number at its end.
IDENTIFIER = re.compile(
    r"(?i:[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})\Z|(?:[+/_=-]*(?:[A-Z]*[a-z]+|[A-Z]+|[a-z]+[0-9]{1,4}|[A-Z]+[0-9]{1,4}|[0-9]+)(?=[+/_=-]|[A-Z][a-z]|\Z))++[+/_=-]*\Z")

#: Parts of a run: UUIDs, and pieces between separators.
UUID = r"(?i:[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})(?![A-Za-z0-9])"
PIECE = re.compile(rf"(?<![A-Za-z0-9]){UUID}|[A-Za-z0-9]+")
LEAST = 16
LETTERS = re.compile(rf"[A-Za-z]{{{LEAST},}}")
#: A word of up to so many characters doesn't end a string with separators in it (base64).
SHORT_WORD = 4

SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def tokens_counter(vocabulary: bytes) -> Callable[[str], int]:
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in vocabulary.splitlines() if line)}
    encoding = tiktoken.Encoding("secrets", pat_str=CUTS, mergeable_ranks=ranks, special_tokens={})
    return lambda s: len(encoding.encode_ordinary(s))


def pattern_spans(text: str) -> list[tuple[str, int, int]]:
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return found


def known_string(run: str, tokens: Callable[[str], int], most: float) -> bool:
    """A digest, or an identifier whose long letter runs are words."""
    if HEX_DIGEST.match(run) and len(run) in DIGEST_LENGTHS:
        return True
    return bool(IDENTIFIER.match(run)) and all(len(m[0]) >= most * tokens(m[0]) for m in LETTERS.finditer(run))


def windows(piece: str, tokens: Callable[[str], int], most: float) -> list[tuple[int, int]]:
    """The windows of ``LEAST`` characters that look random, overlapping ones as one."""
    found: list[tuple[int, int]] = []
    for a in range(len(piece) - LEAST + 1):
        w = piece[a:a + LEAST]
        if LEAST < most * tokens(w) and not known_string(w, tokens, most):
            if found and a <= found[-1][1]:
                found[-1] = (found[-1][0], a + LEAST)
            else:
                found.append((a, a + LEAST))
    return found


def random_parts(run: str, tokens: Callable[[str], int], most: float) -> list[tuple[int, int]]:
    """The parts of a run that look random: neighbouring pieces that are no identifiers, or of those the single pieces and windows."""
    groups: list[list[tuple[int, int]]] = [[]]
    between: list[tuple[int, int]] = []
    for m in PIECE.finditer(run):
        if not known_string(m[0], tokens, most):
            groups[-1] += [*(between if groups[-1] else []), m.span()]
            between = []
        elif len(m[0]) <= SHORT_WORD:
            between.append(m.span())
        else:
            groups.append([])
            between = []
    found = []
    for group in filter(None, groups):
        start, end = group[0][0], group[-1][1]
        if LEAST <= end - start < most * tokens(run[start:end]):
            found.append((start, end))
            continue
        whole = [(a, b) for a, b in group if LEAST <= b - a < most * tokens(run[a:b])]
        mixed = [(start + a, start + b) for a, b in windows(run[start:end], tokens, most)]
        found += sorted(whole + [w for w in mixed if all(w[1] <= a or b <= w[0] for a, b in whole)])
    return found


def random_spans(text: str, tokens: Callable[[str], int], most: float, taken: Sequence[tuple[str, int, int]] = ()) -> list[tuple[str, int, int]]:
    """Spans that don't overlap those of ``taken``: beside these, the rest of a run is tested in parts."""
    found = []
    for m in RUN.finditer(text):
        run, (start, end) = m[0], m.span()
        if known_string(run, tokens, most):
            continue
        inside = sorted((max(a, start), min(b, end)) for _, a, b in taken if a < end and start < b)
        if not inside and len(run) < most * tokens(run) and not IDENTIFIER.match(run):
            found.append(("random", start, end))
            continue
        at = start
        for a, b in [*inside, (end, end)]:
            if a - at >= LEAST:
                found += [("random", at + x, at + y) for x, y in random_parts(text[at:a], tokens, most)]
            at = max(at, b)
    return found


def spans_of(text: str, tokens: Callable[[str], int], most: float = MAX_CHARS_PER_TOKEN) -> list[tuple[str, int, int]]:
    """All spans by start, then kind as in ``KINDS``."""
    base = pattern_spans(text)
    return sorted(base + random_spans(text, tokens, most, base), key=lambda x: (x[1], KINDS.index(x[0])))


def redacted(text: str, spans: list[tuple[str, int, int]], mark: str) -> str:
    """The text with each run of overlapping spans replaced by ``mark``."""
    out, at = [], 0
    for _, start, end in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def secret_spans(text: Column, vocabulary: str = VOCABULARY, max_chars_per_token: float = MAX_CHARS_PER_TOKEN) -> Column:
    """array<struct<kind, start, end>>: code points, end exclusive."""
    with open(vocabulary, "rb") as f:
        ranks = f.read()

    @F.pandas_udf(SPANS)
    def find(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens = tokens_counter(ranks)
        for batch in texts:
            yield pd.Series([spans_of(t, tokens, max_chars_per_token) if t else [] for t in batch], dtype=object)

    return find(text)


def redact(text: Column, spans: Column | None = None, mark: str = "[SECRET]", vocabulary: str = VOCABULARY,
           max_chars_per_token: float = MAX_CHARS_PER_TOKEN) -> Column:
    """The text with its spans (of ``secret_spans``) replaced; a null text stays null. Without ``spans`` they are found
    in the same pass over the text: Spark gives each of two functions in a row a Python worker of its own in every
    task and keeps all of them for later stages."""
    if spans is None:
        with open(vocabulary, "rb") as f:
            ranks = f.read()

        @F.pandas_udf(T.StringType())
        def clean(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            tokens = tokens_counter(ranks)
            for batch in texts:
                yield pd.Series([redacted(t, spans_of(t, tokens, max_chars_per_token), mark) if t else t for t in batch], dtype=object)

        return clean(text)

    @F.pandas_udf(T.StringType())
    def replace(batch: pd.Series, found: pd.Series) -> pd.Series:
        return pd.Series([t if t is None or not len(x) else redacted(t, [(s["kind"], s["start"], s["end"]) for s in x], mark)
                          for t, x in zip(batch, found)], dtype=object)

    return replace(text, spans)


def find_secrets(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with the column ``spans``."""
    return docs.withColumn("spans", secret_spans(F.col("text"), **options))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secrets_digest(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random."""
    found = find_secrets(docs.select("doc_id", "text"), **options).select("doc_id", F.col("spans").alias("found"))

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = joined(F.filter("found", lambda s: s["kind"] != "random"))
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(base, 256).alias("base_sha256"),
                        joined(F.col("found")).alias("spans"), count("random"))
