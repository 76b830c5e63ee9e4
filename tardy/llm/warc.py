"""Web archives: WARC records written from pages, read back, and their capture index.

Method
    Writing: a record per page. Of pages with equal payloads of at least ``least_bytes``
    the one with the largest page_id is a ``response``, the others are ``revisit``
    records that refer to it and carry no payload. Records end in CR LF CR LF, which is
    the line separator of Spark's text writer, so the archives are its part files, with
    at most ``file_records`` records each.

    Reading: an archive is parsed by its records' Content-Length; payload digests of
    responses are computed anew and must equal their headers.

    Index: each archive gives a run of captures, sorted in its task by (URL key,
    timestamp, page_id). The runs are an external table. Ranges of the key, cut by
    Spark's sample of it into ranges of about ``range_rows`` rows, are merged by a
    loser tree over the runs that reach into the range. Ranges are in order and so are
    their rows, which makes the capture histories globally ordered.

Hot groups: payload groups are reduced to (digest, largest page_id) before anything is
joined, and payloads are shuffled by page_id, never by digest. Range borders include
the timestamp and page_id, so captures of one URL can lie in many ranges.

Defined cases
    A null html is an empty payload. A null URL has no target header and the key ''. A
    null page_id never is a group's largest; in a group without any page_id all records
    are responses. Rows with the same page_id and payload are records of their own,
    each a response if the page_id is the largest. An empty table gives no records.
    CR and LF in a URL are written as %0D and %0A. Extra columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import re
from base64 import b32encode
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tardy.session import materialize, scratch_path

#: Fixed value: the digits of base 32 (RFC 4648).
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: Fixed value: the digits that ``conv`` writes in radix 32.
RADIX32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
LEAST_BYTES = 0
FILE_RECORDS = 5_000
RANGE_ROWS = 100_000
#: Pages carry no capture time; their records are dated by page_id, in seconds from here.
FIRST_CAPTURE = 1_600_000_000
CRLF, RECORD_END = "\r\n", "\r\n\r\n"
COMPRESSION = "gzip"


def sha1_base32(payload: Column) -> Column:
    """Upper-case base 32 of the SHA-1, from its hex form in groups of 40 bits."""
    hexed = F.sha1(payload)
    # 40 bits are 8 digits of radix 32 (0-9, A-V), one expression a group: the payload is hashed for few of them.
    digits = [F.lpad(F.conv(F.substring(hexed, 10 * group + 1, 10), 16, 32), 8, "0") for group in range(4)]
    return F.translate(F.concat(*digits), RADIX32, BASE32)


def capture_rows(pages: DataFrame) -> DataFrame:
    """page_id, url, payload (binary), payload_bytes, digest, captured (epoch seconds)."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url"), F.coalesce(F.col("html"), F.lit("")).alias("html"))
    return rows.withColumn("payload_bytes", F.octet_length("html").cast("long")).withColumn(
        "digest", sha1_base32(F.col("html").cast("binary"))).withColumn(
        "captured", F.lit(FIRST_CAPTURE).cast("long") + F.coalesce("page_id", F.lit(0)))


def with_record_types(captures: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Adds refers_to: the page_id of the response that a revisit refers to, else null."""
    narrow = captures.select("page_id", "digest", "payload_bytes")
    largest = narrow.groupBy("digest").agg(F.max("page_id").alias("largest"))
    kinds = narrow.where(F.col("payload_bytes") >= least_bytes).select("page_id", "digest").distinct().join(largest, "digest")
    revisits = kinds.where(F.col("largest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("largest"))).select(
        F.col("page_id").alias("r_page_id"), F.col("digest").alias("r_digest"), F.col("largest").alias("refers_to"))
    return captures.join(revisits, captures.page_id.eqNullSafe(F.col("r_page_id")) & (captures.digest == F.col("r_digest")), "left").drop("r_page_id", "r_digest")


def record_id(page_id: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws("/", F.coalesce(page_id.cast("string"), F.lit("")), digest).cast("binary"))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def record(captures: DataFrame) -> Column:
    """The whole record without its end."""
    revisit = F.col("refers_to").isNotNull()

    def header(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value.cast("string"))

    http = F.concat(F.lit(CRLF.join(["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", "Content-Length: "])),
                    F.col("payload_bytes").cast("string"), F.lit(RECORD_END))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("html")))
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    headers = F.concat_ws(
        CRLF, F.lit("WARC/1.1"), header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        header("WARC-Record-ID", record_id(F.col("page_id"), F.col("digest"))),
        header("WARC-Date", F.date_format(F.timestamp_seconds("captured"), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        header("WARC-Target-URI", url), header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.when(revisit, header("WARC-Refers-To", record_id(F.col("refers_to"), F.col("digest")))),
        header("X-Page-Id", F.col("page_id")), header("X-Refers-To-Page-Id", F.col("refers_to")),
        F.lit("Content-Type: application/http; msgtype=response"), header("Content-Length", F.octet_length(block)))
    return F.concat(headers, F.lit(RECORD_END), block)


def write_archives(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES, file_records: int = FILE_RECORDS) -> None:
    """Writes the pages' records under ``path``. Dates are written in UTC."""
    spark = pages.sparkSession
    zone = spark.conf.get("spark.sql.session.timeZone")
    rows = with_record_types(capture_rows(pages), least_bytes)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        rows.select(record(rows).alias("value")).write.option("lineSep", RECORD_END).option("compression", COMPRESSION).option(
            "maxRecordsPerFile", file_records).text(path)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


URL = re.compile(r"(?:([a-zA-Z][a-zA-Z0-9+.-]*)://)?(?:[^/?#@]*@)?([^/?#:]*)(?::(\d*))?([^?#]*)(?:\?([^#]*))?")


def url_key(url: str | None) -> str:
    """The URL in sort-friendly form: host labels reversed (without www), a port that
    isn't the scheme's, the path without a slash at its end, sorted query fields; no fragment."""
    if not url:
        return ""
    scheme, host, port, path, query = URL.match(url.strip()).groups()
    labels = host.lower().rstrip(".").split(".")
    if len(labels) > 2 and re.fullmatch(r"www\d*", labels[0]):
        labels = labels[1:]
    usual = {"http": "80", "https": "443"}.get((scheme or "http").lower())
    place = ",".join(reversed(labels)) + (f":{port}" if port and port != usual else "")
    fields = "&".join(sorted(query.split("&"))) if query else ""
    return f"{place}){(path or '/').lower().rstrip('/') or '/'}" + (f"?{fields.lower()}" if fields else "")


CAPTURE = ("url_key string, timestamp string, page_id long, record_type string, payload_bytes long, payload_digest string, "
           "refers_to long, url string, archive string, offset long, length long")


def records_of(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, headers in lower case, block) of each record of an archive."""
    at = 0
    while at < len(data):
        head = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:head].decode().split(CRLF)
        if not first.startswith("WARC/"):
            raise ValueError(f"no record at {at}")
        headers = {k.lower(): v for k, v in (line.split(": ", 1) for line in lines)}
        start = head + 4
        end = start + int(headers["content-length"])
        if data[end:end + 4] != RECORD_END.encode():
            raise ValueError(f"the record at {at} doesn't end where it says")
        yield at, end + 4 - at, headers, data[start:end]
        at = end + 4


def read_runs(spark, path: str) -> DataFrame:
    """The captures of the archives under ``path``: each archive's own rows in order (``seq``)."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                data = content.as_py()
                data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
                rows = []
                for offset, length, headers, block in records_of(data):
                    http, payload = block.split(RECORD_END.encode(), 1)
                    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
                    digest = headers["warc-payload-digest"].removeprefix("sha1:")
                    if headers["warc-type"] == "response" and (len(payload) != size or b32encode(hashlib.sha1(payload).digest()).decode() != digest):
                        raise ValueError(f"payload of {headers['warc-record-id']} isn't what its header says")
                    page, refers, url = (headers.get(h) for h in ("x-page-id", "x-refers-to-page-id", "warc-target-uri"))
                    stamp = re.sub(r"\D", "", headers["warc-date"])
                    rows.append((url_key(url), stamp, None if page is None else int(page), headers["warc-type"], size, digest,
                                 None if refers is None else int(refers), url, name.as_py().rsplit("/", 1)[-1], offset, length))
                rows.sort(key=capture_order)
                kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
                names = [part.split()[0] for part in CAPTURE.split(", ")]
                yield pa.record_batch([*(pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)), pa.array(range(len(rows)), pa.int64())], names=[*names, "seq"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(read, CAPTURE + ", seq long")


def capture_order(row: tuple) -> tuple:
    return row[0], row[1], row[2] is not None, row[2] or 0, row[8], row[9]


class LoserTree:
    """Merges sorted lists. Each inner node holds the loser of its match; the winner of
    all is outside, and after it is taken only its own path is played again."""

    def __init__(self, runs: list[list[tuple]]) -> None:
        self.runs, self.at = runs, [0] * len(runs)
        self.losers = [-1] * len(runs)
        self.winner = self._play(1) if runs else -1

    def _key(self, run: int) -> tuple:
        place = self.at[run]
        return (1,) if place >= len(self.runs[run]) else (0, capture_order(self.runs[run][place]), run)

    def _play(self, node: int) -> int:
        n = len(self.runs)
        if node >= n:
            return node - n
        a, b = self._play(2 * node), self._play(2 * node + 1)
        a, b = (a, b) if self._key(a) <= self._key(b) else (b, a)
        self.losers[node] = b
        return a

    def __iter__(self) -> Iterator[tuple]:
        while self.winner >= 0 and self.at[self.winner] < len(self.runs[self.winner]):
            yield self.runs[self.winner][self.at[self.winner]]
            self.at[self.winner] += 1
            now, node = self.winner, (self.winner + len(self.runs)) // 2
            while node:
                if self._key(self.losers[node]) < self._key(now):
                    self.losers[node], now = now, self.losers[node]
                node //= 2
            self.winner = now


def merge_runs(runs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """All captures with ``range`` (number of the key range) and ``place`` (in the range):
    in order of (range, place) the captures are in order of (url_key, timestamp, page_id)."""
    ranges = max(1, -(-runs.count() // range_rows))
    names = [part.split()[0] for part in CAPTURE.split(", ")]

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[str, list[tuple]] = {}
        number, schema = 0, None
        for batch in batches:  # sorted by archive and place in its run: one range of the runs
            schema = batch.schema
            for *row, part in zip(*(c.to_pylist() for c in batch.columns)):
                own.setdefault(row[8], []).append(tuple(row))
                number = part
        if schema is None:
            return
        merged = list(LoserTree(list(own.values())))
        for at in range(0, len(merged), 10_000):
            rows = merged[at:at + 10_000]
            yield pa.record_batch([*(pa.array([r[i] for r in rows], schema.field(i).type) for i in range(len(names))),
                                   pa.array([number] * len(rows), pa.int32()), pa.array(range(at, at + len(rows)), pa.int64())], names=[*names, "range", "place"])

    dealt = runs.repartitionByRange(ranges, "url_key", "timestamp", "page_id", "archive", "offset").sortWithinPartitions("archive", "seq")
    return dealt.select(*names, F.spark_partition_id().alias("range")).mapInArrow(merge, CAPTURE + ", range int, place long")


def capture_histories(pages: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Writes the archives under ``path`` (a fresh scratch folder by default) and returns their merged index."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archives(pages, path, **options)
    return merge_runs(materialize(read_runs(spark, path), "warc-runs"))


def page_records(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, read back from the archives."""
    return capture_histories(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: DuckDB.
SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, (unhex(sha1(h)))::BIT::VARCHAR AS bits FROM p),
e AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i: substr('{BASE32}', 1
    + 16 * substr(bits, 5 * i + 1, 1)::INTEGER + 8 * substr(bits, 5 * i + 2, 1)::INTEGER + 4 * substr(bits, 5 * i + 3, 1)::INTEGER
    + 2 * substr(bits, 5 * i + 4, 1)::INTEGER + substr(bits, 5 * i + 5, 1)::INTEGER, 1)), '') AS payload_digest FROM d),
g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM e)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= {LEAST_BYTES} AND top IS NOT NULL AND page_id IS DISTINCT FROM top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {LEAST_BYTES} AND top IS NOT NULL AND page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM g
"""
