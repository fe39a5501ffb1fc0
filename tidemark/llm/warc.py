"""WARC archives of pages and their capture index.

Pages are written as WARC records. The text writer does it: a record is text that ends with an
empty line, so each archive file is a gzip-compressed WARC file in whatever store Spark writes
to. Reading parses whole archives by the lengths in their headers.

The index is an external merge. Every archive gives a run, sorted by URL key and capture time.
Runs are cut at common bounds over (URL key, time, page), so a key of any frequency is spread
over several ranges, and each range merges its slices of all runs with a loser tree. The ranges
in order are the globally ordered capture history.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import new_table_path, stored

CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURE = (
    "run string, seq long, url_key string, captured string, page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, offset long, record_bytes long"
)
FIELDS = [f.split(" ")[0] for f in CAPTURE.split(", ")]


def url_key(url: str | None) -> str:
    """Sort-friendly key: host names from the right, then path and query; lower case, without scheme, www and default ports."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip().lower())
        port = parts.port
    except ValueError:
        return url.strip().lower()
    if not parts.hostname:
        return url.strip().lower()
    host = re.sub(r"^www\d*\.", "", parts.hostname)
    rest = (parts.path or "/") + ("?" + parts.query if parts.query else "")
    return ",".join(reversed(host.split("."))) + (f":{port}" if port and port not in (80, 443) else "") + ")" + rest


# ---- writing


def _records(pages: DataFrame, least_bytes: int):
    """One WARC record (without its closing empty line) per page."""
    base = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.regexp_replace(F.col("url").cast("string"), r"[\x00-\x20\x7F]", "%20").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")
    ).withColumns({"digest": F.sha1(F.col("html").cast("binary")), "n": F.octet_length("html")})
    large = base.filter((F.col("n") >= least_bytes) & F.col("page_id").isNotNull())
    originals = large.groupBy("digest").agg(F.max("page_id").alias("original"), F.count("*").alias("copies")).filter("copies > 1").select("digest", "original")
    rows = base.join(originals, "digest", "left")
    revisit = F.coalesce(F.col("page_id") < F.col("original"), F.lit(False))
    line = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts], F.lit(CRLF))
    optional = lambda condition, column: F.when(condition, column).otherwise("")
    http = F.concat(line("HTTP/1.1 200 OK"), line("Content-Type: text/html; charset=utf-8"), line("Content-Length: ", F.col("n").cast("string")), F.lit(CRLF))
    kind = F.when(revisit, "revisit").otherwise("response")
    date = F.date_format(F.timestamp_seconds(F.lit(1704067200) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(10**9))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    body = F.when(revisit, "").otherwise(F.col("html"))
    name = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    header = F.concat(
        line("WARC/1.1"),
        line("WARC-Type: ", kind),
        optional(F.col("page_id").isNotNull(), line("WARC-Record-ID: ", F.coalesce(name(F.col("page_id")), F.lit("")))),
        optional(F.col("url").isNotNull(), line("WARC-Target-URI: ", F.coalesce("url", F.lit("")))),
        line("WARC-Date: ", date),
        line("WARC-Payload-Digest: sha1:", F.col("digest")),
        optional(revisit, F.concat(line("WARC-Profile: ", PROFILE), line("WARC-Refers-To: ", F.coalesce(name(F.col("original")), F.lit(""))))),
        line("Content-Type: application/http;msgtype=response"),
        line("Content-Length: ", (F.octet_length(http) + F.octet_length(body)).cast("string")),
        F.lit(CRLF),
    )
    return rows.select(F.concat(header, http, body).alias("value"))


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 1000, records_per_file: int = 5000) -> None:
    """A WARC record per row of ``pages`` (page_id, url, html) in gzip-compressed archives.

    The payload is the html in UTF-8 (null: empty). Of equal payloads of at least ``least_bytes``
    bytes the largest page_id is the response and smaller ones are revisits that refer to it;
    repeated rows of that page_id are responses too. Rows with a null page_id are responses
    without a record id. White space and control characters of a URL are escaped.
    """
    _records(pages, least_bytes).write.option("lineSep", CRLF + CRLF).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(folder)


# ---- reading


def parse(data: bytes):
    """Offset, length, header fields and block of every record."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:end].decode().split(CRLF)
        if not first.startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        fields = dict(line.split(": ", 1) for line in lines)
        body = end + 4
        stop = body + int(fields["Content-Length"])
        if data[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} does not end where its length says")
        yield at, stop + 4 - at, fields, data[body:stop]
        at = stop + 4


def _page(name: str | None) -> int | None:
    return int(name.removeprefix("<urn:page:").removesuffix(">")) if name else None


def _captures(run: str, data: bytes) -> list[tuple]:
    """Captures of an archive, sorted by URL key, time and page."""
    out = []
    for offset, size, fields, block in parse(data):
        head, _, payload = block.partition(b"\r\n\r\n")
        n = int(re.search(rb"(?m)^Content-Length: (\d+)", head)[1])
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        if fields["WARC-Type"] == "response" and (len(payload) != n or hashlib.sha1(payload).hexdigest() != digest):
            raise ValueError(f"payload of the record at byte {offset} of {run} is damaged")
        url = fields.get("WARC-Target-URI")
        page = _page(fields.get("WARC-Record-ID"))
        out.append((run, 0, url_key(url), fields["WARC-Date"], page, url, fields["WARC-Type"], n, digest, _page(fields.get("WARC-Refers-To")), offset, size))
    out.sort(key=_order)
    return [(c[0], i, *c[2:]) for i, c in enumerate(out)]


def _order(c: tuple) -> tuple:
    """Place of a capture in the history; a null page comes first."""
    return c[2], c[3], c[4] is not None, c[4] or 0, c[0], c[10]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], names=FIELDS)


SCHEMA = pa.schema([(n, {"string": pa.string(), "long": pa.int64()}[t]) for n, t in (f.split(" ") for f in CAPTURE.split(", "))])


def read_captures(spark, folder: str) -> DataFrame:
    """The captures of all archives of a folder; each archive is one sorted run."""

    def read(batches):
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                inflate, data, rest = None, [], content.as_py()
                while rest:  # a file may have several members
                    inflate = zlib.decompressobj(31)
                    data.append(inflate.decompress(rest))
                    rest = inflate.unused_data
                rows = _captures(path, b"".join(data))
                for i in range(0, len(rows), 4096):
                    yield _batch(rows[i : i + 4096], SCHEMA)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder)
    return files.select("path", "content").mapInArrow(read, CAPTURE)


# ---- merging


class LoserTree:
    """k-way merge of sorted lists: each inner node keeps the loser of its match, so the next
    smallest item costs one match per level."""

    def __init__(self, runs: list[list], key):
        self.key, self.runs = key, [iter(r) for r in runs]
        self.k = max(1, len(runs))
        self.heads: list = [None] * self.k
        self.keys: list = [None] * self.k
        for i in range(len(runs)):
            self._next(i)
        self.losers = [-1] * self.k
        self.winner = self._play(1) if len(runs) > 1 else 0

    def _next(self, i: int) -> None:
        self.heads[i] = next(self.runs[i], None)
        self.keys[i] = None if self.heads[i] is None else self.key(self.heads[i])

    def _less(self, a: int, b: int) -> bool:
        if self.keys[a] is None:
            return False
        return self.keys[b] is None or (self.keys[a], a) < (self.keys[b], b)

    def _play(self, node: int) -> int:
        """Winner below a node; leaves are nodes k to 2k-1."""
        if node >= self.k:
            return node - self.k
        a, b = self._play(2 * node), self._play(2 * node + 1)
        win, lose = (a, b) if self._less(a, b) else (b, a)
        self.losers[node] = lose
        return win

    def __iter__(self):
        while self.heads[self.winner] is not None:
            yield self.heads[self.winner]
            self._next(self.winner)
            w, node = self.winner, (self.winner + self.k) // 2
            while node:
                if self._less(self.losers[node], w):
                    w, self.losers[node] = self.losers[node], w
                node //= 2
            self.winner = w


def merge_index(captures: DataFrame, range_rows: int = 200_000) -> DataFrame:
    """The captures in global order: ``part`` (range) and ``place`` (from 0 in the range) give it.

    Order: URL key, time, page_id (null first), archive, offset. Ties in all are the same record.
    """
    ranges = max(1, -(-captures.count() // range_rows))

    def merge(batches):
        from pyspark import TaskContext

        runs: dict[str, list] = {}
        for batch in batches:
            for row in zip(*[batch.column(n).to_pylist() for n in FIELDS], strict=True):
                runs.setdefault(row[0], []).append(row)
        slices = [sorted(rows, key=lambda r: r[1]) for _, rows in sorted(runs.items())]
        part, at, block = TaskContext.get().partitionId(), 0, []

        def emit():
            batch = _batch(block, SCHEMA)
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * len(block), pa.int32()), pa.array(range(at, at + len(block)), pa.int64())], names=[*FIELDS, "part", "place"])

        for row in LoserTree(slices, _order) if slices else ():
            block.append(row)
            if len(block) == 4096:
                yield emit()
                at, block = at + 4096, []
        if block:
            yield emit()

    return captures.repartitionByRange(ranges, "url_key", "captured", F.col("page_id").asc_nulls_first()).mapInArrow(merge, CAPTURE + ", part int, place long")


def archive_pages(pages: DataFrame) -> DataFrame:
    """Writes the pages as archives, reads these back and gives their ordered capture index."""
    spark = pages.sparkSession
    folder = new_table_path(spark, "warc")
    write_archives(pages, folder)
    return merge_index(stored(read_captures(spark, folder), "runs"))


ORACLE_SQL = """
SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
    CASE WHEN strlen(coalesce(html, '')) >= 1000 AND page_id < max(page_id) OVER (PARTITION BY coalesce(html, '')) THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN strlen(coalesce(html, '')) >= 1000 AND page_id < max(page_id) OVER (PARTITION BY coalesce(html, '')) THEN max(page_id) OVER (PARTITION BY coalesce(html, '')) END AS refers_to
FROM pages"""
