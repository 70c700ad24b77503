"""WARC archives in which equal payloads are stored once.

Headers (id, size and digest of the payload) are shuffled by digest; of the records with
equal payloads the one with the smallest page_id is the response, the others become
revisits of it.  The archives are written with fresh headers by Spark's text writer, whose
separator is the blank lines that end a record, so that a lost executor costs a file and
no more.  Reading goes by Content-Length, as payloads may contain anything.

Payloads under ``LEAST_BYTES`` are always written out.  Null payloads are empty ones.  Rows
that repeat the page_id of a response are responses themselves; rows without a page_id
are revisits where a response exists, and responses otherwise.  Line ends in a URL are
percent-encoded; a null URL has no header.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.llm.common import shared_path, stored

LEAST_BYTES = 100
RECORDS_PER_FILE = 4096
# A payload that a third of all pages have is spread over so many parts.
SALTS = 32

# Fixed values of the format.
VERSION = "WARC/1.1"
LINE, GAP = "\r\n", "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_READ_BYTES = 1 << 20


def headers(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest) of every row."""
    text = F.coalesce(F.col(payload).cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), text.alias("payload"))
    size = F.octet_length("payload").cast("long").alias("payload_bytes")
    return rows.select("*", size, F.sha2("payload", 256).alias("payload_digest"))


def revisits(heads: DataFrame) -> DataFrame:
    """(page_id, digest, first_id, first_url) of rows whose payload an earlier page has.

    ``heads`` has page_id, url, payload_bytes and payload_digest, and no payload.
    """
    long = heads.filter(F.col("payload_bytes") >= LEAST_BYTES)
    first = F.min(F.struct(F.col("page_id").isNull(), "page_id", "url")).alias("first")
    groups = long.groupBy("payload_digest").agg(first, F.count("*").alias("n")).filter("n > 1")
    groups = groups.select(F.col("payload_digest").alias("digest"), "first")
    spread = groups.withColumn("salt", F.explode(F.expr(f"sequence(0L, {SALTS - 1}L)")))
    salted = long.select("page_id", "payload_digest", F.expr(f"pmod(xxhash64(page_id, url), {SALTS})").alias("salt"))
    found = salted.join(spread, [F.col("payload_digest") == F.col("digest"), salted["salt"] == spread["salt"]])
    later = F.coalesce(F.col("page_id") > F.col("first.page_id"), F.col("first.page_id").isNotNull())
    return found.filter(later).select(
        "page_id", "digest", F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url")
    ).distinct()


def _record_id(page_id: Column, digest: Column) -> Column:
    """A name-based identifier, equal in reruns."""
    name = F.md5(F.concat_ws(" ", F.coalesce(page_id.cast("string"), F.lit("-")), digest).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(name, "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-"), F.lit(">"))


def _header(name: str, value: Column) -> Column:
    safe = F.replace(F.replace(value.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit(LINE)), F.lit(""))


def records(pages: DataFrame, later: DataFrame, written: datetime) -> DataFrame:
    """(value): a whole record per row, without the blank lines that end it."""
    later = later.select(F.col("page_id").alias("later_id"), "digest", "first_id", "first_url")
    same = F.col("page_id").eqNullSafe(F.col("later_id")) & (F.col("payload_digest") == F.col("digest"))
    rows = pages.join(later, same, "left")
    again = F.col("digest").isNotNull()
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=UTF-8{LINE}Content-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(GAP),
    )
    body = F.when(again, F.lit("")).otherwise(F.col("payload").cast("string"))
    length = F.octet_length(http) + F.when(again, F.lit(0)).otherwise(F.col("payload_bytes"))
    moment = written.astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    none = F.lit(None).cast("string")
    return rows.select(
        F.concat(
            F.lit(VERSION + LINE),
            _header("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
            _header("WARC-Record-ID", _record_id(F.col("page_id"), F.col("payload_digest"))),
            _header("WARC-Date", F.lit(moment)),
            _header("WARC-Target-URI", F.col("url")),
            _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
            _header("WARC-Profile", F.when(again, F.lit(PROFILE)).otherwise(none)),
            _header("WARC-Refers-To", F.when(again, _record_id(F.col("first_id"), F.col("digest"))).otherwise(none)),
            _header("WARC-Refers-To-Target-URI", F.col("first_url")),
            _header("X-Page-ID", F.col("page_id")),
            _header("X-Refers-To-Page-ID", F.col("first_id")),
            F.lit(f"Content-Type: application/http;msgtype=response{LINE}"),
            _header("Content-Length", length),
            F.lit(LINE),
            http,
            body,
        ).alias("value")
    )


def write(pages: DataFrame, path: str, written: datetime | None = None) -> None:
    """Write deduplicated archives of ``pages`` (page_id, url, html) below ``path``."""
    whole = headers(pages)
    heads = stored(whole.drop("payload"), "headers")
    later = stored(revisits(heads), "revisits")
    rows = records(whole, later, written or datetime.now(timezone.utc))
    out = rows.write.option("lineSep", GAP).option("maxRecordsPerFile", RECORDS_PER_FILE)
    out.option("compression", "gzip").text(path)


class _Stream:
    """Bytes of a compressed file, unpacked a piece at a time."""

    def __init__(self, content: bytes) -> None:
        self.content, self.at, self.buffer = memoryview(content), 0, bytearray()
        self.unzip = zlib.decompressobj(wbits=31)

    def _more(self) -> bool:
        while self.at < len(self.content):
            piece = self.content[self.at : self.at + _READ_BYTES]
            self.at += len(piece)
            self.buffer += self.unzip.decompress(piece)
            while self.unzip.eof and self.unzip.unused_data:  # the next member
                rest, self.unzip = self.unzip.unused_data, zlib.decompressobj(wbits=31)
                self.buffer += self.unzip.decompress(rest)
            if self.buffer:
                return True
        return False

    def until(self, mark: bytes) -> bytes | None:
        """Up to and without ``mark``; None at the end."""
        begin = 0
        while (found := self.buffer.find(mark, begin)) < 0:
            begin, size = max(0, len(self.buffer) - len(mark)), len(self.buffer)
            if not self._more() or len(self.buffer) == size:
                if bytes(self.buffer).strip():
                    raise ValueError("a record is cut off")
                return None
        out = bytes(self.buffer[:found])
        del self.buffer[: found + len(mark)]
        return out

    def take(self, size: int) -> bytes:
        while len(self.buffer) < size:
            before = len(self.buffer)
            if not self._more() or len(self.buffer) == before:
                raise ValueError("a record is cut off")
        out = bytes(self.buffer[:size])
        del self.buffer[:size]
        return out


def parse(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of a compressed archive."""
    stream = _Stream(content)
    while (head := stream.until(GAP.encode())) is not None:
        first, *lines = head.decode("utf-8", "surrogateescape").split(LINE)
        if first != VERSION:
            raise ValueError(f"no record begins with {first[:40]!r}")
        fields = dict(line.split(": ", 1) for line in lines)
        block = stream.take(int(fields["Content-Length"]))
        if stream.take(len(GAP)) != GAP.encode():
            raise ValueError("a record does not end where its length says")
        yield fields, block


def read(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record.

    Sizes and digests of responses are those of the payload read; a revisit's are those of
    its headers.  ``payloads`` adds the payload, null for revisits.
    """
    found = spark.read.format("binaryFile").load(path).filter("length > 0").select("content")
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * payloads
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()] + [pa.binary()] * payloads

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0).to_pylist():
                rows, held = [], 0
                for fields, block in parse(content):
                    http, _, payload = block.partition(GAP.encode())
                    kind = fields["WARC-Type"]
                    own = kind == "response"
                    size = len(payload) if own else int(http.rsplit(b"Content-Length: ", 1)[1])
                    digest = hashlib.sha256(payload).hexdigest() if own else fields["WARC-Payload-Digest"][len("sha256:") :]
                    ids = [int(fields[h]) if h in fields else None for h in ("X-Page-ID", "X-Refers-To-Page-ID")]
                    rows.append((ids[0], size, digest, kind, ids[1], payload if own else None))
                    held += len(payload) * payloads
                    if len(rows) >= 4096 or held > _READ_BYTES * 16:
                        yield _batch(rows, names, kinds)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows, names, kinds)

    layout = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    return found.mapInArrow(run, layout + ", payload binary" * payloads)


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))[: len(names)]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def resolved(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload) of every record: revisits are joined to their responses by digest."""
    rows = read(spark, path, payloads=True)
    asked = rows.filter("record_type = 'revisit'").select("page_id", F.col("payload_digest").alias("digest"))
    asked = asked.withColumn("salt", F.expr(f"pmod(xxhash64(page_id), {SALTS})"))
    wanted = asked.select(F.col("digest").alias("wanted"), F.col("salt").alias("at")).distinct()
    own = rows.filter("record_type = 'response'")
    original = own.groupBy("payload_digest").agg(F.min("payload").alias("payload"))
    spread = wanted.join(original, F.col("wanted") == F.col("payload_digest")).select("wanted", "at", "payload")
    again = asked.join(spread, (F.col("digest") == F.col("wanted")) & (F.col("salt") == F.col("at")), "left")
    return own.select("page_id", "payload").unionByName(again.select("page_id", "payload"))


def archived(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write the archives and read them back: one row per page."""
    path = path or shared_path(pages.sparkSession, "warc")
    write(pages, path)
    return read(pages.sparkSession, path)


ORACLE = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
             sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, CASE WHEN payload_bytes >= 100
        THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_id FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
  CASE WHEN coalesce(page_id > first_id, first_id IS NOT NULL) THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN coalesce(page_id > first_id, first_id IS NOT NULL) THEN first_id END AS refers_to FROM f
"""
