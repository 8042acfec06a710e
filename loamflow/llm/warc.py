"""WARC archives: write, read, and resolve revisits into deduplicated archives.

Archives are gzip-compressed WARC 1.1 files. A record is its header lines, an empty line,
the payload and two line ends; Spark's text writer puts the records of a partition into one
file (its line separator is the record's end), so any file system Spark can write works, a
retried task replaces its file, and a lost executor loses nothing. Files are read as whole
binary files and parsed as a stream; ``records_per_file`` bounds their size.

Resolution never groups payloads: headers (record id, digest, length) are shuffled by
payload digest, the smallest id of each digest is found with map-side partial aggregation,
and the decisions are joined back to the records by record id.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_run_dir
from .common import map_arrow, materialize

CRLF = "\r\n"
RECORD_END = CRLF + CRLF
#: Fixed value: when no capture time is known.
DATE = "1970-01-01T00:00:00Z"
RECORDS_PER_FILE = 20_000
#: Fixed value: the profile of a revisit by identical payload digest.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEX32, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
RECORD = ("page_id long, record_type string, uri string, refers_to long, payload_digest string, "
          "payload_bytes long, body binary")


def sha1_base32(data: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: 40 bits (ten hex digits) make eight letters."""
    hexed = F.sha1(data)
    return F.concat(*[F.translate(F.lpad(F.conv(F.substring(hexed, 1 + 10 * i, 10), 16, 32),
                                         8, "0"), HEX32, BASE32) for i in range(4)])


def _line(name: str, value: Column) -> Column:
    return F.when(value.isNull(), F.lit("")).otherwise(
        F.concat(F.lit(name + ": "), value.cast("string"), F.lit(CRLF)))


def write_archive(records: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write records (page_id, uri, record_type, refers_to, payload_digest, body) to ``path``.
    A null page_id or uri leaves its header out; a revisit has an empty block and names the
    record it refers to. Line ends within a uri are written as spaces."""
    body = F.when(F.col("record_type") == "revisit", F.lit("").cast("binary")).otherwise(F.col("body"))
    uri = F.translate("uri", CRLF, "  ")
    head = F.concat(
        F.lit("WARC/1.1" + CRLF), _line("WARC-Type", F.col("record_type")),
        _line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.col("page_id"), F.lit(">"))),
        F.lit(f"WARC-Date: {DATE}{CRLF}"), _line("WARC-Target-URI", uri),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to"), F.lit(">"))),
        F.when(F.col("record_type") == "revisit", F.lit(f"WARC-Profile: {PROFILE}{CRLF}"))
        .otherwise(F.lit("")),
        F.lit("Content-Type: text/html" + CRLF), _line("Content-Length", F.octet_length(body)),
        F.lit(CRLF))
    record = F.concat(head.cast("binary"), body).cast("string")
    (records.select(record.alias("value")).write.option("lineSep", RECORD_END)
     .option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path))


class _Stream:
    """Inflates the members of a gzip file piece by piece."""

    def __init__(self, data: bytes, step: int = 1 << 20):
        self.data, self.at, self.step = memoryview(data), 0, step
        self.have, self.z = bytearray(), None
        self.plain = data[:2] != b"\x1f\x8b"

    def _more(self) -> bool:
        if self.at >= len(self.data):
            return False
        piece = self.data[self.at:self.at + self.step]
        self.at += len(piece)
        while len(piece):
            if self.plain:
                self.have += piece
                break
            self.z = self.z or zlib.decompressobj(31)
            self.have += self.z.decompress(piece)
            piece = b""
            if self.z.eof:
                piece, self.z = self.z.unused_data, None
        return True

    def until(self, mark: bytes, start: int = 0) -> int:
        while (i := self.have.find(mark, start)) < 0:
            start = max(0, len(self.have) - len(mark))
            if not self._more():
                return -1
        return i

    def take(self, n: int) -> bytes:
        while len(self.have) < n and self._more():
            pass
        out = bytes(self.have[:n])
        del self.have[:n]
        return out


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of one archive, plain or gzip (one member or one a record): lower-cased
    header names with their values, and the block. A record cut short raises ValueError."""
    s = _Stream(data)
    while True:
        i = s.until(RECORD_END.encode())
        if i < 0:
            if bytes(s.have).strip():
                raise ValueError("archive ends within a record header")
            return
        lines = s.take(i + 4).decode("utf-8", "replace").strip().split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {lines[0][:80]!r}")
        head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = int(head.get("content-length", 0))
        block = s.take(size)
        if len(block) < size:
            raise ValueError("archive ends within a record block")
        s.take(4)
        yield head, block


def _number(urn: str | None) -> int | None:
    digits = (urn or "").rpartition(":")[2].strip("<>")
    return int(digits) if digits.lstrip("-").isdigit() else None


def _reader(keep_body: bool):
    def read(batches):
        names = ["page_id", "record_type", "uri", "refers_to", "payload_digest", "payload_bytes", "body"]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for head, block in parse_records(content.as_py()):
                    kind, digest, size = head.get("warc-type"), head.get("warc-payload-digest"), None
                    if kind == "revisit":
                        digest = (digest or "").removeprefix("sha1:") or None
                    else:
                        digest, size = base64.b32encode(hashlib.sha1(block).digest()).decode(), len(block)
                    rows.append((_number(head.get("warc-record-id")), kind, head.get("warc-target-uri"),
                                 _number(head.get("warc-refers-to")), digest, size,
                                 block if keep_body else None))
                    held += len(block) if keep_body else 100
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
    return read


def read_archive(spark: SparkSession, path: str, bodies: bool = True) -> DataFrame:
    """Every record below ``path``. The digest and size of a response are taken from the block
    that was read, those of a revisit from its header (its size is null). ``bodies=False``
    leaves the blocks in the workers."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return map_arrow(files, _reader(bodies), RECORD)


def resolve_revisits(headers: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Which record each record refers to: (page_id, payload_digest, refers_to), one row for every
    page that is to become a revisit. ``headers`` holds page_id, payload_digest and payload_bytes. Of equal
    payloads of at least ``min_bytes`` bytes the smallest page_id stays a response; records
    without an id stay as they are."""
    h = headers.where((F.col("payload_bytes") >= min_bytes) & F.col("page_id").isNotNull())
    first = (h.groupBy("payload_digest", "payload_bytes")
             .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1"))
    return (h.join(first, ["payload_digest", "payload_bytes"]).where("page_id > first_id")
            .select("page_id", "payload_digest", F.col("first_id").alias("refers_to")).distinct())


def page_records(pages: DataFrame) -> DataFrame:
    """A response record for each row of pages (page_id, url, html); null html is empty."""
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").alias("uri"),
                        F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"),
                        sha1_base32(body).alias("payload_digest"), body.alias("body"))


def deduplicate(spark: SparkSession, source: str, target: str, min_bytes: int = 0) -> None:
    """Read the archives below ``source`` and write deduplicated ones with fresh headers to
    ``target``. Revisits that ``source`` already holds count as copies of what they refer to.
    Repeated rows of one page_id with one payload are all responses."""
    headers = materialize(read_archive(spark, source, bodies=False).drop("body", "uri"), "warc-headers")
    old = headers.where("record_type = 'revisit'")
    sizes = headers.where("record_type = 'response'").select(
        F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("size")).distinct()
    known = (headers.where("record_type = 'response'").select("page_id", "payload_digest", "payload_bytes")
             .unionByName(old.join(sizes, "refers_to")
                          .select("page_id", "payload_digest", F.col("size").alias("payload_bytes"))))
    again = resolve_revisits(known, min_bytes).withColumnRenamed("refers_to", "first_id")
    records = read_archive(spark, source).join(again, ["page_id", "payload_digest"], "left")
    fresh = records.select("page_id", "uri", "payload_digest", "body",
                           F.coalesce("first_id", "refers_to").alias("refers_to")).withColumn(
        "record_type", F.when(F.col("refers_to").isNull(), "response").otherwise("revisit"))
    write_archive(fresh, target)


def resolved(spark: SparkSession, path: str) -> DataFrame:
    """Read archives back with every revisit joined to its original response: page_id,
    payload_bytes, payload_digest, record_type, refers_to, uri. A revisit whose original is
    missing keeps a null size."""
    r = read_archive(spark, path, bodies=False).drop("body")
    originals = r.where("record_type = 'response' AND page_id IS NOT NULL").select(
        F.col("page_id").alias("refers_to"), "payload_digest", F.col("payload_bytes").alias("size")).distinct()
    revisits = r.where("record_type = 'revisit'").join(originals, ["refers_to", "payload_digest"], "left")
    cols = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "uri")
    return (r.where("record_type <> 'revisit'").select(*cols)
            .unionByName(revisits.withColumn("payload_bytes", F.col("size")).select(*cols)))


def warc_round_trip(spark: SparkSession, pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write a record for every page, deduplicate the archives, and read them back resolved.
    An empty table gives empty archives and no rows."""
    raw, clean = new_run_dir(spark, "warc-raw"), new_run_dir(spark, "warc-clean")
    write_archive(page_records(pages), raw)
    deduplicate(spark, raw, clean, min_bytes)
    return resolved(spark, clean)


# SHA-1 isn't among DuckDB's digests of every build; where it is, base32 is spelled out.
ORACLE_WARC = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha1(html) AS x FROM p),
g AS (SELECT *, ('0x' || substr(x, 1, 10))::BIGINT AS a, ('0x' || substr(x, 11, 10))::BIGINT AS b,
             ('0x' || substr(x, 21, 10))::BIGINT AS c, ('0x' || substr(x, 31, 10))::BIGINT AS d FROM h),
e AS (SELECT page_id, payload_bytes,
        list_aggregate(list_transform(range(32), lambda i:
          substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            (((CASE i // 8 WHEN 0 THEN a WHEN 1 THEN b WHEN 2 THEN c ELSE d END)
              >> ((7 - i % 8) * 5)::INT) & 31)::INT + 1, 1)), 'string_agg', '') AS payload_digest
      FROM g),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first_id FROM e)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id > first_id AND payload_bytes >= 0 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first_id AND payload_bytes >= 0 THEN first_id END AS refers_to
FROM f
"""
