"""A content-addressed web archive: payloads once by digest, exact record headers beside them, WARC records by joining both."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CRLF = "\r\n"
LARGE = 1024  # a digest of more than a LARGE-th of all records is hot; there are fewer than LARGE of them
SHARE = 1024  # records of one digest that meet a copy of its payload in a task
LEAST_BYTES = 100  # of a payload that others may revisit


def _digested(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload")).withColumn("digest", F.sha2("payload", 256))


def _line(name: str, value: Column) -> Column:
    """A header line, none for a null value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))


def _record_id(page_id: Column, record: Column) -> Column:
    return F.concat(F.lit("<urn:"), F.coalesce(F.concat(F.lit("page:"), F.url_encode(page_id.cast("string"))), F.lit("no-page")), F.lit(":"), record.cast("string"), F.lit(">"))


def _head(date: str) -> Column:
    """The bytes of a record ahead of its payload: WARC header, empty line, HTTP header, empty line. White space and control characters of the url are percent-encoded."""
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}"), _line("Content-Length", F.col("payload_bytes").cast("string")), F.lit(CRLF))
    revisit = F.col("record_type") == "revisit"
    block = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes"))
    url = F.col("url").cast("string")
    for code in (*range(0x21), 0x7F):
        url = F.replace(url, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    lines = [
        F.lit(f"WARC/1.1{CRLF}"), _line("WARC-Type", F.col("record_type")), _line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("record"))), _line("WARC-Date", F.lit(date)), _line("WARC-Target-URI", url),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))), _line("WARC-Profile", F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        _line("WARC-Refers-To", F.when(revisit, _record_id(F.col("first.page_id"), F.col("first.record")))), _line("Content-Type", F.lit("application/http; msgtype=response")), _line("Content-Length", block.cast("string")), F.lit(CRLF),
    ]
    return F.concat(*lines, http).cast("binary")


def write(pages: DataFrame, path: str, date: str = "2000-01-01T00:00:00Z", least_bytes: int = LEAST_BYTES) -> None:
    """Write an archive of pages (page_id, url, html) to path: payloads (digest, payload, payload_bytes, copies) and heads (record, page_id, url, digest, copies, record_type, head).

    A payload is the html in UTF-8; null is empty. Of the records with one payload of least_bytes or more, that of the smallest page_id is a
    response (null ids are largest, and of repeated rows exactly one is) and the others revisit it, without a payload; all smaller ones are
    responses. A null url has no line. Other columns are not read. An empty table makes an empty archive.

    Payloads are stored once by SHA-256. They are grouped by digest and bytes, so equal bytes are proven equal and a digest of
    two payloads is an error. Copies collapse map-side: a payload that a third of all pages have is shuffled once a task. The head of
    a hot payload's records comes by a broadcast of fewer than LARGE rows without payloads. date: of the capture, for all records.
    """
    spark = pages.sparkSession
    stored = _digested(pages).groupBy("digest", "payload").agg(F.count(F.lit(1)).alias("copies"))
    stored.withColumn("payload_bytes", F.octet_length("payload").cast("long")).write.parquet(f"{path}/payloads")
    clash = spark.read.parquet(f"{path}/payloads").groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).collect()
    if clash:
        raise ValueError(f"two payloads have the digest {clash[0]['digest']}")

    _digested(pages).select(F.monotonically_increasing_id().alias("record"), "page_id", "url", "digest", F.octet_length("payload").cast("long").alias("payload_bytes")).write.parquet(f"{path}/captures")
    ids = spark.read.parquet(f"{path}/captures")
    first = ids.groupBy("digest").agg(F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "record")).alias("first"), F.count(F.lit(1)).alias("copies"))
    first.write.parquet(f"{path}/firsts")
    first = spark.read.parquet(f"{path}/firsts")
    hot = F.broadcast(first.where(F.col("copies") * LARGE > ids.count()))
    captures = ids.join(hot, "digest").unionByName(ids.join(hot.select("digest"), "digest", "left_anti").join(first, "digest"))
    again = (F.col("payload_bytes") >= least_bytes) & (F.col("record") != F.col("first.record"))
    captures = captures.withColumn("record_type", F.when(again, "revisit").otherwise("response"))
    captures.select("record", "page_id", "url", "digest", "copies", "record_type", _head(date).alias("head")).write.parquet(f"{path}/heads")


def records(spark: SparkSession, path: str) -> DataFrame:
    """The archive's records: every head with its full payload, and warc, the record's bytes as they stand in a WARC file.

    Columns: record, url, digest, payload, head, warc. A payload whose bytes don't have its digest, or a head whose payload is missing, is an error.

    Heads and payloads know how many copies a digest has, so the join deals those of a hot digest over as many copies of its payload as
    it has shares of SHARE records.
    """
    payloads, heads = spark.read.parquet(f"{path}/payloads"), spark.read.parquet(f"{path}/heads")
    sound = F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("payload differs from its digest "), "digest")))
    payloads = payloads.select("digest", sound.alias("payload"), F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {SHARE}"))).alias("share"))
    heads = heads.withColumn("share", F.pmod(F.xxhash64("record"), F.expr(f"(copies - 1) div {SHARE} + 1")))
    joined = heads.join(payloads, ["digest", "share"], "left")
    held = F.coalesce("payload", F.raise_error(F.concat(F.lit("no payload has the digest "), "digest")).cast("binary"))
    body = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return joined.withColumn("payload", held).select("record", "url", "digest", "payload", "head", F.concat("head", body, F.lit(b"\r\n\r\n")).alias("warc"))


def parsed(head: Column) -> dict[str, Column]:
    """What a head says: record_type, page_id and refers_to as text, payload_digest, payload_bytes."""
    text = head.cast("string")

    def line(name: str) -> Column:
        return F.regexp_extract(text, f"\r\n{name}: ([^\r\n]*)\r\n", 1)

    def page(value: Column) -> Column:
        return F.when(value.startswith("<urn:page:"), F.url_decode(F.regexp_extract(value, "^<urn:page:(.*):[0-9]+>$", 1)))

    return {
        "record_type": line("WARC-Type"), "page_id": page(line("WARC-Record-ID")), "refers_to": page(line("WARC-Refers-To")),
        "payload_digest": F.regexp_replace(line("WARC-Payload-Digest"), "^sha256:", ""), "payload_bytes": F.regexp_extract(text, "\r\nContent-Length: ([0-9]+)\r\n\r\n$", 1).cast("long"),
    }


def pages(spark: SparkSession, path: str, id_type: str = "long") -> DataFrame:
    """The archived pages, read from the records: page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to.

    A record whose head disagrees with its payload is an error.
    """
    said = records(spark, path).select("url", "digest", "payload", *[c.alias(n) for n, c in parsed(F.col("head")).items()])
    agrees = (F.col("payload_digest") == F.col("digest")) & (F.col("payload_bytes") == F.octet_length("payload"))
    bytes_ = F.when(agrees, F.col("payload_bytes")).otherwise(F.raise_error(F.concat(F.lit("a head disagrees with its payload "), "digest")).cast("long"))
    return said.select(F.col("page_id").cast(id_type).alias("page_id"), "url", "payload", bytes_.alias("payload_bytes"), "payload_digest", "record_type", F.col("refers_to").cast(id_type).alias("refers_to"))


def write_files(records: DataFrame, folder: str) -> None:
    """WARC files of records, one for each task; a record ends with two line breaks, which the writer adds."""
    records.select(F.expr("substring(warc, 1, octet_length(warc) - 4)").cast("string").alias("value")).write.option("lineSep", CRLF * 2).text(folder)


def _in_file(batches: Iterator[pa.RecordBatch]):
    size = re.compile(rb"\r\nContent-Length: ([0-9]+)\r\n")
    for batch in batches:
        for body in batch.column("content"):
            data, at, heads, payloads = memoryview(body.as_buffer()), 0, [], []
            while at < len(data):
                ends, start = b"", at
                while b"\r\n\r\n" not in ends[-3 - (1 << 12) :]:
                    if start >= len(data):
                        raise ValueError("a record's header doesn't end")
                    ends += bytes(data[start : start + (1 << 12)])
                    start += 1 << 12
                top = ends[: ends.index(b"\r\n\r\n") + 4]
                stop = at + len(top) + int(size.search(top)[1])
                block = bytes(data[at + len(top) : stop])
                if not top.startswith(b"WARC/") or len(data) < stop + 4 or data[stop : stop + 4] != b"\r\n\r\n":
                    raise ValueError("not a WARC record")
                http = block.index(b"\r\n\r\n") + 4
                heads.append(top + block[:http])
                payloads.append(block[http:])
                at = stop + 4
            yield pa.RecordBatch.from_arrays([pa.array(heads, pa.binary()), pa.array(payloads, pa.binary())], ["head", "payload"])


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """head and payload of every record in the WARC files of a folder, in which a record's block begins with an HTTP header. A file is read whole in one task."""
    return spark.read.format("binaryFile").load(folder).select("content").mapInArrow(_in_file, "head binary, payload binary")
