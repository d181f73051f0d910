"""WARC archives without repeated payloads: digests decide which record is the response, the others revisit it.

Only headers (id, digest, length) are shuffled by digest, with a partial minimum per task, so a payload that a third of
all pages share costs one row per task. Decisions come back by page id, which is even. Archives are gzip files that any
number of readers stream; a reader holds one record at a time. (Spark writes a file as one gzip member, so records are
found by reading on, not by seeking.)

Defined results: a null payload is empty; payloads under ``least`` bytes are never revisits; rows that repeat the
smallest id of a payload are all responses; a null id counts as larger than any other, and payloads that only rows
without an id hold are all responses; empty tables write no records; other columns are ignored; a null URL is empty, and
line breaks in URLs are percent-encoded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lean, ready

SEP = "\r\n\r\n"
_SEP = SEP.encode()
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def revisits_of(headers: DataFrame, least: int) -> DataFrame:
    """(id, digest, first, first_url) of each header whose payload an earlier id holds. headers: (id, url, digest, bytes)."""
    large = headers.filter(F.col("bytes") >= least)
    # the least (id, url) of the rows that have an id
    known = F.when(F.col("id").isNotNull(), F.struct("id", "url"))
    first = large.groupBy("digest").agg(F.min(known).alias("k"), F.count(F.lit(1)).alias("n"))
    first = first.filter("n > 1 and k is not null").select("digest", F.col("k.id").alias("first"), F.col("k.url").alias("first_url"))
    return large.join(first, "digest").filter(~F.col("id").eqNullSafe(F.col("first"))).select("id", "digest", "first", "first_url").distinct()


def record_id(key: Column, digest: Column) -> Column:
    """One for each id and payload; rows that repeat both share it."""
    return F.concat(F.lit("<urn:record:"), F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), F.left(digest, F.lit(32)), F.lit(">"))


def write_archives(
    pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html",
    least: int = 100, records_per_file: int = 50_000, date: str | None = None,
) -> None:
    """Write every row as a WARC record into gzip files in folder, with one date, now if none is given."""
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    body = F.coalesce(F.col(payload), F.lit(""))
    safe = F.replace(F.replace(F.coalesce(F.col(url), F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    p = pages.select(F.col(key).alias("id"), safe.alias("url"), body.alias("body"))
    p = p.withColumns({"bytes": F.octet_length("body"), "digest": F.sha2("body", 256)})
    d = revisits_of(p.select("id", "url", "digest", "bytes"), least).select(F.col("id").alias("rid"), F.col("digest").alias("rdigest"), "first", "first_url")
    r = p.join(d, F.col("id").eqNullSafe(F.col("rid")) & (F.col("digest") == F.col("rdigest")), "left")
    again = F.col("first").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(SEP))
    kept = F.when(again, "").otherwise(F.col("body"))
    refers = F.concat(
        F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: "), record_id(F.col("first"), F.col("digest")),
        F.lit("\r\nWARC-Refers-To-Target-URI: "), F.col("first_url"), F.lit(f"\r\nWARC-Refers-To-Date: {date}"),
    )
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(again, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), record_id(F.col("id"), F.col("digest")),
        F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Target-URI: "), safe,
        F.lit("\r\nWARC-Payload-Digest: sha256:"), F.col("digest"),
        F.when(again, refers).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        (F.octet_length(http) + F.octet_length(kept)).cast("string"), F.lit(SEP),
    )
    out = r.select(F.concat(head, http, kept).alias("value"))
    out.write.option("lineSep", SEP).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(folder)


def _fields(head: bytes) -> dict[bytes, bytes]:
    return dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:] if b": " in x)


def records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[bytes, bytes], dict[bytes, bytes], bytes]]:
    """(WARC fields, HTTP fields, payload) of each record of a stream that was cut at every blank line."""
    rest: list[bytes] = []

    def more() -> bytes:
        return rest.pop() if rest else next(pieces)

    while True:
        try:
            head = more()
        except StopIteration:
            return
        if not head.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {head[:40]!r}")
        warc = _fields(head)
        size = int(warc[b"Content-Length"])
        block, have = [more()], 0
        have = len(block[0])
        while have < size:  # the payload holds blank lines, or begins with one
            try:
                piece = more()
            except StopIteration:
                block.append(b"")
                have += len(_SEP)
                break
            block.append(piece)
            have += len(_SEP) + len(piece)
        whole = _SEP.join(block)
        if have < size:
            raise ValueError(f"a record ends after {have} of {size} bytes")
        if have > size:  # the payload ends in part of a blank line: what follows is the terminator and the next record
            rest.append(whole[size:].removeprefix(_SEP))
            if not rest[-1]:
                rest.pop()
        http, _, payload = whole[:size].partition(_SEP)
        yield warc, _fields(http), payload


def _id_of(field: bytes | None) -> int | None:
    text = (field or b"").removeprefix(b"<urn:record:").partition(b":")[0]
    return int(text) if text else None


def read_archives(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """(id, record_type, digest, bytes, refers_to[, payload]) of each record, the digests of responses computed anew.

    A response whose payload doesn't have the digest of its header is an error.
    """
    ready(spark)
    schema = "id long, record_type string, digest string, bytes long, refers_to long" + ", payload binary" * payloads

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0

        def batch() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()] + [pa.binary()] * payloads
            names = ["id", "record_type", "digest", "bytes", "refers_to"] + ["payload"] * payloads
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        for warc, http, payload in records(x for b in batches for x in b.column(0).to_pylist()):
            kind, said = warc[b"WARC-Type"].decode(), warc[b"WARC-Payload-Digest"].decode().removeprefix("sha256:")
            size = int(http[b"Content-Length"])
            if kind == "response" and (hashlib.sha256(payload).hexdigest() != said or len(payload) != size):
                raise ValueError(f"record {warc[b'WARC-Record-ID']!r} is damaged")
            row = (_id_of(warc[b"WARC-Record-ID"]), kind, said, size, _id_of(warc.get(b"WARC-Refers-To")))
            rows.append(row + (payload,) * payloads)
            held += len(payload) * payloads
            if len(rows) >= 1000 or held > 1 << 24:
                yield batch()
                rows, held = [], 0
        if rows:
            yield batch()

    text = spark.read.option("lineSep", SEP).schema("value string").text(folder)
    return text.select(F.col("value").cast("binary")).mapInArrow(lean(run), schema)


def resolved(read: DataFrame) -> DataFrame:
    """Every record with the payload length of the response that a revisit refers to, by id and digest.

    Large groups of revisits are the skewed side of a sort-merge join, which Spark splits.
    """
    original = read.filter("record_type = 'response' and id is not null").select(F.col("id").alias("oid"), F.col("digest").alias("odigest"), F.col("bytes").alias("obytes")).distinct()
    again = read.filter("record_type = 'revisit'").join(original, (F.col("refers_to") == F.col("oid")) & (F.col("digest") == F.col("odigest")), "left")
    again = again.select("id", "record_type", "digest", F.col("obytes").alias("bytes"), "refers_to")
    return read.filter("record_type = 'response'").select(*again.columns).unionByName(again)
