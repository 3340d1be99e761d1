"""WARC archives of pages in which a payload is stored once: later records of it are revisits.

Headers are shuffled by payload digest to find what repeats, archives are
written by Spark's text writer, whose line separator is the two line ends that
close a record, and read back by record length, their digests verified.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.keyfilter import filter_bits, may_hold
from ..session import BROADCAST_ROWS, broadcast_if_small, new_place, written

#: Fixed: what a record consists of.
VERSION = "WARC/1.1"
END = "\r\n"
RECORD_END = END + END
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payload bytes from which equal payloads are stored once.
MIN_REVISIT_BYTES = 1000
#: Records of an archive file, at most, and the payload bytes up to which so many may share one (1 GB in all).
RECORDS_PER_FILE = 5000
LARGE_BYTES = 200_000
RESPONSE, REVISIT = "response", "revisit"


def record_id(page_id: Column, url: Column, digest: Column) -> Column:
    """A urn for a record, the same at every run."""
    mark = F.md5(F.concat_ws("\n", F.coalesce(page_id.cast("string"), F.lit("-")), F.coalesce(url, F.lit("-")), digest))
    parts = [F.substring(mark, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def headers(pages: DataFrame) -> DataFrame:
    """page_id, url, html (null: empty) with payload_digest (bare SHA-1), payload_bytes and record_id."""
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("html"))
    rows = rows.withColumn("payload_digest", F.sha1(F.encode("html", "UTF-8"))).withColumn("payload_bytes", F.octet_length("html").cast("long"))
    return rows.withColumn("record_id", record_id(F.col("page_id"), F.col("url"), F.col("payload_digest")))


def originals(rows: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(payload_digest, original): of payloads that repeat, page_id, record_id and url of the record with the largest page_id.

    Each task adds its headers up by digest before they move.
    """
    own = F.struct("page_id", "record_id", "url")
    repeated = rows.filter(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest").agg(F.count("*").alias("n"), F.max(own).alias("original"))
    return repeated.filter("n > 1").select("payload_digest", "original")


def _clean(value: Column) -> Column:
    """A header value on one line."""
    return F.regexp_replace(value, r"[\x00-\x1F\x7F]", "%20")


def _header(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(END)), F.lit(""))


def revisits(heads: DataFrame, found: DataFrame) -> DataFrame:
    """Headers of the records that are revisits, with the ``original`` they refer to."""
    joined = heads.join(broadcast_if_small(found), "payload_digest")
    return joined.filter(F.col("original.record_id") != F.col("record_id"))


def responses(rows: DataFrame, revisited: DataFrame) -> DataFrame:
    """The rows that are no revisits, found by record id, which no two pages share.

    Few ids are broadcast.  Beyond, a Bloom filter tells apart the rows that are
    surely none, so that payloads that do not repeat stay where they are, and
    the rest is decided by a join.
    """
    ids = revisited.select("record_id").distinct()
    n = ids.count()
    if n <= BROADCAST_ROWS:
        return rows.join(F.broadcast(ids), "record_id", "left_anti")
    held = may_hold(rows, ["record_id"], ids, ["record_id"], filter_bits(n))
    if held is None:
        return rows.join(ids, "record_id", "left_anti")
    return rows.filter(~held).unionByName(rows.filter(held).join(ids, "record_id", "left_anti"))


def _text(original: Column | None, date: str) -> Column:
    """A whole record but for the two line ends that close it: a revisit to ``original`` without payload, or a response."""
    revisit = original is not None
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), F.col("payload_bytes").cast("string"), F.lit(RECORD_END))
    block = http if revisit else F.concat(http, "html")
    lines = [
        _header("WARC-Type", F.lit(REVISIT if revisit else RESPONSE)),
        _header("WARC-Record-ID", F.col("record_id")),
        _header("WARC-Date", F.lit(date)),
        _header("WARC-Target-URI", _clean(F.col("url"))),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
    ]
    if original is not None:
        lines += [
            _header("WARC-Profile", F.lit(REVISIT_PROFILE)),
            _header("WARC-Refers-To", original["record_id"]),
            _header("WARC-Refers-To-Target-URI", _clean(original["url"])),
        ]
    lines += [
        _header("Page-ID", F.col("page_id").cast("string")),
        _header("Content-Type", F.lit("application/http; msgtype=response")),
        _header("Content-Length", F.octet_length(block).cast("string")),
    ]
    return F.concat(F.lit(VERSION + END), *lines, F.lit(END), block)


def records(pages: DataFrame, date: str, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(record, payload_bytes): a whole WARC record of every page with fresh headers, but for the two line ends that close it.

    Of equal payloads of ``min_bytes`` or more, the record with the largest
    page_id carries the payload; the others are revisits that refer to it.
    Rows that are equal in page_id, url and payload are the same record and all carry it.
    Headers alone are written and joined by digest; a revisit is made from them.
    """
    rows = headers(pages)
    heads = written(rows.drop("html"), "warc-headers")
    revisited = written(revisits(heads, written(originals(heads, min_bytes), "warc-originals")), "warc-revisits")
    whole = responses(rows, revisited).select(_text(None, date).alias("record"), "payload_bytes")
    return whole.unionByName(revisited.select(_text(F.col("original"), date).alias("record"), F.lit(0).cast("long").alias("payload_bytes")))


def write_archives(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", min_bytes: int = MIN_REVISIT_BYTES) -> None:
    """Archives of ``pages`` (page_id, url, html) as gzip files in the folder ``path``, deduplicated.

    Payloads too large for many to share a file go to files of fewer records.
    """
    made = records(pages, date, min_bytes)
    largest = pages.agg(F.max(F.octet_length("html"))).first()[0] or 0
    parts = [(made, RECORDS_PER_FILE)]
    if largest > LARGE_BYTES:
        large = F.col("payload_bytes") > LARGE_BYTES
        parts = [(made.filter(~large), RECORDS_PER_FILE), (made.filter(large), max(1, RECORDS_PER_FILE * LARGE_BYTES // largest))]
    for part, most in parts:
        writer = part.select("record").write.mode("append").option("lineSep", RECORD_END).option("compression", "gzip")
        writer.option("maxRecordsPerFile", most).text(path)


def parse_archive(stream: io.BufferedIOBase) -> Iterator[dict[str, str | int | bool | None]]:
    """Header fields of each record, with the size of the payload it carries; a payload that is not what its digest says is an error."""
    while line := stream.readline():
        if line.rstrip() != VERSION.encode():
            raise ValueError(f"no record begins with {line[:40]!r}")
        fields: dict[str, str | int | bool | None] = {}
        while (line := stream.readline()) not in (END.encode(), b""):
            name, _, value = line.decode().partition(": ")
            fields[name] = value.removesuffix(END)
        block = stream.read(int(fields["Content-Length"]))
        if len(block) != int(fields["Content-Length"]) or stream.read(4) != RECORD_END.encode():
            raise ValueError("a record ends early")
        payload = block.partition(RECORD_END.encode())[2]
        if fields["WARC-Type"] == RESPONSE:
            if hashlib.sha1(payload).hexdigest() != fields["WARC-Payload-Digest"].removeprefix("sha1:"):
                raise ValueError(f"the payload of {fields['WARC-Record-ID']} is not what its digest says")
            fields["bytes"] = len(payload)
        yield fields


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(record_id, refers_to_id, record_type, url, page_id, payload_digest, payload_bytes) of every record; a revisit carries no payload and has null bytes."""
    layout = "record_id string, refers_to_id string, record_type string, url string, page_id long, payload_digest string, payload_bytes long"
    kinds = [pa.string()] * 4 + [pa.int64(), pa.string(), pa.int64()]
    names = [c.split()[0] for c in layout.split(", ")]

    def rows_of(content: bytes) -> Iterator[tuple]:
        with gzip.GzipFile(fileobj=io.BytesIO(content)) as stream:
            for f in parse_archive(stream):
                page = f.get("Page-ID")
                yield (f["WARC-Record-ID"], f.get("WARC-Refers-To"), f["WARC-Type"], f.get("WARC-Target-URI"), int(page) if page else None,
                       f["WARC-Payload-Digest"].removeprefix("sha1:"), f.get("bytes"))

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                columns = list(zip(*rows_of(content.as_py()))) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content").mapInArrow(parsed, layout)


def resolved(archived: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to): revisits joined to the responses they refer to; responses stay where they are."""
    back, whole = (archived.filter(F.col("record_type") == kind) for kind in (REVISIT, RESPONSE))
    asked = broadcast_if_small(written(back.select(F.col("refers_to_id").alias("record_id")).distinct(), "warc-referred"))
    found = whole.join(asked, "record_id", "left_semi").groupBy(F.col("record_id").alias("refers_to_id")).agg(
        F.max("page_id").alias("refers_to"), F.max("payload_bytes").alias("_bytes")
    )
    met = back.join(broadcast_if_small(written(found, "warc-found")), "refers_to_id", "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    sized = met.withColumn("payload_bytes", F.coalesce("payload_bytes", "_bytes")).select(columns)
    return whole.withColumn("refers_to", F.lit(None).cast("long")).select(columns).unionByName(sized)


def archive_and_read(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write the archives, into a new folder of the shared one unless ``path`` is given, and read every record back."""
    spark = pages.sparkSession
    path = path or new_place(spark, "warc")
    write_archives(pages, path)
    return resolved(written(read_archives(spark, path), "warc-read"))
