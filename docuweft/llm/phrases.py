"""Fingerprints of texts by their Lempel-Ziv phrases: alike if the same phrases compress them.

A text's bytes are parsed as LZ78 does: each phrase is the shortest run that is
not in the dictionary yet, and joins it.  The phrases' hashes are the text's
set, and its KEPT smallest are the fingerprint.  Of two fingerprints, the
share of the KEPT smallest hashes of both together that stands in both tells
how much of their phrases the texts share; it is exact for texts with no
more phrases than KEPT.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import local_frame, written

#: Smallest hashes that are kept, four bytes each.
KEPT = 64
#: Fixed: an odd multiplier without a pattern, which spreads the phrases' crc32.
_SPREAD = np.uint32(0x9E3779B1)


class Phrases:
    """The dictionary of a text read so far, and the phrase that is still open."""

    def __init__(self, known: frozenset[bytes] | set[bytes] = frozenset(), begun: bytes = b""):
        self.known, self.begun = set(known), begun

    def copy(self) -> Phrases:
        return Phrases(self.known, self.begun)

    def read(self, data: bytes) -> Phrases:
        known, data, start = self.known, self.begun + data, 0
        for end in range(len(self.begun) + 1, len(data) + 1):
            phrase = data[start:end]
            if phrase not in known:
                known.add(phrase)
                start = end
        self.begun = data[start:]
        return self

    def fingerprint(self) -> bytes:
        """The smallest hashes in ascending order, four bytes each, the highest first."""
        hashes = np.fromiter(map(crc32, self.known), np.uint32, len(self.known))
        hashes = (hashes ^ hashes >> np.uint32(15)) * _SPREAD
        return np.unique(hashes ^ hashes >> np.uint32(13))[:KEPT].astype(">u4").tobytes()


def fingerprint(text: str | None) -> bytes:
    """The fingerprint of a text; that of an empty or null one has no bytes."""
    return Phrases().read((text or "").encode()).fingerprint()


def likeness(a: bytes, b: bytes) -> float:
    """How much of their phrases two texts share, from 0 to 1, by their fingerprints; two empty ones are alike."""
    one, other = ({f[i:i + 4] for i in range(0, len(f), 4)} for f in (a, b))
    least = sorted(one | other)[:KEPT]
    return sum(h in one and h in other for h in least) / len(least) if least else 1.0


def fingerprints(text: Column | str) -> Column:
    """The fingerprints of a text column, as lowercase hex."""

    @F.pandas_udf("string")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(lambda t: fingerprint(t).hex())

    return of(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def cut(text: str, part: int = 4) -> int:
    """How many code points at its end an edited text exchanges."""
    return len(text) // part


def edited(text: str, following: str, part: int = 4) -> str:
    """``text`` with its last ``part``-th exchanged for as much of the start of ``following``, or all of it."""
    n = cut(text, part)
    return text[:len(text) - n] + following[:n]


class _Read:
    """A text parsed up to its cut and to its end."""

    def __init__(self, doc_id, text: str):
        self.doc_id, self.text, self.n = doc_id, text, cut(text)
        kept = len(text) - self.n
        self.head = Phrases().read(text[:kept].encode())
        self.fingerprint = self.head.copy().read(text[kept:].encode()).fingerprint()

    def against(self, following: _Read) -> tuple:
        """The row of :func:`neighbours_compared`; to be asked once, as it parses on."""
        other = self.head.read(following.text[:self.n].encode()).fingerprint()
        digest = sha256(edited(self.text, following.text).encode()).hexdigest()
        return (
            self.doc_id, len(self.text), digest, self.fingerprint, other,
            likeness(self.fingerprint, other), likeness(self.fingerprint, following.fingerprint),
        )


def _batch(rows: list[tuple], layout: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(layout)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, layout)], schema=layout)


_RESULT = (
    ("n_chars", "long"), ("edited_sha256", "string"), ("fingerprint", "binary"), ("edited_fingerprint", "binary"),
    ("near_edited", "double"), ("near_next", "double"),
)


def neighbours_compared(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row of ``docs`` (doc_id, text).

    A row's next one is that of the next larger doc_id, the last's the first;
    rows that repeat a doc_id follow each other by a hash of their texts, those
    without one come first, and a lone row is its own next.  Null texts are
    empty.  Texts are sorted in ranges and move once; each task meets the rows
    of its range in order, and hands on the range's first and last row, for the
    pairs that ranges part.
    """
    spark = docs.sparkSession
    keys = ["doc_id", "tag", "place"]
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("tag", F.xxhash64("text")).withColumn("place", F.monotonically_increasing_id())
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")
    result = StructType(list(docs.select("doc_id").schema.fields))
    for name, kind in _RESULT:
        result = result.add(name, kind)
    streamed = StructType(list(result.fields)).add("part", "integer").add("is_first", "boolean").add("text", "string")
    own, whole = to_arrow_schema(result), to_arrow_schema(streamed)
    blank, inner = (None,) * 6, (None,) * 3

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last = TaskContext.get().partitionId(), None
        for batch in batches:
            out = []
            for doc_id, text in zip(*(batch.column(c) for c in ("doc_id", "text"))):
                now = _Read(doc_id.as_py(), text.as_py())
                out.append(last.against(now) + inner if last else (now.doc_id, *blank, part, True, now.text))
                last = now
            yield _batch(out, whole)
        if last:
            yield _batch([(last.doc_id, *blank, part, False, last.text)], whole)

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(*(batch.column(c) for c in ("doc_id", "text", "following")))
            yield _batch([_Read(d.as_py(), t.as_py()).against(_Read(None, f.as_py())) for d, t, f in pairs], own)

    found = written(ordered.mapInArrow(stream, streamed), "neighbours")
    ends = found.filter("part is not null")
    # as many numbers as ranges, no texts
    parts = sorted(r["part"] for r in ends.filter("is_first").select("part").collect())
    after = local_frame(spark, list(zip(parts, parts[1:] + parts[:1])), "part int, next int")
    firsts = ends.filter("is_first").select(F.col("part").alias("next"), F.col("text").alias("following"))
    parted = ends.filter("not is_first").select("doc_id", "text", "part").join(after, "part").join(firsts, "next")
    closed = parted.select("doc_id", "text", "following").mapInArrow(close, result)
    return found.filter("part is null").select(*result.names).unionByName(closed)
