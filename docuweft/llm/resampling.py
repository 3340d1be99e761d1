"""Importance resampling towards a target: documents whose hashed n-grams are those of target texts are drawn more often.

Features are runs of one to ORDER words, each in a bucket by its crc32.  A
bucket's gain is the log of how much more of the target's features it holds
than of the corpus's; a document's weight is the mean gain of its features.
Weights plus Gumbel noise, which hangs on the document's id only, are ordered,
and the highest are drawn: a sample without replacement in which a document's
chance grows with the exponent of its weight.

Texts of a batch are joined with a sentinel no word holds; one pass of the
pattern finds all words, and the documents' offsets tell which runs reach over
a document's end.  Both passes over the corpus end in one row a document or a
bucket, so that texts never move; the order is made by ranges, not in one task.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .common import numbered

#: Longest run of words that is a feature, and the buckets of features.
ORDER = 2
BUCKETS = 10_000
#: Percent of the documents with so many words that are drawn, and the seed of the noise.
PERCENT = 25
LEAST_WORDS = 20
SEED = 7
#: Gains are thousandths.
SCALE = 1000
#: Fixed: what a word is made of, in bytes of UTF-8 whose A-Z are lower-cased; what parts words; and a byte that does.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BETWEEN = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
SENTINEL = b"\n"
_IN_WORD = np.array([WORD.match(bytes([c])) is not None for c in range(256)])
#: Texts joined at once, and bytes of them, about, whose words are looked at together.
TEXTS_AT_ONCE = 256
BYTES_AT_ONCE = 1 << 20


def _words(joined: bytes) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """All words and where they start, in blocks that end between words."""
    start = 0
    while start < len(joined):
        end = BETWEEN.search(joined, min(start + BYTES_AT_ONCE, len(joined)))
        block = joined[start:end.start() if end else len(joined)]
        inside = _IN_WORD[np.frombuffer(block, np.uint8)]
        opens = inside.copy()
        opens[1:] &= ~inside[:-1]
        yield WORD.findall(block), start + np.flatnonzero(opens)
        start += len(block) + (end is not None)


def feature_buckets(texts: Iterable[str | None], order: int = ORDER, buckets: int = BUCKETS) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length of the run, number of the text, bucket) of all features, in blocks; a null text has none."""
    data = [(t or "").encode().lower() for t in texts]
    begins = np.cumsum([0, *(len(d) + len(SENTINEL) for d in data)])[:-1]
    words: list[bytes] = []
    owner = np.empty(0, np.int64)
    for block, at in _words(SENTINEL.join(data)):
        # the last words of the blocks before are the heads of runs that end in this one
        old = min(len(words), order - 1)
        words, owner = words[len(words) - old:] + block, owner[len(owner) - old:]
        owner = np.concatenate([owner, np.searchsorted(begins, at, side="right") - 1])
        spaced = [b" " + w for w in words]
        hashes: Iterable[int] = map(crc32, words)
        for more in range(min(order, len(words))):
            if more:
                hashes = map(crc32, spaced[more:], hashes)
            hashes = np.fromiter(hashes, np.uint32, len(words) - more)
            fits = owner[more:] == owner[:len(owner) - more]  # no run reaches over a document's end
            fits[:max(0, old - more)] = False
            yield more + 1, owner[more:][fits], hashes[fits] % buckets
            hashes = hashes.tolist()


def bucket_counts(docs: DataFrame, order: int = ORDER, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts each bucket holds; every task passes on one row a bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, TEXTS_AT_ONCE):
                for _, _, bucket in feature_buckets(batch.column("text").slice(start, TEXTS_AT_ONCE).to_pylist(), order, buckets):
                    total += np.bincount(bucket, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    counts = np.zeros(buckets, np.int64)
    for row in docs.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[row["bucket"]] = row["n"]
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))) of each of the B buckets."""
    of_corpus, of_target = float(corpus.sum() + len(corpus)), float(target.sum() + len(target))
    return np.array([
        math.floor(SCALE * math.log((t + 1.0) * of_corpus / ((s + 1.0) * of_target))) for s, t in zip(corpus.tolist(), target.tolist())
    ], dtype=np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, order: int = ORDER) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row: the floored mean gain of its features, 0 without any."""
    layout = docs.selectExpr("doc_id", "0L as n_words", "0L as n_features", "0L as weight").schema

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, features, sums = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for start in range(0, batch.num_rows, TEXTS_AT_ONCE):
                texts = batch.column("text").slice(start, TEXTS_AT_ONCE).to_pylist()
                for length, owner, bucket in feature_buckets(texts, order, len(gain)):
                    some = slice(start, start + len(texts))
                    n = np.bincount(owner, minlength=len(texts))
                    features[some] += n
                    if length == 1:
                        words[some] += n
                    # whole numbers far below 2 ** 53: exact as doubles
                    sums[some] += np.bincount(owner, weights=gain[bucket], minlength=len(texts)).astype(np.int64)
            weight = np.floor_divide(sums, np.maximum(features, 1))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, (words, features, weight))], names=layout.fieldNames())

    return docs.select("doc_id", "text").mapInArrow(weigh, layout)


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, order: int = ORDER, buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank), all long but doc_id, of every row of ``docs`` (doc_id, text).

    ``target`` has a column ``text``.  Of the documents with ``least_words``
    words or more ``percent`` in a hundred, rounded down, are drawn: those of
    the highest scores, ties to the smaller doc_id, and ``rank`` is their place
    from 1; others have none.  Null texts are empty.  Rows that repeat a doc_id
    are scored and drawn one by one; those without one have no score, are never
    drawn and do not count among the documents drawn from.
    """
    gain = gains(bucket_counts(docs, order, buckets), bucket_counts(target, order, buckets))
    key = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-SCALE * F.log(-F.log((key + 0.5) / 4294967296.0)))
    scored = written(weighed(docs, gain, order).withColumn("score", F.col("weight") + noise), "weights")
    joins_in = (F.col("n_words") >= least_words) & F.col("doc_id").isNotNull()
    eligible = scored.filter(joins_in)
    drawn = percent * eligible.count() // 100
    ranked = numbered(eligible, F.desc("score"), F.asc("doc_id"), F.asc("n_features"))
    rank = F.when(F.col("number") <= drawn, F.col("number"))
    left = scored.filter(~joins_in).withColumn("rank", F.lit(None).cast("long"))
    return ranked.withColumn("rank", rank).drop("number").unionByName(left)
