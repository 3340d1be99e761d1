"""Near-duplicate texts by SimHash: 64-bit fingerprints that differ in few bits are linked.

Fingerprints meet through an inverted index over their bytes and byte positions.
If two differ in at most ``d`` bits they differ in at most ``d`` of the eight
bytes, so they share at least ``8 - d`` positional bytes, and some choice of
``8 - d`` positions on which they agree wholly.  Postings are therefore
kept under every such choice: to stand in one posting list is to have reached the
guaranteed number of shared positional bytes, and no pair below it is ever made.
The rest of a posting is ``d`` bytes, so a list holds 65,536 different fingerprints
at most for ``d = 2`` however many documents there are.  The members of a list
are verified against each other and passed on as chains, not as all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small, written
from .components import components

BYTES = 8
#: Fixed: seed of the shingle hash.
SEED = 42
#: Hashes whose bits are counted at once.
HASHES_AT_ONCE = 1 << 14
#: Members up to which a list is verified by its matrix of differences.
SMALL_LIST = 256


def fingerprint(text: str | None, width: int = 3) -> int:
    """Signed 64-bit fingerprint: a bit is 1 if more than half of the shingles' hashes have it.

    Words are split at ASCII white space, A-Z lower-cased; shingles are ``width``
    words joined by a space, the whole text if it has fewer.  No words: zero.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < width:
        hashes = np.array([digest(b" ".join(words), SEED)], dtype=np.uint64)
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width))))
        hashes = np.fromiter((digest(s, SEED) for s in shingles), np.uint64, len(words) - width + 1)
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), HASHES_AT_ONCE):
        bits = np.unpackbits(hashes[start:start + HASHES_AT_ONCE].astype(">u8").view(np.uint8).reshape(-1, BYTES), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, fingerprint long) of every row; a null text counts as empty."""
    layout = docs.select("doc_id").withColumn("fingerprint", F.lit(0).cast("long")).schema

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [fingerprint(t.as_py(), width) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(marks, pa.int64())], ["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(of_batches, layout)


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def postings(marks: DataFrame, max_bits: int) -> DataFrame:
    """(choice, shared, fingerprint): a row for every choice of positions; ``shared`` has the other bytes blanked."""
    shared = []
    for choice, blanked in enumerate(combinations(range(BYTES), max_bits)):
        mask = (1 << 64) - 1
        for at in blanked:
            mask ^= 0xFF << (8 * at)
        shared.append(F.struct(F.lit(choice).alias("choice"), F.col("fingerprint").bitwiseAND(F.lit(_signed(mask))).alias("shared")))
    return marks.select("fingerprint", F.explode(F.array(*shared)).alias("p")).select("p.choice", "p.shared", "fingerprint")


def _masks(free: int, max_bits: int) -> np.ndarray:
    bits = [np.uint64(1 << i) for i in range(64) if free >> i & 1]
    return np.array([sum(c, np.uint64(0)) for n in range(1, max_bits + 1) for c in combinations(bits, n)], dtype=np.uint64)


def verified_pairs(values: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of different values that differ in at most ``max_bits`` bits, given that they differ in few places."""
    if len(values) <= SMALL_LIST:
        near = np.bitwise_count(values[:, None] ^ values[None, :]) <= max_bits
        return np.nonzero(np.triu(near, 1))
    free = int(np.bitwise_or.reduce(values ^ values[0]))
    left, right = [], []
    for mask in _masks(free, max_bits):
        at = np.searchsorted(values, values ^ mask).clip(max=len(values) - 1)
        hit = np.flatnonzero((values[at] == values ^ mask) & (values < values ^ mask))
        left.append(hit)
        right.append(at[hit])
    return np.concatenate(left), np.concatenate(right)


def _chains(values: np.ndarray, max_bits: int) -> Iterator[tuple[int, int]]:
    """Links that join the values of a list as all its verified pairs would: one fewer than the members of each part."""
    values = np.unique(values)
    part = np.arange(len(values))
    left, right = verified_pairs(values, max_bits)
    while len(left):
        least = np.minimum(part[left], part[right])
        before = part.copy()
        np.minimum.at(part, left, least)
        np.minimum.at(part, right, least)
        part = part[part]
        if np.array_equal(before, part):
            break
    order = np.lexsort((values, part))
    same = part[order][1:] == part[order][:-1]
    yield from zip(values[order][:-1][same].view(np.int64).tolist(), values[order][1:][same].view(np.int64).tolist())


def links(marks: DataFrame, max_bits: int = 2) -> DataFrame:
    """(a, b) between different fingerprints: parts of the graph of all pairs within ``max_bits`` bits stay whole."""
    if not 1 <= max_bits <= 2:
        raise ValueError("max_bits is 1 or 2: beyond, posting lists are not bounded usefully")
    # dealt anew: so few bytes would be put in few tasks, and each becomes one row for every choice there
    each = marks.select("fingerprint").distinct().repartition(marks.sparkSession.sparkContext.defaultParallelism)
    lists = postings(each, max_bits).groupBy("choice", "shared").agg(
        F.collect_list("fingerprint").alias("members")
    ).filter(F.size("members") > 1).select("members")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("members")
            values, ends = column.flatten().to_numpy(zero_copy_only=False).view(np.uint64), np.cumsum(column.value_lengths().to_numpy())
            found = [pair for start, end in zip([0, *ends[:-1]], ends) for pair in _chains(values[start:end], max_bits)]
            a, b = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return lists.mapInArrow(joined, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, width: int = 3, max_bits: int = 2) -> DataFrame:
    """(doc_id, fingerprint long, component_id) of every row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest doc_id reachable over links, the row's own
    included; null ids are passed over, and it is null where a part has no other.
    """
    marks = written(fingerprints(docs, width), "fingerprints")
    least = marks.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    parts = components(links(marks, max_bits))
    linked = parts.join(least, parts["node"] == least["fingerprint"]).select("root", "fingerprint", "least")
    smallest = linked.groupBy("root").agg(F.min("least").alias("component"))
    moved = linked.join(smallest, "root").select("fingerprint", "component")
    whole = least.join(moved, "fingerprint", "left").select("fingerprint", F.coalesce("component", "least").alias("component_id"))
    whole = written(whole, "fingerprint-parts")  # so that the join below shuffles both sides and can split a hot fingerprint
    return marks.join(broadcast_if_small(whole), "fingerprint").select("doc_id", "fingerprint", "component_id")
