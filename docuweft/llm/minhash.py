"""Near copies by the shingles they share: SimHash and MinHash lists propose pairs, the shingle sets themselves confirm them.

A text is the set of its shingles' hashes, two are near copies if their sets'
Jaccard similarity reaches a bound.  Each set has BANDS keys of ROWS minima;
sets that share a key stand in one list.  At a similarity of 0.8 a pair shares
none with a chance of 6 in 100,000, and every pair that a list proposes is held
against the whole sets, so nothing below the bound is linked.

Before that SimHash fingerprints of the same shingles are linked, within two bits:
what these links join after the sets have confirmed them is of one part when the
lists are met.  They reach the nearest copies, the lists those further apart.

Within a list pairs are not made all at once: some members, the leaders, are
held against all others and then leave it, and a list is done once its members
are known to be of one part.  A large group of near copies is so linked by
little more than one comparison a member.  Before whole sets are fetched, the
join compares sketches, four bits of each minimum: texts that are loosely alike,
far below the bound, share lists in great numbers but not sketches.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from . import simhash
from .components import components

#: Keys of a set, and minima that make up one.
BANDS, ROWS = 32, 6
#: Bits of a minimum in a sketch, and the first of them; the lowest do not depend on the multiplier.
PLANES, SKETCH_BIT = 4, 20
#: Longs that hold one such bit of all minima.
LONGS = BANDS * ROWS // 64
#: Standard deviations by which sketches may differ more than at the bound: a pair right there is passed over with a chance of 5 in 1,000,000.
SLACK = 4.5
#: Fixed: seed of the shingle hash and of the multipliers.
SEED = 42
#: Hashes whose products are held at once.
HASHES_AT_ONCE = 1 << 10
#: The first round has one leader a list, each later one so many times those of the round before.
MORE_LEADERS = 16

_MULTIPLIERS = np.random.default_rng(SEED).integers(0, 1 << 64, (BANDS * ROWS, 1), dtype=np.uint64) | np.uint64(1)


def shingle_set(text: str | None, width: int = 5) -> np.ndarray:
    """The different hashes of a text's shingles, ascending; words and shingles as in :func:`simhash.fingerprint`."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    if len(words) < width:
        return np.array([digest(b" ".join(words), SEED)], dtype=np.uint64)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(width))))
    return np.unique(np.fromiter((digest(s, SEED) for s in shingles), np.uint64, len(words) - width + 1))


def minima(shingles: np.ndarray) -> np.ndarray:
    """The smallest hash of a set under each multiplier."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), HASHES_AT_ONCE):
        np.minimum(least, (shingles[start:start + HASHES_AT_ONCE] * _MULTIPLIERS).min(axis=1), out=least)
    return least


def list_keys(shingles: np.ndarray, least: np.ndarray) -> list[int]:
    """The signed keys of the lists a set with such minima stands in; of an empty one, none."""
    if not len(shingles):
        return []
    keys = [xxhash.xxh64_intdigest(band.tobytes(), seed) for seed, band in enumerate(least.reshape(BANDS, ROWS))]
    return np.array(keys, np.uint64).view(np.int64).tolist()


def sketch(least: np.ndarray) -> list[int]:
    """Some bits of each minimum, as PLANES planes of LONGS signed longs."""
    bits = [(least >> np.uint64(SKETCH_BIT + plane)) & np.uint64(1) for plane in range(PLANES)]
    return np.packbits(np.concatenate(bits).astype(np.uint8)).view(np.int64).tolist()


def sketches_differ(a: str, b: str) -> Column:
    """The number of minima whose bits differ between two columns of sketches."""
    planes = [[F.col(a)[p * LONGS + n].bitwiseXOR(F.col(b)[p * LONGS + n]) for p in range(PLANES)] for n in range(LONGS)]
    return reduce(Column.__add__, [F.bit_count(reduce(Column.bitwiseOR, own)) for own in planes])


def most_differing(least: float) -> int:
    """How many minima may differ in sketches of sets whose similarity is ``least``; some unequal minima have equal bits."""
    share, count = (1.0 - 2.0 ** -PLANES) * (1.0 - least), BANDS * ROWS
    return min(count, int(np.ceil(count * share + SLACK * np.sqrt(count * share * (1.0 - share)))))


def _node(shingles: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(shingles.tobytes(), SEED)).view(np.int64))


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, tag, node long, mark long, size int, lists, sketch) of every row of ``docs`` (doc_id, tag, text); equal sets, those without words too, have one ``node``; ``mark`` is the SimHash fingerprint."""
    longs = F.array(F.lit(0).cast("long"))
    layout = docs.select("doc_id", "tag", F.lit(0).cast("long").alias("node"), F.lit(0).cast("long").alias("mark"), F.lit(0).alias("size"), longs.alias("lists"), longs.alias("sketch")).schema

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, marks, sizes, lists, sketches = [], [], [], [], []
            for t in batch.column("text"):
                own = shingle_set(t.as_py(), width)
                nodes.append(_node(own))
                marks.append(simhash.fingerprint(t.as_py(), width))
                sizes.append(len(own))
                least = minima(own)
                lists.append(list_keys(own, least))
                sketches.append(sketch(least))
            longs = pa.list_(pa.int64())
            columns = [pa.array(nodes, pa.int64()), pa.array(marks, pa.int64()), pa.array(sizes, pa.int32()), pa.array(lists, longs), pa.array(sketches, longs)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tag"), *columns], layout.names)

    return docs.select("doc_id", "tag", "text").mapInArrow(of_batches, layout)


def sets(docs: DataFrame, width: int) -> DataFrame:
    """(node, shingles array of long) of every row."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in batch.column("text"):
                own = shingle_set(t.as_py(), width)
                yield pa.RecordBatch.from_arrays([pa.array([_node(own)], pa.int64()), pa.array([own.view(np.int64)], pa.list_(pa.int64()))], ["node", "shingles"])

    return docs.select("text").mapInArrow(of_batches, "node long, shingles array<long>")


def confirmed(pairs: DataFrame, known: DataFrame, least: float) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sets in ``known`` (node, shingles) have a similarity of ``least`` or more."""
    own = known.select(F.col("node").alias("a"), F.col("shingles").alias("_a"))
    other = known.select(F.col("node").alias("b"), F.col("shingles").alias("_b"))
    both = pairs.join(own, "a").join(other, "b").withColumn("_shared", F.size(F.array_intersect("_a", "_b")))
    return both.filter(F.col("_shared") / (F.size("_a") + F.size("_b") - F.col("_shared")) >= least).select("a", "b")


def simhash_pairs(marks: DataFrame) -> DataFrame:
    """(a, b) of different nodes of ``marks`` (node, mark) whose fingerprints SimHash links or that are equal.

    One node stands for its fingerprint, so that very many equal ones make no
    more pairs than nodes.
    """
    # a set that comes from several texts, whose repeats differ, has one fingerprint here
    own = marks.filter("size > 0").groupBy("node").agg(F.min("mark").alias("fingerprint"))
    first = written(own.groupBy("fingerprint").agg(F.min("node").alias("first")), "first-nodes")
    near = simhash.links(first)
    to_a, to_b = (first.select(F.col("fingerprint").alias(c), F.col("first").alias(f"_{c}")) for c in ("a", "b"))
    pairs = near.join(to_a, "a").join(to_b, "b").select("_a", "_b").unionByName(
        own.join(first, "fingerprint").select(F.col("node").alias("_a"), F.col("first").alias("_b"))
    )
    return pairs.filter("_a <> _b").select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct()


def _sets_of(docs: DataFrame, smallest: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """(node, shingles) of some ``nodes``, and perhaps others, once each."""
    ids = smallest.join(nodes, "node", "left_semi").select(F.col("least").alias("_id"))
    chosen = sets(docs.join(ids, docs["doc_id"] == ids["_id"], "left_semi"), width)
    return written(chosen.dropDuplicates(["node"]), "sets")


def tag_of(text: Column) -> Column:
    """Tells apart rows that share a doc_id but not the text; a null text counts as an empty one."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def near_copies(docs: DataFrame, width: int = 5, least: float = 0.8) -> DataFrame:
    """(doc_id, tag, node, part, component_id) of every row of ``docs`` (doc_id, text) that has a doc_id.

    ``part`` is common to rows that are reachable from each other over near
    copies, and to no others; ``component_id`` is their smallest doc_id.  Rows
    that repeat a doc_id stand each for its text, which ``tag`` names, and may
    be in different parts.  Each round writes what it leaves; rounds end when the
    members of every list are of one part, or have all been leaders but one.
    """
    docs = docs.filter("doc_id is not null").select("doc_id", tag_of(F.col("text")).alias("tag"), "text")
    marks = written(signatures(docs, width), "signatures")
    smallest = marks.groupBy("node").agg(F.min("doc_id").alias("least"))
    members = written(marks.dropDuplicates(["node"]).select(F.explode("lists").alias("list"), "node", "size"), "lists")
    links = tested = known = parts = None
    pairs = written(simhash_pairs(marks), "simhash-pairs")
    if not pairs.isEmpty():
        ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        tested, links = pairs, written(confirmed(pairs, _sets_of(docs, smallest, ends, width), least), "near")
        parts = written(components(links), "parts")
    at_once = 1
    while True:
        root = F.col("node") if parts is None else F.coalesce("root", "node")
        rooted = (members if parts is None else members.join(parts, "node", "left")).select(*members.columns, root.alias("root"))
        counts = rooted.groupBy("list", "root").count().groupBy("list").agg(F.max(F.struct("count", "root"))["root"].alias("largest"), F.count("*").alias("parts"))
        unsettled = written(counts.filter("parts > 1").select("list", "largest"), "unsettled")
        if unsettled.isEmpty():
            break
        rooted = rooted.join(unsettled, "list")
        if known is None:  # sketches are carried only by members of lists that have pairs, and by those from here on
            rooted = rooted.join(marks.select("node", "sketch").dropDuplicates(["node"]), "node")
        rooted = written(rooted, "members")
        if known is None:
            known = _sets_of(docs, smallest, rooted.select("node").distinct(), width)
        # leaders are not of the largest part: once all others have left, the list is settled
        order = F.xxhash64("node")
        slot = F.pmod(order, F.lit(at_once)).alias("slot")
        first = rooted.filter("root <> largest").groupBy("list", slot).agg(F.min(F.struct(order.alias("order"), "node", "size", "sketch", "root")).alias("led"))
        leaders = written(first.select("list", *[F.col("led")[c].alias(f"_{c}") for c in ("node", "size", "sketch", "root")]), "leaders")
        bounded = F.least("size", "_size") >= F.lit(least) * F.greatest("size", "_size") - 0.5  # exact sets decide
        alike = sketches_differ("sketch", "_sketch") <= most_differing(least)
        met = rooted.join(leaders, "list").filter((F.col("root") != F.col("_root")) & bounded & alike)
        pairs = met.select(F.least("node", "_node").alias("a"), F.greatest("node", "_node").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        tested = pairs if tested is None else tested.unionByName(pairs)
        found = written(confirmed(pairs, known, least), "near")
        links = found if links is None else links.unionByName(found)
        if parts is None or not found.isEmpty():
            parts = written(components(links), "parts")
        at_once *= MORE_LEADERS
        led = leaders.select("list", F.col("_node").alias("node"))
        members = written(rooted.select("list", "node", "size", "sketch").join(led, ["list", "node"], "left_anti"), "lists")
    whole = smallest.withColumn("root", F.col("node")) if parts is None else smallest.join(parts, "node", "left").withColumn("root", F.coalesce("root", "node"))
    component = whole.groupBy("root").agg(F.min("least").alias("component_id"))
    whole = written(whole.select("node", "root").join(written(component, "components"), "root").select("node", F.col("root").alias("part"), "component_id"), "near-parts")
    return marks.select("doc_id", "tag", "node").join(whole, "node").select("doc_id", "tag", "node", "part", "component_id")
