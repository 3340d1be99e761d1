"""An inverted term index in blocks of documents, and exact BM25 search that skips blocks which cannot matter.

Documents are ordered by length and cut into small blocks.  A row of the
postings holds one term's documents of one block, and the highest share of a
score that any of them gets from the term.  Rows of a term stand together in one
bucket, those of a very frequent term in several, so that a search reads the
buckets and row groups of its own terms.

A search first adds up, for each query and block, the highest shares: a bound
for all scores of the block.  The best blocks by that bound are scored whole,
and their k-th best score is a floor: blocks and documents whose bound lies
below it cannot be among the best k.  Terms that alone cannot lift a document
to the floor come last, and only for documents that can still reach it.  Where
all postings of the queries' terms are few, they are scored in one pass instead.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import broadcast_if_small, is_small, local_frame, new_table, written
from .analyze import STANDARD, Analyzer, exploded
from .bm25 import DIGITS, K1, B, query_terms, top_k

#: Bits of the number of documents in a block.
BLOCK_BITS = 5
#: Postings of a term that stand in one bucket, about; those of a more frequent one are dealt to several.
HOT_POSTINGS = 1 << 20
#: Blocks of a query that are scored first, to find the floor, at least.
FIRST_BLOCKS = 16
#: Terms, and slots of them, that are named to the scan; of more, all buckets are read.
LISTED = 1000
#: Postings of all query terms from which on blocks are skipped; fewer are scored sooner than bounds are worked out.
SKIP_FROM = 50_000_000
#: Scores this far below the floor still count, as scores are rounded.
SLACK = 10.0 ** -DIGITS


@dataclass(frozen=True)
class InvertedIndex:
    """Postings (slot, scope…, term, block, n, share, ids, tfs, lengths), terms (scope…, term, df, share, spread), sizes (scope…, n, avgdl)."""

    postings: DataFrame
    terms: DataFrame
    sizes: DataFrame
    scope: tuple[str, ...] = ()


def _share(tf: Column, length: Column, avgdl: Column) -> Column:
    """What a term gives to a score, but for its weight."""
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / avgdl))


def _slot(term: Column, part: Column) -> Column:
    return F.xxhash64(term, part.cast("int"))


def _with_sizes(rows: DataFrame, sizes: DataFrame, scope: Sequence[str]) -> DataFrame:
    """``rows`` with n and avgdl of their scope."""
    if scope:
        return rows.join(broadcast_if_small(sizes), [*scope])
    return rows.withColumns({c: F.lit(v) for c, v in sizes.first().asDict().items()})


def _block_lists(held: DataFrame, scope: Sequence[str]) -> DataFrame:
    """(scope…, term, block, n, share, ids, tfs, lengths) of documents (scope…, id, length, block, postings, avgdl).

    The documents of a block stand together, so that its lists are made in the
    task that reads them and postings do not move one by one.  A block that two
    Arrow batches share has two lists of a term, whose bounds add up to one that
    still holds.
    """
    kinds = {f.name: f.dataType for f in held.schema}
    own = [T.StructField(c, kinds[c]) for c in scope]
    layout = T.StructType([
        *own, T.StructField("term", T.StringType()), T.StructField("block", T.LongType()), T.StructField("n", T.IntegerType()),
        T.StructField("share", T.DoubleType()), T.StructField("ids", T.ArrayType(kinds["id"])), T.StructField("tfs", T.ArrayType(T.IntegerType())),
        T.StructField("lengths", T.ArrayType(T.IntegerType())),
    ])

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = {c: batch.column(c) for c in batch.schema.names}
            pairs = column["postings"].flatten()
            if not len(pairs):
                continue
            row = np.repeat(np.arange(len(batch)), pc.fill_null(column["postings"].value_lengths(), 0).to_numpy(zero_copy_only=False))
            words = pairs.field("term").dictionary_encode()
            code, tf = words.indices.to_numpy(zero_copy_only=False), pairs.field("tf").to_numpy(zero_copy_only=False)
            # runs of documents of one block and scope
            new = np.ones(len(batch), dtype=bool)
            new[1:] = False
            for key in ["block", *scope]:
                marks = column[key].dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
                new[1:] |= marks[1:] != marks[:-1]
            run = np.cumsum(new)
            at = np.empty(len(batch), dtype=np.int64)
            at[pc.array_sort_indices(column["id"], null_placement="at_start").to_numpy()] = np.arange(len(batch))
            order = np.lexsort((at[row], run[row], code))
            row, code, tf = row[order], code[order], tf[order]
            starts = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (run[row][1:] != run[row][:-1])])
            length = column["length"].to_numpy(zero_copy_only=False)[row]
            share = _share(tf, length, column["avgdl"].to_numpy(zero_copy_only=False)[row])
            first, ends = pa.array(row[starts]), pa.array(np.r_[starts, len(row)].astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                *(column[c].take(first) for c in scope), words.dictionary.take(pa.array(code[starts])), column["block"].take(first),
                pa.array(np.diff(np.r_[starts, len(row)]).astype(np.int32)), pa.array(np.maximum.reduceat(share, starts)),
                pa.ListArray.from_arrays(ends, column["id"].take(pa.array(row))), pa.ListArray.from_arrays(ends, pa.array(tf.astype(np.int32))),
                pa.ListArray.from_arrays(ends, pa.array(length.astype(np.int32))),
            ], layout.names)

    return held.select(*scope, "id", "length", "block", "avgdl", "postings").mapInArrow(of_batches, layout)


def kept_inverted_index(index: DataFrame, scope: Sequence[str] = (), buckets: int | None = None) -> InvertedIndex:
    """The inverted form of a term index (scope…, id, length, postings) as tables in the shared folder.

    Documents are ordered by length in the tasks they are in, so that those of a
    block are alike; a term's postings of a block move once, as one row, to the term.  ``buckets`` sets how
    many files the tables have.
    """
    spark, name = index.sparkSession, f"inverted_{uuid.uuid4().hex}"
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [*scope, "length", "id"]
    ordered = index.select(*order, "postings").sortWithinPartitions(*order)
    held = written(ordered.withColumn("block", F.shiftright(F.monotonically_increasing_id(), BLOCK_BITS)), "blocked")
    sizes = written(held.filter("length > 0").groupBy(*scope).agg(F.count("*").alias("n"), F.avg("length").alias("avgdl")), "sizes")
    lists = _block_lists(_with_sizes(held, sizes, scope), scope)
    if (sizes.agg(F.sum("n")).first()[0] or 0) > HOT_POSTINGS:  # else no term can be in so many documents
        lists = written(lists, "block-lists")
        hot = lists.groupBy("term").agg(F.sum("n").alias("count")).filter(F.col("count") > HOT_POSTINGS)
        spread = broadcast_if_small(written(hot.select("term", F.ceil(F.col("count") / HOT_POSTINGS).cast("int").alias("spread")), "hot"))
    else:
        spread = local_frame(spark, [], "term string, spread int")
    slot = _slot(F.col("term"), F.pmod(F.xxhash64("block"), F.coalesce("spread", F.lit(1))))
    rows = lists.join(spread, "term", "left").select(slot.alias("slot"), *scope, "term", "block", "n", "share", "ids", "tfs", "lengths")
    rows = rows.repartition(buckets, "slot")
    postings = new_table(rows.write.bucketBy(buckets, "slot").sortBy("slot", "term", "block"), spark, f"{name}_postings")
    terms = postings.groupBy(*scope, "term").agg(F.sum("n").alias("df"), F.max("share").alias("share"))
    terms = terms.join(spread, "term", "left").withColumn("spread", F.coalesce("spread", F.lit(1)))
    kept = new_table(terms.repartition(buckets, "term").write.bucketBy(buckets, "term").sortBy("term"), spark, f"{name}_terms")
    return InvertedIndex(postings, kept, sizes, tuple(scope))


def _only(table: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """Rows of a table bucketed by ``column`` whose value is wanted, by name where there are few: other buckets are not read then."""
    found = [r[0] for r in wanted.select(column).distinct().limit(LISTED + 1).collect()]
    return table.filter(F.col(column).isin(found)) if len(found) <= LISTED else table


def _weights(index: InvertedIndex, wanted: DataFrame) -> DataFrame:
    """(scope…, query_id, term, slot, df, weight, avgdl, most) of the query terms that documents hold; ``most`` is the highest part of any score."""
    known = _only(index.terms, "term", wanted).join(wanted, [*index.scope, "term"])
    idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighed = _with_sizes(known, index.sizes, index.scope).withColumn("weight", idf * F.col("qtf"))
    part = F.explode(F.sequence(F.lit(0), F.col("spread") - 1))
    return weighed.select(
        *index.scope, "query_id", "term", "df", "weight", "avgdl", (F.col("weight") * F.col("share")).alias("most"), part.alias("_part")
    ).withColumn("slot", _slot(F.col("term"), F.col("_part"))).drop("_part")


class _Asked:
    """Queries met with an index: the weights of their terms, and the postings of these terms."""

    def __init__(self, index: InvertedIndex, wanted: DataFrame):
        self.index, self.weights = index, written(_weights(index, wanted), "weights")
        self.postings = _only(index.postings, "slot", self.weights)
        self.small = is_small(self.weights)

    def rows(self, weights: DataFrame, *columns: str) -> DataFrame:
        """Rows of the postings joined to the queries that ask for their term; ``weights`` are some of the own ones."""
        key = ["slot", *self.index.scope, "term"]
        own = weights.select(*key, "query_id", "weight", "avgdl")
        return self.postings.select(*key, "block", *columns).join(F.broadcast(own) if self.small else own, key)

    def lists(self, weights: DataFrame) -> DataFrame:
        """(query_id, term, block, weight, avgdl, docs), ``docs`` the id, tf and length of each posting."""
        rows = self.rows(weights, "ids", "tfs", "lengths")
        return rows.withColumn("docs", F.arrays_zip("ids", "tfs", "lengths")).drop("ids", "tfs", "lengths")

    def every(self) -> int:
        """Postings of all terms of all queries."""
        return self.weights.select("query_id", "term", "df").distinct().agg(F.sum("df")).first()[0] or 0


def _parts(lists: DataFrame) -> DataFrame:
    """(query_id, block, id, part): what each posting adds to a score."""
    single = lists.select("query_id", "block", "weight", "avgdl", F.explode("docs").alias("p"))
    return single.select(
        "query_id", "block", F.col("p.ids").alias("id"), (F.col("weight") * _share(F.col("p.tfs"), F.col("p.lengths"), F.col("avgdl"))).alias("part")
    )


def _all_scores(asked: _Asked) -> DataFrame:
    return _parts(asked.lists(asked.weights)).groupBy("query_id", "id").agg(F.round(F.sum("part"), DIGITS).alias("score"))


def bm25_scores(index: InvertedIndex, wanted: DataFrame) -> DataFrame:
    """(query_id, id, score) of every document that shares a term with a query of its scope; ``wanted`` as of :func:`bm25.query_terms`."""
    return _all_scores(_Asked(index, wanted))


def _staged(weights: DataFrame, floors: DataFrame) -> DataFrame:
    """``weights`` with ``first``: whether a term is scored for all open blocks.

    Terms of a query in falling order of the most they give: first while those
    from here on could lift a document to the floor by themselves.
    """
    own = weights.dropDuplicates(["query_id", "term"]).select("query_id", "term", "most")
    order = Window.partitionBy("query_id").orderBy(F.desc("most"), "term")
    left = F.sum("most").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    known = own.withColumn("left", left).join(broadcast_if_small(floors), "query_id")
    return weights.join(known.select("query_id", "term", (F.col("left") >= F.col("floor")).alias("first")), ["query_id", "term"])


def _floors(asked: _Asked, bound: DataFrame, wanted: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """(query_id, floor), just below the k-th best score in a query's best blocks by their bound, and the postings scored for it."""
    pair = ["query_id", "block"]
    blocks = max(FIRST_BLOCKS, -(-4 * k >> BLOCK_BITS))
    highest = Window.partitionBy("query_id").orderBy(F.desc("bound"), "block")
    first = written(bound.withColumn("at", F.row_number().over(highest)).filter(F.col("at") <= blocks).select(*pair), "first-blocks")
    leading = _parts(asked.lists(asked.weights).join(broadcast_if_small(first), pair))
    scores = leading.groupBy("query_id", "id").agg(F.sum("part").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"))
    kth = scores.withColumn("at", F.row_number().over(best)).filter(F.col("at") == k)
    floor = (F.coalesce("score", F.lit(0.0)) - SLACK).alias("floor")
    return written(wanted.select("query_id").distinct().join(kth, "query_id", "left").select("query_id", floor), "floors"), leading


def _best(asked: _Asked, wanted: DataFrame, k: int) -> tuple[DataFrame, list[DataFrame]]:
    """(query_id, id, score) that hold every query's best ``k``, and the frames of the postings that were scored."""
    pair = ["query_id", "block"]
    met = asked.rows(asked.weights, "share").select(*pair, "term", (F.col("weight") * F.col("share")).alias("most"))
    met = written(met, "bounds")
    floors, leading = _floors(asked, met.groupBy(*pair).agg(F.sum("most").alias("bound")), wanted, k)
    staged = written(_staged(asked.weights, floors), "staged")

    later = F.sum(F.when(~F.col("first"), F.col("most")).otherwise(0.0)).alias("later")
    bounds = met.join(staged.select("query_id", "term", "first").distinct(), ["query_id", "term"])
    bounds = bounds.groupBy(*pair).agg(F.sum("most").alias("bound"), later).join(broadcast_if_small(floors), "query_id")
    blocks = written(bounds.filter("bound >= floor").drop("bound"), "open-blocks")

    early = _parts(asked.lists(staged.filter("first")).join(blocks.select(*pair), pair, "left_semi"))
    begun = early.groupBy(*pair, "id").agg(F.sum("part").alias("part")).join(blocks, pair)
    begun = begun.filter(F.col("part") + F.col("later") >= F.col("floor"))
    documents = written(begun.groupBy(*pair).agg(F.collect_list(F.struct("id", "part")).alias("begun")), "open-documents")

    lists = asked.lists(staged.filter("not first")).join(documents, pair)
    late = _parts(lists.withColumn("docs", F.expr("filter(docs, p -> array_contains(begun.id, p.ids))")))
    own = documents.select(*pair, F.inline("begun"))
    scores = own.unionByName(late).groupBy("query_id", "id").agg(F.round(F.sum("part"), DIGITS).alias("score"))
    return scores, [leading, early, late]


def bm25_topk(index: InvertedIndex, queries: DataFrame, k: int, analyzer: Analyzer = STANDARD, skip_from: int = SKIP_FROM) -> DataFrame:
    """(query_id, id, score, rank): the best ``k`` documents of each query (scope…, query_id, query), exactly; ties by id."""
    wanted = written(query_terms(queries, analyzer, index.scope), "wanted")
    asked = _Asked(index, wanted)
    return top_k(_all_scores(asked) if asked.every() < skip_from else _best(asked, wanted, k)[0], k)


def scored_postings(index: InvertedIndex, queries: DataFrame, k: int, analyzer: Analyzer = STANDARD) -> tuple[int, int]:
    """(postings scored, postings of all query terms) of a search that skips blocks, to see what that saves."""
    wanted = written(query_terms(queries, analyzer, index.scope), "wanted")
    asked = _Asked(index, wanted)
    return sum(frame.count() for frame in _best(asked, wanted, k)[1]), asked.every()
