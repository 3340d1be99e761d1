"""Term index and BM25 ranking of many queries at once."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import ANALYZER_OF
from ..session import broadcast_if_small, is_small, new_table
from .analyze import ANALYZERS, STANDARD, Analyzer, analyzed, counted, exploded

# Term saturation and length weight, and digits scores are kept to.
K1, B = 1.2, 0.75
DIGITS = 6


def term_index(
    docs: DataFrame, text: Column | str, analyzer: Analyzer = STANDARD, id_col: str = "id", scope: Sequence[str] = ()
) -> DataFrame:
    """(scope…, id, length, postings) of every document; write it to reuse it.

    ``scope`` names columns, such as ``client_id``, that set documents apart:
    statistics are kept and queries answered within a scope.
    """
    text = F.col(text) if isinstance(text, str) else text
    rows = docs.select(*scope, F.col(id_col).alias("id"), text.alias("_text"))
    return counted(analyzed(rows, "_text", analyzer).drop("_text"))


def kept_index(index: DataFrame, buckets: int | None = None) -> DataFrame:
    """An index as a table in the shared folder, bucketed by document.

    A document's postings stay in one task through a search, so its scores are
    summed and cut to the best k there, before any row moves.  ``buckets`` sets
    how many tasks read it; as many as shuffles have unless given.
    """
    spark, name = index.sparkSession, f"terms_{uuid.uuid4().hex}"
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return new_table(index.repartition(buckets, "id").write.bucketBy(buckets, "id"), spark, name)


def field_index(docs: DataFrame, field: str, scope: Sequence[str] = ()) -> DataFrame:
    """The term index of a document text field, under that field's own analyzer."""
    return term_index(docs, field, ANALYZERS[ANALYZER_OF[field]], scope=scope)


def term_stats(index: DataFrame) -> DataFrame:
    """(term, df, tf): documents holding a term and its occurrences."""
    return exploded(index).groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("tf"))


def query_terms(queries: DataFrame, analyzer: Analyzer = STANDARD, scope: Sequence[str] = ()) -> DataFrame:
    """(scope…, query_id, term, qtf) of queries (scope…, query_id, query)."""
    rows = analyzed(queries.select(*scope, "query_id", "query"), "query", analyzer).drop("query", "length")
    return exploded(counted(rows)).withColumnRenamed("tf", "qtf")


def bm25_scores(index: DataFrame, wanted: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """(query_id, id, score) of every document sharing a term with a query of its scope.

    ``index`` is read three times and should be a written table, best one of
    :func:`kept_index`.  While the query terms are few, they go to the
    documents, and of such an index no scored pair moves; else term and postings
    are joined by a shuffle that splits hot terms.
    """
    key = [*scope, "term"]
    hint = F.broadcast if is_small(wanted) else (lambda side: side)
    held = exploded(index).join(hint(wanted.select(*key).distinct()), key, "left_semi")
    df = held.groupBy(*key).agg(F.count("*").alias("df"))
    size = index.filter("length > 0").groupBy(*scope).agg(F.count("*").alias("n"), F.avg("length").alias("avgdl"))
    df = df.join(broadcast_if_small(size), [*scope]) if scope else df.withColumns(
        {c: F.lit(v) for c, v in size.first().asDict().items()}
    )
    idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weights = wanted.join(df, key).select(*key, "query_id", (idf * F.col("qtf")).alias("weight"), "avgdl")
    norm = K1 * (1 - B + B * F.col("length") / F.col("avgdl"))
    part = F.col("weight") * F.col("tf") * (K1 + 1) / (F.col("tf") + norm)
    pairs = exploded(index).join(hint(weights), key)
    return pairs.groupBy("query_id", "id").agg(F.round(F.sum(part), DIGITS).alias("score"))


def top_k(scores: DataFrame, k: int) -> DataFrame:
    """Best k per query with their rank; ties by id.  Each task keeps k before rows move."""
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("id"))
    return scores.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def bm25_topk(
    index: DataFrame, queries: DataFrame, k: int, analyzer: Analyzer = STANDARD, scope: Sequence[str] = ()
) -> DataFrame:
    return top_k(bm25_scores(index, query_terms(queries, analyzer, scope), scope), k)
