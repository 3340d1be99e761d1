"""Nearest documents by cosine, exactly, for a batch of query vectors.

Small searches compare every vector with every query.  In larger ones vectors
are dealt into cells around centres, and each cell's radius is the widest angle
of a member to the centre.  A query searches its nearest cells first; the k-th
best it finds there is a floor, and by the triangle inequality of angles no
member of a cell can be nearer to a query than their centres' angle less the
radius: cells that so lie below the floor are not compared at all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import broadcast_if_small, written
from .bm25 import DIGITS, top_k

#: Documents, and queries, that meet in one task at a time.
DOCUMENT_BLOCK, QUERY_BLOCK = 8192, 1024
#: Pairs of documents and queries from which on cells are made.
CELLS_FROM = 2_000_000_000
#: Cells of a tenant and length at most, vectors for each that centres are fitted on, and rounds of that.
MOST_CELLS, SAMPLED, ROUNDS = 1024, 16, 4
#: Cells a query searches to find its floor.
FIRST_CELLS = 3
#: Scores this far below the floor still count, as scores are rounded; and what an angle may be wrong by.
SLACK, ANGLE_SLACK = 10.0 ** -DIGITS, 1e-6


def usable(vector: Column) -> Column:
    """Whether a vector has a direction: not null or empty, all numbers finite, not all of them zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def unusable_queries(queries: DataFrame) -> DataFrame:
    """Query ids that cannot be answered, for their senders to see."""
    return queries.filter(~usable(F.col("vector"))).select("query_id")


_KIND = ("scope", "length")


def _sides(vectors: DataFrame, queries: DataFrame, scope: str | None) -> tuple[DataFrame, DataFrame]:
    """Documents and queries that have a direction, with their scope and length."""
    group = F.col(scope) if scope else F.lit(0)
    docs = vectors.filter(usable(F.col("embedding"))).select(group.alias("scope"), F.size("embedding").alias("length"), "id", "embedding")
    return docs, queries.filter(usable(F.col("vector"))).select(group.alias("scope"), F.size("vector").alias("length"), "query_id", "vector")


def knn_topk(vectors: DataFrame, queries: DataFrame, k: int, scope: str | None = None, cells_from: int = CELLS_FROM) -> DataFrame:
    """(query_id, id, score, rank): the k best documents (id, embedding) of each query (query_id, vector).

    The score is ``1 / (2 - cosine)``.  Queries meet documents whose vector has
    their length, so that tenants of different models can ask together; vectors
    without a direction match nothing.  ``scope`` names a column of both sides,
    such as ``client_id``: queries meet only documents of their own.  Where
    pairs are ``cells_from`` or more, cells are made, and both tables read
    several times.
    """
    docs, asked = _sides(vectors, queries, scope)
    counts = docs.groupBy(*_KIND).agg(F.count("*").alias("n")).join(asked.groupBy(*_KIND).agg(F.count("*").alias("m")), [*_KIND])
    pairs = counts.agg(F.sum(F.col("n").cast("double") * F.col("m"))).first()[0] or 0
    if pairs < cells_from:
        return top_k(_compared(docs, asked, list(_KIND), k), k)
    first, near, rest, cells = _searched(docs, asked, k)
    return top_k(near.drop("rank").unionByName(_compared(cells, rest, [*_KIND, "cell"], k)), k)


def compared_pairs(vectors: DataFrame, queries: DataFrame, k: int, scope: str | None = None) -> tuple[int, int]:
    """(pairs compared, all pairs) of a search by cells, to see what skipping saves."""
    docs, asked = _sides(vectors, queries, scope)
    first, _, rest, cells = _searched(docs, asked, k)
    sizes = cells.groupBy(*_KIND, "cell").agg(F.count("*").alias("n"))
    met = first.drop("vector").unionByName(rest.drop("vector")).join(sizes, [*_KIND, "cell"]).agg(F.sum("n")).first()[0]
    every = docs.groupBy(*_KIND).count().withColumnRenamed("count", "n").join(asked, [*_KIND]).agg(F.sum("n")).first()[0]
    return met or 0, every or 0


def _searched(docs: DataFrame, asked: DataFrame, k: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """What queries search first, what they find there, the cells left to them, and the documents by cell."""
    cell = [*_KIND, "cell"]
    docs = docs.withColumn("pick", F.xxhash64("id"))
    counts = docs.groupBy(*_KIND).agg(F.least(F.ceil(F.sqrt(F.count("*"))), F.lit(MOST_CELLS)).alias("wanted"))
    by_pick = Window.partitionBy(*_KIND).orderBy("pick", "id")
    # no more vectors of a tenant and length than the bound leave a task
    sample = docs.withColumn("at", F.row_number().over(by_pick)).filter(F.col("at") <= MOST_CELLS * SAMPLED)
    sample = sample.join(broadcast_if_small(counts), [*_KIND]).filter(F.col("at") <= F.col("wanted") * SAMPLED)
    scope = docs.schema["scope"]
    layout = T.StructType([scope, T.StructField("length", T.IntegerType()), T.StructField("cell", T.IntegerType()), T.StructField("centre", T.ArrayType(T.DoubleType()))])
    fitted = sample.select(*_KIND, "pick", "wanted", "embedding").groupBy(*_KIND).applyInPandas(_fit_centres(layout), layout)
    centres = written(fitted, "centres")

    placed = T.StructType([scope, T.StructField("length", T.IntegerType()), docs.schema["id"], docs.schema["embedding"], T.StructField("cell", T.IntegerType()), T.StructField("angle", T.DoubleType())])
    cells = written(_met(docs.select(*_KIND, "id", "embedding"), "id", DOCUMENT_BLOCK, centres, _place_in_cells(placed), placed), "cells")
    radii = centres.join(cells.groupBy(*cell).agg(F.max("angle").alias("radius"), F.count("*").alias("n")), cell)
    radii = written(radii, "radii")

    asks = T.StructType([scope, T.StructField("length", T.IntegerType()), asked.schema["query_id"], asked.schema["vector"], T.StructField("cell", T.IntegerType())])
    plain = asked.withColumn("floor", F.lit(None).cast("double"))
    first = written(_met(plain, "query_id", QUERY_BLOCK, radii, _choose_cells(asks, k), asks), "first-cells")
    near = written(top_k(_compared(cells, first, cell, k), k), "near")
    floors = near.filter(F.col("rank") == k).select("query_id", F.col("score").alias("floor"))
    known = asked.join(broadcast_if_small(floors), "query_id", "left").withColumn("floor", F.coalesce("floor", F.lit(-1.0)))
    left = _met(known.select(*plain.columns), "query_id", QUERY_BLOCK, radii, _choose_cells(asks, k), asks)
    rest = written(left.join(first.select(*cell, "query_id"), [*cell, "query_id"], "left_anti").select(*asks.names), "other-cells")
    return first, near, rest, cells


def _met(rows: DataFrame, key: str, size: int, centres: DataFrame, each, layout: T.StructType) -> DataFrame:
    """``each`` over blocks of about ``size`` rows of a tenant and length, and all its centres."""
    blocks = rows.groupBy(*_KIND).agg(F.ceil(F.count("*") / size).alias("blocks"))
    blocks = broadcast_if_small(blocks)
    dealt = rows.join(blocks, [*_KIND]).withColumn("block", F.pmod(F.xxhash64(key), F.col("blocks")).cast("long")).drop("blocks")
    copies = centres.join(blocks, [*_KIND]).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).drop("blocks")
    meet = [*_KIND, "block"]
    return dealt.groupBy(*meet).cogroup(copies.groupBy(*meet)).applyInPandas(each, layout)


def _fit_centres(layout: T.StructType):
    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pick", kind="stable")
        units = _unit(rows["embedding"])
        centres = units[:int(rows["wanted"].iloc[0])]
        for _ in range(ROUNDS):
            own = (units @ centres.T).argmax(axis=1)
            sums = np.zeros_like(centres)
            np.add.at(sums, own, units)
            sizes = np.linalg.norm(sums, axis=1, keepdims=True)
            centres = np.where(sizes > 1e-9, sums / np.maximum(sizes, 1e-9), centres)
        kind = {c: rows[c].iloc[0] for c in _KIND}
        return pd.DataFrame({**kind, "cell": np.arange(len(centres), dtype=np.int32), "centre": list(centres)})[layout.names]

    return fit


def _angles(units: np.ndarray, centres: pd.DataFrame) -> np.ndarray:
    return np.arccos(np.clip(units @ np.stack([np.asarray(c) for c in centres["centre"]]).T, -1.0, 1.0))


def _place_in_cells(layout: T.StructType):
    def place(docs: pd.DataFrame, centres: pd.DataFrame) -> pd.DataFrame:
        if docs.empty or centres.empty:
            return pd.DataFrame([], columns=layout.names, dtype=object)
        angles = _angles(_unit(docs["embedding"]), centres)
        own = angles.argmin(axis=1)
        return docs.assign(cell=centres["cell"].to_numpy()[own].astype(np.int32), angle=angles[np.arange(len(own)), own])[layout.names]

    return place


def _choose_cells(layout: T.StructType, k: int):
    """The cells of each query: without a floor its nearest few, with k members at least; else all that reach the floor."""

    def choose(asked: pd.DataFrame, cells: pd.DataFrame) -> pd.DataFrame:
        if asked.empty or cells.empty:
            return pd.DataFrame([], columns=layout.names, dtype=object)
        angles = _angles(_unit(asked["vector"]), cells)
        sizes, radii, floors = cells["n"].to_numpy(), cells["radius"].to_numpy(), asked["floor"].to_numpy(dtype=np.float64)
        # a score of at least s needs a cosine of 2 - 1 / s
        least = np.where(floors > SLACK, 2.0 - 1.0 / np.maximum(floors - SLACK, SLACK), -1.0)
        widest = np.arccos(np.clip(least, -1.0, 1.0)) + ANGLE_SLACK
        row, column = [], []
        for n, own in enumerate(angles):
            if np.isnan(floors[n]):
                near = np.argsort(own, kind="stable")
                before = np.cumsum(sizes[near]) - sizes[near]
                chosen = near[(before < k) | (np.arange(len(near)) < FIRST_CELLS)]
            else:
                chosen = np.flatnonzero(own - radii <= widest[n] + ANGLE_SLACK)
            row += [n] * len(chosen)
            column += chosen.tolist()
        picked = asked.iloc[row]
        return picked.assign(cell=cells["cell"].to_numpy()[column].astype(np.int32))[layout.names]

    return choose


def _compared(docs: DataFrame, asked: DataFrame, kind: list[str], k: int) -> DataFrame:
    """(query_id, id, score): k rows per query and block of those documents that stand in the same ``kind``.

    Each side of a kind is dealt into blocks by a hash of its id, and every
    block of documents meets every block of queries in a task of its own.
    """
    # a row for each kind
    parts = docs.groupBy(*kind).agg(F.ceil(F.count("*") / DOCUMENT_BLOCK).alias("blocks")).join(
        asked.groupBy(*kind).agg(F.ceil(F.count("*") / QUERY_BLOCK).alias("query_blocks")), kind
    )
    parts = broadcast_if_small(parts)
    meet = [*kind, "block", "query_block"]

    def each(blocks: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1))

    def own(key: str, blocks: str) -> Column:
        return F.pmod(F.xxhash64(key), F.col(blocks)).cast("long")

    layout = T.StructType([asked.schema["query_id"], docs.schema["id"], T.StructField("score", T.DoubleType())])
    docs = docs.join(parts, kind).withColumn("block", own("id", "blocks")).withColumn("query_block", each("query_blocks"))
    asked = asked.join(parts, kind).withColumn("query_block", own("query_id", "query_blocks")).withColumn("block", each("blocks"))
    scores = docs.select(*meet, "id", "embedding").groupBy(*meet).cogroup(asked.select(*meet, "query_id", "vector").groupBy(*meet))
    return scores.applyInPandas(_best_of_blocks(layout, k), layout)


def _best_of_blocks(layout: T.StructType, k: int):
    names = layout.fieldNames()

    def best(docs: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if docs.empty or asked.empty:
            return pd.DataFrame([], columns=names, dtype=object)
        ids, rows = docs["id"].to_numpy(), _unit(docs["embedding"])
        found = [(q, ids[n], s) for q, near in zip(asked["query_id"], _nearest(ids, rows, _unit(asked["vector"]), k)) for n, s in near]
        return pd.DataFrame(found, columns=names)

    return best


def _unit(vectors: pd.Series) -> np.ndarray:
    rows = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    rows /= np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _nearest(ids: np.ndarray, rows: np.ndarray, asked: np.ndarray, k: int) -> Iterator[list[tuple[int, float]]]:
    """For every query the places and scores of its k best documents, ties by id."""
    scores = np.round(1.0 / (2.0 - asked @ rows.T), DIGITS)
    for found in scores:
        near = np.arange(len(ids))
        if len(ids) > k:
            near = np.flatnonzero(found >= np.partition(found, len(ids) - k)[len(ids) - k])
        kept = near[np.lexsort((ids[near], -found[near]))[:k]]
        yield list(zip(kept.tolist(), found[kept].tolist()))
