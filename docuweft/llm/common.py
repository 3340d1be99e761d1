"""What the corpus operators share: reading tables, choosing labelled rows, fitting a small logistic model."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import local_frame, written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, where: str = "true") -> DataFrame:
    """(doc_id, text, label): at most ``per_class`` documents of each class, the same ones at every run.

    Label rows come in the order of a hash of their id, each task passing on no
    more than it may keep; the chosen ids, at most twice ``per_class``, are broadcast to the documents, whose texts stay where
    they are.  ``where`` is a condition on doc_id.  Ids that carry both labels,
    null ids and null labels take no part.
    """
    agreed = (
        labels.filter("doc_id is not null").filter(F.col(label).isin(0, 1)).filter(where)
        .groupBy("doc_id").agg(F.min(label).alias("label"), F.max(label).alias("_most")).filter("label = _most")
    )
    def first_of(value: int) -> DataFrame:
        return agreed.filter(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)

    chosen = first_of(0).unionByName(first_of(1)).select(F.col("doc_id").alias("_id"), "label")
    return docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), F.col("label").cast("int").alias("label")
    )


def numbered(rows: DataFrame, *order: Column) -> DataFrame:
    """``rows`` with ``number`` long, their place from 1 in the given order, made without gathering them in one task.

    Rows are sorted in ranges and written; the driver sees one count a range.
    Rows that are equal in all of ``order`` come in the order they are read, and
    may stand in different ranges, so that many of them are no hot group.
    """
    bits = 33  # of monotonically_increasing_id, whose upper ones are the number of the partition
    read = rows.withColumn("_read", F.monotonically_increasing_id())
    placed = written(read.orderBy(*order, "_read").withColumn("_read", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_read", bits)
    counts = sorted((r["part"], r["count"]) for r in placed.groupBy(part.alias("part")).count().collect())
    before, seen = [], 0
    for p, n in counts:
        before.append((p, seen))
        seen += n
    offsets = F.broadcast(local_frame(rows.sparkSession, before, "_part long, _before long"))
    number = F.col("_before") + F.col("_read") - F.shiftleft("_part", bits) + 1
    return placed.join(offsets, part == F.col("_part")).select(*[f"`{c}`" for c in rows.columns], number.alias("number"))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40.0, 40.0)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> np.ndarray:
    """Weights and, last, the intercept of a logistic model, by Newton steps.

    A class that is missing leaves the constant one half.
    """
    x = np.column_stack([x, np.ones(len(y))])
    w = np.zeros(x.shape[1])
    if len(y) == 0 or y.min() == y.max():
        return w
    share = np.full(len(y), 1.0 / len(y))
    keep = np.full(x.shape[1], ridge)
    keep[-1] = 1e-9
    for _ in range(steps):
        p = sigmoid(x @ w)
        gradient = x.T @ (share * (p - y)) + keep * w
        curve = (x * (share * p * (1 - p))[:, None]).T @ x + np.diag(keep)
        step = np.linalg.solve(curve, gradient)
        w -= step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return w
