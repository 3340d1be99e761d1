"""Blending text and vector hits of the same queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bm25 import DIGITS, top_k

# Weights of text and vector scores, and what the lowest hit counts.
TEXT_WEIGHT, VECTOR_WEIGHT = 0.3, 0.7
LOWEST = 0.001


def min_max(hits: DataFrame) -> DataFrame:
    """Scores of each query's hit list scaled to 0..1; a lone or tied list counts 1, the lowest hit a little."""
    mine = Window.partitionBy("query_id")
    low, high = F.min("score").over(mine), F.max("score").over(mine)
    scaled = F.when(high == low, F.lit(1.0)).otherwise((F.col("score") - low) / (high - low))
    return hits.withColumn("score", F.when(scaled == 0, F.lit(LOWEST)).otherwise(scaled))


def _merged(text_hits: DataFrame, vector_hits: DataFrame) -> DataFrame:
    text = text_hits.select("query_id", "id", F.col("score").alias("text_score"))
    vector = vector_hits.select("query_id", "id", F.col("score").alias("vector_score"))
    both = text.join(vector, ["query_id", "id"], "full_outer")
    return both.fillna(0.0, ["text_score", "vector_score"])


def hybrid(text_hits: DataFrame, vector_hits: DataFrame, k: int) -> DataFrame:
    """Weighted mean of the normalised scores; a document missing from a list counts 0 there."""
    merged = _merged(min_max(text_hits), min_max(vector_hits))
    blend = (TEXT_WEIGHT * F.col("text_score") + VECTOR_WEIGHT * F.col("vector_score")) / (TEXT_WEIGHT + VECTOR_WEIGHT)
    return top_k(merged.select("query_id", "id", F.round(blend, DIGITS).alias("score")), k)


def fallback(text_hits: DataFrame, vector_hits: DataFrame, k: int) -> DataFrame:
    """Without the blending step: the sum of both raw scores."""
    total = F.col("text_score") + F.col("vector_score")
    return top_k(_merged(text_hits, vector_hits).select("query_id", "id", F.round(total, DIGITS).alias("score")), k)
