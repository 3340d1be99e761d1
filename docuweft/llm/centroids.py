"""Clusters of vectors around centroids in whole numbers, by tables of squared differences.

Components become whole numbers floor(SCALE x), so that distances, sums and new
centroids are exact and do not hang on the order of rows.  In every round each
batch of vectors tabulates, dimension by dimension, the squared difference of
each value that occurs to each centroid; a distance is then a row of gathers
from these tables, added up.  Tasks pass on one sum a centroid and dimension,
and the driver holds the centroids alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import local_frame, written

#: Components of a vector, centroids, rounds, seed of the first centroids, and the whole numbers a unit is divided into.
DIMENSIONS = 64
CLUSTERS = 8
ROUNDS = 10
SEED = 3
SCALE = 1024
#: Whole numbers below it keep squared distances of some dozens of dimensions within a long.
LARGEST = 1 << 27
#: Values a table holds from the least to the greatest that occurs; where these are further apart it holds those that occur only.
SPAN = 1 << 14


def whole_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """(vec_id, at array of int) of the rows of ``vectors`` (vec_id, embedding) with ``dimensions`` components, none null or not finite.

    Components of LARGEST / ``scale`` and beyond, whose squared distances no
    long holds, leave a vector out as one that is not finite does.
    """
    bound = float(LARGEST) / scale
    x = F.transform("embedding", lambda c: c.cast("double"))
    fits = F.forall(x, lambda c: F.coalesce((c > -bound) & (c < bound), F.lit(False)))  # NaN is greater than any number
    kept = vectors.filter((F.size("embedding") == dimensions) & fits)
    return kept.select("vec_id", F.transform(x, lambda c: F.floor(c * scale).cast("int")).alias("at"))


def first_centroids(whole: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The vectors whose ``seed:vec_id`` has the smallest sha256 in hex, in that order; all of them, if they are fewer.

    Rows that repeat a vec_id count one by one, in the order of their
    components; those without one come last.
    """
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = whole.orderBy(key.asc_nulls_last(), "at").limit(clusters).collect()
    return np.array([r["at"] for r in rows], dtype=np.int64)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    """Dimensions by rows."""
    at = batch.column("at")
    return at.flatten().to_numpy().reshape(len(at), -1).T.astype(np.int64)


def nearest_centroids(matrix: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of the centroid nearest to each column of ``matrix``; ties go to the smaller number."""
    total = np.zeros((matrix.shape[1], len(centroids)), np.int64)
    for values, goals in zip(matrix, centroids.T):
        least, greatest = int(values.min()), int(values.max())
        if greatest - least < SPAN:
            occurring, place = np.arange(least, greatest + 1), values - least
        else:
            occurring, place = np.unique(values, return_inverse=True)
        table = (occurring[:, None] - goals[None, :]) ** 2
        total += table[place]
    number = total.argmin(axis=1)
    return number, total[np.arange(len(number)), number]


def moved(whole: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: floors of the exact means of the vectors nearest to each, itself where there are none."""
    k, dimensions = centroids.shape

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, sizes = np.zeros((k, dimensions), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            if batch.num_rows:
                matrix = _matrix(batch)
                number, _ = nearest_centroids(matrix, centroids)
                sizes += np.bincount(number, minlength=k)
                for own in np.unique(number):
                    sums[own] += matrix[:, number == own].sum(axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), pa.array(sizes), pa.array(list(sums), pa.list_(pa.int64()))], ["number", "n", "sums"])

    parts = whole.select("at").mapInArrow(add_up, "number int, n long, sums array<long>")
    rows = parts.select("number", "n", F.posexplode("sums")).groupBy("number", "pos").agg(F.sum("n").alias("n"), F.sum("col").alias("sum")).collect()
    out = centroids.copy()
    for r in rows:
        if r["n"]:
            out[r["number"], r["pos"]] = r["sum"] // r["n"]
    return out


def cluster(
    vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE, seed: int = SEED,
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every vector that :func:`whole_vectors` keeps, and the final centroids.

    Rounds end early once one moves no centroid, as all later ones would then.
    Rows that repeat a vec_id are clustered one by one, those without one too.
    """
    whole = written(whole_vectors(vectors, dimensions, scale), "vectors")
    centroids = first_centroids(whole, clusters, seed)
    if not len(centroids):
        centroids = centroids.reshape(0, dimensions)
        return whole.selectExpr("vec_id", "0 as cluster", "0L as distance"), centroids
    for _ in range(rounds):
        before, centroids = centroids, moved(whole, centroids)
        if (before == centroids).all():
            break
    final = centroids
    layout = whole.selectExpr("vec_id", "0 as cluster", "0L as distance").schema

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                number, distance = nearest_centroids(_matrix(batch), final)
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(number.astype(np.int32)), pa.array(distance)], layout.fieldNames())

    return whole.mapInArrow(assign, layout), centroids


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``assigned`` (vec_id, cluster, distance) with cluster_inertia, inertia and centroid_sha256: one row a cluster is broadcast."""
    assigned = written(assigned, "clusters")
    sums = {r["cluster"]: r["sum"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("sum")).collect()}
    rows = [
        (number, own, sum(sums.values()), sha256(",".join(map(str, centroids[number].tolist())).encode()).hexdigest())
        for number, own in sums.items()
    ]
    known = local_frame(assigned.sparkSession, rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
