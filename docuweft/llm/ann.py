"""Approximate nearest neighbours by cosine along several shifted Hilbert curves.

Each ordering turns and shifts the unit vectors, projects them to a few
dimensions and numbers the cells a Hilbert curve passes through.  The numbers of
an ordering are range-partitioned into key windows at their quantiles; a query
meets the vectors of its own window and of its two neighbours, in every
ordering, and what it finds is merged and ranked by the exact measure.

Equal vectors are one class, searched once and listed by its smallest ids.
A window that holds more than a task should is split into blocks by a hash, the
queries that ask for it too, and every block of one meets every block of the other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written

#: Orderings, dimensions a vector is projected to and bits of each.
ORDERINGS, DIMENSIONS, BITS = 24, 8, 7
#: Key windows of an ordering, at most and a power of two; fewer vectors have fewer, of WINDOW_ROWS at least.
WINDOWS, WINDOW_ROWS = 64, 256
#: Vectors, and queries, that meet in one task at a time.
BLOCK = 4096
#: Cosines this near to the last that counts are worked out exactly.
SLACK = 1e-9
SEED = 17


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Positions along the Hilbert curve of cells (rows of small non-negative integers).

    The cells' bits are turned, from the highest down, into those of the
    transposed curve index, as Skilling describes, and then interleaved.
    """
    x = cells.astype(np.uint64).T.copy()
    count = len(x)
    for bit in range(bits - 1, 0, -1):
        high, low = np.uint64(1 << bit), np.uint64((1 << bit) - 1)
        for axis in range(count):
            inverts = (x[axis] & high) != 0
            swaps = np.where(inverts, np.uint64(0), (x[0] ^ x[axis]) & low)
            x[0] ^= np.where(inverts, low, np.uint64(0)) ^ swaps
            x[axis] ^= swaps
    for axis in range(1, count):
        x[axis] ^= x[axis - 1]
    turn = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> np.uint64(bit)) & np.uint64(1), np.uint64((1 << bit) - 1), np.uint64(0))
    x ^= turn
    keys = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for axis in range(count):
            keys = (keys << np.uint64(1)) | ((x[axis] >> np.uint64(bit)) & np.uint64(1))
    return keys.astype(np.int64)


@dataclass(frozen=True)
class Curves:
    """Orderings for vectors of one length, the same at every run."""

    length: int

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        """One row of keys per vector, one column per ordering."""
        unit = vectors / _norms(vectors)[:, None]
        random = np.random.default_rng([SEED, self.length])
        dims = min(DIMENSIONS, self.length)
        found = []
        for _ in range(ORDERINGS):
            turn = np.linalg.qr(random.normal(size=(self.length, dims)))[0]
            spot = (unit @ turn) * np.sqrt(self.length)
            shifted = (np.clip(spot, -4.0, 4.0) + 4.0 + random.random(dims)) / 9.0
            found.append(hilbert_keys(np.minimum((shifted * (1 << BITS)).astype(np.int64), (1 << BITS) - 1), BITS))
        return np.column_stack(found)


def _norms(rows: np.ndarray) -> np.ndarray:
    return np.sqrt((rows * rows).sum(axis=1))


def _usable(vectors: DataFrame, is_query: Column) -> DataFrame:
    """vec_id, vector (doubles), asks, and the hash that tells vectors apart; without vectors that take no part."""
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    fine = "vec_id is not null and size(vector) > 0 and forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    length = "aggregate(vector, 0D, (s, x) -> s + x * x)"
    rows = rows.filter(fine).filter(f"{length} > 0 and {length} < double('infinity')")
    return rows.withColumn("h1", F.xxhash64("vector")).withColumn("h2", F.xxhash64(F.lit("second"), "vector"))


def _classes(rows: DataFrame, k: int) -> DataFrame:
    """(h1, h2, vector, asks, ids) of different vectors; ``ids`` are the k + 1 smallest that have it."""
    key = ["h1", "h2"]
    smallest = Window.partitionBy(*key).orderBy("vec_id")
    ids = rows.select(*key, "vec_id").distinct().withColumn("_n", F.row_number().over(smallest)).filter(F.col("_n") <= k + 1)
    ids = ids.groupBy(*key).agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    return rows.groupBy(*key).agg(F.first("vector").alias("vector"), F.max("asks").alias("asks")).join(ids, key)


def _with_keys(classes: DataFrame) -> DataFrame:
    """``classes`` with the vector's length, its bytes and its keys."""
    layout = T.StructType([
        *[classes.schema[c] for c in ("h1", "h2", "asks")], T.StructField("least", T.LongType()), T.StructField("length", T.IntegerType()),
        T.StructField("vector", T.BinaryType()), T.StructField("keys", T.ArrayType(T.LongType())),
    ])

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vector")
            sizes = column.value_lengths().to_numpy()
            for length in np.unique(sizes):
                at = pa.array(np.flatnonzero(sizes == length))
                rows = column.take(at).flatten().to_numpy(zero_copy_only=False).reshape(len(at), length)
                keys = Curves(int(length)).keys(rows)
                yield pa.RecordBatch.from_arrays([
                    *[batch.column(c).take(at) for c in ("h1", "h2", "asks", "least")], pa.array(np.full(len(at), length, np.int32)),
                    pa.array([r.tobytes() for r in rows], pa.binary()), pa.array(list(keys), pa.list_(pa.int64())),
                ], names=layout.fieldNames())

    own = classes.select("h1", "h2", "asks", F.col("ids")[0].cast("long").alias("least"), "vector")
    return own.mapInArrow(keyed, layout)


def _cuts(curves: DataFrame) -> dict[tuple[int, int], np.ndarray]:
    """(length, ordering) -> the keys at which windows end; as many as WINDOWS for each, whatever the number of vectors."""
    parts = [n / WINDOWS for n in range(1, WINDOWS)]
    each = curves.select("length", F.posexplode("keys").alias("ordering", "key"))
    found = each.groupBy("length", "ordering").agg(F.count("*").alias("n"), F.percentile_approx("key", parts, 10_000).alias("ends"))
    cuts = {}
    for row in found.collect():
        windows = 1 << max(0, min(WINDOWS, row["n"] // WINDOW_ROWS).bit_length() - 1)
        step = WINDOWS // windows
        cuts[row["length"], row["ordering"]] = np.array(row["ends"][step - 1::step][:windows - 1], dtype=np.int64)
    return cuts


def _windows_of(length: int, keys: np.ndarray, cuts: dict) -> np.ndarray:
    return np.column_stack([np.searchsorted(cuts[length, n], keys[:, n]) for n in range(keys.shape[1])])


def _batches_with_windows(batches: Iterator[pa.RecordBatch], cuts: dict):
    """Of each batch and vector length: the rows' places, and their windows in every ordering."""
    for batch in batches:
        lengths = batch.column("length").to_numpy()
        keys = batch.column("keys").flatten().to_numpy().reshape(len(lengths), ORDERINGS)
        for length in np.unique(lengths):
            at = np.flatnonzero(lengths == length)
            yield batch, int(length), at, _windows_of(int(length), keys[at], cuts)


def _sizes(curves: DataFrame, cuts: dict) -> dict[tuple[int, int, int], tuple[int, int]]:
    """(length, ordering, window) -> its vectors and queries."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, length, at, windows in _batches_with_windows(batches, cuts):
            asks = batch.column("asks").to_numpy(zero_copy_only=False)[at]
            rows = []
            for ordering in range(ORDERINGS):
                for window in np.unique(windows[:, ordering]):
                    inside = windows[:, ordering] == window
                    rows.append((length, ordering, int(window), int(inside.sum()), int((inside & asks).sum())))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["length", "ordering", "window", "n", "asked"])

    found = curves.select("length", "keys", "asks").mapInArrow(counted, "length long, ordering long, window long, n long, asked long")
    rows = found.groupBy("length", "ordering", "window").agg(F.sum("n").alias("n"), F.sum("asked").alias("asked")).collect()
    return {(r["length"], r["ordering"], r["window"]): (r["n"], r["asked"]) for r in rows}


def _dealt(curves: DataFrame, cuts: dict, sizes: dict) -> DataFrame:
    """A row for every meeting a vector takes part in, as candidate in its window or as query in it and its neighbours."""
    none = (0, 0)

    def blocks(length: int, ordering: int, window: int) -> tuple[int, int]:
        asked = sum(sizes.get((length, ordering, w), none)[1] for w in (window - 1, window, window + 1))
        return -(-sizes.get((length, ordering, window), none)[0] // BLOCK), -(-asked // BLOCK)

    parts = {at: blocks(*at) for at in sizes}

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["length", "ordering", "window", "block", "asked_block", "asks", "h1", "h2", "least", "vector"]
        for batch, length, at, windows in _batches_with_windows(batches, cuts):
            h1, asks = batch.column("h1").to_numpy()[at], batch.column("asks").to_numpy(zero_copy_only=False)[at]
            spread = (h1.astype(np.uint64) >> np.uint64(20)).astype(np.int64)
            for ordering in range(ORDERINGS):
                rows: list[tuple[int, int, int, int, bool]] = []
                for n, window in enumerate(windows[:, ordering].tolist()):
                    own, asked = parts[length, ordering, window]
                    rows += [(n, window, int(spread[n] % own), q, False) for q in range(asked)]
                    if asks[n]:
                        for w in (window - 1, window, window + 1):
                            if (length, ordering, w) in parts:
                                own, asked = parts[length, ordering, w]
                                rows += [(n, w, b, int(spread[n] % asked), True) for b in range(own)]
                if rows:
                    n, window, block, asked_block, role = zip(*rows)
                    take = pa.array(at[list(n)])
                    yield pa.RecordBatch.from_arrays([
                        pa.array([length] * len(n), pa.int32()), pa.array([ordering] * len(n), pa.int32()), pa.array(window, pa.int32()),
                        pa.array(block, pa.int32()), pa.array(asked_block, pa.int32()), pa.array(role, pa.bool_()),
                        *[batch.column(c).take(take) for c in ("h1", "h2", "least", "vector")],
                    ], names=names)

    layout = "length int, ordering int, window int, block int, asked_block int, asks boolean, h1 long, h2 long, least long, vector binary"
    return curves.mapInArrow(dealt, layout)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``a`` with that of ``b``, in double precision."""
    return (a * b).sum(axis=1) / (_norms(a) * _norms(b))


def _best_of(queries: np.ndarray, rows: np.ndarray, least: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each query the places of its k best rows and their cosines, ties to the smaller id."""
    near = (queries / _norms(queries)[:, None]) @ (rows / _norms(rows)[:, None]).T
    for query, found in zip(queries, near):
        at = np.arange(len(rows))
        if len(at) > k:
            at = np.flatnonzero(found >= np.partition(found, len(at) - k)[len(at) - k] - SLACK)
        exact = cosines(np.broadcast_to(query, (len(at), len(query))), rows[at])
        order = np.lexsort((least[at], -exact))[:k]
        yield at[order], exact[order]


def _found(dealt: DataFrame, k: int) -> DataFrame:
    """(q1, q2, h1, h2, least, score): of each meeting the k best classes of each query, its own among them."""

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        asks = group["asks"].to_numpy()
        rows, queries = group[~asks], group[asks]
        out = {c: [] for c in ("q1", "q2", "h1", "h2", "least", "score")}
        if len(rows) and len(queries):
            matrix, wanted = (np.stack([np.frombuffer(v) for v in part["vector"]]) for part in (rows, queries))
            least = rows["least"].to_numpy()
            for q1, q2, (at, score) in zip(queries["h1"], queries["h2"], _best_of(wanted, matrix, least, k)):
                out["q1"] += [q1] * len(at)
                out["q2"] += [q2] * len(at)
                for c in ("h1", "h2", "least"):
                    out[c] += rows[c].to_numpy()[at].tolist()
                out["score"] += score.tolist()
        return pd.DataFrame(out)

    layout = "q1 long, q2 long, h1 long, h2 long, least long, score double"
    return dealt.groupBy("length", "ordering", "window", "block", "asked_block").applyInPandas(meet, layout)


def nearest(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """(query_id, rank from 1, vec_id, score): for rows of ``vectors`` (vec_id, embedding) that ``is_query`` holds for, their k nearest others.

    The score is the cosine of the original vectors in double precision; ties
    go to the smaller vec_id.  Null ids, and vectors that are null, empty, zero
    or hold nulls or non-finite numbers take no part; vectors of different
    lengths do not meet.  Rows that repeat an id and its vector count once.
    """
    rows = _usable(vectors, is_query)
    classes = written(_classes(rows, k), "vector-classes")
    curves = written(_with_keys(classes), "vector-curves")
    cuts = _cuts(curves)
    best = Window.partitionBy("q1", "q2").orderBy(F.desc("score"), "least")
    hits = _found(_dealt(curves, cuts, _sizes(curves, cuts)), k + 1).groupBy("q1", "q2", "h1", "h2").agg(
        F.max("score").alias("score"), F.min("least").alias("least")
    )
    hits = hits.withColumn("_n", F.row_number().over(best)).filter(F.col("_n") <= k + 1)
    listed = hits.join(classes.select("h1", "h2", F.explode("ids").alias("vec_id")), ["h1", "h2"])
    entry = F.struct((-F.col("score")).alias("far"), "vec_id")
    ranked = listed.groupBy("q1", "q2").agg(F.array_sort(F.collect_list(entry)).alias("near"))
    asked = rows.filter("asks").select(F.col("vec_id").alias("query_id"), F.col("h1").alias("q1"), F.col("h2").alias("q2")).distinct()
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return asked.join(ranked, ["q1", "q2"]).select("query_id", F.posexplode(others).alias("_at", "hit")).select(
        "query_id", (F.col("_at") + 1).cast("int").alias("rank"), "hit.vec_id", (-F.col("hit.far")).alias("score")
    )
