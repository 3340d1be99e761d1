import math
import random
from hashlib import sha256

import numpy as np
import pytest

from docuweft.llm import centroids

SHAPE = "vec_id long, embedding array<double>"


def plain(rows, k=8, rounds=10):
    whole = [(d, [math.floor(1024 * x) for x in v]) for d, v in rows
             if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    goals = [v for _, v in sorted(whole, key=lambda r: sha256(f"3:{r[0]}".encode()).hexdigest())[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, g)), n) for n, g in enumerate(goals))

    for _ in range(rounds):
        held = {}
        for _, v in whole:
            held.setdefault(nearest(v)[1], []).append(v)
        goals = [[sum(c) // len(held[n]) for c in zip(*held[n])] if n in held else g for n, g in enumerate(goals)]
    out = {d: nearest(v) for d, v in whole}
    own = {n: sum(d for d, m in out.values() if m == n) for n in range(len(goals))}
    return {
        v: (n, d, own[n], sum(own.values()), sha256(",".join(map(str, goals[n])).encode()).hexdigest()) for v, (d, n) in out.items()
    }


def run(spark, rows, shape=SHAPE, **more):
    found = centroids.with_inertia(*centroids.cluster(spark.createDataFrame(rows, shape), **more))
    return [(r["vec_id"], tuple(r)[1:]) for r in found.collect()]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    middles = [[rng.gauss(0, 1) for _ in range(64)] for _ in range(5)]
    rows = [(n, [x + rng.gauss(0, 0.3) for x in rng.choice(middles)]) for n in range(300)]
    rows += [(400 + n, list(rows[0][1])) for n in range(100)]
    rows += [(600, None), (601, []), (602, [1.0] * 63), (603, [None] + [1.0] * 63), (604, [math.nan] * 64), (605, [math.inf] + [0.0] * 63)]
    return rows + [(606, [0.0] * 64), (607, [-0.0001] * 64), (608, [100_000.0] * 64)]


def test_as_by_brute_force(spark, rows):
    found = run(spark, rows)
    wanted = plain(rows)
    assert len(found) == len(wanted) and dict(found) == wanted


def test_a_wide_span_is_tabulated_by_what_occurs(monkeypatch, spark):
    rng = np.random.default_rng(2)
    matrix, goals = rng.integers(-10**6, 10**6, (64, 500)), rng.integers(-10**6, 10**6, (8, 64))
    wanted = ((matrix.T[:, None, :] - goals[None]) ** 2).sum(axis=2)
    for span in (1, 1 << 30):
        monkeypatch.setattr(centroids, "SPAN", span)
        number, distance = centroids.nearest_centroids(matrix, goals)
        assert (number == wanted.argmin(axis=1)).all() and (distance == wanted.min(axis=1)).all()


def test_ties_empty_clusters_and_equal_vectors(spark):
    rows = [(n, [float(n % 2)] * 64) for n in range(40)]  # equal first centroids: the smaller number takes all, others stay
    assert dict(run(spark, rows)) == plain(rows)


def test_fewer_vectors_than_clusters_and_none(spark):
    rows = [(1, [0.5] * 64), (2, [-0.5] * 64)]
    assert dict(run(spark, rows)) == plain(rows)
    assert run(spark, []) == [] and run(spark, [(1, None)]) == []


def test_repeated_rows_too_large_numbers_and_clashing_columns(spark):
    rows = [(1, [0.5] * 64, 1, "a"), (1, [0.5] * 64, 1, "a"), (None, [0.25] * 64, 1, None), (2, [131_072.0] + [0.0] * 63, 1, None)]
    found = run(spark, rows, SHAPE + ", cluster int, at string")
    assert sorted(str(d) for d, _ in found) == ["1", "1", "None"]
    assert {v[1] for _, v in found} == {0}
