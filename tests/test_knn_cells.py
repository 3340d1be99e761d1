"""Vector search by cells against brute force: the same rows, fewer pairs."""

import numpy as np
import pytest

from docuweft.search import knn


def clustered(n, clusters, spread, size=32, seed=3):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(clusters, size))
    return (middles[rng.integers(0, clusters, n)] + spread * rng.normal(size=(n, size))).tolist()


def frames(spark, vectors, asked, scope=None):
    more = ", client_id string" if scope else ""
    docs = [(n, v, *([scope(n)] if scope else [])) for n, v in enumerate(vectors)]
    queries = [(n, v, *([scope(n)] if scope else [])) for n, v in enumerate(asked)]
    return spark.createDataFrame(docs, "id long, embedding array<double>" + more), spark.createDataFrame(queries, "query_id long, vector array<double>" + more)


def both(spark, vectors, asked, k, scope=None):
    docs, queries = frames(spark, vectors, asked, scope)
    name = "client_id" if scope else None
    return [sorted(map(tuple, knn.knn_topk(docs, queries, k, name, cells_from=c).collect())) for c in (0, 1 << 60)]


@pytest.mark.parametrize("spread, k", [(0.05, 5), (0.5, 1), (2.0, 20)])
def test_cells_find_what_all_pairs_find(spark, spread, k):
    vectors = clustered(1500, 25, spread)
    by_cells, by_pairs = both(spark, vectors, vectors[::20], k)
    assert by_cells == by_pairs and len(by_pairs) == 75 * k


def test_most_pairs_are_skipped_where_vectors_are_clustered(spark):
    vectors = clustered(4000, 60, 0.15)
    docs, queries = frames(spark, vectors, vectors[::20])
    compared, every = knn.compared_pairs(docs, queries, 5)
    assert every == 4000 * 200 and compared < 0.3 * every


def test_ties_copies_scopes_and_odd_vectors(spark):
    rng = np.random.default_rng(8)
    vectors = clustered(300, 6, 0.2, 16) + [[1.0] * 16] * 200 + [[-2.0] * 16] * 3 + [[3.0] * 8] * 5
    vectors += [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [0.0] * 15]
    asked = [vectors[0], [1.0] * 16, [0.0] * 16, None, [1.0] * 8, [1.0] * 4, rng.normal(size=16).tolist()]
    by_cells, by_pairs = both(spark, vectors, asked, 7)
    assert by_cells == by_pairs
    assert {r[0] for r in by_cells} == {0, 1, 4, 6}
    by_cells, by_pairs = both(spark, vectors, asked, 400, lambda n: "ab"[n % 2])
    assert by_cells == by_pairs


def test_empty_sides(spark):
    docs, queries = frames(spark, clustered(10, 2, 0.1), [[1.0] * 32])
    for a, b in ((docs.limit(0), queries), (docs, queries.limit(0))):
        assert knn.knn_topk(a, b, 3, cells_from=0).collect() == []


def test_hot_cells_are_dealt_to_blocks(spark, monkeypatch):
    monkeypatch.setattr(knn, "DOCUMENT_BLOCK", 50)
    monkeypatch.setattr(knn, "QUERY_BLOCK", 4)
    vectors = clustered(300, 3, 0.1, 8) + [[1.0] * 8] * 300
    by_cells, by_pairs = both(spark, vectors, vectors[::20], 6)
    assert by_cells == by_pairs
