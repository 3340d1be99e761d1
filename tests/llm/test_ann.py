import os

import numpy as np
import pytest

from docuweft.llm import ann
from docuweft.llm.queries import op2_nearest

SF = "/root/testdata/sf0.1"


def exact(rows, k, every):
    """query_id -> [(vec_id, score)] over all others."""
    ids = np.array([i for i, _ in rows])
    matrix = np.array([v for _, v in rows], dtype=np.float64)
    out = {}
    for n in np.flatnonzero(ids % every == 0):
        score = ann.cosines(np.broadcast_to(matrix[n], matrix.shape), matrix)
        order = [m for m in np.lexsort((ids, -score)) if ids[m] != ids[n]][:k]
        out[int(ids[n])] = [(int(ids[m]), float(score[m])) for m in order]
    return out


def answers(found):
    out = {}
    for r in sorted(found.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def same(got, wanted):
    assert got.keys() == wanted.keys()
    for q, hits in wanted.items():
        assert [i for i, _ in got[q]] == [i for i, _ in hits], q
        assert np.allclose([s for _, s in got[q]], [s for _, s in hits], rtol=0, atol=1e-12)


@pytest.mark.parametrize("bits,dims", [(1, 2), (4, 2), (3, 3), (2, 5)])
def test_curve_goes_through_every_cell_by_single_steps(bits, dims):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), axis=-1).reshape(-1, dims)
    keys = ann.hilbert_keys(cells, bits)
    assert sorted(keys) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_exact_where_one_window_holds_all_and_ties_go_to_smaller_ids(spark):
    rng = np.random.default_rng(1)
    rows = [(n, rng.normal(size=8).tolist()) for n in range(150)]
    rows += [(1000 + n, rows[20][1]) for n in range(40)] + [(2000, rows[30][1])]
    frame = spark.createDataFrame([(*r, 1.0) for r in rows], "vec_id long, embedding array<double>, score double")
    same(answers(ann.nearest(frame, ann.F.col("vec_id") % 10 == 0, 5)), exact(rows, 5, 10))


def test_vectors_that_take_no_part(spark):
    good = [(n, [float(n + 1), 1.0]) for n in range(4)]
    odd = [(10, None), (20, []), (30, [0.0, 0.0]), (40, [float("nan"), 1.0]), (50, [float("inf"), 1.0]), (60, [1.0, None]), (None, [1.0, 1.0]), (70, [1.0, 2.0, 3.0])]
    rows = good + odd + [good[0], good[0]]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = answers(ann.nearest(frame, ann.F.col("vec_id") % 10 == 0, 5))
    same(got, exact(good, 5, 10))
    assert ann.nearest(frame.limit(0), ann.F.col("vec_id") % 10 == 0, 5).collect() == []


def test_blocks_of_a_full_window_all_meet(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 16)
    rng = np.random.default_rng(2)
    rows = [(n, (rng.normal(size=6)).tolist()) for n in range(200)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    same(answers(ann.nearest(frame, ann.F.col("vec_id") % 3 == 0, 4)), exact(rows, 4, 3))


@pytest.mark.skipif(not os.path.isdir(SF), reason="the given tables are not here")
def test_recall_on_the_given_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got, wanted = answers(op2_nearest(spark, SF)), exact(rows, 5, 50)
    assert got.keys() == wanted.keys()
    found = np.mean([len({i for i, _ in got[q]} & {i for i, _ in hits}) / len(hits) for q, hits in wanted.items()])
    assert found >= 0.9
