"""The inverted index and its pruned search against brute force and the forward index."""

import random

import pytest
from pyspark.sql import functions as F

from docuweft.search import bm25, inverted
from docuweft.session import remove_written

from test_search import brute_bm25


def frames(spark, docs, queries):
    return spark.createDataFrame(docs, "id long, text string"), spark.createDataFrame(queries, "query_id long, query string")


def best_of(docs, queries, k):
    scores = brute_bm25(docs, queries)
    out = {}
    for q, _ in queries:
        own = sorted((-round(s, 6), i) for (p, i), s in scores.items() if p == q)[:k]
        out |= {(q, i): (round(-s, 6), n) for n, (s, i) in enumerate(own, 1)}
    return out


@pytest.fixture(scope="module")
def texts():
    """Zipf-like words, ties by equal texts, long and empty documents."""
    rng = random.Random(4)
    words = [f"w{n}" for n in range(400)]
    weights = [1 / (n + 1) for n in range(400)]
    docs = [" ".join(rng.choices(words, weights, k=rng.choice([0, 3, 20, 80, 300]))) for _ in range(900)]
    docs += [docs[5], docs[5], docs[17], "w0 " * 5000, None, "w0", "w0", "w0"]
    return list(enumerate(docs))


@pytest.fixture(scope="module")
def asked():
    rng = random.Random(6)
    queries = [" ".join(rng.choices([f"w{n}" for n in range(400)], k=n)) for n in (1, 2, 3, 8, 20, 40)]
    return list(enumerate([*queries, "w0", "w0 w0 w1", "w399 w0", "nothing", ""]))


@pytest.mark.parametrize("k", [1, 10, 100])
@pytest.mark.parametrize("hot, skip_from", [(1 << 20, 0), (50, 0), (50, 1 << 40)])
def test_as_by_brute_force(spark, texts, asked, monkeypatch, k, hot, skip_from):
    monkeypatch.setattr(inverted, "HOT_POSTINGS", hot)
    docs, queries = frames(spark, texts, asked)
    index = inverted.kept_inverted_index(bm25.term_index(docs, "text"))
    found = inverted.bm25_topk(index, queries, k, skip_from=skip_from).collect()
    got = {(r["query_id"], r["id"]): (r["score"], r["rank"]) for r in found}
    wanted = best_of(texts, asked, k)
    assert got.keys() == wanted.keys() and len(found) == len(got)
    assert all(abs(got[p][0] - wanted[p][0]) < 2e-6 and got[p][1] == wanted[p][1] for p in got)


def test_joins_without_broadcasts_and_lists(spark, texts, asked, monkeypatch):
    docs, queries = frames(spark, texts, asked)
    index = inverted.kept_inverted_index(bm25.term_index(docs, "text"))
    wanted = sorted(map(tuple, inverted.bm25_topk(index, queries, 5, skip_from=0).collect()))
    monkeypatch.setattr(inverted, "LISTED", 0)
    monkeypatch.setattr(inverted, "is_small", lambda df: False)
    monkeypatch.setattr(inverted, "broadcast_if_small", lambda df: df)
    assert sorted(map(tuple, inverted.bm25_topk(index, queries, 5, skip_from=0).collect())) == wanted


def test_all_scores_are_those_of_the_forward_index(spark, texts, asked):
    docs, queries = frames(spark, texts, asked)
    forward = bm25.term_index(docs, "text")
    wanted = bm25.query_terms(queries)
    a = sorted(map(tuple, bm25.bm25_scores(forward, wanted).collect()))
    b = sorted(map(tuple, inverted.bm25_scores(inverted.kept_inverted_index(forward), wanted).collect()))
    assert [r[:2] for r in a] == [r[:2] for r in b] and all(abs(x[2] - y[2]) < 2e-6 for x, y in zip(a, b))


def test_scopes_are_counted_apart(spark, texts, asked):
    docs, queries = frames(spark, texts, asked)
    both = docs.withColumn("client_id", F.when(F.col("id") % 3 == 0, "a").otherwise("b"))
    asks = queries.withColumn("client_id", F.when(F.col("query_id") % 2 == 0, "a").otherwise("b"))
    index = inverted.kept_inverted_index(bm25.term_index(both, "text", scope=["client_id"]), ["client_id"])
    got = {(r["query_id"], r["id"]): r["rank"] for r in inverted.bm25_topk(index, asks, 4, skip_from=0).collect()}
    wanted = {}
    for client in (0, 1):
        own = [(i, t) for i, t in texts if (i % 3 == 0) == (client == 0)]
        wanted |= {p: n for p, (_, n) in best_of(own, [(q, t) for q, t in asked if q % 2 == client], 4).items()}
    assert got == wanted


def test_empty_tables(spark, texts, asked):
    docs, queries = frames(spark, texts, asked)
    index = inverted.kept_inverted_index(bm25.term_index(docs.limit(0), "text"))
    assert inverted.bm25_topk(index, queries, 3, skip_from=0).collect() == []
    index = inverted.kept_inverted_index(bm25.term_index(docs, "text"))
    assert inverted.bm25_topk(index, queries.limit(0), 3, skip_from=0).collect() == []


def scans(spark, frame, column):
    """The scan nodes of a plan that read ``column``."""
    text = frame._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    nodes = [p.strip() for p in text.split("\n\n")]
    return [p for p in nodes if "ReadSchema:" in p and column in p.split("ReadSchema:")[1]]


def test_a_search_reads_the_buckets_of_its_terms(spark, texts):
    docs, queries = frames(spark, texts, [(1, "w7 w8 w9")])
    index = inverted.kept_inverted_index(bm25.term_index(docs, "text"), buckets=64)
    wanted = bm25.query_terms(queries)
    asked = inverted._Asked(index, wanted)
    weights = asked.weights
    (whole,) = scans(spark, asked.rows(weights, "ids", "tfs", "lengths"), "lengths")
    assert "In(slot," in whole  # row groups of other terms are passed over
    (light,) = scans(spark, asked.rows(weights, "share"), "share:")
    assert "ids" not in light.split("ReadSchema:")[1]
    (known,) = scans(spark, inverted._weights(index, wanted), "spread")
    assert "In(term, [w7,w8,w9])" in known
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1")  # a partition for each piece of a file
    try:
        every, some = index.postings, inverted._only(index.postings, "slot", weights)
        assert len(some.select(F.input_file_name()).distinct().collect()) <= 3
        assert some.rdd.getNumPartitions() * 8 <= every.rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_postings_of_a_hot_term_are_dealt_to_several_slots(spark, texts, monkeypatch):
    monkeypatch.setattr(inverted, "HOT_POSTINGS", 40)
    docs, _ = frames(spark, texts, [])
    index = inverted.kept_inverted_index(bm25.term_index(docs, "text"))
    held = {r["term"]: (r["n"], r["slots"]) for r in index.postings.groupBy("term").agg(F.sum("n").alias("n"), F.countDistinct("slot").alias("slots")).collect()}
    assert held["w0"][0] > 400 and held["w0"][1] >= 4
    assert all(slots == 1 for n, slots in held.values() if n <= 40)


def test_most_postings_are_skipped(spark):
    rng = random.Random(12)
    words, weights = [f"w{n}" for n in range(3000)], [1 / (n + 1) for n in range(3000)]
    docs = [(n, " ".join(rng.choices(words, weights, k=rng.randrange(20, 200)))) for n in range(6000)]
    queries = [(q, " ".join(rng.choices(words[:300], k=4))) for q in range(12)]
    index = inverted.kept_inverted_index(bm25.term_index(spark.createDataFrame(docs, "id long, text string"), "text"))
    scored, every = inverted.scored_postings(index, spark.createDataFrame(queries, "query_id long, query string"), 5)
    assert scored < every / 2


def test_names_of_tables_are_removed(spark):
    docs, _ = frames(spark, [(1, "a b")], [])
    index = inverted.kept_inverted_index(bm25.term_index(docs, "text"))
    assert index.postings.count() == 2
    before = {t.name for t in spark.catalog.listTables()}
    assert any(n.startswith("inverted_") for n in before)
    remove_written(spark)
    assert not any(t.name.startswith(("inverted_", "terms_")) for t in spark.catalog.listTables())


def test_lists_of_a_block_are_made_without_moving_postings(spark):
    shape = "client_id string, id long, length int, block long, avgdl double, postings array<struct<term: string, tf: int>>"
    rows = [("x", 3, 2, 0, 2.0, [("a", 1), ("b", 1)]), ("x", None, 2, 0, 2.0, [("a", 2)]), ("y", 1, 1, 0, 2.0, [("a", 1)]), ("y", 2, 0, 1, 2.0, []), ("y", 4, 1, 1, 2.0, [("b", 1)])]
    lists = inverted._block_lists(spark.createDataFrame(rows, shape).coalesce(1), ["client_id"])
    assert "Exchange" not in lists._jdf.queryExecution().executedPlan().toString()
    found = sorted((r["client_id"], r["term"], r["block"], r["n"], r["ids"], r["tfs"], r["lengths"]) for r in lists.collect())
    assert found == [("x", "a", 0, 2, [None, 3], [2, 1], [2, 2]), ("x", "b", 0, 1, [3], [1], [2]), ("y", "a", 0, 1, [1], [1], [1]), ("y", "b", 1, 1, [4], [1], [1])]
