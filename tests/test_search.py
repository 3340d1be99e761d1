"""Analysis, ranking, pages and highlights against brute force on small fixtures."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from docuweft.operators.quality import backlog, dimension_drift, lag_by_tenant, positions_from_progress
from docuweft.search import bm25, hybrid, knn, request
from docuweft.search.analyze import DOMAIN, ENGLISH, STANDARD, STOP_WORDS, SYNONYMS_ONLY, analyzed, counted, exploded
from docuweft.search.stemming import stem


def test_stems_of_the_published_examples():
    words = """caresses caress ponies poni ties ti caress caress cats cat feed feed agreed agre plastered plaster bled bled
        motoring motor sing sing conflated conflat troubled troubl sized size hopping hop tanned tan falling fall hissing hiss
        fizzed fizz failing fail filing file happy happi sky sky relational relat conditional condit rational ration valenci
        valenc hesitanci hesit digitizer digit conformabli conform radicalli radic differentli differ vileli vile
        analogousli analog vietnamization vietnam predication predic operator oper feudalism feudal decisiveness decis
        hopefulness hope callousness callous formaliti formal sensitiviti sensit sensibiliti sensibl triplicate triplic
        formative form formalize formal electriciti electr electrical electr hopeful hope goodness good revival reviv
        allowance allow inference infer airliner airlin gyroscopic gyroscop adjustable adjust defensible defens irritant
        irrit replacement replac adjustment adjust dependent depend adoption adopt homologou homolog communism commun
        activate activ angulariti angular homologous homolog effective effect bowdlerize bowdler probate probat rate rate
        cease ceas controll control roll roll""".split()
    for word, want in zip(words[::2], words[1::2]):
        assert stem(word) == want, word


def terms(spark, value, analyzer):
    row = analyzed(spark.createDataFrame([(value,)], "t string"), "t", analyzer).first()
    return row["terms"], row["length"]


@pytest.mark.parametrize("value, want", [
    ("Don't stop, U.S.A. 3.14 1,000 a_b x1y été’s", ["don't", "stop", "u.s.a", "3.14", "1,000", "a_b", "x1y", "été’s"]),
    ("日本ab こx", ["日", "本", "ab", "こ", "x"]),
    ("a..b 1.a a.1 SO-12/34", ["a", "b", "1", "a", "a", "1", "so", "12", "34"]),
    ("", []), (None, []), ("·!?", []),
    ("w" * 600, ["w" * 255, "w" * 255, "w" * 90]),
])
def test_tokens(spark, value, want):
    assert terms(spark, value, STANDARD) == (want, len(want))


def test_english_and_domain_chains(spark):
    assert terms(spark, "The dog's ponies are running to Bob’s", ENGLISH) == (["dog", "poni", "run", "bob"], 4)
    got, length = terms(spark, "the Bill of Materials for rfq", DOMAIN)
    assert Counter(got) == Counter("bom bill materi rfq request quotat request quot".split())
    assert length == 4


def test_synonyms_both_ways(spark):
    got, length = terms(spark, "po 7 purchase order x goods received note", SYNONYMS_ONLY)
    assert Counter(got) == Counter(
        "po purchase order 7 po purchase order x grn goods receipt goods received note".split())
    assert length == 8


def test_counts_and_statistics(spark):
    docs = spark.createDataFrame([(1, "b a b"), (2, ""), (3, "a")], "id long, text string")
    index = bm25.term_index(docs, "text")
    assert sorted(tuple(r) for r in exploded(index).collect()) == [(1, 3, "a", 1), (1, 3, "b", 2), (3, 1, "a", 1)]
    assert sorted(tuple(r) for r in bm25.term_stats(index).collect()) == [("a", 2, 2), ("b", 1, 2)]
    assert counted(docs.selectExpr("array('x','y','x') as terms")).first()["postings"] == [("x", 2), ("y", 1)]


def brute_bm25(docs, queries):
    words = {i: Counter(t.split()) for i, t in docs if t}
    n, avg = len(words), sum(sum(c.values()) for c in words.values()) / len(words)
    scores = {}
    for q, asked in queries:
        for term, times in Counter(asked.split()).items():
            df = sum(term in c for c in words.values())
            for i, c in words.items():
                if term in c:
                    part = math.log(1 + (n - df + 0.5) / (df + 0.5)) * c[term] * 2.2 / (
                        c[term] + 1.2 * (0.25 + 0.75 * sum(c.values()) / avg))
                    scores[q, i] = scores.get((q, i), 0) + times * part
    return scores


@pytest.mark.parametrize("broadcast_rows", [200_000, 0])
def test_bm25(spark, monkeypatch, broadcast_rows):
    monkeypatch.setattr(bm25, "is_small", lambda df: broadcast_rows > 0)
    rnd = random.Random(1)
    docs = [(i, " ".join(rnd.choices("a b c d e f hot hot hot".split(), k=rnd.randint(0, 30)))) for i in range(60)]
    queries = [(q, " ".join(rnd.choices("a b zz hot".split(), k=4))) for q in range(5)] + [(9, "zz")]
    index = bm25.term_index(spark.createDataFrame(docs, "id long, text string"), "text")
    asked = spark.createDataFrame(queries, "query_id long, query string")
    want = brute_bm25(docs, queries)
    got = {(r["query_id"], r["id"]): r["score"] for r in bm25.bm25_scores(index, bm25.query_terms(asked)).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 2e-6 for k in want)
    top = bm25.bm25_topk(index, asked, 3).collect()
    for q in range(5):
        best = sorted(((-round(s, 6), i) for (p, i), s in want.items() if p == q))[:3]
        assert [(r["id"], r["rank"]) for r in sorted(top, key=lambda r: r["rank"]) if r["query_id"] == q] == [
            (i, n) for n, (_, i) in enumerate(best, 1)]


def test_search_within_a_tenant(spark):
    """Two tenants share document ids; each question is answered and counted within its own."""
    docs = [("a", 1, "x y"), ("a", 2, "x"), ("b", 1, "x x z"), ("b", 3, "z"), ("b", 4, "q")]
    asked = [("a", 10, "x"), ("b", 20, "x z")]
    frame = spark.createDataFrame(docs, "client_id string, id long, text string")
    index = bm25.term_index(frame, "text", scope=["client_id"])
    questions = spark.createDataFrame(asked, "client_id string, query_id long, query string")
    got = {(r["query_id"], r["id"]): r["score"] for r in bm25.bm25_topk(index, questions, 9, scope=["client_id"]).collect()}
    want = {}
    for client, query_id, query in asked:
        want |= brute_bm25([(i, t) for c, i, t in docs if c == client], [(query_id, query)])
    assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 2e-6 for p in want)
    vectors = spark.createDataFrame([("a", 1, [1.0, 0.0]), ("b", 1, [0.0, 1.0]), ("b", 2, [1.0, 0.0])], "client_id string, id long, embedding array<float>")
    near = spark.createDataFrame([("a", 10, [0.0, 1.0]), ("b", 20, [0.0, 1.0]), ("c", 30, [0.0, 1.0])], "client_id string, query_id long, vector array<double>")
    hits = knn.knn_topk(vectors, near, 1, scope="client_id").collect()
    assert sorted((r["query_id"], r["id"], r["score"]) for r in hits) == [(10, 1, 0.5), (20, 1, 1.0)]


def test_bm25_without_documents(spark):
    for docs in ([(1, "")], []):
        index = bm25.term_index(spark.createDataFrame(docs, "id long, text string"), "text")
        assert bm25.bm25_topk(index, spark.createDataFrame([(1, "a")], "query_id long, query string"), 3).count() == 0


@pytest.mark.parametrize("documents, queries", [(8192, 1024), (50, 2)])
def test_knn(spark, monkeypatch, documents, queries):
    monkeypatch.setattr(knn, "DOCUMENT_BLOCK", documents)
    monkeypatch.setattr(knn, "QUERY_BLOCK", queries)
    rnd = np.random.default_rng(3)
    rows = [(f"d{i:03d}", [float(x) for x in rnd.normal(size=4)]) for i in range(200)]
    rows += [(f"same{i:03d}", [1.0, 0.0, 0.0, 0.0]) for i in range(100)] + [("none", None), ("zero", [0.0] * 4)]
    rows += [(f"bad{i}", [float("nan"), 1.0, 1.0, 1.0]) for i in range(9)] + [("hole", [None, 1.0, 1.0, 1.0]), ("far", [float("inf"), 1.0, 1.0, 1.0])]
    rows += [("odd", [1.0]), ("odd2", [-1.0])]
    asked = [(q, [float(x) for x in rnd.normal(size=4)]) for q in range(5)] + [(9, [2.0, 0.0, 0.0, 0.0])]
    others = [(20, [3.0]), (21, [0.0] * 4), (22, None), (23, [float("nan")] * 4)]
    frame = spark.createDataFrame(asked + others, "query_id long, vector array<double>")
    hits = knn.knn_topk(spark.createDataFrame(rows, "id string, embedding array<float>"), frame, 7).collect()
    assert sorted((r["id"], r["score"]) for r in hits if r["query_id"] >= 20) == [("odd", 1.0), ("odd2", round(1 / 3, 6))]
    assert sorted(r["query_id"] for r in knn.unusable_queries(frame).collect()) == [21, 22, 23]
    got = knn.knn_topk(spark.createDataFrame(rows, "id string, embedding array<float>").repartition(3),
                       spark.createDataFrame(asked, "query_id long, vector array<double>"), 7).collect()
    for q, vector in asked:
        scores = []
        for i, v in rows:
            if v and len(v) == 4 and any(v) and None not in v and np.isfinite(v).all():
                v = np.array(v, dtype=np.float32).astype(float)
                norm = np.linalg.norm(v) * np.linalg.norm(vector)
                scores.append((-round(1 / (2 - (v @ np.array(vector) / norm if norm else 0)), 6), i))
        mine = sorted((r["rank"], r["id"], r["score"]) for r in got if r["query_id"] == q)
        assert [(i, s) for _, i, s in mine] == [(i, -s) for s, i in sorted(scores)[:7]]
    empty = spark.createDataFrame([], "query_id long, vector array<double>")
    assert knn.knn_topk(spark.createDataFrame(rows, "id string, embedding array<float>"), empty, 7).count() == 0


def test_blending(spark):
    text = spark.createDataFrame([(1, 1, 8.0), (1, 2, 4.0), (1, 3, 6.0), (2, 1, 3.0)], "query_id long, id long, score double")
    vector = spark.createDataFrame([(1, 2, 0.9), (1, 4, 0.5), (3, 5, 0.7)], "query_id long, id long, score double")
    got = {(r["query_id"], r["id"]): r["score"] for r in hybrid.hybrid(text, vector, 10).collect()}
    assert got == {(1, 1): 0.3, (1, 2): 0.7003, (1, 3): 0.15, (1, 4): 0.0007, (2, 1): 0.3, (3, 5): 0.7}
    got = {(r["query_id"], r["id"]): (r["score"], r["rank"]) for r in hybrid.fallback(text, vector, 2).collect()}
    assert got == {(1, 1): (8.0, 1), (1, 3): (6.0, 2), (2, 1): (3.0, 1), (3, 5): (0.7, 1)}


REQUEST = ("query_id long, client_id string, modules array<string>, status array<string>, date_from date, date_to date, "
           "`limit` int, `offset` int")


def test_requests_and_pages(spark):
    docs = spark.range(30).selectExpr(
        "'t1' as client_id", "concat('d', lpad(id, 2, '0')) as id", "if(id % 2 = 0, 'sales', 'account') as module",
        "if(id % 3 = 0, 'Paid', 'Draft') as status", "date_add(date'2024-01-01', cast(id as int)) as date",
    ).unionByName(spark.sql("select 't2' client_id, 'z' id, 'sales' module, 'Paid' status, date'2024-01-05' date"))
    asked = spark.createDataFrame([
        (1, "t1", None, None, None, None, None, None), (2, "t1", ["sales"], ["Paid"], None, None, 2, 1),
        (3, "t2", None, None, None, None, 5, 0), (4, "t1", ["none"], None, None, None, 5, 0),
    ], REQUEST)
    got = {}
    for r in request.search(docs, asked).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["id"], r["total"]))
    assert [i for _, i, _ in sorted(got[1])] == [f"d{n:02d}" for n in range(29, 9, -1)] and got[1][0][2] == 30
    assert sorted(got[2]) == [(2, "d18", 5), (3, "d12", 5)] and got[3] == [(1, "z", 1)] and 4 not in got
    scores = spark.createDataFrame([(1, "d03", 5.0), (1, "d01", 5.0), (1, "d20", 9.0), (1, "z", 99.0)], "query_id long, id string, score double")
    ranked = sorted((r["rank"], r["id"], r["total"]) for r in request.search(docs, asked, scores).collect())
    assert ranked == [(1, "d20", 3), (2, "d01", 3), (3, "d03", 3)]
    with pytest.raises(Exception, match="out of range"):
        request.search(docs, spark.createDataFrame([(1, "t1", None, None, None, None, 101, 0)], REQUEST)).collect()


def test_highlight(spark):
    docs = spark.createDataFrame([(1, "The PO", "Pay the order.\nNo match here! an Order's order, twice")], "id long, title string, text_content string")
    (row,) = request.highlight(docs, F.array(F.lit("order"), F.lit("pay"))).collect()
    assert row["highlight"] == {"text_content": ["<em>Pay</em> the <em>order</em>.", "an Order's <em>order</em>, twice"]}


def test_highlight_keeps_numbers_whole_and_follows_the_request(spark):
    docs = spark.createDataFrame([(1, "po 7", "Paid 12.50 twice. The ponies ran.\nRunning on! See www.x.org")], "id long, title string, text_content string")
    (row,) = request.highlight(docs, F.array(F.lit("12.50"), F.lit("www.x.org"))).collect()
    assert row["highlight"] == {"text_content": ["Paid <em>12.50</em> twice.", "See <em>www.x.org</em>"]}
    hits = docs.selectExpr("explode(array(10, 20, 30)) as query_id", "*")
    asked = spark.createDataFrame([(10, "the pony runs"), (20, "purchase order"), (30, "")], "query_id int, query string")
    got = {r["query_id"]: r["highlight"] for r in request.highlight_requests(hits, asked).collect()}
    assert got[10] == {"text_content": ["The <em>ponies</em> ran.", "<em>Running</em> on!"]}
    assert got[20] == {"title": ["<em>po</em> 7"]} and got[30] == {}
    plain = request.highlight_requests(hits, asked, ["text_content"], {"text_content": STANDARD}).collect()
    assert {r["query_id"]: r["highlight"] for r in plain} == {10: {"text_content": ["<em>The</em> ponies ran."]}, 20: {}, 30: {}}


def test_stop_words_are_the_published_ones():
    """The default English list of the classic analyzers, written down here on its own."""
    published = """a, an, and, are, as, at, be, but, by, for, if, in, into, is, it, no, not, of, on, or, such, that, the, their, then,
        there, these, they, this, to, was, will, with"""
    assert STOP_WORDS == set(published.replace("\n", " ").replace(" ", "").split(","))


def test_watching(spark):
    docs = spark.createDataFrame([("a", "m", [1.0, 2.0]), ("a", "m", [1.0]), ("b", "m", None), ("b", "n", [1.0])], "client_id string, module string, embedding array<float>")
    assert sorted(tuple(r) for r in dimension_drift(docs, 2).collect()) == [("a", "m", 1, 1), ("b", "n", 1, 1)]
    progress = [{"latestOffset": '{"s1": {"0": 10, "1": 5}, "s2": {"0": 4}}', "endOffset": '{"s1": {"0": 7, "1": 5}}'}]
    positions = spark.createDataFrame(positions_from_progress(progress), "stream string, latest long, committed long, pending long")
    streams = spark.createDataFrame([("s1", "a"), ("s2", "a"), ("s3", "b")], "stream string, client_id string")
    assert [tuple(r) for r in lag_by_tenant(positions, streams).collect()] == [("a", 7)]
    events = spark.range(2100).selectExpr("if(id < 1001, 'x', 'y') as stream").filter("stream = 'x'")
    assert [tuple(r) for r in backlog(events).collect()] == [("x", 1001)]
    assert backlog(events.limit(1000)).count() == 0


def test_an_analyzers_worker_remembers_a_bounded_number_of_words():
    from docuweft.search.analyze import _Terms

    terms = _Terms(ENGLISH)
    assert all(terms[f"w{n}"] == f"w{n}" for n in range(150_000))
    assert len(terms) <= 100_000
