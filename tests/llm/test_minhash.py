import os
import random
from itertools import combinations

import numpy as np
import pytest

import corpus_pipeline
from docuweft.llm import minhash, simhash

from .test_simhash import parts_of

SF = "/root/testdata/sf0.001"


def plain_shingles(text, width=5):
    words = (text or "").lower().split()
    return {" ".join(words[i:i + width]) for i in range(len(words) - width + 1)} or ({" ".join(words)} if words else set())


def similar(a, b):
    return a == b or len(a & b) >= 0.8 * len(a | b)


def wanted_parts(rows):
    own = {d: plain_shingles(t) for d, t in rows}
    return parts_of(list(own), [(a, b) for a, b in combinations(own, 2) if similar(own[a], own[b])])


def edited(rng, words, at_most):
    words = list(words)
    for _ in range(rng.randrange(at_most + 1)):
        words[rng.randrange(len(words))] = f"new{rng.random()}"
    return " ".join(words)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    texts = []
    for n in range(25):
        base = [f"w{n}-{rng.randrange(200)}" for _ in range(rng.randrange(3, 400))]
        texts += [edited(rng, base, max(1, len(base) // 40)) for _ in range(rng.randrange(1, 6))]
    base = [f"big{n}" for n in range(300)]
    texts += [edited(rng, base, 5) for _ in range(150)]
    chain = [f"chain{n}" for n in range(100)]
    for n in range(30):  # each near the next, the ends far from each other
        chain[3 * n] = f"moved{n}"
        texts.append(" ".join(chain))
    texts += [None, "", " \n", "one two", "One  two", "one three", "z " * 5000]
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_as_by_brute_force(spark, rows):
    found = minhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == wanted_parts(rows)


def test_below_the_bound_nothing_is_linked(spark):
    base = [f"w{n}" for n in range(104)]  # 100 shingles
    rows = [(1, " ".join(base)), (2, " ".join(base[:92] + [f"x{n}" for n in range(12)])), (3, " ".join(base[:93] + [f"y{n}" for n in range(11)]))]
    assert not similar(plain_shingles(rows[0][1]), plain_shingles(rows[1][1]))
    found = minhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == wanted_parts(rows)


def test_loosely_alike_texts_are_not_held_against_each_other(spark, monkeypatch):
    rng = random.Random(11)
    base = [f"w{n}" for n in range(60)]
    texts = []
    for _ in range(400):  # two words changed in each: most pairs share half of their shingles
        words = list(base)
        for at in rng.sample(range(60), 2):
            words[at] = f"new{rng.random()}"
        texts.append(" ".join(words))
    rows = list(enumerate(texts))
    compared, write = [], minhash.written

    def counting(df, name):
        done = write(df, name)
        if name == "pairs":
            compared.append(done.count())
        return done

    monkeypatch.setattr(minhash, "written", counting)
    found = minhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == wanted_parts(rows)
    assert sum(compared) < 0.1 * 400 * 399 / 2


def test_sketches_of_pairs_at_the_bound_stay_within_their_slack(spark):
    rng = random.Random(12)
    pairs = []
    for n in range(300):
        size = rng.choice([18, 90, 900])
        shared = [rng.getrandbits(64) for _ in range(size - size // 9)]
        sets = [np.array(sorted(shared + [rng.getrandbits(64) for _ in range(size // 9)]), np.uint64) for _ in "ab"]
        pairs.append((n, *[minhash.sketch(minhash.minima(own)) for own in sets]))
    differ = spark.createDataFrame(pairs, "n long, a array<long>, b array<long>").select(minhash.sketches_differ("a", "b").alias("d")).collect()
    by_hand = []
    for _, a, b in pairs:
        unequal = np.unpackbits(np.array(a).view(np.uint8)) != np.unpackbits(np.array(b).view(np.uint8))
        by_hand.append(int(unequal.reshape(minhash.PLANES, -1).any(axis=0).sum()))
    assert [r["d"] for r in differ] == by_hand
    assert max(by_hand) <= minhash.most_differing(0.8) < 64


def test_empty_table(spark):
    assert minhash.near_copies(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.skipif(not os.path.isdir(SF), reason="the given tables are not here")
def test_the_pipelines_stage_keeps_one_of_near_copies(spark):
    rng = random.Random(8)
    base = [f"w{n}" for n in range(300)]
    rows = [(10 + n, edited(rng, base, 5)) for n in range(20)] + [(n, f"another text {n} that nothing is near to") for n in range(5)]
    kept = corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF).collect()
    assert sorted(r["doc_id"] for r in kept) == [0, 1, 2, 3, 4, 10]


def test_simhash_proposes_pairs(spark):
    text = " ".join(f"w{n}" for n in range(400))
    rows = [(1, text), (2, text + " tail"), (3, text), (4, "nothing like the others at all"), (5, None)]
    docs = spark.createDataFrame([(d, 0, t) for d, t in rows], "doc_id long, tag long, text string")
    marks = minhash.signatures(docs, 5)
    own = {r["doc_id"]: (r["node"], r["mark"]) for r in marks.collect()}
    assert all(m == simhash.fingerprint(t, 5) for (d, t), (_, m) in zip(rows, (own[d] for d, _ in rows)))
    assert (own[1][1] ^ own[2][1]).bit_count() <= 2
    pairs = [(r["a"], r["b"]) for r in minhash.simhash_pairs(marks).collect()]
    assert pairs == [tuple(sorted((own[1][0], own[2][0])))]
