import math
import random
import re
from hashlib import sha256
from zlib import crc32

import pytest

from docuweft.llm import resampling

SHAPE = "doc_id long, text string"


def plain_features(text, order=2):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return words, [" ".join(words[i:i + n]) for n in range(1, order + 1) for i in range(len(words) - n + 1)]


def plain(rows, target, percent=25, least=20, buckets=10_000):
    bucket = lambda f: crc32(f.encode()) % buckets
    s, t = [0] * buckets, [0] * buckets
    for counts, texts in ((s, [x for _, x in rows]), (t, target)):
        for text in texts:
            for f in plain_features(text)[1]:
                counts[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    out, eligible = {}, []
    for doc_id, text in rows:
        words, features = plain_features(text)
        weight = sum(gain[bucket(f)] for f in features) // len(features) if features else 0
        h = int(sha256(f"7:{doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out[doc_id] = [len(features), weight, score, None]
        if len(words) >= least:
            eligible.append((-score, doc_id))
    for rank, (_, doc_id) in enumerate(sorted(eligible)[:percent * len(eligible) // 100], 1):
        out[doc_id][3] = rank
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    vocabulary = [f"w{n}" for n in range(300)] + ["Größe", "ÀB", "naïve", "日本語", "x_y", "don't", "A1"]
    texts = [rng.choice(["\n", " ", ", "]).join(rng.choices(vocabulary, k=rng.randrange(60))) for _ in range(300)]
    texts += [None, "", " \n\t", "one", "\x00a\x00b", "word " * 50_000, "x" * 3_000_000, texts[0], texts[0]]
    return list(enumerate(texts))


TARGET = ["w1 w2 w3 w4", "w1 w2", None, "größe W7"]


def run(spark, rows, target=TARGET, **more):
    found = resampling.resample(spark.createDataFrame(rows, SHAPE), spark.createDataFrame([(t,) for t in target], "text string"), **more)
    return [(r["doc_id"], [r["n_features"], r["weight"], r["score"], r["rank"]]) for r in found.collect()]


def test_as_by_brute_force(spark, rows):
    found = run(spark, rows)
    assert len(found) == len(rows) and dict(found) == plain(rows, TARGET)


def test_blocks_lose_no_run(monkeypatch, rows):
    texts = [t for _, t in rows]
    monkeypatch.setattr(resampling, "BYTES_AT_ONCE", 17)
    some = list(resampling.feature_buckets(texts[:200], 3))
    monkeypatch.undo()
    wanted = [(n, o, b) for n, o, b in resampling.feature_buckets(texts[:200], 3)]
    for length in (1, 2, 3):
        pairs = [sorted(p for n, o, b in found if n == length for p in zip(o.tolist(), b.tolist())) for found in (some, wanted)]
        assert pairs[0] == pairs[1]


def test_empty_tables(spark, rows):
    assert run(spark, []) == []
    assert dict(run(spark, rows[:50], [])) == plain(rows[:50], [])


def test_repeated_rows_and_rows_without_id(spark):
    text = " ".join(f"w{n}" for n in range(30))
    rows = [(1, text)] * 4 + [(None, text)] * 4
    found = run(spark, rows, percent=50)
    assert sorted(v[3] or 0 for d, v in found if d == 1) == [0, 0, 1, 2]
    assert all(v[2] is None and v[3] is None for d, v in found if d is None)


def test_extra_columns_are_left_alone(spark):
    docs = spark.createDataFrame([(1, "a b", 9, 9, "x")], SHAPE + ", score int, number int, `_read` string")
    assert resampling.resample(docs, docs.select("text")).columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]


def test_no_task_holds_all_ranks(spark):
    from pyspark.sql import functions as F

    from docuweft.llm.common import numbered

    rows = spark.range(5000).select((F.col("id") % 7).alias("key"), "id").repartition(4)
    found = numbered(rows, F.desc("key"), F.asc("id")).collect()
    assert [r["number"] for r in sorted(found, key=lambda r: (-r["key"], r["id"]))] == list(range(1, 5001))
    same = numbered(spark.range(1000).selectExpr("1 as key"), F.asc("key"))
    assert sorted(r["number"] for r in same.collect()) == list(range(1, 1001))
