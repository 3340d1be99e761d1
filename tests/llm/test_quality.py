import os
import random
import re
from collections import Counter

import pytest

from docuweft.llm import compression, quality_rules
from docuweft.llm.common import table
from docuweft.llm.queries import TRAINED, op7_quality_rules, op10_quality_classifier

SF = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="the given tables are not here")


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + s for i, w in enumerate(windows) if often[w] > 1 for s in range(3)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered)


def samples():
    rng = random.Random(3)
    odd = ["", " ", "a", "a b", "a b c", "a b c a b c", "a a a a", "x\n x\nx\n\n\nx", "é b c\x85d", "#*$%&|<>", "A a A a", "t\x0bu\x0cv\rw\r\nx", "a b c a b d a b c " * 200]
    return odd + [" ".join(rng.choice(["a", "b", "c#", "d", "\n", "ß"]) for _ in range(rng.randrange(80))) for _ in range(200)]


@pytest.mark.parametrize("text", samples())
def test_counts(text):
    data = text.encode()
    assert quality_rules.text_counts(text, data, data.split()) == plain_counts(text)


def labelled(spark, n=400):
    rng = random.Random(5)
    good, bad = ["lovely", "prose", "about", "rivers", "and", "hills"], ["BUY!!", "$$$", "CLICK!!", "###", "WIN!!"]
    rows, labels = [], []
    for i in range(n):
        quality = int(rng.random() < 0.7)
        rows.append((i, " ".join(rng.choices(good if quality else bad, k=rng.randrange(60, 200)))))
        labels.append((i, quality))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")


def judge_both(docs, labels, rows):
    ngrams, packs = quality_rules.train(docs, labels), compression.train(docs, labels)
    return quality_rules.judge_quality(rows, ngrams), compression.score_quality(rows, packs)


def test_models_learn_what_labels_say(spark):
    docs, labels = labelled(spark)
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    by_ngram, by_size = judge_both(docs, labels, docs)
    assert {r["doc_id"]: int(r["probability"] >= 0.5) for r in by_ngram.collect()} == truth
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in by_size.collect()) >= 0.97 * len(truth)


def test_odd_rows_and_clashing_columns(spark):
    docs, labels = labelled(spark)
    labels = labels.unionByName(labels.sparkSession.createDataFrame([(1, None), (None, 1), (2, 0), (2, 1), (9999, 1)], "doc_id long, quality int"))
    rows = spark.createDataFrame(
        [(1, None, 7.0, True), (None, "", 7.0, True), (2, "😀" * 3, 7.0, True), (3, "word " * 200_000, 7.0, True), (3, "word " * 200_000, 7.0, True)],
        "doc_id long, text string, Score double, kept boolean",
    )
    by_ngram, by_size = judge_both(docs, labels, rows)
    got = by_ngram.drop("text").collect()
    assert [r["base_failed"] for r in got] == [True] * 5 and not any(r["kept"] for r in got) and got[0]["n_words"] == 0
    scores = [r["score"] for r in by_size.select("score").collect()]
    assert all(0 <= s <= 1 for s in scores) and scores[0] == scores[1] and scores[3] == scores[4]
    assert by_ngram.columns.count("kept") == 1 and "Score" not in by_size.columns
    assert [x.limit(0).collect() for x in (by_ngram, by_size)] == [[], []]


def test_without_labels_all_texts_score_alike(spark):
    docs, labels = labelled(spark, 50)
    for few in (labels.limit(0), labels.filter("quality = 1")):
        by_ngram, by_size = judge_both(docs, few, docs)
        assert {r["probability"] for r in by_ngram.collect()} == {0.5} and {r["score"] for r in by_size.collect()} == {0.5}


@needs_tables
def test_held_out_accuracy_on_the_given_tables(spark):
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF, "labels").collect()}
    rows = [(r["predicted"], labels[r["doc_id"]]) for r in op10_quality_classifier(spark, SF).filter("held_out").collect() if r["doc_id"] in labels]
    assert len(rows) > 50 and sum(p == q for p, q in rows) / len(rows) >= 0.9
    docs, answers = table(spark, SF, "documents").select("doc_id", "text"), table(spark, SF, "labels")
    judged = quality_rules.judge_quality(docs, quality_rules.train(docs, answers, where=TRAINED)).filter(f"not ({TRAINED}) and not base_failed")
    rows = [(int(r["kept"]), labels[r["doc_id"]]) for r in judged.drop("text").collect() if r["doc_id"] in labels]
    assert sum(p == q for p, q in rows) / len(rows) >= 0.9


@needs_tables
def test_query_counts_on_the_given_table(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    for r in op7_quality_rules(spark, SF).collect():
        got = tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
        assert got == plain_counts(texts[r["doc_id"]])
        assert r["base_failed"] == (got[0] < 50 or 100 * got[4] > 50 * got[0]) and not (r["kept"] and r["base_failed"])
