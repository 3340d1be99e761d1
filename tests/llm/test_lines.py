import hashlib
import random

import pytest

from docuweft.llm import lines

BLANK = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_force(docs, min_docs, min_chars, keep_first):
    """Rows (doc_id, text) -> (kept text, lines, dropped) by the plain reading of the rule."""
    where = {}
    for doc_id, text in docs:
        for pos, line in enumerate((text or "").split("\n")):
            key = line.strip(BLANK).translate(LOWER)
            if len(key) >= min_chars:
                where.setdefault(key, []).append((doc_id, pos))
    out = []
    for doc_id, text in docs:
        own, kept = (text or "").split("\n"), []
        for pos, line in enumerate(own):
            found = where.get(line.strip(BLANK).translate(LOWER), [])
            first = keep_first and found and (doc_id, pos) == min(found)
            if len({d for d, _ in found}) < min_docs or first:
                kept.append(line)
        out.append((doc_id, "\n".join(kept), len(own), len(own) - len(kept)))
    return out


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(1)
    shared = ["Cookie banner", "  all rights RESERVED\t", "Ünïcode ÀB", "x", "", "\x0bvertical\x0c", "nbsp\u00a0"]
    rows = [(n, "\n".join(rng.choice([*shared, f"own {rng.random()}"]) for _ in range(rng.randrange(12)))) for n in range(60)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (103, "cookie BANNER\r\ncookie banner"), (104, "line\n" * 5000 + "Cookie banner")]
    return rows


@pytest.mark.parametrize("min_docs,min_chars,keep_first", [(10, 1, False), (3, 0, False), (2, 2, True), (1000, 1, False)])
def test_as_by_brute_force(spark, docs, min_docs, min_chars, keep_first):
    found = lines.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"), min_docs, min_chars, keep_first).collect()
    got = sorted((r["doc_id"], r["text"], r["_n_lines"], r["_n_dropped"]) for r in found)
    assert got == sorted(brute_force(docs, min_docs, min_chars, keep_first))


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    text = "shared\nmine"
    rows = [(n, text, "a", 1, 2) for n in range(3)] + [(0, text, "a", 1, 2), (None, text, "b", 3, 4), (None, "shared", "b", 3, 4), (7, "other", "c", 5, 6)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, _gaps string, tag int, _n_lines int")
    found = lines.dedup_lines(frame, min_docs=4, min_chars=1)
    assert found.columns == ["doc_id", "text", "_gaps", "tag", "_n_lines", "_n_dropped"]
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"], r["_gaps"], r["_n_dropped"]) for r in found.collect())
    # ids 0, 1, 2 and null: four documents hold both lines
    assert got == [(False, 0, "", "a", 2), (False, 0, "", "a", 2), (False, 1, "", "a", 2), (False, 2, "", "a", 2), (False, 7, "other", "c", 0),
                   (True, 0, "", "b", 1), (True, 0, "", "b", 2)]


def test_hot_keys_are_dealt_out_without_changing_the_result(spark, monkeypatch):
    monkeypatch.setattr(lines, "HOT_SAMPLE", 1.0)
    rows = [(n, f"everywhere\nhalf {n % 2}\nalone {n}") for n in range(300)]
    found = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), 150, 1, True).collect()
    got = sorted((r["doc_id"], r["text"], r["_n_lines"], r["_n_dropped"]) for r in found)
    assert got == sorted(brute_force(rows, 150, 1, True))


def test_bitmaps_hold_gaps_instead_of_text(spark):
    frame = spark.createDataFrame([(1, "a\nb\nx\nc\nx"), (2, "x")], "doc_id long, text string")
    found = {r["doc_id"]: r["gaps"] for r in lines.drop_bitmaps(frame, min_docs=2).collect()}
    assert found == {1: [2, 1], 2: [0]}


def test_empty_table(spark):
    assert lines.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query_digest(spark, tmp_path):
    from docuweft.llm.queries import op5_line_dedup

    spark.createDataFrame([(1, None), (2, "a\nb")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["kept_sha256"] for r in op5_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {1: hashlib.sha256(b"").hexdigest(), 2: hashlib.sha256(b"a\nb").hexdigest()}
