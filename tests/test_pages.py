"""Pages and totals of search requests, made in one pass."""

import datetime
import random

import pytest

from docuweft.search import request

REQUEST = "query_id long, client_id string, modules array<string>, status array<string>, date_from date, date_to date, limit int, offset int"
DOCUMENT = "client_id string, id string, module string, status string, date date, title string"


@pytest.fixture(scope="module")
def documents():
    """Many ties of dates, null dates, and one tenant with most rows."""
    rng = random.Random(2)
    day = datetime.date(2024, 1, 1)
    return [
        (rng.choice("aaaab"), f"d{n:05d}é"[rng.randrange(2):], rng.choice(["sales", "rent"]), rng.choice(["open", "done", None]),
         rng.choice([None, *(day + datetime.timedelta(days=i) for i in range(9))]), f"title {n}")
        for n in range(3000)
    ]


def plain(documents, asked, scores=None):
    out = []
    for q, client, modules, statuses, least, most, limit, offset in asked:
        limit, offset = limit or 20, offset or 0
        own = [
            d for d in documents if d[0] == client and (modules is None or d[2] in modules) and (statuses is None or d[3] in statuses)
            and (least is None or (d[4] is not None and d[4] >= least)) and (most is None or (d[4] is not None and d[4] <= most))
            and (scores is None or (q, d[1]) in scores)
        ]
        by = (lambda d: (-(d[4].toordinal() if d[4] else 0), d[1])) if scores is None else (lambda d: (-scores[q, d[1]], d[1]))
        own.sort(key=by)
        out += [(q, d[1], n, len(own)) for n, d in enumerate(own, 1) if offset < n <= offset + limit]
    return sorted(out)


ASKED = [
    (1, "a", None, None, None, None, None, None), (2, "a", ["sales"], ["open", "done"], None, None, 100, 50), (3, "b", None, None, None, None, 7, 590),
    (4, "b", ["rent"], None, datetime.date(2024, 1, 3), datetime.date(2024, 1, 5), 3, 0), (5, "c", None, None, None, None, None, None),
    (6, "a", None, None, None, None, 5, 100_000), (7, "a", None, None, None, None, 100, 2390),
]


@pytest.mark.parametrize("rows_at_once", ["10000", "37"])
@pytest.mark.parametrize("scored", [False, True])
def test_as_by_brute_force(spark, documents, rows_at_once, scored):
    by_id = {(d[0], d[1]): d for d in documents}.values()
    docs, asked = spark.createDataFrame(list(by_id), DOCUMENT).repartition(5), spark.createDataFrame(ASKED, REQUEST)
    scores = {(q, d[1]): float(len(d[5]) % 4 + q) for q in range(1, 8) for d in by_id} if scored else None
    frame = spark.createDataFrame([(q, i, s) for (q, i), s in scores.items()], "query_id long, id string, score double") if scored else None
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows_at_once)
    try:
        found = request.search(docs, asked, frame).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted((r["query_id"], r["id"], r["rank"], r["total"]) for r in found) == plain(by_id, ASKED, scores)
    assert all(r["title"].startswith("title") for r in found)


def test_matches_are_made_once(spark, documents, tmp_path):
    spark.createDataFrame(documents, DOCUMENT).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    found = request.matches(docs.select("client_id", "id", "module", "status", "date"), spark.createDataFrame(ASKED, REQUEST))
    text = request.pages(found, "date")._jdf.queryExecution().toString()
    physical = text.split("== Physical Plan ==")[1]
    assert physical.count("FileScan parquet") == 1


def test_no_documents_or_requests(spark, documents):
    docs, asked = spark.createDataFrame(documents, DOCUMENT), spark.createDataFrame(ASKED, REQUEST)
    assert request.search(docs.limit(0), asked).collect() == [] and request.search(docs, asked.limit(0)).collect() == []
