import glob
import gzip
import hashlib
import io
import random

import pytest

from docuweft.llm import warc


def wanted(rows):
    """What the rule says of rows (page_id, url, html), ids all different."""
    sized = [(p, (h or "").encode()) for p, _, h in rows]
    out = []
    for page_id, data in sized:
        last = max((p for p, d in sized if d == data), default=page_id, key=lambda p: (p is not None, p or 0))
        refers = len(data) >= 1000 and last != page_id
        out.append((page_id, len(data), hashlib.sha1(data).hexdigest(), "revisit" if refers else "response", last if refers else None))
    return sorted(out, key=str)


def test_round_trip(spark, tmp_path):
    rng = random.Random(1)
    big = ["x" * 1000, "é" * 500, "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 40, "a\r\n\r\nb\n" * 300, "😀\x00" * 400]
    rows = [(n, f"http://h/{n}", rng.choice([*big, "x" * 999, "", "short", f"own {n}" * 300])) for n in range(120)]
    rows += [(500, None, None), (501, "http://h/\r\nWARC-Type: evil", big[0]), (502, "", "y" * 300_000), (-5, "u", big[1]), (None, "u", big[0])]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload_digest string")
    found = warc.archive_and_read(frame, str(tmp_path / "archive")).collect()
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[c] for c in columns) for r in found), key=str) == wanted(rows)


def test_archives_hold_a_payload_once_under_standard_headers(spark, tmp_path):
    html = "z" * 5000
    frame = spark.createDataFrame([(n, f"http://h/{n}", html) for n in range(5)], "page_id long, url string, html string")
    warc.write_archives(frame, str(tmp_path / "a"))
    text = "".join(gzip.open(f, "rt", newline="").read() for f in glob.glob(f"{tmp_path}/a/*.gz"))
    assert text.count(html) == 1 and text.count("WARC-Type: revisit\r\n") == 4 and text.count("WARC/1.1\r\n") == 5
    own = next(r for r in text.split("WARC/1.1\r\n") if "WARC-Type: response" in r).split("WARC-Record-ID: ")[1].split("\r\n")[0]
    assert text.count(f"WARC-Refers-To: {own}\r\n") == 4 and text.count("WARC-Refers-To-Target-URI: http://h/4\r\n") == 4


def test_repeated_rows_are_the_same_record(spark):
    html = "z" * 2000
    rows = [(1, "u", html), (1, "u", html), (0, "u", html)]
    found = warc.archive_and_read(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r["page_id"], r["record_type"], r["refers_to"]) for r in found) == [(0, "revisit", 1), (1, "response", None), (1, "response", None)]


@pytest.mark.parametrize("bits", [1 << 10, None])
def test_more_revisits_than_are_broadcast(spark, monkeypatch, bits):
    monkeypatch.setattr(warc, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(warc, "filter_bits", lambda n: bits)
    rows = [(n, f"http://h/{n}", "hot " * 500 if n % 3 else f"own {n // 6} " * 300) for n in range(300)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(8)
    found = warc.archive_and_read(frame).collect()
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[c] for c in columns) for r in found), key=str) == wanted(rows)


def test_large_payloads_share_files_with_few(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "LARGE_BYTES", 2000)
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 4)
    rows = [(n, "u", f"{n} " * (4000 if n % 2 else 10)) for n in range(40)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    found = warc.archive_and_read(frame, str(tmp_path / "a")).collect()
    assert len(found) == 40 and len(glob.glob(f"{tmp_path}/a/*.gz")) == 5 + 20


def test_payloads_do_not_move(spark):
    frame = spark.range(50).selectExpr("id as page_id", "'u' as url", "if(id % 3 = 0, repeat('x', 2000), repeat(id, 2000)) as html")
    plan = warc.records(frame, "2024")._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti, BuildRight" in plan and "SortMergeJoin" not in plan


def test_broken_archives_are_an_error():
    record = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <a>\r\nWARC-Payload-Digest: sha1:00\r\nContent-Length: 6\r\n\r\nh\r\n\r\nb\r\n\r\n"
    for content in (record, record[:-5], "nonsense"):
        with pytest.raises(ValueError):
            list(warc.parse_archive(io.BytesIO(content.encode())))


def test_empty_table(spark):
    assert warc.archive_and_read(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
