"""Columns of queries without SQL against plain Python of their contracts, over a whole given table."""

import hashlib
import os
import re
from zlib import crc32

import pytest

from docuweft.llm import compression, queries
from docuweft.llm.common import table

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the given tables are not here")


def luhn(digits):
    doubled = [int(c) * (1 + n % 2) for n, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


#: Kind: pattern of the contract, and what a match must fulfil.
BASE = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
}


def test_personal_data_by_the_plain_patterns(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, SF, "documents").collect()}
    found = {r["doc_id"]: r for r in queries.op3_pii(spark, SF).collect()}
    assert found.keys() == texts.keys()
    for doc_id, text in texts.items():
        spans = {k: [(m.start(), m.end()) for m in re.finditer(p, text) if holds(m[0])] for k, (p, holds) in BASE.items()}
        row = found[doc_id]
        assert [row[f"n_{k}"] for k in BASE] == [len(spans[k]) for k in BASE]
        told = ",".join(f"{k}:{a}:{b}" for k in BASE for a, b in spans[k])
        assert row["base_sha256"] == hashlib.sha256(told.encode()).hexdigest()
        assert set(filter(None, told.split(","))) <= set(row["spans"].split(","))


def test_quality_scores_by_a_plain_recomputation(spark):
    docs = table(spark, SF, "documents")
    model = compression.train(docs.select("doc_id", "text"), table(spark, SF, "labels"), where=queries.TRAINED)
    plain = model.scorer()
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    found = {r["doc_id"]: r for r in queries.op10_quality_classifier(spark, SF).collect()}
    assert found.keys() == texts.keys()
    for doc_id, text in texts.items():
        row = found[doc_id]
        assert row["held_out"] == (crc32(str(doc_id).encode()) % 4 == 2)
        assert abs(row["score"] - float(plain([text])[0])) < 1e-12 and 0 <= row["score"] <= 1
        assert row["predicted"] == int(row["score"] >= 0.7)


def test_fingerprint_columns_are_hex(spark):
    rows = queries.op12_fingerprints(spark, SF).collect()
    assert len(rows) == table(spark, SF, "documents").count()
    assert all(re.fullmatch("([0-9a-f]{8})*", r[c]) for r in rows for c in ("fingerprint", "edited_fingerprint"))
