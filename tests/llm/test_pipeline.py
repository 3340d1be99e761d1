import os

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from docuweft.llm import compression, packing, pii
from docuweft.llm.common import table
from docuweft.llm.queries import TRAINED, WORD_BPE

from .test_lines import brute_force as deduped_lines
from .test_minhash import wanted_parts
from .test_packing import held

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the given tables are not here")


def plain_pipeline(spark):
    """(doc_id, text) that the stages before packing leave, one step after the other in plain Python."""
    docs = table(spark, SF, "documents")
    score = compression.train(docs, table(spark, SF, "labels"), where=TRAINED).scorer()
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    rows = [(d, t) for d, t in rows if score([t])[0] >= 0.7]
    rows = [(d, t) for d, t, *_ in deduped_lines(rows, 10, 1, True)]
    least = wanted_parts(rows)
    return [(d, pii.masked(t)) for d, t in rows if least[d] == d]


def test_as_by_brute_force(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    held(rows, plain_pipeline(spark), Tokenizer.from_file(WORD_BPE), packing.WINDOW)


def test_stages_return_the_columns_of_documents_and_bear_odd_rows(spark):
    shape = "doc_id long, text string, lang string, source string, n_chars long, _id string, score string, label int"
    rows = [(1, None, None, None, None, None, None, None), (None, "", "en", "s", 0, "i", "x", 1), (None, None, "en", "s", 0, "i", "x", 1)]
    rows += [(2, "mail a@b.de now please", "en", "s", 22, "i", "x", 1)] * 2 + [(3, "mail a@b.de now please", "en", "s", 22, "i", "x", 1), (4, "w " * 100_000, "en", "s", 1, "i", "x", 1)]
    docs = spark.createDataFrame(rows, shape)
    for frame in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, frame, SF).columns == docs.columns
        assert stage(spark, frame, SF).count() == frame.count()
        corpus_pipeline.pack(spark, frame, SF).collect()
    kept = corpus_pipeline.near_dedup(spark, docs, SF).collect()
    assert sorted(str(r["doc_id"]) for r in kept) == ["1", "2", "4", "None", "None"]
    masked = {r["doc_id"]: (r["text"], r["n_chars"]) for r in corpus_pipeline.mask_personal_data(spark, docs, SF).collect()}
    assert masked[2] == ("mail [EMAIL] now please", 23) and masked[1] == (None, None)


@pytest.mark.parametrize("order", [(0, 1, 2), (1, 2, 0), (2, 1, 0), (2, 0, 1)])
def test_rows_that_repeat_a_doc_id_are_held_by_their_texts(spark, order):
    rows = [(3, "one text with some words of its own"), (5, "one text with some words of its own"), (5, "quite another text that nothing is near to")]
    docs = spark.createDataFrame([rows[n] for n in order], "doc_id long, text string")
    assert sorted(map(tuple, corpus_pipeline.near_dedup(spark, docs, SF).collect())) == [rows[0], rows[2]]


def test_one_of_many_copies_keeps_its_whole_text(spark):
    own = [f"line {n} of the copied text, with words of its own" for n in range(30)]
    rows = [(100 + n, "\n".join(own), 1) for n in range(50)] + [(n, f"alone {n}\nnothing shared {n}", 1) for n in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    left = corpus_pipeline.near_dedup(spark, corpus_pipeline.line_dedup(spark, docs, SF), SF).collect()
    texts = {r["doc_id"]: r["text"] for r in left}
    assert texts[100] == "\n".join(own)
    assert [d for d, t in texts.items() if d >= 100 and t] == [100]
    assert {d: t for d, t in texts.items() if d < 100} == {d: t for d, t, _ in rows if d < 100}
