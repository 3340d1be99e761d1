import random
import struct

import numpy as np
import pytest
import sentencepiece

from docuweft.llm import sentencepiece_codec as sc
from docuweft.llm.queries import PIECE_BPE

ODD = [
    "", " ", "  ", "a  b", "\n", "\n\n x", " a", "a ", "▁", "▁▁a ▁", "é x ́y", "<s> </s> <unk> <0x41>", "日本語 テキスト 😀 \x00 a", "tab\tsep\r\nline", "a" * 3000, "aaa aaaa aaaaa", "ﬁ ﬂ Å",
    "x" + " " * 40 + "y",
]


def texts():
    rng = random.Random(3)
    return ODD + ["".join(rng.choice("aAbeE  \n\té▁😀.,!1the") for _ in range(rng.randrange(40))) for _ in range(1500)]


def field(number, value):
    """One protobuf field."""
    if isinstance(value, int):
        return bytes([number << 3 & 0x7F | (0x80 if number > 15 else 0)]) + (bytes([number >> 4]) if number > 15 else b"") + bytes([value])
    if isinstance(value, float):
        return bytes([number << 3 | 5]) + struct.pack("<f", value)
    return bytes([number << 3 | 2]) + varint(len(value)) + value


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def unigram_model(fallback, prefix=1, trims=0):
    """A small model written by hand: nothing is trained."""
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    pieces += [(f"<0x{n:02X}>", 0.0, 6) for n in range(256)] if fallback else []
    words = ["▁", "a", "b", "e", "t", "h", "▁t", "▁the", "he", "the", "ab", "▁ab", "ea", ".", "▁a", "é", "th"]
    pieces += [(w, -1.0 - 0.37 * n, 1) for n, w in enumerate(words)]
    data = b"".join(field(1, field(1, p.encode()) + field(2, float(s)) + (field(3, k) if k != 1 else b"")) for p, s, k in pieces)
    trainer = field(3, 1) + (field(35, 1) if fallback else b"")
    return data + field(2, trainer) + field(3, field(3, prefix) + field(4, trims) + field(5, 1))


@pytest.fixture(scope="module", params=["bpe", "unigram", "unigram bytes", "unigram plain", "unigram trims"])
def path(request, tmp_path_factory):
    if request.param == "bpe":
        return PIECE_BPE
    made = tmp_path_factory.mktemp("model") / "m.model"
    made.write_bytes(unigram_model("bytes" in request.param, 0 if "plain" in request.param else 1, int("trims" in request.param)))
    return str(made)


def test_ids_and_texts_are_those_of_the_sentencepiece_library(path):
    judge, own = sentencepiece.SentencePieceProcessor(model_file=path), sc.Codec(path)
    found, agrees = own.encode(texts())
    for text, ids in zip(texts(), found):
        ids = np.frombuffer(ids, dtype="<u4").tolist()
        assert ids == judge.encode(text), text
        if own.model.byte_fallback:
            assert own.decode(ids) == judge.decode(ids), text
            assert own.comes_back(text, np.array(ids, dtype="<u4").tobytes())
    assert np.mean(agrees) > 0.99


def test_the_two_libraries_agree_on_the_given_model():
    assert all(sc.Codec(PIECE_BPE).encode(texts())[1])


def test_a_wrong_normaliser_is_seen(monkeypatch):
    monkeypatch.setattr(sc, "normalizer", lambda model: sc.normalizers.Sequence([sc.normalizers.Lowercase(), sc.normalizers.Prepend(sc.MARK), sc.normalizers.Replace(" ", sc.MARK)]))
    judge, own = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE), sc.Codec(PIECE_BPE)
    found, agrees = own.encode(["The hills", "the hills"])
    assert agrees == [False, True]
    assert [np.frombuffer(i, dtype="<u4").tolist() for i in found] == judge.encode(["The hills", "the hills"])


def test_ids_are_decoded_by_both_libraries(path, monkeypatch):
    own, judge = sc.Codec(path), sentencepiece.SentencePieceProcessor(model_file=path)
    if own.model.byte_fallback:
        odd = [[3 + 0x41], [1, 2, 259]]  # a byte that is a character, control pieces
        assert [own.decode(i) for i in odd] == [judge.decode(i) for i in odd]
    ids = own.encode(["the ab"])[0]
    assert own.comes_back("the ab", ids[0])
    monkeypatch.setattr(own, "decode", lambda ids: "other")
    assert not own.comes_back("the ab", ids[0])


def test_model_file_is_read_whole():
    model, judge = sc.parse_model(open(PIECE_BPE, "rb").read()), sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    assert len(model.pieces) == judge.get_piece_size() and model.unk_id == judge.unk_id() and model.byte_fallback and model.splits
    assert all(p == judge.id_to_piece(n) and abs(s - judge.get_score(n)) < 1e-6 for n, (p, s, _) in enumerate(model.pieces))


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(sc, "REMEMBERED", 10)
    own, judge = sc.Codec(PIECE_BPE), sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    for n in range(20):
        text = " ".join(f"w{n}x{m}" for m in range(8))
        assert np.frombuffer(own.encode([text])[0][0], dtype="<u4").tolist() == judge.encode(text)
        assert len(own.words) <= 18


def test_tables(spark):
    rows = [(1, None, "x"), (None, "", "x"), (2, "the hills", "x"), (2, "the hills", "x"), (3, "é😀 " * 30_000, "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    judge = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    found = sc.encode(frame, PIECE_BPE)
    assert found.columns == ["doc_id", "text", "ids", "agrees"]
    assert [(r["ids"], r["agrees"]) for r in found.collect()] == [(judge.encode(t or ""), True) for _, t, _ in rows]
    assert [r["back"] for r in found.select(sc.decode(found["ids"], PIECE_BPE).alias("back")).collect()] == [t or "" for _, t, _ in rows]
    checked = sc.encode_and_verify(frame, PIECE_BPE).collect()
    assert [r["n_tokens"] for r in checked] == [len(judge.encode(t or "")) for _, t, _ in rows] and all(r["comes_back"] for r in checked)
    assert sc.encode(frame.limit(0), PIECE_BPE).collect() == []
