import random
from zlib import crc32

import numpy as np
import pytest
from tokenizers import Tokenizer

from docuweft.llm import packing, word_memo
from docuweft.llm.queries import WORD_BPE

ODD = [
    "", " ", "\n\t", "a  b", " a", "é x ́y", "<|endoftext|> a<|startoftext|>b<|", "İstanbul ΑΣ ΣΑΣ ÀÉß", "x y\x1cz w\x85q r", "日本語 😀 \x00 a", "don't I'LL it's 's", "a" * 3000,
    "ﬁ Å ÷×ª", "1234 5a6", "!!??--", "µ º K",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(WORD_BPE)


def plain_ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def test_words_alone_give_the_ids_of_the_text(tokenizer):
    rng, own = random.Random(2), packing.WordTokens(WORD_BPE)
    assert own.splits_here
    texts = ODD + ["".join(rng.choice("aAbeÉ'slt1 \n.,!<|>́😀ßÿ") for _ in range(rng.randrange(50))) for _ in range(4000)]
    for text in texts:
        assert own.encode(text) == np.array(plain_ids(tokenizer, text)[:-1], dtype="<u4").tobytes(), text


def test_memory_is_bounded(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 20)
    own = packing.WordTokens(WORD_BPE)
    own.memo = word_memo.WordMemo(own.learn, 64)
    for n in range(50):
        text = " ".join(f"w{n}x{m}é" for m in range(15))
        assert own.encode(text) == np.array(plain_ids(tokenizer, text)[:-1], dtype="<u4").tobytes()
        assert own.memo.words <= 48 and len(own.parts) <= 20 and len(own.before) <= 20


def test_words_are_remembered_whole(tokenizer, monkeypatch):
    rng = random.Random(7)
    words = ["".join(rng.choice("abcé") for _ in range(rng.choice([1, 2, 3, 5, 63, 64, 65, 200]))) for _ in range(600)]
    texts = [rng.choice([" ", "\n", " \t "]).join(rng.choices(words, k=rng.randrange(300))) for _ in range(60)] + ODD
    for block in (10, 1 << 18):
        monkeypatch.setattr(word_memo, "BYTES_AT_ONCE", block)
        own = packing.WordTokens(WORD_BPE)
        for _ in range(2):
            assert own.encode_all(texts) == [np.array(plain_ids(tokenizer, t)[:-1], dtype="<u4").tobytes() for t in texts]


def test_hashes_that_agree_in_part_are_told_apart(monkeypatch):
    monkeypatch.setattr(word_memo, "_RANDOM", np.stack([np.ones_like(word_memo._RANDOM[0]), word_memo._RANDOM[1]]))
    memo = word_memo.WordMemo(lambda words: [int(w).to_bytes(4, "little") for w in words], 256)
    for _ in range(3):
        assert [i.tolist() for i in memo.encode(["7 8 9 7", "", "9 10 11 8"])] == [[7, 8, 9, 7], [], [9, 10, 11, 8]]


def plain_best_fit(lengths, window):
    rooms, out = [], []
    for length in lengths:
        fits = [(room, n) for n, room in enumerate(rooms) if room >= length]
        room = min(fits)[0] if fits else window
        if not fits:
            rooms.append(window)
        out.append(room)
        at = min(fits)[1] if fits else len(rooms) - 1
        rooms[at] -= length
    return out, sorted(rooms)


@pytest.mark.parametrize("window", [1, 2, 7, 64, 100])
def test_best_fit_takes_the_tightest_window(window):
    rng = random.Random(window)
    lengths = sorted((rng.randrange(1, window + 1) for _ in range(400)), reverse=True)
    numbers, offsets = packing.best_fit(lengths, window)
    rooms = {}
    for length, number, offset in zip(lengths, numbers, offsets):
        assert offset == window - rooms.get(number, window)
        rooms[number] = rooms.get(number, window) - length
    wanted, left = plain_best_fit(lengths, window)
    assert [window - o for o in offsets] == wanted and sorted(rooms.values()) == left


def held(rows, docs, tokenizer, window):
    """That pieces cover every document once and lie in their sequences without gaps."""
    ids = {}
    for doc_id, text in docs:
        ids.setdefault(doc_id, []).append(plain_ids(tokenizer, text))
    pieces = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
    assert pieces.keys() == ids.keys()
    for doc_id, own in ids.items():
        wanted = sorted((s, len(i[s:s + window]), crc32(np.array(i[s:s + window], dtype="<u4").tobytes()), len(i)) for i in own for s in range(0, len(i), window))
        assert sorted((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in pieces[doc_id]) == wanted
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    return len(sequences)


@pytest.mark.parametrize("group", [16_384, 20])
def test_pieces_and_sequences(spark, tokenizer, group):
    rng = random.Random(11)
    docs = [(n, " ".join(rng.choices(["river", "Hills", "and", "42"], k=rng.randrange(120)))) for n in range(150)]
    docs += [(1000, None), (1001, ""), (1002, "long " * 1000), (1003, "long " * 63), (None, "no id"), (7, "the same id"), (7, "the same id")]
    frame = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, length string")
    pieces = packing.written(packing.token_pieces(frame, WORD_BPE, 64), "pieces")
    rows = packing.pack(pieces, 64, group).collect()
    sequences = held(rows, docs, tokenizer, 64)
    least = -(-sum(r["length"] for r in rows) // 64)
    assert sequences <= least * 1.05 + 1 if group > len(rows) else sequences <= least * 1.6


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack_documents(frame, WORD_BPE).collect() == []
