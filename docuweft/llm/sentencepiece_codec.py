"""SentencePiece models run by the tokenizers library: the model file is parsed and its tokenizer rebuilt, nothing is trained.

Unigram and BPE models are rebuilt with the normaliser, the metaspace marker,
scores and byte fallback of the file.  Where no piece holds the marker after
another character, texts are encoded by marked words: each different word once,
many in one multithreaded call, and then remembered.  Every word's ids are held
against the sentencepiece library; of a word on which the two differ its ids are
used, and the text says so.  That library also normalises every whole raw text.
As no piece reaches over a word's end, neither library's ids of a text are other
than those of its words: equal normal forms and equal words make equal texts.

Ids are decoded whole, by the pieces of the file and by the sentencepiece library.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

#: Fixed: the marker that stands for a blank, model and piece types of the file format, its field numbers.
MARK = "▁"
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: More blanks than a text starts with: where a model trims, decoding drops them all.
ALL_BLANKS = 1 << 31
#: Words whose ids a worker remembers; beyond, it starts anew.
REMEMBERED = 500_000
#: Words of a line and lines of a call.
WORDS_A_LINE, LINES_AT_ONCE = 64, 512


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protobuf message: integers, or bytes of what is longer."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(data):
        number, kind = divmod(varint(), 8)
        if kind == 0:
            yield number, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield number, data[at:at + size]
            at += size


@dataclass(frozen=True)
class Model:
    pieces: list[tuple[str, float, int]]
    kind: int
    byte_fallback: bool
    unk_id: int
    charsmap: bytes
    dummy_prefix: bool
    trims: bool
    escapes: bool
    suffix: bool

    @property
    def splits(self) -> bool:
        """Whether words may be encoded alone: the marker is a piece, and no piece has it behind another character."""
        known = [p for p, _, kind in self.pieces if kind in (NORMAL, USER_DEFINED)]
        return self.escapes and not self.suffix and MARK in known and not any(re.search(f"[^{MARK}]{MARK}", p) for p in known)


def parse_model(data: bytes) -> Model:
    """The parts of a model file that decide how it encodes."""
    pieces: list[tuple[str, float, int]] = []
    trainer: dict[int, int | bytes] = {}
    normal: dict[int, int | bytes] = {}
    for number, value in _fields(data):
        if number == 1:
            own = dict(_fields(value))
            score = struct.unpack("<f", own[2])[0] if 2 in own else 0.0
            pieces.append((own.get(1, b"").decode(), score, own.get(3, NORMAL)))
        elif number in (2, 3):
            (trainer if number == 2 else normal).update(_fields(value))
    return Model(
        pieces=pieces, kind=trainer.get(3, UNIGRAM), byte_fallback=bool(trainer.get(35, 0)),
        unk_id=next((n for n, p in enumerate(pieces) if p[2] == UNKNOWN), 0), charsmap=normal.get(2, b""),
        dummy_prefix=bool(normal.get(3, 1)), trims=bool(normal.get(4, 1)), escapes=bool(normal.get(5, 1)), suffix=bool(trainer.get(24, 0)),
    )


def _merges(pieces: dict[str, tuple[int, float]]) -> list[tuple[str, str]]:
    """Pairs of pieces that make a piece, the best scored piece first."""
    found = []
    for piece, (n, score) in pieces.items():
        for cut in range(1, len(piece)):
            left, right = piece[:cut], piece[cut:]
            if left in pieces and right in pieces:
                found.append((-score, n, pieces[left][0], pieces[right][0], left, right))
    return [(left, right) for *_, left, right in sorted(found)]


def normalizer(model: Model) -> normalizers.Normalizer:
    steps: list = []
    if model.charsmap:
        steps.append(normalizers.Precompiled(model.charsmap))
    if model.trims:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Replace(Regex(r"\A | \z"), "")]
    if model.dummy_prefix and not model.suffix:
        steps.append(normalizers.Prepend(" "))
    if model.escapes:
        steps.append(normalizers.Replace(" ", MARK))
        if model.trims:
            steps.append(normalizers.Replace(Regex(rf"{MARK}+\z"), ""))
    return normalizers.Sequence(steps)


def build_tokenizer(model: Model) -> Tokenizer:
    """A tokenizer that encodes normalised text; normalising is a step of its own, see :func:`normalizer`."""
    if model.kind == UNIGRAM:
        inner = models.Unigram([(p, s) for p, s, _ in model.pieces], model.unk_id, model.byte_fallback)
    elif model.kind == BPE:
        if any(kind == UNUSED for *_, kind in model.pieces):
            raise ValueError("BPE models with unused pieces are not supported")
        plain = {p: (n, s) for n, (p, s, kind) in enumerate(model.pieces) if kind in (NORMAL, USER_DEFINED)}
        inner = models.BPE(
            {p: n for n, (p, *_) in enumerate(model.pieces)}, _merges(plain), unk_token=model.pieces[model.unk_id][0],
            fuse_unk=True, byte_fallback=model.byte_fallback,
        )
    else:
        raise ValueError(f"models of type {model.kind} are not supported")
    tokenizer = Tokenizer(inner)
    steps: list = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    if model.dummy_prefix or model.trims:
        steps.append(decoders.Strip(" ", ALL_BLANKS if model.trims else 1, 0))
    tokenizer.decoder = decoders.Sequence(steps)
    return tokenizer


def _looked_up(known: dict, rows: list[list], learn: Callable[[list], None]) -> list[list]:
    """What ``known`` has for the members of each row, new ones learned first."""
    found = [list(map(known.get, row)) for row in rows]
    new = [n for n, own in enumerate(found) if None in own]
    if new:
        learn(list({m for n in new for m, o in zip(rows[n], found[n]) if o is None}))
        for n in new:
            found[n] = list(map(known.__getitem__, rows[n]))
    return found


class Codec:
    """Encoding and decoding by a model file, words remembered."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            data = file.read()
        self.model = parse_model(data)
        self.normalizer = normalizer(self.model)
        self.tokenizer = build_tokenizer(self.model)
        self.judge = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.controls = {n for n, (*_, kind) in enumerate(self.model.pieces) if kind == CONTROL}
        self.surface = [
            b"" if kind == CONTROL else bytes([int(p[3:5], 16)]) if kind == BYTE else p.replace(MARK, " ").encode() for p, _, kind in self.model.pieces
        ]
        self.words: dict[str, bytes] = {}
        self.differs: set[str] = set()
        self.pattern = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
        self.whole = re.compile(f"{MARK}[^{MARK}]+")
        if self.model.splits:
            self.tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(self.pattern.pattern), "isolated")

    def _judged(self, word: str) -> list[int]:
        """Ids of a normalised word inside a text, by the sentencepiece library, which marks a text's start itself."""
        if word == MARK:
            return [self.judge.piece_to_id(MARK)]
        return self.judge.encode(word[1:] if self.model.dummy_prefix else word)

    def _keep(self, word: str, ids: list[int], wanted: list[int]) -> None:
        if ids != wanted:
            self.differs.add(word)
        self.words[word] = np.array(wanted, dtype="<u4").tobytes()

    def learn(self, words: list[str]) -> None:
        """Encode new words, many to a line and many lines in one multithreaded call, and hold them against the other library."""
        inside = [w for w in words if self.whole.fullmatch(w)] if self.model.dummy_prefix else []
        lines = [inside[n:n + WORDS_A_LINE] for n in range(0, len(inside), WORDS_A_LINE)]
        for start in range(0, len(lines), LINES_AT_ONCE):
            part = lines[start:start + LINES_AT_ONCE]
            joined = ["".join(line) for line in part]
            judged = self.judge.encode([j[1:] for j in joined])
            for line, found, wanted in zip(part, self.tokenizer.encode_batch(joined, add_special_tokens=False), judged):
                ids, ends = found.ids, np.searchsorted(np.array(found.word_ids), np.arange(len(line)), side="right").tolist()
                if ids == wanted:
                    packed = np.array(ids, dtype="<u4").tobytes()
                    self.words.update((w, packed[4 * a:4 * b]) for w, a, b in zip(line, [0, *ends], ends))
                else:
                    for w, a, b in zip(line, [0, *ends], ends):
                        self._keep(w, ids[a:b], self._judged(w))
        for word in set(words).difference(self.words):
            self._keep(word, self.tokenizer.encode(word, add_special_tokens=False).ids, self._judged(word))

    def encode(self, texts: list[str], normal: list[str] | None = None) -> tuple[list[bytes], list[bool]]:
        """Ids of each text as little-endian 32-bit numbers, and whether both libraries agree on its normal form and all its words.

        ``normal`` are the texts as the sentencepiece library normalises them, where that is known.
        """
        if len(self.words) > REMEMBERED:
            self.words.clear()
            self.differs.clear()
        marked = [self.normalizer.normalize_str(t) for t in texts]
        if not self.model.splits:
            found = [e.ids for e in self.tokenizer.encode_batch_fast(marked, add_special_tokens=False)]
            wanted = self.judge.encode(texts)
            return [np.array(w, dtype="<u4").tobytes() for w in wanted], [f == w for f, w in zip(found, wanted)]
        normal = self.judge.normalize(texts) if normal is None else normal
        alike = [m == n for m, n in zip(marked, normal)]
        # of a text on which the normal forms differ the library's counts, as its ids do
        cut = [self.pattern.findall(n) for n in normal]
        found = _looked_up(self.words, cut, self.learn)
        same = [a and (not self.differs or self.differs.isdisjoint(words)) for a, words in zip(alike, cut)]
        return [b"".join(ids) for ids in found], same

    def come_back(self, normal: list[str], ids: list[bytes]) -> list[bool]:
        """Whether both libraries' decoding of each row of ids gives its text, ``normal`` as the sentencepiece library normalises it."""
        rows = [np.frombuffer(i, dtype="<u4").tolist() for i in ids]
        wanted = [n.replace(MARK, " ") for n in normal]
        if self.model.dummy_prefix:
            wanted = [w.removeprefix(" ") for w in wanted]
        return [self.decode(r) == d == w for r, d, w in zip(rows, self.judge.decode(rows), wanted)]

    def comes_back(self, text: str, ids: bytes) -> bool:
        """:meth:`come_back` of one raw text."""
        return self.come_back([self.judge.normalize(text)], [ids])[0]

    def decode(self, ids: list[int]) -> str:
        """The text of some ids by the pieces of the model file; control pieces have none."""
        try:
            text = b"".join(map(self.surface.__getitem__, ids)).decode()
        except UnicodeDecodeError:  # bytes that are no character: the tokenizers library says what stands for them
            return self.tokenizer.decode([i for i in ids if i not in self.controls], skip_special_tokens=False)
        if self.model.trims:
            return text.lstrip(" ")
        return text.removeprefix(" ") if self.model.dummy_prefix else text


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The worker's own codec, which outlives a task."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


#: Texts encoded in one call.
TEXTS_AT_ONCE = 500


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """``docs`` with ids array<int> and agrees boolean; a null text counts as empty and has no ids."""

    @F.pandas_udf("ids array<int>, agrees boolean")
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = codec(model_path)
        for texts in batches:
            parts = [own.encode(texts.iloc[n:n + TEXTS_AT_ONCE].tolist()) for n in range(0, len(texts), TEXTS_AT_ONCE)]
            ids = [np.frombuffer(i, dtype="<u4").astype(np.int32) for found, _ in parts for i in found]
            yield pd.DataFrame({"ids": pd.Series(ids, dtype=object), "agrees": [a for _, same in parts for a in same]})

    own = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("ids", "agrees")]
    return docs.select(*own, encoded(F.coalesce("text", F.lit(""))).alias("_found")).select(*own, "_found.*")


def decode(ids: Column, model_path: str) -> Column:
    """The text of a column of ids; null stays null."""

    @F.pandas_udf("string")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec(model_path)
        for rows in batches:
            yield pd.Series([None if r is None else own.decode([int(i) for i in r]) for r in rows], dtype=object)

    return decoded(ids)


def encode_and_verify(docs: DataFrame, model_path: str) -> DataFrame:
    """``docs`` with n_tokens, ids_crc32 (little-endian 32-bit ids), agrees, and comes_back: whether decoding the ids gives the text.

    ``agrees`` says that both libraries normalise the whole text alike and encode
    its words alike, ``comes_back`` that both decode the ids alike and to the
    text.  Where a model trims or maps characters, a text comes back as its
    normalised form.
    """

    @F.pandas_udf("n_tokens long, ids_crc32 long, agrees boolean, comes_back boolean")
    def verified(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = codec(model_path)
        for texts in batches:
            parts = []
            for n in range(0, len(texts), TEXTS_AT_ONCE):
                some = texts.iloc[n:n + TEXTS_AT_ONCE].tolist()
                normal = own.judge.normalize(some)
                found, same = own.encode(some, normal)
                parts += [(len(i) // 4, crc32(i), a, c) for i, a, c in zip(found, same, own.come_back(normal, found))]
            yield pd.DataFrame(parts, columns=["n_tokens", "ids_crc32", "agrees", "comes_back"])

    own = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("n_tokens", "ids_crc32", "agrees", "comes_back")]
    return docs.select(*own, verified(F.coalesce("text", F.lit(""))).alias("_found")).select(*own, "_found.*")
