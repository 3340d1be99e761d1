"""Token sequences of a fixed length with little padding, by best fit decreasing."""

from __future__ import annotations

import json
import re
import struct
from array import array
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from ..session import written
from .word_memo import WordMemo

#: Tokens of a sequence, and the id that ends a document.
WINDOW = 2048
END_ID = 1
#: Pieces that are packed together, about.
GROUP = 16_384
#: Parts of words of a generation, about; a worker remembers two, and of the older one those come along that are met again.
REMEMBERED = 75_000
#: Texts encoded together.
TEXTS_AT_ONCE = 256
#: Words encoded in one call.
WORDS_AT_ONCE = 10_000

#: Fixed: how the tokenizer file says that it lower-cases and splits words.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"},
]}
PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": _PATTERN}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]}
#: Words the same split of which is made here, and that split of them in lower case; special tokens are none of them.
PLAIN = re.compile("(?!.*<\\|)[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
SPLIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+")


class WordTokens:
    """Ids of texts as little-endian 32-bit numbers, by a tokenizer that never joins what white space parts.

    Texts are split at ASCII white space and each word is encoded once, then
    remembered: the ids of a text are those of its words in a row.  Words of
    plain Latin letters, digits and signs are lower-cased and split here, as a
    tokenizer of this make would, so that their parts are shared between words;
    all others go through the whole tokenizer.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        parts = json.loads(self.tokenizer.to_str())
        self.splits_here = parts["normalizer"] == NORMALIZER and parts["pre_tokenizer"] == PRE_TOKENIZER
        self.encode_part = self.tokenizer.model.tokenize
        as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.byte_marks = {c: as_bytes.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x100)}
        self.parts: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.memo = WordMemo(self.learn)

    def _part(self, part: str) -> bytes:
        found = self.parts.get(part)
        if found is None:
            found = self.before.get(part)
            if found is None:
                ids = [t.id for t in self.encode_part(part.translate(self.byte_marks))]
                found = struct.pack(f"<{len(ids)}I", *ids)
            if len(self.parts) >= REMEMBERED:
                self.before, self.parts = self.parts, {}
            self.parts[part] = found
        return found

    def learn(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word."""
        learned, others = [b""] * len(words), []
        for n, word in enumerate(words):
            text = word.decode()
            if self.splits_here and PLAIN.fullmatch(text):
                learned[n] = b"".join(map(self._part, SPLIT.findall(text.lower())))
            else:
                others.append((n, text))
        for start in range(0, len(others), WORDS_AT_ONCE):
            part = others[start:start + WORDS_AT_ONCE]
            found = self.tokenizer.encode([t for _, t in part], is_pretokenized=True, add_special_tokens=False)
            ids, of_word = np.array(found.ids, dtype="<u4"), np.array(found.word_ids, dtype=np.int64)
            ends = np.searchsorted(of_word, np.arange(len(part)), side="right").tolist()
            for (n, _), a, b in zip(part, [0, *ends], ends):
                learned[n] = ids[a:b].tobytes()
        return learned

    def encode_all(self, texts: list[str]) -> list[bytes]:
        return [ids.tobytes() for ids in self.memo.encode(texts)]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]


_TOKENS: dict[str, WordTokens] = {}


def word_tokens(path: str) -> WordTokens:
    """The worker's own encoder, which outlives a task."""
    if path not in _TOKENS:
        _TOKENS[path] = WordTokens(path)
    return _TOKENS[path]


def pieces_of(ids: bytes, window: int) -> Iterator[tuple[int, int, int]]:
    """(start, length, crc32) of the windows a document is cut into, all full but the last."""
    for start in range(0, len(ids), 4 * window):
        part = ids[start:start + 4 * window]
        yield start // 4, len(part) // 4, crc32(part)


def token_pieces(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens) of every piece of every row; a null text is empty."""
    layout = docs.select("doc_id").selectExpr("doc_id", *[f"0L as {c}" for c in ("start", "length", "ids_crc32", "doc_tokens")]).schema
    last = end_id.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = word_tokens(tokenizer_path)
        for batch in batches:
            rows: list[tuple[int, int, int, int, int]] = []
            for start in range(0, batch.num_rows, TEXTS_AT_ONCE):
                texts = [t or "" for t in batch.column("text").slice(start, TEXTS_AT_ONCE).to_pylist()]
                for n, ids in enumerate(tokens.encode_all(texts), start):
                    ids += last
                    rows += [(n, *piece, len(ids) // 4) for piece in pieces_of(ids, window)]
            at, *columns = (pa.array(c, pa.int64()) for c in zip(*rows)) if rows else [pa.array([], pa.int64())] * 5
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(at), *columns], names=layout.fieldNames())

    return docs.select("doc_id", "text").mapInArrow(cut, layout)


class OpenWindows:
    """Open windows by the room they have left: a segment tree over rooms, each with its windows."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.any = bytearray(2 * self.leaves)
        self.at: list[list[int]] = [[] for _ in range(window + 1)]

    def _set(self, room: int, there: bool) -> None:
        node = room + self.leaves
        self.any[node] = there
        while node > 1:
            node >>= 1
            now = self.any[2 * node] | self.any[2 * node + 1]
            if self.any[node] == now:
                break
            self.any[node] = now

    def add(self, room: int, number: int) -> None:
        if room:
            self.at[room].append(number)
            if len(self.at[room]) == 1:
                self._set(room, True)

    def take(self, length: int) -> tuple[int, int] | None:
        """(room, number) of a window with the least room of those that have ``length``, taken out."""
        node = length + self.leaves
        if not self.any[node]:
            while node > 1 and (node & 1 or not self.any[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.any[2 * node] else 2 * node + 1
        room = node - self.leaves
        number = self.at[room].pop()
        if not self.at[room]:
            self._set(room, False)
        return room, number


def best_fit(lengths: list[int], window: int) -> tuple[array, array]:
    """(window number, offset) of each piece, given in falling order of length."""
    free, used = OpenWindows(window), 0
    numbers, offsets = array("q"), array("q")
    for length in lengths:
        found = free.take(length) if length < window else None
        if found is None:
            found, used = (window, used), used + 1
        room, number = found
        numbers.append(number)
        offsets.append(window - room)
        free.add(room - length, number)
    return numbers, offsets


def pack(pieces: DataFrame, window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """``pieces`` (length, and any other columns) with sequence_id long and offset long.

    Pieces are dealt evenly into groups of about ``group``; each is packed
    alone, which leaves a few windows per group that are not full.  ``pieces``
    is a written table: it is read twice and dealt out by the place of its rows.
    """
    groups = max(1, -(-pieces.count() // group))
    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)).cast("long"))
    layout = pieces.selectExpr("*", "0L as sequence_id", "0L as offset").schema

    def packed(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("length", ascending=False, kind="stable")
        numbers, offsets = best_fit(rows["length"].tolist(), window)
        first = int(rows["_group"].iloc[0]) << 32
        placed = rows.assign(sequence_id=first + np.array(numbers, dtype=np.int64), offset=np.array(offsets, dtype=np.int64))
        return placed[layout.fieldNames()]

    return dealt.groupBy("_group").applyInPandas(packed, layout)


def pack_documents(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of every piece of every row of ``docs``."""
    return pack(written(token_pieces(docs, tokenizer_path, window, end_id), "pieces"), window)
