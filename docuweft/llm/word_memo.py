"""Ids of words that were encoded before, in one table of numbers that is looked up for many words at once.

Texts are split at ASCII white space.  A word is known by two hashes of its
bytes, 96 bits together, so that no word is kept as an object of its own: a
remembered word takes about 40 bytes.  Hashes are sums of random numbers, one
for each byte at each place of a word, made by gathers over a whole block.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np

#: Places of the table, a power of two, and the share of them that is used before all are forgotten.
PLACES = 1 << 21
FULL = 0.75
#: Bytes of the longest word that is remembered.
LONGEST = 64
#: Bytes of text, about, whose words are looked up together.
BYTES_AT_ONCE = 1 << 18
#: Fixed: white space between words.
BLANK = re.compile(rb"[\x20\x09-\x0D]")

_IN_WORD = np.array([BLANK.match(bytes([c])) is None for c in range(256)])
_RANDOM = np.random.default_rng(42).integers(1, 1 << 64, (2, LONGEST * 256), dtype=np.uint64)


class WordMemo:
    """Ids of texts as the ids of their words in a row; ``learn`` gives those of a list of words, as little-endian 32-bit numbers."""

    def __init__(self, learn: Callable[[list[bytes]], list[bytes]], places: int = PLACES):
        self.learn, self.mask = learn, places - 1
        self.limit = int(places * FULL)
        self.keys = np.zeros(places, np.uint64)
        self.checks = np.zeros(places, np.uint32)
        self.firsts = np.zeros(places, np.int32)
        self.counts = np.zeros(places, np.uint16)
        self.ids = np.empty(1 << 16, "<u4")
        self.words = self.used = 0

    def _forget(self) -> None:
        self.keys[:] = 0
        self.words = self.used = 0

    def _keep_ids(self, ids: np.ndarray) -> int:
        """Where ``ids`` stand from now on."""
        first, self.used = self.used, self.used + len(ids)
        if self.used > len(self.ids):
            grown = np.empty(max(2 * len(self.ids), self.used), "<u4")
            grown[:first] = self.ids[:first]
            self.ids = grown
        self.ids[first:self.used] = ids
        return first

    def _find(self, keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """The place of each key, -1 where it is not known."""
        found = np.full(len(keys), -1, np.int64)
        place = (keys & np.uint64(self.mask)).astype(np.int64)
        left = np.arange(len(keys))
        while len(left):
            there = self.keys[place]
            hit = (there == keys[left]) & (self.checks[place] == checks[left])
            found[left[hit]] = place[hit]
            on = ~hit & (there != 0)
            left, place = left[on], place[on] + 1 & self.mask
        return found

    def _add(self, keys: np.ndarray) -> np.ndarray:
        """Free places for keys that are not known and all different."""
        taken = np.empty(len(keys), np.int64)
        place = (keys & np.uint64(self.mask)).astype(np.int64)
        left = np.arange(len(keys))
        while len(left):
            free = self.keys[place] == 0
            self.keys[place[free]] = keys[left[free]]  # of several keys at one place one stays
            won = free & (self.keys[place] == keys[left])
            taken[left[won]] = place[won]
            left, place = left[~won], place[~won] + 1 & self.mask
        self.words += len(keys)
        return taken

    def _block(self, block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, number of ids) of each word of a block, and all ids."""
        raw = np.frombuffer(block, np.uint8)
        inside = np.zeros(len(raw) + 2, np.int8)
        inside[1:-1] = _IN_WORD[raw]
        edges = np.flatnonzero(np.diff(inside))
        starts, lengths = edges[::2], edges[1::2] - edges[::2]
        if not len(starts):
            return starts, starts, np.empty(0, "<u4")
        heads = np.cumsum(lengths) - lengths
        at = np.flatnonzero(inside[1:-1])
        bytes_at = np.minimum(at - np.repeat(starts, lengths), LONGEST - 1) << 8 | raw[at]
        keys = np.maximum(np.add.reduceat(_RANDOM[0][bytes_at], heads), np.uint64(1))
        checks = (np.add.reduceat(_RANDOM[1][bytes_at], heads) >> np.uint64(32)).astype(np.uint32)

        if self.words + len(starts) > self.limit:
            self._forget()
        place = self._find(keys, checks)
        new = np.flatnonzero((place < 0) & (lengths <= LONGEST))
        different, at_new, same = np.unique(keys[new], return_index=True, return_inverse=True)
        one = new[at_new]
        place_of = self._add(different)
        # the two hashes agree for equal words only; should one alone agree, the word is encoded by itself
        agrees = checks[new] == checks[one][same]
        place[new[agrees]] = place_of[same[agrees]]
        alone = np.flatnonzero(place < 0)
        ask = np.concatenate([one, alone])
        ids = self.learn([block[a:a + n] for a, n in zip(starts[ask].tolist(), lengths[ask].tolist())])
        sizes = np.fromiter((len(i) // 4 for i in ids), np.int64, len(ids))
        kept = sizes[:len(one)]
        self.firsts[place_of] = self._keep_ids(np.frombuffer(b"".join(ids[:len(one)]), "<u4")) + np.cumsum(kept) - kept
        self.counts[place_of], self.checks[place_of] = kept, checks[one]

        firsts, counts = self.firsts[place].astype(np.int64), self.counts[place].astype(np.int64)
        others = sizes[len(one):]
        counts[alone], firsts[alone] = others, self.used + np.cumsum(others) - others
        source = self.ids[:self.used]
        if len(alone):
            source = np.concatenate([source, np.frombuffer(b"".join(ids[len(one):]), "<u4")])
        from_at = np.repeat(firsts - (np.cumsum(counts) - counts), counts)
        return starts, counts, source[from_at + np.arange(len(from_at))]

    def _blocks(self, joined: bytes) -> Iterator[tuple[int, bytes]]:
        """(start, bytes) of blocks that end at white space."""
        start = 0
        while start < len(joined):
            end = BLANK.search(joined, min(start + BYTES_AT_ONCE, len(joined)))
            stop = end.start() if end else len(joined)
            yield start, joined[start:stop]
            start = stop + 1

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        data = [t.encode() for t in texts]
        begins = np.cumsum([0, *(len(d) + 1 for d in data)])[:-1]
        parts, sizes = [np.empty(0, "<u4")], np.zeros(len(texts), np.int64)
        for start, block in self._blocks(b" ".join(data)):
            at, counts, ids = self._block(block)
            owner = np.searchsorted(begins, start + at, side="right") - 1
            sizes += np.bincount(owner, weights=counts, minlength=len(texts)).astype(np.int64)
            parts.append(ids)
        return np.split(np.concatenate(parts), np.cumsum(sizes)[:-1]) if texts else []
