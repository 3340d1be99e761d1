"""Document vectors from a pluggable provider, one model per Python worker."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import embed_input
from ..schema import VECTOR

# Fixed value: texts handed to a provider at a time.
BATCH_SIZE = 50


class Provider(Protocol):
    def embed_documents(self, texts: list[str]) -> list: ...


class HashingProvider:
    """Words hashed into a unit vector: deterministic, no model, for tests and dry runs."""

    def __init__(self, dimension: int = 1024):
        self.dimension = dimension

    def embed_documents(self, texts: list[str]) -> list:
        vectors = np.zeros((len(texts), self.dimension), dtype=np.float32)
        for row, text in enumerate(texts):
            for word in text.lower().split():
                h = int(hashlib.md5(word.encode()).hexdigest()[:8], 16)
                vectors[row, h % self.dimension] += 1.0 if h >> 31 else -1.0
        norms = np.linalg.norm(vectors, axis=1, keepdims=True)
        return list(vectors / np.where(norms == 0, 1, norms))


class SingleTextProvider:
    """Adapts a client that embeds one text a call: a few calls at once.

    A text longer than ``max_chars`` is embedded in parts; its vector is their
    mean by length, so that no part of it is left out.
    """

    def __init__(self, embed_one: Callable[[str], list[float]], workers: int = 8, max_chars: int | None = None):
        self._embed_one, self._workers, self._max_chars = embed_one, workers, max_chars

    def embed_documents(self, texts: list[str]) -> list:
        most = self._max_chars
        parts = [[t[n : n + most] for n in range(0, len(t), most)] or [t] if most else [t] for t in texts]
        with ThreadPoolExecutor(self._workers) as pool:
            done = iter(pool.map(self._embed_one, [p for own in parts for p in own]))
        vectors = []
        for own in parts:
            found = [next(done) for _ in own]
            vectors.append(found[0] if len(own) == 1 else np.average(found, axis=0, weights=[len(p) for p in own]).tolist())
        return vectors


def embedder(make_provider: Callable[[], Provider]) -> Callable[[Column], Column]:
    """A column function text -> vector.  The provider is made once per worker task and called
    with batches; only the text column crosses into Python."""

    @F.pandas_udf(VECTOR)
    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        provider = make_provider()
        for texts in batches:
            found: list = [None] * len(texts)
            present = np.flatnonzero(texts.notna())
            for start in range(0, len(present), BATCH_SIZE):
                part = present[start : start + BATCH_SIZE]
                vectors = provider.embed_documents(texts.iloc[part].tolist())
                for at, vector in zip(part, vectors):
                    found[at] = np.asarray(vector, dtype=np.float32).tolist()
            yield pd.Series(found, dtype=object)

    return embed


def embed_documents(documents: DataFrame, make_provider: Callable[[], Provider], reason: str = "reason") -> DataFrame:
    """Fill ``embedding`` from title and text; refused rows are not sent to the provider."""
    wanted = embed_input("title", "text_content")
    if reason in documents.columns:
        wanted = f"if({reason} is null, {wanted}, null)"
    return documents.withColumn("embedding", embedder(make_provider)(F.expr(wanted)))
