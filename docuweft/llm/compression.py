"""Text quality by compression: which of two zstandard dictionaries, of good and of bad texts, shrinks a text better.

A text is cut into blocks that are compressed one by one with either dictionary,
so that it helps alike in short and in long texts.  The feature is the difference
of the two sizes over the number of bytes; a logistic curve fitted on labelled
texts that no dictionary has seen turns it into a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fit_logistic, labelled_sample, sigmoid

#: Labelled documents of each class a model is fitted on, at most.
PER_CLASS = 4000
#: Bytes of a dictionary, at most, and of the blocks it is made from and applied to.
DICTIONARY_BYTES = 256 << 10
BLOCK_BYTES = 1024
#: A dictionary has at most this part of the smaller class's bytes; both have the same size, so that neither gains by it.
DICTIONARY_PART = 8
#: Bytes of a class's texts its dictionary is chosen from, at most.
TRAINING_BYTES = 24 << 20
LEVEL = 3
#: Documents whose id has this remainder of its crc32 calibrate; the others fill the dictionaries.
CALIBRATION = "pmod(crc32(encode(cast(doc_id as string), 'UTF-8')) div 4, 3) = 0"
#: From this score on a text counts as good.
THRESHOLD = 0.7


def blocks_of(text: str) -> list[bytes]:
    data = text.encode()
    return [data[i:i + BLOCK_BYTES] for i in range(0, len(data), BLOCK_BYTES)]


@dataclass(frozen=True)
class CompressionModel:
    good: bytes
    bad: bytes
    slope: float
    intercept: float

    def scorer(self):
        """A function from texts to their scores between 0 and 1."""
        sizes = _measure(self.good, self.bad)
        return lambda texts: sigmoid(self.slope * sizes(texts) + self.intercept)


def _measure(good: bytes, bad: bytes):
    """A function from texts to (size with bad - size with good) / bytes; 0 for an empty text."""
    def packer(content: bytes):
        if not content:
            return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
        kept = zstandard.ZstdCompressionDict(content)
        kept.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=kept, write_content_size=False, write_dict_id=False)

    with_good, with_bad = packer(good), packer(bad)

    def measure(texts: list[str | None]) -> np.ndarray:
        out = np.zeros(len(texts))
        for n, text in enumerate(texts):
            blocks = blocks_of(text or "")
            if blocks:
                more = sum(len(with_bad.compress(b)) for b in blocks) - sum(len(with_good.compress(b)) for b in blocks)
                out[n] = more / sum(map(len, blocks))
        return out

    return measure


def _dictionaries(classes: list[list[bytes]]) -> list[bytes]:
    """A trained dictionary of the same size for each class; none where texts are too few to train one."""
    size = min(DICTIONARY_BYTES, min(sum(map(len, blocks)) for blocks in classes) // DICTIONARY_PART)
    try:
        return [zstandard.train_dictionary(size, blocks, level=LEVEL).as_bytes() for blocks in classes]
    except zstandard.ZstdError:
        return [b"" for _ in classes]


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", where: str = "true", per_class: int = PER_CLASS) -> CompressionModel:
    """A model fitted on at most ``per_class`` labelled documents of each class whose doc_id meets ``where``.

    Without labels of both classes, or with too few texts to train a dictionary
    on, every text scores the same.
    """
    sample = labelled_sample(docs, labels, label, per_class, where).withColumn("calibrates", F.expr(CALIBRATION))
    rows = sample.select("text", "label", "calibrates", F.xxhash64("doc_id").alias("at")).toPandas().sort_values(["at", "text"])
    classes: list[list[bytes]] = []
    for value in (1, 0):
        blocks, taken = [], 0
        for text in rows[(rows["label"] == value) & ~rows["calibrates"]]["text"]:
            for block in blocks_of(text) if taken < TRAINING_BYTES else ():
                blocks.append(block)
                taken += len(block)
        classes.append(blocks)
    parts = _dictionaries(classes)
    held = rows[rows["calibrates"]]
    slope, intercept = fit_logistic(_measure(*parts)(held["text"].tolist())[:, None], held["label"].to_numpy(), ridge=1e-7)
    return CompressionModel(*parts, float(slope), float(intercept))


def score_quality(docs: DataFrame, model: CompressionModel, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score double and predicted int, which replace columns of these names; null and empty texts are scored too."""
    own = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("score", "predicted")]

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = model.scorer()
        for texts in batches:
            yield pd.Series(scorer(texts.tolist()))

    scored = docs.select(*own, score(F.coalesce("text", F.lit(""))).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
