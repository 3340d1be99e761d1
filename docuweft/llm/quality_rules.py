"""Rules on a text's words and lines, and a calibrated model over hashed n-grams of words and characters."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fit_logistic, labelled_sample, sigmoid

#: Labelled documents of each class the model is fitted on, at most.
PER_CLASS = 2000
#: Documents whose id has this remainder calibrate; the others fit the weights.
CALIBRATION = "pmod(crc32(encode(cast(doc_id as string), 'UTF-8')) div 4, 3) = 0"
#: Hash buckets of word n-grams, and as many of character n-grams.
BUCKETS = 1 << 16
#: Bytes of a character n-gram.
CHARS = 4
#: Steps of the fit and their size.
STEPS, RATE, RIDGE = 120, 0.5, 1e-6
#: Probability from which a text is kept.
THRESHOLD = 0.5
#: Fixed: the rules' limits.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

_SYMBOLS = re.compile(r"[#*$%&|<>]")
_BLANK = b" \t\n\x0b\x0c\r"
_MIX = np.uint32(2654435761)


def _buckets(data: bytes, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text's words and word pairs, and of its character n-grams."""
    one = np.fromiter(map(crc32, words), np.uint32, len(words))
    pairs = (one[:-1] * _MIX) ^ one[1:]
    shift = np.uint32(32 - BUCKETS.bit_length() + 1)
    by_word = (np.concatenate([one, pairs]) * _MIX) >> shift
    raw = np.frombuffer(data, np.uint8)
    code = np.zeros(max(0, len(raw) - CHARS + 1), np.uint32)
    for at in range(CHARS):
        code |= raw[at:at + len(code)].astype(np.uint32) << np.uint32(8 * at)
    return by_word, (code * _MIX) >> shift


def _frequencies(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(feature, share of the n-grams of its sort) of a text, each feature once."""
    data = text.encode()
    index, value = [], []
    for offset, found in zip((0, BUCKETS), _buckets(data, data.split())):
        own, count = np.unique(found, return_counts=True)
        index.append(own.astype(np.int64) + offset)
        value.append(count / max(1, len(found)))
    return np.concatenate(index), np.concatenate(value)


@dataclass(frozen=True)
class NgramModel:
    weights: np.ndarray
    slope: float
    intercept: float

    def margin(self, data: bytes, words: list[bytes]) -> float:
        by_word, by_char = _buckets(data, words)
        total = float(self.weights[by_word].mean()) if len(by_word) else 0.0
        return total + (float(self.weights[BUCKETS:][by_char].mean()) if len(by_char) else 0.0)

    def probability(self, margins: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * margins + self.intercept)


def _fit(texts: list[str], good: np.ndarray) -> np.ndarray:
    """Weights by logistic regression, both classes weighing the same, with a step size per feature."""
    weights = np.zeros(2 * BUCKETS)
    if len(texts) == 0 or good.min() == good.max():
        return weights
    rows = [_frequencies(t) for t in texts]
    sizes = np.array([len(i) for i, _ in rows])
    feature, value = (np.concatenate([r[k] for r in rows]) for k in (0, 1))
    row = np.repeat(np.arange(len(rows)), sizes)
    share = np.where(good == 1, 0.5 / max(1, (good == 1).sum()), 0.5 / max(1, (good == 0).sum()))
    seen = np.full(len(weights), 1e-12)
    bias = 0.0
    for _ in range(STEPS):
        margin = np.bincount(row, weights=value * weights[feature], minlength=len(rows)) + bias
        error = share * (sigmoid(margin) - good)
        gradient = np.bincount(feature, weights=value * error[row], minlength=len(weights)) + RIDGE * weights
        seen += gradient**2
        weights -= RATE * gradient / np.sqrt(seen)
        bias -= RATE * error.sum()
    return weights


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", where: str = "true", per_class: int = PER_CLASS) -> NgramModel:
    """A model fitted on at most ``per_class`` labelled documents of each class whose doc_id meets ``where``.

    A third of them calibrates.  Without labels of both classes every text has probability one half.
    """
    sample = labelled_sample(docs, labels, label, per_class, where).withColumn("calibrates", F.expr(CALIBRATION))
    rows = sample.select("text", "label", "calibrates", F.xxhash64("doc_id").alias("at")).toPandas().sort_values(["at", "text"])
    fits, held = rows[~rows["calibrates"]], rows[rows["calibrates"]]
    weights = _fit(fits["text"].tolist(), fits["label"].to_numpy()).astype(np.float32)
    model = NgramModel(weights, 1.0, 0.0)
    margins = np.array([model.margin(d, d.split()) for d in map(str.encode, held["text"])])
    slope, intercept = fit_logistic(margins[:, None], held["label"].to_numpy(), ridge=1e-7)
    return NgramModel(weights, float(slope), float(intercept))


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more, the first of them included, each word once."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    count: dict[tuple, int] = {}
    for w in windows:
        count[w] = count.get(w, 0) + 1
    inside = np.zeros(len(words), bool)
    at = np.flatnonzero(np.fromiter((count[w] > 1 for w in windows), bool, len(windows)))
    for step in range(3):
        inside[at + step] = True
    return int(inside.sum())


def text_counts(text: str, data: bytes, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """Words, their code points, symbols, repeated lines with a word, repeated words."""
    lines = [line for line in text.split("\n") if line.strip(" \t\x0b\x0c\r")]
    blanks = sum(data.count(c) for c in _BLANK)
    return len(words), len(text) - blanks, len(_SYMBOLS.findall(text)), len(lines) - len(set(lines)), repeated_words(words)


def judge_quality(docs: DataFrame, model: NgramModel, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, probability and kept.

    Words are runs without ASCII white space.  A null text has none of
    anything and fails.  Columns of ``docs`` with these names give way.
    """
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    layout = ", ".join(f"{c} long" for c in counts) + ", probability double"

    @F.pandas_udf(layout)
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows, margins = [], []
            for text in texts:
                data = text.encode()
                words = data.split()
                rows.append(text_counts(text, data, words))
                margins.append(model.margin(data, words))
            out = pd.DataFrame(rows, columns=list(counts), dtype="int64")
            yield out.assign(probability=model.probability(np.array(margins, dtype=float)))

    taken = {*counts, "base_failed", "probability", "kept"}
    own = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in taken]
    found = docs.select(*own, judge(F.coalesce("text", F.lit(""))).alias("_found")).select(*own, "_found.*")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return found.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("probability") >= threshold))
