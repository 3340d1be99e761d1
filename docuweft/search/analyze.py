"""Text to terms: word tokens, synonyms, stop words and stems, and counts per document."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import let
from .stemming import stem

# Synonym groups and English stop words.
SYNONYM_GROUPS = (
    "po, purchase order",
    "so, sales order",
    "do, delivery order",
    "grn, goods receipt, goods received note",
    "rfq, request for quotation, request for quote",
    "bom, bill of materials",
    "je, journal entry",
    "cn, credit note",
    "dn, debit note",
    "vra, vendor return",
    "inv, invoice",
)
STOP_WORDS = frozenset(
    "a an and are as at be but by for if in into is it no not of on or such that the their then"
    " there these they this to was will with".split()
)
#: Longest token; what is longer is cut into several.
LONGEST = 255
#: Words whose terms a worker remembers; beyond, it starts anew.
REMEMBERED = 100_000

# Word tokens by the Unicode word-break rules: letters joined over . : · or an
# apostrophe, digits joined over . , ; or an apostrophe, ideographs on their own.
_IDEO = r"\p{IsHan}\p{IsHiragana}"
_L = rf"[\p{{L}}\p{{M}}&&[^{_IDEO}]]"
_N = r"\p{N}"
TOKEN = rf"[{_IDEO}]|(?:{_L}+(?:[.:·'’]{_L}+)*|{_N}+(?:[.,;'’]{_N}+)*|_+)+"


@dataclass(frozen=True)
class Analyzer:
    """Steps after tokenizing and lower-casing, in this order."""

    possessive: bool = False
    synonyms: tuple[str, ...] = ()
    stop_words: frozenset[str] = frozenset()
    stemmed: bool = False

    @property
    def plain(self) -> bool:
        return self == Analyzer()


STANDARD = Analyzer()
ENGLISH = Analyzer(possessive=True, stop_words=STOP_WORDS, stemmed=True)
DOMAIN = Analyzer(synonyms=SYNONYM_GROUPS, stop_words=STOP_WORDS, stemmed=True)
SYNONYMS_ONLY = Analyzer(synonyms=SYNONYM_GROUPS)
ANALYZERS = {"standard": STANDARD, "english": ENGLISH, "domain": DOMAIN}


def tokens(text: Column) -> Column:
    """Lower-case word tokens of a text, in order."""
    found = F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))
    return let(found, lambda all_: F.when(F.exists(all_, _too_long), _cut(all_)).otherwise(all_))


def _too_long(token: Column) -> Column:
    return F.length(token) > LONGEST


def _cut(found: Column) -> Column:
    return F.flatten(F.transform(found, lambda t: F.regexp_extract_all(t, F.lit(f".{{1,{LONGEST}}}"), F.lit(0))))


class _Terms(dict):
    """Word -> term, worked out once a word; stop words have none."""

    def __init__(self, analyzer: Analyzer):
        super().__init__()
        self._analyzer = analyzer

    def __missing__(self, word: str) -> str:
        if len(self) >= REMEMBERED:
            self.clear()
        term = "" if word in self._analyzer.stop_words else stem(word) if self._analyzer.stemmed else word
        self[word] = term
        return term


def _phrases(groups: tuple[str, ...]) -> dict[str, list[tuple[list[str], list[list[str]]]]]:
    """First word -> the phrases it may begin, longest first, each with its whole group."""
    starts: dict[str, list[tuple[list[str], list[list[str]]]]] = {}
    for group in groups:
        members = [p.split() for p in group.split(",")]
        for phrase in members:
            starts.setdefault(phrase[0], []).append((phrase, members))
    for found in starts.values():
        found.sort(key=lambda p: -len(p[0]))
    return starts


def _chain(analyzer: Analyzer) -> Callable[[list[str]], tuple[list[str], int]]:
    """The steps as one function words -> (terms, length); length counts positions, not synonyms."""
    starts = _phrases(analyzer.synonyms)
    terms = _Terms(analyzer)

    def placed(words: list[str]) -> Iterator[tuple[int, str]]:
        at = 0
        while at < len(words):
            known = starts.get(words[at], ())
            phrase, members = next((k for k in known if words[at : at + len(k[0])] == k[0]), ([words[at]], None))
            for member in members or [phrase]:
                yield from enumerate(member, at)
            at += len(phrase)

    def run(words: list[str]) -> tuple[list[str], int]:
        if analyzer.possessive:
            words = [_bare(w, analyzer) for w in words]
        if starts.keys().isdisjoint(words):
            kept = [t for w in words if (t := terms[w])]
            return kept, len(kept)
        kept = [(at, t) for at, w in placed(words) if (t := terms[w])]
        return [t for _, t in kept], len({at for at, _ in kept})

    return run


def _analyzed(analyzer: Analyzer) -> Callable[[Column], Column]:
    """Space-joined tokens in, space-joined terms and length out: text columns are cheap to pass."""

    @F.pandas_udf("terms string, length int")
    def analyze(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        run = _chain(analyzer)
        for texts in batches:
            done = [run(t.split(" ") if t else []) for t in texts]
            yield pd.DataFrame({"terms": [" ".join(t) for t, _ in done], "length": [n for _, n in done]})

    return analyze


def word_terms(analyzer: Analyzer) -> Callable[[Column], Column]:
    """Space-joined words to the space-joined term of each word alone; a stop word's is ``-``."""

    @F.pandas_udf("string")
    def each(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        terms = _Terms(analyzer)
        for texts in batches:
            yield pd.Series([" ".join(terms[_bare(w, analyzer)] or "-" for w in t.split(" ")) for t in texts], dtype=object)

    return each


def _bare(word: str, analyzer: Analyzer) -> str:
    return word[:-2] if analyzer.possessive and word.endswith(("'s", "’s")) else word


def analyzed(docs: DataFrame, text: Column | str, analyzer: Analyzer = STANDARD) -> DataFrame:
    """Add ``terms`` (array, in order) and ``length`` (positions) of a text column."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    if analyzer.plain:
        return docs.withColumn("terms", tokens(text)).withColumn("length", F.size("terms"))
    out = docs.withColumn("_a", _analyzed(analyzer)(F.array_join(tokens(text), " ")))
    terms = F.when(F.col("_a.terms") == "", F.array().cast("array<string>")).otherwise(F.split("_a.terms", " "))
    return out.withColumns({"terms": terms, "length": F.col("_a.length")}).drop("_a")


def counted(docs: DataFrame) -> DataFrame:
    """Replace ``terms`` by ``postings``, the (term, tf) pairs of the row.

    Counting runs over the sorted terms of one row, so no row leaves its
    partition: the text is never exploded and shuffled to be counted.
    """
    return docs.withColumn("postings", let(F.sort_array("terms"), _runs)).drop("terms")


def _runs(ordered: Column) -> Column:
    """(term, tf) of an ordered array: where each run of equal terms ends, and how long it is."""
    n = F.size(ordered)
    ends = F.filter(
        F.sequence(F.lit(1), n), lambda i: (i == n) | (F.get(ordered, i - 1) != F.get(ordered, i))
    )
    ends = F.when(n == 0, F.array().cast("array<int>")).otherwise(ends)
    return let(ends, lambda at: F.transform(at, lambda end, j: F.struct(
        F.get(ordered, end - 1).alias("term"),
        (end - F.coalesce(F.get(at, j - 1), F.lit(0))).alias("tf"),
    )))


def exploded(index: DataFrame) -> DataFrame:
    """One row per document and term."""
    kept = [c for c in index.columns if c != "postings"]
    # The outer form: the plain one adds a filter that would count the terms a second time.
    return index.select(*kept, F.inline_outer("postings")).filter(F.col("term").isNotNull())
