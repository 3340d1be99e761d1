"""Personal data in texts: patterns propose spans, checksums confirm them, words nearby adjust their score."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds whose plain pattern counts once confirmed, in their order, and kinds of the method alone.  Spans that it
#: adds, of either, are kept from MIN_SCORE on.
BASE_KINDS = ("email", "ip", "card", "phone")
SCORED_KINDS = ("iban", "national_id")
MIN_SCORE = 0.5
#: Code points on either side in which words count as context, and what they add or take.
CONTEXT = 60
RAISES, LOWERS = 0.3, 0.3
#: Score of a confirmed span without context.
START = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "national_id": 0.35}
WORDS = {
    "email": ("mail", "contact", "kontakt", "courriel", "correo"),
    "ip": ("ip", "address", "host", "server", "login"),
    "card": ("card", "credit", "visa", "payment", "karte", "carte", "tarjeta"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "telefon"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "national_id": ("ssn", "social", "security", "insurance", "identity", "taxpayer"),
}
DOUBT = ("version", "example", "sample", "dummy", "test", "isbn", "serial", "invoice", "part")

LAYOUT = "array<struct<kind:string,start:int,end:int,score:double,base:boolean>>"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DIGIT = re.compile(r"[0-9]")
_DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_NATIONAL = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
#: Numbers in their usual groups, also where the plain pattern runs on into a number that follows.
_CARD_ALONE = re.compile(r"(?<![0-9])[3-6](?:[0-9]{12,18}|[0-9]{3}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7})(?![0-9])")
_PHONE_ALONE = re.compile(r"\+[0-9]{1,3}[\x20.-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20.-]?[0-9]{3,4}[\x20.-]?[0-9]{3,4}(?![0-9])")
_WORD = re.compile(r"[^\W\d_]+")


def luhn(digits: str) -> bool:
    """Whether the check digit of a card number is right."""
    own = sum(map(int, digits[-1::-2]))
    return (own + sum(d // 10 + d % 10 for d in (2 * int(c) for c in digits[-2::-2]))) % 10 == 0


def mod97(iban: str) -> bool:
    """Whether an account number's check digits are right; blanks are passed over."""
    plain = iban.replace(" ", "")
    if not 15 <= len(plain) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost addresses: from each @ back to the run of local characters before it, forward over its domain."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def ips(text: str) -> Iterator[tuple[int, int]]:
    """Each four neighbours in a chain of dotted numbers, all at most 255."""
    for chain in _DOTTED.finditer(text):
        parts, start = chain.group().split("."), chain.start()
        for first in range(0, len(parts) - 3, 4):
            four = parts[first:first + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in four):
                yield start, end
            start = end + 1


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _digits(m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    if "+" in text:
        yield from (m.span() for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15)


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """Account numbers: the longest run of groups that is right, as upper-case words and numbers may stand beside it."""
    at = 0
    while m := _IBAN.search(text, at):
        limits = [e for e in range(m.start(), m.end()) if text[e] == " "] + [m.end()]
        end = next((e for e in reversed(limits) if mod97(text[m.start():e])), None)
        if end:
            yield m.start(), end
        at = end or limits[0]


def national_ids(text: str) -> Iterator[tuple[int, int]]:
    yield from (m.span() for m in _NATIONAL.finditer(text))


def cards_alone(text: str) -> Iterator[tuple[int, int]]:
    yield from (m.span() for m in _CARD_ALONE.finditer(text) if luhn(_digits(m.group())))


def phones_alone(text: str) -> Iterator[tuple[int, int]]:
    if "+" in text:
        yield from (m.span() for m in _PHONE_ALONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15)


BASE_FINDERS = {"email": emails, "ip": ips, "card": cards, "phone": phones}
ADDED_FINDERS = {"card": cards_alone, "phone": phones_alone, "iban": ibans, "national_id": national_ids}


def score(text: str, kind: str, start: int, end: int) -> float:
    """How sure a span is, by the words around it."""
    near = f"{text[max(0, start - CONTEXT):start]} {text[end:end + CONTEXT]}".lower()
    words = set(_WORD.findall(near))
    found = START[kind] + RAISES * (not words.isdisjoint(WORDS[kind])) - LOWERS * (not words.isdisjoint(DOUBT))
    return round(min(1.0, max(0.0, found)), 2)


def _free(taken: list[tuple[int, int]], span: tuple[int, int]) -> bool:
    """Whether a span overlaps none of some others, which are in order and do not overlap."""
    at = bisect_left(taken, span[1], key=lambda s: s[0])  # the first that begins behind it
    return at == 0 or taken[at - 1][1] <= span[0]


def spans_of(text: str) -> list[tuple[str, int, int, float, bool]]:
    """(kind, start, end, score, base) in code points, by kind and start; spans of different kinds may overlap.

    ``base`` is true of what the plain patterns find; what the method adds
    overlaps no such span of its kind.
    """
    numbers = _DIGIT.search(text) is not None
    found = []
    for kind in (*BASE_KINDS, *SCORED_KINDS):
        if not (numbers or kind == "email"):
            continue
        own = list(BASE_FINDERS[kind](text)) if kind in BASE_FINDERS else []
        added = [s for s in ADDED_FINDERS[kind](text) if _free(own, s)] if kind in ADDED_FINDERS else []
        spans = sorted([(a, b, True) for a, b in own] + [(a, b, False) for a, b in added])
        scored = [(kind, a, b, score(text, kind, a, b), base) for a, b, base in spans]
        found += [s for s in scored if s[4] or s[3] >= MIN_SCORE]
    return found


def masked(text: str) -> str:
    """The text with each span, or run of overlapping spans, replaced by the kind of its first, such as ``[EMAIL]``."""
    out, done = [], 0
    for kind, start, end, *_ in sorted(spans_of(text), key=lambda s: (s[1], -s[2])):
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def find_pii(text: Column) -> Column:
    """The spans of a text column; a null text has none."""

    @F.pandas_udf(LAYOUT)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([spans_of(t) for t in texts])

    return find(F.coalesce(text, F.lit("")))


def mask_pii(docs: DataFrame) -> DataFrame:
    """``docs`` with the spans of its texts masked; a null text stays null."""

    @F.pandas_udf("string")
    def mask(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([t if t is None else masked(t) for t in texts], dtype=object)

    return docs.withColumn("text", mask("text"))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of an array of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
