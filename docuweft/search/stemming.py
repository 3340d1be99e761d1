"""The published Porter (1980) suffix rules, with its author's two later amendments."""

from __future__ import annotations

# Suffix rules of steps 2 to 4, tried in order within a step.
STEP_2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
    ("logi", "log"),
)
STEP_3 = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""),
)
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "sion", "tion",
    "ou", "ism", "ate", "iti", "ous", "ive", "ize",
)


def _shape(word: str) -> str:
    """c for each consonant, v for each vowel; y is a vowel after a consonant."""
    shape = ""
    for letter in word:
        vowel = letter in "aeiou" or (letter == "y" and shape[-1:] == "c")
        shape += "v" if vowel else "c"
    return shape


def _measure(word: str) -> int:
    return _shape(word).count("vc")


def _short_end(word: str) -> bool:
    return _shape(word)[-3:] == "cvc" and word[-1] not in "wxy"


def _plural(w: str) -> str:
    if w.endswith(("sses", "ies")):
        return w[:-2]
    return w[:-1] if w.endswith("s") and not w.endswith("ss") else w


def _past(w: str) -> str:
    if w.endswith("eed"):
        return w[:-1] if _measure(w[:-3]) > 0 else w
    for suffix in ("ed", "ing"):
        stem = w.removesuffix(suffix)
        if stem != w:
            return _restored(stem) if "v" in _shape(stem) else w
    return w


def _restored(stem: str) -> str:
    if stem.endswith(("at", "bl", "iz")):
        return stem + "e"
    if stem[-1:] == stem[-2:-1] and _shape(stem)[-1:] == "c":
        return stem if stem[-1] in "lsz" else stem[:-1]
    return stem + "e" if _measure(stem) == 1 and _short_end(stem) else stem


def _replaced(w: str, rules: tuple[tuple[str, str], ...]) -> str:
    for suffix, to in rules:
        if w.endswith(suffix):
            stem = w[: -len(suffix)]
            return stem + to if _measure(stem) > 0 else w
    return w


def _dropped(w: str) -> str:
    for suffix in STEP_4:
        if w.endswith(suffix):
            stem = w[: -len(suffix)] + (suffix[0] if suffix in ("sion", "tion") else "")
            return stem if _measure(stem) > 1 else w
    return w


def _final(w: str) -> str:
    if w.endswith("e"):
        m = _measure(w[:-1])
        if m > 1 or (m == 1 and not _short_end(w[:-1])):
            w = w[:-1]
    return w[:-1] if w.endswith("ll") and _measure(w[:-1]) > 1 else w


def stem(word: str) -> str:
    """The stem of a lower-case word; words of one or two letters stay."""
    if len(word) < 3:
        return word
    w = _past(_plural(word))
    if w.endswith("y") and "v" in _shape(w[:-1]):
        w = w[:-1] + "i"
    return _final(_dropped(_replaced(_replaced(w, STEP_2), STEP_3)))
