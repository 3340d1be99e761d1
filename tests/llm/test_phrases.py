import random
from hashlib import sha256

import pytest

from docuweft.llm import phrases

SHAPE = "doc_id long, text string"


def plain_phrases(text):
    """The phrases by the definition: the shortest run that is not known yet."""
    data, known = (text or "").encode(), []
    while data:
        n = next((n for n in range(1, len(data) + 1) if data[:n] not in known), None)
        if n is None:
            break
        known.append(data[:n])
        data = data[n:]
    return set(known)


def test_phrases_by_their_definition():
    rng = random.Random(1)
    for text in ["", "a", "aaaaaaaaa", "abababababab", "日本語日本語日本", *("".join(rng.choices("abcß ", k=rng.randrange(300))) for _ in range(40))]:
        assert phrases.Phrases().read(text.encode()).known == plain_phrases(text)
        cut = rng.randrange(len(text) + 1)
        begun = phrases.Phrases().read(text[:cut].encode())
        assert begun.copy().read(text[cut:].encode()).fingerprint() == phrases.fingerprint(text)
        assert begun.known == plain_phrases(text[:cut])


def test_likeness_is_exact_for_few_phrases_and_near_for_many():
    rng = random.Random(2)
    for size, most in ((60, 0.0), (20_000, 0.2)):
        one = "".join(rng.choices("abcdefgh ", k=size))
        other = one[:size // 2] + "".join(rng.choices("abcdefgh ", k=size // 2))
        a, b = plain_phrases_fast(one), plain_phrases_fast(other)
        wanted = len(a & b) / len(a | b)
        assert abs(phrases.likeness(phrases.fingerprint(one), phrases.fingerprint(other)) - wanted) <= most


def plain_phrases_fast(text):
    return phrases.Phrases().read(text.encode()).known


def test_likeness_at_the_ends():
    own = phrases.fingerprint("some words of a text")
    assert phrases.likeness(own, own) == 1.0 and phrases.likeness(b"", b"") == 1.0
    assert phrases.likeness(own, b"") == 0.0 and phrases.likeness(own, phrases.fingerprint("0123456789")) == 0.0


def plain(rows):
    """What the query holds, one text after the other; ``rows`` have different ids."""
    rows = sorted((d, t or "") for d, t in rows)
    out = {}
    for n, (doc_id, text) in enumerate(rows):
        following = rows[(n + 1) % len(rows)][1]
        cut = len(text) // 4
        edited = text[:len(text) - cut] + following[:cut]
        a, b, c = map(phrases.fingerprint, (text, edited, following))
        out[doc_id] = (len(text), sha256(edited.encode()).hexdigest(), a, b, phrases.likeness(a, b), phrases.likeness(a, c))
    return out


def run(spark, rows, shape=SHAPE):
    return [tuple(r) for r in phrases.neighbours_compared(spark.createDataFrame(rows, shape)).collect()]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    texts = [" ".join(rng.choices(["naïve", "日本", "alpha", "beta", "gamma"], k=rng.randrange(200))) for _ in range(120)]
    texts += [None, "", "abc", "abcd", "z" * 200_000, texts[3], texts[3]]
    ids = rng.sample(range(-500, 5000), len(texts))
    return list(zip(ids, texts))


def test_as_by_brute_force(spark, rows):
    found = run(spark, rows)
    assert len(found) == len(rows) and {r[0]: tuple(map(lambda v: bytes(v) if isinstance(v, bytearray) else v, r[1:])) for r in found} == plain(rows)


def test_few_rows(spark):
    assert run(spark, []) == []
    (one,) = run(spark, [(1, "abcdefgh")])
    assert one[1:3] == (8, sha256(b"abcdefab").hexdigest()) and one[6] == 1.0
    assert {r[0]: r[2] for r in run(spark, [(1, "abcdefgh"), (2, "x")])} == {1: sha256(b"abcdefx").hexdigest(), 2: sha256(b"x").hexdigest()}


def test_repeated_rows_and_rows_without_id(spark):
    rows = [(1, "abcdefgh" * 9)] * 50 + [(None, "xyz"), (None, None), (2, "other text of its own")]
    found = run(spark, rows)
    assert sorted(str(r[0]) for r in found) == sorted(str(d) for d, _ in rows)
    assert len({bytes(r[3]) for r in found if r[0] == 1}) == 1
    assert sum(r[0] == 1 and r[6] == 1.0 for r in found) == 49


def test_clashing_columns(spark):
    found = run(spark, [(1, "abcdefgh", 3, "p", True), (2, "qrstuvwx", 4, "q", None)], SHAPE + ", part int, following string, is_first boolean")
    assert len(found) == 2


def test_column_of_fingerprints(spark):
    rows = spark.createDataFrame([(1, "some text"), (2, None)], SHAPE).select("doc_id", phrases.fingerprints("text").alias("f")).collect()
    assert {r["doc_id"]: r["f"] for r in rows} == {1: phrases.fingerprint("some text").hex(), 2: ""}
