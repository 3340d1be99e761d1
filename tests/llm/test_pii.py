import random
import re

import pytest

from docuweft.llm import pii

#: The patterns as the contract states them.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for n, c in enumerate(reversed(digits)):
        d = int(c) * (1 + n % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(len(p.lstrip("0")) > 3 or int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


def base(text):
    return [s[:3] for s in pii.spans_of(text) if s[4]]


@pytest.mark.parametrize("text", [
    "", "a@b.c_d@e.f", "a@@b.c", "x@y", "x@y..z a@b.c.", "é a.b+c%d@ex-ample.co.uk, next@host.de", "@a.b", "a@b.c@d.e", "1.2.3.4.5.6.7.8", "256.1.1.1 1.1.1.256 001.02.3.255",
    "1..2.3.4", "1.2.3", "4111 1111 1111 1111", "4111-1111-1111-1111-", "4111  1111 1111 1111", "41111111111111111111111", "+1 (663) 555-6869 x", "+1+2 345 678 901", "+49 30 (", "tel +4930123456.",
    "٤١١١ 1.2.3.٤", " 4111 1111", "0" * 40, "a" * 30 + "@", "4242424242424242\n4242424242424242",
])
def test_base_spans_as_the_plain_patterns_find_them(text):
    assert base(text) == plain_spans(text)


def test_base_spans_of_random_texts():
    rng = random.Random(8)
    for _ in range(6000):
        text = "".join(rng.choice("aZ09157@..+-- ()_%é\n") for _ in range(rng.randrange(60)))
        assert base(text) == plain_spans(text), text


def test_long_runs_take_linear_time():
    for text in ("a" * 400_000, "1" * 400_000, "1." * 200_000, "a@" * 200_000, "+1" * 200_000, "1 " * 200_000, "A1" * 200_000):
        pii.spans_of(text)


def test_checksums_and_context():
    assert pii.mod97("GB82 WEST 1234 5698 7654 32") and not pii.mod97("GB83 WEST 1234 5698 7654 32")
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert [s[0] for s in pii.spans_of("IBAN GB82WEST12345698765432 please")] == ["iban"]
    assert pii.spans_of("IBAN GB83WEST12345698765432 please") == []
    assert [s[0] for s in pii.spans_of("her social security number is 219-09-9999")] == ["national_id"]
    assert pii.spans_of("part 219-09-9999") == [] and pii.spans_of("social security 000-09-9999") == []
    near, doubt = (pii.spans_of(t)[0][3] for t in ("call +49 30 1234567", "version +49 30 1234567"))
    assert near > pii.START["phone"] > doubt


def test_numbers_that_run_into_each_other_are_added():
    text = "call +1 (269) 555-3296 4524132264652876 now"
    assert plain_spans(text) == [] == base(text)
    assert [(s[0], text[s[1]:s[2]]) for s in pii.spans_of(text)] == [("card", "4524132264652876"), ("phone", "+1 (269) 555-3296")]
    assert pii.masked(text) == "call [PHONE] [CARD] now"
    text = "card 4111 1111 1111 1111"
    assert [s[4] for s in pii.spans_of(text)] == [True]


def test_many_spans_take_little_time():
    pii.spans_of("+1 (269) 555-3296 4524132264652876 a@b.de " * 3000)


def test_masked():
    assert pii.masked("mail a@b.de or 4111 1111 1111 1111, no 1") == "mail [EMAIL] or [CARD], no 1"
    assert pii.masked("+4111 1111 1111 1111 x") .count("[") == 1
    assert pii.masked("") == "" and pii.masked("plain") == "plain"


def test_tables(spark):
    frame = spark.createDataFrame([(1, None, "k"), (None, "a@b.de", "k"), (1, "", "k"), (1, "😀 a@b.de", "k")], "doc_id long, text string, spans string")
    got = [r["s"] for r in frame.select(pii.find_pii(frame["text"]).alias("s")).collect()]
    assert [[tuple(s)[:3] for s in g] for g in got] == [[], [("email", 0, 6)], [], [("email", 2, 8)]]
    masked = pii.mask_pii(frame)
    assert masked.columns == frame.columns and [r["text"] for r in masked.collect()] == [None, "[EMAIL]", "", "😀 [EMAIL]"]
    assert pii.mask_pii(frame.limit(0)).collect() == []


@pytest.mark.parametrize("text", [
    "DE89370400440532013000 BIC COBADEFFXXX", "pay DE89 3704 0044 0532 0130 00 12345 now", "DE89370400440532013000 4711", "REF AB12 3456 DE89 3704 0044 0532 0130 00 EUR",
])
def test_account_numbers_beside_words_and_numbers(text):
    found = [text[a:b].replace(" ", "") for kind, a, b, *_ in pii.spans_of(text) if kind == "iban"]
    assert found == ["DE89370400440532013000"]
    assert "[IBAN]" in pii.masked(text) and "0532" not in pii.masked(text)


def test_account_numbers_one_after_the_other():
    text = "DE89370400440532013000 GB29NWBK60161331926819"
    assert pii.masked(text) == "[IBAN] [IBAN]"
