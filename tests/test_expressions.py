"""Row expressions against plain Python on edge cases and on random rows."""

import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from docuweft.functions import keys, text
from docuweft.functions.columns import Columns, strip


def evaluate(spark, schema, rows, make):
    """Values of one expression, in row order; ``make`` gets the columns of the frame."""
    rows = [(n, *r) for n, r in enumerate(rows)]
    df = spark.createDataFrame(rows, f"_n long, {schema}")
    return [r["v"] for r in df.selectExpr("_n", f"{make(Columns(df))} as v").orderBy("_n").collect()]


def test_strip_is_any_whitespace(spark):
    values = [" a ", "\t\n\r\x0b\x0ca b\x1c\x1d\x1e\x1f\x85\xa0", "    x    　", "", " \n", "​z"]
    got = evaluate(spark, "c string", [(v,) for v in values], lambda r: strip(r["c"]))
    assert got == [v.strip() for v in values]


def test_title_and_prose(spark):
    make = text.title("Thing", "a", "b", "gone")
    assert evaluate(spark, "a string, b long", [("x ", 5), (None, 0), (" \t", None)], make) == ["Thing · x · 5", "Thing · 0", "Thing"]
    make = text.prose("it's a thing", "name <- a, b, not there")
    assert evaluate(spark, "a string, b long", [("x ", 5), (None, 0), (" \t", None)], make) == [
        "This is a it's a thing where name is x, b is 5", "This is a it's a thing where b is 0", "This is a it's a thing"]


def test_generic_text(spark):
    schema = "id long, company_id long, tax_code string, owner_id long, password string, seen timestamp_ntz, n double"
    rows = [(1, 2, " x ", 3, "p", dt.datetime(2024, 1, 2, 3, 4, 5), 1.5), (1, 2, " ", 3, "p", None, None)]
    got = evaluate(spark, schema, rows, text.generic_text)
    assert got[0] == " n: 0 tax code: x seen: 2024-01-02 03:04:05 n: 1.5" and got[1] == " n: 1"


def test_numbers(spark):
    values = ["1", " 1.5 ", "1e3", "-.5", "+2.", "1_000", "1d", "1f", "0x1", "", " ", "abc", "1__0", "nan", "inf", "1.2.3", None]

    def as_python(v):
        try:
            return float(v)
        except (TypeError, ValueError):
            return None

    got = evaluate(spark, "c string", [(v,) for v in values], lambda r: r.number("c"))
    assert [str(g) for g in got] == [str(as_python(v)) for v in values]
    assert evaluate(spark, "c boolean", [(True,), (None,)], lambda r: r.number("c")) == [1.0, None]
    assert evaluate(spark, "c decimal(18,2)", [(Decimal("10.50"),)], lambda r: r.number("c")) == [10.5]


def test_first_amount(spark):
    rows = [("x", 2.0, Decimal("3")), (None, None, Decimal("3")), ("0", 2.0, None), (None, None, None), (" 7 ", 1.0, None)]
    got = evaluate(spark, "grand_total string, amount double, payment_amount decimal(5,1)", rows, text.extract_amount)
    assert got == [2.0, 3.0, 0.0, None, 7.0]
    assert evaluate(spark, "x string", [("1",)], text.extract_amount) == [None]


def test_values_as_text(spark):
    doubles = [1.0, 0.1, 12345678.5, 1e10, 1.5e15, 123456789012.125, 0.00012, 0.001, -2.5e9, 0.0, 100.0]
    assert evaluate(spark, "c double", [(d,) for d in doubles], lambda r: r.text("c")) == [repr(d) for d in doubles]
    assert evaluate(spark, "c boolean", [(True,), (False,), (None,)], lambda r: r.text("c")) == ["1", "0", None]
    assert evaluate(spark, "c decimal(9,2)", [(Decimal("10.50"),)], lambda r: r.text("c")) == ["10.50"]
    moments = [dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2024, 1, 2, 3, 4, 5, 600)]
    assert evaluate(spark, "c timestamp_ntz", [(m,) for m in moments], lambda r: r.text("c")) == [str(m) for m in moments]
    assert evaluate(spark, "id long", [(5,), (0,), (None,)], text.id_reference) == ["5", None, None]


def test_dates(spark):
    rows = [("2024-02-03",), (" 2024-02-03\n",), ("2024-02-30",), ("x",), ("",), (None,)]
    assert [str(v) for v in evaluate(spark, "c string", rows, lambda r: r.date("c"))] == ["2024-02-03"] * 2 + ["None"] * 4
    assert evaluate(spark, "c string", rows, lambda r: r.bad_date("c")) == [False, False, True, True, False, False]
    assert evaluate(spark, "c timestamp_ntz", [(dt.datetime(2024, 1, 2, 23),)], lambda r: r.date("c")) == [dt.date(2024, 1, 2)]


def test_document_ids(spark):
    rows = [(1, 5), (2, None), (3, 0)]
    assert evaluate(spark, "id long, company_id long", rows, lambda r: keys.doc_id("t", r, True)) == ["t:1:5", "t:2:", "t:3:"]
    assert evaluate(spark, "id long, company_id long", rows, lambda r: keys.doc_id("t", r, False)) == ["t:1", "t:2", "t:3"]
    assert evaluate(spark, "id long, company_id long", rows, keys.company_key) == ["5", "0", "0"]
    assert evaluate(spark, "id long", [(1,)], keys.company_key) == ["0"]


def test_embed_input(spark):
    rows = [("T", " x "), ("", " x "), (None, "x"), (" ", "x")]
    got = evaluate(spark, "t string, x string", rows, lambda r: text.embed_input(r["t"], r["x"]))
    assert got == ["T  x", " x ", "x", "x"]


WORDS = st.one_of(st.none(), st.sampled_from(["", " ", "Ann", " Lee ", "\tB\n", "O'Neil", "a\\b", "0"]))
COLUMNS = ("customer_name", "vendor_name", "first_name", "middle_name", "last_name", "name", "company_name", "email",
           "email_ids", "status")
ROW = st.fixed_dictionaries({c: WORDS for c in COLUMNS})


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ROW, min_size=30, max_size=60))
def test_random_rows(spark, rows):
    schema, data = ", ".join(f"{c} string" for c in COLUMNS), [tuple(r[c] for c in COLUMNS) for r in rows]

    def shown(r):
        person = " ".join(filter(None, (r["first_name"], r["middle_name"], r["last_name"]))).strip()
        options = [r["customer_name"], r["vendor_name"], person, r["name"], r["company_name"]]
        return next((o for o in options if o), None)

    def joined(r):
        given_ = [p for p in (r["first_name"], r["middle_name"], r["last_name"]) if p is not None]
        return next((o for o in (" ".join(given_).strip(" ") or None, r["company_name"], r["name"]) if o is not None), None)

    def said(r):
        parts = [f"{c} is {r[c].strip()}" for c in ("name", "status") if r[c] and r[c].strip()]
        return "This is a row" + (" where " + ", ".join(parts) if parts else "")

    assert evaluate(spark, schema, data, text.resolve_party_name) == [shown(r) for r in rows]
    assert evaluate(spark, schema, data, text.sql_party_name) == [joined(r) for r in rows]
    assert evaluate(spark, schema, data, text.prose("row", "name, status")) == [said(r) for r in rows]
    assert evaluate(spark, schema, data, lambda c: c.first_truthy("email", "email_ids")) == [r["email"] or r["email_ids"] for r in rows]
