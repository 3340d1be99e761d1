"""Every table spec on a fixture row, the tenant override, and the join edge cases."""

from pathlib import Path

import pytest

from pyspark.sql import functions as F

import erp
from docuweft.operators.documents import REASON, build_documents, checked_documents
from docuweft.plans.registry import BASE, apply_overrides, indices_for, modules, variants
from docuweft.sample.tenants import resolve as resolve_registry
from docuweft.plans.spec import Keys, TableSpec, source_rows
from docuweft.schema import ANALYZER_OF, DOC_FIELDS, NARROW_FIELDS

GOLDEN = Path(__file__).parent / "golden_specs.txt"
SHOWN = ("id", "module", "company_id", "title", "reference", "status", "date", "amount", "party_name", "text_content")


def golden() -> dict[str, list[str]]:
    lines = (line.split(" | ") for line in GOLDEN.read_text().splitlines())
    return {first: rest for first, *rest in lines}


def test_layout_of_documents():
    assert len(DOC_FIELDS) == 110 and len(NARROW_FIELDS) == 17
    types = [f.type.simpleString() for f in DOC_FIELDS]
    assert types.count("date") == 18 and types.count("double") == 13 and types.count("bigint") == 1
    assert ANALYZER_OF["title"] == "domain" and ANALYZER_OF["narration"] == "english" and ANALYZER_OF["address"] == "standard"


def test_catalogue_is_complete():
    assert len(BASE) == 45 and set(golden()) == set(BASE)
    counts = {m: sum(s.module == m for s in BASE.values()) for m in modules()}
    assert counts == {"account": 15, "inventory": 5, "sales": 7, "purchase": 8, "manufacturing": 7, "rental": 2, "document": 1}
    for table, spec in BASE.items():
        assert set(spec.source_columns()) <= set(erp.layouts()[table]), table


@pytest.mark.parametrize("module", modules())
def test_golden_documents(spark, module):
    tables = erp.lookups(spark)
    for table, spec in BASE.items():
        if spec.module == module:
            frames = {table: erp.frame(spark, table, erp.filled(table))} | tables
            docs = build_documents(spec, frames.__getitem__)
            assert docs.schema.names == ["client_id", *(f.name for f in DOC_FIELDS)]
            (row,) = docs.select(*SHOWN).collect()
            assert [str(v) for v in row] == golden()[table], table


def test_missing_source_column_is_an_error(spark):
    rows = erp.frame(spark, "sl_sales_orders", erp.filled("sl_sales_orders")).drop("company_id")
    frames = {**erp.lookups(spark), "sl_sales_orders": rows}
    with pytest.raises(ValueError, match="company_id"):
        source_rows(BASE["sl_sales_orders"], frames.__getitem__)


def test_override_takes_company_from_party(spark):
    rows = erp.frame(spark, "sl_opportunity_parties", erp.filled("sl_opportunity_parties")).drop("company_id")
    frames = {**erp.lookups(spark), "sl_opportunity_parties": rows}
    (row,) = build_documents(resolve_registry("spar")["sl_opportunity_parties"], frames.__getitem__).collect()
    assert row["company_id"] == "7"
    assert row["title"] == "Sales Opportunity · Ann Lee · [stages]"


def test_override_grammar():
    spec = BASE["parties"]
    assert apply_overrides(BASE, {}) == dict(BASE)
    merged = apply_overrides(BASE, {"parties": {"status": "type"}, "drive": None, "extra": TableSpec("extra", "new", spec.title, spec.text)})
    assert merged["parties"].status == "type" and merged["parties"].title is spec.title
    assert "drive" not in merged and "drive" in BASE and BASE["parties"].status is None
    assert merged["extra"].module == "new" and "new" in modules(merged)
    with pytest.raises(ValueError):
        apply_overrides(BASE, {"prties": {"status": "x"}})
    assert set(resolve_registry("dev_env")) == set(resolve_registry("nobody")) == set(BASE)


def test_indices_and_variants():
    assert "spar_account" in indices_for("spar") and len(indices_for("spar")) == 7
    assert not set(indices_for("spar")) & set(indices_for("dev_env"))
    assert [c for _, c in variants(["spar", "dev_env", "x1"], "parties")] == [["spar", "dev_env", "x1"]]
    assert sorted(c for _, c in variants(["spar", "dev_env", "x1"], "sl_opportunity_parties", resolve_registry)) == [["dev_env", "x1"], ["spar"]]


def test_equal_specs_are_one_variant_whoever_made_them():
    change = {"sl_quotation": {"status": "other"}}

    def fresh(client_id):
        return apply_overrides(BASE, change if client_id != "plain" else {})

    assert sorted(c for _, c in variants(["a", "plain", "b"], "sl_quotation", fresh)) == [["a", "b"], ["plain"]]
    assert variants(["a"], "no_such_table", fresh) == []


def orders(spark, *rows, types=None):
    filled = [erp.filled("sl_sales_orders", **r) for r in rows]
    return erp.frame(spark, "sl_sales_orders", *filled, types=types)


def test_join_edges(spark):
    rows = orders(
        spark,
        {"id": 1}, {"id": 2, "is_deleted": 1}, {"id": 3, "is_deleted": None}, {"id": 4, "customer_id": None},
        {"id": 5, "customer_id": 99}, {"id": 6, "company_id": None}, {"id": 7, "company_id": None, "customer_id": 99},
        {"id": 8, "client_id": "t2"}, {"id": 9, "company_id": None, "customer_id": 2},
    )
    parties = erp.frame(spark, "parties", erp.party(), erp.party(id=2, first_name="", last_name="", company_name="Acme", company_id=None))
    frames = {"sl_sales_orders": rows, "parties": parties}
    docs = build_documents(BASE["sl_sales_orders"], frames.__getitem__).collect()
    got = {r["source_id"]: (r["party_name"], r["company_id"]) for r in docs}
    assert got == {
        1: ("Ann Lee", "1"), 4: (None, "1"), 5: (None, "1"), 6: ("Ann Lee", "7"), 7: (None, "0"), 8: (None, "1"),
        9: ("Acme", "0"),
    }


@pytest.mark.parametrize("kind", ["smallint", "decimal(5,0)", "tinyint", "decimal(10,2)", "string", "bigint"])
def test_join_keys_of_any_type(spark, kind):
    rows = orders(spark, {"id": 1}, {"id": 2, "customer_id": None}, {"id": 3, "customer_id": 99}).withColumn("customer_id", F.col("customer_id").cast(kind))
    frames = {"sl_sales_orders": rows, "parties": erp.frame(spark, "parties", erp.party())}
    got = {r["id"]: r["customer_name"] for r in source_rows(BASE["sl_sales_orders"], frames.__getitem__).collect()}
    assert got == {1: "Ann Lee", 2: None, 3: None}


def test_party_names(spark):
    people = [
        dict(id=1, company_name="Acme", first_name=None, last_name=None), dict(id=2),
        dict(id=3, first_name="", last_name=" ", name="Only"), dict(id=4, first_name="Ann", middle_name="", last_name="Lee"),
        dict(id=5, first_name=None, last_name=None), dict(id=6, company_name="", first_name=" A", last_name="B "),
    ]
    parties = erp.frame(spark, "parties", *[erp.party(**p) for p in people])
    docs = build_documents(BASE["parties"], {"parties": parties}.__getitem__)
    got = {r["source_id"]: (r["title"], r["party_name"], r["text_content"].split(",")[0]) for r in docs.collect()}
    assert got[1] == ("Party · Acme", "Acme", "This is a party with company name Acme")
    assert got[2] == ("Party · Ann Lee", "Ann Lee", "This is a party with name Ann Lee")
    assert got[3] == ("Party", "Only", "This is a party with name  ")
    assert got[4] == ("Party · Ann Lee", "Ann Lee", "This is a party with name Ann Lee")
    assert got[5] == ("Party", None, "This is a party")
    assert got[6] == ("Party · A B", "A B", "This is a party with name  A B ")
    orders_ = orders(spark, {"id": 1, "customer_id": 4})
    (row,) = source_rows(BASE["sl_sales_orders"], {"sl_sales_orders": orders_, "parties": parties}.__getitem__).collect()
    assert row["customer_name"] == "Ann  Lee"


def test_junctions(spark):
    links = spark.createDataFrame(
        [("t1", 1, 5, 1), ("t1", 2, 6, 1), ("t1", 3, None, 2), ("t2", 4, 9, 3)],
        "client_id string, id long, company_id long, item_id long",
    )
    items = erp.frame(spark, "items", *[erp.filled("items", id=i) for i in (1, 2, 3)])
    frames = {"items": items, "item_companies": links}
    got = sorted((r["id"], r["company_id"]) for r in build_documents(BASE["items"], frames.__getitem__).collect())
    assert got == [("items:1:5", "5"), ("items:1:6", "6"), ("items:2:", "0"), ("items:3:", "0")]
    boms = erp.frame(spark, "mf_bom", *[erp.filled("mf_bom", id=i) for i in (1, 2, 3)])
    frames = {"mf_bom": boms, "items": items, "mf_bom_companies": links.withColumnRenamed("item_id", "bom_id")}
    assert sorted(r["id"] for r in build_documents(BASE["mf_bom"], frames.__getitem__).collect()) == ["mf_bom:1:5", "mf_bom:1:6", "mf_bom:2:"]


@pytest.mark.parametrize("few", [True, False])
def test_keys_keep_only_their_rows(spark, few):
    rows = orders(spark, *[{"id": i} for i in range(1, 6)], {"id": 2, "client_id": "t2"})
    frames = {**erp.lookups(spark), "sl_sales_orders": rows}
    wanted = spark.createDataFrame([("t1", 2), ("t1", 5), ("t2", 9)], "client_id string, id long")
    keys = Keys.of(wanted) if few else Keys(wanted)
    got = source_rows(BASE["sl_sales_orders"], frames.__getitem__, keys)
    assert sorted((r["client_id"], r["id"], r["customer_name"]) for r in got.collect()) == [("t1", 2, "Ann Lee"), ("t1", 5, "Ann Lee")]


def test_hot_and_null_foreign_keys(spark):
    """A third of the rows share one key, a third have none; nothing is lost or matched wrongly."""
    rows = spark.range(3000).selectExpr(
        "'t1' as client_id", "id", "case id % 3 when 0 then 1 when 1 then null else id end as customer_id",
        "1L as company_id", "0 as is_deleted",
    )
    frames = {"sl_sales_orders": rows, "parties": erp.frame(spark, "parties", erp.party())}
    got = source_rows(BASE["sl_sales_orders"], frames.__getitem__)
    assert got.count() == 3000 and got.filter("customer_name = 'Ann Lee'").count() == 1000


def test_rejects(spark):
    rows = orders(
        spark, {"id": 1, "date": "2024-01-05T10:00:00"}, {"id": 2, "date": "soon"}, {"id": 3, "date": " \n"}, {"id": None, "date": None},
        types={"date": erp.TYPES["string"]},
    )
    frames = {**erp.lookups(spark), "sl_sales_orders": rows}
    checked = checked_documents(source_rows(BASE["sl_sales_orders"], frames.__getitem__), BASE["sl_sales_orders"])
    got = {r["source_id"]: (str(r["date"]), r[REASON]) for r in checked.collect()}
    assert got == {1: ("2024-01-05", None), 2: ("None", "bad_date:date"), 3: ("None", None), None: ("None", "null_id")}


def test_either_date_and_amounts(spark):
    types = {"acquisition_date": erp.TYPES["string"], "posting_date": erp.TYPES["string"], "asset_value": erp.TYPES["string"]}
    rows = [
        dict(id=1, acquisition_date="", posting_date="2024-02-03", asset_value="7"), dict(id=2, acquisition_date="2024-01-01", posting_date="x", asset_value=None),
        dict(id=3, acquisition_date=None, posting_date=None, asset_value="n/a"),
    ]
    assets = erp.frame(spark, "assets", *[erp.filled("assets", **r) for r in rows], types=types)
    checked = checked_documents(source_rows(BASE["assets"], {"assets": assets}.__getitem__), BASE["assets"])
    got = {r["source_id"]: (str(r["date"]), r["amount"], r[REASON]) for r in checked.collect()}
    # The pass-through field of the first date is blank in row 1, which is no fault.
    assert got == {1: ("2024-02-03", 7.0, None), 2: ("2024-01-01", None, None), 3: ("None", None, "bad_amount")}
