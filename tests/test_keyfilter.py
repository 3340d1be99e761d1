"""Keys of changes as Bloom filters: nothing with a key is lost, little else passes, lookups are cut at any number of keys."""

import pytest
from pyspark.sql import functions as F

import erp
from docuweft.plans import keyfilter, spec
from docuweft.plans.registry import BASE
from docuweft.plans.spec import Keys, source_rows
from test_plans import lake, plan


@pytest.mark.parametrize("kind", ["int", "long", "decimal(20,2)", "double"])
def test_no_key_is_lost_and_little_else_passes(spark, kind):
    keys = spark.range(0, 40_000, 20).selectExpr("if(id % 40 = 0, 't1', 't2') as c", "id")
    rows = spark.range(40_000).selectExpr("if(id % 40 = 0, 't1', 't2') as client", f"cast(id as {kind}) as k")
    passed = keyfilter.cut(rows, ["client", "k"], keys, ["c", "id"], keyfilter.filter_bits(2000))
    by_key = passed.groupBy((F.col("k") % 20 == 0).alias("has")).count().collect()
    counts = {r["has"]: r["count"] for r in by_key}
    assert counts[True] == 2000 and counts.get(False, 0) < 0.03 * 38_000


def test_edges(spark):
    rows = spark.createDataFrame([("a", 0.0), ("a", -0.0), ("a", None), (None, 1.0)], "c string, k double")
    none = spark.createDataFrame([], "c string, k double")
    assert keyfilter.cut(rows, ["c", "k"], none, ["c", "k"], 1024).count() == 0
    zero = spark.createDataFrame([("a", 0)], "c string, k int")
    assert keyfilter.cut(rows, ["c", "k"], zero, ["c", "k"], 1024).filter("k = 0").count() == 2
    texts = spark.createDataFrame([("a", "0")], "c string, k string")
    assert keyfilter.cut(rows, ["c", "k"], texts, ["c", "k"], 1024).count() == 4  # a text and a number are left to the join
    assert keyfilter.cut(rows, ["c", "k"], zero, ["c", "k"], None).count() == 4


def test_size():
    assert keyfilter.filter_bits(0) == 1024
    assert keyfilter.filter_bits(10_000) == 1 << 18
    assert keyfilter.filter_bits(5_000_000) == keyfilter.MOST_BITS
    assert keyfilter.filter_bits(100_000_000) is None


@pytest.mark.parametrize("few", [0, 1 << 30])
def test_lookups_are_cut_at_any_number_of_keys(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(spec, "FEW_KEYS", min(few, 10_000))
    source = lake(spark, tmp_path)
    parties = source("parties").selectExpr("* except (id)", "explode(sequence(1L, 3000L)) as id").withColumn("id", F.expr("if(id = 1, 1L, id + 10)"))
    parties.write.parquet(f"{tmp_path}/many")
    many = spark.read.parquet(f"{tmp_path}/many")
    reads = {"parties": many, "sl_sales_orders": source("sl_sales_orders")}.__getitem__
    keys = Keys.of(spark.createDataFrame([("t1", 1), ("t1", 5)], "client_id string, id long"))
    got = source_rows(BASE["sl_sales_orders"], reads, keys)
    want = source_rows(BASE["sl_sales_orders"], reads).filter("client_id = 't1' and id in (1, 5)")
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect())) and got.count() == 1
    text = plan(got)
    lookups = [lk for lk in BASE["sl_sales_orders"].lookups if lk.table == "parties"]
    assert lookups
    if few:
        assert "In(id, [1,5])" in text and text.count("LeftSemi") >= len(lookups)
    else:
        assert text.count("bit_or") >= len(lookups) and "LeftSemi" not in text
