"""What the plans must look like to hold at scale."""

import os

from pyspark.sql import functions as F

import erp
from docuweft.operators.store import DocumentStore, as_changes
from docuweft.plans.registry import BASE
from docuweft.operators.documents import build_documents
from docuweft.plans.spec import Keys, source_rows
from docuweft.search import bm25, knn, request
from docuweft.session import remove_written, written
from docuweft.sources.tables import lake_source, scan


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def lake(spark, folder):
    for table in ("sl_sales_orders", "parties"):
        row = erp.party() if table == "parties" else erp.filled(table)
        erp.frame(spark, table, row, {**row, "client_id": "t2"}).write.partitionBy("client_id").parquet(f"{folder}/{table}")
    return lake_source(spark, str(folder), client_ids=["t1"])


def test_scan_prunes_tenants_and_columns(spark, tmp_path):
    source = lake(spark, tmp_path)
    active = scan(source, "sl_sales_orders", client_id="t1").select("id", "status")
    text = plan(active)
    assert all("client_id=t1" in f for f in active.inputFiles()) and "PartitionFilters: [isnotnull(client_id" in text
    assert "ReadSchema: struct<id:bigint,status:string,is_deleted:int>" in text
    docs = build_documents(BASE["sl_sales_orders"], source).select("id", "status")
    assert "narration" not in plan(docs) and docs.count() == 1


def test_few_keys_reach_the_scan_and_cut_the_lookup(spark, tmp_path):
    source = lake(spark, tmp_path)
    keys = Keys.of(spark.createDataFrame([("t1", 1), ("t1", 5)], "client_id string, id long"))
    text = plan(source_rows(BASE["sl_sales_orders"], source, keys))
    assert "In(id, [1,5])" in text and "LeftSemi" in text
    assert source_rows(BASE["sl_sales_orders"], source, keys).count() == 1


def test_changes_of_any_number_do_not_shuffle_the_base(spark, tmp_path):
    store = DocumentStore(spark, str(tmp_path))
    docs = spark.range(1000).selectExpr("'t1' as client_id", "'m' as module", "'x' as doc_type", "concat('x:', id) as id", "id as source_id")
    store.commit(as_changes(docs, "'put'", 0), "a")
    store.compact()
    many = spark.range(250_000).selectExpr("'t1' as client_id", "'m' as module", "'x' as doc_type", "concat('x:', id) as id", "id as source_id")
    store.commit(as_changes(many, "'put'", 10).unionByName(as_changes(docs.limit(3), "'del_key'", 20)), "b")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        live = store.snapshot().select("id")
        text = plan(live)
        assert live.count() == 249_997
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = text.splitlines()
    scans = [n for n, line in enumerate(lines) if "Bucketed: true" in line]
    assert len(scans) == 2 and "WindowGroupLimit" in text
    for n in scans:  # up from each scan of the base the first join comes before any exchange
        depth = len(lines[n]) - len(lines[n].lstrip(" :+-"))
        above = []
        for line in reversed(lines[:n]):
            own = len(line) - len(line.lstrip(" :+-"))
            if own < depth:
                above.append(line)
                depth = own
        met = next(line for line in above if "Join" in line or "Exchange" in line)
        assert "Join" in met


def test_ranking_keeps_k_rows_per_task_and_does_not_shuffle_postings(spark):
    docs = spark.range(100).selectExpr("id", "concat('a b ', id) as text")
    index = bm25.kept_index(bm25.term_index(docs, "text"))
    text = plan(bm25.bm25_topk(index, docs.limit(3).selectExpr("id as query_id", "text as query"), 5))
    assert text.count("WindowGroupLimit") == 2 and "SortMergeJoin" not in text
    # down from the top: the only exchange on the way to the postings takes k rows per task and query
    steps = [line.strip(" :+-*()0123456789") for line in text.split("BroadcastExchange")[0].splitlines()]
    moved = [n for n, step in enumerate(steps) if step.startswith("Exchange")]
    assert len(moved) == 1 and steps[moved[0] + 1].startswith("WindowGroupLimit")
    vectors = docs.selectExpr("id", "array(1.0f, cast(id as float)) as embedding")
    text = plan(knn.knn_topk(vectors, vectors.limit(2).selectExpr("id as query_id", "embedding as vector"), 5))
    assert text.count("WindowGroupLimit") == 2 and "FlatMapCoGroups" in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_intermediate_tables_can_be_removed(spark):
    table = written(spark.range(5).toDF("id"), "some")
    (file, *_) = table.inputFiles()
    folder = file.removeprefix("file://").rpartition("/")[0]
    assert os.path.isdir(folder)
    remove_written(spark)
    assert not os.path.exists(folder)


def test_requests_join_by_tenant(spark, tmp_path):
    docs = build_documents(BASE["sl_sales_orders"], lake(spark, tmp_path))
    asked = spark.createDataFrame([(1, "t1", None, None, None, None, None, None)], (
        "query_id long, client_id string, modules array<string>, status array<string>, date_from date, date_to date, "
        "`limit` int, `offset` int"))
    text = plan(request.matches(docs, asked))
    assert "BroadcastHashJoin" in text and "NestedLoop" not in text and "Cartesian" not in text


def test_hot_foreign_key_is_split(spark):
    """With a third of the rows on one key and a third without any, the adaptive join splits what is left."""
    low = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB", "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in low}
    for k, v in low.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(0, 300_000, 1, 8).selectExpr(
            "'t1' as client_id", "id", "case id % 3 when 0 then 1 when 1 then null else id end as customer_id", "1L as company_id",
            "0 as is_deleted", "uuid() as narration",
        )
        parties = spark.range(2000).selectExpr("'t1' as client_id", "id", "7L as company_id", "concat('n', id) as name")
        got = source_rows(BASE["sl_sales_orders"], {"sl_sales_orders": rows, "parties": parties}.__getitem__)
        sizes = got.groupBy(F.spark_partition_id()).count().toPandas()["count"]
        final = got.select("id", "customer_name", "narration")
        final.collect()
        text = final._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in text
        assert sizes.sum() == 300_000 and got.filter("customer_name = 'n1'").count() == 100_000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
