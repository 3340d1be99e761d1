"""Bulk sync into the store: modes, rejects, status, isolation of failures, compaction."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

import erp
from docuweft import session
from docuweft.operators.embedding import HashingProvider
from docuweft.operators.status import latest_status
from docuweft.operators import store as store_module
from docuweft.operators.store import DocumentStore, as_changes, current_documents
from docuweft.functions import text
from docuweft.plans.registry import BASE, resolver
from docuweft.sources.tables import lake_source
from docuweft.operators.sync import FULL_REINDEX, RECREATE, delete_scope, sync

TABLES = ["sl_sales_orders", "parties"]


@pytest.fixture
def store(spark, tmp_path):
    return DocumentStore(spark, str(tmp_path / "docs"))


def source_of(spark, order_ids, clients=("t1",), **order):
    rows = [erp.filled("sl_sales_orders", client_id=c, id=i, **order) for c in clients for i in order_ids]
    parties = [erp.party(client_id=c) for c in clients]
    frames = {
        "sl_sales_orders": erp.frame(spark, "sl_sales_orders", *rows, types={"date": erp.TYPES["string"]}),
        "parties": erp.frame(spark, "parties", *parties),
    }
    return frames.__getitem__


def ids(store, **scope):
    return sorted(r["id"] for r in store.snapshot(**scope).select("id").collect())


def test_upsert_keeps_what_vanished_and_full_reindex_does_not(spark, store):
    sync(store, source_of(spark, [1, 2], date="2024-01-01"), ["t1"], TABLES)
    assert ids(store) == ["parties:1", "sl_sales_orders:1", "sl_sales_orders:2"]
    sync(store, source_of(spark, [2, 3], date="2024-01-01", status="new"), ["t1"], TABLES)
    assert ids(store, module="sales") == ["sl_sales_orders:1", "sl_sales_orders:2", "sl_sales_orders:3"]
    status = {r["id"]: r["status"] for r in store.snapshot(module="sales").collect()}
    assert status == {"sl_sales_orders:1": "[status]", "sl_sales_orders:2": "new", "sl_sales_orders:3": "new"}
    sync(store, source_of(spark, [3], date="2024-01-01"), ["t1"], ["sl_sales_orders"], mode=FULL_REINDEX)
    assert ids(store) == ["parties:1", "sl_sales_orders:3"]


def test_full_reindex_of_an_empty_table_clears_it(spark, store):
    sync(store, source_of(spark, [1], date="2024-01-01"), ["t1"], TABLES)
    runs = sync(store, source_of(spark, [1], date="2024-01-01", is_deleted=1), ["t1"], ["sl_sales_orders"], mode=FULL_REINDEX)
    assert ids(store) == ["parties:1"] and (runs["t1"].indexed, runs["t1"].errors) == (0, 0)


def test_recreate_clears_the_tenant_only(spark, store):
    source = source_of(spark, [1], clients=("t1", "t2"), date="2024-01-01")
    sync(store, source, ["t1", "t2"], TABLES)
    with pytest.raises(ValueError):
        sync(store, source, ["t1"], ["parties"], mode=RECREATE)
    sync(store, source, ["t1"], ["parties"], mode=RECREATE, force=True)
    assert ids(store, client_id="t1") == ["parties:1"]
    assert ids(store, client_id="t2") == ["parties:1", "sl_sales_orders:1"]


def test_tables_none_and_empty_and_unknown(spark, store):
    assert sync(store, source_of(spark, [1]), ["t1"], [])["t1"].total_tables == 0
    with pytest.raises(ValueError, match="nope"):
        sync(store, source_of(spark, [1]), ["t1"], ["nope"])


def test_failure_of_a_table_is_recorded_and_isolated(spark, store, tmp_path):
    path = str(tmp_path / "runs")
    runs = sync(store, source_of(spark, [1], date="bad"), ["t1"], ["drive", *TABLES], job_id="j1", runs_path=path)
    run = runs["t1"]
    assert (run.status, run.indexed, run.errors, run.failed_tables, run.completed_tables) == ("partial", 1, 2, ["drive"], 3)
    assert [r["reason"] for r in store.rejects().collect()] == ["bad_date:date"]
    (row,) = latest_status(spark.read.parquet(path), client_id="t1").collect()
    assert (row["status"], row["indexed"], row["errors"], row["failed_tables"]) == ("partial", 1, 2, ["drive"])
    assert latest_status(spark.read.parquet(path), client_id="t2").count() == 0


def test_vectors_and_their_length(spark, store):
    sync(store, source_of(spark, [1, 2], date="2024-01-01"), ["t1"], TABLES, make_provider=lambda: HashingProvider(16), dimension=16)
    rows = store.snapshot().collect()
    assert len(rows) == 3 and all(len(r["embedding"]) == 16 for r in rows)
    runs = sync(store, source_of(spark, [1], date="2024-01-01"), ["t1"], TABLES, make_provider=lambda: HashingProvider(8), dimension=16)
    assert (runs["t1"].indexed, runs["t1"].errors) == (0, 2)
    assert all(len(r["embedding"]) == 16 for r in store.snapshot().collect())


def test_commit_again_replaces_and_compaction_keeps_state(spark, store):
    docs = spark.createDataFrame([("t1", "sales", "sl_sales_orders", f"sl_sales_orders:{i}", i) for i in range(5)],
                                 "client_id string, module string, doc_type string, id string, source_id long")
    for _ in range(2):
        store.commit(as_changes(docs, "'put'", 10), "a")
    assert store.changes().count() == 5
    store.commit(as_changes(docs.filter("source_id = 1"), "'del_key'", 20), "b")
    before = ids(store)
    assert before == [f"sl_sales_orders:{i}" for i in (0, 2, 3, 4)]
    store.compact()
    assert store.changes().count() == 0 and ids(store) == before
    store.commit(as_changes(docs.filter("source_id = 3"), "'del_key'", 30), "c")
    again = store.commit(as_changes(docs.filter("source_id = 1"), "'put'", 40), "b")
    assert again != "b" and ids(store) == [f"sl_sales_orders:{i}" for i in (0, 1, 2, 4)]
    store.merge()
    assert len(store._open_commits()) == 1 and ids(store) == [f"sl_sales_orders:{i}" for i in (0, 1, 2, 4)]
    store.commit(delete_scope(spark, "del_type", 50, [{"client_id": "t1", "module": "sales", "doc_type": "sl_sales_orders"}]), "d")
    store.commit(as_changes(docs.filter("source_id = 2"), "'put'", 60), "e")
    store.merge()
    assert ids(store) == ["sl_sales_orders:2"]
    store.compact()
    assert ids(store) == ["sl_sales_orders:2"] and store.changes().count() == 0


def one(spark, seq, kind="put", status=None):
    row = spark.createDataFrame([("t1", "sales", "sl_sales_orders", "sl_sales_orders:1", 1, status)],
                                "client_id string, module string, doc_type string, id string, source_id long, status string")
    return as_changes(row, f"'{kind}'", seq)


@pytest.mark.parametrize("kind,scope", [("del_key", None), ("del_type", {"client_id": "t1", "module": "sales", "doc_type": "sl_sales_orders"}), ("del_tenant", {"client_id": "t1"})])
def test_what_comes_late_does_not_undo_what_is_newer(spark, store, kind, scope):
    store.commit(one(spark, 100, status="new"), "a")
    store.compact()
    store.commit(one(spark, 10, status="old"), "b")
    assert [r["status"] for r in store.snapshot().collect()] == ["new"]
    store.compact()
    assert [r["status"] for r in store.snapshot().collect()] == ["new"]
    store.commit(one(spark, 200, "del_key") if scope is None else delete_scope(spark, kind, 200, [scope]), "c")
    assert ids(store) == []
    store.compact()
    store.commit(one(spark, 150, status="late"), "d")
    assert ids(store) == []
    store.compact()
    store.compact()
    store.commit(one(spark, 300, status="newest"), "e")
    assert [r["status"] for r in store.snapshot().collect()] == ["newest"]


def test_rejects_outlive_compaction(spark, store):
    sync(store, source_of(spark, [1], date="bad"), ["t1"], TABLES)
    before = [tuple(r) for r in store.rejects().collect()]
    store.merge()
    store.compact()
    store.compact()
    assert [tuple(r) for r in store.rejects().collect()] == before and before[0][4] == "bad_date:date"


def test_sequence_numbers_of_two_drivers_rise(spark, store, monkeypatch):
    other = DocumentStore(spark, store.root)
    numbers = [s.next_seq() for _ in range(60) for s in (store, other)]
    assert numbers == sorted(set(numbers)) and all(b - a >= 2 for a, b in zip(numbers, numbers[1:]))
    from docuweft.operators import store as module

    monkeypatch.setattr(module.time, "time_ns", lambda: 0)
    assert other.next_seq() > numbers[-1]


def test_a_base_is_read_in_a_new_session(spark, store):
    store.commit(one(spark, 100, status="new"), "a")
    store.compact()
    other = DocumentStore(spark.newSession(), store.root)
    for table in other.spark.catalog.listTables():
        other.spark.sql(f"DROP TABLE {table.name}")
    assert ids(other) == ["sl_sales_orders:1"]


def test_only_the_failing_tenant_of_a_shared_job_is_recorded(spark, store):
    whole = source_of(spark, [1], clients=("t1", "t2", "t3"), date="2024-01-01")

    def source(table):
        bad = F.when(F.col("client_id") == "t2", F.raise_error(F.lit("broken")).cast("int"))
        return whole(table).withColumn("is_deleted", F.coalesce(bad, F.col("is_deleted")))

    runs = sync(store, source, ["t1", "t2", "t3"], ["parties"])
    assert {c: (r.status, r.indexed, r.failed_tables) for c, r in runs.items()} == {
        "t1": ("ok", 1, []), "t2": ("partial", 0, ["parties"]), "t3": ("ok", 1, []),
    }


def test_sync_takes_each_tenants_own_registry(spark, store):
    whole = source_of(spark, [1], clients=("t1", "t2"), date="2024-01-01")
    extra = replace(BASE["parties"], table="people", module="staff")
    resolve = resolver({"t2": {"sl_sales_orders": None, "parties": {"title": text.column("type")}, "people": extra}})
    runs = sync(store, lambda t: whole("parties" if t == "people" else t), ["t1", "t2"], ["parties"], resolve=resolve)
    assert all(r.status == "ok" for r in runs.values())
    sync(store, lambda t: whole("parties" if t == "people" else t), ["t2"], ["people"], resolve=resolve)
    assert ids(store, client_id="t2") == ["parties:1", "people:1"] and ids(store, client_id="t2", module="staff") == ["people:1"]
    titles = {r["client_id"]: r["title"] for r in store.snapshot(module="account").collect()}
    assert titles["t1"] == "Party · Ann Lee" and titles["t2"] != titles["t1"]
    with pytest.raises(ValueError, match="sl_sales_orders"):
        sync(store, whole, ["t2"], ["sl_sales_orders"], resolve=resolve)


def test_a_tenant_without_a_folder_has_no_rows(spark, store, tmp_path):
    whole = source_of(spark, [1], clients=("t1", "t2"), date="2024-01-01")
    for table, rows in (("parties", whole("parties")), ("sl_sales_orders", whole("sl_sales_orders").filter("client_id = 't1'"))):
        rows.write.partitionBy("client_id").parquet(f"{tmp_path}/lake/{table}")
    source = lake_source(spark, f"{tmp_path}/lake", client_ids=["t1", "t2"])
    runs = sync(store, source, ["t1", "t2"], TABLES)
    assert {c: (r.status, r.indexed) for c, r in runs.items()} == {"t1": ("ok", 2), "t2": ("ok", 1)}
    with pytest.raises(KeyError):
        source("no_such_table")


@pytest.mark.parametrize("few", [200_000, 0])
def test_deletes_joined_by_broadcast_or_shuffle(spark, monkeypatch, few):
    monkeypatch.setattr(session, "BROADCAST_ROWS", few)
    docs = spark.range(20).selectExpr("if(id < 10, 't1', 't2') as client_id", "'m' as module", "if(id % 2 = 0, 'a', 'b') as doc_type",
                                      "concat('x:', id) as id", "id as source_id")
    base = as_changes(docs.filter("source_id <> 19"), "'put'", 0).drop("kind", "reason")
    changes = as_changes(docs.filter("source_id in (1, 12)"), "'del_key'", 10).unionByName(
        delete_scope(spark, "del_type", 10, [{"client_id": "t1", "module": "m", "doc_type": "a"}])).unionByName(
        as_changes(docs.filter("source_id in (2, 19)"), "'put'", 10)).unionByName(
        delete_scope(spark, "del_tenant", 0, [{"client_id": "t2"}]))
    live = sorted(r["source_id"] for r in current_documents(changes, base).collect())
    assert live == [2, 3, 5, 7, 9, 10, 11, 13, 14, 15, 16, 17, 18, 19]


def test_snapshot_with_one_document_changed_very_often(spark):
    rows = spark.range(5000).selectExpr(
        "'t1' as client_id", "'m' as module", "'x' as doc_type", "if(id % 3 = 0, 'x:hot', concat('x:', id)) as id", "id as source_id", "cast(id as string) as status")
    changes = as_changes(rows, "'put'", 0).withColumn("seq", rows.sparkSession.range(1).selectExpr("1L").first()[0] + rows["source_id"])
    live = current_documents(changes)
    assert live.count() == 3334 and live.filter("id = 'x:hot'").first()["status"] == "4998"


def test_a_run_that_breaks_is_recorded_as_failed(spark, store, tmp_path, monkeypatch):
    path = str(tmp_path / "runs")

    def broken(*_, **__):
        raise OSError("no space")

    monkeypatch.setattr(DocumentStore, "commit", broken)
    with pytest.raises(OSError):
        sync(store, source_of(spark, [1]), ["t1"], mode=RECREATE, runs_path=path)
    (row,) = latest_status(spark.read.parquet(path), client_id="t1").collect()
    assert row["status"] == "failed" and row["completed_at"] is not None


def test_a_source_row_with_very_many_documents_is_dealt_in_slices(spark, store, monkeypatch):
    monkeypatch.setattr(store_module, "SLICE_ROWS", 100)
    docs = spark.range(1600).selectExpr(
        "'t1' as client_id", "'m' as module", "'x' as doc_type", "concat('x:', id) as id", "if(id % 2 = 0, 2000L, if(id % 4 = 1, 9L, id)) as source_id",
        "'old' as status")
    store.commit(as_changes(docs, "'put'", 0), "first")
    store.compact()
    slices = {r["source_id"]: r["slices"] for r in store.slices().many.collect()}
    assert slices == {2000: 8, 9: 4}
    sizes = [r["count"] for r in store.base().groupBy("source_id", "slice").count().collect()]
    assert sum(sizes) == 1600 and max(sizes) < 160
    newer = docs.filter("source_id = 2000 and cast(substring(id, 3) as int) % 10 = 0").withColumn("status", F.lit("new"))
    older = docs.filter("source_id % 4 = 3 and source_id < 200").withColumn("status", F.lit("late"))
    gone = docs.filter("source_id in (9, 203)").select("client_id", "module", "doc_type", "source_id").distinct()
    changes = as_changes(newer, "'put'", 10).unionByName(as_changes(older, "'put'", -2)).unionByName(as_changes(gone, "'del_key'", 10))
    store.commit(changes, "second")
    want = {"old": 1600 - 400 - 1 - 160, "new": 160}
    for _ in range(2):  # before and after the changes are taken in
        assert {r["status"]: r["count"] for r in store.snapshot().groupBy("status").count().collect()} == want
        store.compact()
    assert {r["source_id"]: r["slices"] for r in store.slices().many.collect()} == {2000: 8}


def _put(spark, number, seq):
    row = spark.range(number, number + 1).selectExpr("'t1' as client_id", "'m' as module", "'x' as doc_type", "concat('x:', id) as id", "id as source_id")
    return as_changes(row, "'put'", seq)


def test_heads_of_drivers_whose_clocks_differ(spark, tmp_path, monkeypatch):
    one, other = DocumentStore(spark, str(tmp_path / "docs")), DocumentStore(spark, str(tmp_path / "docs"))
    one.commit(_put(spark, 1, 10), "a")
    one.merge()
    monkeypatch.setattr(store_module.time, "time_ns", lambda: 1_000)
    other.commit(_put(spark, 2, 20), "b")
    other.compact()
    other.commit(_put(spark, 3, 30), "c")
    other.merge()
    monkeypatch.undo()
    assert {"a", "b", "c"} <= one._head()[1] and one._head() == other._head() and len(one._heads()) == 3
    assert ids(one) == ["x:1", "x:2", "x:3"]


def test_a_head_that_another_driver_was_sooner_to_write_is_taken_in(spark, tmp_path):
    one, other = DocumentStore(spark, str(tmp_path / "docs")), DocumentStore(spark, str(tmp_path / "docs"))
    one.commit(_put(spark, 1, 10), "a")
    one._change_head(lambda base, taken: (base, taken | {"gone"}))
    calls = []

    def change(base, taken):
        if not calls:
            one._change_head(lambda base, taken: (base, taken | {"theirs"}))
        calls.append(taken)
        return base, taken | {"ours"}

    other._change_head(change)
    assert calls == [{"gone"}, {"gone", "theirs"}] and one._head() == (None, {"gone", "theirs", "ours"})


def test_a_base_gives_way_to_one_put_in_force_meanwhile(spark, tmp_path, monkeypatch):
    one, other = DocumentStore(spark, str(tmp_path / "docs")), DocumentStore(spark, str(tmp_path / "docs"))
    one.commit(_put(spark, 1, 10), "a")
    made = store_module.many_sliced

    def slowly(staged):
        monkeypatch.setattr(store_module, "many_sliced", made)
        other.commit(_put(spark, 2, 20), "b")
        other.compact()
        return made(staged)

    monkeypatch.setattr(store_module, "many_sliced", slowly)
    one.compact()
    assert one._head()[1] == {"a", "b"} and one.changes().count() == 0 and ids(one) == ["x:1", "x:2"]


def test_a_bucket_of_a_base_holds_few_documents():
    for documents in (0, 900_000, 9_000_000, 54_000_000, 500_000_000):
        assert documents / store_module.buckets_for(documents) <= 113_000
