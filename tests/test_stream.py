"""The change stream with a file source: every kind of event, replay, restart, dead letters."""

import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

import erp
from docuweft.operators import cdc, routing
from docuweft.operators.store import DocumentStore
from docuweft.operators.sync import sync
from docuweft.plans.registry import BASE
from docuweft.plans import spec
from docuweft.plans.spec import Keys
from docuweft.sample import tenants
from docuweft.sources.changes import file_changes
from docuweft.streaming.ingest import ChangeIngest

TENANTS = ["spar", "dev_env"]


class World:
    """Source tables that can change, a store, an event folder and the ingest over them."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.n = spark, folder, 0
        self.rows = {("spar", i): erp.party(client_id="spar", id=i, first_name=f"P{i}") for i in (1, 2, 3)}
        self.rows |= {("dev_env", i): erp.party(client_id="dev_env", id=i, first_name=f"D{i}") for i in (1, 2)}
        self.links = [("spar", 1, 5, 1), ("spar", 2, 6, 1)]
        self.fail = False
        self.store = DocumentStore(spark, f"{folder}/docs")
        tenants = spark.createDataFrame(
            [(t, "shared_db", f"cdc_{t}") for t in TENANTS], "client_id string, db_name string, cdc_topic_prefix string")
        tables = routing.known_tables(spark, TENANTS)
        self.ingest = ChangeIngest(self.store, self.source, routing.stream_map(tenants, tables), tables, f"{folder}/state")
        (folder / "events").mkdir()

    def source(self, table):
        if self.fail:
            raise RuntimeError("source is down")
        if table == "parties":
            return erp.frame(self.spark, "parties", *self.rows.values())
        if table == "item_companies":
            return self.spark.createDataFrame(self.links, "client_id string, id long, company_id long, item_id long")
        return erp.frame(self.spark, "items", *[erp.filled("items", client_id="spar", id=i) for i in (1, 2)])

    def send(self, *events, client="spar", table="parties"):
        lines = []
        for e in events:
            self.n += 1
            value = e if isinstance(e, str) else json.dumps({"source": {"table": table}, **e})
            lines.append(json.dumps({"stream": f"cdc_{client}.shared_db.{table}", "msg_id": f"{self.n}-0", "value": value}))
        (self.folder / "events" / f"{self.n:05d}.json").write_text("\n".join(lines))

    def run(self):
        query = self.ingest.start(file_changes(self.spark, str(self.folder / "events")), {"availableNow": True})
        query.awaitTermination(120)

    def titles(self):
        return {(r["client_id"], r["id"]): r["title"] for r in self.store.snapshot().collect()}


@pytest.fixture
def world(spark, tmp_path):
    return World(spark, tmp_path)


def upsert(i, op="u"):
    return {"op": op, "before": None, "after": {"id": i}}


def delete(i):
    return {"op": "d", "before": {"id": i}, "after": None}


def test_life_of_documents(world):
    sync(world.store, world.source, TENANTS, ["parties"])
    assert len(world.titles()) == 5
    world.rows["spar", 4] = erp.party(client_id="spar", id=4, first_name="New")
    world.rows["spar", 2]["first_name"] = "Changed"
    world.rows["spar", 3]["is_deleted"] = 1
    del world.rows["spar", 1]
    world.send(upsert(4, "c"), upsert(2), upsert(2), {"payload": {**upsert(3), "source": {"table": "parties"}}}, delete(1))
    world.send(upsert(1, "r"), client="dev_env")
    world.send("", "default", "[1, 2]", "7", '{"ddl": "x", "source": {}}', {"op": "u", "after": None}, {"op": "t"}, {"op": "d", "before": None})
    world.send(upsert(1), table="unknown")
    world.run()
    assert world.titles() == {
        ("spar", "parties:2"): "Party · Changed Lee", ("spar", "parties:4"): "Party · New Lee",
        ("dev_env", "parties:1"): "Party · D1 Lee", ("dev_env", "parties:2"): "Party · D2 Lee",
    }
    assert [r["reason"] for r in world.ingest.dead().collect()] == ["no_before_id"]
    # Restart from the checkpoint: only what is new is read, delete and re-insert end as present.
    world.rows["spar", 2]["first_name"] = "Again"
    world.send(delete(2), upsert(2), upsert(4), delete(4))
    del world.rows["spar", 4]
    world.run()
    assert world.titles()["spar", "parties:2"] == "Party · Again Lee" and ("spar", "parties:4") not in world.titles()


def test_replay_of_a_batch_changes_nothing(world, spark):
    raw = spark.createDataFrame([("cdc_spar.shared_db.parties", "1-0", json.dumps({"source": {"table": "parties"}, **upsert(1)}))],
                                "stream string, msg_id string, value string")
    world.ingest(raw, 0)
    first = world.titles()
    world.ingest(raw, 0)
    assert world.titles() == first == {("spar", "parties:1"): "Party · P1 Lee"}
    assert world.store.commits() == ["changes-0000000000"]


def test_commits_are_merged_now_and_then(world):
    world.ingest.merge_every = 2
    for n in (1, 2, 3):
        world.rows["spar", n]["first_name"] = f"Round{n}"
        world.send(upsert(n))
        world.run()
    assert len(world.store.commits()) == 4 and len(world.store._open_commits()) == 2
    assert set(world.titles().values()) == {f"Party · Round{n} Lee" for n in (1, 2, 3)}


def test_failing_batch_is_retried_then_dead_lettered(world):
    world.send(upsert(1), upsert(2))
    world.fail = True
    for _ in range(cdc.MAX_DELIVERIES):
        with pytest.raises(Exception, match="source is down"):
            world.run()
    assert world.titles() == {}
    world.run()
    letters = world.ingest.dead().filter("reason = 'max_retries_exceeded'").collect()
    assert [r["original_id"] for r in sorted(letters)] == ["1-0", "2-0"]
    world.fail = False
    world.send(upsert(3))
    world.run()
    assert world.titles() == {("spar", "parties:3"): "Party · P3 Lee"}


def test_only_the_failing_tenant_is_dead_lettered(world):
    world.send(upsert(1))
    world.send(upsert(2), client="dev_env")
    healthy = world.source

    def source(table):
        rows = healthy(table)
        broken = F.when((F.col("client_id") == "dev_env") & (F.col("id") > 0), F.raise_error(F.lit("bad tenant")).cast("int"))
        return rows.withColumn("is_deleted", F.coalesce(broken, F.col("is_deleted")))

    world.ingest.source = source
    for _ in range(cdc.MAX_DELIVERIES):
        with pytest.raises(Exception):
            world.run()
    world.run()
    assert world.titles() == {("spar", "parties:1"): "Party · P1 Lee"}
    assert [r["original_id"] for r in world.ingest.dead().collect()] == ["2-0"]


def test_unsound_routes_stop_the_ingest(world, spark):
    rows = [("spar", "db", "p"), ("dev_env", "db", "p")]
    tenants = spark.createDataFrame(rows, "client_id string, db_name string, cdc_topic_prefix string")
    with pytest.raises(ValueError, match="shared_routing_key"):
        ChangeIngest(world.store, world.source, world.ingest.streams, world.ingest.tables, str(world.folder), tenants=tenants)


@pytest.mark.parametrize("few", [10_000, 10])
def test_an_overridden_table_is_one_plan_for_any_number_of_keys(spark, world, monkeypatch, few):
    monkeypatch.setattr(spec, "FEW_KEYS", few)
    rows = spark.range(5000).selectExpr("'spar' as client_id", "'sl_opportunity_parties' as table", "id as row_id", "'upsert' as action")
    made = []

    def resolve(client_id):
        made.append(client_id)
        return dict(tenants.resolve(client_id)) | {"sl_opportunity_parties": replace(BASE["sl_opportunity_parties"], status="x")}

    _, upserts = cdc.batch_keys(rows, resolve)
    assert len(upserts) == 1 and made == ["spar"] and upserts[0][1].frame.count() == 5000


def test_stream_state_stays_small(world):
    world.ingest.merge_every = 5
    for n in range(12):
        raw = world.spark.createDataFrame([("cdc_spar.shared_db.parties", str(n), json.dumps({"source": {"table": "parties"}, **upsert(1 + n % 3)}))],
                                          "stream string, msg_id string, value string")
        world.ingest(raw, n)
    before = world.titles()
    world.store.compact()
    world.store.vacuum(older_than_seconds=0)
    assert world.titles() == before and len(before) == 3
    left = [str(p.relative_to(world.folder)) for p in world.folder.rglob("*") if p.is_dir()]
    assert not any("attempts/" in p or "dead/" in p for p in left)
    assert sum(p.startswith("docs/commits/") for p in left) == 0 and sum(p.startswith("docs/heads/") for p in left) <= 2
    assert sum(p.count("/") == 2 and p.startswith("docs/bases/") for p in left) == 1


def test_refused_document_fails_the_batch(world, spark):
    broken = erp.frame(spark, "parties", *world.rows.values()).withColumn("date_of_joining", erp_text("never"))
    world.ingest.source = {"parties": broken}.__getitem__
    world.send(upsert(1))
    with pytest.raises(Exception, match="refused"):
        world.run()


def erp_text(value):
    from pyspark.sql import functions as F

    return F.lit(value)


@pytest.mark.parametrize("replace", [False, True])
def test_junction_fanout(world, replace):
    world.ingest.options = {"replace_fanout": replace}
    world.send(upsert(1), upsert(2), table="items")
    world.run()
    assert sorted(i for _, i in world.titles()) == ["items:1:5", "items:1:6", "items:2:"]
    world.links.pop()
    world.send(upsert(1), upsert(9), table="items")
    world.run()
    stale = [] if replace else ["items:1:6"]
    assert sorted(i for _, i in world.titles()) == sorted(["items:1:5", "items:2:", *stale])


def test_many_keys_take_the_distributed_way(spark, world, monkeypatch):
    values = [{"source": {"table": "parties"}, **e} for e in (upsert(1), upsert(2), upsert(9), delete(3))]
    raw = spark.createDataFrame([("cdc_spar.shared_db.parties", str(n), json.dumps(v)) for n, v in enumerate(values)],
                                "stream string, msg_id string, value string")
    events = cdc.classify(cdc.parse_events(raw, world.ingest.streams), world.ingest.tables)

    def changes():
        rows = cdc.apply_changes(events, world.source, world.ingest.tables, 10)
        return sorted((r["kind"], r["source_id"], r["seq"], r["title"] or "") for r in rows.collect())

    few = changes()
    monkeypatch.setattr(spec, "FEW_KEYS", 1)
    assert changes() == few
    assert [(k, i) for k, i, _, _ in few] == [("del_key", 3), ("del_key", 9), ("put", 1), ("put", 2)]


def test_narrow_documents(spark, world):
    keys = Keys.listed(spark, [("spar", 1)])
    (row,) = cdc.table_key_changes(BASE["parties"], world.source, keys, 0, narrow=True).collect()
    assert row["title"] == "Party · P1 Lee" and row["party_name"] is None and row["vat_number"] is None


def test_pending_messages_split(spark):
    rows = [("s", 1, "a", 5), ("s", 2, "b", 4), ("s", 3, "c", 6), ("s", 4, "d", 1)]
    pending = spark.createDataFrame(rows, "stream string, position long, msg_id string, deliveries int")
    got = {r["msg_id"]: r["fate"] for r in cdc.split_pending(cdc.next_pending(pending)).collect()}
    assert got == {"a": "dead", "b": "live", "c": "dead", "d": "live"}
    assert sorted(r["msg_id"] for r in cdc.next_pending(pending, 2).collect()) == ["a", "b"]


def test_stream_map(spark, world):
    rows = {r["stream"]: (r["client_id"], r["index_name"]) for r in world.ingest.streams.collect()}
    assert len(rows) == 2 * 45
    assert rows["cdc_spar.shared_db.parties"] == ("spar", "spar_account")
    assert rows["cdc_dev_env.shared_db.sl_quotation"] == ("dev_env", "dev_env_sales")


def test_route_violations(spark):
    rows = [("spar", "db", "p"), ("spar", "db2", "q"), ("Spar", "db", "r"), ("1spar", "a.b", "s"), ("t4", None, "u"),
            ("t5", "shared", "same"), ("t6", "shared", "same"), ("ok_1", "db", "v")]
    got = routing.route_violations(spark.createDataFrame(rows, "client_id string, db_name string, cdc_topic_prefix string"))
    assert sorted(tuple(r) for r in got.collect()) == sorted([
        ("spar", "duplicate_client_id"), ("Spar", "bad_client_id"), ("1spar", "bad_client_id"), ("1spar", "dot_in_db_name"),
        ("t4", "missing_db_name"), ("t5", "shared_routing_key"), ("t6", "shared_routing_key"),
    ])
