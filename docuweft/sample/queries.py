"""One query per operator, over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..functions.columns import Columns
from ..functions.keys import index_name
from ..operators import cdc, quality, routing, status
from ..operators.documents import build_documents, checked_documents, checked_narrow_documents, accepted, rejects
from ..operators.embedding import HashingProvider, embed_documents
from ..operators.store import DocumentStore, as_changes, current_documents
from ..operators.sync import delete_scope, sync, table_changes
from ..plans.registry import BASE, modules, resolver
from ..plans.spec import Keys, TableSpec, lookup, source_rows
from ..schema import DEL_TENANT, DEL_TYPE
from ..search import bm25, hybrid, inverted, knn, request
from ..search.analyze import DOMAIN, ENGLISH, STANDARD, SYNONYMS_ONLY, Analyzer, analyzed, counted, exploded
from ..session import configure, shared_folder, written
from ..sources.tables import scan
from ..streaming.ingest import ChangeIngest
from . import registry, tenants
from .views import TENANTS, Tables, pick

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: Tables the given data has views for.
COVERED = ("sl_sales_orders", "purchase_invoices", "parties", "items", "mf_bom", "stock_transfers",
           "pr_purchase_requests", "expense_reimbursements")
SHOWN = ("client_id", "id", "source_id", "doc_type", "module", "company_id", "title", "reference", "status", "date",
         "amount", "text_content", "party_name", "company_name", "approval_status", "email", "delivery_status",
         "party_type", "item_type", "bill_date", "quantity", "expected_closing_date", "sales_price", "priority")


def query(make: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Register under the function's name; the function sees the tables."""

    @wraps(make)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return make(Tables(configure(spark), sf_dir))

    QUERIES[make.__name__] = run
    return make


def rows_of(t: Tables, table: str) -> DataFrame:
    return source_rows(BASE[table], t.source())


def docs_of(t: Tables, table: str) -> DataFrame:
    return build_documents(BASE[table], t.source())


# Scans, projections and scalar functions


@query
def scan_active(t):
    return scan(t.source(), "sl_sales_orders", client_id="spar").select("id", "status", "date")


@query
def project_override(t):
    return rows_of(t, "purchase_invoices").select("client_id", "id", "date", "company_id", "vendor_name")


@query
def doc_title(t):
    return docs_of(t, "sl_sales_orders").select("id", "title")


@query
def doc_prose(t):
    return docs_of(t, "sl_sales_orders").select("id", "text_content")


@query
def text_generic(t):
    rows = t.parties().drop("client_id")
    return rows.selectExpr("id", f"{text.generic_text(Columns(rows))} as text")


@query
def extract_amount(t):
    rows = t.sl_sales_orders()
    return rows.selectExpr("id", f"{text.extract_amount(Columns(rows))} as amount")


def _texts(t: Tables) -> DataFrame:
    """Order values written in several text forms."""
    return t.raw("orders").select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice").cast("decimal(18,2)").cast("string")).otherwise(
            pick("o_orderpriority", {
                "1-URGENT": "12.5", "2-HIGH": " 7\n", "3-MEDIUM": "abc", "4-NOT SPECIFIED": "1d", "5-LOW": "-1e3",
            })
        ).alias("number"),
        F.when(F.col("o_orderstatus") == "O", F.concat(F.lit("\t"), F.to_date("o_orderdate").cast("string"), F.lit(" ")))
        .otherwise(pick("o_orderpriority", {
            "1-URGENT": "soon", "2-HIGH": "", "3-MEDIUM": "2001-02-30", "5-LOW": " \n",
        })).alias("day"),
        F.col("o_orderdate").alias("moment"),
        (F.col("o_totalprice") > 250000).alias("flag"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
        F.col("o_custkey").alias("role"),
    )


@query
def coerce_float(t):
    rows = _texts(t)
    return rows.selectExpr("id", f"{Columns(rows).number('number')} as value")


@query
def coerce_str(t):
    rows = _texts(t)
    row = Columns(rows)
    cells = [f"{row.text(c)} as {c}" for c in ("flag", "price", "role")]
    return rows.selectExpr("id", *cells, f"{text.id_reference(row)} as reference")


@query
def normalise_date(t):
    rows = _texts(t)
    row = Columns(rows)
    return rows.selectExpr("id", f"{row.date('day')} as day", f"{row.bad_date('day')} as bad", f"{row.date('moment')} as moment")


@query
def resolve_party_name(t):
    rows = t.parties()
    return rows.selectExpr("id", f"{text.resolve_party_name(Columns(rows))} as party_name")


@query
def truthy_or(t):
    rows = t.parties()
    row = Columns(rows)
    email, first = row.first_truthy("email", "email_ids"), row.first_truthy("first_name", "last_name")
    return rows.selectExpr("id", f"{email} as email", f"{first} as first")


@query
def doc_id(t):
    return docs_of(t, "items").select("id", "source_id", "company_id")


@query
def embed_input(t):
    docs = docs_of(t, "parties")
    some = "if(party_type <> 'BUILDING', title, null)"
    return docs.selectExpr("id", f"{text.embed_input(some, 'text_content')} as embed_input")


@query
def sql_party_name(t):
    rows = t.parties()
    return rows.selectExpr("id", f"{text.sql_party_name(Columns(rows))} as party_name")


@query
def sql_concat_null(t):
    rows = t.employees()
    return rows.selectExpr("id", f"{text.sql_employee_name(Columns(rows))} as employee_name")


@query
def party_text(t):
    docs = docs_of(t, "parties")
    return docs.select("id", "title", "text_content")


# Joins


@query
def join_left_dim(t):
    return rows_of(t, "sl_sales_orders").select("client_id", "id", "customer_id", "customer_name", "company_id")


@query
def join_dim_twice(t):
    return rows_of(t, "stock_transfers").select("id", "source_location_name", "destination_location_name")


@query
def join_two_dims(t):
    return rows_of(t, "pr_purchase_requests").select("id", "department_name", "vendor_name", "approval_status")


@query
def join_junction_left(t):
    return rows_of(t, "items").select("id", "company_id", "item_type")


@query
def join_junction_inner(t):
    return rows_of(t, "mf_bom").select("id", "company_id", "item_name")


@query
def join_small_key_types(t):
    """Nations and regions looked up by keys of small types, some null."""
    keyed = t.raw("orders").selectExpr(
        "'spar' as client_id", "o_orderkey as id", "0 as is_deleted",
        "cast(if(o_orderkey % 3 <> 0, o_custkey % 40, null) as smallint) as small_id",
        "cast(if(o_orderkey % 4 <> 0, o_custkey % 7, null) as decimal(5,0)) as decimal_id",
    )
    named = {
        "orders": keyed,
        "nations": t.raw("nation").selectExpr("'spar' as client_id", "n_nationkey as id", "n_name as name"),
        "regions": t.raw("region").selectExpr("'spar' as client_id", "cast(r_regionkey as bigint) as id", "r_name as name"),
    }
    base = BASE["parties"]
    spec = TableSpec("orders", "sales", base.title, base.text, (
        lookup("nations", "small_id", small_name="name"), lookup("regions", "decimal_id", decimal_name="name"),
    ))
    return source_rows(spec, named.__getitem__).select("id", "small_name", "decimal_name")


# Documents


@query
def documents_union(t):
    merged = None
    for table in COVERED:
        docs = docs_of(t, table).select(*SHOWN)
        merged = docs if merged is None else merged.unionByName(docs)
    return merged


def _register_module(module: str) -> None:
    def make(t: Tables) -> DataFrame:
        return registry.documents_of_module(t, module)

    make.__name__ = f"registry_{module}"
    query(make)


for _module in modules():
    _register_module(_module)


@query
def build_documents_full(t):
    return docs_of(t, "sl_sales_orders").drop("embedding")


@query
def build_documents_narrow(t):
    rows = rows_of(t, "parties")
    return accepted(checked_narrow_documents(rows, BASE["parties"])).drop("embedding")


@query
def tenant_override(t):
    return build_documents(tenants.resolve("spar")["sl_opportunity_parties"], _opportunities(t)).select(
        "client_id", "id", "title", "company_id", "amount", "text_content"
    )


def _opportunities(t: Tables):
    orders = t.sl_sales_orders().withColumnRenamed("customer_id", "party_id").drop("company_id", "expected_closing_date")
    orders = orders.withColumns({"stages": F.col("priority"), "expected_revenue": F.col("total_amount")})
    return lambda table: orders if table == "sl_opportunity_parties" else t.source()(table)


@query
def doc_rejects(t):
    checked = [checked_documents(rows_of(t, table), BASE[table]) for table in ("sl_sales_orders", "items")]
    return rejects(checked[0]).unionByName(rejects(checked[1]))


@query
def embed_documents_vectors(t):
    """Every number of every vector that is not zero."""
    docs = embed_documents(docs_of(t, "sl_sales_orders"), lambda: HashingProvider(64))
    cells = docs.select("id", F.posexplode("embedding").alias("bucket", "x")).filter("x <> 0")
    return cells.select("id", "bucket", F.round(F.col("x").cast("double"), 4).alias("value"))


@query
def dimension_drift(t):
    docs = t.raw("embeddings").select(
        F.when(F.col("label") < 5, "spar").otherwise("dev_env").alias("client_id"),
        F.when(F.col("label") == 0, "account").otherwise("sales").alias("module"),
        F.when(F.col("label").isin(3, 7), F.slice("embedding", 1, 32)).otherwise(F.col("embedding")).alias("embedding"),
    )
    return quality.dimension_drift(docs, 64)


# Store and sync


def _stored(t: Tables) -> DataFrame:
    return as_changes(docs_of(t, "sl_sales_orders"), "'put'", 0)


def _incoming(t: Tables, seq: int = 10) -> DataFrame:
    """Open orders come in again with a new status."""
    open_ = docs_of(t, "sl_sales_orders").filter(F.col("status") == "O")
    return as_changes(open_.withColumn("status", F.lit("X")), "'put'", seq)


def _state(changes: DataFrame, base: DataFrame | None = None) -> DataFrame:
    return current_documents(changes, base).select("client_id", "id", "status", "seq")


@query
def sync_upsert(t):
    return _state(_stored(t).unionByName(_incoming(t)))


@query
def full_reindex(t):
    scope = [{"client_id": "spar", "module": "sales", "doc_type": "sl_sales_orders"}]
    return _state(_stored(t).unionByName(delete_scope(t.spark, DEL_TYPE, 10, scope)).unionByName(_incoming(t)))


@query
def recreate_indices(t):
    gone = delete_scope(t.spark, DEL_TENANT, 10, [{"client_id": "spar"}])
    return _state(_stored(t).unionByName(gone).unionByName(_incoming(t)))


@query
def delete_by_source_id(t):
    closed = docs_of(t, "sl_sales_orders").filter(F.col("status") == "F")
    gone = as_changes(closed.select("client_id", "module", "doc_type", "source_id"), "'del_key'", 20)
    return _state(_stored(t).unionByName(gone).unionByName(_incoming(t, 30)))


@query
def upsert_apply(t):
    """Change events applied over a base of stored documents, counted per index."""
    events = cdc.classify(_parsed(t), _tables(t))
    changes = written(cdc.apply_changes(events, t.source(), _tables(t), 100, tenants.resolve), "changes")
    base = as_changes(docs_of(t, "parties"), "'put'", 0).drop("kind", "reason")
    live = current_documents(changes, base)
    index = index_name(F.col("client_id"), F.col("module")).alias("index_name")
    return live.groupBy(index, "seq").agg(F.count("*").alias("documents"), F.sum("source_id").alias("ids"))


@query
def sync_counts(t):
    orders = table_changes(BASE["sl_sales_orders"], t.source(), 0)
    items = table_changes(BASE["items"], t.source(), 0)
    return status.sync_counts(orders.unionByName(items))


@query
def store_end_to_end(t):
    """A sync of two tables written to a store, then a batch of change events, read back."""
    folder = f"{shared_folder(t.spark)}/store-{uuid.uuid4().hex}"
    store = DocumentStore(t.spark, f"{folder}/documents")
    sync(store, t.source(), TENANTS, ["sl_sales_orders", "parties"], resolve=tenants.resolve)
    ingest = ChangeIngest(store, t.source(), _streams(t), _tables(t), f"{folder}/state", resolve=tenants.resolve)
    ingest(t.raw_events(), 0)
    return store.snapshot().select("client_id", "id", "doc_type", "title", "amount")


def _new_store(t: Tables) -> DocumentStore:
    return DocumentStore(t.spark, f"{shared_folder(t.spark)}/store-{uuid.uuid4().hex}")


def _open_orders(t: Tables) -> DataFrame:
    return docs_of(t, "sl_sales_orders").filter(F.col("status") == "O")


@query
def store_compact_then_late_put(t):
    """Documents of a base, then an older state of them that comes late."""
    store = _new_store(t)
    store.commit(as_changes(_open_orders(t), "'put'", 100), "newer")
    store.compact()
    store.commit(as_changes(_open_orders(t).withColumn("status", F.lit("old")), "'put'", 10), "late")
    return store.snapshot().select("client_id", "id", "status", "seq")


@query
def store_compact_then_late_delete(t):
    """Documents deleted before a compaction, then put again by a writer that began before the delete."""
    store = _new_store(t)
    store.commit(_stored(t), "first")
    gone = _open_orders(t).select("client_id", "module", "doc_type", "source_id")
    store.commit(as_changes(gone, "'del_key'", 100), "delete")
    store.compact()
    store.commit(as_changes(_open_orders(t), "'put'", 10), "late")
    return store.snapshot().select("client_id", "id", "status", "seq")


@query
def rejects_after_compact(t):
    store = _new_store(t)
    store.commit(table_changes(BASE["sl_sales_orders"], t.source(), 0), "sync")
    store.compact()
    return store.rejects().select("client_id", "doc_type", "source_id", "reason")


@query
def sync_with_overrides(t):
    """A tenant that changes a table, drops one and adds one, beside a tenant that has the base."""
    title = BASE["sl_sales_orders"].title
    resolve = resolver({"dev_env": {
        "sl_sales_orders": {"title": lambda row: f"concat('again ', {title(row)})"},
        "parties": None,
        "people": replace(BASE["parties"], table="people"),
    }})
    store, source = _new_store(t), t.source()
    plain = ["sl_sales_orders", "parties"]
    sync(store, source, ["spar"], plain, resolve=resolve)
    sync(store, lambda name: source("parties" if name == "people" else name), ["dev_env"], ["sl_sales_orders", "people"], resolve=resolve)
    return store.snapshot().select("client_id", "id", "doc_type", "title")


def _runs(t: Tables) -> DataFrame:
    """Events as run states: the user is the job, the time the moment of the change."""
    return t.raw("events").select(
        F.concat(F.lit("job-"), "user_id").alias("job_id"),
        F.when(F.col("user_id") < 100, "spar").otherwise("dev_env").alias("client_id"),
        F.when(F.col("event_type") == "error", "failed").otherwise("running").alias("status"),
        F.col("event_id").alias("indexed"), F.col("ts").alias("updated_at"),
    )


@query
def job_status_latest(t):
    return status.latest_status(_runs(t), client_id="spar").select("job_id", "client_id", "status", "indexed")


@query
def job_summary(t):
    """Users as jobs and event types as their tables; a type with a very high value has failed."""
    tables = t.raw("events").groupBy(
        F.concat(F.lit("job-"), "user_id").alias("job_id"), F.lit("spar").alias("client_id"), F.col("event_type").alias("doc_type")
    ).agg(
        F.sum("event_id").alias("indexed"), F.sum(F.length("props")).alias("errors"), (F.max("value") > 200).alias("failed")
    )
    return status.summarise(tables).withColumn("failed_tables", F.array_join("failed_tables", ","))


# Change events


def _tables(t: Tables) -> DataFrame:
    return routing.known_tables(t.spark, list(TENANTS), tenants.resolve)


def _streams(t: Tables) -> DataFrame:
    return routing.stream_map(t.stream_tenants(), _tables(t))


def _parsed(t: Tables) -> DataFrame:
    return cdc.parse_events(t.raw_events(), _streams(t))


def _keys(t: Tables) -> Keys:
    return Keys.of(cdc.changed_keys(cdc.classify(_parsed(t), _tables(t)), cdc.UPSERT).select("client_id", "id"))


@query
def cdc_parse(t):
    return _parsed(t).drop("value", "stream")


@query
def cdc_classify(t):
    return cdc.classify(_parsed(t), _tables(t)).select("msg_id", "action", "row_id", "skip_reason")


@query
def cdc_compact(t):
    events = cdc.classify(_parsed(t), _tables(t))
    deletes = cdc.changed_keys(events, cdc.DELETE).withColumn("action", F.lit("delete"))
    return deletes.unionByName(cdc.changed_keys(events, cdc.UPSERT).withColumn("action", F.lit("upsert")))


@query
def cdc_refetch(t):
    return cdc.refetch(BASE["parties"], t.source(), _keys(t)).select("client_id", "id", "name", "party_type")


@query
def cdc_soft_delete(t):
    return cdc.soft_deleted(BASE["parties"], t.source(), _keys(t))


@query
def cdc_apply(t):
    events = cdc.classify(_parsed(t), _tables(t))
    changes = cdc.apply_changes(events, t.source(), _tables(t), 100, tenants.resolve)
    return changes.select("client_id", "kind", "seq", "doc_type", "source_id", "id", "title")


@query
def cdc_apply_override(t):
    """Each user's row of an overridden table as changed."""
    events = t.raw("events").select(
        F.lit("spar").alias("client_id"), F.lit("sl_opportunity_parties").alias("table"), F.col("user_id").alias("row_id"), F.lit("upsert").alias("action")
    )
    changes = cdc.apply_changes(events, _opportunities(t), _tables(t), 100, tenants.resolve)
    return changes.select("source_id", "kind", "title", "company_id")


@query
def cdc_lag(t):
    events = t.raw_events().join(t.raw("events").select(F.col("event_id").cast("string").alias("msg_id"), "ts", "event_type"), "msg_id")
    positions = events.groupBy("stream").agg(
        F.count("*").alias("latest"), F.count_if(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz")).alias("committed"),
        F.count_if(F.col("event_type") == "error").alias("pending"),
    )
    return quality.lag_by_tenant(positions, _streams(t))


@query
def cdc_backlog(t):
    return quality.backlog(t.raw_events())


@query
def dead_letter_split(t):
    pending = t.raw("events").select(
        F.concat(F.lit("stream-"), "event_type").alias("stream"), F.col("event_id").alias("position"),
        F.floor(F.col("value") / 20).alias("deliveries"),
    )
    return cdc.split_pending(cdc.next_pending(pending))


@query
def dead_letters(t):
    events = cdc.classify(_parsed(t), _tables(t)).filter(F.col("action") == cdc.DEAD)
    return cdc.dead_letters(events, F.col("skip_reason"))


@query
def stream_route(t):
    return routing.route(t.raw_events(), _streams(t)).select("msg_id", "stream", "client_id")


@query
def stream_map(t):
    events = t.raw_events().groupBy("stream").agg(F.count("*").alias("events"))
    return _streams(t).join(events, "stream", "left").fillna(0, ["events"])


@query
def route_violations(t):
    return routing.route_violations(t.tenant_config())


@query
def tenant_isolation(t):
    docs = docs_of(t, "sl_sales_orders").select("client_id", "module").unionByName(
        docs_of(t, "parties").select("client_id", "module")
    )
    index = index_name(F.col("client_id"), F.col("module")).alias("index_name")
    return docs.select("client_id", index).groupBy("index_name").agg(
        F.countDistinct("client_id").alias("tenants"), F.count("*").alias("documents")
    )


# Search


def _doc_terms(t: Tables, analyzer: Analyzer) -> DataFrame:
    docs = t.raw("documents").select("doc_id", "text")
    return exploded(counted(analyzed(docs, "text", analyzer).drop("text")))


@query
def analyze_terms(t):
    return _doc_terms(t, STANDARD).select("doc_id", "length", "term", "tf")


@query
def analyze_english(t):
    return _doc_terms(t, ENGLISH).select("doc_id", "length", "term", "tf")


@query
def analyze_domain(t):
    docs = docs_of(t, "sl_sales_orders").select("id", "text_content")
    return exploded(counted(analyzed(docs, "text_content", DOMAIN).drop("text_content")))


@query
def field_indexes(t):
    """Terms of text fields, each under its own analyzer."""
    docs = docs_of(t, "sl_sales_orders").select("id", "title", "narration", "party_name")
    fields = [
        exploded(bm25.field_index(docs, f)).select(F.lit(f).alias("field"), "id", "term", "tf") for f in ("title", "narration", "party_name")
    ]
    return fields[0].unionByName(fields[1]).unionByName(fields[2])


@query
def expand_synonyms(t):
    docs = docs_of(t, "sl_sales_orders").select("id", "title")
    return exploded(counted(analyzed(docs, "title", SYNONYMS_ONLY).drop("title")))


@query
def term_stats(t):
    return bm25.term_stats(bm25.term_index(t.raw("documents"), "text", STANDARD, "doc_id"))


def _index(t: Tables, analyzer: Analyzer) -> inverted.InvertedIndex:
    return inverted.kept_inverted_index(bm25.term_index(t.raw("documents"), "text", analyzer, "doc_id"))


def _questions(t: Tables) -> DataFrame:
    return t.raw("benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


@query
def bm25_topk(t):
    return inverted.bm25_topk(_index(t, STANDARD), _questions(t), 10)


@query
def bm25_domain(t):
    return inverted.bm25_topk(_index(t, DOMAIN), _questions(t), 10, DOMAIN)


def _vectors(t: Tables) -> DataFrame:
    return t.raw("embeddings").select(F.col("vec_id").alias("id"), "embedding")


@query
def knn_topk(t):
    """Documents nearest to the mean vector of each label."""
    cells = t.raw("embeddings").select("label", F.posexplode("embedding").alias("at", "x"))
    means = cells.groupBy("label", "at").agg(F.avg(F.col("x").cast("double")).alias("x"))
    centres = means.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("at", "x"))).alias("c"))
    queries = centres.select(F.col("label").cast("long").alias("query_id"), F.col("c.x").alias("vector"))
    return knn.knn_topk(_vectors(t), queries, 10)


@query
def knn_mixed_lengths(t):
    """Two tenants whose models give vectors of different lengths, asked together."""
    mixed = t.raw("embeddings").select(
        F.when(F.col("label") < 5, "spar").otherwise("dev_env").alias("client_id"), F.col("vec_id").alias("id"),
        F.when(F.col("label") < 5, F.col("embedding")).otherwise(F.slice("embedding", 1, 32)).alias("embedding"),
    )
    queries = mixed.filter("id % 20 = 0").select("client_id", F.col("id").alias("query_id"), F.col("embedding").alias("vector"))
    return knn.knn_topk(mixed, queries, 5, "client_id")


@query
def knn_bad_vectors(t):
    """Vectors some of which are null, zero or hold what is no number."""
    part = F.col("vec_id") % 7
    broken = F.when(part == 0, F.transform("embedding", lambda x: F.lit(float("nan")).cast("float"))).when(
        part == 1, F.transform("embedding", lambda x: F.lit(0.0).cast("float"))
    ).when(part != 2, F.col("embedding"))
    vectors = t.raw("embeddings").select(F.col("vec_id").alias("id"), broken.alias("embedding"))
    queries = vectors.filter("id % 20 = 0").select(F.col("id").alias("query_id"), F.col("embedding").alias("vector"))
    return knn.knn_topk(vectors, queries, 5)


def _both(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Text hits of every question and vector hits of the questions that have a vector."""
    questions = _questions(t)
    vectors = t.raw("embeddings").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    asked = questions.join(vectors, "query_id").select("query_id", "vector")
    return inverted.bm25_topk(_index(t, STANDARD), questions, 50), knn.knn_topk(_vectors(t), asked, 50)


@query
def hybrid_search(t):
    return hybrid.hybrid(*_both(t), 10)


@query
def hybrid_fallback(t):
    return hybrid.fallback(*_both(t), 10)


@query
def search_filtered(t):
    return request.search(docs_of(t, "sl_sales_orders"), t.requests()).select("query_id", "id", "date", "status", "rank", "total")


@query
def search_text(t):
    """Requests with words: filtered, ranked by BM25 within their tenant, and paged."""
    docs = docs_of(t, "sl_sales_orders")
    index = inverted.kept_inverted_index(bm25.term_index(docs, "text_content", STANDARD, scope=["client_id"]), ["client_id"])
    words = F.when(F.col("query_id") < 8, "rush it order").when(F.col("query_id") < 16, "medium status O").otherwise("narration F rush")
    asked = t.requests().withColumn("query", words)
    scores = inverted.bm25_scores(index, bm25.query_terms(asked, STANDARD, ["client_id"]))
    return request.search(docs, asked, scores).select("query_id", "id", "score", "rank", "total")


@query
def search_exact(t):
    parties = request.exact(docs_of(t, "parties"), "party_type", ["MACHINERY", "AUTOMOBILE"])
    orders = request.exact(docs_of(t, "sl_sales_orders"), "status", ["O"])
    return parties.select("client_id", "id", "doc_type").unionByName(orders.select("client_id", "id", "doc_type"))


@query
def search_highlight(t):
    docs = t.raw("documents").select(
        F.col("doc_id").alias("id"), F.col("source").alias("title"), F.col("text").alias("text_content")
    )
    words = F.array(*[F.lit(w) for w in ("the", "und", "les", "src3")])
    marked = request.highlight(docs, words)
    return marked.select(
        "id", F.get(F.map_keys("highlight"), F.lit(0)).alias("first_field"),
        F.array_join(F.col("highlight")["title"], "|").alias("title"),
        F.array_join(F.col("highlight")["text_content"], "|").alias("text_content"),
    )
