"""Change events: decode, sort out, and turn into changes of the document store."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.registry import Resolve, by_spec, resolve_base
from ..plans.spec import Keys, Source, TableSpec, source_rows
from ..schema import DEL_KEY
from ..session import broadcast_if_small, written
from .documents import checked_documents, checked_narrow_documents, with_vector_check
from .embedding import Provider, embed_documents
from .routing import route
from .store import as_changes
from .sync import PUT_OR_REJECT

# Fixed value: deliveries after which an event goes to the dead letters.
MAX_DELIVERIES = 5
# Fixed value: unconfirmed messages looked at per stream at a time.
PENDING_BATCH = 50
DELETE, UPSERT, SKIP, DEAD = "delete", "upsert", "skip", "dead"
_FOUND = "_found"
_DELETED = f"'{DEL_KEY}'"

_IMAGE = "struct<id: string>"
_EVENT = f"op: string, source: struct<table: string>, before: {_IMAGE}, after: {_IMAGE}"
_MESSAGE = f"struct<{_EVENT}, payload: struct<{_EVENT}>, _corrupt: string>"


def parse_events(raw: DataFrame, streams: DataFrame) -> DataFrame:
    """Messages (stream, msg_id, value) as events of a tenant, with a reason where one is skipped.

    The event may be the message itself or sit under ``payload``; only the ids
    of the row images are decoded.
    """
    message = F.from_json("value", _MESSAGE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    decoded = raw.withColumn("_m", message)
    wrapped = F.col("_m.payload").isNotNull()

    def part(path: str) -> Column:
        return F.when(wrapped, F.col(f"_m.payload.{path}")).otherwise(F.col(f"_m.{path}"))

    events = route(decoded, streams).select(
        "stream", "msg_id", "value", "client_id",
        part("source.table").alias("table"),
        F.coalesce(part("op"), F.lit("c")).alias("op"),
        part("before.id").try_cast("long").alias("before_id"),
        part("after.id").try_cast("long").alias("after_id"),
        (F.col("_m").isNull() | F.col("_m._corrupt").isNotNull()).alias("_malformed"),
    )
    reason = (
        F.when(F.col("client_id").isNull(), "no_route")
        .when(F.coalesce("value", F.lit("")) == "", "empty")
        .when(F.col("_malformed"), "malformed")
        .when(F.coalesce("table", F.lit("")) == "", "no_table")
    )
    return events.withColumn("skip_reason", reason).drop("_malformed")


def classify(events: DataFrame, tables: DataFrame) -> DataFrame:
    """What to do with each event: delete, upsert, skip or dead, the row id it is about, and why."""
    known = broadcast_if_small(tables.select("client_id", "table", F.lit(True).alias("_known")))
    joined = events.join(known, ["client_id", "table"], "left")
    is_delete = F.col("op") == "d"
    row_id = F.when(is_delete, F.col("before_id")).otherwise(F.col("after_id"))
    why = (
        F.when(F.col("skip_reason").isNotNull(), F.col("skip_reason"))
        .when(F.col("_known").isNull(), "unknown_table")
        .when(row_id.isNull(), F.when(is_delete, "no_before_id").otherwise("no_id"))
    )
    action = (
        F.when(F.col("_why") == "no_before_id", DEAD)
        .when(F.col("_why").isNotNull(), SKIP)
        .when(is_delete, DELETE)
        .otherwise(UPSERT)
    )
    return (
        joined.withColumn("_why", why)
        .withColumn("action", action)
        .withColumn("row_id", F.when(F.col("action").isin(DELETE, UPSERT), row_id))
        .withColumn("skip_reason", F.col("_why"))
        .drop("_why", "_known")
    )


def changed_keys(classified: DataFrame, action: str) -> DataFrame:
    """Distinct (client_id, table, id) of an action; counted down before they are shuffled."""
    keys = classified.filter(F.col("action") == action)
    return keys.select("client_id", "table", F.col("row_id").alias("id")).distinct()


def refetch(spec: TableSpec, source: Source, keys: Keys) -> DataFrame:
    """Current rows of changed keys."""
    return source_rows(spec, source, keys)


def table_key_changes(
    spec: TableSpec,
    source: Source,
    keys: Keys,
    seq: int,
    make_provider: Callable[[], Provider] | None = None,
    dimension: int | None = None,
    narrow: bool = False,
    replace_fanout: bool = False,
) -> DataFrame:
    """Changes for upserted keys: their current documents, or a delete where no row is live.

    Found and missing keys come from one read, so they cannot disagree.  A
    junction table may hold very many rows of one key, which a left join from
    the keys could not split; there the missing keys are looked up on their own.
    ``replace_fanout`` also drops a key's documents that are no longer made.
    """
    build = checked_narrow_documents if narrow else checked_documents
    docs = build(refetch(spec, source, keys), spec, whole=False)
    wanted = keys.frame.select("client_id", F.col("id").alias("source_id"))
    if replace_fanout:
        cleared = wanted
    elif spec.junction:
        cleared = soft_deleted(spec, source, keys).withColumnRenamed("id", "source_id")
    else:
        cleared = None
        docs = wanted.join(docs.withColumn(_FOUND, F.lit(True)), ["client_id", "source_id"], "left")
    if make_provider is not None:
        docs = embed_documents(docs, make_provider)
    if dimension is not None:
        docs = with_vector_check(docs, dimension)
    if cleared is None:
        kind = f"if({_FOUND} is null, '{DEL_KEY}', {PUT_OR_REJECT})"
        return as_changes(_of_spec(docs, spec), kind, seq)
    return as_changes(docs, PUT_OR_REJECT, seq).unionByName(as_changes(_of_spec(cleared, spec), _DELETED, seq))


def _of_spec(rows: DataFrame, spec: TableSpec) -> DataFrame:
    return rows.withColumns({"doc_type": F.lit(spec.table), "module": F.lit(spec.module)})


def apply_changes(
    classified: DataFrame,
    source: Source,
    tables: DataFrame,
    seq: int,
    resolve: Resolve = resolve_base,
    **options,
) -> DataFrame:
    """All store changes of a batch of classified events: deletes first, then the present state.

    Deletes carry a lower sequence number than puts, so a key that is both
    deleted and upserted ends as its current row says.
    """
    deletes, upserts = batch_keys(classified, resolve)
    changes = as_changes(
        deletes.join(broadcast_if_small(tables), ["client_id", "table"]).select(
            "client_id", "module", F.col("table").alias("doc_type"), F.col("id").alias("source_id")
        ), _DELETED, seq,
    )
    for spec, keys in upserts:
        changes = changes.unionByName(table_key_changes(spec, source, keys, seq, **options))
    return changes


def batch_keys(classified: DataFrame, resolve: Resolve = resolve_base) -> tuple[DataFrame, list[tuple[TableSpec, Keys]]]:
    """Deleted keys (client_id, table, id), and per spec the upserted ones; the events are decoded once.

    Keys are written to the shared folder, as both are read from them.  Of each
    spec's upserts, those that are few become a filter the scan can use.
    """
    wanted = classified.filter(F.col("action").isin(DELETE, UPSERT))
    keys = written(wanted.select("action", "client_id", "table", F.col("row_id").alias("id")).distinct(), "keys")
    upserts = keys.filter(F.col("action") == UPSERT)
    # At most tenants times tables rows.
    touched = [(r["client_id"], r["table"], r["client_id"]) for r in upserts.select("client_id", "table").distinct().collect()]
    found = []
    for spec, client_ids in by_spec(sorted(touched), resolve):
        mine = upserts.filter((F.col("table") == spec.table) & F.col("client_id").isin(client_ids))
        found.append((spec, Keys.of(mine)))
    return keys.filter(F.col("action") == DELETE).drop("action"), found


def soft_deleted(spec: TableSpec, source: Source, keys: Keys) -> DataFrame:
    """Changed keys that have no live row any more."""
    found = source_rows(spec, source, keys).select("client_id", "id").distinct()
    return keys.frame.join(found, ["client_id", "id"], "left_anti")


def dead_letters(messages: DataFrame, reason: Column | str) -> DataFrame:
    reason = F.lit(reason) if isinstance(reason, str) else reason
    return messages.select("value", F.col("msg_id").alias("original_id"), "stream", reason.alias("reason"))


def next_pending(pending: DataFrame, size: int = PENDING_BATCH) -> DataFrame:
    """The oldest unconfirmed messages (stream, position, …) of each stream, a batch of them."""
    oldest = Window.partitionBy("stream").orderBy("position")
    return pending.withColumn("_n", F.row_number().over(oldest)).filter(F.col("_n") <= size).drop("_n")


def split_pending(pending: DataFrame, most: int = MAX_DELIVERIES) -> DataFrame:
    """Pending messages (…, deliveries) marked ``dead`` once delivered too often, else ``live``."""
    return pending.withColumn("fate", F.when(F.col("deliveries") >= most, "dead").otherwise("live"))
