"""Which stream belongs to which tenant and table, and whether that map is sound."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import index_name, stream_key
from ..plans.registry import Resolve, resolve_base
from ..session import broadcast_if_small, local_frame

# Fixed value: what a tenant id looks like.
CLIENT_ID_PATTERN = "^[a-z][a-z0-9_]{1,30}$"
REQUIRED = ("client_id", "db_name", "cdc_topic_prefix")


def known_tables(
    spark: SparkSession, client_ids: list[str], resolve: Resolve = resolve_base
) -> DataFrame:
    """(client_id, table, module) of every table a tenant indexes: tenants times tables, configuration only."""
    rows = [(c, t, s.module) for c in client_ids for t, s in resolve(c).items()]
    return local_frame(spark, rows, "client_id string, table string, module string")


def stream_map(tenants: DataFrame, tables: DataFrame) -> DataFrame:
    """(stream, client_id, table, module, index_name) for every tenant and table it indexes."""
    joined = tenants.select(*REQUIRED).join(tables, "client_id")
    return joined.select(
        stream_key(F.col("cdc_topic_prefix"), F.col("db_name"), F.col("table")).alias("stream"),
        "client_id", "table", "module",
        index_name(F.col("client_id"), F.col("module")).alias("index_name"),
    )


def route(events: DataFrame, streams: DataFrame) -> DataFrame:
    """Events with the tenant of their stream; a null client_id where no tenant owns it.

    The map is configuration and goes to the events, so that a busy stream is
    not gathered; a map too large for that is joined by a shuffle that splits.
    """
    owners = broadcast_if_small(streams.select("stream", "client_id"))
    return events.join(owners, "stream", "left")


def route_violations(tenants: DataFrame) -> DataFrame:
    """(client_id, violation) of tenant rows that would misroute events."""
    blank = [F.when(F.col(c).isNull() | (F.trim(c) == ""), F.lit(f"missing_{c}")) for c in REQUIRED]
    dotted = [
        F.when(F.contains(F.col(c), F.lit(".")), F.lit(f"dot_in_{c}")) for c in ("db_name", "cdc_topic_prefix")
    ]
    malformed = F.when(~F.col("client_id").rlike(CLIENT_ID_PATTERN), F.lit("bad_client_id"))
    found = F.array_compact(F.array(*blank, *dotted, malformed))
    per_row = tenants.select("client_id", F.explode(found).alias("violation"))
    return (
        per_row.unionByName(_shared(tenants, ["client_id"], "duplicate_client_id"))
        .unionByName(_shared(tenants, ["cdc_topic_prefix", "db_name"], "shared_routing_key"))
        .distinct()
    )


def _shared(tenants: DataFrame, key: list[str], violation: str) -> DataFrame:
    repeated = tenants.dropna(subset=key).groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    return tenants.join(repeated, key, "left_semi").select("client_id", F.lit(violation).alias("violation"))
