"""Watching the tables: vector drift, lag and backlog."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: stream depth that raises an alarm.
BACKLOG_LIMIT = 1000


def dimension_drift(documents: DataFrame, expected: int) -> DataFrame:
    """(client_id, module, dimension, documents) where stored vectors are not of the expected length."""
    sized = documents.filter(F.col("embedding").isNotNull()).withColumn("dimension", F.size("embedding"))
    found = sized.filter(F.col("dimension") != expected)
    return found.groupBy("client_id", "module", "dimension").agg(F.count("*").alias("documents"))


def lag_by_tenant(positions: DataFrame, streams: DataFrame) -> DataFrame:
    """Unread plus pending messages per tenant from (stream, latest, committed, pending)."""
    waiting = F.greatest(F.col("latest") - F.col("committed"), F.lit(0)) + F.coalesce("pending", F.lit(0))
    owned = positions.join(streams.select("stream", "client_id"), "stream")
    return owned.groupBy("client_id").agg(F.sum(waiting).alias("lag"))


def backlog(events: DataFrame, limit: int = BACKLOG_LIMIT) -> DataFrame:
    """Streams holding more messages than the limit."""
    return events.groupBy("stream").agg(F.count("*").alias("depth")).filter(F.col("depth") > limit)


def _offsets(told: str | dict | None) -> dict:
    """The offsets of a report, which tells them as an object or as its text."""
    return (json.loads(told) if isinstance(told, str) else told) or {}


def positions_from_progress(progress: list[dict]) -> list[tuple[str, int, int, int]]:
    """(stream, latest, committed, pending) of the sources of a progress report.

    A Kafka source tells offsets per topic and partition; a file source, whose
    stream is its description, only how many batches of files it has listed.
    """
    rows = []
    for source in progress:
        latest, committed = (_offsets(source.get(k)) for k in ("latestOffset", "endOffset"))
        if "logOffset" in committed:
            done = committed["logOffset"] + 1
            rows.append((source["description"], max(done, latest.get("logOffset", -1) + 1), done, 0))
            continue
        for topic, offsets in latest.items():
            done = committed.get(topic, {})
            rows.append((topic, sum(offsets.values()), sum(done.get(p, 0) for p in offsets), 0))
    return rows
