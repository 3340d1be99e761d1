"""The change stream: each micro-batch becomes one commit, a failing one dead letters in the end."""

from __future__ import annotations

import json
import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.cdc import DEAD, DELETE, MAX_DELIVERIES, UPSERT, apply_changes, classify, dead_letters, parse_events
from ..operators.quality import lag_by_tenant, positions_from_progress
from ..operators.routing import route_violations
from ..operators.store import DocumentStore
from ..plans.registry import Resolve, resolve_base
from ..plans.spec import Source
from ..schema import REJECT
from ..session import local_frame

log = logging.getLogger(__name__)

# Fixed value: pause between micro-batches.
TRIGGER = "2 seconds"


class RejectedDocuments(RuntimeError):
    """Some documents of a batch were refused; the batch is tried again."""


@dataclass
class ChangeIngest:
    """Applies micro-batches of raw events to the store.

    Delivery is at least once: the checkpoint replays a batch until it succeeds,
    and a batch writes under its own number, so a replay replaces what it wrote.
    A batch that has failed too often is applied tenant by tenant, and only the
    events of tenants that still fail become dead letters.  ``tenants`` are the
    settings the stream map was made from; given, the ingest refuses to start
    with settings that would misroute events.  ``state`` is a shared folder for
    attempts and dead letters.  Every ``merge_every`` batches the store's small
    commits are put into one.
    """

    store: DocumentStore
    source: Source
    streams: DataFrame
    tables: DataFrame
    state: str
    name: str = "changes"
    resolve: Resolve = resolve_base
    fail_on_reject: bool = True
    merge_every: int = 1000
    tenants: DataFrame | None = None
    options: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.tenants is not None:
            found = route_violations(self.tenants).collect()  # a few rows per tenant at most
            if found:
                raise ValueError("unsound tenant settings: " + ", ".join(f"{r['client_id']} {r['violation']}" for r in found))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        label, attempts = f"{self.name}-{batch_id:010d}", self._attempts(batch_id)
        self._note_attempt(batch_id, attempts)
        classified = classify(parse_events(batch, self.streams), self.tables).persist()
        try:
            unreadable = dead_letters(classified.filter(F.col("action") == DEAD), F.col("skip_reason"))
            if attempts >= MAX_DELIVERIES:
                self._each_tenant(classified, unreadable, label)
            else:
                self._bury(unreadable, label)
                self._apply(classified, label)
        finally:
            classified.unpersist()
        self._forget_attempts(batch_id)
        if self.merge_every and (batch_id + 1) % self.merge_every == 0:
            self.store.merge()

    def _apply(self, classified: DataFrame, label: str) -> None:
        changes = apply_changes(classified, self.source, self.tables, self.store.next_seq(), self.resolve, **self.options)
        written = self.store.commit(changes, label)
        if self.fail_on_reject:
            refused = self.store.read([written]).filter(F.col("kind") == REJECT)
            if not refused.isEmpty():
                raise RejectedDocuments(f"{label}: documents were refused, see commit {written}")

    def _each_tenant(self, classified: DataFrame, unreadable: DataFrame, label: str) -> None:
        """Apply the events of each tenant alone; those that still fail are buried."""
        acting = classified.filter(F.col("action").isin(DELETE, UPSERT))
        letters = unreadable
        for row in acting.select("client_id").distinct().collect():  # tenants: configuration
            own = acting.filter(F.col("client_id") == row["client_id"])
            try:
                self._apply(own, f"{label}-{row['client_id']}")
            except Exception:
                log.exception("%s: the events of %s become dead letters", label, row["client_id"])
                letters = letters.unionByName(dead_letters(own, "max_retries_exceeded"))
        self._bury(letters, label)

    def start(self, raw: DataFrame, trigger: dict | None = None) -> StreamingQuery:
        writer = raw.writeStream.queryName(self.name).foreachBatch(self)
        return writer.option("checkpointLocation", f"{self.state}/checkpoint").trigger(
            **(trigger or {"processingTime": TRIGGER})
        ).start()

    def lag(self, query: StreamingQuery) -> DataFrame:
        """Unread messages per tenant by the last progress report of a running Kafka stream."""
        last = json.loads(query.lastProgress.json) if query.lastProgress else {}
        layout = "stream string, latest long, committed long, pending long"
        return lag_by_tenant(local_frame(self.store.spark, positions_from_progress(last.get("sources", [])), layout), self.streams)

    def dead(self) -> DataFrame:
        spark, layout = self.store.spark, "value string, original_id string, stream string, reason string"
        fs, path = self._at("dead")
        if not fs.exists(path):
            return spark.createDataFrame([], layout)
        return spark.read.schema(layout).option("recursiveFileLookup", "true").parquet(f"{self.state}/dead")

    def _bury(self, letters: DataFrame, label: str) -> None:
        if not letters.isEmpty():
            letters.write.mode("overwrite").parquet(f"{self.state}/dead/{label}")

    def _at(self, place: str):
        """The file system of a place under the state folder, and its path there."""
        spark = self.store.spark
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.state}/{place}")
        return path.getFileSystem(spark._jsc.hadoopConfiguration()), path

    def _attempts(self, batch_id: int) -> int:
        fs, path = self._at(f"attempts/{batch_id}/*")
        return len(fs.globStatus(path) or [])

    def _note_attempt(self, batch_id: int, made: int) -> None:
        fs, path = self._at(f"attempts/{batch_id}/{made}")
        fs.createNewFile(path)

    def _forget_attempts(self, batch_id: int) -> None:
        fs, path = self._at(f"attempts/{batch_id}")
        fs.delete(path, True)
