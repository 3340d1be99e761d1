"""Positions of change streams as a table, so that lag is seen outside the driver that runs them."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..operators.quality import lag_by_tenant, positions_from_progress

LAYOUT = "query string, batch_id long, at timestamp, stream string, latest long, committed long, pending long"
#: Batches of a query whose positions are kept.
KEPT_BATCHES = 100


class PositionLog(StreamingQueryListener):
    """Writes what each batch of a named query has read and what there was to read: a small file a batch, in ``place``.

    Register it with ``spark.streams.addListener``.  A batch that reports again
    replaces its file; files of batches long past are removed, so the table
    stays small however long a stream runs.
    """

    def __init__(self, spark: SparkSession, place: str, names: tuple[str, ...] = ()):
        self.spark, self.place, self.names = spark, place.rstrip("/"), names

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.note(json.loads(event.progress.json))

    def note(self, progress: dict) -> None:
        """Write the positions of one progress report; reports of unnamed and of other queries are passed over."""
        name, batch = progress.get("name"), progress["batchId"]
        if not name or (self.names and name not in self.names):
            return
        columns = ("stream", "latest", "committed", "pending")
        head = {"query": name, "batch_id": batch, "at": progress["timestamp"]}
        lines = [json.dumps(head | dict(zip(columns, row))) for row in positions_from_progress(progress.get("sources", []))]
        if not lines:
            return
        fs, path = self._at(name, batch)
        out = fs.create(path, True)
        try:
            out.write(bytearray("\n".join(lines).encode()))
        finally:
            out.close()
        if batch >= KEPT_BATCHES:
            fs.delete(self._at(name, batch - KEPT_BATCHES)[1], False)

    def _at(self, name: str, batch: int):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.place}/{name}-{batch:010d}.json")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path


def positions(spark: SparkSession, place: str) -> DataFrame:
    """The newest positions (query, batch_id, at, stream, latest, committed, pending) of each query and stream, read by any session."""
    newest = Window.partitionBy("query", "stream").orderBy(F.desc("batch_id"))
    rows = spark.read.schema(LAYOUT).json(place)
    return rows.withColumn("_n", F.row_number().over(newest)).filter("_n = 1").drop("_n")


def lag(spark: SparkSession, place: str, streams: DataFrame) -> DataFrame:
    """Unread plus pending messages per tenant, from the positions alone."""
    return lag_by_tenant(positions(spark, place).select("stream", "latest", "committed", "pending"), streams)
