"""Progress of sync runs: one appended row per state change, the newest one counts."""

from __future__ import annotations

import logging
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import RUN_SCHEMA

log = logging.getLogger(__name__)


@dataclass
class RunStatus:
    job_id: str
    client_id: str
    status: str = "running"
    indexed: int = 0
    errors: int = 0
    total_tables: int = 0
    completed_tables: int = 0
    failed_tables: list[str] = field(default_factory=list)
    started_at: datetime = field(default_factory=lambda: datetime.now(timezone.utc))
    completed_at: datetime | None = None
    duration_ms: float | None = None

    def finish(self, status: str | None = None) -> None:
        self.completed_at = datetime.now(timezone.utc)
        self.duration_ms = round((self.completed_at - self.started_at).total_seconds() * 1000, 2)
        self.status = status or ("partial" if self.failed_tables else "ok")


def write_status(spark: SparkSession, path: str | None, runs: list[RunStatus]) -> None:
    """Append the state of runs; a failure to do so never fails the run."""
    if path is None:
        return
    now = datetime.now(timezone.utc)
    try:
        rows = [{**asdict(r), "updated_at": now} for r in runs]
        spark.createDataFrame(rows, RUN_SCHEMA).coalesce(1).write.mode("append").parquet(path)
    except Exception:
        log.warning("could not write status of %s", [r.job_id for r in runs], exc_info=True)


def latest_status(runs: DataFrame, *, client_id: str, job_id: str | None = None) -> DataFrame:
    """Newest state of the tenant's runs; other tenants' runs are not seen."""
    own = runs.filter(F.col("client_id") == client_id)
    if job_id is not None:
        own = own.filter(F.col("job_id") == job_id)
    state = F.struct(*[c for c in runs.columns if c not in ("job_id", "client_id")])
    newest = own.groupBy("job_id", "client_id").agg(F.max_by(state, "updated_at").alias("s"))
    return newest.select("job_id", "client_id", "s.*")


def summarise(tables: DataFrame) -> DataFrame:
    """Run state from per-table results (job_id, client_id, doc_type, indexed, errors, failed).

    A table that failed as a whole counts as one error; any such table makes the run partial.
    """
    failed = F.col("failed")
    return tables.groupBy("job_id", "client_id").agg(
        F.when(F.count_if(failed) > 0, "partial").otherwise("ok").alias("status"),
        F.sum(F.when(failed, 0).otherwise(F.col("indexed"))).alias("indexed"),
        F.sum(F.when(failed, 1).otherwise(F.col("errors"))).alias("errors"),
        F.count("*").alias("total_tables"),
        F.sort_array(F.collect_list(F.when(failed, F.col("doc_type")))).alias("failed_tables"),
    )


def sync_counts(changes: DataFrame) -> DataFrame:
    """Indexed and refused documents per tenant and table, with a total row per tenant (null doc_type)."""
    counted = changes.filter(F.col("kind").isin("put", "reject")).groupBy("client_id", "doc_type").agg(
        F.count_if(F.col("kind") == "put").alias("indexed"),
        F.count_if(F.col("kind") == "reject").alias("errors"),
    )
    return counted.rollup("client_id", "doc_type").agg(
        F.sum("indexed").alias("indexed"), F.sum("errors").alias("errors")
    ).filter(F.col("client_id").isNotNull())
