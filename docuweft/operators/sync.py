"""Bulk sync: rebuild some or all tables of one or many tenants in the document store."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.registry import Registry, Resolve, resolve_base, variants
from ..plans.spec import Source, TableSpec, source_rows
from ..schema import DEL_TENANT, DEL_TYPE, PUT, REJECT
from .documents import REASON, checked_documents, with_vector_check
from .embedding import Provider, embed_documents
from .status import RunStatus, write_status
from .store import DocumentStore, as_changes

log = logging.getLogger(__name__)

UPSERT, FULL_REINDEX, RECREATE = "upsert", "full_reindex", "recreate"


#: A checked row is put, or recorded as refused.
PUT_OR_REJECT = f"if({REASON} is null, '{PUT}', '{REJECT}')"


def table_changes(
    spec: TableSpec,
    source: Source,
    seq: int,
    make_provider: Callable[[], Provider] | None = None,
    dimension: int | None = None,
) -> DataFrame:
    """A table's rows as put and reject rows, with vectors where a provider is given."""
    docs = checked_documents(source_rows(spec, source), spec, whole=False)
    if make_provider is not None:
        docs = embed_documents(docs, make_provider)
    if dimension is not None:
        docs = with_vector_check(docs, dimension)
    return as_changes(docs, PUT_OR_REJECT, seq)


def delete_scope(spark: SparkSession, kind: str, seq: int, scopes: Sequence[Mapping[str, str]]) -> DataFrame:
    """Delete rows for whole types or tenants: one row per scope, from configuration."""
    rows = [(s["client_id"], s.get("module"), s.get("doc_type")) for s in scopes]
    return as_changes(spark.createDataFrame(rows, "client_id string, module string, doc_type string"), f"'{kind}'", seq)


def sync(
    store: DocumentStore,
    source: Source,
    client_ids: Sequence[str],
    tables: Sequence[str] | None = None,
    mode: str = UPSERT,
    make_provider: Callable[[], Provider] | None = None,
    dimension: int | None = None,
    job_id: str | None = None,
    runs_path: str | None = None,
    force: bool = False,
    at_once: int = 4,
    resolve: Resolve = resolve_base,
) -> dict[str, RunStatus]:
    """Index the given tables (None: all, []: none) of the given tenants.

    ``upsert`` never removes documents; ``full_reindex`` replaces each table's
    documents in one commit; ``recreate`` first clears every module of the
    tenants and therefore refuses a subset of tables unless forced.  ``resolve``
    gives each tenant's own registry.  Tenants with the same spec share a job;
    where that fails, each is tried alone, so that a failing table is recorded
    for the tenants at fault only and stops no other.
    """
    spark, job_id = store.spark, job_id or uuid.uuid4().hex
    registries = {c: resolve(c) for c in client_ids}
    wanted = {c: list(reg) if tables is None else list(tables) for c, reg in registries.items()}
    _check_tables(registries, wanted)
    if mode == RECREATE and tables is not None and not force:
        raise ValueError("recreate clears every table of the tenant; pass force=True to load only some")

    runs = {c: RunStatus(f"{job_id}", c, total_tables=len(wanted[c])) for c in client_ids}
    write_status(spark, runs_path, list(runs.values()))
    try:
        if mode == RECREATE:
            scopes = [{"client_id": c} for c in client_ids]
            store.commit(delete_scope(spark, DEL_TENANT, store.next_seq(), scopes), f"{job_id}-recreate")
        names = sorted({t for ts in wanted.values() for t in ts})
        asked = {t: [c for c in client_ids if t in wanted[c]] for t in names}
        work = [(t, spec, cs) for t in names for spec, cs in variants(asked[t], t, resolve)]
        with ThreadPoolExecutor(at_once) as pool:
            def submit(label: str, table: str, spec: TableSpec, members: list[str]):
                job = pool.submit(_sync_table, store, source, spec, members, mode, make_provider, dimension, f"{job_id}-{label}")
                return job, (label, table, spec, members)

            jobs = dict(submit(f"{t}-{n}", t, spec, cs) for n, (t, spec, cs) in enumerate(work))
            while jobs:
                ended, _ = wait(jobs, return_when=FIRST_COMPLETED)
                for done in ended:
                    label, table, spec, members = jobs.pop(done)
                    if done.exception() is not None and len(members) > 1:
                        log.warning("sync of %s failed for %s together; trying each alone", table, members, exc_info=done.exception())
                        jobs.update(submit(f"{label}-{n}", table, spec, [c]) for n, c in enumerate(members))
                        continue
                    _record(runs, table, members, done)
                    write_status(spark, runs_path, [runs[c] for c in members])
    except Exception:
        for run in runs.values():
            run.finish("failed")
        write_status(spark, runs_path, list(runs.values()))
        raise
    for run in runs.values():
        run.finish()
    write_status(spark, runs_path, list(runs.values()))
    return runs


def _check_tables(registries: Mapping[str, Registry], wanted: Mapping[str, list[str]]) -> None:
    for client_id, names in wanted.items():
        unknown = [t for t in names if t not in registries[client_id]]
        if unknown:
            raise ValueError(f"unknown tables for {client_id}: {', '.join(unknown)}")


def _sync_table(
    store: DocumentStore, source: Source, spec: TableSpec, client_ids: list[str], mode: str,
    make_provider: Callable[[], Provider] | None, dimension: int | None, name: str,
) -> dict[str, tuple[int, int]]:
    """Write one table of some tenants as one commit; (indexed, errors) per tenant."""
    mine = source.of(client_ids) if hasattr(source, "of") else source

    def own(table: str) -> DataFrame:
        return mine(table).filter(F.col("client_id").isin(client_ids))

    seq = store.next_seq()
    changes = table_changes(spec, own, seq, make_provider, dimension)
    if mode == FULL_REINDEX:
        scopes = [{"client_id": c, "module": spec.module, "doc_type": spec.table} for c in client_ids]
        changes = changes.unionByName(delete_scope(store.spark, DEL_TYPE, seq, scopes))
    name = store.commit(changes, name)
    counts = store.read([name]).groupBy("client_id").agg(
        F.count_if(F.col("kind") == PUT).alias("puts"), F.count_if(F.col("kind") == REJECT).alias("rejects")
    )
    return {r["client_id"]: (r["puts"], r["rejects"]) for r in counts.collect()}


def _record(runs: Mapping[str, RunStatus], table: str, members: list[str], done) -> None:
    failure = done.exception()
    if failure is not None:
        log.error("sync of %s failed for %s", table, members, exc_info=failure)
    counts = {} if failure is not None else done.result()
    for client_id in members:
        run = runs[client_id]
        run.completed_tables += 1
        if failure is not None:
            run.failed_tables.append(table)
            run.errors += 1
        else:
            indexed, errors = counts.get(client_id, (0, 0))
            run.indexed += indexed
            run.errors += errors
