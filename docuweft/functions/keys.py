"""Identifiers: documents, indices, streams."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import Columns, Sql, quoted


def doc_id(table: str, row: Columns, junction: bool) -> Sql:
    """``table:id``; rows fanned out over companies add ``:company``, empty without one."""
    parts = [quoted(f"{table}:"), row.text("id")]
    if junction:
        parts += ["':'", f"coalesce({row.truthy_text('company_id')}, '')"]
    return f"concat({', '.join(parts)})"


def company_key(row: Columns) -> Sql:
    return f"coalesce({row.text('company_id')}, '0')"


def index_name(client_id: Column, module: Column) -> Column:
    return F.concat_ws("_", client_id, module)


def stream_key(prefix: Column, db_name: Column, table: Column) -> Column:
    return F.concat_ws(".", prefix, db_name, table)
