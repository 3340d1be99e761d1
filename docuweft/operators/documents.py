"""Rows of a table spec as documents, and the rows that cannot become one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import keys, text
from ..functions.columns import Columns, Sql, quoted
from ..plans.spec import Keys, Source, TableSpec, source_rows
from ..schema import DOC_FIELDS, NARROW_FIELDS, PASS_THROUGH
from ..search.knn import usable

REASON = "reason"
_TYPES = {f.name: f.type for f in DOC_FIELDS}


def checked_documents(rows: DataFrame, spec: TableSpec, whole: bool = True) -> DataFrame:
    """Every row as a full document with ``client_id`` and, where it is unfit, a reason.

    With ``whole=False`` fields the table does not have are left out, for a
    writer that lays rows out itself.
    """
    rows, date = _with_date(rows, spec)
    row = Columns(rows)
    fields = _core(spec, row, date)
    fields |= {f.name: _coerced(row, f.name, f.rule) for f in PASS_THROUGH if f.name in row}
    return _projected(rows, fields, [f.name for f in DOC_FIELDS], _reject_reason(row, spec, date), whole)


def checked_narrow_documents(rows: DataFrame, spec: TableSpec, whole: bool = True) -> DataFrame:
    """The 17-field shape of a change event: fewer fields, plainer party name and email."""
    rows, date = _with_date(rows, spec)
    row = Columns(rows)
    fields = _core(spec, row, date)
    fields["party_name"] = row.first_truthy("customer_name", "vendor_name", "party_name", "employee_name")
    fields["email"] = row.text("email")
    return _projected(rows, fields, NARROW_FIELDS, _reject_reason(row, spec, date), whole)


def accepted(checked: DataFrame) -> DataFrame:
    return checked.filter(f"{REASON} is null").drop(REASON)


def rejects(checked: DataFrame) -> DataFrame:
    return checked.filter(f"{REASON} is not null").select("client_id", "doc_type", "source_id", "id", REASON)


def build_documents(spec: TableSpec, source: Source, keys: Keys | None = None) -> DataFrame:
    return accepted(checked_documents(source_rows(spec, source, keys), spec))


def with_vector_check(checked: DataFrame, dimension: int) -> DataFrame:
    """Reject documents whose vector is not of the expected length, or has no direction to compare."""
    if "embedding" not in checked.columns:
        return checked
    vector = F.col("embedding")
    wrong = F.when(vector.isNotNull() & ((F.size(vector) != dimension) | ~usable(vector)), "bad_vector")
    return checked.withColumn(REASON, F.coalesce(F.col(REASON), wrong))


def _projected(rows: DataFrame, fields: dict[str, Sql], names: Sequence[str], reason: Sql, whole: bool) -> DataFrame:
    """The fields a row has; for the whole layout also those it lacks, as null."""
    cells = [f"{fields[n]} as `{n}`" for n in names if n in fields]
    docs = rows.selectExpr("client_id", *cells, f"{reason} as {REASON}")
    if not whole:
        return docs
    layout = [T.StructField(n, _TYPES[n]) for n in names]
    layout = [T.StructField("client_id", T.StringType()), *layout, T.StructField(REASON, T.StringType())]
    return docs.to(T.StructType(layout))


def _with_date(rows: DataFrame, spec: TableSpec) -> tuple[DataFrame, str | None]:
    """The column the document date is read from; for an either-or, a new one."""
    if not isinstance(spec.date, tuple):
        return rows, spec.date
    row, (first, second) = Columns(rows), spec.date
    if row.type(first) == row.type(second):
        chosen = f"coalesce({row.truthy(first)}, {row[second]})"
    else:
        chosen = row.first_truthy(first, second)
    return rows.withColumn("_doc_date", F.expr(chosen)), "_doc_date"


def _core(spec: TableSpec, row: Columns, date: str | None) -> dict[str, Sql]:
    """Core fields; those that can only be null here are left to the layout."""
    fields = {
        "id": keys.doc_id(spec.table, row, spec.junction),
        "source_id": f"cast({row['id']} as bigint)",
        "doc_type": quoted(spec.table),
        "module": quoted(spec.module),
        "company_id": keys.company_key(row),
        "title": spec.title(row),
        "text_content": spec.text(row),
        "party_name": text.resolve_party_name(row),
    }
    if spec.reference:
        fields["reference"] = spec.reference(row) if callable(spec.reference) else row.text(spec.reference)
    if spec.status:
        fields["status"] = row.text(spec.status)
    if date:
        fields["date"] = row.date(date)
    if spec.amount:
        fields["amount"] = spec.amount(row) if callable(spec.amount) else row.number(spec.amount)
    for name in ("company_name", "first_name", "last_name", "approval_status", "transaction_type"):
        if name in row:
            fields[name] = row.text(name)
    for name, other in (("email", "email_ids"), ("phone", "contact_no")):
        if name in row or other in row:
            fields[name] = row.first_truthy(name, other)
    return fields


def _coerced(row: Columns, name: str, rule: str) -> Sql:
    if rule == "date":
        return row.date(name)
    return row.number(name) if rule == "double" else row.text(name)


def _reject_reason(row: Columns, spec: TableSpec, date: str | None) -> Sql:
    """Why the store would refuse the row; checks that the column types rule out are left out."""
    dates = ([("date", date)] if date else []) + [(f.name, f.name) for f in PASS_THROUGH if f.rule == "date"]
    checks = [(f"{row['id']} is null", "null_id")]
    checks += [(bad, f"bad_date:{field}") for field, name in dates if (bad := row.bad_date(name))]
    if isinstance(spec.amount, str) and spec.amount in row:
        checks.append((f"({row[spec.amount]} is not null and {row.number(spec.amount)} is null)", "bad_amount"))
    return f"case {' '.join(f'when {bad} then {quoted(why)}' for bad, why in checks)} end"
