"""What a table spec is, and how it turns source tables into document rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text
from ..functions.columns import Columns, Sql, quoted
from ..session import local_frame, written
from .keyfilter import cut, filter_bits

#: Gives a table's rows; every frame carries ``client_id``.
Source = Callable[[str], DataFrame]

FILL, TAKE = "fill", "take"


@dataclass(frozen=True)
class Lookup:
    """One join of a spec: where to look, by what, and which columns it adds.

    ``adds`` maps a new column to an expression over the looked-up table.
    ``company`` says how its company_id is used: ``take`` replaces the row's
    own, ``fill`` only where the row (column ``company_from``) has none.
    ``many`` marks a junction table with several rows per key.
    """

    table: str
    on: tuple[str, str]
    adds: Mapping[str, text.Builder] = field(default_factory=dict)
    company: str | None = None
    company_from: str = "company_id"
    how: str = "left"
    many: bool = False


def party(fk: str, name_as: str, company: str | None = FILL) -> Lookup:
    return Lookup("parties", (fk, "id"), {name_as: text.sql_party_name}, company)


def lookup(table: str, fk: str, company: str | None = None, company_from: str = "company_id", **adds: str) -> Lookup:
    """A join on ``id`` that copies columns: ``new_name="looked_up_column"``."""
    return Lookup(table, (fk, "id"), {n: text.column(c) for n, c in adds.items()}, company, company_from)


@dataclass(frozen=True)
class TableSpec:
    """How the rows of one table become documents; columns and expressions only."""

    table: str
    module: str
    title: text.Builder
    text: text.Builder
    lookups: tuple[Lookup, ...] = ()
    copies: Mapping[str, str] = field(default_factory=dict)
    reference: str | text.Builder | None = None
    status: str | None = None
    date: str | tuple[str, str] | None = None
    amount: str | text.Builder | None = None
    junction: bool = False

    def source_columns(self) -> tuple[str, ...]:
        """Driving-table columns the joins and copies cannot do without."""
        filled = (lk.company_from for lk in self.lookups if lk.company == FILL)
        return ("id", "is_deleted", *(lk.on[0] for lk in self.lookups), *self.copies.values(), *filled)


def live(rows: DataFrame) -> DataFrame:
    """Rows not soft-deleted; a null marker counts as not live."""
    boolean = isinstance(rows.schema["is_deleted"].dataType, T.BooleanType)
    return rows.filter("not is_deleted" if boolean else "is_deleted = 0")


#: Up to this many changed keys are known to the driver and pushed to the scan.
FEW_KEYS = 10_000


@dataclass(frozen=True)
class Keys:
    """Changed row keys (client_id, id): a frame, and the ids per tenant while they are few."""

    frame: DataFrame
    few: Mapping[str, tuple[int, ...]] | None = None

    @staticmethod
    def of(frame: DataFrame) -> Keys:
        found = frame.select("client_id", "id").limit(FEW_KEYS + 1).collect()
        return Keys.listed(frame.sparkSession, found) if len(found) <= FEW_KEYS else Keys(frame)

    @staticmethod
    def listed(spark: SparkSession, found: Sequence[tuple[str, int]]) -> Keys:
        ids: dict[str, list[int]] = {}
        for client_id, row_id in found:
            ids.setdefault(client_id, []).append(row_id)
        frame = local_frame(spark, [tuple(r) for r in found], "client_id string, id long")
        return Keys(frame, {c: tuple(sorted(i)) for c, i in ids.items()})

    def only(self, rows: DataFrame) -> DataFrame:
        """The rows of these keys; few keys become a filter the scan can skip files by, more a Bloom filter ahead of the join."""
        if self.few is None:
            rows = cut(rows, ["client_id", "id"], self.frame, ["client_id", "id"], filter_bits(self.frame.count()))
            return rows.join(self.frame, ["client_id", "id"], "left_semi")
        wanted = [f"(client_id = {quoted(c)} and id in ({', '.join(map(str, i))}))" for c, i in self.few.items()]
        return rows.filter(" or ".join(wanted) or "false")


def source_rows(spec: TableSpec, source: Source, keys: Keys | None = None) -> DataFrame:
    """The spec's rows: live, joined, with copies and computed columns replacing their namesakes.

    ``keys`` keeps only those rows, before any join is made.  Looked-up tables
    are cut to the rows wanted too, so that changes do not shuffle a whole
    table: by the foreign keys while the keys are few, else by a Bloom filter of
    them.  The rows of many keys are written for that, to be found once.
    """
    rows = live(source(spec.table))
    missing = [c for c in spec.source_columns() if c not in rows.columns]
    if missing:
        raise ValueError(f"{spec.table}: source lacks {', '.join(missing)}")
    if keys is not None:
        rows = keys.only(rows)
    if keys is not None and keys.few is None and spec.lookups:
        rows = refetched = written(rows, "refetched")
        bits = filter_bits(refetched.count())
    own, base = Columns(rows), rows.columns
    computed: dict[str, Sql] = {alias: own[name] for alias, name in spec.copies.items()}
    for n, lk in enumerate(spec.lookups):
        prefix = f"_{n}_"
        found = _looked_up(source(lk.table), lk, prefix)
        if keys is not None and keys.few is not None:
            wanted = rows.select(F.col("client_id").alias(prefix + "client"), F.col(f"`{lk.on[0]}`").alias(prefix + "key"))
            found = found.join(F.broadcast(wanted.distinct()), [prefix + "client", prefix + "key"], "left_semi")
        elif keys is not None:
            found = cut(found, [prefix + "client", prefix + "key"], refetched, ["client_id", lk.on[0]], bits)
        rows = _join(rows, lk, found, prefix)
        computed.update({name: prefix + name for name in lk.adds})
        if lk.company == TAKE:
            computed["company_id"] = prefix + "company_id"
        elif lk.company == FILL:
            computed["company_id"] = f"coalesce({own[lk.company_from]}, {prefix}company_id)"
    if not computed:
        return rows
    kept = [f"`{c}`" for c in base if c not in computed]
    return rows.selectExpr(*kept, *[f"{sql} as `{name}`" for name, sql in computed.items()])


def _looked_up(table: DataFrame, lk: Lookup, prefix: str) -> DataFrame:
    """Key, tenant and added columns of a looked-up table, named apart; built before the join."""
    there = Columns(table)
    cells = {"client": there["client_id"], "key": there[lk.on[1]]}
    cells |= {name: build(there) for name, build in lk.adds.items()}
    if lk.company:
        cells["company_id"] = there["company_id"]
    return table.selectExpr(*[f"{sql} as `{prefix}{name}`" for name, sql in cells.items()])


def _join(rows: DataFrame, lk: Lookup, found: DataFrame, prefix: str) -> DataFrame:
    """Join by (tenant, key), without letting one key value gather in one task.

    Rows with a null foreign key would all hash alike, so a second key spreads
    them: it is 0 for a row that has a key and for every row looked up, and some
    other number for the rest, which match nothing anyway.  The keys themselves
    are compared as they are, whatever their types.  A junction is the many side
    of a left join, which cannot be split there; as an inner join plus the rows
    it leaves over, either side can be.
    """
    here, there = f"`{lk.on[0]}`", f"{prefix}key"
    tenant = f"client_id = {prefix}client"
    if lk.how == "inner" or lk.many:
        on = F.expr(f"{tenant} and {here} = {there}")
        matched = rows.join(found, on, "inner")
        if lk.how == "left":
            keys = found.select(prefix + "client", there).distinct()
            matched = matched.unionByName(rows.join(keys, on, "left_anti"), allowMissingColumns=True)
        return matched.drop(prefix + "client", there)
    spread, zero = f"{prefix}spread", f"{prefix}zero"
    rows = rows.withColumn(spread, F.expr(f"if({here} is null, 1 + pmod(xxhash64(id), 1073741824L), 0L)"))
    # a plain 0 would be folded into the condition and be no key any more
    found = found.withColumn(zero, F.expr(f"pmod(xxhash64({there}), 1L)"))
    matched = rows.join(found, F.expr(f"{tenant} and {here} = {there} and {spread} = {zero}"), "left")
    return matched.drop(prefix + "client", there, spread, zero)
