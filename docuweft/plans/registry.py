"""All table specs, and what a tenant changes about them."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import replace
from typing import Any, TypeVar

from . import account, document, inventory, manufacturing, purchase, rental, sales
from .spec import TableSpec

Registry = Mapping[str, TableSpec]
#: A tenant's registry.
Resolve = Callable[[str], Registry]
T = TypeVar("T")
#: Per table: fields to replace, a whole spec to add, or None to drop it.
Overrides = Mapping[str, "Mapping[str, Any] | TableSpec | None"]

BASE: Registry = {
    spec.table: spec
    for group in (account, inventory, sales, purchase, manufacturing, rental, document)
    for spec in group.SPECS
}

def apply_overrides(base: Registry, overrides: Overrides) -> dict[str, TableSpec]:
    """Base specs with fields replaced, tables dropped and tables added; base stays as it was."""
    merged = {t: s for t, s in base.items() if overrides.get(t, s) is not None}
    for table, change in overrides.items():
        if isinstance(change, TableSpec):
            merged[table] = change
        elif change is not None:
            if table not in merged:
                raise ValueError(f"override of unknown table {table} must be a whole spec")
            merged[table] = replace(merged[table], **change)
    return merged


def resolver(tenants: Mapping[str, Overrides]) -> Resolve:
    """A function from tenant to registry; each is made once, so that its specs stay the same objects."""
    made: dict[str, Registry] = {}

    def resolve(client_id: str) -> Registry:
        if client_id not in tenants:
            return BASE
        if client_id not in made:
            made[client_id] = apply_overrides(BASE, tenants[client_id])
        return made[client_id]

    return resolve


#: Every tenant as the base has it.
resolve_base: Resolve = resolver({})


def modules(registry: Registry = BASE) -> list[str]:
    return sorted({spec.module for spec in registry.values()})


def indices_for(client_id: str, resolve: Resolve = resolve_base) -> list[str]:
    """The tenant's index names, from its own resolved registry."""
    return [f"{client_id}_{m}" for m in modules(resolve(client_id))]


def by_spec(wanted: Iterable[tuple[str, str, T]], resolve: Resolve) -> list[tuple[TableSpec, list[T]]]:
    """Members, given as (tenant, table, member), under the different specs that apply to them.

    Specs that are equal are one, whoever made them, so the number of plans
    follows the number of variants and not of tenants or rows.  A table that a
    tenant does not have is left out.
    """
    known: dict[str, Registry] = {}
    groups: dict[str, list[tuple[TableSpec, list[T]]]] = {}
    for client_id, table, member in wanted:
        if client_id not in known:
            known[client_id] = resolve(client_id)
        spec = known[client_id].get(table)
        if spec is None:
            continue
        variants = groups.setdefault(table, [])
        found = next((members for other, members in variants if other is spec or other == spec), None)
        if found is None:
            found = []
            variants.append((spec, found))
        found.append(member)
    return [group for variants in groups.values() for group in variants]


def variants(client_ids: Sequence[str], table: str, resolve: Resolve = resolve_base) -> list[tuple[TableSpec, list[str]]]:
    """The distinct specs of a table and the tenants each applies to."""
    return by_spec(((c, table, c) for c in client_ids), resolve)
