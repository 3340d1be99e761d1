"""Titles, prose and names: the text a document is found by, as SQL expressions."""

from __future__ import annotations

from collections.abc import Callable

from .columns import Columns, Sql, non_blank, quoted, strip

Builder = Callable[[Columns], Sql]

# Separator of title parts; columns the generic text leaves out;
# columns tried for an amount, in order.
TITLE_SEPARATOR = " · "
SKIPPED_COLUMNS = (
    "id", "company_id", "is_deleted", "deleted_at", "deleted_by", "created_at", "updated_at",
    "created_by", "updated_by", "password", "remember_token", "attachment",
)
AMOUNT_COLUMNS = (
    "grand_total", "total_amount", "total_invoice_amount", "amount", "net_amount",
    "purchase_amount", "purchase_price", "total_value", "budget_amount", "payment_amount",
)


def joined(separator: str, *cells: Sql) -> Sql:
    """The cells that are not null, joined."""
    return f"concat_ws({', '.join([quoted(separator), *cells])})"


def said(label: str, value: Sql) -> Sql:
    """``<label><value>``, null when the value is."""
    return f"concat({quoted(label)}, {value})"


def column(name: str) -> Builder:
    return lambda row: row.text(name)


def title(label: str, *parts: str | Builder) -> Builder:
    """Label and the non-blank parts, stripped, joined by the title separator."""

    def build(row: Columns) -> Sql:
        cells = [p(row) if callable(p) else row.text(p) for p in parts if callable(p) or p in row]
        return joined(TITLE_SEPARATOR, quoted(label), *map(non_blank, cells))

    return build


def prose(label: str, fields: str) -> Builder:
    """``This is a <label> where <name> is <value>, ...`` over the non-blank fields.

    ``fields`` lists names, ``name <- column`` where the column is called otherwise.
    """
    pairs = []
    for entry in fields.split(","):
        name, _, source = (p.strip() for p in entry.partition("<-"))
        pairs.append((name, source or name.replace(" ", "_")))

    def build(row: Columns) -> Sql:
        cells = [said(f"{n} is ", non_blank(row.text(c))) for n, c in pairs if c in row]
        details = f"nullif({joined(', ', *cells)}, '')"
        return f"concat({quoted(f'This is a {label}')}, coalesce({said(' where ', details)}, ''))"

    return build


def generic_text(row: Columns) -> Sql:
    """``name: value`` of every column that is neither skipped nor an id, blanks left out."""
    kept = [n for n in row.names() if n not in SKIPPED_COLUMNS and not n.endswith("_id")]
    return joined(" ", *[said(n.replace("_", " ") + ": ", non_blank(row.text(n))) for n in kept])


def extract_amount(row: Columns) -> Sql:
    """The first amount column that holds a number."""
    found = [row.number(n) for n in AMOUNT_COLUMNS if n in row]
    return f"coalesce({', '.join([*found, 'cast(null as double)'])})"


def id_reference(row: Columns) -> Sql:
    return row.truthy_text("id")


def sql_party_name(row: Columns) -> Sql:
    """A joined party's name: person names, else company name, else name (spaces-only trim)."""
    person = joined(" ", *[row.text(n) for n in ("first_name", "middle_name", "last_name")])
    return f"coalesce(nullif(trim({person}), ''), {row.text('company_name')}, {row.text('name')})"


def sql_employee_name(row: Columns) -> Sql:
    """First and last name; null without a first name, trailing space without a last one."""
    return f"concat({row.text('first_name')}, ' ', coalesce({row.text('last_name')}, ''))"


def _person_names(row: Columns) -> Sql:
    return joined(" ", *[row.truthy_text(n) for n in ("first_name", "middle_name", "last_name") if n in row])


def resolve_party_name(row: Columns) -> Sql:
    """The name a document is shown under, from joined names down to the row's own name."""
    given = [row.truthy_text(n) for n in ("customer_name", "vendor_name", "party_name", "employee_name") if n in row]
    own = [row.truthy_text("name"), row.truthy_text("company_name")]
    return f"coalesce({', '.join([*given, non_blank(_person_names(row)), *own])})"


def party_display_name(row: Columns) -> Sql:
    return f"coalesce({row.truthy_text('company_name')}, nullif({_person_names(row)}, ''))"


def party_text(row: Columns) -> Sql:
    """Text of a party: who it is, then its attributes as they are stored."""
    # Attribute labels and their columns.
    attributes = (
        ("party type", "party_type"), ("vat number", "vat_number"), ("crn", "crn"),
        ("email", "email"), ("sales lead status", "sales_lead_status"),
        ("sales opportunity stage", "sales_op_stage"),
    )
    label = f"if({row.truthy('company_name')} is not null, ' with company name ', ' with name ')"
    who = f"concat('This is a party', coalesce(concat({label}, {party_display_name(row)}), ''))"
    cells = [
        f"if({non_blank(row.text(c))} is not null, {said(f'{n} is ', row.text(c))}, null)"
        for n, c in attributes if c in row
    ]
    return joined(", ", who, *cells)


def embed_input(title_sql: Sql, text_sql: Sql) -> Sql:
    """What is embedded: title and text, stripped; the text alone when there is no title."""
    both = strip(f"concat({title_sql}, ' ', {text_sql})")
    return f"if(coalesce({title_sql}, '') = '', {text_sql}, {both})"
