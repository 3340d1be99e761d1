"""Small source tables in the layouts FIXTURES.md lists."""

import datetime as dt
import re
from decimal import Decimal
from functools import cache
from pathlib import Path

from pyspark.sql import types as T

DAY = dt.date(2024, 1, 2)
TYPES = {"long": T.LongType(), "string": T.StringType(), "date": T.DateType(), "int": T.IntegerType(),
         "decimal(18,2)": T.DecimalType(18, 2)}


@cache
def layouts() -> dict[str, dict[str, T.DataType]]:
    """Table -> columns and types, read from the fixture document."""
    text = (Path(__file__).parent.parent / "FIXTURES.md").read_text()
    rows = re.findall(r"^\| `(\w+)` \| ((?:\w+:[\w(),]+(?:, )?)+) \|", text, re.M)
    return {
        name: {c: TYPES[t] for c, t in re.findall(r"(\w+):(decimal\(18,2\)|\w+)", columns)} for name, columns in rows
    }


def schema(table: str, **types) -> T.StructType:
    columns = {**layouts()[table], **{k: v for k, v in types.items() if v is not None}}
    return T.StructType([T.StructField("client_id", T.StringType())] + [T.StructField(c, t) for c, t in columns.items()])


def filled(table: str, **values) -> dict:
    """A live row whose texts name their column and whose keys are 1."""
    row = {}
    for name, kind in layouts()[table].items():
        if isinstance(kind, T.StringType):
            row[name] = f"[{name}]"
        elif isinstance(kind, T.DateType):
            row[name] = DAY
        elif isinstance(kind, T.DecimalType):
            row[name] = Decimal("10.50")
        else:
            row[name] = 1
    return {"client_id": "t1", **row, "is_deleted": 0, **values}


def frame(spark, table: str, *rows: dict, types: dict | None = None):
    layout = schema(table, **(types or {}))
    return spark.createDataFrame([tuple(r.get(f.name) for f in layout.fields) for r in rows], layout)


def party(**values) -> dict:
    names = {"company_name": None, "first_name": "Ann", "middle_name": None, "last_name": "Lee", "name": None}
    return filled("parties", **{"id": 1, "company_id": 7, **names, **values})


def lookups(spark) -> dict:
    """One row of every looked-up table, all with key 1."""
    return {
        "parties": frame(spark, "parties", party()),
        "employees": frame(spark, "employees", filled("employees", first_name="Eve", last_name=None)),
        "user": frame(spark, "user", filled("user", company_id=9)),
        "journal_entries": frame(spark, "journal_entries", filled("journal_entries", company_id=8)),
        "assets": frame(spark, "assets", filled("assets", company_id=6)),
        "items": frame(spark, "items", filled("items", name="Bolt")),
        "warehouse_location": frame(spark, "warehouse_location", filled("warehouse_location", name="Main")),
        "mf_work_orders": frame(spark, "mf_work_orders", filled("mf_work_orders", series_number="WO-1")),
        "item_companies": spark.createDataFrame([("t1", 1, 5, 1)], "client_id string, id long, company_id long, item_id long"),
        "mf_bom_companies": spark.createDataFrame([("t1", 1, 1, 5)], "client_id string, id long, bom_id long, company_id long"),
        "department": spark.createDataFrame([("t1", 1, "Stores")], "client_id string, id long, name string"),
    }
