"""Inventory tables. Titles, labels and column names are fixed values."""

from ..functions.text import prose, title
from .spec import TAKE, Lookup, TableSpec, lookup

M = "inventory"

SPECS = (
    TableSpec(
        "items", M,
        copies={"item_type": "type"},
        lookups=(Lookup("item_companies", ("id", "item_id"), company=TAKE, many=True),),
        title=title("Item", "name"), reference="sku", amount="sales_price",
        text=prose("item product", "name, sku, item type, brand, upc bar code, description"),
        junction=True,
    ),
    TableSpec(
        "warehouse_location", M,
        title=title("Warehouse", "name"), reference="short_name",
        text=prose("warehouse location", "name, short name, address"),
    ),
    TableSpec(
        "inventory_adjustments", M,
        lookups=(lookup("warehouse_location", "location", location_name="name"),),
        title=title("Inventory Adjustment", "reason", "location_name"), date="date",
        text=prose("inventory adjustment stock adjustment", "reason, location <- location_name, narration"),
    ),
    TableSpec(
        "bin_transfers", M,
        title=title("Bin Transfer", "status"), status="status", date="date",
        text=prose("bin transfer", "status, narration"),
    ),
    TableSpec(
        "stock_transfers", M,
        lookups=(
            lookup("warehouse_location", "source_location_id", source_location_name="name"),
            lookup("warehouse_location", "destination_location_id", destination_location_name="name"),
        ),
        title=title("Stock Transfer", "operation_type", "source_location_name", "destination_location_name"),
        status="status", date="date",
        text=prose("stock transfer", "operation type, source location <- source_location_name,"
                   " destination location <- destination_location_name, transfer type, status, description"),
    ),
)
