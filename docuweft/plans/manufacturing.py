"""Manufacturing tables. Titles, labels and column names are fixed values."""

from ..functions.text import prose, title
from .spec import TAKE, Lookup, TableSpec, lookup, party

M = "manufacturing"

SPECS = (
    TableSpec(
        "mf_work_orders", M,
        copies={"work_order_type": "type"}, lookups=(lookup("items", "item_id", item_name="name"),),
        title=title("Work Order", "series_number", "item_name"),
        reference="series_number", status="status", date="date",
        text=prose("work order manufacturing", "series number, item <- item_name, status, material status,"
                   " reference number, narration"),
    ),
    TableSpec(
        "mf_bom", M,
        lookups=(
            lookup("items", "item_id", item_name="name"),
            Lookup("mf_bom_companies", ("id", "bom_id"), company=TAKE, how="inner", many=True),
        ),
        title=title("Bill of Materials", "name", "item_name"),
        reference="version_number", status="status", date="start_date",
        text=prose("bill of materials bom", "name, item <- item_name, version number, status, narration"),
        junction=True,
    ),
    TableSpec(
        "mf_build_orders", M,
        lookups=(lookup("items", "item_id", item_name="name"),),
        title=title("Build Order", "series_number", "item_name"),
        reference="series_number", status="status", date="date",
        text=prose("build order assembly", "series number, item <- item_name, status, narration"),
    ),
    TableSpec(
        "mf_job_cards", M,
        lookups=(lookup("mf_work_orders", "work_order_id", work_order_number="series_number"),),
        title=title("Job Card", "series_number", "work_order_number"),
        reference="series_number", status="status", date="date",
        text=prose("job card production", "series number, work order number, status, material status, narration"),
    ),
    TableSpec(
        "mf_production_plan", M,
        title=title("Production Plan", "series_number"),
        reference="series_number", status="status", date="date",
        text=prose("production plan", "series number"),
    ),
    TableSpec(
        "mf_equipments", M,
        lookups=(party("vendor_id", "vendor_name", company=None),),
        title=title("Equipment", "name"),
        reference="serial_number", status="status", date="effective_date", amount="equipment_cost",
        text=prose("equipment machinery", "name, serial number, vendor <- vendor_name, status, used by, model,"
                   " maintenance period, narration"),
    ),
    TableSpec(
        "mf_gate_registers", M,
        title=title("Gate Register", "series_number", "transporter_name"),
        reference="series_number", date="record_date",
        text=prose("gate register entry exit", "series number, transporter <- transporter_name,"
                   " driver <- driver_name, driver contact <- driver_contact_number, identification number,"
                   " entry purpose, entry material, exit purpose"),
    ),
)
