"""Purchase tables. Titles, labels and column names are fixed values."""

from ..functions.columns import Columns
from ..functions.text import extract_amount, prose, title
from .spec import TableSpec, lookup, party

M = "purchase"


def _vendor_or_department(row: Columns):
    return row.first_truthy("vendor_name", "department_name")


SPECS = (
    TableSpec(
        "pr_purchase_orders", M,
        lookups=(party("supplier_id", "vendor_name"),),
        title=title("Purchase Order", "series_number", "vendor_name"),
        reference="series_number", status="status", date="date", amount=extract_amount,
        text=prose("purchase order", "series number, vendor <- vendor_name, status, billing status,"
                   " receiving status, return status, order type, narration"),
    ),
    TableSpec(
        "pr_purchase_requests", M,
        copies={"approval_status": "status"},
        lookups=(
            lookup("department", "department_id", department_name="name"),
            party("vendor_id", "vendor_name", company=None),
        ),
        title=title("Purchase Request", "series_number", _vendor_or_department),
        reference="series_number", date="date",
        text=prose("purchase request", "series number, department <- department_name, approval status, narration"),
    ),
    TableSpec(
        "pr_rfqs", M,
        copies={"rfq_type": "type"}, lookups=(party("vendor_id", "vendor_name"),),
        title=title("RFQ", "series_number", "vendor_name"),
        reference="series_number", status="status", date="date",
        text=prose("request for quotation rfq", "series number, vendor <- vendor_name, status, rfq type,"
                   " reference number, narration"),
    ),
    TableSpec(
        "pr_rfq_responses", M,
        lookups=(party("vendor_id", "vendor_name"),),
        title=title("RFQ Response", "vendor_name", "reference_number"),
        reference="reference_number", date="date", amount=extract_amount,
        text=prose("rfq response quotation", "vendor <- vendor_name, reference number, narration"),
    ),
    TableSpec(
        "pr_purchase_order_grns", M,
        copies={"date": "grn_date"}, lookups=(party("vendor_id", "vendor_name"),),
        title=title("Purchase GRN", "series_number", "vendor_name"),
        reference="series_number", date="date",
        text=prose("purchase goods receipt grn", "series number, vendor <- vendor_name, narration"),
    ),
    TableSpec(
        "pr_vras", M,
        lookups=(party("vendor_id", "vendor_name"),),
        title=title("Vendor Return", "series_number", "vendor_name"),
        reference="series_number", status="status", date="date", amount=extract_amount,
        text=prose("vendor return purchase return", "series number, vendor <- vendor_name, status,"
                   " refund status, reference number, narration"),
    ),
    TableSpec(
        "pr_delivery_orders", M,
        lookups=(party("vendor_id", "vendor_name"),),
        title=title("Purchase Delivery Order", "series_number", "vendor_name"),
        reference="series_number", status="status", date="date",
        text=prose("purchase delivery order", "series number, vendor <- vendor_name, status, narration"),
    ),
    TableSpec(
        "pr_purchase_agreements", M,
        lookups=(party("vendor_id", "vendor_name"),),
        title=title("Purchase Agreement", "name", "vendor_name"),
        status="status", date="date", amount=extract_amount,
        text=prose("purchase agreement contract", "name, vendor <- vendor_name, agreement type, status,"
                   " instructions, narration"),
    ),
)
