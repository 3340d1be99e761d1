"""Sales tables. Titles, labels and column names are fixed values."""

from ..functions.text import extract_amount, prose, title
from .spec import TableSpec, party

M = "sales"

SPECS = (
    TableSpec(
        "sl_sales_orders", M,
        lookups=(party("customer_id", "customer_name"),),
        title=title("Sales Order", "series_number", "customer_name"),
        reference="series_number", status="status", date="date", amount=extract_amount,
        text=prose("sales order", "series number, customer <- customer_name, status, invoice status,"
                   " delivery status, return status, transaction type, po number, narration"),
    ),
    TableSpec(
        "sl_quotation", M,
        lookups=(party("party_id", "customer_name"),),
        title=title("Quotation", "reference_no", "customer_name"),
        reference="reference_no", status="status", date="date", amount=extract_amount,
        text=prose("quotation", "reference number <- reference_no, customer <- customer_name, status,"
                   " transaction type, narration"),
    ),
    TableSpec(
        "sl_delivery_orders", M,
        lookups=(party("customer_id", "customer_name"),),
        title=title("Delivery Order", "series_number", "customer_name"),
        reference="series_number", status="status", date="date", amount=extract_amount,
        text=prose("delivery order", "series number, customer <- customer_name, status, narration"),
    ),
    TableSpec(
        "sl_customer_returns", M,
        lookups=(party("customer_id", "customer_name"),),
        title=title("Customer Return", "series_number", "customer_name"),
        reference="series_number", status="status", date="date", amount=extract_amount,
        text=prose("customer return", "series number, customer <- customer_name, status, return source,"
                   " reference number, narration"),
    ),
    TableSpec(
        "sl_customer_return_grn", M,
        lookups=(party("customer_id", "customer_name"),),
        title=title("Customer Return Receipt", "customer_name", "series_number"),
        reference="series_number", date="date",
        text=prose("customer return receipt", "customer <- customer_name, reference number <- series_number, narration"),
    ),
    TableSpec(
        "sl_opportunity_parties", M,
        lookups=(party("party_id", "party_name"),),
        title=title("Sales Opportunity", "party_name", "stages"),
        date="expected_closing_date", amount="expected_revenue",
        text=prose("sales opportunity", "party <- party_name, stage <- stages, narration"),
    ),
    TableSpec(
        "sl_promotions", M,
        title=title("Promotion", "name"), status="status", date="start_date",
        text=prose("promotion", "name, promotion type, status, narration"),
    ),
)
