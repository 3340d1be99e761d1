"""Rental tables. Titles, labels and column names are fixed values."""

from ..functions.text import id_reference, prose, title
from .spec import TAKE, TableSpec, party

M = "rental"

SPECS = (
    TableSpec(
        "rn_cross_hire_summary", M,
        lookups=(party("vendor_id", "party_name", company=TAKE),),
        title=title("Cross Hire", "party_name"), reference=id_reference, date="date",
        text=prose("cross hire rental", "party <- party_name"),
    ),
    TableSpec(
        "rn_delivery_order_grn", M,
        copies={"date": "receipt_date"}, lookups=(party("customer_id", "party_name"),),
        title=title("Rental Return GRN", "series_number", "party_name"),
        reference="series_number", status="status", date="date",
        text=prose("rental return delivery receipt", "series number, party <- party_name, status, po number, narration"),
    ),
)
