"""Account tables. Titles, labels and column names are fixed values."""

from ..functions.text import (
    column, extract_amount, party_display_name, party_text, prose, sql_employee_name, title,
)
from .spec import FILL, TAKE, Lookup, TableSpec, lookup, party

M = "account"

SPECS = (
    TableSpec(
        "sales_invoices", M,
        lookups=(party("customer_id", "customer_name"),),
        title=title("Sales Invoice", "series_number", "customer_name"),
        reference="series_number", date="date", amount=extract_amount,
        text=prose("sales invoice", "series number, customer <- customer_name, approval status,"
                   " payment status, transaction type, narration"),
    ),
    TableSpec(
        "purchase_invoices", M,
        copies={"date": "bill_date"}, lookups=(party("vendor_id", "vendor_name"),),
        title=title("Purchase Invoice", "series_number", "vendor_name"),
        reference="series_number", date="date", amount=extract_amount,
        text=prose("purchase invoice", "series number, vendor <- vendor_name, approval status,"
                   " payment status, supplier invoice number, narration"),
    ),
    TableSpec(
        "payment_entries", M,
        copies={"payment_method_type": "type"}, lookups=(lookup("journal_entries", "entry_id", company=TAKE),),
        title=title("Payment Entry", "series_number", "payment_method_type"),
        reference="reference_number", status="status", date="date", amount=extract_amount,
        text=prose("payment entry", "series number, payment type, party type, approval status, status,"
                   " payment method type, narration"),
    ),
    TableSpec(
        "credit_notes", M,
        copies={"date": "credit_note_date", "party_role": "party"}, lookups=(party("party_id", "party_name"),),
        title=title("Credit Note", "series_number", "party_name"),
        reference="series_number", status="status", date="date", amount=extract_amount,
        text=prose("credit note", "series number, party <- party_name, party role, status, narration"),
    ),
    TableSpec(
        "debit_notes", M,
        copies={"date": "debit_note_date", "party_role": "party"}, lookups=(party("party_id", "party_name"),),
        title=title("Debit Note", "series_number", "party_name"),
        reference="series_number", status="status", date="date", amount=extract_amount,
        text=prose("debit note", "series number, party <- party_name, party role, status, narration"),
    ),
    TableSpec(
        "journal_entries", M,
        copies={"date": "posting_date"},
        title=title("Journal Entry", "series_number", "narration"),
        reference="series_number", status="status", date="date",
        text=prose("journal entry", "series number, status, ref type, narration"),
    ),
    TableSpec(
        "parties", M,
        copies={"party_type": "type"},
        title=title("Party", party_display_name), text=party_text,
    ),
    TableSpec(
        "companies", M,
        copies={"company_id": "id"},
        title=title("Company", "company_name"), reference="crn",
        text=prose("company", "company name, crn, vat number, address, email, phone"),
    ),
    TableSpec(
        "employees", M,
        title=title("Employee", "first_name", "last_name"),
        reference="series_number", status="status", date="date_of_joining",
        text=prose("employee", "first name, last name, email, phone, nationality, gender, status, series number"),
    ),
    TableSpec(
        "user", M,
        title=title("User", "first_name", "last_name"), reference="email",
        text=prose("user", "first name, last name, email, phone"),
    ),
    TableSpec(
        "budgets", M,
        title=title("Budget", "budget_name", "budget_period"), status="status",
        text=prose("budget", "budget name, budget period, status"),
    ),
    TableSpec(
        "expense_reimbursements", M,
        lookups=(Lookup("employees", ("employee_id", "id"), {"employee_name": sql_employee_name}),),
        title=title("Expense Reimbursement", "series_number", "employee_name"),
        reference="series_number", date="transaction_date", amount=extract_amount,
        text=prose("expense reimbursement", "series number, employee <- employee_name, approval status,"
                   " expense entry type, paid by, description"),
    ),
    TableSpec(
        "cash_expenses", M,
        lookups=(party("vendor_id", "vendor_name"),),
        title=title("Cash Expense", "series_number", "vendor_name"),
        reference="series_number", date="bill_date", amount=extract_amount,
        text=prose("cash expense", "series number, vendor <- vendor_name, approval status, narration"),
    ),
    TableSpec(
        "assets", M,
        title=title("Fixed Asset", "asset_name"),
        reference="series_number", status="status", date=("acquisition_date", "posting_date"),
        amount="asset_value",
        text=prose("fixed asset", "asset name, series number, status, depreciation, asset specification"),
    ),
    TableSpec(
        "asset_transfers", M,
        lookups=(Lookup("assets", ("asset_id", "id"), {"asset_name": column("asset_name")}, FILL, "source_company_id"),),
        title=title("Asset Transfer", "transfer_name", "asset_name"),
        reference="reference_number", status="status", date="transfer_date",
        text=prose("asset transfer", "transfer name, asset name, status, narration"),
    ),
)
