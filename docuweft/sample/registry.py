"""All table specs over one wide view of the customers, and the same documents in SQL.

The view has every column any table reads, under a rule that leaves some blank,
null or padded; each table and each looked-up table is that view.  The two
junction tables come from the orders.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from ..operators.documents import build_documents
from ..plans.registry import BASE, modules
from ..plans.spec import Source
from .oracle import EMPLOYEE, PARTY, nb, prose, title
from .views import Tables

TEXTS = """series_number reference_number reference_no status approval_status payment_status transaction_type narration
supplier_invoice_number type payment_type party_type party ref_type crn vat_number address email phone nationality gender
budget_name budget_period expense_entry_type paid_by description asset_name depreciation asset_specification transfer_name
name sku brand upc_bar_code short_name reason operation_type transfer_type invoice_status delivery_status return_status
po_number return_source stages promotion_type billing_status receiving_status order_type refund_status agreement_type
instructions material_status version_number serial_number used_by model maintenance_period transporter_name driver_name
driver_contact_number identification_number entry_purpose entry_material exit_purpose file_extension mime_type title
first_name middle_name last_name company_name sales_lead_status sales_op_stage""".split()
KEYS = """customer_id vendor_id entry_id party_id employee_id asset_id location source_location_id destination_location_id
supplier_id department_id item_id work_order_id created_by""".split()
DAYS = """date bill_date credit_note_date debit_note_date posting_date date_of_joining transaction_date acquisition_date transfer_date
expected_closing_date start_date grn_date effective_date record_date receipt_date""".split()
MONEY = "grand_total asset_value sales_price expected_revenue equipment_cost".split()
SHOWN = ("client_id", "id", "source_id", "doc_type", "module", "company_id", "title", "reference", "status", "date",
         "amount", "party_name", "text_content")


def wide_columns() -> dict[str, str]:
    """Column -> expression over a customer row, in SQL both engines read."""
    columns = {
        "client_id": "case when c_mktsegment = 'AUTOMOBILE' then 'dev_env' else 'spar' end", "id": "c_custkey",
        "company_id": "case when c_acctbal > 3000 then cast(c_nationkey as bigint) end",
        "source_company_id": "case when c_acctbal < 3000 then cast(c_nationkey as bigint) end",
        "is_deleted": "case when c_acctbal < -500 then 1 when c_acctbal between 0 and 60 then null else 0 end",
    }
    for n, name in enumerate(TEXTS):
        said = f"'{name.replace('_', ' ')} ' || c_custkey"
        columns[name] = (
            said,
            f"case when c_mktsegment = 'HOUSEHOLD' then '' else {said} end",
            f"case when c_mktsegment <> 'MACHINERY' then '  ' || {said} || chr(9) end",
            f"case when c_acctbal < 1000 then '   ' when c_acctbal < 5000 then {said} end",
        )[n % 4]
    for n, name in enumerate(KEYS):
        columns[name] = (
            f"case when c_mktsegment = 'BUILDING' then null when c_acctbal > 9000 then -1 - c_custkey"
            f" else cast(c_nationkey * {n + 2} as bigint) end"
        )
    for n, name in enumerate(DAYS):
        columns[name] = f"case when c_nationkey <> {n} then cast('2024-01-{n + 1:02d}' as date) end"
    for n, name in enumerate(MONEY):
        columns[name] = f"case when c_nationkey <> {n} then cast(c_acctbal as decimal(18, 2)) end"
    return columns


def wide_source(t: Tables) -> Source:
    wide = t.raw("customer").selectExpr(*[f"{sql} as {name}" for name, sql in wide_columns().items()])

    def links(key: str) -> DataFrame:
        pairs = t.raw("orders").selectExpr("o_custkey", "floor(o_totalprice / 200000) as company_id")
        return pairs.distinct().selectExpr("'spar' as client_id", f"o_custkey as {key}", "company_id")

    named = {"item_companies": "item_id", "mf_bom_companies": "bom_id"}
    return lambda table: links(named[table]) if table in named else wide


def documents_of_module(t: Tables, module: str) -> DataFrame:
    source = wide_source(t)
    parts = [build_documents(s, source).select(*SHOWN) for s in BASE.values() if s.module == module]
    return reduce(DataFrame.unionByName, parts)


# What a document of each table says.  table | title parts | reference | status |
# date | amount | text label: fields | copies | join (table key, columns added, use of its company).
DOCUMENTS = """
sales_invoices | Sales Invoice, series_number, customer_name | series_number | - | date | first | sales invoice: series number, customer <- customer_name, approval status, payment status, transaction type, narration | - | party customer_id customer_name fill
purchase_invoices | Purchase Invoice, series_number, vendor_name | series_number | - | date | first | purchase invoice: series number, vendor <- vendor_name, approval status, payment status, supplier invoice number, narration | date=bill_date | party vendor_id vendor_name fill
payment_entries | Payment Entry, series_number, payment_method_type | reference_number | status | date | first | payment entry: series number, payment type, party type, approval status, status, payment method type, narration | payment_method_type=type | own entry_id - take
credit_notes | Credit Note, series_number, party_name | series_number | status | date | first | credit note: series number, party <- party_name, party role, status, narration | date=credit_note_date, party_role=party | party party_id party_name fill
debit_notes | Debit Note, series_number, party_name | series_number | status | date | first | debit note: series number, party <- party_name, party role, status, narration | date=debit_note_date, party_role=party | party party_id party_name fill
journal_entries | Journal Entry, series_number, narration | series_number | status | date | - | journal entry: series number, status, ref type, narration | date=posting_date | -
parties | Party, DISPLAY | - | - | - | - | PARTY | party_type=type | -
companies | Company, company_name | crn | - | - | - | company: company name, crn, vat number, address, email, phone | company_id=id | -
employees | Employee, first_name, last_name | series_number | status | date_of_joining | - | employee: first name, last name, email, phone, nationality, gender, status, series number | - | -
user | User, first_name, last_name | email | - | - | - | user: first name, last name, email, phone | - | -
budgets | Budget, budget_name, budget_period | - | status | - | - | budget: budget name, budget period, status | - | -
expense_reimbursements | Expense Reimbursement, series_number, employee_name | series_number | - | transaction_date | first | expense reimbursement: series number, employee <- employee_name, approval status, expense entry type, paid by, description | - | employee employee_id employee_name -
cash_expenses | Cash Expense, series_number, vendor_name | series_number | - | bill_date | first | cash expense: series number, vendor <- vendor_name, approval status, narration | - | party vendor_id vendor_name fill
assets | Fixed Asset, asset_name | series_number | status | coalesce(acquisition_date, posting_date) | asset_value | fixed asset: asset name, series number, status, depreciation, asset specification | - | -
asset_transfers | Asset Transfer, transfer_name, asset_name | reference_number | status | transfer_date | - | asset transfer: transfer name, asset name, status, narration | - | own asset_id asset_name=asset_name source
items | Item, name | sku | - | - | sales_price | item product: name, sku, item type, brand, upc bar code, description | item_type=type | junction left
warehouse_location | Warehouse, name | short_name | - | - | - | warehouse location: name, short name, address | - | -
inventory_adjustments | Inventory Adjustment, reason, location_name | - | - | date | - | inventory adjustment stock adjustment: reason, location <- location_name, narration | - | own location location_name=name -
bin_transfers | Bin Transfer, status | - | status | date | - | bin transfer: status, narration | - | -
stock_transfers | Stock Transfer, operation_type, source_location_name, destination_location_name | - | status | date | - | stock transfer: operation type, source location <- source_location_name, destination location <- destination_location_name, transfer type, status, description | - | own source_location_id source_location_name=name - ; own destination_location_id destination_location_name=name -
sl_sales_orders | Sales Order, series_number, customer_name | series_number | status | date | first | sales order: series number, customer <- customer_name, status, invoice status, delivery status, return status, transaction type, po number, narration | - | party customer_id customer_name fill
sl_quotation | Quotation, reference_no, customer_name | reference_no | status | date | first | quotation: reference number <- reference_no, customer <- customer_name, status, transaction type, narration | - | party party_id customer_name fill
sl_delivery_orders | Delivery Order, series_number, customer_name | series_number | status | date | first | delivery order: series number, customer <- customer_name, status, narration | - | party customer_id customer_name fill
sl_customer_returns | Customer Return, series_number, customer_name | series_number | status | date | first | customer return: series number, customer <- customer_name, status, return source, reference number, narration | - | party customer_id customer_name fill
sl_customer_return_grn | Customer Return Receipt, customer_name, series_number | series_number | - | date | - | customer return receipt: customer <- customer_name, reference number <- series_number, narration | - | party customer_id customer_name fill
sl_opportunity_parties | Sales Opportunity, party_name, stages | - | - | expected_closing_date | expected_revenue | sales opportunity: party <- party_name, stage <- stages, narration | - | party party_id party_name fill
sl_promotions | Promotion, name | - | status | start_date | - | promotion: name, promotion type, status, narration | - | -
pr_purchase_orders | Purchase Order, series_number, vendor_name | series_number | status | date | first | purchase order: series number, vendor <- vendor_name, status, billing status, receiving status, return status, order type, narration | - | party supplier_id vendor_name fill
pr_purchase_requests | Purchase Request, series_number, EITHER | series_number | - | date | - | purchase request: series number, department <- department_name, approval status, narration | approval_status=status | own department_id department_name=name - ; party vendor_id vendor_name -
pr_rfqs | RFQ, series_number, vendor_name | series_number | status | date | - | request for quotation rfq: series number, vendor <- vendor_name, status, rfq type, reference number, narration | rfq_type=type | party vendor_id vendor_name fill
pr_rfq_responses | RFQ Response, vendor_name, reference_number | reference_number | - | date | first | rfq response quotation: vendor <- vendor_name, reference number, narration | - | party vendor_id vendor_name fill
pr_purchase_order_grns | Purchase GRN, series_number, vendor_name | series_number | - | date | - | purchase goods receipt grn: series number, vendor <- vendor_name, narration | date=grn_date | party vendor_id vendor_name fill
pr_vras | Vendor Return, series_number, vendor_name | series_number | status | date | first | vendor return purchase return: series number, vendor <- vendor_name, status, refund status, reference number, narration | - | party vendor_id vendor_name fill
pr_delivery_orders | Purchase Delivery Order, series_number, vendor_name | series_number | status | date | - | purchase delivery order: series number, vendor <- vendor_name, status, narration | - | party vendor_id vendor_name fill
pr_purchase_agreements | Purchase Agreement, name, vendor_name | - | status | date | first | purchase agreement contract: name, vendor <- vendor_name, agreement type, status, instructions, narration | - | party vendor_id vendor_name fill
mf_work_orders | Work Order, series_number, item_name | series_number | status | date | - | work order manufacturing: series number, item <- item_name, status, material status, reference number, narration | - | own item_id item_name=name -
mf_bom | Bill of Materials, name, item_name | version_number | status | start_date | - | bill of materials bom: name, item <- item_name, version number, status, narration | - | own item_id item_name=name - ; junction inner
mf_build_orders | Build Order, series_number, item_name | series_number | status | date | - | build order assembly: series number, item <- item_name, status, narration | - | own item_id item_name=name -
mf_job_cards | Job Card, series_number, work_order_number | series_number | status | date | - | job card production: series number, work order number, status, material status, narration | - | own work_order_id work_order_number=series_number -
mf_production_plan | Production Plan, series_number | series_number | status | date | - | production plan: series number | - | -
mf_equipments | Equipment, name | serial_number | status | effective_date | equipment_cost | equipment machinery: name, serial number, vendor <- vendor_name, status, used by, model, maintenance period, narration | - | party vendor_id vendor_name -
mf_gate_registers | Gate Register, series_number, transporter_name | series_number | - | record_date | - | gate register entry exit: series number, transporter <- transporter_name, driver <- driver_name, driver contact <- driver_contact_number, identification number, entry purpose, entry material, exit purpose | - | -
rn_cross_hire_summary | Cross Hire, party_name | nullif(id, 0)::varchar | - | date | - | cross hire rental: party <- party_name | - | party vendor_id party_name take
rn_delivery_order_grn | Rental Return GRN, series_number, party_name | series_number | status | date | - | rental return delivery receipt: series number, party <- party_name, status, po number, narration | date=receipt_date | party customer_id party_name fill
drive | Document File, file_name | - | - | - | - | document file: file name, drive type, mime type, file extension | file_name=title, drive_type=type | own created_by - take
"""

OWN_NAMES = "concat_ws(' ', nullif(first_name, ''), nullif(middle_name, ''), nullif(last_name, ''))"
DISPLAY = f"coalesce(nullif(company_name, ''), nullif({OWN_NAMES}, ''))"
PARTY_SAYS = (("party type", "party_type"), ("vat number", "vat_number"), ("crn", "crn"), ("email", "email"),
              ("sales lead status", "sales_lead_status"), ("sales opportunity stage", "sales_op_stage"))


def _cell(name: str) -> str:
    return {"DISPLAY": DISPLAY, "EITHER": "coalesce(nullif(vendor_name, ''), department_name)"}.get(name, name)


def _text(said: str) -> str:
    if said == "PARTY":
        rest = ", ".join(f"case when {nb(c)} is not null then '{n} is ' || {c} end" for n, c in PARTY_SAYS)
        label = "case when nullif(company_name, '') is not null then ' with company name ' else ' with name ' end"
        return f"concat_ws(', ', 'This is a party' || coalesce({label} || {DISPLAY}, ''), {rest})"
    label, _, fields = said.partition(": ")
    pairs = [f.partition(" <- ") for f in fields.split(", ")]
    return prose(label, **{n.replace(" ", "_"): c or n.replace(" ", "_") for n, _, c in pairs})


def document_sql(line: str) -> str:
    """One table's documents over the views w and w_links."""
    table, parts, reference, status, date, amount, said, copies, joins = (c.strip() for c in line.split(" | "))
    given = {} if copies == "-" else {a: f"t.{c}" for a, c in (p.strip().split("=") for p in copies.split(","))}
    froms, junction, names = ["w t"], False, []
    for n, join in enumerate([] if joins == "-" else joins.split(" ; ")):
        kind, key, *rest = join.split()
        d = f"d{n}"
        if kind == "junction":
            junction = True
            froms.append(f"{key} join w_links {d} on {d}.k = t.id and t.client_id = 'spar'")
            given["company_id"] = f"{d}.company_id"
            continue
        froms.append(f"left join w {d} on {d}.id = t.{key} and {d}.client_id = t.client_id")
        added, company = rest
        if kind in ("party", "employee"):
            given[added] = (PARTY if kind == "party" else EMPLOYEE).replace("p.", f"{d}.")
            names.append(added)
        elif added != "-":
            alias, _, column = added.partition("=")
            given[alias] = f"{d}.{column}"
        own = "t.source_company_id" if company == "source" else "t.company_id"
        if company != "-":
            given["company_id"] = f"{d}.company_id" if company == "take" else f"coalesce({own}, {d}.company_id)"
    hidden = [c for c in given if c in wide_columns()]
    star = f"t.* exclude ({', '.join(hidden)})" if hidden else "t.*"
    inner = ", ".join([star, *[f"{sql} as {alias}" for alias, sql in given.items()]])
    label, *cells = [p.strip() for p in parts.split(",")]
    shown = [f"nullif({n}, '')" for n in names if n in ("customer_name", "vendor_name", "party_name", "employee_name")]
    shown += [nb(OWN_NAMES), "nullif(name, '')", "nullif(company_name, '')"]
    ident = f"'{table}:' || id" + (" || ':' || coalesce(nullif(company_id, 0)::varchar, '')" if junction else "")
    module = BASE[table].module
    money = {"first": "grand_total::double", "-": "null::double"}.get(amount, f"{amount}::double")
    return f"""select client_id, {ident} id, id source_id, '{table}' doc_type, '{module}' as module,
        coalesce(company_id::varchar, '0') company_id, {title(label, *[_cell(c) for c in cells])} title,
        {'null::varchar' if reference == '-' else reference} reference, {'null::varchar' if status == '-' else status} status,
        {'null::date' if date == '-' else date} as date, {money} amount, coalesce({', '.join(shown)}) party_name, {_text(said)} text_content
      from (select {inner} from {' '.join(froms)} where t.is_deleted = 0)"""


def module_sql() -> dict[str, str]:
    """Query name -> SQL, one per module."""
    wide = ", ".join(f"{sql} as {name}" for name, sql in wide_columns().items())
    views = f"""with w as (select {wide} from customer),
      w_links as (select distinct o_custkey k, floor(o_totalprice / 200000)::bigint company_id from orders)"""
    lines = DOCUMENTS.strip().splitlines()
    out = {}
    for module in modules():
        selects = [document_sql(line) for line in lines if BASE[line.split(" | ")[0]].module == module]
        out[f"registry_{module}"] = f"{views} {' union all '.join(selects)}"
    return out
