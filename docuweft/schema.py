"""Fixed record layouts: documents, change rows, events, run status, dead letters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

STRING, LONG, DOUBLE, DATE = T.StringType(), T.LongType(), T.DoubleType(), T.DateType()
VECTOR = T.ArrayType(T.FloatType())

# The document fields in order; those below come first.
CORE_FIELDS = (
    "id", "source_id", "doc_type", "module", "company_id", "title", "reference", "status",
    "date", "amount", "text_content", "embedding", "party_name", "company_name", "first_name",
    "last_name", "approval_status", "transaction_type", "email", "phone",
)
CORE_TYPES = {"source_id": LONG, "date": DATE, "amount": DOUBLE, "embedding": VECTOR}
CORE_ANALYZERS = {
    "title": "domain", "text_content": "domain", "reference": "domain",
    "party_name": "standard", "company_name": "standard",
}
# The fields a change event writes in the narrow document shape.
NARROW_FIELDS = (
    "id", "source_id", "doc_type", "module", "company_id", "title", "reference", "status", "date",
    "amount", "text_content", "embedding", "party_name", "approval_status", "transaction_type",
    "email", "phone",
)


@dataclass(frozen=True)
class DocField:
    name: str
    type: T.DataType
    rule: str = "text"
    analyzer: str | None = None


# The fields that pass a source column through, in order.
PASS_THROUGH = (
    DocField("payment_status", STRING),
    DocField("due_date", DATE, "date"),
    DocField("amount_paid", DOUBLE, "double"),
    DocField("amount_due", DOUBLE, "double"),
    DocField("supplier_invoice_number", STRING),
    DocField("order_type", STRING),
    DocField("payment_type", STRING),
    DocField("payment_method_type", STRING),
    DocField("cheque_number", STRING),
    DocField("cheque_date", DATE, "date"),
    DocField("is_reconciled", STRING),
    DocField("narration", STRING, analyzer="english"),
    DocField("ref_type", STRING),
    DocField("party_role", STRING),
    DocField("version", STRING),
    DocField("po_number", STRING),
    DocField("party_type", STRING),
    DocField("vat_number", STRING),
    DocField("crn", STRING),
    DocField("sales_lead_status", STRING),
    DocField("sales_op_stage", STRING),
    DocField("credit_hold", STRING),
    DocField("is_active", STRING),
    DocField("address", STRING, analyzer="standard"),
    DocField("date_of_joining", DATE, "date"),
    DocField("nationality", STRING),
    DocField("gender", STRING),
    DocField("role_id", STRING),
    DocField("budget_period", STRING),
    DocField("transaction_date", DATE, "date"),
    DocField("paid_by", STRING),
    DocField("expense_entry_type", STRING),
    DocField("bill_date", DATE, "date"),
    DocField("asset_value", DOUBLE, "double"),
    DocField("acquisition_date", DATE, "date"),
    DocField("depreciation", STRING),
    DocField("asset_specification", STRING, analyzer="english"),
    DocField("original_value", DOUBLE, "double"),
    DocField("invoice_status", STRING),
    DocField("delivery_status", STRING),
    DocField("expiration_date", DATE, "date"),
    DocField("return_status", STRING),
    DocField("return_source", STRING),
    DocField("stages", STRING),
    DocField("expected_closing_date", DATE, "date"),
    DocField("expected_revenue", DOUBLE, "double"),
    DocField("probability", DOUBLE, "double"),
    DocField("priority", STRING),
    DocField("promotion_type", STRING),
    DocField("start_date", DATE, "date"),
    DocField("end_date", DATE, "date"),
    DocField("billing_status", STRING),
    DocField("receiving_status", STRING),
    DocField("rfq_type", STRING),
    DocField("lead_time", STRING),
    DocField("received_by", STRING),
    DocField("agreement_type", STRING),
    DocField("valid_up_to", DATE, "date"),
    DocField("refund_status", STRING),
    DocField("item_type", STRING),
    DocField("sales_price", DOUBLE, "double"),
    DocField("purchase_price", DOUBLE, "double"),
    DocField("upc_bar_code", STRING),
    DocField("costing_method", STRING),
    DocField("city", STRING),
    DocField("summary", STRING, analyzer="english"),
    DocField("transfer_type", STRING),
    DocField("description", STRING, analyzer="english"),
    DocField("material_status", STRING),
    DocField("production_start_date", DATE, "date"),
    DocField("production_end_date", DATE, "date"),
    DocField("quantity", DOUBLE, "double"),
    DocField("work_order_type", STRING),
    DocField("equipment_cost", DOUBLE, "double"),
    DocField("effective_date", DATE, "date"),
    DocField("warranty_expiration_date", DATE, "date"),
    DocField("maintenance_period", STRING),
    DocField("transporter_name", STRING),
    DocField("driver_name", STRING),
    DocField("driver_contact_number", STRING),
    DocField("entry_datetime", DATE, "date"),
    DocField("exit_datetime", DATE, "date"),
    DocField("entry_purpose", STRING, analyzer="english"),
    DocField("exit_purpose", STRING, analyzer="english"),
    DocField("received_quantity", DOUBLE, "double"),
    DocField("returned_quantity", DOUBLE, "double"),
    DocField("file_extension", STRING),
    DocField("mime_type", STRING),
    DocField("drive_type", STRING),
    DocField("is_private", STRING),
)
DOC_FIELDS = tuple(
    DocField(n, CORE_TYPES.get(n, STRING), "core", CORE_ANALYZERS.get(n)) for n in CORE_FIELDS
) + PASS_THROUGH
ANALYZER_OF = {f.name: f.analyzer for f in DOC_FIELDS if f.analyzer}
DOC_SCHEMA = T.StructType([T.StructField(f.name, f.type) for f in DOC_FIELDS])

#: What a stored row does: put a document, delete by source id, by document type
#: or by tenant, or record a row that was refused.
PUT, DEL_KEY, DEL_TYPE, DEL_TENANT, REJECT = "put", "del_key", "del_type", "del_tenant", "reject"
CHANGE_SCHEMA = T.StructType(
    [
        T.StructField("client_id", STRING),
        T.StructField("kind", STRING),
        T.StructField("seq", LONG),
        T.StructField("reason", STRING),
    ]
    + list(DOC_SCHEMA.fields)
)

RAW_EVENT_SCHEMA = "stream string, msg_id string, value string"
TENANT_SCHEMA = "client_id string, db_name string, cdc_topic_prefix string, db_host string, db_port int"
DEAD_LETTER_SCHEMA = "value string, original_id string, stream string, reason string"
RUN_SCHEMA = (
    "job_id string, client_id string, status string, indexed long, errors long, "
    "total_tables int, completed_tables int, failed_tables array<string>, "
    "started_at timestamp, completed_at timestamp, duration_ms double, updated_at timestamp"
)
