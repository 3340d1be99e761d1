"""The given tables seen as a tenant's operational tables.

Each view has the shape a table spec reads; nulls, blanks, padding, bad text
and missing partners are derived from the values of the given rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.spec import Source
from ..session import spread

TENANTS = ("spar", "dev_env")
FACTS = ("orders", "lineitem", "events", "documents", "embeddings")


def pick(c: str, options: dict[str, str | None]) -> Column:
    """Text chosen by a column's value; null for values not listed."""
    chosen = F.lit(None).cast("string")
    for value, text in options.items():
        chosen = F.when(F.col(c) == value, F.lit(text)).otherwise(chosen)
    return chosen


class Tables:
    """The given tables of one folder, and the views over them by source table name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self._dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        """A given table; the growing ones over all cores even where they are a single file."""
        table = self.spark.read.parquet(f"{self._dir}/{name}.parquet")
        return spread(table) if name in FACTS else table

    def source(self) -> Source:
        return lambda table: getattr(self, table)()

    def parties(self) -> DataFrame:
        seg, bal = F.col("c_mktsegment"), F.col("c_acctbal")
        return self.raw("customer").select(
            F.when(seg == "AUTOMOBILE", "dev_env").otherwise("spar").alias("client_id"),
            F.col("c_custkey").alias("id"),
            F.when(seg.isin("BUILDING", "MACHINERY"), F.concat(F.lit("Co "), "c_name"))
            .when(seg == "HOUSEHOLD", "").alias("company_name"),
            F.when(seg == "AUTOMOBILE", " Ann").when(seg == "HOUSEHOLD", "")
            .when(seg == "FURNITURE", F.col("c_name")).alias("first_name"),
            F.when(F.col("c_nationkey") < 8, "").when(F.col("c_nationkey") < 16, "M").alias("middle_name"),
            F.when(bal > 5000, F.concat(F.lit("Smith"), "c_nationkey")).when(bal < 0, "").alias("last_name"),
            F.when(bal < 9000, F.col("c_name")).alias("name"),
            F.when(F.col("c_nationkey") != 3, F.col("c_nationkey").cast("long")).alias("company_id"),
            seg.alias("type"),
            F.when(bal > 8000, "").when(bal > 2000, F.concat(F.lower("c_name"), F.lit("@mail.test"))).alias("email"),
            F.when(seg != "BUILDING", F.concat(F.lit("all-"), F.lower("c_name"))).alias("email_ids"),
            F.when(bal > 4000, F.concat(F.lit(" VAT "), "c_nationkey", F.lit("\n"))).alias("vat_number"),
            F.when(bal < -500, 1).when(bal.between(0, 60), None).otherwise(0).alias("is_deleted"),
        )

    def _order_base(self) -> DataFrame:
        orders, total = self.raw("orders"), F.col("o_totalprice")
        return orders.select(
            F.when(F.col("o_orderpriority") == "1-URGENT", "dev_env").otherwise("spar").alias("client_id"),
            F.col("o_orderkey").alias("id"),
            F.concat(F.lit("SO-"), "o_orderkey").alias("series_number"),
            F.when(total > 25000, F.col("o_custkey")).alias("customer_id"),
            F.col("o_orderstatus").alias("status"),
            F.to_date("o_orderdate").alias("date"),
            F.when(F.col("o_orderstatus") == "F", "n/a").when(
                F.col("o_orderstatus") == "P", F.concat(F.lit(" "), total.cast("decimal(18,2)").cast("string"), F.lit("\t"))
            ).alias("grand_total"),
            F.when(F.col("o_orderpriority") != "2-HIGH", total).alias("total_amount"),
            F.when(F.col("o_orderstatus") != "F", F.floor(total / 100000)).alias("company_id"),
            pick("o_orderpriority", {
                "1-URGENT": "\t rush it\n", "2-HIGH": "   ", "3-MEDIUM": "medium ", "5-LOW": "",
            }).alias("narration"),
            F.col("o_orderpriority").alias("priority"),
            F.when((F.col("o_orderstatus") == "P") & (total > 400000), 1).when(total < 5000, None).otherwise(0).alias("is_deleted"),
        )

    def sl_sales_orders(self) -> DataFrame:
        return self._order_base().withColumn("delivery_status", F.col("status")).withColumn(
            "expected_closing_date",
            F.when(F.col("priority") == "1-URGENT", "soon").when(F.col("priority") == "2-HIGH", " ")
            .otherwise(F.concat(F.lit(" "), F.col("date").cast("string"), F.lit("\n"))),
        )

    def purchase_invoices(self) -> DataFrame:
        base = self._order_base().withColumnRenamed("customer_id", "vendor_id")
        return base.withColumn("bill_date", F.date_add("date", 30)).withColumn(
            "approval_status", F.when(F.col("status") != "O", F.col("status"))
        )

    def items(self) -> DataFrame:
        return self.raw("part").select(
            F.lit("spar").alias("client_id"), F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
            F.concat_ws("-", "p_brand", "p_partkey").alias("sku"), F.col("p_type").alias("type"),
            F.col("p_brand").alias("brand"),
            F.when(F.col("p_size") < 25, F.col("p_retailprice").cast("decimal(18,2)").cast("string"))
            .when(F.col("p_size") == 30, "call us").alias("sales_price"),
            F.when(F.col("p_size") > 40, F.concat(F.lit("size "), "p_size")).alias("description"),
            F.when(F.col("p_size") == 50, 1).otherwise(0).alias("is_deleted"),
        )

    def _part_companies(self) -> DataFrame:
        pairs = self.raw("lineitem").select("l_partkey", F.nullif("l_suppkey", F.lit(0)).alias("company_id")).distinct()
        return pairs.select(F.lit("spar").alias("client_id"), "l_partkey", "company_id")

    def item_companies(self) -> DataFrame:
        return self._part_companies().withColumnRenamed("l_partkey", "item_id")

    def mf_bom_companies(self) -> DataFrame:
        return self._part_companies().withColumnRenamed("l_partkey", "bom_id")

    def mf_bom(self) -> DataFrame:
        return self.raw("part").select(
            F.lit("spar").alias("client_id"), F.col("p_partkey").alias("id"),
            F.when(F.col("p_size") > 10, F.col("p_partkey") + F.col("p_size")).alias("item_id"),
            F.concat(F.lit("kit "), "p_name").alias("name"), F.col("p_type").alias("version_number"),
            F.when(F.col("p_size") < 30, "open").alias("status"),
            F.when(F.col("p_size") == 49, 1).otherwise(0).alias("is_deleted"),
        )

    def warehouse_location(self) -> DataFrame:
        return self.raw("nation").select(
            F.lit("spar").alias("client_id"), F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"),
            F.col("n_regionkey").cast("long").alias("company_id"), F.lit(0).alias("is_deleted"),
        )

    def stock_transfers(self) -> DataFrame:
        """Line items as transfers from the supplier's nation to the customer's; two keys into one table."""
        line, sup = self.raw("lineitem"), self.raw("supplier").select("s_suppkey", "s_nationkey")
        orders = self.raw("orders").select("o_orderkey", "o_custkey")
        cust = self.raw("customer").select("c_custkey", "c_nationkey")
        joined = (
            line.join(sup, line.l_suppkey == sup.s_suppkey, "left")
            .join(orders, line.l_orderkey == orders.o_orderkey, "left")
            .join(cust, F.col("o_custkey") == cust.c_custkey, "left")
        )
        return joined.select(
            F.lit("spar").alias("client_id"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
            F.col("s_nationkey").cast("long").alias("source_location_id"),
            F.when(F.col("l_quantity") < 48, F.col("c_nationkey").cast("long")).alias("destination_location_id"),
            F.col("l_returnflag").alias("operation_type"), F.col("l_linestatus").alias("status"),
            F.to_date("l_shipdate").alias("date"), F.col("l_quantity").alias("quantity"),
            F.lit(0).alias("is_deleted"),
        )

    def department(self) -> DataFrame:
        return self.raw("region").select(
            F.lit("spar").alias("client_id"), F.col("r_regionkey").cast("long").alias("id"), F.col("r_name").alias("name")
        )

    def pr_purchase_requests(self) -> DataFrame:
        """Line items as requests: the line number is the department, the supplier key the vendor."""
        return self.raw("lineitem").select(
            F.lit("spar").alias("client_id"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
            F.concat_ws("-", F.lit("PR"), "l_orderkey", "l_linenumber").alias("series_number"),
            F.col("l_linenumber").cast("long").alias("department_id"),
            F.when(F.col("l_returnflag") != "N", F.col("l_suppkey")).alias("vendor_id"),
            F.col("l_linestatus").alias("status"), F.to_date("l_shipdate").alias("date"), F.lit(0).alias("is_deleted"),
        )

    def employees(self) -> DataFrame:
        return self.parties().select("client_id", "id", "first_name", "last_name", "company_id", "is_deleted")

    def expense_reimbursements(self) -> DataFrame:
        base = self._order_base().withColumnRenamed("customer_id", "employee_id")
        return base.withColumnRenamed("date", "transaction_date")

    def stream_tenants(self) -> DataFrame:
        """Each region as a tenant; all share a database name and differ in their topic prefix."""
        name = F.col("r_name")
        client = F.when(name == "AFRICA", "spar").when(name == "AMERICA", "dev_env").otherwise(
            F.replace(F.lower(name), F.lit(" "), F.lit("_"))
        )
        return self.raw("region").select(
            client.alias("client_id"), F.lit("shared_db").alias("db_name"),
            F.concat(F.lit("cdc_"), client).alias("cdc_topic_prefix"),
        )

    def tenant_config(self) -> DataFrame:
        """Nations as tenant settings with faults: bad ids, repeats, shared routes, blanks and dots."""
        key, region = F.col("n_nationkey"), F.col("n_regionkey")
        return self.raw("nation").select(
            F.when(key > 20, F.col("n_name")).when(region == 2, "same_id").otherwise(F.lower("n_name")).alias("client_id"),
            F.when(region == 4, None).when(key == 7, "db.seven").otherwise("shared_db").alias("db_name"),
            F.when(region == 3, "cdc_three").when(key == 0, " ").otherwise(F.concat(F.lit("cdc_"), F.lower("n_name")))
            .alias("cdc_topic_prefix"),
        )

    def requests(self) -> DataFrame:
        """Each nation as a search request with its own filters and page."""
        key, region = F.col("n_nationkey"), F.col("n_regionkey")
        none = F.lit(None).cast("array<string>")
        return self.raw("nation").select(
            key.cast("long").alias("query_id"),
            F.when(region < 3, "spar").otherwise("dev_env").alias("client_id"),
            F.when(region == 1, F.array(F.lit("sales"), F.lit("account"))).when(region == 2, F.array(F.lit("account")))
            .otherwise(none).alias("modules"),
            F.when(key < 10, F.array(F.lit("O"), F.lit("P"))).when(key < 15, F.array(F.lit("F"))).otherwise(none).alias("status"),
            F.when(key < 20, F.date_add(F.lit("1996-01-01").cast("date"), key * 30)).alias("date_from"),
            F.when(key > 5, F.date_add(F.lit("1999-01-01").cast("date"), key * 20)).alias("date_to"),
            F.when(key != 4, key + 1).alias("limit"), F.when(key != 6, key * 2).alias("offset"),
        )

    def raw_events(self) -> DataFrame:
        """Events as change messages: the type gives the operation, the value what is wrong with it."""
        e = self.raw("events")
        op = pick("event_type", {"signup": "c", "view": "r", "click": "u", "purchase": "u", "error": "d"})
        table = F.when(F.col("value") < 0.5, "").when(F.col("value") > 250, "no_such_table").otherwise("parties")
        image = F.concat(F.lit('{"id": '), F.col("user_id").cast("string"), F.lit(', "name": "x"}'))
        before = F.when((op == "d") & (F.col("value") > 1), image).otherwise("null")
        after = F.when((op != "d") & (F.col("value") > 1.5), image).otherwise("null")
        body = F.concat(
            F.lit('{"op": "'), op, F.lit('", "before": '), before, F.lit(', "after": '), after,
            F.lit(', "source": {"table": "'), table, F.lit('", "db": "shared_db"}}'),
        )
        message = (
            F.when(F.col("value").between(100, 101), "")
            .when(F.col("value").between(101, 102), "default")
            .when(F.col("value").between(102, 103), F.substring_index(body, '"source"', 1))
            .when(F.col("event_type") == "click", F.concat(F.lit('{"payload": '), body, F.lit("}")))
            .otherwise(body)
        )
        stream = F.when(F.col("value") < 20, "cdc_dev_env.shared_db.parties").when(
            F.col("value") > 300, "cdc_gone.shared_db.parties"
        ).otherwise("cdc_spar.shared_db.parties")
        return e.select(stream.alias("stream"), F.col("event_id").cast("string").alias("msg_id"), message.alias("value"))
