"""The driver's star schema seen as canonical tables: parties, invoices, lines, shipments, payments, readings.

Each table is a lazy projection; ``VIEWS`` holds the same tables in DuckDB SQL for the oracles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MONEY = "decimal(16,2)"
#: Lines whose readings or pages go to one task.
LINES = 150_000


def money(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(MONEY)


class Driver:
    """Canonical tables over one folder of driver tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def line_tasks(self) -> int:
        """Tasks that the lines are dealt into; they follow the lines, so what one holds does not grow."""
        return max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), self.raw("lineitem").count() // LINES)

    def party(self) -> DataFrame:
        def side(table: str, mark: str, letter: str) -> DataFrame:
            key = F.col(f"{mark}_{'cust' if mark == 'c' else 'supp'}key")
            return self.raw(table).select(F.concat(F.lit(letter), key).alias("party_key"), F.col(f"{mark}_name").alias("canonical_name"), F.lit(table).alias("role"), F.col(f"{mark}_nationkey").alias("nation_key"), (F.col("c_mktsegment") if mark == "c" else F.lit(None).cast("string")).alias("segment"))

        return side("customer", "c", "C").unionByName(side("supplier", "s", "S"))

    def selling_location(self) -> DataFrame:
        n, r = self.raw("nation"), self.raw("region")
        return n.join(r, n.n_regionkey == r.r_regionkey).select(F.concat(F.lit("L"), "n_nationkey").alias("selling_location_key"), F.col("n_name").alias("location_name"), F.col("r_name").alias("territory_name"))

    def invoice_header(self) -> DataFrame:
        o = self.raw("orders")
        c = self.raw("customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
        total = money("o_totalprice")
        due = F.when(F.col("o_orderstatus") == "O", total).when(F.col("o_orderstatus") == "P", money(total / 2)).otherwise(money(F.lit(0)))
        k = F.col("o_orderkey")
        return o.join(c, "o_custkey", "left").select(
            F.concat(F.lit("I"), k).alias("invoice_key"),
            F.concat(F.lit("INV-"), F.lpad(k.cast("string"), 8, "0")).alias("invoice_number"),
            F.to_date("o_orderdate").alias("invoice_date"),
            F.date_add(F.to_date("o_orderdate"), 30).alias("due_date"),
            F.concat(F.lit("C"), "o_custkey").alias("payer_party_key"),
            F.concat(F.lit("S"), (k % 10).cast("string")).alias("biller_party_key"),
            F.when(k % 3 == 0, "USD").when(k % 3 == 1, "EUR").otherwise("CAD").alias("currency_code"),
            total.alias("total_amount"),
            due.alias("amount_due"),
            F.concat(F.lit("L"), "c_nationkey").alias("selling_location_key"),
            F.concat(F.lit("D"), k).alias("source_document_id"),
            F.when(k % 11 == 0, "needs_review").otherwise("clear").alias("review_status"),
            F.when(k % 7 == 0, "").when(k % 13 != 0, F.col("o_orderpriority")).alias("priority"),
            k.alias("ordinal"),
        )

    def invoice_line(self) -> DataFrame:
        q, e = F.col("l_quantity").cast("decimal(16,4)"), money("l_extendedprice")
        price = (F.col("l_extendedprice") / F.col("l_quantity")).cast("decimal(16,4)")
        return self.raw("lineitem").select(
            F.concat(F.lit("I"), "l_orderkey").alias("invoice_key"),
            F.concat(F.lit("D"), "l_orderkey").alias("document_id"),
            F.col("l_linenumber").alias("line_number"),
            F.concat(F.lit("P"), "l_partkey").alias("product_key"),
            F.when(F.col("l_partkey") % 19 != 0, q).alias("quantity"),
            price.alias("unit_price"),
            money(F.when(F.col("l_partkey") % 17 == 0, e + 1).otherwise(e)).alias("extended_amount"),
            F.col("l_discount").cast("decimal(5,4)").alias("rate"),
            F.to_date("l_shipdate").alias("ship_date"),
            F.col("l_suppkey").alias("suppkey"),
            F.col("l_partkey").alias("partkey"),
        )

    def shipment(self) -> DataFrame:
        o = self.raw("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
        return self.raw("lineitem").join(o, "l_orderkey").select(
            F.concat(F.lit("D"), "l_orderkey").alias("source_document_id"),
            F.to_date("l_shipdate").alias("ship_date"),
            F.when(F.col("l_partkey") % 23 != 0, F.date_add(F.to_date("o_orderdate"), 60)).alias("committed_date"),
            F.date_add(F.to_date("l_shipdate"), (F.col("l_partkey") % 20).cast("int")).alias("delivery_date"),
        )

    def attribution(self) -> DataFrame:
        k = F.col("o_orderkey")
        return self.raw("orders").filter(k % 5 != 0).select(F.lit("invoice_header").alias("target_table"), F.concat(F.lit("I"), k).alias("target_key"), (money("o_totalprice") - money("o_totalprice") % 10).cast(MONEY).alias("amount"), (k % 10 == 1).alias("is_failure"), F.concat(F.lit("D"), k).alias("source_document_id"))

    def payment(self) -> DataFrame:
        """Applications: a full one for most finished orders, 100 short for some, some to unknown invoices."""
        k = F.col("o_orderkey")
        part = F.when(k % 4 == 0, money("o_totalprice") - 100).otherwise(money("o_totalprice"))
        number = F.when(k % 9 == 0, F.concat(F.lit("UNKNOWN-"), k)).otherwise(F.concat(F.lit("INV-"), F.lpad(k.cast("string"), 8, "0")))
        return self.raw("orders").filter(F.col("o_orderstatus").isin("F", "P")).select(number.alias("invoice_number"), money(part).alias("amount_applied"), F.concat(F.lit("C"), "o_custkey").alias("payer_party_key"))

    def readings(self) -> DataFrame:
        """Three readers of each line's amount, and of its flag; b and c misread by modulus; c skips some."""
        line = self.raw("lineitem").select(F.concat(F.lit("D"), "l_orderkey").alias("document_id"), F.col("l_linenumber").alias("row_index"), "l_partkey", money("l_extendedprice").alias("e"), "l_returnflag")
        # dealt once by document, which later groupings by cell or document need not do again
        line = line.repartition(self.line_tasks(), "document_id").groupBy("document_id", "row_index").agg(F.max("l_partkey").alias("p"), F.max("e").alias("e"), F.min("l_returnflag").alias("r"))
        p, e, r = F.col("p"), F.col("e"), F.col("r")
        amounts = {"a": e, "b": F.when(p % 6 == 0, e + 10).otherwise(e), "c": F.when(p % 4 == 0, e + 20).otherwise(e)}
        flags = {"a": r, "b": F.when(p % 10 == 0, "X").otherwise(r), "c": F.lower(r)}

        def cell(vendor: str, field: str, value: Column, handwritten: Column) -> Column:
            made = F.struct(F.lit(vendor).alias("vendor"), F.lit(field).alias("field"), value.cast("string").alias("value"), handwritten.alias("handwritten"))
            return F.when(p % 8 != 0, made) if vendor == "c" else made

        cells = [cell(v, f, x, h) for v in "abc" for f, x, h in (("extended_amount", amounts[v], p % 29 == 0), ("flag", flags[v], F.lit(False)))]
        # one scan and one aggregation, whatever the readers
        rows = line.select("document_id", "row_index", F.explode(F.array(*cells)).alias("x"))
        return rows.filter("x is not null").select("document_id", "row_index", "x.*")


_LINE_KEY = "SELECT l_orderkey, l_linenumber, max(l_partkey) AS p, max(CAST(l_extendedprice AS DECIMAL(16,2))) AS e, min(l_returnflag) AS r FROM lineitem GROUP BY ALL"
#: DuckDB twins of the tables above.
VIEWS = {
    "party": "SELECT 'C' || c_custkey AS party_key, c_name AS canonical_name, 'customer' AS role, c_nationkey AS nation_key, c_mktsegment AS segment FROM customer UNION ALL SELECT 'S' || s_suppkey, s_name, 'supplier', s_nationkey, NULL FROM supplier",
    "selling_location": "SELECT 'L' || n_nationkey AS selling_location_key, n_name AS location_name, r_name AS territory_name FROM nation JOIN region ON n_regionkey = r_regionkey",
    "invoice_header": """SELECT 'I' || o_orderkey AS invoice_key, 'INV-' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS invoice_number, CAST(o_orderdate AS DATE) AS invoice_date,
 CAST(o_orderdate AS DATE) + 30 AS due_date, 'C' || o_custkey AS payer_party_key, 'S' || (o_orderkey % 10) AS biller_party_key,
 CASE o_orderkey % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'CAD' END AS currency_code, CAST(o_totalprice AS DECIMAL(16,2)) AS total_amount,
 CASE o_orderstatus WHEN 'O' THEN CAST(o_totalprice AS DECIMAL(16,2)) WHEN 'P' THEN CAST(round(CAST(CAST(o_totalprice AS DECIMAL(16,2)) AS DECIMAL(20,4)) * 0.5, 2) AS DECIMAL(16,2)) ELSE CAST(0 AS DECIMAL(16,2)) END AS amount_due,
 'L' || c_nationkey AS selling_location_key, 'D' || o_orderkey AS source_document_id, CASE WHEN o_orderkey % 11 = 0 THEN 'needs_review' ELSE 'clear' END AS review_status,
 CASE WHEN o_orderkey % 7 = 0 THEN '' WHEN o_orderkey % 13 <> 0 THEN o_orderpriority END AS priority, o_orderkey AS ordinal FROM orders LEFT JOIN customer ON c_custkey = o_custkey""",
    "invoice_line": """SELECT 'I' || l_orderkey AS invoice_key, 'D' || l_orderkey AS document_id, l_linenumber AS line_number, 'P' || l_partkey AS product_key,
 CASE WHEN l_partkey % 19 <> 0 THEN CAST(l_quantity AS DECIMAL(16,4)) END AS quantity, CAST(l_extendedprice / l_quantity AS DECIMAL(16,4)) AS unit_price,
 CAST(CAST(l_extendedprice AS DECIMAL(16,2)) + CASE WHEN l_partkey % 17 = 0 THEN 1 ELSE 0 END AS DECIMAL(16,2)) AS extended_amount, CAST(l_discount AS DECIMAL(5,4)) AS rate,
 CAST(l_shipdate AS DATE) AS ship_date, l_suppkey AS suppkey, l_partkey AS partkey FROM lineitem""",
    "shipment": "SELECT 'D' || l_orderkey AS source_document_id, CAST(l_shipdate AS DATE) AS ship_date, CASE WHEN l_partkey % 23 <> 0 THEN CAST(o_orderdate AS DATE) + 60 END AS committed_date, CAST(l_shipdate AS DATE) + CAST(l_partkey % 20 AS INTEGER) AS delivery_date FROM lineitem JOIN orders ON o_orderkey = l_orderkey",
    "attribution": "SELECT 'invoice_header' AS target_table, 'I' || o_orderkey AS target_key, CAST(CAST(o_totalprice AS DECIMAL(16,2)) - CAST(o_totalprice AS DECIMAL(16,2)) % 10 AS DECIMAL(16,2)) AS amount, o_orderkey % 10 = 1 AS is_failure, 'D' || o_orderkey AS source_document_id FROM orders WHERE o_orderkey % 5 <> 0",
    "payment": "SELECT CASE WHEN o_orderkey % 9 = 0 THEN 'UNKNOWN-' || o_orderkey ELSE 'INV-' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') END AS invoice_number, CAST(CAST(o_totalprice AS DECIMAL(16,2)) - CASE WHEN o_orderkey % 4 = 0 THEN 100 ELSE 0 END AS DECIMAL(16,2)) AS amount_applied, 'C' || o_custkey AS payer_party_key FROM orders WHERE o_orderstatus IN ('F', 'P')",
    "readings": f"""SELECT 'D' || l_orderkey AS document_id, l_linenumber AS row_index, vendor, field, value, handwritten FROM (
 SELECT *, 'a' AS vendor, 'extended_amount' AS field, CAST(e AS VARCHAR) AS value, p % 29 = 0 AS handwritten FROM ({_LINE_KEY})
 UNION ALL SELECT *, 'a', 'flag', r, false FROM ({_LINE_KEY})
 UNION ALL SELECT *, 'b', 'extended_amount', CAST(CASE WHEN p % 6 = 0 THEN e + 10 ELSE e END AS VARCHAR), p % 29 = 0 FROM ({_LINE_KEY})
 UNION ALL SELECT *, 'b', 'flag', CASE WHEN p % 10 = 0 THEN 'X' ELSE r END, false FROM ({_LINE_KEY})
 UNION ALL SELECT *, 'c', 'extended_amount', CAST(CASE WHEN p % 4 = 0 THEN e + 20 ELSE e END AS VARCHAR), p % 29 = 0 FROM ({_LINE_KEY}) WHERE p % 8 <> 0
 UNION ALL SELECT *, 'c', 'flag', lower(r), false FROM ({_LINE_KEY}) WHERE p % 8 <> 0)""",
}


def twin(body: str, *views: str) -> str:
    """Oracle SQL over some of the canonical tables; ``body`` may begin with further expressions after ``WITH``."""
    head = ", ".join(f"{v} AS ({VIEWS[v]})" for v in views)
    body = body.strip()
    return f"WITH {head}, {body[5:]}" if body.upper().startswith("WITH ") else f"WITH {head} {body}"
