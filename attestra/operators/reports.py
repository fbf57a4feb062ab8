"""The saved reports, the account card and the sales slicer over canonical tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOTAL = "decimal(38,2)"
UNASSIGNED = "unassigned"


def in_range(c: Column, start: str | None, end: str | None) -> Column:
    """Inclusive; a null date passes only without bounds."""
    if start is None and end is None:
        return F.lit(True)
    out = c.isNotNull()
    if start:
        out = out & (c >= F.lit(start).cast("date"))
    return out & (c <= F.lit(end).cast("date")) if end else out


def invoice_register(invoices: DataFrame, parties: DataFrame, lines: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Invoices with payer, biller and line count."""
    names = parties.select("party_key", "canonical_name")
    payer = names.toDF("payer_party_key", "payer")
    biller = names.toDF("biller_party_key", "biller")
    counts = lines.groupBy("invoice_key").agg(F.count(F.lit(1)).alias("line_count"))
    rows = invoices.filter(in_range(F.col("invoice_date"), start, end)).join(payer, "payer_party_key", "left").join(biller, "biller_party_key", "left").join(counts, "invoice_key", "left")
    return rows.withColumn("line_count", F.coalesce("line_count", F.lit(0)))


def aging_bucket(days: Column) -> Column:
    return F.when(days <= 0, "current").when(days <= 30, "1-30").when(days <= 60, "31-60").when(days <= 90, "61-90").otherwise("90+")


def receivables_aging(invoices: DataFrame, as_of: str) -> DataFrame:
    """Open balances on a day; without a due date nothing is overdue."""
    day = F.lit(as_of).cast("date")
    open_ = invoices.filter((F.col("invoice_date").isNull() | (F.col("invoice_date") <= day)) & (F.col("amount_due") > 0))
    days = F.coalesce(F.datediff(day, "due_date"), F.lit(0))
    return open_.withColumn("days_past_due", days).withColumn("aging_bucket", aging_bucket(days))


def account_directory(parties: DataFrame, roles: DataFrame) -> DataFrame:
    """Each party with its sorted roles."""
    r = roles.filter("role is not null").groupBy("party_key").agg(F.sort_array(F.collect_set("role")).alias("roles"))
    return parties.join(r, "party_key", "left").withColumn("roles", F.coalesce("roles", F.array().cast("array<string>")))


def sales_by(invoices: DataFrame, key: str, label: str | None = None) -> DataFrame:
    """(key or unassigned, currency): invoices, value, balance; the label is that of the smallest ordinal."""
    k = F.coalesce(F.nullif(F.col(key), F.lit("")), F.lit(UNASSIGNED)).alias("group_key")
    extra = [F.min_by(label, "ordinal").alias("label")] if label else []
    return invoices.groupBy(k, "currency_code").agg(*extra, F.count(F.lit(1)).alias("invoice_count"), F.sum("total_amount").cast(TOTAL).alias("total_value"), F.sum("amount_due").cast(TOTAL).alias("balance"))


def attribution_coverage(invoices: DataFrame, attributions: DataFrame) -> DataFrame:
    """By the invoice's currency: invoice value, attributed value of rows that are no failures, and their share."""
    ccy = F.coalesce(F.nullif(F.col("currency_code"), F.lit("")), F.lit("Unassigned")).alias("currency_code")
    value = invoices.groupBy(ccy).agg(F.count(F.lit(1)).alias("invoice_records"), F.sum("total_amount").cast(TOTAL).alias("invoice_value"))
    good = attributions.filter((F.col("target_table") == "invoice_header") & ~F.coalesce("is_failure", F.lit(False)))
    got = good.join(invoices.select(F.col("invoice_key").alias("target_key"), "currency_code"), "target_key").groupBy(ccy).agg(F.count(F.lit(1)).alias("attribution_records"), F.sum("amount").cast(TOTAL).alias("attributed_value"), F.countDistinct("source_document_id").alias("documents"))
    out = value.join(got, "currency_code", "left").na.fill(0, ["attribution_records", "documents"]).withColumn("attributed_value", F.coalesce("attributed_value", F.lit(0).cast(TOTAL)))
    share = F.when(F.col("invoice_value") != 0, F.col("attributed_value").cast("double") / F.col("invoice_value").cast("double") * 100).otherwise(0.0)
    return out.withColumn("unattributed_value", F.col("invoice_value") - F.col("attributed_value")).withColumn("coverage_percent", share)


def delivery_status(delivered: Column, committed: Column) -> Column:
    return F.when(delivered.isNull() | committed.isNull(), "not_measurable").when(delivered <= committed, "on_time").otherwise("late")


def shipment_performance(shipments: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    return shipments.filter(in_range(F.col("ship_date"), start, end)).withColumn("delivery_status", delivery_status(F.col("delivery_date"), F.col("committed_date")))


def account_card(parties: DataFrame, invoices: DataFrame, payments: DataFrame) -> DataFrame:
    """By party and currency: invoices it pays or bills, and payments.  Two equi-joins in a union replace the join on either key."""
    touch = invoices.select(F.col("payer_party_key").alias("party_key"), "invoice_key", "currency_code", "total_amount", "amount_due").unionByName(invoices.select(F.col("biller_party_key").alias("party_key"), "invoice_key", "currency_code", "total_amount", "amount_due"))
    totals = touch.distinct().groupBy("party_key", "currency_code").agg(F.count(F.lit(1)).alias("invoices"), F.sum("total_amount").cast(TOTAL).alias("total_value"), F.sum("amount_due").cast(TOTAL).alias("balance"))
    paid = payments.groupBy(F.col("payer_party_key").alias("party_key")).agg(F.sum("amount_applied").cast(TOTAL).alias("paid"))
    return parties.join(totals, "party_key").join(paid, "party_key", "left")


def sales_slice(invoices: DataFrame, locations: DataFrame, dimensions: dict[str, Column], start: str | None = None, end: str | None = None, low: float | None = None, high: float | None = None) -> DataFrame:
    """Up to three dimensions and the currency: count, sum, average and the sorted distinct documents."""
    if len(dimensions) > 3:
        raise ValueError("at most 3 dimensions")
    if low is not None and high is not None and high < low:
        raise ValueError("the upper amount is under the lower")
    rows = invoices.join(locations, "selling_location_key", "left").filter(in_range(F.col("invoice_date"), start, end))
    if low is not None:
        rows = rows.filter(F.col("total_amount") >= low)
    if high is not None:
        rows = rows.filter(F.col("total_amount") <= high)
    keys = [F.coalesce(F.nullif(c.cast("string"), F.lit("")), F.lit("Unassigned")).alias(n) for n, c in dimensions.items()]
    return rows.groupBy(*keys, "currency_code").agg(F.count(F.lit(1)).alias("invoices"), F.sum("total_amount").cast(TOTAL).alias("total_value"), F.round(F.avg("total_amount").cast("double"), 6).alias("average_value"), F.sort_array(F.collect_set("source_document_id")).alias("documents"))
