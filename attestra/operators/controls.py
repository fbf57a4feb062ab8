"""Completeness controls: number gaps, calendar gaps, ledger variance, open items; and inferred ledgers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.values import loadable_date, loadable_month, parse_money

MIN_SERIES, MIN_MONTHS, MAX_GAP, MAX_SHARE = 5, 4, 500, 0.8


def split_number(c: Column) -> tuple[Column, Column, Column]:
    """(prefix, number, width) of an invoice number's last run of digits; nulls without one."""
    digits = F.regexp_extract(c, r"([0-9]+)$", 1)
    has = digits != ""
    return F.when(has, F.regexp_extract(c, r"^(.*?)[0-9]+$", 1)).otherwise(c), F.when(has, digits.try_cast("bigint")), F.when(has, F.length(digits))


def sequence_gaps(docs: DataFrame, vendor: str, number: str) -> tuple[DataFrame, DataFrame]:
    """(runs of missing numbers by (vendor, prefix), series left out with a reason)."""
    prefix, n, width = split_number(F.col(number))
    rows = docs.select(F.col(vendor).alias("vendor"), prefix.alias("prefix"), n.alias("n"), width.alias("width"))
    series = rows.filter("n is not null").groupBy("vendor", "prefix").agg(F.count(F.lit(1)).alias("documents"), F.countDistinct("n").alias("present"), F.min("n").alias("low"), F.max("n").alias("high"), F.max("width").alias("width"))
    span = F.col("high") - F.col("low") + 1
    series = series.withColumn("missing", span - F.col("present")).withColumn("likely_shared", (F.col("missing") > MAX_GAP) | (F.col("missing") > span * MAX_SHARE))
    after = F.lead("n").over(Window.partitionBy("vendor", "prefix").orderBy("n"))
    runs = rows.filter("n is not null").select("vendor", "prefix", "n").distinct().withColumn("next", after).filter("next > n + 1")
    runs = runs.select("vendor", "prefix", (F.col("n") + 1).alias("from_n"), (F.col("next") - 1).alias("to_n"))
    out = runs.join(series.filter(F.col("documents") >= MIN_SERIES), ["vendor", "prefix"]).withColumn("count", F.col("to_n") - F.col("from_n") + 1)
    short = series.filter(F.col("documents") < MIN_SERIES).select("vendor", "prefix", "documents", F.lit("series_below_minimum").alias("reason"))
    bare = rows.filter("n is null").groupBy("vendor", "prefix").agg(F.count(F.lit(1)).alias("documents")).withColumn("reason", F.lit("no_numeric_suffix"))
    return out.select("vendor", "prefix", "from_n", "to_n", "count", "present", "missing", "likely_shared"), short.unionByName(bare)


def upper_median(values: Column) -> Column:
    """The middle of the sorted list, the upper one of two."""
    return F.element_at(F.sort_array(values), (F.floor(F.size(values) / 2) + 1).cast("int"))


def calendar_gaps(docs: DataFrame, vendor: str, day: str) -> DataFrame:
    """Missing and thin months inside each vendor's active period; vendors of under four months are left out."""
    months = docs.filter(F.col(day).isNotNull()).groupBy(F.col(vendor).alias("vendor"), F.trunc(day, "month").alias("month")).agg(F.count(F.lit(1)).alias("n"))
    v = months.groupBy("vendor").agg(F.min("month").alias("low"), F.max("month").alias("high"), F.count(F.lit(1)).alias("observed"), upper_median(F.collect_list("n")).alias("median")).filter(F.col("observed") >= MIN_MONTHS)
    every = v.select("vendor", "median", F.explode(F.sequence("low", "high", F.expr("interval 1 month"))).alias("month"))
    seen = every.join(months, ["vendor", "month"], "left")
    kind = F.when(F.col("n").isNull(), "missing").when((F.col("median") >= 4) & (F.col("n") <= F.greatest(F.lit(1.0), F.col("median") * 0.25)), "thin")
    return seen.withColumn("finding", kind).filter("finding is not null").select("vendor", F.date_format("month", "yyyy-MM").alias("month"), "finding", F.coalesce("n", F.lit(0)).alias("documents"), "median")


def ledger_variance(docs: DataFrame, ledger: DataFrame, tolerance_pct: float, rejected: bool = False) -> DataFrame:
    """(period, vendor) of both sides: variance, share, verdict; a rejected ledger row voids every within-tolerance verdict."""
    e = docs.groupBy("period", "vendor").agg(F.sum("amount").cast("decimal(38,2)").alias("extracted"))
    g = ledger.groupBy("period", "vendor").agg(F.sum("amount").cast("decimal(38,2)").alias("ledger"))
    zero = F.lit(0).cast("decimal(38,2)")
    j = e.join(g, ["period", "vendor"], "full").select("period", "vendor", F.coalesce("extracted", zero).alias("extracted"), F.coalesce("ledger", zero).alias("ledger"))
    pct = F.when(F.col("ledger") != 0, F.round((F.col("extracted") - F.col("ledger")).cast("double") / F.col("ledger").cast("double") * 100, 2))
    within = F.lit(not rejected) & (F.abs("variance_pct") <= tolerance_pct)
    out = j.withColumn("variance", F.col("extracted") - F.col("ledger")).withColumn("variance_pct", pct)
    return out.withColumn("verdict", F.when(F.col("variance_pct").isNull(), "no_ledger_value").when(within, "within_tolerance").otherwise("variance"))


def open_item_closure(invoices: DataFrame, payments: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(each invoice: applied, balance, closed / partial / unresolved; payments that meet no invoice or several)."""
    many = invoices.groupBy("invoice_number").agg(F.count(F.lit(1)).alias("candidates"))
    paid = payments.join(many, "invoice_number", "left").withColumn("candidates", F.coalesce("candidates", F.lit(0)))
    good = paid.filter("candidates = 1").groupBy("invoice_number").agg(F.sum("amount_applied").cast("decimal(38,2)").alias("applied"))
    out = invoices.join(good, "invoice_number", "left").withColumn("applied", F.coalesce("applied", F.lit(0).cast("decimal(38,2)")))
    balance = F.col("total_amount") - F.col("applied")
    status = F.when(F.col("applied") == 0, "unresolved").when(F.abs(balance) <= 0.01, "closed").when(balance > 0, "partial").otherwise("overpaid")
    bad = paid.filter("candidates <> 1").withColumn("reason", F.when(F.col("candidates") == 0, "no_invoice").otherwise("ambiguous"))
    return out.withColumn("balance", balance).withColumn("closure", status), bad


# The fields that each part of a document event is read from, first present wins.
EVENT_FIELDS = {
    "vendor": ("seller_name", "vendor_name", "carrier_name", "payee_name", "brand_name"),
    "invoice_number": ("invoice_number", "pro_number"),
    "date": ("invoice_date", "bill_date", "memo_date", "document_date", "statement_date", "period_end"),
    "credits": ("credit_amount", "credits_applied"),
    "explicit_status": ("payment_status", "document_status", "approval_status"),
}


def document_events(headers: DataFrame) -> DataFrame:
    """One event a header: vendor, number, date, month, credits and status, each by its chain of fields; blanks count as absent.

    Fields that ``headers`` lacks are passed over.  Amounts are read whole or as zero; a date that names no day
    gives its month if it names one.
    """

    def chain(part: str) -> Column:
        have = [F.nullif(F.trim(F.col(f).cast("string")), F.lit("")) for f in EVENT_FIELDS[part] if f in headers.columns]
        return F.coalesce(*have) if have else F.lit(None).cast("string")

    date = chain("date")
    month = F.coalesce(F.date_format(loadable_date(date), "yyyy-MM"), F.nullif(loadable_month(date), F.lit("")))
    amount = F.coalesce(parse_money(chain("credits")).cast("decimal(38,2)"), F.lit(0).cast("decimal(38,2)"))
    return headers.select("document_id", F.coalesce(chain("vendor"), F.lit("UNKNOWN")).alias("vendor"), chain("invoice_number").alias("invoice_number"), date.alias("date"), month.alias("month"), F.abs(amount).alias("credits"), F.lower(F.coalesce(chain("explicit_status"), F.lit(""))).alias("explicit_status"))
