"""Payments against invoices: nested applications, narrowing by vendor and currency, closure, the largest open items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import parse_money

# Names that a party and an amount go by, first filled one first; statuses that settle an invoice; kinds that can be open.
PARTY = ("vendor", "vendor_name", "payee")
AMOUNT = ("amount_applied", "total_paid", "amount")
SETTLED = ("paid", "written_off", "credited", "open", "disputed")
KINDS = ("commercial_invoice", "carrier_freight_bill", "invoice", "unknown")
MONEY = "decimal(38,2)"
LARGEST = 50


def _text(c: Column) -> Column:
    return F.nullif(F.trim(c.cast("string")), F.lit(""))


def _chain(of, have: list[str], names: tuple[str, ...]) -> Column:
    found = [_text(of(n)) for n in names if n in have]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def read_payments(spark: SparkSession, path: str) -> DataFrame:
    """A payment export: CSV with headings in any case and with blanks, or JSON (a list, an object with ``payments``, or lines of objects).

    CSV columns are texts.  A name that occurs twice after lower-casing keeps its first place; the later ones get their place as a suffix.
    """
    if path.lower().endswith(".json"):
        df = spark.read.option("multiLine", True).json(path)
        if "payments" in df.columns and isinstance(df.schema["payments"].dataType, T.ArrayType):
            df = df.select(F.explode("payments").alias("p")).select("p.*")
        return df
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    seen, names = set(), []
    for i, c in enumerate(df.columns):
        n = "_".join(c.strip().lower().split())
        names.append(n if n not in seen else f"{n}_{i}")
        seen.add(names[-1])
    return df.toDF(*names)


def applications(payments: DataFrame) -> DataFrame:
    """One row an application: (invoice_number, vendor, currency, amount, reason).

    A payment with entries under ``applied`` (else ``applications``) gives a row each, which takes vendor and currency from
    the payment where it has none; another is its own application.  Columns that the export lacks count as blank.  Vendors lose case,
    currencies are in capitals, an amount that is none counts zero.  A row without a number cannot be keyed: it keeps its
    amount and has ``reason`` payment_row_has_no_invoice_number.
    """
    nested = [(n, payments.schema[n].dataType.elementType) for n in ("applied", "applications") if n in payments.columns and isinstance(payments.schema[n].dataType, T.ArrayType) and isinstance(payments.schema[n].dataType.elementType, T.StructType)]
    parts = ("invoice_number", "vendor", "currency", "amount")

    def entry(of, have: list[str]) -> Column:
        values = (_chain(of, have, ("invoice_number",)), _chain(of, have, PARTY), _chain(of, have, ("currency",)), _chain(of, have, AMOUNT))
        return F.struct(*(v.alias(n) for n, v in zip(parts, values)))

    own = entry(F.col, payments.columns)
    rows = F.array(own)
    for name, kind in reversed(nested):
        have = list(kind.names)
        under = F.transform(F.filter(name, lambda x: x.isNotNull()), lambda x: entry(lambda n: x[n], have))
        rows = F.when(F.size(F.coalesce(F.col(name), F.array().cast(payments.schema[name].dataType))) > 0, under).otherwise(rows)
    out = payments.select(own.alias("p"), F.explode(rows).alias("x"))
    number = F.col("x.invoice_number")
    vendor, currency = F.coalesce("x.vendor", "p.vendor"), F.coalesce("x.currency", "p.currency")
    amount = F.coalesce(parse_money(F.col("x.amount")).cast(MONEY), F.lit(0).cast(MONEY))
    return out.select(number.alias("invoice_number"), F.lower(vendor).alias("vendor"), F.upper(currency).alias("currency"), amount.alias("amount"), F.when(number.isNull(), "payment_row_has_no_invoice_number").alias("reason"))


def close_open_items(events: DataFrame, applied: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(each invoice with applied, balance and closure; applications that meet no invoice or several).

    ``events`` is (document_id, doc_type, vendor, invoice_number, currency, amount, credits, explicit_status), ``applied`` as
    :func:`applications` gives it.  An application counts where exactly one document of its number is left after its vendor and its
    currency, each only if it names one; two documents of one vendor, number and currency are two.  Closed by an explicit
    status, or when credits and payments meet the amount within a cent; partial when they fall short; else unresolved.  Only kinds
    that can be open and amounts above zero are examined.  Applications are summed per key before any join, so a number
    paid very often costs one row a vendor and currency.
    """
    key = ("invoice_number", "vendor", "currency")
    norm = {"invoice_number": _text(F.col("invoice_number")), "vendor": F.lower(F.coalesce(_text(F.col("vendor")), F.lit(""))), "currency": F.upper(F.coalesce(_text(F.col("currency")), F.lit("")))}
    docs = events.select("document_id", "doc_type", *(c.alias(n) for n, c in norm.items()), F.col("amount").cast(MONEY).alias("amount"), F.coalesce(F.col("credits").cast(MONEY), F.lit(0).cast(MONEY)).alias("credits"), F.lower(F.coalesce("explicit_status", F.lit(""))).alias("status"))
    owners = docs.filter("invoice_number is not null").groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    asked = applied.filter("reason is null").groupBy(*key).agg(F.sum("amount").cast(MONEY).alias("paid"), F.count(F.lit(1)).alias("applications"))
    o = owners.select(F.col("invoice_number"), F.col("vendor").alias("o_vendor"), F.col("currency").alias("o_currency"), "n")
    fits = (F.col("vendor").isNull() | (F.col("vendor") == F.col("o_vendor"))) & (F.col("currency").isNull() | (F.col("currency") == F.col("o_currency")))
    met = asked.join(o, "invoice_number", "left").groupBy(*key, "paid", "applications")
    met = met.agg(F.coalesce(F.sum(F.when(fits, F.col("n"))), F.lit(0)).alias("candidates"), F.min(F.when(fits, F.struct("o_vendor", "o_currency"))).alias("to"))
    good = met.filter("candidates = 1").groupBy("invoice_number", F.col("to.o_vendor").alias("vendor"), F.col("to.o_currency").alias("currency")).agg(F.sum("paid").cast(MONEY).alias("applied"))
    zero = F.lit(0).cast(MONEY)
    out = docs.filter(F.col("doc_type").isin(*KINDS) & (F.col("amount") > 0)).join(good, list(key), "left").withColumn("applied", F.coalesce("applied", zero) + F.col("credits"))
    balance = F.col("amount") - F.col("applied")
    closure = F.when(F.col("status").isin(*SETTLED) | (F.abs(balance) <= 0.01), "closed").when((F.col("applied") > 0) & (F.col("applied") < F.col("amount")), "partial").otherwise("unresolved")
    bad = met.filter("candidates <> 1").select(*key, "paid", "applications", "candidates")
    unkeyed = applied.filter("reason is not null").groupBy(*key).agg(F.sum("amount").cast(MONEY).alias("paid"), F.count(F.lit(1)).alias("applications")).withColumn("candidates", F.lit(0).cast("long"))
    reason = F.when(F.col("invoice_number").isNull(), "payment_row_has_no_invoice_number").when(F.col("candidates") == 0, "no_invoice").otherwise("ambiguous")
    return out.withColumn("balance", balance).withColumn("closure", closure), bad.unionByName(unkeyed).withColumn("reason", reason)


def largest(closed: DataFrame, closure: str, shown: int = LARGEST) -> DataFrame:
    """The ``shown`` largest balances of one closure, ties by document, each beside the true count and sum of all."""
    rows = closed.filter(F.col("closure") == closure)
    every = rows.agg(F.count(F.lit(1)).alias("all_items"), F.coalesce(F.sum("balance"), F.lit(0)).cast(MONEY).alias("all_balance"))
    top = rows.orderBy(F.desc("balance"), "document_id").limit(shown)
    return top.select("document_id", "vendor", "invoice_number", "amount", "applied", "balance").crossJoin(F.broadcast(every))  # one row
