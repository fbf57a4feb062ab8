"""Ranked attribution of documents to jobs: printed key, lines, cross-reference, inherited, and fuzzy."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANKS = {1: "printed_key", 2: "secondary_key", 3: "po_cross_reference", 4: "inherited_shipment", 5: "inherited_invoice", 6: "fuzzy"}
DAYS, SHARE = 45, 0.02


def explicit_key(fields: list[str], pattern: str) -> tuple[Column, Column]:
    """(valid key, rejected text) of the first populated field."""
    first = F.coalesce(*(F.nullif(F.trim(F.col(f).cast("string")), F.lit("")) for f in fields))
    return F.when(first.rlike(pattern), first), F.when(~first.rlike(pattern), first)


def cross_reference(docs: DataFrame, master: DataFrame) -> DataFrame:
    """(document_id, job) by purchase order; of several master rows for one order the last in ``ordinal`` wins."""
    last = master.filter("po_number is not null").groupBy("po_number").agg(F.max_by("job", "ordinal").alias("job"))
    return docs.join(last, "po_number").select("document_id", "job")


def _near(docs: DataFrame, master: DataFrame, days: int, share: float) -> DataFrame:
    """(document_id, k, job, jobs): how many rows of the master fit a document, of which jobs (ten of them)."""
    who = F.lower(F.trim(F.col("customer").cast("string")))
    m = master.filter("day is not null and amount <> 0").select(who.alias("who"), "job", F.col("day").alias("m_day"), F.abs("amount").alias("m_amount"))
    mine = docs.filter("day is not null and amount > 0").select("document_id", "day", "amount", who.alias("who"))
    near = (F.abs(F.datediff("day", "m_day")) <= days) & (F.abs(F.col("m_amount") - F.col("amount")) <= F.col("m_amount") * share)
    hit = mine.join(m, "who").filter(near)
    per = hit.groupBy("document_id", "job").agg(F.count(F.lit(1)).alias("n"))
    place = F.row_number().over(Window.partitionBy("document_id").orderBy("job"))  # ten jobs are gathered, however many fit
    return per.withColumn("place", place).groupBy("document_id").agg(F.sum("n").alias("k"), F.min("job").alias("job"), F.sort_array(F.collect_list(F.when(F.col("place") <= 10, F.col("job")))).alias("jobs"))


def fuzzy(docs: DataFrame, master: DataFrame, days: int = DAYS, share: float = SHARE) -> DataFrame:
    """(document_id, job): same customer, dates within ``days``, amounts within ``share``; only a unique candidate counts.

    Candidates are rows of the master, so two rows of one job are two.  The customer is
    the join key, without case; date and amount bound the matches inside it.  A document without a
    positive amount and a reference without an amount match nothing.
    """
    return _near(docs, master, days, share).filter("k = 1").select("document_id", "job")


def fuzzy_ambiguous(docs: DataFrame, master: DataFrame, days: int = DAYS, share: float = SHARE) -> DataFrame:
    """(document_id, candidates, jobs) of documents that several rows of the master fit: work for a person."""
    return _near(docs, master, days, share).filter("k > 1").select("document_id", F.col("k").alias("candidates"), "jobs")


WEAKEST_DONOR = 5


def inherit(docs: DataFrame, resolved: DataFrame, shipment: list[str], invoice: list[str], number: str = "invoice_number", order: str = "ordinal") -> DataFrame:
    """(document_id, rank, job, donor) of open documents that share a reference with a resolved one.

    Rank 4 goes by shipment references, in their order, to the first document in ``order`` with that
    reference and a job; rank 5 by invoice references to the last document of that
    number, whatever it is.  ``resolved`` (document_id, rank, job) of rank 6 and weaker never
    gives a job on, and no document gives one to itself.
    """
    good = resolved.filter(F.col("job").isNotNull() & (F.col("rank") <= WEAKEST_DONOR)).select("document_id", "job")
    open_ = docs.join(resolved.filter("job is not null").select("document_id"), "document_id", "left_anti")

    def long(d: DataFrame, fields: list[str], *more: str) -> DataFrame:
        refs = F.array(*(F.struct(F.lit(i).alias("kind"), F.trim(F.col(r).cast("string")).alias("ref")) for i, r in enumerate(fields)))
        return d.select("document_id", *more, F.explode(refs).alias("x")).select("document_id", *more, "x.*").filter("ref <> ''")

    # a reference keeps one donor, so a common one is one row; a kind of shipment reference meets the same kind of any document
    given = long(docs.join(good, "document_id"), shipment, "job", order).groupBy("ref").agg(F.min(F.struct(order, "document_id", "job")).alias("d"))
    four = long(open_, shipment).join(given, "ref").select("document_id", F.lit(4).alias("rank"), "kind", F.col("d.document_id").alias("donor"), F.col("d.job").alias("job"))
    last = docs.filter(F.trim(F.col(number).cast("string")) != "").groupBy(F.trim(F.col(number).cast("string")).alias("ref")).agg(F.max_by("document_id", order).alias("donor"))
    five = long(open_, invoice).join(last, "ref").filter("donor <> document_id").join(good.withColumnRenamed("document_id", "donor"), "donor").select("document_id", F.lit(5).alias("rank"), "kind", "donor", "job")
    best = four.unionByName(five).groupBy("document_id").agg(F.min(F.struct("rank", "kind", "donor", "job")).alias("b"))
    return best.select("document_id", "b.rank", "b.job", "b.donor")


def credit_by_line(lines: DataFrame, keys: list[str], pattern: str, amounts: list[str]) -> DataFrame:
    """(document_id, line, key_field, key, amount): each money line of a document credited to the key it prints.

    A document gives credits only if it has a money line, and every money line prints a valid key.
    """
    amount = F.coalesce(*(F.col(a) for a in amounts))
    clean = [F.nullif(F.trim(F.col(k).cast("string")), F.lit("")) for k in keys]
    field = F.coalesce(*(F.when(c.isNotNull(), k) for k, c in zip(keys, clean)))
    money = lines.withColumns({"amount": amount, "key": F.coalesce(*clean), "key_field": field}).filter("amount <> 0")
    bad = money.groupBy("document_id").agg(F.bool_and(F.coalesce(F.col("key").rlike(pattern), F.lit(False))).alias("all_valid")).filter("all_valid")
    return money.join(bad, "document_id", "left_semi").select("document_id", "line", "key_field", "key", F.round("amount", 2).alias("amount"))


# Reasons that settle a document without a job.
DISPOSITIONS = ("internal_transfer", "rebate", "rebilled_freight", "pre_system", "closed_job_credit", "overhead", "payment_record", "blank_page")
LINE_CREDIT = "credited_by_line"


def register(attributed: DataFrame, dispositions: DataFrame, credits: DataFrame | None = None, settled: tuple[str, ...] = DISPOSITIONS) -> DataFrame:
    """Documents (document_id, amount, job) without a job, each with its reason and whether it is a failure."""
    open_ = attributed.filter("job is null").join(dispositions.select("document_id", "reason_code"), "document_id", "left")
    code = F.coalesce("reason_code", F.lit("unresolved"))
    if credits is not None:
        open_ = open_.join(credits.select("document_id").distinct().withColumn("credited", F.lit(True)), "document_id", "left")
        code = F.when((code == "unresolved") & F.coalesce("credited", F.lit(False)), LINE_CREDIT).otherwise(code)
    return open_.select("document_id", "amount", code.alias("reason_code"), (~code.isin(LINE_CREDIT, *settled)).alias("is_failure"))


def gate(attributed: DataFrame, registered: DataFrame) -> DataFrame:
    """One row: documents and value in all, attributed, disposed of and failed; the gate is open without a failure."""
    a = attributed.agg(F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum("amount"), F.lit(0)).alias("total_value"), F.count("job").alias("attributed"), F.coalesce(F.sum(F.when(F.col("job").isNotNull(), F.col("amount"))), F.lit(0)).alias("attributed_value"))
    r = registered.agg(F.sum(F.when(F.col("is_failure"), 1).otherwise(0)).alias("failures"), F.coalesce(F.sum(F.when(F.col("is_failure"), F.col("amount"))), F.lit(0)).alias("failure_value"), F.coalesce(F.sum(F.when(~F.col("is_failure"), F.col("amount"))), F.lit(0)).alias("disposed_value"))
    return a.crossJoin(r).withColumn("gate", F.when(F.coalesce("failures", F.lit(0)) > 0, "closed").otherwise("open"))  # one row by one


def ranked(docs: DataFrame, methods: list[tuple[int, DataFrame]]) -> DataFrame:
    """Each document with the job of its lowest rank."""
    rows = reduce(lambda a, b: a.unionByName(b), (m.select("document_id", F.lit(r).alias("rank"), "job") for r, m in methods))
    best = rows.groupBy("document_id").agg(F.min(F.struct("rank", "job")).alias("b"))
    names = F.create_map(*(F.lit(x) for kv in RANKS.items() for x in kv))
    return docs.join(best, "document_id", "left").select(*docs.columns, F.col("b.rank").alias("rank"), F.col("b.job").alias("job"), F.coalesce(names[F.col("b.rank")], F.lit("unresolved")).alias("method"))


# Fields that state where a sale was made, where goods left, where the customer sits and where goods went.
SELLING = ("warehouse_location", "branch", "office", "selling_location")
SHIP_FROM = ("origin_city", "origin_address", "ship_from_city")
CUSTOMER = ("buyer_address", "bill_to_address", "buyer_city", "bill_to_city")
DESTINATION = ("destination_city", "destination_address", "ship_to_address", "ship_to_city")
SALESPERSON = ("sales_representative_name", "salesperson")
KEY_PREFIX = "^([A-Za-z]{2,4})[-_]"


def selling_location(docs: DataFrame, master: DataFrame) -> DataFrame:
    """(document_id, selling_location, method, ship_from, customer_location, destination): every reading of a place that a document gives.

    ``docs`` has document_id, ack_number (its attributed key) and any of the fields above; an absent column counts as empty.
    In order: a field that states it, the letterhead's city, the key's row of ``master`` (ack_number, ordinal,
    selling_location; the last row of a key wins), the letters before the key's first hyphen.  A salesperson alone needs a
    territory table.
    """
    first = lambda names: F.coalesce(*(F.nullif(F.col(n).cast("string"), F.lit("")) for n in names if n in docs.columns), F.lit(None).cast("string"))
    last = master.filter("ack_number is not null").groupBy("ack_number").agg(F.max_by(F.coalesce("selling_location", F.lit("")), "ordinal").alias("_m"))
    stated, head, key = first(SELLING), first(("letterhead_city",)), first(("ack_number",))
    table, prefix = F.nullif(F.col("_m"), F.lit("")), F.nullif(F.upper(F.regexp_extract(key, KEY_PREFIX, 1)), F.lit(""))
    place = F.coalesce(F.trim(stated), F.trim(head), table, prefix)
    method = F.when(stated.isNotNull(), "explicit_field").when(head.isNotNull(), "letterhead").when(table.isNotNull(), "reference_table_via_ack").when(prefix.isNotNull(), "ack_prefix_inferred")
    method = method.when(first(SALESPERSON).isNotNull(), "salesperson_needs_territory_table").otherwise("unresolved")
    out = docs.join(last, "ack_number", "left")
    return out.select("document_id", place.alias("selling_location"), method.alias("method"), first(SHIP_FROM).alias("ship_from"), first(CUSTOMER).alias("customer_location"), first(DESTINATION).alias("destination"))


def shared_key_fill(rows: DataFrame, maker: str, key: str, party: str) -> DataFrame:
    """Rows without a party whose (maker, key) names exactly one party elsewhere."""
    one = rows.filter(F.col(party).isNotNull()).groupBy(maker, key).agg(F.countDistinct(party).alias("k"), F.min(party).alias("filled")).filter("k = 1").drop("k")
    return rows.filter(F.col(party).isNull()).join(one, [maker, key])


def inferred_ledger(docs: DataFrame) -> DataFrame:
    """Month by vendor: amount and documents."""
    return docs.groupBy(F.date_format("day", "yyyy-MM").alias("period"), "vendor").agg(F.sum("amount").cast("decimal(38,2)").alias("amount"), F.count(F.lit(1)).alias("documents"))
