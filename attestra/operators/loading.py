"""What goes to a loader: documents of a manifest, ordered plans with checksums, typing gaps, implausible years, JSON leaves."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.snapshot import row_hash

IMPLAUSIBLE_YEAR = 1000


def manifest_documents(pages: DataFrame) -> DataFrame:
    """Retained pages as documents: (document_id, source_file, source_sha256, source_page_range, page_count, ...).

    pages (document_id, page_id, ordinal, source_file, source_sha256, source_page_range); a page without a
    document is its own.  What a document says of itself is what its first page says.
    """
    blank = lambda c: F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))
    own = pages.withColumn("document_id", F.coalesce(blank("document_id"), blank("page_id")))
    first = lambda c: F.min_by(c, "ordinal").alias(c)
    ranges = F.sort_array(F.collect_list(F.when(blank("source_page_range").isNotNull(), F.struct("ordinal", blank("source_page_range").alias("r")))))
    return own.filter("document_id is not null").groupBy("document_id").agg(first("source_file"), first("source_sha256"), F.array_join(F.transform(ranges, lambda x: x["r"]), ",").alias("source_page_range"), F.count(F.lit(1)).alias("page_count"))


def export_withheld(documents: DataFrame, retained: DataFrame) -> DataFrame:
    """(document_id, reason) of documents that the manifest and the records do not both hold."""
    a, b = documents.select("document_id", F.lit(True).alias("in_manifest")), retained.select("document_id", F.lit(True).alias("in_records"))
    out = a.join(b, "document_id", "full")
    reason = F.when(F.col("in_manifest").isNull(), "no_manifest_page").when(F.col("in_records").isNull(), "no_record")
    return out.select("document_id", reason.alias("reason")).filter("reason is not null")


def load_plan(tables: dict[str, DataFrame], order: list[str], keys: dict[str, list[str]]) -> DataFrame:
    """(step, table, records, checksum, keys, finding) in load order; a table of no rows has a step as well.

    The checksum sums the hashes of the rows, so it does not hang on their order.  A plan of no rows says so.
    """
    unknown = sorted(set(tables) - set(order))
    if unknown:
        raise ValueError(f"tables with no place in the load order: {unknown}")
    steps = []
    for i, name in enumerate(order, 1):
        if name not in tables:
            continue
        hashed = tables[name].select(F.conv(F.substring(row_hash(tables[name].columns), 1, 12), 16, 10).cast("decimal(38,0)").alias("h"))
        steps.append(hashed.agg(F.count(F.lit(1)).alias("records"), F.coalesce(F.sum("h"), F.lit(0)).cast("string").alias("checksum")).select(F.lit(i).alias("step"), F.lit(name).alias("table"), "records", "checksum", F.lit(",".join(keys[name])).alias("keys")))
    plan = reduce(DataFrame.unionByName, steps)
    total = plan.agg(F.sum("records").alias("total"))
    return plan.crossJoin(total).select("*", F.when(F.col("total") == 0, "plan_orders_no_rows").alias("finding")).drop("total")  # one row of a total


def export_summary(tables: dict[str, DataFrame], order: list[str], review: str = "review_status") -> DataFrame:
    """(table, records, withheld, empty) in load order, and last the totals as ``all``: rows that are clear to export, and rows that are not.

    A table with a ``review`` column exports its clear rows alone, a null status is not clear; another exports all.  Each table is
    counted in one scan of that column.
    """
    counts = []
    for i, name in enumerate(n for n in order if n in tables):
        df = tables[name]
        clear = F.coalesce(F.col(review) == "clear", F.lit(False)) if review in df.columns else F.lit(True)
        counts.append(df.agg(F.count_if(clear).alias("records"), F.count_if(~clear).alias("withheld")).select(F.lit(i).alias("at"), F.lit(name).alias("table"), "records", "withheld"))
    rows = reduce(DataFrame.unionByName, counts)
    total = rows.agg((F.max("at") + 1).alias("at"), F.lit("all").alias("table"), F.sum("records").alias("records"), F.sum("withheld").alias("withheld"))
    return rows.unionByName(total).orderBy("at").select("table", "records", "withheld", (F.col("records") == 0).alias("empty"))


def untyped_columns(rows: DataFrame, columns: list[str], suffix: str, kind: str) -> DataFrame:
    """(column, rows, kind, reason) of columns that hold text and have no typed companion beside them."""
    bare = [c for c in columns if c in rows.columns and f"{c}{suffix}" not in rows.columns]
    if not bare:
        return rows.sparkSession.createDataFrame([], "column string, rows long, kind string, reason string")
    filled = rows.agg(*(F.count(F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))).alias(c) for c in bare))
    return filled.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("rows")) for c in bare))).alias("x")).select("x.*", F.lit(kind).alias("kind"), F.lit("no_typed_companion").alias("reason")).filter("rows > 0")


def year_issues(rows: DataFrame, key: list[str], suffixes: tuple[str, ...] = ("__iso", "__month")) -> DataFrame:
    """(key, column, value, reading) of typed dates and months whose year no document was written in."""
    typed = [c for c in rows.columns if c.endswith(suffixes)]
    base = {c: next(c[: -len(s)] for s in suffixes if c.endswith(s)) for c in typed}
    cells = F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"), (F.col(base[c]).cast("string") if base[c] in rows.columns else F.lit(None).cast("string")).alias("reading")) for c in typed))
    long = rows.select(*key, F.explode(cells).alias("x")).select(*key, "x.*")
    year = F.regexp_extract(F.col("value"), r"^([0-9]{4})-[0-9]{2}(?:-[0-9]{2})?$", 1).try_cast("int")
    return long.filter(year < IMPLAUSIBLE_YEAR)


def union_first(frames: list[DataFrame], key: list[str]) -> DataFrame:
    """Rows of several tables, one a key: that of the earliest table that has it, of several there the smallest."""
    rows = reduce(DataFrame.unionByName, (f.withColumn("_source", F.lit(i)) for i, f in enumerate(frames)))
    rest = [c for c in frames[0].columns if c not in key]
    first = rows.groupBy(*key).agg(F.min(F.struct("_source", *rest)).alias("_f"))
    return first.select(*key, *(F.col(f"_f.{c}").alias(c) for c in rest))


def json_leaves(docs: DataFrame, key: str, text: str, depth: int = 64) -> DataFrame:
    """(key, pointer, value) of every leaf of JSON text, as RFC 6901 pointers; text that is no JSON has a null pointer.

    Each level explodes what is still an object or array, so the work follows the data's own depth;
    deeper than ``depth`` is refused.
    """
    spark = docs.sparkSession
    part = lambda c: F.regexp_replace(F.regexp_replace(c, "~", "~0"), "/", "~1")
    parsed = docs.select(F.col(key), F.lit("").alias("pointer"), F.try_parse_json(F.col(text)).alias("v"), F.col(text).isNotNull().alias("given"))
    broken = parsed.filter("v is null and given").select(key, F.lit(None).cast("string").alias("pointer"), F.lit(None).cast("string").alias("value"))
    now, found = parsed.filter("v is not null").select(key, "pointer", "v"), [broken]
    kind = F.schema_of_variant("v")
    for _ in range(depth):
        nested = kind.startswith("OBJECT<") | kind.startswith("ARRAY<")
        found.append(now.filter(~nested).select(key, "pointer", F.try_variant_get("v", "$", "string").alias("value")))
        live = now.filter(nested)
        if live.isEmpty():
            return reduce(DataFrame.unionByName, found)
        now = live.lateralJoin(spark.tvf.variant_explode(F.col("v").outer())).select(key, F.concat("pointer", F.lit("/"), F.coalesce(part(F.col("key")), F.col("pos").cast("string"))).alias("pointer"), F.col("value").alias("v"))
    raise ValueError(f"JSON is nested deeper than {depth}")


def account_cards(parties: DataFrame, roles: DataFrame, invoices: DataFrame, payments: DataFrame, documents: DataFrame, variants: DataFrame | None = None) -> DataFrame:
    """One card a party: roles, name variants, invoices and payments it is part of, totals by currency, and source documents that are missing.

    A party is part of an invoice as biller or payer (or ship-to); an invoice counts once a party.  A single total
    is given only where there is one currency.
    """
    keys = [c for c in ("biller_party_key", "payer_party_key", "ship_to_party_key") if c in invoices.columns]
    touch = invoices.select(F.explode(F.array_distinct(F.array(*keys))).alias("party_key"), "invoice_key", "currency_code", "total_amount", "amount_due", "source_document_id").filter("party_key is not null")
    money = touch.groupBy("party_key", "currency_code").agg(F.count(F.lit(1)).alias("n"), F.sum("total_amount").cast("decimal(38,2)").alias("value"), F.sum("amount_due").cast("decimal(38,2)").alias("due"))
    totals = money.groupBy("party_key").agg(F.sum("n").alias("invoice_count"), F.sort_array(F.collect_list(F.struct("currency_code", "value", "due"))).alias("totals"))
    paid = payments.groupBy(F.col("payer_party_key").alias("party_key")).agg(F.count(F.lit(1)).alias("payment_count"))
    who = roles.filter("role is not null").groupBy("party_key").agg(F.sort_array(F.collect_set("role")).alias("roles"))
    missing = touch.select("party_key", F.col("source_document_id").alias("document_id")).distinct().join(documents.select("document_id"), "document_id", "left_anti").groupBy("party_key").agg(F.count(F.lit(1)).alias("missing_documents"))
    out = parties.join(who, "party_key", "left").join(totals, "party_key", "left").join(paid, "party_key", "left").join(missing, "party_key", "left")
    if variants is not None:
        named = variants.groupBy("party_key").agg(F.sort_array(F.collect_set("raw_name")).alias("name_variants"))
        out = out.join(named, "party_key", "left")
    several = F.coalesce(F.size("totals") > 1, F.lit(False))
    single = F.when(F.size("totals") == 1, F.col("totals")[0]["value"])
    zero: list[Column] = [F.coalesce(c, F.lit(0)).alias(c) for c in ("invoice_count", "payment_count", "missing_documents")]
    rest = [c for c in out.columns if c not in ("invoice_count", "payment_count", "missing_documents")]
    return out.select(*rest, *zero, single.alias("invoice_value"), several.alias("cross_currency_totals_suppressed"))
