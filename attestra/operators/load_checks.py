"""Cells that a load target would take wrongly: several values in one, placeholders for keys, country names, addresses of products, shared identities."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Columns that hold one value each, that name one record, and that describe a product; shapes of keys, countries and streets.
PHONE, EMAIL = r"\d[\d\-.\s()]{6,}\d", r"(?i)[^@\s]+@[^@\s]+\.[a-z]{2,}"
SINGLE = {"contact_phone": PHONE, "contact_email": EMAIL, "sales_representative_phone": PHONE, "sales_representative_email": EMAIL}
IDENTITIES = ("payment_reference", "check_number")
PRODUCTS = ("product_sku", "item_code", "description", "style", "product_name")
PLACEHOLDER = r"(?U)^[0\W_]+$"
COUNTRY_COLUMN = r"(^|_)country(_of_\w+|_code)?$"
COUNTRY_CODE = "^[A-Za-z]{2}$"
STREET_ADDRESS = r"(?i)\b\d{1,6}\s+[a-z][^,;]{0,30}?\b(?:st|street|ave|avenue|rd|road|blvd|boulevard|dr|drive|ln|lane|way|suite|ste|pkwy|parkway|hwy|highway)\b"
EVIDENCE = ("__inferred_by", "__inferred_evidence")
SHOWN = 5


def cells(rows: DataFrame, key: list[str]) -> DataFrame:
    """(key, column, value) of the filled cells of every other column, as trimmed text; columns of evidence are no cells."""
    columns = [c for c in rows.columns if c not in key and not c.endswith(EVIDENCE)]
    long = F.array(*(F.struct(F.lit(c).alias("column"), F.trim(F.col(f"`{c}`").cast("string")).alias("value")) for c in columns))
    return rows.select(*key, F.explode(F.filter(long, lambda x: x["value"] != "")).alias("x")).select(*key, "x.*") if columns else rows.sparkSession.createDataFrame([], rows.select(*key, F.lit("").alias("column"), F.lit("").alias("value")).schema)


def cell_issues(rows: DataFrame, key: list[str]) -> DataFrame:
    """(key, column, value, reason): one row a cell and fault, in one scan.  A cell may have several; nulls and blanks have none."""
    c, v = F.col("column"), F.col("value")
    many = [F.when((c == column) & (F.regexp_count(v, F.lit(pattern)) > 1), "multiple_values_in_a_single_valued_column") for column, pattern in SINGLE.items()]
    faults = F.array_compact(F.array(
        *many,
        F.when(c.isin(*IDENTITIES) & v.rlike(PLACEHOLDER), "placeholder_standing_in_for_an_identity"),
        F.when(c.rlike(COUNTRY_COLUMN) & ~v.rlike(COUNTRY_CODE), "country_name_where_a_two_letter_code_belongs"),
        F.when(c.isin(*PRODUCTS) & v.rlike(STREET_ADDRESS), "address_shaped_value_in_a_product_column"),
    ))
    return cells(rows, key).select(*key, "column", "value", F.explode(faults).alias("reason"))


def shared_identities(rows: DataFrame, document: str = "document_id") -> DataFrame:
    """(column, value, documents, first): identities that several documents claim, with the first five.

    Placeholders are left to :func:`cell_issues`.  A null document counts as one.  Claims are made distinct by shuffle, and a
    task passes on five documents of an identity at most.
    """
    have = [c for c in IDENTITIES if c in rows.columns]
    narrow = rows.select(F.coalesce(F.col(document).cast("string"), F.lit("")).alias("_d"), *have)
    claims = cells(narrow, ["_d"]).filter(~F.col("value").rlike(PLACEHOLDER)).distinct()
    counts = claims.groupBy("column", "value").agg(F.count(F.lit(1)).alias("documents")).filter("documents > 1")
    top = claims.withColumn("_k", F.row_number().over(Window.partitionBy("column", "value").orderBy("_d"))).filter(F.col("_k") <= SHOWN)
    return counts.join(top.groupBy("column", "value").agg(F.array_join(F.sort_array(F.collect_list("_d")), "; ").alias("first")), ["column", "value"])
