"""Load contracts and gates: every operator returns the offending rows with a reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicate_keys(rows: DataFrame, key: list[str]) -> DataFrame:
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def orphans(rows: DataFrame, link: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose link names no parent; an empty link is no orphan."""
    p = parent.select(F.col(parent_key).alias("_p")).distinct()
    return rows.filter(F.col(link).isNotNull() & (F.col(link).cast("string") != "")).join(p, F.col(link) == F.col("_p"), "left_anti")


def enum_violations(rows: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    return rows.filter(F.col(column).isNotNull() & ~F.col(column).isin(allowed)).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("rows"))


def width_violations(rows: DataFrame, limits: dict[str, int]) -> DataFrame:
    """(column, rows over its width, widest)."""
    long = rows.select(*(F.length(F.col(c).cast("string")).alias(c) for c in limits)).unpivot([], list(limits), "column", "width")
    table = F.create_map(*(F.lit(x) for kv in limits.items() for x in kv))
    return long.groupBy("column").agg(F.sum((F.col("width") > table[F.col("column")]).cast("long")).alias("over"), F.max("width").cast("long").alias("widest"))


def scale_violations(rows: DataFrame, column: str, scale: int) -> DataFrame:
    """Rows whose number has more decimals than the target keeps."""
    c = F.col(column).cast("decimal(38,9)")
    return rows.filter(c != F.round(c, scale))


def order_violations(rows: DataFrame, earlier: str, later: str) -> DataFrame:
    return rows.filter(F.col(earlier) > F.col(later))


def gate(rows: DataFrame, checks: list[tuple[str, Column]]) -> DataFrame:
    """Each row with the first check that fails, in order; null where all pass."""
    out = F.lit(None).cast("string")
    for reason, fails in reversed(checks):
        out = F.when(F.coalesce(fails, F.lit(False)), reason).otherwise(out)
    return rows.withColumn("excluded_for", out)


def row_contract(rows: DataFrame, key: list[str], batch: str | None = None, batch_id: str | None = None, status: str = "review_status", clear: tuple[str, ...] = ("clear",)) -> DataFrame:
    """Counts of what a batched table may not hold: null keys, repeated keys, foreign batches, open reviews."""
    total = rows.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.when(F.greatest(*(F.col(k).isNull() for k in key), F.lit(False)), 1).otherwise(0)).alias("null_keys"), F.sum((~F.col(status).isin(*clear)).cast("long")).alias("open_reviews"), F.sum((F.col(batch) != batch_id).cast("long") if batch else F.lit(0)).alias("foreign_batches"))
    return total.crossJoin(duplicate_keys(rows, key).agg(F.count(F.lit(1)).alias("duplicate_keys")))
