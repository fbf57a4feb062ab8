"""Rows numbered in an order, over written ranges, so that no task holds a whole group."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import Scratch

#: Rows that one task sorts or joins.
TASK_ROWS = 150_000


def tasks(spark: SparkSession, rows: int) -> int:
    """How many tasks so many rows are dealt into: the session's own number, or more, so that what one holds does not grow."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), rows // TASK_ROWS)


def numbered(df: DataFrame, s: Scratch, within: tuple[str, ...], order: tuple[str, ...], name: str = "position") -> DataFrame:
    """``df`` with a number from 1 on, in ascending ``order`` (nulls first) inside each group of ``within``.

    The ranges are written with their number.  A group that begins in an earlier range continues there with an offset; a range
    has one such group at most, so the offsets are no more rows than there are ranges.  ``order`` should be unique in
    a group; equal rows are numbered in any order.
    """
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = s.table(df.repartitionByRange(parts, *within, *order).withColumn("_p", F.spark_partition_id()))
    sums = ranged.groupBy("_p", *within).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*within).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).filter("_before > 0").select(F.col("_p").alias("_q"), *(F.col(c).alias(f"_w_{c}") for c in within), "_before")
    same = F.col("_p") == F.col("_q")
    for c in within:
        same = same & F.col(c).eqNullSafe(F.col(f"_w_{c}"))
    here = ranged.withColumn("_k", F.row_number().over(Window.partitionBy("_p", *within).orderBy(*order)))
    return here.join(F.broadcast(offsets), same, "left").select(*df.columns, (F.col("_k") + F.coalesce("_before", F.lit(0))).cast("long").alias(name))
