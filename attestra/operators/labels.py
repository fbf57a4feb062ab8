"""Line-grain labels: windows over a total order of whole rows, so that equal keys have a defined first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..numbering import tasks


def _hash(columns: list[str]) -> Column:
    return F.sha2(F.concat_ws("\x1f", *(F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns)), 256)


def duplicate_lines(lines: DataFrame, document: str, order: str, signature: list[str]) -> DataFrame:
    """The first row of a document with the same full signature, for every later one."""
    w = Window.partitionBy(document, "_s")
    out = lines.withColumn("_s", _hash(signature)).withColumn("first_row", F.min(order).over(w)).drop("_s")
    return out.withColumn("duplicate_of", F.when(F.col(order) > F.col("first_row"), F.col("first_row"))).drop("first_row")


def repeat_across_documents(lines: DataFrame, document: str, signature: list[str]) -> DataFrame:
    """Signatures in several documents: the first document, how many, and each later document.

    Aggregated by (signature, document) first, so that a very common line is counted and
    not gathered.
    """
    per = lines.withColumn("_s", _hash(signature)).groupBy("_s", document).agg(F.count(F.lit(1)).alias("rows"))
    first = per.groupBy("_s").agg(F.min(document).alias("first_document"), F.count(F.lit(1)).alias("documents")).filter("documents > 1")
    return per.join(first, "_s").filter(F.col(document) != F.col("first_document")).select(document, "first_document", "documents", "rows", F.col("_s").alias("signature"))


def shifted_column(lines: DataFrame, document: str, order: str, value: str, sibling: str, least_run: int = 2) -> DataFrame:
    """Runs of rows whose ``value`` equals the row above's ``sibling``: gaps and islands over the row order."""
    w = Window.partitionBy(document).orderBy(order)
    hit = (F.col(value).isNotNull() & (F.col(value) == F.lag(sibling).over(w)) & (F.col(value) != F.coalesce(F.col(sibling), F.lit(-1)))).cast("int")
    rows = lines.withColumn("_hit", F.coalesce(hit, F.lit(0))).withColumn("_island", F.row_number().over(w) - F.sum("_hit").over(w))
    runs = rows.filter("_hit = 1").groupBy(document, "_island").agg(F.min(order).alias("from_row"), F.max(order).alias("to_row"), F.count(F.lit(1)).alias("rows"))
    return runs.filter(F.col("rows") >= least_run).drop("_island")


def majority_elsewhere(cells: DataFrame, document: str, keys: list[str], value: str, least: int = 3) -> DataFrame:
    """Of each key, the value most documents print (ties to the smallest text), for documents that print another."""
    per = cells.select(document, *keys, F.col(value).cast("string").alias("v")).distinct()
    counts = per.groupBy(*keys, "v").agg(F.count(F.lit(1)).alias("n"))
    top = counts.groupBy(*keys).agg(F.min(F.struct((-F.col("n")).alias("m"), F.col("v").alias("v"))).alias("t"), F.sum("n").alias("documents"))
    best = top.select(*keys, F.col("t.v").alias("majority"), (-F.col("t.m")).alias("agreeing"), "documents").filter(F.col("documents") >= least)
    return per.join(best, keys).filter("v <> majority").withColumnRenamed("v", "value")


def amended_values(originals: DataFrame, amendments: DataFrame, key: list[str], value: str) -> DataFrame:
    """The amendment of the latest effective time over each original, and whether there is one."""
    last = amendments.groupBy(*key).agg(F.max_by("amended_value", F.struct("effective_time", "amended_value")).alias("amended_value"))
    out = originals.join(last, key, "left")
    return out.withColumn("is_amended", F.col("amended_value").isNotNull()).withColumn("current_value", F.coalesce("amended_value", value)).drop("amended_value")


def repeated_blocks(lines: DataFrame, document: str, order: str, signature: list[str], least_pairs: int = 3, ratio: float = 0.8) -> DataFrame:
    """Documents whose table repeats itself at an offset of at least half its rows.

    Pairs of equal rows within a document are counted by their offset.
    """
    spark, of_document = lines.sparkSession, Window.partitionBy(document)
    parts = tasks(spark, lines.count())
    # dealt by document for its numbers, then by document and row; both follow the lines, so what a task holds does not grow
    dealt = lines.select(*dict.fromkeys([document, order, *signature])).repartition(parts, document)
    rows = dealt.select(document, F.dense_rank().over(of_document.orderBy(order)).alias("i"), _hash(signature).alias("s")).distinct().withColumn("n", F.max("i").over(of_document))
    rows = rows.repartition(parts, document, "s")
    # a row in a table's second half meets those at least half a table above it, no others
    a, b = rows.alias("a"), rows.filter(F.col("i") * 2 > F.col("n")).alias("b")
    offset = F.col("b.i") - F.col("a.i")
    pairs = a.join(b, (F.col(f"a.{document}") == F.col(f"b.{document}")) & (F.col("a.s") == F.col("b.s")) & (F.col("a.i") < F.col("b.i")) & (offset * 2 >= F.col("b.n")))
    # counted first where they met, so that no pair is dealt out again
    met = pairs.groupBy(F.col(f"a.{document}").alias(document), offset.alias("offset"), F.col("b.n").alias("n"), F.col("a.s").alias("s")).agg(F.count(F.lit(1)).alias("m"))
    by = met.repartition(parts, document, "offset", "n").groupBy(document, "offset", "n").agg(F.sum("m").alias("pairs"), F.count(F.lit(1)).alias("variety"))
    return by.filter((F.col("pairs") >= least_pairs) & (F.col("variety") >= 2) & (F.col("pairs") >= ratio * (F.col("n") - F.col("offset")))).select(document, "offset", "pairs", "variety", "n")
