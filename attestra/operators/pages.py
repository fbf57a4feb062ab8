"""Pages: reassembly of numbered pages, and money that a page's export lost or invented."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def page_marker(text: Column) -> tuple[Column, Column]:
    """(number, total) of a printed PAGE X OF Y."""
    pattern = r"(?i)\bpage\s+(\d{1,4})\s+of\s+(\d{1,4})\b"
    return F.regexp_extract(text, pattern, 1).try_cast("int"), F.regexp_extract(text, pattern, 2).try_cast("int")


def reassemble(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(complete groups, first pages without one) of pages (source, ordinal, number, total, type, identifiers).

    A group is ``total`` consecutive ordinals numbered 1..total with one type and an
    identifier that all share.  Every page is keyed by where its group would begin, so a group is
    one aggregation; pages of two groups cannot overlap, as their numbers place them in one.
    """
    p = pages.filter("number is not null and total >= 2").withColumn("begin", F.col("ordinal") - F.col("number") + 1)
    g = p.groupBy("source", "begin", "total").agg(F.countDistinct("number").alias("pages"), F.max("number").alias("last"), F.countDistinct("type").alias("types"), F.count("type").alias("typed"), F.min("type").alias("type"), F.min("number").alias("first"))
    ids = p.select("source", "begin", "total", "number", F.explode(F.array_distinct("identifiers")).alias("i")).groupBy("source", "begin", "total", "i").agg(F.countDistinct("number").alias("n")).filter("n = total")
    shared = ids.groupBy("source", "begin", "total").agg(F.sort_array(F.collect_set("i")).alias("shared"))
    out = g.join(shared, ["source", "begin", "total"], "left")
    whole = (F.col("pages") == F.col("total")) & (F.col("types") == 1) & (F.col("typed") == F.col("pages")) & F.col("shared").isNotNull()
    reason = F.when(F.col("pages") < F.col("total"), "incomplete_page_sequence").otherwise("conflicting_reassembly_evidence")
    groups = out.filter(whole).select("source", "begin", "total", "type", "shared")
    return groups, out.filter(~whole & (F.col("first") == 1)).select("source", "begin", "total", reason.alias("reason"))


def money_difference(printed: DataFrame, retained: DataFrame, key: str, amount: str) -> tuple[DataFrame, DataFrame]:
    """(amounts printed and not retained, amounts retained and not printed), as multisets by page."""
    a, b = printed.select(key, amount), retained.select(key, amount)
    return a.exceptAll(b), b.exceptAll(a)


def evidence_tally(rows: DataFrame, grade: str, amount: str) -> DataFrame:
    return rows.groupBy(grade).agg(F.count(F.lit(1)).alias("rows"), F.sum(F.abs(amount)).alias("absolute"))


def strata_coverage(documents: DataFrame, stratum: str, value: str, per_stratum: int) -> DataFrame:
    """Of each stratum its documents, value, how many are drawn, and what one drawn page stands for."""
    g = documents.groupBy(stratum).agg(F.count(F.lit(1)).alias("documents"), F.sum(value).alias("value"))
    drawn = F.least(F.col("documents"), F.lit(per_stratum))
    return g.withColumn("drawn", drawn).withColumn("documents_per_page", F.bround(F.col("documents") / drawn, 1))


def key_cardinality(lines: DataFrame, document: str, key: str) -> DataFrame:
    """Documents by the number of their distinct line keys."""
    per = lines.groupBy(document).agg(F.countDistinct(key).alias("keys"))
    return per.groupBy("keys").agg(F.count(F.lit(1)).alias("documents"))


def page_of(document: Column) -> Column:
    """The page that a document is: the last segment of its id."""
    return F.element_at(F.split(document, "__"), -1)


def printed_row_codes(lines: DataFrame, tokens: DataFrame, code: str) -> DataFrame:
    """(page, position, code) of lines whose printed row shows one code that no other line claims.

    ``lines`` is (page, position, amounts), ``tokens`` (page, index, reading, top, bottom).  An amount finds a row only
    where the page prints it once; a row is shared where either reading's middle lies within the other.
    ``code`` matches a whole token without its outer marks.
    """
    digits = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), r"[,$\s]", "")
    word = F.regexp_replace("reading", r"^[()\[\]{}:;,.|]+|[()\[\]{}:;,.|]+$", "")
    codes = tokens.select("page", "index", word.alias("code"), F.col("top").alias("c_top"), F.col("bottom").alias("c_bottom")).filter(F.col("code").rlike(f"^(?:{code})$"))
    printed = tokens.select("page", digits(F.col("reading")).alias("amount"), "top", "bottom").groupBy("page", "amount")
    once = printed.agg(F.count(F.lit(1)).alias("n"), F.min("top").alias("top"), F.min("bottom").alias("bottom")).filter("n = 1").drop("n")
    own = lines.select("page", "position", F.explode(F.array_distinct(F.transform("amounts", digits))).alias("amount")).filter("amount <> ''")
    spans = own.join(once, ["page", "amount"])
    shared = ((F.col("top") + F.col("bottom")) / 2).between(F.col("c_top"), F.col("c_bottom")) | ((F.col("c_top") + F.col("c_bottom")) / 2).between(F.col("top"), F.col("bottom"))
    found = spans.join(codes, "page").filter(shared).groupBy("page", "position").agg(F.min("index").alias("index"), F.max("index").alias("last"), F.min("code").alias("code"))
    claims = found.filter(F.col("index") == F.col("last"))
    alone = claims.groupBy("page", "index").agg(F.count(F.lit(1)).alias("n"), F.min("position").alias("position"), F.min("code").alias("code")).filter("n = 1")
    return alone.select("page", "position", "code")


def refile(readings: DataFrame, rules: DataFrame, authorization: str) -> tuple[DataFrame, DataFrame]:
    """(readings after the moves, refusals) of line readings (document_id, line, field, value) under rules (page, source, target).

    A reading moves to its rule's target unless the target holds a reading, or another reading is to
    move there too; empty values never move.  Rules judge the input, not each other's moves: a source
    that is also a target of its page is left for a second call.  A moved row says where it stood.
    """
    full = F.coalesce(F.trim("value"), F.lit("")) != ""
    r = rules.select("page", F.col("source").alias("field"), "target").distinct()
    rows = readings.withColumn("page", page_of(F.col("document_id"))).join(r, ["page", "field"], "left")
    held = readings.filter(full).select("document_id", "line", F.col("field").alias("target")).distinct().withColumn("held", F.lit(True))
    asked = rows.filter(full & F.col("target").isNotNull()).groupBy("document_id", "line", "target").agg(F.count(F.lit(1)).alias("asked"))
    j = rows.join(held, ["document_id", "line", "target"], "left").join(asked, ["document_id", "line", "target"], "left")
    wanted = full & F.col("target").isNotNull()
    moves = wanted & F.col("held").isNull() & (F.col("asked") == 1)
    after = j.select("document_id", "line", F.when(moves, F.col("target")).otherwise(F.col("field")).alias("field"), "value", F.when(moves, F.col("field")).alias("refiled_from"), F.when(moves, F.lit(authorization)).alias("authorization"))
    gone = after.filter("refiled_from is not null").select("document_id", "line", "field", F.lit(True).alias("filled"))
    kept = after.join(gone, ["document_id", "line", "field"], "left").filter(F.col("refiled_from").isNotNull() | F.col("filled").isNull()).drop("filled")
    refused = j.filter(wanted & ~moves).select("document_id", "line", "field", "target", F.when(F.col("held"), "the_target_field_holds_a_reading").otherwise("two_readings_for_one_target").alias("reason"))
    return kept, refused
