"""Votes on open cells with their two tie breaks, and readings weighed against an independent page text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch
from .consensus import CELL, comparable, vendor_vote

# What separates the figures of a page, what a token is made of, and the shortest value sought inside others.
SEPARATORS = r"(?U)[\s,$£€]"
TOKEN = r"[a-z0-9().%/-]+"
SHORTEST = 3


def _words(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "))


def vote_with_ties(cells: DataFrame, readings: DataFrame, pages: DataFrame | None = None, minimum: int = 2) -> DataFrame:
    """The open cells of :func:`~attestra.operators.consensus.field_consensus`: resolved_value, resolved_by, agreeing, reason.

    Where vendors tie, the one reading of the cell that its document has settled elsewhere is
    taken (same_document); failing that, the one that an independent extractor's text of the
    page holds (independent_extractor).  Both are weaker than vendor_agreement and say so.  Two such readings break no tie.
    readings (document_id, row_index, field, vendor, value); pages (document_id, text), of several for one document all count.
    """
    # the cells are read three times, so they are made once
    cells = Scratch(cells.sparkSession, "votes").table(cells.select(*CELL, "value", "accepted", "clusters"))
    base = vendor_vote(cells, minimum)
    tied = base.filter("reason = 'vendors_tied'").select(*CELL)
    said = readings.filter("value is not null").select(*CELL, "value").distinct().join(tied, list(CELL), "left_semi").withColumn("k", comparable(F.col("value")))
    settled = cells.filter("accepted").select("document_id", comparable(F.col("value")).alias("k")).filter("k is not null").distinct()
    one = lambda df, name: df.groupBy(*CELL).agg(F.count(F.lit(1)).alias("n"), F.min("value").alias(name)).filter("n = 1").drop("n")
    out = base.join(one(said.join(settled, ["document_id", "k"]), "local"), list(CELL), "left")
    if pages is None:
        out = out.withColumn("printed", F.lit(None).cast("string"))
    else:
        # a document's text is looked into where its tied readings are, once for all of them
        mine = said.groupBy("document_id").agg(F.collect_set(F.struct(*CELL[1:], "value")).alias("s"))
        text = pages.select("document_id", _words(F.coalesce("text", F.lit(""))).alias("t"))
        seen = mine.join(text, "document_id").select("document_id", "t", F.explode("s").alias("x")).select("document_id", "x.*", "t")
        needle = _words(F.col("value"))
        seen = seen.filter((needle != "") & F.contains("t", needle)).select(*CELL, "value").distinct()
        out = out.join(one(seen, "printed"), list(CELL), "left")
    tie = F.coalesce(F.col("reason") == "vendors_tied", F.lit(False))
    value = F.when(tie, F.coalesce("local", "printed")).otherwise(F.col("resolved_value"))
    by = F.when(tie & F.col("local").isNotNull(), "same_document").when(tie & F.col("printed").isNotNull(), "independent_extractor").when(F.col("reason").isNull(), "vendor_agreement")
    return out.select(*CELL, value.alias("resolved_value"), by.alias("resolved_by"), "agreeing", F.when(by.isNull(), F.col("reason")).alias("reason"))


def glyphs(c: Column) -> Column:
    """What two readers of the same print share: no case, blanks, thousands commas or currency signs."""
    return F.regexp_replace(F.lower(F.coalesce(c.cast("string"), F.lit(""))), SEPARATORS, "")


def page_evidence(pages: DataFrame) -> DataFrame:
    """(document_id, joined, tokens): a page's text without separators, and how often each token stands on it; pages without any text are absent.

    pages (document_id, text); several texts of one page are one.
    """
    whole = pages.groupBy("document_id").agg(F.array_join(F.sort_array(F.collect_list(F.coalesce("text", F.lit("")))), " ").alias("text"))
    tokens = F.regexp_extract_all(F.regexp_replace(F.lower("text"), ",", ""), F.lit(TOKEN), F.lit(0))
    return whole.select("document_id", glyphs(F.col("text")).alias("joined"), tokens.alias("tokens")).filter("joined <> ''")


def _occurrences(value: Column, joined: Column, tokens: Column) -> Column:
    """How often a value of three glyphs or more stands in the joined text, a shorter one as a whole token."""
    g = glyphs(value)
    inside = ((F.length(joined) - F.length(F.replace(joined, g, F.lit("")))) / F.length(g)).cast("int")
    return F.when(g == "", 0).when(F.length(g) < SHORTEST, F.size(F.filter(tokens, lambda t: t == g))).otherwise(inside)


def corroborate(findings: DataFrame, evidence: DataFrame) -> DataFrame:
    """Each finding (document_id, field, candidates) with outcome, value, match_mode, occurrences and reason.

    One candidate that the page holds is a corroboration; of two, the only one that it holds breaks the tie.  Presence
    proves that a figure is printed on the page and not where, so how often it stands there is told beside it.
    """
    f = findings.withColumn("candidates", F.filter(F.coalesce("candidates", F.array().cast("array<string>")), lambda c: c.isNotNull()))
    x = f.join(evidence, "document_id", "left")
    counted = F.transform("candidates", lambda c: F.struct(c.alias("value"), _occurrences(c, F.col("joined"), F.col("tokens")).alias("n")))
    x = x.withColumn("present", F.filter(counted, lambda y: y["n"] > 0))
    few, found = F.size("candidates"), F.size("present")
    outcome = F.when(F.col("joined").isNull(), "unresolved").when((few == 1) & (found == 1), "corroboration").when((few == 2) & (found == 1), "tie_break").otherwise("unresolved")
    why = F.when(F.col("joined").isNull(), "no_independent_evidence_for_page").when(few == 1, "value_absent_from_independent_evidence").when(few == 2, F.when(found == 2, "both_candidates_present").otherwise("neither_candidate_present")).otherwise("no_candidate_value_to_weigh_against_evidence")
    x = x.withColumn("outcome", outcome)
    good, hit = F.col("outcome") != "unresolved", F.get("present", F.lit(0))
    mode = F.when(F.length(glyphs(hit["value"])) < SHORTEST, "token").otherwise("substring")
    return x.select(*findings.columns, "outcome", F.when(good, hit["value"]).alias("value"), F.when(good, mode).alias("match_mode"), F.when(good, hit["n"]).alias("occurrences"), F.when(~good, why).alias("reason"))
