"""The review queue packed into questions: which control blocks, what is asked in what order, and with which examples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..numbering import numbered
from ..scratch import Scratch

# Controls and the words of a finding's source that name them, first control first.
CONTROLS = {
    "extraction": ("primary_exception", "secondary_exception", "adapter", "extraction"),
    "consensus": ("consensus", "partial_disagreement", "no_majority", "single_engine", "printed_majority", "provider_extraction_exception"),
    "arithmetic": ("arithmetic",),
    "validation": ("validate", "validation"),
    "adjudication": ("adjudicat",),
    "reassembly": ("reassembly",),
    "tables": ("table",),
    "handwriting": ("handwriting", "htr"),
    "identity": ("identity", "entity", "address"),
    "attribution": ("attribution",),
    "completeness": ("completeness",),
    "sampling": ("sampling",),
    "schema": ("schema_discovery", "schema"),
    "slot_equivalence": ("slot_equivalence",),
    "allocation": ("allocation",),
    "relationships": ("relationship", "graph"),
    "delivery": ("delivery", "canonical"),
}
UNCLASSIFIED = "unclassified"
SELF_RESOLVING = ("document_wrapper",)
PRIORITIES = ("critical", "high", "normal")
EXAMPLES, READINGS = 3, 6


def control_of(*sources: Column) -> Column:
    """The control that raised a finding, by the words of its sources together."""
    text = F.lower(F.concat_ws(" ", *(F.coalesce(c, F.lit("")) for c in sources)))
    out = F.lit(UNCLASSIFIED)
    for control, words in reversed(CONTROLS.items()):
        out = F.when(text.rlike("|".join(words)), control).otherwise(out)
    return out


def blocks(items: DataFrame, sources: tuple[str, ...], floors: dict[str, int] | None = None) -> DataFrame:
    """(control, blocking_items, threshold, triggered) of the controls that block; ``items`` has blocking and disposition.

    An item blocks unless blocking is false or its disposition says no_action or informational.  Floors are 1 where none
    is given.  An item of no known control always triggers.
    """
    for control, floor in (floors or {}).items():
        if control not in CONTROLS or floor < 0:
            raise ValueError(f"no such control, or a floor below zero: {control}")
    on = F.coalesce("blocking", F.lit(True)) & ~F.lower(F.coalesce("disposition", F.lit(""))).rlike("no_action|informational")
    counted = items.filter(on).groupBy(control_of(*map(F.col, sources)).alias("control")).agg(F.count(F.lit(1)).alias("blocking_items"))
    floor = F.lit(1)
    for control, n in (floors or {}).items():
        floor = F.when(F.col("control") == control, n).otherwise(floor)
    return counted.withColumn("threshold", floor).withColumn("triggered", F.col("blocking_items") >= F.col("threshold"))


def _filled(c: str) -> Column:
    return F.nullif(F.col(c).cast("string"), F.lit(""))


def examples(members: DataFrame, s: Scratch, uninformative: DataFrame | None = None, limit: int = EXAMPLES) -> DataFrame:
    """(group_id, place, document_id, page_id, field, reason, candidates): documents at even steps through a group.

    Of a document (by its id, else its page) the first item stands, one that names a page or document first, then by document
    and field, then by item.  Documents on ``uninformative`` pages (page_id) are shown only where a group has no other.  With n documents
    and a limit of L the places are round(i * (n - 1) / (L - 1)), halves to even.
    """
    if limit < 1:
        raise ValueError("the limit is positive")
    doc, page = F.coalesce(_filled("document_id"), F.lit("")), F.coalesce(_filled("page_id"), _filled("document_id"), F.lit(""))
    key = F.coalesce(_filled("document_id"), _filled("page_id"), F.lit(""))
    rank = F.struct((F.coalesce(_filled("page_id"), _filled("document_id")).isNull()).alias("bare"), doc.alias("document_id"), F.coalesce("field", F.lit("")).alias("field"), "item_index", page.alias("page_id"), "reason", "candidates")
    one = members.groupBy("group_id", key.alias("key")).agg(F.min_by(rank, F.struct(rank["bare"], rank["document_id"], rank["field"], "item_index")).alias("x")).select("group_id", "x.*")
    if uninformative is not None:
        dull = uninformative.select("page_id").dropna().distinct().withColumn("dull", F.lit(True))
        one = one.join(dull, "page_id", "left")
    else:
        one = one.withColumn("dull", F.lit(None).cast("boolean"))
    one = s.table(one.withColumn("dull", F.coalesce("dull", F.lit(False))))
    n = one.groupBy("group_id").agg(F.count_if(~F.col("dull")).alias("good"), F.count(F.lit(1)).alias("all"))
    n = s.table(n.select("group_id", (F.col("good") == 0).alias("only_dull"), F.when(F.col("good") > 0, F.col("good")).otherwise(F.col("all")).alias("n")))
    shown = one.join(n, "group_id").filter(F.col("only_dull") | ~F.col("dull"))
    ranked = numbered(shown, s, ("group_id",), ("bare", "document_id", "field", "item_index"))
    step = (F.col("n") - 1) / F.lit(float(max(limit - 1, 1)))
    places = F.transform(F.sequence(F.lit(0), F.lit(limit - 1)), lambda i: F.bround(i * step).cast("long"))
    chosen = ranked.filter((F.col("n") <= limit) | F.array_contains(places, F.col("position") - 1))
    return chosen.select("group_id", F.col("position").alias("place"), "document_id", "page_id", "field", "reason", "candidates")


def pack(groups: DataFrame, items: DataFrame, wording: DataFrame, max_questions: int | None = None, uninformative: DataFrame | None = None) -> dict[str, DataFrame]:
    """Questions, the items behind each, examples, and what the pack covers.

    ``groups`` is (group_id, finding_family, protected), one row a group; ``items`` is (item_index, group_id, document_id, page_id,
    field, reason, candidates: array, priority); ``wording`` is (finding_family, headline, decision_choice), and families without
    one are asked generically.  Open groups come before protected ones, then those that settle more items, then by id.  Past
    ``max_questions`` a question is deferred, never dropped.  A protected group is not cleared by one answer for all; a family that
    resolves itself asks nothing.  Items of no group are in ``members`` without a question.  A group without items is asked as well.
    """
    if max_questions is not None and max_questions < 1:
        raise ValueError("max_questions is positive")
    s = Scratch(items.sparkSession, "questions")
    urgent = F.lower(F.coalesce("priority", F.lit("normal")))
    level = F.when(urgent == PRIORITIES[0], 0).when(urgent == PRIORITIES[1], 1).otherwise(2)
    sums = items.groupBy("group_id").agg(F.count(F.lit(1)).alias("items"), F.count_distinct(_filled("document_id")).alias("documents"), F.min(level).alias("level"))
    known = groups.select("group_id", "finding_family", F.coalesce("protected", F.lit(False)).alias("protected")).join(sums, "group_id", "left")
    known = known.withColumns({"items": F.coalesce("items", F.lit(0)), "documents": F.coalesce("documents", F.lit(0)), "level": F.coalesce("level", F.lit(2))})
    known = known.join(wording.select("finding_family", "headline", "decision_choice"), "finding_family", "left").withColumn("_less", -F.col("items"))
    asked = s.table(numbered(known, s, (), ("protected", "_less", "group_id"), "number"))
    shown = s.table(examples(items.filter("group_id is not null"), s, uninformative))
    read = F.array_distinct(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("place", "candidates"))), lambda x: F.coalesce(x["candidates"], F.array().cast("array<string>")))))
    read = F.filter(F.transform(read, lambda v: F.trim(v)), lambda v: v != "")
    readings = shown.groupBy("group_id").agg(F.array_distinct(read).alias("r"))
    more = F.size("r") - READINGS
    summary = F.concat(F.array_join(F.slice("r", 1, READINGS), " | "), F.when(more > 0, F.concat(F.lit(" | (+"), more, F.lit(" more)"))).otherwise(""))
    answerable = ~F.coalesce(F.col("finding_family").isin(*SELF_RESOLVING), F.lit(False))
    questions = asked.join(readings, "group_id", "left").select(
        F.concat(F.lit("Q"), F.when(F.col("number") < 1000, F.lpad(F.col("number").cast("string"), 3, "0")).otherwise(F.col("number").cast("string"))).alias("question_id"), "number", "group_id", "finding_family",
        F.coalesce("headline", F.lit("Please confirm these items.")).alias("headline"), "decision_choice", "items", "documents", F.element_at(F.array(*map(F.lit, PRIORITIES)), F.col("level") + 1).alias("priority"), "protected",
        answerable.alias("client_answer_permitted"), (answerable & ~F.col("protected")).alias("batch_clear_permitted"), F.col("headline").isNull().alias("generic_wording"),
        F.coalesce(summary, F.lit("")).alias("what_we_read"), F.lit(False if max_questions is None else None).cast("boolean").alias("deferred"),
    )
    if max_questions is not None:
        questions = questions.withColumn("deferred", F.col("number") > max_questions)
    questions = s.table(questions)
    members = items.select("item_index", "group_id").join(questions.select("group_id", "question_id", "deferred"), "group_id", "left")
    total = items.agg(F.count(F.lit(1)).alias("queue_items"))
    of = lambda c: F.count_if(~F.col("deferred") & c)
    every, answer = F.lit(True), F.col("client_answer_permitted")
    figures = questions.agg(
        of(every).alias("questions"), of(answer).alias("answerable"), of(F.col("protected")).alias("protected"), of(F.col("batch_clear_permitted")).alias("batch_clearing"),
        of(answer & ~F.col("batch_clear_permitted")).alias("rechecked_one_by_one"), F.count_if("deferred").alias("deferred"), of(F.col("generic_wording")).alias("generic"),
        F.coalesce(F.sum(F.when(~F.col("deferred"), F.col("items"))), F.lit(0)).alias("items_covered"),
    )
    pct = F.when(F.col("queue_items") > 0, F.round(100.0 * F.col("items_covered") / F.col("queue_items"), 2)).otherwise(0.0)
    return {"questions": questions, "members": members, "examples": shown, "summary": figures.crossJoin(total).withColumn("coverage_pct", pct)}  # one row each
