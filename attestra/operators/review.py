"""The review queue and authorised amendments: everything keeps the prior state beside the new one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = ("document_id", "field", "reason", "stage", "source")


def queue_dedupe(queues: list[DataFrame], key: tuple[str, ...] = KEY) -> DataFrame:
    """The union of queues, one row a key: the smallest priority, every artifact."""
    rows = reduce(lambda a, b: a.unionByName(b), queues)
    return rows.groupBy(*key).agg(F.min("priority").alias("priority"), F.sort_array(F.collect_set("artifact")).alias("artifacts"), F.count(F.lit(1)).alias("copies"))


def review_cards(items: DataFrame) -> DataFrame:
    """One card a document: best priority, reasons, fields, items."""
    return items.groupBy("document_id").agg(F.min("priority").alias("priority"), F.sort_array(F.collect_set("reason")).alias("reasons"), F.countDistinct("field").alias("fields"), F.count(F.lit(1)).alias("items"))


def root_causes(items: DataFrame) -> DataFrame:
    """Families of findings by (reason, field): how many items and documents, biggest first by the caller."""
    return items.groupBy("reason", "field").agg(F.count(F.lit(1)).alias("items"), F.countDistinct("document_id").alias("documents"))


def supersede(items: DataFrame, answered: DataFrame) -> DataFrame:
    """Items with their answer's id where (document_id, field) is answered, else open."""
    a = answered.groupBy("document_id", "field").agg(F.min("answer_id").alias("answer_id"))
    return items.join(a, ["document_id", "field"], "left").withColumn("status", F.when(F.col("answer_id").isNotNull(), "answered").otherwise("open"))


def resolve_exceptions(documents: DataFrame, authorised: DataFrame) -> DataFrame:
    """A document clears only when every open field is named; the prior status stays beside the new one."""
    named = authorised.groupBy("document_id").agg(F.collect_set("field").alias("named"))
    out = documents.join(named, "document_id", "left")
    left = F.array_except("open_fields", F.coalesce("named", F.array().cast("array<string>")))
    status = F.when(F.col("status") == "clear", "clear").when((F.size("open_fields") > 0) & (F.size(left) == 0), "clear").otherwise(F.col("status"))
    return out.select("document_id", F.col("status").alias("prior_status"), status.alias("status"), F.sort_array(left).alias("still_open"))


def amend_classification(current: DataFrame, amendments: DataFrame, supersede_vendors: bool = False) -> DataFrame:
    """The last amendment of a document counts; vendor agreement outranks it unless told otherwise; two of one time conflict."""
    w = Window.partitionBy("document_id").orderBy(F.desc("entry"))
    last = amendments.withColumn("_k", F.rank().over(w)).filter("_k = 1").groupBy("document_id").agg(F.countDistinct("type").alias("k"), F.min("type").alias("amended_type"))
    out = current.join(last, "document_id", "left")
    ok = (F.col("k") == 1) & (F.lit(supersede_vendors) | ~F.col("vendor_agreed"))
    return out.select("document_id", F.col("type").alias("prior_type"), F.when(ok, F.col("amended_type")).otherwise(F.col("type")).alias("type"), F.when(F.col("k") > 1, "conflicting").when(ok, "amended").when(F.col("k") == 1, "vendor_agreement_stands").otherwise("unchanged").alias("outcome"))


def withhold_outliers(members: DataFrame, group: str, populated: str, factor: float) -> DataFrame:
    """Members with more populated fields than ``factor`` times their group's true median."""
    med = members.groupBy(group).agg(F.median(populated).alias("median"))
    return members.join(med, group).withColumn("withheld", F.col(populated) > factor * F.col("median"))


def exact_cover(groups: DataFrame, decisions: DataFrame) -> DataFrame:
    """Every group decided once: missing, repeated and unknown decisions by group_id."""
    d = decisions.groupBy("group_id").agg(F.count(F.lit(1)).alias("n"))
    g = groups.select("group_id").distinct().withColumn("known", F.lit(True))
    out = g.join(d, "group_id", "full")
    problem = F.when(F.col("known").isNull(), "unknown_group").when(F.col("n").isNull(), "undecided").when(F.col("n") > 1, "decided_more_than_once")
    return out.select("group_id", problem.alias("problem")).filter("problem is not null")


def privacy_inventory(texts: DataFrame, key: str, text: str, patterns: dict[str, str]) -> DataFrame:
    """(pattern, texts with a match, matches)."""
    counts = texts.select(key, *(F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(p)).alias(n) for n, p in patterns.items()))
    longer = counts.unpivot([key], list(patterns), "pattern", "n")
    return longer.groupBy("pattern").agg(F.sum((F.col("n") > 0).cast("long")).alias("texts"), F.sum("n").cast("long").alias("matches"))


def page_category(text: Column, signals: list[tuple[str, str]], other: str = "other") -> Column:
    """The first signal whose pattern is found."""
    out = F.lit(other)
    for name, pattern in reversed(signals):
        out = F.when(text.rlike(pattern), name).otherwise(out)
    return out


def duplicate_pages(pages: DataFrame, key: str, content: str) -> DataFrame:
    """Later pages with the content hash of an earlier one, and that first page."""
    h = pages.select(key, F.sha2(F.col(content), 256).alias("h"))
    first = h.groupBy("h").agg(F.min(key).alias("first_page"), F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    return h.join(first, "h").filter(F.col(key) > F.col("first_page")).select(key, "first_page", "copies")


# Reasons that may leave the human queue, and words that keep an item in it.
SAFE_REASONS = (
    "document_type_proposal",
    "formatting_review",
    "google_genai_document_type_disagrees_with_intake_rule",
    "google_genai_document_type_proposal",
    "no_high_signal_document_type",
    "openai_document_type_disagrees_with_intake_rule",
    "openai_document_type_proposal",
    "openrouter_document_type_disagrees_with_intake_rule",
    "openrouter_document_type_proposal",
)
PROTECTED_REASONS = ("no_majority", "partial_disagreement", "upstream_gate_blocked")
REASON_WORDS = ("adjudication", "arithmetic", "conflict", "exception", "failure", "financial", "handwriting", "htr", "identity", "jbig2", "missing", "no_consensus", "no_extractable_text", "provider", "reassembly", "review_flag", "schema", "signature", "unresolved")
FIELD_WORDS = ("account", "address", "amount", "buyer", "currency", "customer", "entity", "handwriting", "identity", "party", "price", "seller", "subtotal", "tax", "total", "vendor")

ITEM_KEY = ("document_id", "page_id", "region_id", "field", "reason")


def protection(reason: Column, about: Column) -> Column:
    """Why an item stays with people: a list of causes, empty for a safe reason alone; an unknown reason fails closed.

    ``about`` is the item's field, category and source in one text.  Nulls count as empty.
    """
    r = F.lower(F.trim(F.coalesce(reason, F.lit(""))))
    a = F.lower(F.coalesce(about, F.lit("")))
    held = F.when(r.isin(*PROTECTED_REASONS), F.concat(F.lit("reason:"), r))
    words = [F.when(F.contains(r, F.lit(w)), F.lit(f"reason_token:{w}")) for w in REASON_WORDS]
    fields = [F.when(F.contains(a, F.lit(w)), F.lit(f"field_token:{w}")) for w in FIELD_WORDS]
    causes = F.array_compact(F.array(held, *words, *fields))
    return F.when(F.size(causes) > 0, causes).when(r.isin(*SAFE_REASONS), F.array().cast("array<string>")).otherwise(F.array(F.lit("unclassified_reason")))


def merge_items(items: DataFrame, order: str, lists: tuple[str, ...]) -> DataFrame:
    """One row of each exact review target: how often it was shown, and each list's values in order of first appearance.

    A value listed twice stands once.  Values are made distinct by key before they are gathered, so
    a target shown very often costs its distinct values only.
    """
    key = [F.coalesce(F.col(k).cast("string"), F.lit("")).alias(k) for k in ITEM_KEY]
    rows = items.select(*key, order, *lists)
    out = rows.groupBy(*ITEM_KEY).agg(F.count(F.lit(1)).alias("copies"))
    for name in lists:
        seen = rows.select(*ITEM_KEY, order, F.posexplode(name).alias("place", "value"))
        first = seen.groupBy(*ITEM_KEY, "value").agg(F.min(F.struct(order, "place")).alias("at"))
        listed = F.transform(F.sort_array(F.collect_list(F.struct("at", "value"))), lambda x: x["value"])
        out = out.join(first.groupBy(*ITEM_KEY).agg(listed.alias(name)), list(ITEM_KEY), "left")
    return out.select(*ITEM_KEY, "copies", *(F.coalesce(F.col(n), F.array().cast(items.schema[n].dataType)).alias(n) for n in lists))


def review_clusters(items: DataFrame, item_id: str, shown: int = 5) -> DataFrame:
    """Items by (reason, field, protected), with the first ``shown`` ids; a protected cluster allows no batch decision.

    ``items`` has reason, field, document_id and protected; its three keys name a cluster.
    """
    rows = items.withColumns({"reason": F.coalesce("reason", F.lit("review_required")), "field": F.coalesce("field", F.lit(""))})
    key = ["reason", "field", "protected"]
    sums = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("items"), F.countDistinct("document_id").alias("documents"))
    ranked = rows.withColumn("_k", F.row_number().over(Window.partitionBy(*key).orderBy(item_id))).filter(F.col("_k") <= shown)
    first = ranked.groupBy(*key).agg(F.sort_array(F.collect_list(item_id)).alias("representatives"))
    return sums.join(first, key, "left").withColumn("batch_decision_allowed", ~F.col("protected"))


def carry_forward(items: DataFrame) -> DataFrame:
    """Explicit proposals that nothing protects leave the queue; the reader's own confidence is no term.

    ``items`` has protected, decision and proposal (null where there is none).
    """
    safe = ~F.col("protected") & (F.col("decision") == "propose_resolution") & F.col("proposal").isNotNull()
    return items.filter(safe).withColumns({"disposition": F.lit("safe_carry_forward_proposal"), "client_review_required": F.lit(False)})


def answer_exceptions(exceptions: DataFrame, answers: DataFrame, authorization: str) -> DataFrame:
    """Findings whose (document_id, field) is answered need no review any more and carry the authorization; all stay.

    A finding that needed none already, and a null document or field, stay as they are.
    """
    named = answers.select("document_id", "field").distinct().withColumn("_answered", F.lit(True))
    out = exceptions.join(named, ["document_id", "field"], "left")
    needed = F.coalesce(F.col("client_review_required"), F.lit(True))
    answered = needed & F.col("_answered").isNotNull()
    return out.withColumns({"client_review_required": needed & ~answered, "authorization_id": F.when(answered, F.lit(authorization))}).drop("_answered")


def simulated_approval(items: DataFrame) -> DataFrame:
    """Every item approved in a projection that approves nothing: production review stays required."""
    return items.withColumns({"simulated_client_decision": F.lit("approve"), "simulated_accepted": F.lit(True), "production_client_review_required": F.lit(True)})


def simulated_gate(simulated: DataFrame) -> DataFrame:
    """What a downstream gate may say of a simulation: items approved in it, and no production fact."""
    return simulated.agg(F.count(F.lit(1)).alias("simulated_approved_items"), F.lit(0).cast("long").alias("production_facts_approved"), F.lit("not_loaded_simulation_only").alias("production_retrieval_status"))


# Who may approve, and what an entry approved by each is called.
AUTHORITIES = {"client": "client_approved", "engagement_owner": "engagement_owner_approved"}


def approval_provenance(decisions: DataFrame) -> DataFrame:
    """(decision_id, status, approval_authority, approved_by, reason): who approved each decision, or why it stands for nothing.

    A null authority is the client's.  An engagement owner has to be named, as the client did not decide; a blank name counts
    as none.  An unknown authority approves nothing.  Refused rows have no status.
    """
    who = F.nullif(F.trim("approved_by"), F.lit(""))
    by = F.coalesce("approval_authority", F.lit("client"))
    reason = F.when(~by.isin(*AUTHORITIES), "unknown_approval_authority").when((by == "engagement_owner") & who.isNull(), "engagement_owner_not_named")
    status = F.create_map(*(F.lit(x) for kv in AUTHORITIES.items() for x in kv))[by]
    return decisions.select("decision_id", F.when(reason.isNull(), status).alias("status"), by.alias("approval_authority"), who.alias("approved_by"), reason.alias("reason"))
