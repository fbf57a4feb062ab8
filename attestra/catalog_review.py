"""Registered queries of the review chain, sample results, column faults, printed rows and party spellings."""

from __future__ import annotations

from pyspark.sql import functions as F

from .operators import arithmetic, entities, pages, recovery, review, sampling
from .registry import register
from .sources.driver_tables import twin

# ---- the review chain --------------------------------------------------------------------


_ITEMS = """SELECT 'D' || l_orderkey AS document_id, '' AS page_id, '' AS region_id, CASE WHEN l_returnflag = 'A' THEN 'notes' ELSE 'amount' END AS field,
 CASE WHEN l_suppkey % 3 = 0 THEN 'formatting_review' ELSE 'no_majority' END AS reason, l_linenumber AS ordinal, 'P' || l_partkey AS evidence, 'R' || l_orderkey || '-' || l_linenumber || '-' || l_partkey AS item_id FROM lineitem"""


def _items(d):
    line = d.raw("lineitem")
    reason = F.when(F.col("l_suppkey") % 3 == 0, "formatting_review").otherwise("no_majority")
    field = F.when(F.col("l_returnflag") == "A", "notes").otherwise("amount")
    item = F.concat(F.lit("R"), "l_orderkey", F.lit("-"), "l_linenumber", F.lit("-"), "l_partkey")
    return line.select(F.concat(F.lit("D"), "l_orderkey").alias("document_id"), F.lit(None).cast("string").alias("page_id"), F.lit("").alias("region_id"), field.alias("field"), reason.alias("reason"), F.col("l_linenumber").alias("ordinal"), F.array(F.concat(F.lit("P"), "l_partkey")).alias("evidence"), item.alias("item_id"))


@register("review_items_merged", f"""WITH i AS ({_ITEMS}), v AS (SELECT document_id, page_id, region_id, field, reason, evidence, min(ordinal) AS o, count(*) AS n FROM i GROUP BY ALL)
SELECT document_id, page_id, region_id, field, reason, CAST(sum(n) AS BIGINT) AS copies, string_agg(evidence, ',' ORDER BY o, evidence) AS evidence FROM v GROUP BY ALL""")
def _(d):
    return review.merge_items(_items(d), "ordinal", ("evidence",)).withColumn("evidence", F.array_join("evidence", ","))


@register("review_clusters", f"""WITH i AS (SELECT *, NOT (reason = 'formatting_review' AND field = 'notes') AS protected FROM ({_ITEMS}) q), k AS (SELECT *, row_number() OVER (PARTITION BY reason, field, protected ORDER BY item_id) AS r FROM i)
SELECT reason, field, protected, count(*) AS items, count(DISTINCT document_id) AS documents, string_agg(CASE WHEN r <= 5 THEN item_id END, ',' ORDER BY item_id) AS representatives, NOT protected AS batch_decision_allowed FROM k GROUP BY reason, field, protected""")
def _(d):
    rows = _items(d).withColumn("protected", F.size(review.protection(F.col("reason"), F.col("field"))) > 0)
    return review.review_clusters(rows, "item_id").withColumn("representatives", F.array_join("representatives", ","))


@register("review_carried_forward", f"""SELECT item_id, 'safe_carry_forward_proposal' AS disposition, false AS client_review_required FROM ({_ITEMS}) q
 WHERE reason = 'formatting_review' AND field = 'notes' AND ordinal % 2 = 0 AND ordinal <> 4""")
def _(d):
    decision = F.when(F.col("ordinal") % 2 == 0, "propose_resolution").otherwise("keep")
    rows = _items(d).withColumns({"protected": F.size(review.protection(F.col("reason"), F.col("field"))) > 0, "decision": decision, "proposal": F.when(F.col("ordinal") != 4, F.lit("{}"))})
    return review.carry_forward(rows).select("item_id", "disposition", "client_review_required")


@register("exceptions_answered", f"""SELECT item_id, coalesce(ordinal <> 3, true) AND NOT (o.k IS NOT NULL) AS client_review_required, CASE WHEN ordinal <> 3 AND o.k IS NOT NULL THEN 'A-1' END AS authorization_id
 FROM ({_ITEMS}) q LEFT JOIN (SELECT 'D' || o_orderkey AS k FROM orders WHERE o_orderkey % 4 = 0) o ON q.document_id = o.k AND q.field = 'amount'""")
def _(d):
    answers_ = d.raw("orders").filter("o_orderkey % 4 = 0").select(F.concat(F.lit("D"), "o_orderkey").alias("document_id"), F.lit("amount").alias("field"))
    rows = _items(d).withColumn("client_review_required", F.when(F.col("ordinal") == 3, F.lit(False)))
    return review.answer_exceptions(rows, answers_, "A-1").select("item_id", "client_review_required", "authorization_id")


@register("simulated_approval_gate", "SELECT count(*) AS simulated_approved_items, CAST(0 AS BIGINT) AS production_facts_approved, 'not_loaded_simulation_only' AS production_retrieval_status FROM lineitem")
def _(d):
    return review.simulated_gate(review.simulated_approval(_items(d)))


# ---- sampling frame and results ----------------------------------------------------------


@register("sampling_frame", """SELECT CASE WHEN o_orderstatus <> 'F' THEN 'not_auto_accepted' WHEN o_orderkey % 5 = 0 THEN 'arithmetic_not_clear' END AS outside, count(*) AS documents FROM orders GROUP BY 1""")
def _(d):
    status = F.when(F.col("o_orderstatus") == "F", "auto_accepted").when(F.col("o_orderstatus") == "P", "needs_review")
    clear = F.when(F.col("o_orderkey") % 5 == 0, "failed").when(F.col("o_orderkey") % 2 == 0, "proved").otherwise("not_applicable")
    return d.raw("orders").groupBy(sampling.outside_frame(status, clear).alias("outside")).agg(F.count("*").alias("documents"))


@register("sample_results_all", "SELECT CASE WHEN o_orderkey % 10 = 0 THEN 'missing' WHEN o_orderkey % 7 = 0 THEN 'unresolved' WHEN o_orderkey % 6 = 0 THEN 'outcome_contradicts_value' ELSE 'complete' END AS state, count(*) AS documents FROM orders GROUP BY 1")
def _(d):
    k, v = F.col("o_orderkey"), F.col("o_totalprice").cast("double")
    orders = d.raw("orders")
    given = orders.filter(k % 10 != 0).select(k.alias("ordinal"), k.cast("string").alias("document_id"), v.alias("recorded"), F.when(k % 6 == 0, v + 1).otherwise(v).alias("audited"), F.when(k % 7 == 0, "failed").otherwise("reviewed_correct").alias("outcome"))
    return sampling.reconcile_results(orders.select(k.cast("string").alias("document_id"), v.alias("value")), given).groupBy("state").agg(F.count("*").alias("documents"))


# ---- columns that hold the wrong number --------------------------------------------------


@register("commission_equals_base", twin("SELECT base, count(*) AS lines FROM (SELECT CASE WHEN suppkey % 4 = 0 THEN 'invoice_amount' WHEN suppkey % 4 = 1 THEN 'extended_amount' END AS base FROM invoice_line WHERE extended_amount > 0) GROUP BY 1", "invoice_line"))
def _(d):
    e = F.col("extended_amount")
    bases = {"commissionable_amount": F.when(F.col("suppkey") % 4 == 2, e + 3), "invoice_amount": F.when(F.col("suppkey") % 4 == 0, e), "extended_amount": F.when(F.col("suppkey") % 4 != 2, e).otherwise(F.lit(0))}
    commission = F.when(F.col("suppkey") % 4 == 3, F.lit(0)).otherwise(e)
    return d.invoice_line().filter("extended_amount > 0").groupBy(arithmetic.commission_is_base(commission, bases).alias("base")).agg(F.count("*").alias("lines"))


@register("relabelled_not_provable", """SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'not_provable' END AS prior_arithmetic_status, CASE WHEN o_orderkey % 3 = 0 THEN 'not_applicable' WHEN o_orderkey % 3 = 1 THEN 'failed' ELSE 'proved' END AS arithmetic_status,
 CASE WHEN o_orderkey % 3 = 0 THEN 'A-2' END AS arithmetic_status_authorization, count(*) AS documents FROM orders GROUP BY ALL""")
def _(d):
    k = F.col("o_orderkey") % 3
    rows = d.raw("orders").select(F.when(k == 0, "not_provable").when(k == 1, "failed").otherwise("proved").alias("arithmetic_status"))
    return arithmetic.relabel_not_provable(rows, "A-2").groupBy("prior_arithmetic_status", "arithmetic_status", "arithmetic_status_authorization").agg(F.count("*").alias("documents"))


# ---- codes on printed rows, events, spellings --------------------------------------------


@register("party_of_reading", twin("""SELECT 'lines[' || (o_orderkey % 4) || '].customer_name' AS field, upper(c_name) AS reading, c_name AS canonical_name, 'C' || min(f) AS party_key, count(*) AS readings
 FROM orders JOIN (SELECT c_custkey, c_name, min(c_custkey) OVER (PARTITION BY lower(trim(c_name))) AS f FROM customer) ON c_custkey = o_custkey GROUP BY 1, 2, 3
 UNION ALL SELECT 'header.note', c_name, NULL, NULL, count(*) FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY c_name""", "party"))
def _(d):
    c = d.raw("customer").select(F.col("c_custkey").alias("ordinal"), F.concat(F.lit("C"), "c_custkey").alias("party_key"), F.col("c_name").alias("canonical_name"), F.array(F.concat(F.lit(" "), F.lower("c_name"))).alias("name_variants"))
    read = d.raw("orders").join(d.raw("customer"), F.col("c_custkey") == F.col("o_custkey"))
    line = read.select(F.concat(F.lit("lines["), F.col("o_orderkey") % 4, F.lit("].customer_name")).alias("field"), F.upper("c_name").alias("reading"))
    note = read.select(F.lit("header.note").alias("field"), F.col("c_name").alias("reading"))
    return entities.party_of_reading(line.unionByName(note), c).groupBy("field", "reading", "canonical_name", "party_key").agg(F.count("*").alias("readings"))


@register("pages_by_document", "SELECT 'p' || lpad(CAST(page_id % 50 AS VARCHAR), 4, '0') AS page, count(*) AS documents FROM pages GROUP BY 1")
def _(d):
    named = F.concat(F.lit("file__part__p"), F.lpad((F.col("page_id") % 50).cast("string"), 4, "0"))
    return d.raw("pages").groupBy(pages.page_of(named).alias("page")).agg(F.count("*").alias("documents"))


# ---- recovered names ---------------------------------------------------------------------


@register("cut_off_parts", """WITH n AS (SELECT DISTINCT CASE WHEN p_partkey % 5 = 0 THEN left(p_name, 1 + p_partkey % 9) ELSE p_name END AS name FROM part), s AS (SELECT name, trim(regexp_replace(lower(name), '[^a-z0-9]+', ' ', 'g')) AS short FROM n),
 w AS (SELECT DISTINCT short FROM s), c AS (SELECT DISTINCT s.name, s.short, w.short AS longer FROM s JOIN w ON w.short <> s.short AND starts_with(w.short, s.short) WHERE s.short <> '')
 SELECT name, CASE WHEN bool_or(longer[length(short) + 1] <> ' ') THEN 'continued_in_mid_word' ELSE 'begins_several_names' END AS why FROM c GROUP BY name, short
 HAVING bool_or(longer[length(short) + 1] <> ' ') OR (NOT contains(short, ' ') AND count(DISTINCT split_part(longer, ' ', 2)) > 1)""")
def _(d):
    k = F.col("p_partkey")
    name = F.when(k % 5 == 0, F.expr("left(p_name, cast(1 + p_partkey % 9 as int))")).otherwise(F.col("p_name"))
    return recovery.cut_off_names(d.raw("part").select(name.alias("name")).distinct(), "name")


