"""Registered queries of the golden set's acceptance and of cells that a load target would take wrongly."""

from __future__ import annotations

from pyspark.sql import functions as F

from .operators import acceptance, load_checks, loading, review
from .registry import register
from .sources.driver_tables import twin

# ---- golden set: documents, their language to be told, most of them predicted ------------------------------


def _golden(d):
    k = F.col("doc_id")
    docs = d.raw("documents").withColumn("source", F.coalesce("source", F.lit("none")))
    checked = lambda m: F.when(k % m == 0, "pass")
    truth = docs.select(k.alias("item_id"), "source", F.col("lang").alias("expected_value"), (k % 8 == 0).alias("protected"), (k % 6 == 0).alias("expected_review_required"), (k % 3 == 0).alias("baseline_review_required"), checked(4).alias("expected_arithmetic_status"), checked(5).alias("expected_completeness_status"))
    status = F.when(k % 9 == 0, "abstained").otherwise("predicted")
    pred = docs.filter("doc_id % 10 <> 3").select((k + F.when(k % 37 == 0, 10_000_000).otherwise(0)).alias("item_id"), F.when(k % 2 == 0, "reader").alias("provider"), status.alias("status"), F.when(F.col("n_chars") > 3000, "en").otherwise(F.col("lang")).alias("predicted_value"), (k % 12 == 0).alias("review_required"), ((k % 4 == 1) & (k % 9 != 0) | (k % 16 == 8) & (k % 9 != 0) & (k % 12 != 0)).alias("auto_accepted"), F.when(k % 28 != 0, "pass").otherwise("fail").alias("arithmetic_status"), F.lit("pass").alias("completeness_status"), (k % 50).alias("milliseconds"))
    return truth, pred


_GOLDEN = """t AS (SELECT doc_id AS item_id, coalesce(source, 'none') AS source, lang AS e, doc_id % 8 = 0 AS protected, doc_id % 6 = 0 AS er, doc_id % 3 = 0 AS br, doc_id % 4 = 0 AS ac, doc_id % 5 = 0 AS cc FROM documents),
p AS (SELECT doc_id + CASE WHEN doc_id % 37 = 0 THEN 10000000 ELSE 0 END AS item_id, CASE WHEN doc_id % 2 = 0 THEN 'reader' ELSE 'unreported' END AS provider, doc_id % 9 <> 0 AS said, CASE WHEN n_chars > 3000 THEN 'en' ELSE lang END AS v, doc_id % 12 = 0 AS rr,
 doc_id % 9 <> 0 AND (doc_id % 4 = 1 OR doc_id % 16 = 8 AND doc_id % 12 <> 0) AS aa, doc_id % 28 <> 0 AS fine, doc_id % 50 AS ms FROM documents WHERE doc_id % 10 <> 3),
j AS (SELECT t.*, coalesce(provider, 'unreported') AS provider, p.item_id IS NOT NULL AS present, coalesce(said, false) AS predicted, coalesce(said AND v IS NOT DISTINCT FROM e, false) AS correct, coalesce(rr, false) AS review, coalesce(aa, false) AS auto,
 ac AND NOT coalesce(fine, false) AS ae, cc AND p.item_id IS NULL AS ce, coalesce(ms, 0) AS ms FROM t LEFT JOIN p ON t.item_id = p.item_id)"""
_FIGURES = """count(*) AS items, count(*) FILTER (present) AS predictions_present, count(*) FILTER (predicted) AS predicted_values, count(*) FILTER (correct) AS correct_values, count(*) FILTER (NOT predicted) AS abstentions_or_failures, count(*) FILTER (auto) AS auto_accepted, count(*) FILTER (auto AND correct) AS correct_auto_accepted,
count(*) FILTER (auto AND NOT correct) AS false_auto_accepts, count(*) FILTER (auto AND (protected OR er)) AS protected_category_escapes, count(*) FILTER (er) AS expected_review_items, count(*) FILTER (er AND review) AS expected_review_captured, count(*) FILTER (br) AS baseline_review_items, count(*) FILTER (review) AS predicted_review_items,
count(*) FILTER (ac) AS arithmetic_status_checks, count(*) FILTER (ae) AS arithmetic_status_errors, count(*) FILTER (cc) AS completeness_status_checks, count(*) FILTER (ce) AS completeness_status_errors, CAST(sum(ms) AS BIGINT) AS milliseconds"""
_RATIOS = ", ".join(f"{a} / nullif({b}, 0) AS {n}" for n, a, b in acceptance.RATIOS) + ", (baseline_review_items - predicted_review_items) / nullif(baseline_review_items, 0) AS review_reduction_rate"


def _rows(d):
    truth, pred = _golden(d)
    return truth, pred, acceptance.compared(truth, pred, ("source",), ("milliseconds",))


@register("golden_figures", f"""WITH {_GOLDEN}, l AS (SELECT *, 'overall' AS dimension, 'all' AS member FROM j UNION ALL SELECT *, 'source', source FROM j UNION ALL SELECT *, 'provider', provider FROM j), s AS (SELECT dimension, member, {_FIGURES} FROM l GROUP BY ALL) SELECT *, {_RATIOS} FROM s""")
def _(d):
    return acceptance.summary(_rows(d)[2], ("source", "provider"), ("milliseconds",))


@register("golden_checks", f"""WITH {_GOLDEN}, s AS (SELECT {_FIGURES} FROM j), r AS (SELECT *, {_RATIOS}, (SELECT count(*) FROM p ANTI JOIN t USING (item_id)) AS unexpected FROM s)
SELECT 'precision' AS "check", CAST(precision AS DOUBLE) AS value, precision >= 0.9 AS passed FROM r UNION ALL SELECT 'recall', recall, recall >= 0.5 FROM r UNION ALL SELECT 'coverage', coverage, coverage >= 0.99 FROM r UNION ALL SELECT 'false_auto_accepts', false_auto_accepts, false_auto_accepts <= 0 FROM r
UNION ALL SELECT 'protected_category_escapes', protected_category_escapes, protected_category_escapes <= 0 FROM r UNION ALL SELECT 'expected_review_recall', expected_review_recall, coalesce(expected_review_recall = 1, true) FROM r UNION ALL SELECT 'arithmetic_status', arithmetic_status_errors, arithmetic_status_errors = 0 FROM r
UNION ALL SELECT 'completeness_status', completeness_status_errors, completeness_status_errors = 0 FROM r UNION ALL SELECT 'unexpected_predictions', unexpected, unexpected = 0 FROM r""")
def _(d):
    truth, pred, rows = _rows(d)
    return acceptance.checks(acceptance.summary(rows, ()), truth, pred, acceptance.Floors(0.9, 0.5, 0.99))


@register("golden_failures", f"""WITH {_GOLDEN}, f AS (SELECT item_id, CASE WHEN NOT present THEN 'golden_set_prediction_missing' WHEN auto AND (protected OR er) THEN 'golden_set_protected_category_escape' WHEN auto AND NOT correct THEN 'golden_set_false_auto_accept' WHEN er AND NOT review THEN 'golden_set_expected_review_not_captured'
 WHEN ae THEN 'golden_set_arithmetic_status_mismatch' WHEN ce THEN 'golden_set_completeness_status_mismatch' END AS reason, CASE WHEN protected THEN 'critical' ELSE 'high' END AS priority FROM j) SELECT * FROM f WHERE reason IS NOT NULL""")
def _(d):
    return acceptance.failures(_rows(d)[2])


# ---- load targets: contacts of documents' texts, keys of orders ----------------------------------------------


def _export(d):
    k = F.col("o_orderkey")
    phone = F.concat(F.lit("+1 (555) 555-"), F.lpad((k % 10000).cast("string"), 4, "0"))
    mail = F.concat(F.lit("clerk"), (k % 100).cast("string"), F.lit("@desk.example"))
    return d.raw("orders").select(
        F.concat(F.lit("D"), k).alias("document_id"), F.when(k % 5 == 0, F.concat(phone, F.lit(" / "), phone)).otherwise(phone).alias("contact_phone"), F.when(k % 7 == 0, F.concat(mail, F.lit("; "), mail)).otherwise(mail).alias("contact_email"),
        F.when(k % 11 == 0, "000-0").when(k % 13 == 0, " ").otherwise(F.concat(F.lit("CHK"), F.floor(k / 3).cast("string"))).alias("check_number"), F.when(k % 2 == 0, "CA").otherwise("Canada").alias("country_of_origin"),
        F.when(k % 17 == 0, F.concat(k.cast("string"), F.lit(" Long Mill Road"))).otherwise("Road bike").alias("description"), F.lit("Canada").alias("country__inferred_by"),
    )


@register("load_cell_issues", """SELECT reason, "column", count(*) AS cells FROM (SELECT 'multiple_values_in_a_single_valued_column' AS reason, 'contact_phone' AS "column" FROM orders WHERE o_orderkey % 5 = 0 UNION ALL SELECT 'multiple_values_in_a_single_valued_column', 'contact_email' FROM orders WHERE o_orderkey % 7 = 0
UNION ALL SELECT 'placeholder_standing_in_for_an_identity', 'check_number' FROM orders WHERE o_orderkey % 11 = 0 UNION ALL SELECT 'country_name_where_a_two_letter_code_belongs', 'country_of_origin' FROM orders WHERE o_orderkey % 2 <> 0
UNION ALL SELECT 'address_shaped_value_in_a_product_column', 'description' FROM orders WHERE o_orderkey % 17 = 0 AND o_orderkey < 1000000) q GROUP BY ALL""")
def _(d):
    return load_checks.cell_issues(_export(d), ["document_id"]).groupBy("reason", "column").agg(F.count("*").alias("cells"))


@register("load_shared_identities", """WITH c AS (SELECT 'CHK' || (o_orderkey // 3) AS value, 'D' || o_orderkey AS d FROM orders WHERE o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0)
SELECT 'check_number' AS "column", value, count(*) AS documents, string_agg(d, '; ' ORDER BY d) AS first FROM c GROUP BY value HAVING count(*) > 1""")
def _(d):
    return load_checks.shared_identities(_export(d))


# ---- what an export holds, and who approved decisions --------------------------------------------------------


@register("export_summary", twin("""WITH c AS (SELECT 'party' AS "table", count(*) AS records, 0 AS withheld FROM party UNION ALL SELECT 'invoice_header', count(*) FILTER (review_status = 'clear'), count(*) FILTER (review_status <> 'clear') FROM invoice_header UNION ALL SELECT 'invoice_line', count(*), 0 FROM invoice_line)
SELECT "table", records, CAST(withheld AS BIGINT) AS withheld, records = 0 AS empty FROM c UNION ALL SELECT 'all', CAST(sum(records) AS BIGINT), CAST(sum(withheld) AS BIGINT), sum(records) = 0 FROM c""", "party", "invoice_header", "invoice_line"))
def _(d):
    return loading.export_summary({"invoice_line": d.invoice_line(), "party": d.party(), "invoice_header": d.invoice_header()}, ["party", "invoice_header", "invoice_line", "shipment"])


@register("approval_provenance", """WITH c AS (SELECT c_custkey AS decision_id, CASE WHEN c_custkey % 3 = 0 THEN 'client' WHEN c_custkey % 3 = 1 THEN 'engagement_owner' WHEN c_custkey % 5 = 0 THEN 'anyone' ELSE 'client' END AS a, CASE WHEN c_custkey % 4 <> 0 THEN c_name END AS who FROM customer),
r AS (SELECT *, CASE WHEN a = 'anyone' THEN 'unknown_approval_authority' WHEN a = 'engagement_owner' AND who IS NULL THEN 'engagement_owner_not_named' END AS reason FROM c)
SELECT decision_id, CASE WHEN reason IS NULL THEN a || '_approved' END AS status, a AS approval_authority, who AS approved_by, reason FROM r""")
def _(d):
    k = F.col("c_custkey")
    authority = F.when(k % 3 == 1, "engagement_owner").when((k % 3 == 2) & (k % 5 == 0), "anyone").when(k % 6 == 0, "client")
    return review.approval_provenance(d.raw("customer").select(k.alias("decision_id"), authority.alias("approval_authority"), F.when(k % 4 == 0, " ").otherwise(F.col("c_name")).alias("approved_by")))
