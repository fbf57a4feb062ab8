"""Registered queries of the graph's build: orders are two artifacts of records, parts are proposals, nations are decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from .operators import graph_build
from .registry import register


def _graph(d):
    k, src = F.col("o_orderkey"), lambda a, i: (F.lit(a).alias("artifact_id"), F.lit("sha " + a).alias("artifact_sha256"), i.alias("index"), F.concat(F.lit("/records/"), i).alias("pointer"))
    o = d.raw("orders")
    doc = F.when(k % 17 != 0, F.concat(F.lit("D"), k))
    cell = lambda f, v: F.struct(F.lit(f).alias("field"), v.cast("string").alias("value"), F.lit(True).alias("accepted"))
    fields = F.array(cell("header.po_number", F.concat(F.lit("PO"), "o_custkey")), cell("header.amount", F.when(k % 5 != 0, F.col("o_totalprice").cast("decimal(16,2)"))))
    record = lambda df, a, status, cells: df.select(*src(a, k), doc.alias("document_id"), F.col("o_orderstatus").alias("document_type"), status.alias("review_status"), cells.alias("fields"))
    none = F.lit(None).cast("array<struct<field:string,value:string,accepted:boolean>>")
    records = record(o, "a-consensus", F.lit("clear"), fields).unionByName(record(o.filter(k % 3 == 0), "b-validated", F.when(k % 6 == 0, "needs_review").otherwise("clear"), none))
    p = F.col("p_partkey")
    flags = {c: p % 7 != 0 for c in graph_build.REQUIRED} | {c: p % 5 == 0 for c in graph_build.DISQUALIFYING}
    status = F.when(p % 4 == 0, "close").when(p % 4 == 1, "matched").when(p % 4 == 2, "confirmed")
    proposals = d.raw("part").select(*src("c-proposals", p), F.concat(F.lit("D"), p * 9).alias("document_id"), F.lit("brand").alias("candidate_type"), F.when(p % 11 != 0, F.col("p_brand")).alias("candidate_value"), F.lit("").alias("evidence_quote"), status.alias("status"), *(v.alias(c) for c, v in flags.items()))
    decisions = d.raw("nation").select(*src("d-decisions", F.col("n_nationkey")), F.col("n_regionkey").alias("decision_id"), F.col("n_name").alias("choice"), F.lit(None).cast("string").alias("note"))
    artifacts = d.spark.createDataFrame([(a,) for a in ("a-consensus", "b-validated", "c-proposals", "d-decisions")], "artifact_id string")
    return graph_build.build(records, proposals, decisions, artifacts)


_BASE = """o AS (SELECT o_orderkey AS k, o_custkey AS c FROM orders WHERE o_orderkey % 17 <> 0),
p AS (SELECT p_partkey AS p, p_partkey * 9 AS k, CASE p_partkey % 4 WHEN 0 THEN 'close_needs_review' WHEN 3 THEN 'proposed' ELSE CASE WHEN p_partkey % 7 <> 0 AND p_partkey % 5 <> 0 THEN 'inferred_high_confidence' ELSE 'proposed' END END AS state FROM part WHERE p_partkey % 11 <> 0),
n AS (SELECT n_regionkey AS r, count(DISTINCT n_name) AS names FROM nation GROUP BY 1)"""


@register("graph_built_nodes", f"""WITH {_BASE}, x AS (SELECT 'document' AS node_type, 'observed' AS approval_state, k % 6 = 0 AS protected FROM o UNION ALL SELECT 'field_claim', 'observed', false FROM o UNION ALL SELECT 'field_claim', 'observed', false FROM o WHERE k % 5 <> 0
 UNION ALL SELECT 'reference', 'observed', false FROM (SELECT DISTINCT c FROM o) UNION ALL SELECT 'proposal', state, state = 'close_needs_review' FROM p UNION ALL SELECT 'client_decision', 'proposed', names > 1 FROM n)
SELECT node_type, approval_state, protected, count(*) AS nodes FROM x GROUP BY ALL""")
def _(d):
    return _graph(d)["nodes"].groupBy("node_type", "approval_state", "protected").agg(F.count("*").alias("nodes"))


@register("graph_built_edges", f"""WITH {_BASE} SELECT 'document_has_claim' AS edge_type, 'observed' AS approval_state, count(*) + count(*) FILTER (WHERE k % 5 <> 0) AS edges FROM o UNION ALL SELECT 'document_references', 'proposed', count(*) FROM o
UNION ALL SELECT 'proposal_about_document', 'proposed', count(*) FROM p SEMI JOIN o USING (k)""")
def _(d):
    return _graph(d)["edges"].groupBy("edge_type", "approval_state").agg(F.count("*").alias("edges"))


@register("graph_build_exceptions", f"""WITH {_BASE}, x AS (SELECT 'graph_missing_document_id' AS reason, 'a-consensus' AS artifact_id FROM orders WHERE o_orderkey % 17 = 0 UNION ALL SELECT 'graph_missing_document_id', 'b-validated' FROM orders WHERE o_orderkey % 17 = 0 AND o_orderkey % 3 = 0
 UNION ALL SELECT 'graph_missing_endpoint', 'c-proposals' FROM part WHERE p_partkey % 11 = 0 UNION ALL SELECT 'graph_node_property_conflict', 'b-validated' FROM o WHERE k % 6 = 0
 UNION ALL SELECT 'graph_node_property_conflict', 'd-decisions' FROM nation a WHERE n_name <> (SELECT arg_min(n_name, n_nationkey) FROM nation b WHERE b.n_regionkey = a.n_regionkey)
 UNION ALL SELECT 'graph_edge_endpoint_missing', NULL FROM p ANTI JOIN o USING (k) UNION ALL SELECT 'graph_source_artifact_contributed_no_nodes', 'b-validated')
SELECT reason, artifact_id, count(*) AS rows FROM x GROUP BY ALL""")
def _(d):
    return _graph(d)["exceptions"].groupBy("reason", "artifact_id").agg(F.count("*").alias("rows"))


@register("graph_provenance_of_references", f"WITH {_BASE} SELECT 'reference:PO' || c AS owner, count(*) AS sources FROM o GROUP BY c")
def _(d):
    return _graph(d)["provenance"].filter(F.col("owner").startswith("reference:")).groupBy("owner").agg(F.count("*").alias("sources"))
