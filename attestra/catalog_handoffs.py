"""Registered queries of handoffs: orders read in four lanes, of which one is sound."""

from __future__ import annotations

from pyspark.sql import functions as F

from .registry import register
from .sources import handoffs

_LANES = (("a", "openai", "m1", "consensus_primary"), ("b", "google", "m2", "consensus_secondary"), ("c", "openrouter", "ink/m3", "consensus_tiebreaker"), ("d", "openrouter", "openai/m1", "consensus_primary"))


def _handoffs(d):
    k, lanes = F.col("o_orderkey"), d.spark.createDataFrame([(h, handoffs.PREFIXES[p] + m, m) for h, p, m, _ in _LANES], "handoff string, engine string, engine_version string")
    base = d.raw("orders").crossJoin(F.broadcast(lanes))  # four lanes
    path = F.concat(F.lit("raw/"), "handoff", F.lit("/"), k)
    h = F.col("handoff")
    records = base.select(
        "handoff", F.when((h != "b") | (k % 80 != 0), F.concat(F.lit("D"), F.when((h == "c") & (k % 90 == 1), k - 1).otherwise(k))).alias("document_id"), "engine", F.when((h == "d") & (k % 40 == 0), "m0").otherwise(F.col("engine_version")).alias("engine_version"),
        path.alias("raw_response"), F.sha2(path, 256).alias("raw_sha256"), F.sha2(k.cast("string"), 256).alias("page_sha256"), F.when(k % 7 == 0, "open_exception").otherwise("clear").alias("review_status"), F.when(k % 11 == 0, F.array(F.lit("Handwritten note"))).alias("flags"), F.col("o_totalprice").cast("string").alias("payload"),
    )
    raw = base.filter((h != "c") | (k % 70 != 0)).select(path.alias("path"), F.sha2(F.when((h == "b") & (k % 50 == 0), "changed").otherwise(path), 256).alias("sha256"))
    head = d.spark.createDataFrame([(h, i, handoffs.SCHEMA, handoffs.ADAPTER, p, handoffs.PREFIXES[p] + m, m, None, p, handoffs.READ_BY_MODEL, lane, True, "notes") for i, (h, p, m, lane) in enumerate(_LANES)], "handoff string, ordinal int, schema_version string, adapter_type string, provider string, engine string, model string, configured_model string, independence_group string, source_read_by string, lane string, raw_retention boolean, context_sha256 string")
    head = head.join(handoffs.digests(records), "handoff", "left").withColumn("records_digest", F.when(h == "c", "0").otherwise(F.col("digest"))).drop("digest")
    return handoffs.load(head, records, raw, ("consensus_primary", "consensus_review"), comment_only=True)


@register("handoff_findings", """WITH f AS (SELECT 'd' AS handoff, 'duplicate_vendor' AS reason UNION ALL SELECT 'c', 'records_digest_mismatch' UNION ALL SELECT NULL, 'handoff_missing:consensus_review' UNION ALL SELECT 'd', 'record_engine_does_not_match_handoff' FROM orders WHERE o_orderkey % 40 = 0
UNION ALL SELECT 'b', CASE WHEN o_orderkey % 50 = 0 THEN 'record_raw_response_changed' ELSE 'record_has_no_document_id' END FROM orders WHERE o_orderkey % 50 = 0 OR o_orderkey % 80 = 0
UNION ALL SELECT 'c', CASE WHEN o_orderkey % 70 = 0 THEN 'record_raw_evidence_invalid' ELSE 'duplicate_engine_for_document' END FROM orders o WHERE o_orderkey % 70 = 0 OR o_orderkey % 90 = 1 AND o_orderkey - 1 IN (SELECT o_orderkey FROM orders) OR o_orderkey % 90 = 0 AND o_orderkey + 1 IN (SELECT o_orderkey FROM orders))
SELECT handoff, reason, count(*) AS rows FROM f GROUP BY ALL""")
def _(d):
    return _handoffs(d)[1].groupBy("handoff", "reason").agg(F.count("*").alias("rows"))


@register("handoff_readings", "SELECT 'D' || o_orderkey AS document_id, 'openai/m1' AS engine, 'openai' AS vendor, CAST(o_totalprice AS DOUBLE) AS payload, o_orderkey % 7 = 0 AS provider_blocked FROM orders")
def _(d):
    return _handoffs(d)[0].select("document_id", "engine", "vendor", F.col("payload").cast("double").alias("payload"), "provider_blocked")
