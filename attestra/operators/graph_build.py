"""The evidence graph built from artifacts: nodes and edges named by their content, conflicts kept as rows, a hash without order.

Three families of artifact rows are read in one pass each.  All have artifact_id, artifact_sha256, index and pointer:
records (document_id, document_type, review_status, fields array<struct<field, value, accepted>>), proposals
(document_id, candidate_type, candidate_value, evidence_quote, status and the flags of :data:`REQUIRED` and
:data:`DISQUALIFYING`), decisions (decision_id, choice, note).
"""

from __future__ import annotations

from math import ceil, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Tokens of field names that carry a business reference, and the flags of a proposal.
REFERENCE_TOKENS = ("ack", "acknowledgement", "acknowledgment", "check", "claim", "job", "order", "payment", "po", "project", "remit", "remittance", "ro", "so", "wo")
REQUIRED = ("deterministic_evidence", "evidence_validated", "arithmetic_pass", "identity_pass")
DISQUALIFYING = ("protected_contradiction", "missing_authority_dependency")
#: Hashes that one bucket of a tree holds on average, and children of one of its nodes.
BUCKET, FAN = 256, 3

_FROM = ("artifact_id", "artifact_sha256", "index", "pointer")


def _json(**parts: Column) -> Column:
    """The one text of some properties: names in order, nulls kept."""
    return F.to_json(F.struct(*(parts[k].alias(k) for k in sorted(parts))), {"ignoreNullFields": "false"})


def _named(kind: str, *parts: Column) -> Column:
    return F.concat(F.lit(kind + ":"), F.sha2(F.to_json(F.array(*(p.cast("string") for p in parts)), {"ignoreNullFields": "false"}), 256))


def _stable(kind: str, value: Column) -> Column:
    return F.concat(F.lit(kind + ":"), value)


def is_reference(field: Column) -> Column:
    """Whether a field's name has a word that marks a business reference."""
    return F.arrays_overlap(F.split(F.lower(field), "[^a-z0-9]+"), F.array(*map(F.lit, REFERENCE_TOKENS)))


def proposal_state(status: Column) -> Column:
    """close_needs_review, inferred_high_confidence where every required flag is true and no disqualifying one is, else proposed."""
    true = lambda c: F.coalesce(F.col(c) == True, F.lit(False))  # noqa: E712,E731
    sound = F.lit(True)
    for c in REQUIRED:
        sound = sound & true(c)
    for c in DISQUALIFYING:
        sound = sound & ~true(c)
    return F.when(status.isin("close", "close_needs_review"), "close_needs_review").when(status.isin("matched", "confirmed") & sound, "inferred_high_confidence").otherwise("proposed")


def _filled(c: str) -> Column:
    return F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) != ""


def readings(records: DataFrame, proposals: DataFrame, decisions: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(node readings, edge readings, exceptions) before anything is merged; rows without an identity are exceptions."""
    node = lambda df, nid, kind, props, state, seq: df.select(nid.alias("node_id"), F.lit(kind).alias("node_type"), props.alias("properties"), state.alias("approval_state"), *_FROM, seq.alias("seq"))
    edge = lambda df, kind, a, b, state: df.select(F.lit(kind).alias("edge_type"), a.alias("from_node_id"), b.alias("to_node_id"), F.lit(state).alias("approval_state"), *_FROM)
    seen, asked = F.lit("observed"), F.lit("proposed")
    r = records.filter(_filled("document_id")).withColumn("d", _stable("document", F.col("document_id").cast("string")))
    claims = r.select("d", *_FROM, F.posexplode(F.coalesce("fields", F.array().cast(records.schema["fields"].dataType))).alias("at", "x")).filter("x.value is not null")
    f, v = F.col("x.field"), F.col("x.value")
    claim, ref = _named("claim", F.col("d"), f, v, F.col("artifact_id"), F.col("index")), _stable("reference", v)
    refs = claims.filter(is_reference(f) & (F.trim(v) != ""))
    p = proposals.filter(_filled("document_id") & (F.coalesce("candidate_value", F.lit("")) != ""))
    prop = _named("proposal", F.col("document_id"), F.col("candidate_type"), F.col("candidate_value"), F.col("artifact_id"), F.col("index"))
    c = decisions.filter(_filled("decision_id"))
    status = F.coalesce("status", F.lit("proposed"))
    nodes = [
        node(r, F.col("d"), "document", _json(document_type=F.col("document_type"), review_status=F.col("review_status")), seen, F.lit(0)),
        node(claims, claim, "field_claim", _json(subject_node_id=F.col("d"), field=f, value=v, accepted=F.col("x.accepted")), seen, F.col("at") * 2 + 1),
        node(refs, ref, "reference", _json(field=f, value=v, reference_only=F.lit(True)), seen, F.col("at") * 2 + 2),
        node(p, prop, "proposal", _json(candidate_type=F.col("candidate_type"), candidate_value=F.col("candidate_value"), evidence_quote=F.coalesce("evidence_quote", F.lit("")), status=status), proposal_state(status), F.lit(0)),
        node(c, _stable("client_decision", F.col("decision_id").cast("string")), "client_decision", _json(choice=F.col("choice"), note=F.col("note")), asked, F.lit(0)),
    ]
    edges = [edge(claims, "document_has_claim", F.col("d"), claim, "observed"), edge(refs, "document_references", F.col("d"), ref, "proposed"), edge(p, "proposal_about_document", prop, _stable("document", F.col("document_id").cast("string")), "proposed")]
    gone = lambda df, ok, why: df.filter(~ok).select(F.lit(why).alias("reason"), "artifact_id", "index", F.lit(None).cast("string").alias("subject"))
    bad = [
        gone(records, _filled("document_id"), "graph_missing_document_id"), gone(proposals, _filled("document_id") & (F.coalesce("candidate_value", F.lit("")) != ""), "graph_missing_endpoint"),
        gone(decisions, _filled("decision_id"), "graph_missing_endpoint"),
    ]
    return _union(nodes), _union(edges), _union(bad)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def build(records: DataFrame, proposals: DataFrame, decisions: DataFrame, artifacts: DataFrame) -> dict[str, DataFrame]:
    """nodes, edges, provenance and exceptions of the graph.

    Of several readings of a node the first by artifact and index is kept; every reading that differs from it
    is an exception, and the node is protected.  Edges of one type and ends are one edge; if their states differ it
    is proposed.  Edges without a node at an end are exceptions and no edges.  ``artifacts`` (artifact_id) names all that were
    loaded: one whose rows give no node that was not there before is an exception too.  Provenance is a table of its own,
    one row an owner and source, so no node gathers the sources of a common value.
    """
    node_rows, edge_rows, exceptions = readings(records, proposals, decisions)
    order = F.struct("artifact_id", "index", "seq")
    first = node_rows.groupBy("node_id").agg(F.min_by(F.struct("node_type", "properties", "approval_state", "artifact_id"), order).alias("f"))
    kept = first.select("node_id", "f.*")
    told = node_rows.join(kept.select("node_id", F.col("node_type").alias("t"), F.col("properties").alias("p")), "node_id").filter((F.col("node_type") != F.col("t")) | (F.col("properties") != F.col("p")))
    clash = told.select("node_id").distinct().withColumn("clash", F.lit(True))
    nodes = kept.join(clash, "node_id", "left").select("node_id", "node_type", "properties", "approval_state", (F.col("approval_state").isin("exception", "close_needs_review") | F.coalesce("clash", F.lit(False))).alias("protected"))
    conflicts = told.select(F.lit("graph_node_property_conflict").alias("reason"), "artifact_id", "index", F.col("node_id").alias("subject"))
    empty = artifacts.select("artifact_id").distinct().join(kept.select("artifact_id").distinct(), "artifact_id", "left_anti")
    idle = empty.select(F.lit("graph_source_artifact_contributed_no_nodes").alias("reason"), "artifact_id", F.lit(None).cast("long").alias("index"), F.lit(None).cast("string").alias("subject"))
    ends = ["edge_type", "from_node_id", "to_node_id"]
    named = edge_rows.withColumn("edge_id", _named("edge", *map(F.col, ends)))
    merged = named.groupBy("edge_id", *ends).agg(F.when(F.min("approval_state") == F.max("approval_state"), F.min("approval_state")).otherwise("proposed").alias("approval_state"))
    merged = merged.withColumn("protected", F.col("approval_state") != "approved")
    ids = nodes.select("node_id")
    lacks = merged.join(ids, merged["from_node_id"] == ids["node_id"], "left_anti").select("edge_id").unionByName(merged.join(ids, merged["to_node_id"] == ids["node_id"], "left_anti").select("edge_id")).distinct()
    edges = merged.join(lacks, "edge_id", "left_anti")
    loose = lacks.select(F.lit("graph_edge_endpoint_missing").alias("reason"), F.lit(None).cast("string").alias("artifact_id"), F.lit(None).cast("long").alias("index"), F.col("edge_id").alias("subject"))
    source = ("artifact_id", "artifact_sha256", "pointer")
    provenance = node_rows.select(F.col("node_id").alias("owner"), *source).unionByName(named.join(edges.select("edge_id"), "edge_id", "left_semi").select(F.col("edge_id").alias("owner"), *source)).distinct()
    return {"nodes": nodes, "edges": edges, "provenance": provenance, "exceptions": _union([exceptions.withColumn("index", F.col("index").cast("long")), conflicts.withColumn("index", F.col("index").cast("long")), idle, loose])}


def table_hash(df: DataFrame) -> str:
    """A hash of a table's rows, repeats counted, that does not hang on their order.

    Rows are hashed, gathered by the leading digits of their hashes, and rolled up level by level.  How many digits
    follows from the count, so what one bucket gathers is bounded.
    """
    rows = df.select(F.sha2(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}), 256).alias("h"))
    digits = max(1, ceil(log(max(rows.count() / BUCKET, 1), 16)))
    at = rows.groupBy(F.substring("h", 1, digits).alias("k")).agg(F.sha2(F.array_join(F.sort_array(F.collect_list("h")), ""), 256).alias("h"))
    while digits:
        digits = max(0, digits - FAN)
        child = F.concat("k", F.lit("="), "h")
        at = at.groupBy(F.expr(f"left(k, {digits})").alias("k")).agg(F.sha2(F.array_join(F.sort_array(F.collect_list(child)), ""), 256).alias("h"))
    got = at.first()
    return got.h if got else ""


def graph_hash(graph: dict[str, DataFrame], run_id: str) -> str:
    """The hash of all that a graph retains, bound to its run."""
    from hashlib import sha256

    return sha256("\n".join([run_id, *(f"{k} {table_hash(graph[k])}" for k in sorted(graph))]).encode()).hexdigest()


def faults(graph: dict[str, DataFrame]) -> DataFrame:
    """(fault, id): identifiers that stand twice or are empty, edges without a node at an end, edges whose name is not their content's."""
    nodes, edges = graph["nodes"], graph["edges"]

    def twice(df: DataFrame, c: str) -> DataFrame:
        return df.groupBy(c).agg(F.count(F.lit(1)).alias("n")).filter(f"n > 1 or coalesce(trim({c}), '') = ''").select(F.lit(f"{c}_not_unique").alias("fault"), F.col(c).alias("id"))

    ids = nodes.select("node_id")
    loose = lambda end: edges.join(ids, edges[end] == ids["node_id"], "left_anti").select(F.lit("edge_endpoint_missing").alias("fault"), F.col("edge_id").alias("id"))
    renamed = edges.filter(F.col("edge_id") != _named("edge", *map(F.col, ("edge_type", "from_node_id", "to_node_id")))).select(F.lit("edge_id_not_its_content").alias("fault"), F.col("edge_id").alias("id"))
    return _union([twice(nodes, "node_id"), twice(edges, "edge_id"), loose("from_node_id"), loose("to_node_id"), renamed]).distinct()


def load_graph(graph: dict[str, DataFrame], run_id: str, expected_hash: str) -> dict[str, DataFrame]:
    """The graph, if its content hashes to what was retained and its ends and names hold; else an error."""
    if graph_hash(graph, run_id) != expected_hash:
        raise ValueError("the graph is not the one that was hashed")
    bad = faults(graph).limit(5).collect()
    if bad:
        raise ValueError("the graph does not hold together: " + ", ".join(f"{b.fault} {b.id}" for b in bad))
    return graph
