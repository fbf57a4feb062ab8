"""The graph of three artifact shapes against a plain build; a tampered one is refused."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from attestra.operators import graph_build as gb

SOURCE = "artifact_id string, artifact_sha256 string, index long, pointer string"
RECORD = SOURCE + ", document_id string, document_type string, review_status string, fields array<struct<field:string,value:string,accepted:boolean>>"
PROPOSAL = SOURCE + ", document_id string, candidate_type string, candidate_value string, evidence_quote string, status string, " + ", ".join(f"{c} boolean" for c in (*gb.REQUIRED, *gb.DISQUALIFYING))
DECISION = SOURCE + ", decision_id string, choice string, note string"


def invented():
    rng = random.Random(2)
    src = lambda a, i: (a, "s" + a, i, f"/records/{i}")
    records, proposals, decisions = [], [], []
    for a in ("a1", "a2"):
        for i in range(40):
            fields = [(f, rng.choice(["7", "8", None, " "]), rng.choice([True, None])) for f in rng.sample(["header.po_number", "total", "job-ref", "cargo"], 2)]
            records.append((*src(a, i), rng.choice([f"d{i % 25}", f"d{i % 25}", "", None]), rng.choice(["invoice", "note"]), "clear", fields if i % 9 else None))
    for i in range(60):
        proposals.append((*src("b1", i), rng.choice([f"d{i % 40}", None]), "party", rng.choice(["v", "w", "", None]), None, rng.choice(["close", "matched", "confirmed", None, "x"]), *(rng.choice([True, True, True, None]) for _ in range(4)), *(rng.choice([False, False, True, None]) for _ in range(2))))
    for i in range(12):
        decisions.append((*src("c1", i), rng.choice([f"q{i % 5}", ""]), rng.choice(["yes", "no"]), None))
    records.append((*src("a3", 0), "d1", "invoice", "clear", None))
    return records, proposals, decisions


def plain(records, proposals, decisions):
    nodes, edges, bad, first = {}, {}, Counter(), {}

    def node(key, kind, props, state, row):
        if key not in nodes:
            nodes[key] = [kind, props, state, state == "close_needs_review"]
            first[key] = row[0]
        elif nodes[key][:2] != [kind, props]:
            nodes[key][3] = True
            bad["graph_node_property_conflict"] += 1

    def edge(kind, a, b, state):
        old = edges.setdefault((kind, a, b), state)
        if old != state:
            edges[kind, a, b] = "proposed"

    rows = sorted([(r[0], r[2], "r", r) for r in records] + [(r[0], r[2], "p", r) for r in proposals] + [(r[0], r[2], "c", r) for r in decisions], key=lambda x: x[:2])
    for _, _, family, r in rows:
        if family == "r":
            if not (r[4] or "").strip():
                bad["graph_missing_document_id"] += 1
                continue
            d = ("document", r[4])
            node(d, "document", (r[5], r[6]), "observed", r)
            for f, v, ok in r[7] or ():
                if v is None:
                    continue
                claim = ("claim", d, f, v, r[0], r[2])
                node(claim, "field_claim", (d, f, v, ok), "observed", r)
                edge("document_has_claim", d, claim, "observed")
                if set(f.replace(".", "_").replace("-", "_").split("_")) & set(gb.REFERENCE_TOKENS) and v.strip():
                    node(("reference", v), "reference", (f, v), "observed", r)
                    edge("document_references", d, ("reference", v), "proposed")
        elif family == "p":
            if not (r[4] or "").strip() or not r[6]:
                bad["graph_missing_endpoint"] += 1
                continue
            status = r[8] or "proposed"
            state = "close_needs_review" if status == "close" else "inferred_high_confidence" if status in ("matched", "confirmed") and all(r[9:13]) and not any(r[13:]) else "proposed"
            node(("proposal", r[4], r[6], r[0], r[2]), "proposal", (r[5], r[6], status), state, r)
            edge("proposal_about_document", ("proposal", r[4], r[6], r[0], r[2]), ("document", r[4]), "proposed")
        elif r[4]:
            node(("client_decision", r[4]), "client_decision", (r[5], r[6]), "proposed", r)
        else:
            bad["graph_missing_endpoint"] += 1
    good = {k: v for k, v in edges.items() if k[1] in nodes and k[2] in nodes}
    bad["graph_edge_endpoint_missing"] = len(edges) - len(good)
    bad["graph_source_artifact_contributed_no_nodes"] = len({"a1", "a2", "a3", "b1", "c1", "d0"} - set(first.values()))
    return Counter((v[0], v[2], v[3]) for v in nodes.values()), Counter((k[0], s) for k, s in good.items()), +bad


@pytest.fixture(scope="module")
def graph(spark):
    records, proposals, decisions = invented()
    artifacts = spark.createDataFrame([(a,) for a in ("a1", "a2", "a3", "b1", "c1", "d0")], "artifact_id string")
    return gb.build(spark.createDataFrame(records, RECORD), spark.createDataFrame(proposals, PROPOSAL), spark.createDataFrame(decisions, DECISION), artifacts)


def test_against_a_plain_build(graph):
    nodes, edges, bad = plain(*invented())
    assert Counter((r.node_type, r.approval_state, r.protected) for r in graph["nodes"].collect()) == nodes
    assert Counter((r.edge_type, r.approval_state) for r in graph["edges"].collect()) == edges
    assert Counter(r.reason for r in graph["exceptions"].collect()) == bad
    assert bad["graph_node_property_conflict"] and bad["graph_edge_endpoint_missing"] and bad["graph_source_artifact_contributed_no_nodes"] == 2


def test_hash_without_order_and_tampering(spark, graph):
    fixed = {k: spark.createDataFrame(v.collect(), v.schema) for k, v in graph.items()}
    h = gb.graph_hash(fixed, "run")
    turned = {k: v.repartition(3).orderBy(F.rand(1)) for k, v in fixed.items()}
    assert gb.graph_hash(turned, "run") == h and gb.graph_hash(fixed, "other") != h
    assert gb.load_graph(turned, "run", h) is turned
    one = fixed["nodes"].filter("node_type = 'document'").first().node_id
    touched = fixed | {"nodes": fixed["nodes"].withColumn("approval_state", F.when(F.col("node_id") == one, "approved").otherwise(F.col("approval_state")))}
    doubled = fixed | {"edges": fixed["edges"].unionByName(fixed["edges"].limit(1))}
    cut = fixed | {"nodes": fixed["nodes"].filter(F.col("node_id") != one)}
    for other in (touched, doubled, cut):
        with pytest.raises(ValueError):
            gb.load_graph(other, "run", h)
    assert {r.fault for r in gb.faults(doubled).collect()} == {"edge_id_not_unique"}
    assert {r.fault for r in gb.faults(cut).collect()} == {"edge_endpoint_missing"}
    assert gb.faults(fixed).isEmpty()


def test_hash_counts_repeats_at_every_size(spark, monkeypatch):
    rows = spark.range(300).selectExpr("cast(id % 100 as string) AS a")
    for bucket in (256, 2):
        monkeypatch.setattr(gb, "BUCKET", bucket)
        assert gb.table_hash(rows) == gb.table_hash(rows.repartition(5)) != gb.table_hash(rows.distinct())
    assert gb.table_hash(rows.limit(0)) == ""
