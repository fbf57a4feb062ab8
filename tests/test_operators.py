"""Edges of single operators on small literals."""

import pytest
from pyspark.sql import functions as F

from attestra.functions import values
from attestra.operators import consensus, controls, entities, graph, labels, query, review, sampling
from attestra.plans.semantic import Dataset, Join, Metric, PlanError, bucket, compile_plan, condition


def one(spark, expr, value, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(expr.alias("x")).first().x


@pytest.mark.parametrize(
    "spec, value, want",
    [
        ({"operator": "ne", "value": "a"}, None, True),
        ({"operator": "ne", "value": "a"}, "a", False),
        ({"operator": "is_null", "value": True}, "", True),
        ({"operator": "lte", "value": "x"}, None, True),
        ({"operator": "gte", "value": 5}, "abc", False),
        ({"operator": "gte", "value": 5}, "10", True),
        ("125", "125.00", False),
        ({"operator": "in", "value": ["a", None]}, None, True),
    ],
)
def test_service_condition(spark, spec, value, want):
    assert one(spark, query.condition(F.col("c"), spec), value) is want


@pytest.mark.parametrize(
    "spec, value, want",
    [
        ({"operator": "ne", "value": "a"}, None, False),
        ({"operator": "eq", "value": None}, None, True),
        ({"operator": "is_null", "value": False}, None, False),
        ({"operator": "not_null", "value": False}, "a", False),
        ({"operator": "not_in", "value": ["b"]}, None, False),
        ({"operator": "ends_with", "value": "LO"}, "hello", True),
    ],
)
def test_semantic_condition(spark, spec, value, want):
    assert one(spark, condition(F.col("c"), spec), value) is want


@pytest.mark.parametrize("grain, want", [("day", "2024-07-01"), ("month", "2024-07"), ("quarter", "2024-Q3"), ("year", "2024"), ("fiscal_year", "FY2025"), ("fiscal_quarter", "FY2025-Q1")])
def test_bucket(spark, grain, want):
    assert one(spark, bucket(F.col("c"), grain, 7), "2024-07-01") == want
    assert one(spark, bucket(F.col("c"), grain, 7), "") == ""


def test_fan_out_is_refused(spark):
    base = spark.createDataFrame([("a", 1)], "k string, v int")
    other = spark.createDataFrame([("a", "x"), ("a", "y")], "k string, n string")
    d = Dataset("b", {"n": ("n", "string")}, {"m": Metric("v", "sum")}, (Join("o", "k", "k", {"n": "n"}),))
    with pytest.raises(PlanError, match="fan-out"):
        compile_plan(d, {"b": base, "o": other}, {"dimensions": ["n"], "metrics": ["m"]})


def test_empty_selection_has_one_total(spark):
    base = spark.createDataFrame([("a", 1)], "k string, v int")
    d = Dataset("b", {"k": ("k", "string")}, {"m": Metric("v", "sum"), "n": Metric(None, "count")})
    a = compile_plan(d, {"b": base}, {"metrics": ["m", "n"], "filters": {"k": "z"}, "include_totals": True})
    assert [tuple(r) for r in a.totals.collect()] == [(None, 0)]


@pytest.mark.parametrize("text, want", [("$1,234.50", 1234.5), ("(12.00)", -12), ("12-", -12), ("abc", None), ("", None)])
def test_money(spark, text, want):
    got = one(spark, values.parse_money(F.col("c")), text)
    assert (None if got is None else float(got)) == want


@pytest.mark.parametrize("text, want", [("2024-02-03", "2024-02-03"), ("20240203", "2024-02-03"), ("03 Feb 2024", "2024-02-03"), ("0203-01-01", None), ("03/02/2024", None)])
def test_date(spark, text, want):
    got = one(spark, values.parse_date(F.col("c")), text)
    assert (None if got is None else str(got)) == want


def test_names(spark):
    norm = entities.normalise_name(F.col("c"))
    assert one(spark, norm, "A. B. Smith & Sons, L.L.C.") == "smith sons"
    assert one(spark, norm, "Acme Mfg Co.") == "acme manufacturing"
    assert one(spark, entities.similarity(F.lit("fern hollow"), F.col("c")), "fernhollow") == 1.0
    assert one(spark, entities.one_edit_apart(F.lit("linden"), F.col("c")), "lindew") is True


def test_components_and_path(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "y")], "a string, b string")
    assert {tuple(r) for r in entities.components(e).collect()} == {("a", "a"), ("b", "a"), ("c", "a"), ("x", "x"), ("y", "x")}
    g = e.toDF("from_id", "to_id")
    assert [r.node_id for r in graph.shortest_path(g, "c", "a").orderBy("step").collect()] == ["c", "b", "a"]
    assert graph.shortest_path(g, "a", "x").count() == 0


def test_consensus_rules(spark):
    rows = [("d", 1, "f", v, x, h) for v, x, h in (("a", "5", True), ("b", "5.0", True))] + [("d", 2, "f", "a", "5", False), ("d", 3, "f", "a", "x", False), ("d", 3, "f", "b", "y", False)]
    r = spark.createDataFrame(rows, "document_id string, row_index int, field string, vendor string, value string, handwritten boolean")
    got = {x.row_index: (x.value, x.consensus_flag) for x in consensus.field_consensus(r, F.lit(True)).collect()}
    assert got == {1: (None, "consensus_2of2_below_required_3"), 2: (None, "single_engine"), 3: (None, "no_consensus")}


def test_tolerance_is_not_transitive(spark):
    rows = [("d", 1, "f", v) for v in ("1.00", "1.04", "1.08")]
    r = spark.createDataFrame(rows, "document_id string, row_index int, field string, value string")
    x = consensus.tolerance_clusters(r, 0.05).first()
    assert (x.clusters, x.largest, x.ambiguous) == (2, 2, True)


def test_gaps(spark):
    d = spark.createDataFrame([("v", f"A-{n}") for n in (1, 2, 5, 6, 7)] + [("w", "none")], "v string, n string")
    runs, left = controls.sequence_gaps(d, "v", "n")
    assert [(r.from_n, r.to_n) for r in runs.collect()] == [(3, 4)]
    assert {r.reason for r in left.collect()} == {"no_numeric_suffix"}


def test_resolve_needs_every_field(spark):
    docs = spark.createDataFrame([("a", "open", ["x", "y"]), ("b", "open", ["x"]), ("c", "clear", [])], "document_id string, status string, open_fields array<string>")
    auth = spark.createDataFrame([("a", "x"), ("b", "x")], "document_id string, field string")
    assert {r.document_id: r.status for r in review.resolve_exceptions(docs, auth).collect()} == {"a": "open", "b": "clear", "c": "clear"}


def test_mus_design_moves_large_units(spark):
    p = spark.createDataFrame([(i, 10.0) for i in range(100)] + [(1000, 900.0)], "k int, v double").withColumn("v", F.col("v").cast("decimal(16,2)"))
    cut, points, interval = sampling.mus_design(p, "v", 5000.0, 10)
    assert cut == 900.0 and points == 9 and abs(interval - 1000 / 9) < 1e-9


def test_shifted_runs(spark):
    rows = [(1, i, v, s) for i, (v, s) in enumerate([(1, 7), (7, 8), (8, 9), (3, 4)])]
    x = labels.shifted_column(spark.createDataFrame(rows, "d int, i int, v int, s int"), "d", "i", "v", "s").collect()
    assert [(r.from_row, r.to_row) for r in x] == [(1, 2)]
