"""Golden acceptance and load checks on rows worked out by hand."""

import pytest

from attestra.operators import acceptance, load_checks

TRUTH = "item_id string, kind string, expected_value string, protected boolean, expected_review_required boolean, baseline_review_required boolean, expected_arithmetic_status string, expected_completeness_status string"
PRED = "item_id string, provider string, status string, predicted_value string, review_required boolean, auto_accepted boolean, arithmetic_status string, completeness_status string, cost double"


def test_checks_and_failures(spark):
    truth = spark.createDataFrame([("a", "x", "1", False, False, True, None, None), ("b", "x", "2", True, False, True, "pass", None), ("c", "y", "3", False, True, False, None, "whole"), ("d", "y", None, False, False, False, None, None), ("e", "y", "5", False, False, True, None, None)], TRUTH)
    pred = spark.createDataFrame([("a", "", "predicted", "9", False, True, None, None, 1.5), ("b", "r", "predicted", "2", False, True, "pass", None, 2.0), ("c", "r", "abstained", None, True, False, None, "part", None), ("d", "r", "predicted", None, False, False, None, None, 1.0), ("z", "r", "failed", None, False, False, None, None, 9.0)], PRED)
    rows = acceptance.compared(truth, pred, ("kind",), ("cost",))
    s = {(r.dimension, r.member): r for r in acceptance.summary(rows, ("kind",), ("cost",)).collect()}
    o = s["overall", "all"]
    assert (o["items"], o.predictions_present, o.predicted_values, o.correct_values, o.auto_accepted, o.false_auto_accepts, o.protected_category_escapes, o.completeness_status_errors, o.cost) == (5, 4, 3, 2, 2, 1, 1, 1, 4.5)
    assert o.precision == pytest.approx(2 / 3) and o.expected_review_recall == 1.0 and o.review_reduction_rate == pytest.approx(2 / 3)
    assert s["kind", "x"].coverage == 1.0 and s["kind", "y"].auto_accept_precision is None
    got = {r.check: r.passed for r in acceptance.checks(acceptance.summary(rows, ()), truth, pred, acceptance.Floors(0.5, 0.5, 0.5, 1, 1)).collect()}
    assert got == {"precision": True, "recall": False, "coverage": True, "false_auto_accepts": True, "protected_category_escapes": True, "expected_review_recall": True, "arithmetic_status": True, "completeness_status": False, "unexpected_predictions": False}
    wrong = {r.item_id: (r.reason.removeprefix("golden_set_"), r.priority) for r in acceptance.failures(rows).collect()}
    assert wrong == {"a": ("false_auto_accept", "high"), "b": ("protected_category_escape", "critical"), "c": ("completeness_status_mismatch", "high"), "e": ("prediction_missing", "high")}
    none = acceptance.summary(acceptance.compared(truth.limit(0), pred, ("kind",)), ("kind",)).collect()
    assert [(r.dimension, r["items"], r.precision) for r in none] == [("overall", 0, None)]
    with pytest.raises(ValueError):
        acceptance.Floors(1.5, 0, 0)


def test_refused(spark):
    truth = spark.createDataFrame([("a", "x", "1", False, False, True, None, None), ("a", "x", "1", False, False, True, None, None), (None, "x", "1", False, False, True, None, None)], TRUTH)
    pred = spark.createDataFrame([("a", "r", "guessed", "9", False, False, None, None, 1.0), ("b", "r", "abstained", None, False, True, None, None, 1.0), ("c", "r", "failed", None, None, False, None, None, 1.0), ("d", "r", "predicted", "1", False, True, None, None, 1.0)], PRED)
    got = sorted((r.side, r.item_id or "", r.reason) for r in acceptance.refused(truth, pred).collect())
    assert got == [("prediction", "a", "status_unknown"), ("prediction", "b", "auto_accepted_without_a_settled_prediction"), ("prediction", "c", "flag_missing"), ("truth", "", "item_id_missing"), ("truth", "a", "item_id_repeated")]


def test_load_checks(spark):
    rows = [(i, f"D{i}", p, c, k, t) for i, (p, c, k, t) in enumerate([("555-123-4567 or 555-123-4568", "US", "CK1", "12 Mill Lane"), ("555-123-4567", "Chile", "--", "Lane 12"), (None, "", "CK1", "way 5"), ("555-123-4567", None, "CK1", None), ("x", "us", "000", "a")])]
    df = spark.createDataFrame(rows, "row_id int, document_id string, contact_phone string, ship_country_code string, check_number string, style string")
    got = sorted((r.row_id, r.column, r.reason.split("_")[0]) for r in load_checks.cell_issues(df, ["row_id", "document_id"]).collect())
    assert got == [(0, "contact_phone", "multiple"), (0, "style", "address"), (1, "check_number", "placeholder"), (1, "ship_country_code", "country"), (4, "check_number", "placeholder")]
    assert [tuple(r) for r in load_checks.shared_identities(df).collect()] == [("check_number", "CK1", 3, "D0; D2; D3")]
    assert load_checks.shared_identities(df.select("document_id", "style")).count() == 0
