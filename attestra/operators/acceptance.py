"""Acceptance of predictions against a golden set: every figure, overall and by each key, and the checks that stand on them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATUSES = ("predicted", "abstained", "failed")
RATIOS = (
    ("precision", "correct_values", "predicted_values"), ("recall", "correct_values", "items"), ("coverage", "predicted_values", "items"), ("prediction_record_rate", "predictions_present", "items"),
    ("abstention_or_failure_rate", "abstentions_or_failures", "items"), ("auto_accept_precision", "correct_auto_accepted", "auto_accepted"), ("expected_review_recall", "expected_review_captured", "expected_review_items"),
)


def refused(truth: DataFrame, predictions: DataFrame) -> DataFrame:
    """(side, item_id, reason) of rows that make a side unfit to be judged: blank or repeated ids, and impossible predictions."""
    out = None
    for side, df in (("truth", truth), ("prediction", predictions)):
        ids = df.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
        reason = F.when(F.trim(F.coalesce(F.col("item_id").cast("string"), F.lit(""))) == "", "item_id_missing").when(F.col("n") > 1, "item_id_repeated")
        found = ids.select(F.lit(side).alias("side"), F.col("item_id").cast("string").alias("item_id"), reason.alias("reason")).filter("reason is not null")
        out = found if out is None else out.unionByName(found)
    odd = F.when(~F.coalesce(F.col("status").isin(*STATUSES), F.lit(False)), "status_unknown").when(F.col("review_required").isNull() | F.col("auto_accepted").isNull(), "flag_missing")
    odd = odd.when(F.col("auto_accepted") & (F.col("review_required") | (F.col("status") != "predicted")), "auto_accepted_without_a_settled_prediction")
    return out.unionByName(predictions.select(F.lit("prediction").alias("side"), F.col("item_id").cast("string").alias("item_id"), odd.alias("reason")).filter("reason is not null"))


def compared(truth: DataFrame, predictions: DataFrame, keys: tuple[str, ...], telemetry: tuple[str, ...] = ()) -> DataFrame:
    """Each golden item beside its prediction, with what it shows as flags.

    ``truth`` is (item_id, expected_value, protected, expected_review_required, baseline_review_required, expected_arithmetic_status,
    expected_completeness_status) and ``keys``; a null expected status is not checked.  ``predictions`` is (item_id, provider, status,
    predicted_value, review_required, auto_accepted, arithmetic_status, completeness_status) and ``telemetry``.  Values are compared
    as they are; two nulls agree.  An item without a prediction counts as not predicted, not reviewed, of provider ``unreported``.
    """
    p = predictions.select("item_id", F.coalesce(F.nullif(F.col("provider"), F.lit("")), F.lit("unreported")).alias("provider"), "status", "predicted_value", F.col("review_required").alias("review"), F.col("auto_accepted").alias("auto"), "arithmetic_status", "completeness_status", *telemetry, F.lit(True).alias("present"))
    j = truth.join(p, "item_id", "left")
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    predicted = yes("present") & F.coalesce(F.col("status") == "predicted", F.lit(False))
    correct = predicted & F.col("predicted_value").eqNullSafe(F.col("expected_value"))
    auto = yes("auto")
    wrong = lambda part: F.col(f"expected_{part}_status").isNotNull() & ~F.coalesce(F.col(f"{part}_status") == F.col(f"expected_{part}_status"), F.lit(False))
    return j.select(
        "item_id", *keys, F.coalesce("provider", F.lit("unreported")).alias("provider"), yes("protected").alias("protected"), yes("expected_review_required").alias("expected_review"), yes("baseline_review_required").alias("baseline_review"),
        yes("present").alias("present"), predicted.alias("predicted"), correct.alias("correct"), yes("review").alias("review"), auto.alias("auto"), (auto & ~correct).alias("false_auto"),
        (auto & (yes("protected") | yes("expected_review_required"))).alias("escape"), F.col("expected_arithmetic_status").isNotNull().alias("arithmetic_checked"), wrong("arithmetic").alias("arithmetic_error"),
        F.col("expected_completeness_status").isNotNull().alias("completeness_checked"), wrong("completeness").alias("completeness_error"), *(F.coalesce(t, F.lit(0)).alias(t) for t in telemetry),
    )


def summary(rows: DataFrame, keys: tuple[str, ...], telemetry: tuple[str, ...] = ()) -> DataFrame:
    """(dimension, member, every count, ratio and telemetry sum): overall, and by each of ``keys`` alone.

    Rows are counted once by all keys together, and those few counts are then added up by each key.  A ratio over nothing is null.
    An empty set has one overall row of zeros.
    """
    c = F.col
    counts = {
        "items": F.lit(True), "predictions_present": c("present"), "predicted_values": c("predicted"), "correct_values": c("correct"), "abstentions_or_failures": ~c("predicted"), "auto_accepted": c("auto"), "correct_auto_accepted": c("auto") & c("correct"),
        "false_auto_accepts": c("false_auto"), "protected_category_escapes": c("escape"), "expected_review_items": c("expected_review"), "expected_review_captured": c("expected_review") & c("review"), "baseline_review_items": c("baseline_review"),
        "predicted_review_items": c("review"), "arithmetic_status_checks": c("arithmetic_checked"), "arithmetic_status_errors": c("arithmetic_error"), "completeness_status_checks": c("completeness_checked"), "completeness_status_errors": c("completeness_error"),
    }
    per = rows.groupBy(*keys).agg(*(F.count_if(x).alias(n) for n, x in counts.items()), *(F.sum(t).alias(t) for t in telemetry))
    names = [*counts, *telemetry]
    total = lambda n: F.coalesce(F.sum(n), F.lit(0)).alias(n)
    overall = per.agg(*map(total, names)).select(F.lit("overall").alias("dimension"), F.lit("all").alias("member"), *names)
    sides = F.array(*(F.struct(F.lit(k).alias("dimension"), F.coalesce(F.col(k).cast("string"), F.lit("")).alias("member")) for k in keys)) if keys else None
    out = overall if sides is None else overall.unionByName(per.withColumn("_s", F.explode(sides)).groupBy("_s.dimension", "_s.member").agg(*map(total, names)))
    for name, above, below in RATIOS:
        out = out.withColumn(name, F.try_divide(c(above).cast("double"), c(below)))
    return out.withColumn("review_reduction_rate", F.try_divide((c("baseline_review_items") - c("predicted_review_items")).cast("double"), c("baseline_review_items")))


@dataclass(frozen=True)
class Floors:
    """What a set of predictions must reach."""

    precision: float
    recall: float
    coverage: float
    false_auto_accepts: int = 0
    protected_escapes: int = 0

    def __post_init__(self):
        if not all(0 <= x <= 1 for x in (self.precision, self.recall, self.coverage)) or min(self.false_auto_accepts, self.protected_escapes) < 0:
            raise ValueError("shares lie between 0 and 1, and error counts are not negative")


def checks(overall: DataFrame, truth: DataFrame, predictions: DataFrame, floors: Floors) -> DataFrame:
    """(check, value, passed) of the nine checks; a share that cannot be computed fails, but for the recall of expected reviews.

    ``overall`` is the overall row of :func:`summary`.  Passing is evidence only and authorises nothing.
    """
    extra = predictions.select("item_id").distinct().join(truth.select("item_id"), "item_id", "left_anti").agg(F.count(F.lit(1)).alias("unexpected"))
    c = F.col
    tests: list[tuple[str, Column, Column]] = [(n, c(n), F.coalesce(c(n) >= getattr(floors, n), F.lit(False))) for n in ("precision", "recall", "coverage")]
    tests += [
        ("false_auto_accepts", c("false_auto_accepts"), c("false_auto_accepts") <= floors.false_auto_accepts), ("protected_category_escapes", c("protected_category_escapes"), c("protected_category_escapes") <= floors.protected_escapes),
        ("expected_review_recall", c("expected_review_recall"), F.coalesce(c("expected_review_recall") == 1, F.lit(True))), ("arithmetic_status", c("arithmetic_status_errors"), c("arithmetic_status_errors") == 0),
        ("completeness_status", c("completeness_status_errors"), c("completeness_status_errors") == 0), ("unexpected_predictions", c("unexpected"), c("unexpected") == 0),
    ]
    made = F.array(*(F.struct(F.lit(n).alias("check"), v.cast("double").alias("value"), ok.alias("passed")) for n, v, ok in tests))
    return overall.crossJoin(extra).select(F.explode(made).alias("x")).select("x.*")  # one row each


def failures(rows: DataFrame) -> DataFrame:
    """(item_id, reason, priority): the first thing wrong with each item; protected items come first."""
    c = F.col
    reason = F.when(~c("present"), "golden_set_prediction_missing").when(c("escape"), "golden_set_protected_category_escape").when(c("false_auto"), "golden_set_false_auto_accept")
    reason = reason.when(c("expected_review") & ~c("review"), "golden_set_expected_review_not_captured").when(c("arithmetic_error"), "golden_set_arithmetic_status_mismatch").when(c("completeness_error"), "golden_set_completeness_status_mismatch")
    return rows.select("item_id", reason.alias("reason"), F.when(c("protected"), "critical").otherwise("high").alias("priority")).filter("reason is not null")
