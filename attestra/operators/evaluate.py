"""Golden-set evaluation, calibration of cut-offs, template drift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def golden_summary(truth: DataFrame, predictions: DataFrame, keys: list[str]) -> DataFrame:
    """Overall and by each key alone (dimension, member): items, predicted, correct, missed, wrongly accepted."""
    j = truth.join(predictions, "item_id", "left")
    pred = F.coalesce(F.col("status") == "predicted", F.lit(False))
    right = pred & (F.col("predicted_value") == F.col("expected_value"))
    sides = F.array(F.struct(F.lit("overall").alias("dimension"), F.lit("all").alias("member")), *(F.struct(F.lit(k).alias("dimension"), F.coalesce(F.col(k).cast("string"), F.lit("")).alias("member")) for k in keys))
    long = j.withColumn("pred", pred).withColumn("right", right).withColumn("_s", F.explode(sides)).select("*", "_s.*")
    n = lambda c: F.sum(c.cast("long"))
    return long.groupBy("dimension", "member").agg(F.count(F.lit(1)).alias("items"), n(F.col("pred")).alias("predicted"), n(F.col("right")).alias("correct"), n(F.col("status").isNull()).alias("missing"), n(F.coalesce(F.col("auto_accepted"), F.lit(False)) & ~F.col("right")).alias("wrongly_accepted"))


def unexpected(truth: DataFrame, predictions: DataFrame) -> DataFrame:
    return predictions.join(truth.select("item_id"), "item_id", "left_anti")


def calibration(scores: DataFrame, labels: DataFrame, cutoffs: list[float]) -> DataFrame:
    """At each cut-off: accepted, correct, abstained, precision, recall; ids on either side count."""
    j = labels.select("item_id", "label").join(scores.select("item_id", "predicted", "score"), "item_id", "full")
    # each row counts once, at the number of cut-offs it reaches; the cut-offs are then summed up
    reach = sum((F.coalesce(F.col("score") >= c, F.lit(False)).cast("int") for c in sorted(cutoffs)), F.lit(0))
    hit = F.coalesce(F.col("predicted") == F.col("label"), F.lit(False))
    per = j.groupBy(reach.alias("reach")).agg(F.count(F.lit(1)).alias("n"), F.sum(hit.cast("long")).alias("right"))
    cuts = scores.sparkSession.createDataFrame([(i + 1, float(c)) for i, c in enumerate(sorted(cutoffs))], "i int, cutoff double")
    total = F.sum("n")
    out = cuts.join(per).groupBy("cutoff").agg(F.sum(F.when(F.col("reach") >= F.col("i"), F.col("n")).otherwise(0)).alias("accepted"), F.sum(F.when(F.col("reach") >= F.col("i"), F.col("right")).otherwise(0)).alias("correct"), total.alias("items"))
    return out.select("cutoff", "accepted", "correct", (F.col("items") - F.col("accepted")).alias("abstained"), F.round(F.try_divide(F.col("correct").cast("double"), F.col("accepted")), 6).alias("precision"), F.round(F.col("correct") / F.col("items"), 6).alias("recall"))


def layout_similarity(a: Column, b: Column, same_family: Column) -> Column:
    """0.5 of header overlap, 0.3 of headers at the same place, 0.2 for one family."""
    overlap = F.size(F.array_intersect(a, b)) / F.greatest(F.size(F.array_union(a, b)), F.lit(1))
    place = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda z: F.coalesce(z, F.lit(False)))) / F.greatest(F.size(a), F.size(b), F.lit(1))
    return F.round(0.5 * overlap + 0.3 * place + 0.2 * same_family.cast("double"), 6)


def template_drift(templates: DataFrame, registry: DataFrame, least: float = 0.5) -> DataFrame:
    """Each template against the approved registry: exact, ambiguous, drift, new.  (template_id, family, headers)

    Templates of one family and the same headers are scored once, and so are approved ones; candidates share a header.  The work
    grows with the pairs of different layouts that share one, not with the templates.
    """
    layout = ["family", "headers"]
    r = registry.groupBy(*layout).agg(F.count(F.lit(1)).alias("ids"), F.min("template_id").alias("approved_id")).toDF("a_family", "a_headers", "ids", "approved_id")
    t = templates.select(*layout).distinct()
    words = t.select(*layout, F.explode("headers").alias("h")).join(r.select("*", F.explode("a_headers").alias("h")), "h").drop("h").distinct()
    scored = words.withColumn("score", layout_similarity(F.col("headers"), F.col("a_headers"), F.col("family") == F.col("a_family"))).withColumn("same", (F.col("headers") == F.col("a_headers")) & (F.col("family") == F.col("a_family")))
    near = scored.filter((F.col("score") >= least) | F.col("same"))
    best = near.groupBy(*layout).agg(F.sum(F.when(F.col("same"), F.col("ids")).otherwise(0)).alias("exact"), F.max("score").alias("top"), F.min(F.struct((-F.col("score")).alias("s"), F.col("approved_id").alias("approved_id"))).alias("b"))
    out = templates.join(best, layout, "left")
    verdict = F.when(F.col("exact") == 1, "exact").when(F.col("exact") > 1, "ambiguous").when(F.col("top").isNotNull(), "drift").otherwise("new")
    return out.select("template_id", verdict.alias("verdict"), F.col("b.approved_id").alias("nearest"), F.col("top").alias("score"))


def cohesion(members: DataFrame, floor: float = 0.25) -> DataFrame:
    """Of each family the share of documents with its most usual label; under ``floor`` it is no template."""
    per = members.groupBy("family", "label").agg(F.countDistinct("document_id").alias("n"))
    docs = members.groupBy("family").agg(F.countDistinct("document_id").alias("documents"))
    out = per.groupBy("family").agg(F.max("n").alias("most")).join(docs, "family").withColumn("cohesion", F.round(F.col("most") / F.col("documents"), 6))
    return out.withColumn("is_template", F.col("cohesion") >= floor)
