"""Decisions over independent evidence: handwriting, table cells, source labels, confidence, page quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What each kind of acceptance lets a reader claim.
CONFIDENCE = {
    "vendor_agreement": "confirmed",
    "independent_corroboration": "corroborated",
    "same_document": "corroborated",
    "extractor_tiebreak": "corroborated",
    "page_review": "corroborated",
    "approved_mapping": "corroborated",
    "document_arithmetic": "computed",
    "derived": "derived",
}
SIGNATURES = ("signature", "initials")
REGION = ("document_id", "page_id", "region_id")


def confidence(accepted_by: Column) -> Column:
    """confirmed, corroborated, computed or derived; anything else is unconfirmed."""
    table = F.create_map(*(F.lit(x) for kv in CONFIDENCE.items() for x in kv))
    return F.coalesce(table[accepted_by], F.lit("unconfirmed"))


def handwriting(readings: DataFrame, max_passes: int = 3) -> DataFrame:
    """One decision a region of readings (REGION, kind, numeric, group, value, iteration).

    Signatures are never data; kinds that differ, missing values and late iterations go to
    review; numbers need three groups of one mind and go to review all the same; text needs
    two that agree and no equal rival.
    """
    value = F.when(F.col("numeric"), F.regexp_replace("value", r"[,$\s]", "").try_cast("decimal(38,4)").cast("string")).otherwise(F.nullif(F.lower(F.trim("value")), F.lit("")))
    r = readings.withColumn("v", value)
    # a region's readings are as many as its groups, so one aggregation holds them
    said = F.collect_set(F.when(F.col("v").isNotNull(), F.struct("v", "group"))).alias("said")
    head = r.groupBy(*REGION).agg(F.size(F.collect_set("kind")).alias("kinds"), F.min("kind").alias("kind"), F.bool_and("numeric").alias("numeric"), F.max("iteration").alias("iteration"), F.size(F.collect_set("group")).alias("groups"), F.count(F.when(F.col("v").isNull(), 1)).alias("missing"), said)
    votes = lambda v: F.size(F.filter("said", lambda s: (s["v"] == v) & s["group"].isNotNull()))
    x = head.withColumn("per", F.transform(F.array_distinct("said.v"), lambda v: F.struct(votes(v).alias("n"), v.alias("v"))))
    x = x.withColumns({"top": F.array_max("per"), "clusters": F.size("per")})
    tied = F.size(F.filter("per", lambda c: c["n"] == F.col("top.n"))) > 1
    reason = (
        F.when(F.col("kinds") != 1, "conflicting_semantic_type")
        .when(F.col("kind").isin(*SIGNATURES), "signature_never_transcribed_as_data")
        .when(F.col("iteration") > max_passes, "iteration_limit_exceeded")
        .when(F.col("missing") > 0, "missing_or_invalid_reading")
        .when(F.col("numeric") & ((F.col("clusters") > 1) | (F.col("groups") < 3)), "numeric_not_unanimous")
        .when(F.col("numeric"), "numeric_requires_review")
        .when((F.col("top.n") < 2) | tied, "text_below_agreement")
    )
    return x.select(*REGION, F.when(reason.isNull() | (reason == "numeric_requires_review"), F.col("top.v")).alias("value"), reason.alias("review_reason"))


def table_cells(cells: DataFrame, independent: DataFrame, key: list[str], protected: str = "protected") -> DataFrame:
    """Each cell against an independent reader's at the same place: missing, ambiguous, agreement or disagreement; protected facts are reviewed whatever comes out."""
    other = independent.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("other"))
    norm = lambda c: F.coalesce(F.regexp_replace(c, r"[,$\s]", "").try_cast("decimal(38,4)").cast("string"), F.lower(F.trim(c)))
    x = cells.join(other, key, "left")
    decision = F.when(F.col("n").isNull(), "independent_cell_missing").when(F.col("n") > 1, "independent_cell_ambiguous").when(norm(F.col("value")) == norm(F.col("other")), "independent_exact_agreement").otherwise("independent_value_disagreement")
    return x.withColumn("decision", decision).withColumn("client_review_required", F.col(protected)).drop("n", "other")


def promote_labels(readings: DataFrame, rules: DataFrame, least_engines: int = 2) -> DataFrame:
    """Values under a printed label that an approved rule maps to a field, where enough engines read one value.  rules (label, field, approved)."""
    ok = rules.filter("approved").groupBy("label").agg(F.countDistinct("field").alias("k"), F.min("field").alias("field")).filter("k = 1").drop("k")
    per = readings.join(F.broadcast(ok), "label").groupBy("document_id", "field", F.lower(F.trim("value")).alias("value")).agg(F.countDistinct("engine").alias("engines")).filter(F.col("engines") >= least_engines)
    one = per.groupBy("document_id", "field").agg(F.count(F.lit(1)).alias("k"), F.min("value").alias("value"), F.max("engines").alias("engines"))
    return one.filter("k = 1").select("document_id", "field", "value", "engines", F.lit("approved_mapping").alias("accepted_by"))


def adjudicate(candidates: DataFrame, supports: Column) -> DataFrame:
    """(document_id): the one candidate that the arithmetic supports, else null with the reason."""
    per = candidates.withColumn("_ok", supports).groupBy("document_id").agg(F.countDistinct(F.when(F.col("_ok"), F.col("value"))).alias("n"), F.min(F.when(F.col("_ok"), F.col("value"))).alias("value"))
    return per.select("document_id", F.when(F.col("n") == 1, F.col("value")).alias("value"), F.when(F.col("n") == 1, "supported").when(F.col("n") > 1, "several_supported").otherwise("none_supported").alias("outcome"))


def scan_quality(dpi: Column, contrast: Column, sharpness: Column, speckle: Column, ink: Column) -> tuple[Column, Column]:
    """(band, problems) of a page's measures; unknown measures are no problem."""
    checks = [
        (dpi.between(1, 199), "dpi_below_200"), (dpi.between(200, 299), "dpi_below_300"), (contrast < 0.35, "low_contrast"), (sharpness < 120, "soft_focus"),
        (speckle > 0.12, "heavy_speckle"), (ink < 0.002, "near_blank"), (ink > 0.45, "over_inked_or_shadowed"),
    ]
    problems = F.filter(F.array(*(F.when(c, n) for c, n in checks)), lambda x: x.isNotNull())
    severe = F.arrays_overlap(problems, F.array(*(F.lit(n) for n in ("dpi_below_200", "low_contrast", "near_blank", "over_inked_or_shadowed"))))
    return F.when(severe | (F.size(problems) >= 3), "poor").when(F.size(problems) > 0, "marginal").otherwise("good"), problems
