"""Monetary-unit sampling, its projection, and hash-ordered draws."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import Scratch

# Cumulative Poisson factors at 95 % for 0 to 10 overstatements.
FACTORS_95 = (3.00, 4.75, 6.30, 7.76, 9.16, 10.52, 11.85, 13.15, 14.44, 15.71, 16.97)


def mus_design(population: DataFrame, value: str, materiality: float, points: int) -> tuple[float, int, float]:
    """(certainty cut, points left, interval): units over the interval move to certainty until none is.

    Each turn is one aggregation; values are decimals, so sums do not depend on layout.
    """
    cut, left = float(materiality), points
    while left > 0:
        row = population.filter(F.col(value) < cut).agg(F.sum(value).alias("s")).first()
        total = float(row.s or 0)
        if total <= 0:
            return cut, 0, 0.0
        interval = total / left
        over = population.filter((F.col(value) < cut) & (F.col(value) > interval)).agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("m")).first()
        if not over.n:
            return cut, left, interval
        left -= over.n
        cut = min(cut, float(over.m))
    return cut, 0, 0.0


def mus_selection(population: DataFrame, key: str, value: str, cut: float, points: int, interval: float, start: float) -> DataFrame:
    """Systematic selection: units below ``cut`` whose running sum in key order passes start + k * interval.

    The running sum is taken in two levels: within range partitions of the key and over
    their totals, so no task holds the whole population.
    """
    rest = population.filter((F.col(value) < cut) & (F.col(value) > 0)).select(key, value)
    parts = max(1, int(population.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # written with the number of its range: both sides below read one and the same division
    ranged = Scratch(population.sparkSession, "mus").table(rest.repartitionByRange(parts, key).withColumn("_p", F.spark_partition_id()))
    totals = ranged.groupBy("_p").agg(F.sum(value).alias("t"))
    before = totals.alias("x").join(totals.alias("y"), F.col("y._p") < F.col("x._p"), "left").groupBy(F.col("x._p").alias("_p")).agg(F.coalesce(F.sum("y.t"), F.lit(0)).alias("before"))
    w = Window.partitionBy("_p").orderBy(key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = ranged.withColumn("_in", F.sum(value).over(w)).join(F.broadcast(before), "_p")
    high = (F.col("before") + F.col("_in")).cast("double")
    low = high - F.col(value).cast("double")
    first = F.greatest(F.ceil((low - start) / interval), F.lit(0))
    hit = start + first * interval
    return run.filter((hit < high) & (first < points)).select(key, value, F.round(hit, 2).alias("selection_point"))


def start_of(seed: int, interval: float) -> float:
    return random.Random(seed).uniform(0, interval)


def projection(findings: DataFrame, interval: float) -> DataFrame:
    """Findings (recorded, audited) of sampled units -> projected overstatement, basic precision, allowances, upper bound."""
    taint = (F.col("recorded") - F.col("audited")) / F.col("recorded")
    t = findings.filter((F.col("recorded") > 0) & F.col("audited").isNotNull()).select("document_id", taint.cast("double").alias("taint"))
    over = t.filter("taint > 0")
    ranked = over.orderBy(F.desc("taint"), "document_id").limit(len(FACTORS_95) - 1)
    ranked = ranked.agg(F.sort_array(F.collect_list("taint"), False).alias("ts"))
    steps = F.array(*(F.lit(FACTORS_95[i + 1] - FACTORS_95[i] - 1) for i in range(len(FACTORS_95) - 1)))
    extra = F.aggregate(F.zip_with("ts", F.slice(steps, F.lit(1), F.greatest(F.size("ts"), F.lit(0))), lambda x, f: x * f), F.lit(0.0), lambda a, x: a + x)
    sums = t.agg(F.count(F.lit(1)).alias("reviewed"), F.count(F.when(F.col("taint") > 0, 1)).alias("overstatements"), F.coalesce(F.sum(F.when(F.col("taint") > 0, F.col("taint"))), F.lit(0.0)).alias("taint_sum"))
    out = sums.crossJoin(ranked.select(extra.alias("extra")))
    base = FACTORS_95[0] * interval
    bound = F.when(F.col("overstatements") < len(FACTORS_95), F.round(F.col("taint_sum") * interval + base + F.col("extra") * interval, 2))
    return out.select("reviewed", "overstatements", F.round(F.col("taint_sum") * interval, 2).alias("projected"), F.lit(round(base, 2)).alias("basic_precision"), F.round(F.col("extra") * interval, 2).alias("incremental"), bound.alias("upper_bound"))


def hash_draw(rows: DataFrame, stratum: str, key: str, size: int) -> DataFrame:
    """The first ``size`` of each stratum in the order of the key's SHA-256, with the weight of each draw.

    Only the smallest hashes of each stratum are ranked: a window limit keeps ``size`` rows a task.
    """
    h = F.sha2(F.col(key).cast("string"), 256)
    w = Window.partitionBy(stratum).orderBy("_h")
    drawn = rows.withColumn("_h", h).withColumn("_k", F.row_number().over(w)).filter(F.col("_k") <= size)
    members = rows.groupBy(stratum).agg(F.count(F.lit(1)).alias("members"))
    return drawn.join(members, stratum).withColumn("weight", F.col("members") / F.least(F.col("members"), F.lit(size))).withColumnRenamed("_k", "draw").drop("_h")


def round_robin(rows: DataFrame, stratum: str, key: str, size: int) -> DataFrame:
    """``size`` rows over the strata in turn, each in hash order."""
    w = Window.partitionBy(stratum).orderBy(F.sha2(F.col(key).cast("string"), 256))
    return rows.withColumn("turn", F.row_number().over(w)).filter(F.col("turn") <= size).orderBy("turn", stratum).limit(size)


def outside_frame(status: Column, arithmetic: Column) -> Column:
    """Why a document is outside the sampling frame, null inside: only what was accepted unseen is drawn from."""
    accepted = F.coalesce(status == "auto_accepted", F.lit(False))
    clear = F.coalesce(arithmetic.isin("proved", "not_applicable"), F.lit(False))
    return F.when(~accepted, "not_auto_accepted").when(~clear, "arithmetic_not_clear")


def reconcile_results(selected: DataFrame, outcomes: DataFrame) -> DataFrame:
    """One row a document of either side: its state, and how many outcomes came after its first.

    ``selected`` is (document_id, value), ``outcomes`` (ordinal, document_id, recorded, audited, outcome).  Blank
    ids are one row, state no_document_id.  A document's first outcome counts; NaN and infinite values are none.
    """
    finite = lambda c: F.when(~F.isnan(c) & (F.abs(c) < float("inf")), c)
    o = outcomes.select("ordinal", F.trim(F.coalesce("document_id", F.lit(""))).alias("document_id"), *(finite(F.col(c).cast("double")).alias(c) for c in ("recorded", "audited")), "outcome")
    first = o.groupBy("document_id").agg(F.min(F.struct("ordinal", "recorded", "audited", "outcome")).alias("o"), F.count(F.lit(1)).alias("n"))
    s = selected.select("document_id", F.col("value").cast("double").alias("value"), F.lit(True).alias("chosen"))
    j = s.join(first, "document_id", "full")
    blank, seen, same = F.col("document_id") == "", F.col("n").isNotNull(), F.col("o.recorded").eqNullSafe(F.col("value"))
    reviewed = F.coalesce(F.col("o.outcome").isin("reviewed_correct", "reviewed_error"), F.lit(False)) & F.col("o.audited").isNotNull()
    agrees = (F.col("o.outcome") == "reviewed_correct") == (F.col("o.audited") == F.col("o.recorded"))
    state = (
        F.when(blank, "no_document_id")
        .when(~seen, "missing")
        .when(F.col("chosen").isNull(), "extra")
        .when(F.col("o.recorded").isNull() | ~same, "recorded_value_differs")
        .when(F.col("o.outcome").isin("abstained", "failed"), "unresolved")
        .when(~reviewed, "invalid_outcome")
        .when(~agrees, "outcome_contradicts_value")
        .otherwise("complete")
    )
    return j.select("document_id", state.alias("state"), F.when(blank | ~seen, 0).otherwise(F.col("n") - 1).cast("long").alias("repeated"), F.col("o.audited").alias("audited"))


def review_complete(reconciled: DataFrame, plan_matches: bool) -> DataFrame:
    """(status, documents): completed only if every document is complete, none came twice and the plan is the one signed."""
    bad = F.count(F.when((F.col("state") != "complete") | (F.col("repeated") > 0), 1))
    return reconciled.agg(F.when(F.lit(plan_matches) & (bad == 0), "completed").otherwise("blocked").alias("status"), F.count(F.lit(1)).alias("documents"))
