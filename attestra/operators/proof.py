"""Proof of documents from their own arithmetic: lines, subtotal, charges, total, credits and amount due."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDE = "decimal(38,6)"
#: Rounding that each row after the first may add to a sum.
ROW_ROUNDING = 0.01
CHARGES = ("tax", "freight", "accessorial", "discount", "credits")


def amended_lines(lines: DataFrame, amendments: DataFrame) -> DataFrame:
    """Lines (document_id, line, quantity, unit_price, extended_amount) with the latest amended values in place.

    amendments (document_id, line, column, value, ordinal); an amended term makes its line handwritten.
    """
    terms = ("quantity", "unit_price", "extended_amount")
    good = amendments.filter(F.col("column").isin(*terms) & F.col("value").isNotNull())
    last = good.groupBy("document_id", "line").agg(*(F.max_by("value", F.when(F.col("column") == t, F.col("ordinal"))).alias(f"new_{t}") for t in terms))
    out = lines.join(last, ["document_id", "line"], "left")
    changed = F.coalesce(*(F.col(f"new_{t}") for t in terms)).isNotNull()
    return out.withColumn("handwritten", F.coalesce("handwritten", F.lit(False)) | changed).withColumns({t: F.coalesce(F.col(f"new_{t}").cast(WIDE), F.col(t).cast(WIDE)) for t in terms}).drop(*(f"new_{t}" for t in terms))


def line_checks(lines: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Each line's extended amount against quantity * unit price - discount: pass, fail, or not_applicable with a missing term."""
    q, p, e = (F.col(c).cast("decimal(18,6)") for c in ("quantity", "unit_price", "extended_amount"))
    expected = (q * p).cast(WIDE) - F.coalesce(F.col("discount").cast(WIDE), F.lit(0).cast(WIDE))
    delta = F.round(e.cast(WIDE) - expected, 4)
    status = F.when(q.isNull() | p.isNull() | e.isNull(), "not_applicable").when(F.abs(delta) <= tolerance, "pass").otherwise("fail")
    return lines.withColumns({"expected": F.round(expected, 2), "delta": delta, "status": status})


def _check(name: str, stated: Column, expected: Column, tolerance: Column, applies: Column) -> Column:
    delta = F.round(stated.cast(WIDE) - expected.cast(WIDE), 4)
    made = F.struct(F.lit(name).alias("check"), F.when(F.abs(delta) <= tolerance, "pass").otherwise("fail").alias("status"), F.round(expected.cast(WIDE), 2).alias("expected"), F.round(stated.cast(WIDE), 2).alias("stated"), delta.alias("delta"))
    return F.when(applies, made)


def document_proof(headers: DataFrame, lines: DataFrame, accessorials: DataFrame, tolerance: float = 0.01, defer_ungrouped: bool = False) -> DataFrame:
    """One row a header: its status, checks, how many ran and failed, and the largest failure.

    headers (document_id, subtotal, tax, freight, accessorial, discount, total, credits, due
    [, document_group_id]); lines as in :func:`line_checks`; accessorials (document_id, charge).
    Lines sum to the subtotal, subtotal and charges to the total, total less credits to
    the amount due, accessorial lines to their total.  A sum's tolerance grows with the rows it sums, a
    header identity's does not.  A document whose checks hold while a line could not be read is
    proved_with_unproved_lines, one without any check not_provable.
    """
    done = line_checks(lines, tolerance)
    by = done.groupBy("document_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.col("extended_amount").cast(WIDE)), F.lit(0).cast(WIDE)).cast(WIDE).alias("computed"),
        F.sum((F.col("status") == "not_applicable").cast("long")).alias("missing"),
        F.sum((F.col("status") != "not_applicable").cast("long")).alias("line_run"),
        F.sum((F.col("status") == "fail").cast("long")).alias("line_failed"),
        F.max(F.when(F.col("status") == "fail", F.abs("delta"))).alias("line_worst"),
        F.max("handwritten").alias("handwritten"),
    )
    acc = accessorials.groupBy("document_id").agg(F.count(F.lit(1)).alias("acc_rows"), F.coalesce(F.sum(F.col("charge").cast(WIDE)), F.lit(0).cast(WIDE)).cast(WIDE).alias("acc_sum"))
    d = headers.join(by, "document_id", "left").join(acc, "document_id", "left")
    n = {c: F.coalesce(F.col(c).cast(WIDE), F.lit(0).cast(WIDE)) for c in CHARGES}
    base = F.lit(tolerance).cast(WIDE)
    grown = lambda rows: base + F.lit(ROW_ROUNDING).cast(WIDE) * F.greatest(F.coalesce(F.col(rows), F.lit(0)) - 1, F.lit(0))
    subtotal, total = F.col("subtotal").cast(WIDE), F.col("total").cast(WIDE)
    checks = F.array(
        _check("lines_sum_to_subtotal", subtotal, F.col("computed"), grown("rows"), F.col("rows").isNotNull() & subtotal.isNotNull()),
        _check("subtotal_plus_charges_equals_total", total, subtotal + n["tax"] + n["freight"] + n["accessorial"] - n["discount"], base, subtotal.isNotNull() & total.isNotNull()),
        _check("total_less_credits_equals_amount_due", F.col("due"), total - n["credits"], base, total.isNotNull() & F.col("due").isNotNull()),
        _check("accessorial_lines_sum_to_total", n["accessorial"], F.col("acc_sum"), grown("acc_rows"), F.col("acc_rows").isNotNull()),
    )
    d = d.withColumn("checks", F.filter(checks, lambda x: x.isNotNull()))
    failed = F.filter("checks", lambda x: x["status"] == "fail")
    d = d.withColumns({"checks_run": F.coalesce("line_run", F.lit(0)) + F.size("checks"), "checks_failed": F.coalesce("line_failed", F.lit(0)) + F.size(failed), "worst": F.greatest(F.coalesce("line_worst", F.lit(0).cast(WIDE)), F.coalesce(F.array_max(F.transform(failed, lambda x: F.abs(x["delta"]))), F.lit(0).cast(WIDE)))})
    alone = F.col("document_group_id").isNull() if defer_ungrouped else F.lit(False)
    status = F.when(F.col("checks_run") == 0, F.when(alone, "deferred_reassembly").otherwise("not_provable")).when(F.col("checks_failed") > 0, "failed").when(F.coalesce("missing", F.lit(0)) > 0, "proved_with_unproved_lines").otherwise("proved")
    return d.select("document_id", status.alias("arithmetic_status"), "checks_run", "checks_failed", F.round("worst", 2).alias("largest_discrepancy"), F.coalesce("missing", F.lit(0)).alias("lines_missing_fields"), F.coalesce("handwritten", F.lit(False)).alias("handwriting_involved"), "checks")


def commission_proof(lines: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """One row a document of commission lines (document_id, base, rate, commission): its rate unit and status.

    The unit is the one reading, percent or fraction, under which its own lines reconcile; lines that
    both readings satisfy say nothing, and documents whose lines disagree are refused.
    """
    b, r, c = (F.col(x).cast("double") for x in ("base", "rate", "commission"))
    off = {name: F.round(c - b * r / divisor, 9) for name, divisor in (("percent", 100), ("fraction", 1))}
    fits = {name: F.coalesce(F.abs(x) <= tolerance, F.lit(False)) for name, x in off.items()}
    whole = b.isNotNull() & r.isNotNull() & c.isNotNull()
    agg = [F.bool_or(fits["percent"] & ~fits["fraction"]).alias("p"), F.bool_or(fits["fraction"] & ~fits["percent"]).alias("f"), F.sum(whole.cast("long")).alias("whole"), F.sum((~whole).cast("long")).alias("missing")]
    for name, x in off.items():
        bad = whole & ~fits[name]
        agg += [F.sum(bad.cast("long")).alias(f"failed_{name}"), F.max(F.when(bad, F.abs(x))).alias(f"worst_{name}")]
    d = lines.groupBy("document_id").agg(*agg)
    unit = F.when(F.col("p") & F.col("f"), "mixed").when(F.col("p"), "percent").when(F.col("f"), "fraction")
    d = d.withColumn("rate_unit", unit)
    failed = F.when(F.col("rate_unit") == "percent", F.col("failed_percent")).when(F.col("rate_unit") == "fraction", F.col("failed_fraction")).otherwise(0)
    worst = F.when(F.col("rate_unit") == "percent", F.col("worst_percent")).when(F.col("rate_unit") == "fraction", F.col("worst_fraction"))
    known = F.col("rate_unit").isin("percent", "fraction")
    status = F.when(~F.coalesce(known, F.lit(False)), "not_provable").when(failed > 0, "failed").otherwise("proved")
    return d.select("document_id", "rate_unit", status.alias("arithmetic_status"), F.when(known, F.col("whole")).otherwise(0).alias("checks_run"), failed.alias("checks_failed"), F.round(F.coalesce(worst, F.lit(0.0)), 2).alias("largest_discrepancy"), "missing")
