"""The change journal as tables: proposals, previews against the present, authorisations, one application each.

Signatures are the caller's: an authorisation row arrives checked.  The journal is only
appended to; every state is derived from it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def admit(journal: DataFrame, requests: DataFrame) -> DataFrame:
    """Requests (owner, kind, request_key, request_hash) against the journal: new, repeated, or a key that names other input."""
    mine = requests.groupBy("owner", "kind", "request_key").agg(F.countDistinct("request_hash").alias("k"), F.min("request_hash").alias("request_hash"))
    past = journal.groupBy("owner", "kind", "request_key").agg(F.min("request_hash").alias("past_hash"))
    out = mine.join(past, ["owner", "kind", "request_key"], "left")
    outcome = F.when(F.col("k") > 1, "conflicting").when(F.col("past_hash").isNull(), "new").when(F.col("past_hash") == F.col("request_hash"), "repeated").otherwise("conflicting")
    return out.select("owner", "kind", "request_key", outcome.alias("outcome"))


def preview(proposals: DataFrame, current: DataFrame) -> DataFrame:
    """Proposals (change_id, key, field, expected, proposed) with the present value; stale where it is no longer the expected one."""
    out = proposals.join(current.select("key", "field", "value"), ["key", "field"], "left")
    status = F.when(F.col("value").isNull() & F.col("expected").isNotNull(), "missing").when(~F.col("value").eqNullSafe(F.col("expected")), "stale").when(F.col("proposed").eqNullSafe(F.col("value")), "no_change").otherwise("ready")
    return out.withColumn("status", status)


def authorised(previews: DataFrame, authorisations: DataFrame, now: str) -> DataFrame:
    """Ready changes with an authorisation that is not expired and not by the proposer."""
    a = authorisations.filter(F.col("expires_at") > F.lit(now)).select("change_id", "authorised_by")
    ready = previews.filter("status = 'ready'").join(a, "change_id", "left")
    good = ready.groupBy(*previews.columns).agg(F.max(F.when(F.col("authorised_by") != F.col("owner"), F.col("authorised_by"))).alias("authorised_by"), F.count("authorised_by").alias("n"))
    return good.withColumn("gate", F.when(F.col("authorised_by").isNotNull(), "open").when(F.col("n") > 0, "same_person").otherwise("not_authorised")).drop("n")


def apply_once(current: DataFrame, changes: DataFrame, applied: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(new values beside the prior ones, journal rows to append); a change that was applied before is not applied again."""
    fresh = changes.filter("gate = 'open'").join(applied.select("change_id"), "change_id", "left_anti")
    one = fresh.groupBy("key", "field").agg(F.min(F.struct("change_id", "proposed")).alias("c"), F.count(F.lit(1)).alias("n")).filter("n = 1")
    take = one.select("key", "field", F.col("c.change_id").alias("change_id"), F.col("c.proposed").alias("proposed"))
    out = current.join(take, ["key", "field"], "left")
    rows = out.select("key", "field", F.col("value").alias("prior_value"), F.when(F.col("change_id").isNotNull(), F.col("proposed")).otherwise(F.col("value")).alias("value"), "change_id")
    return rows, take.select("change_id", F.lit("applied").alias("kind"))


def reconcile(applied: DataFrame, current: DataFrame) -> DataFrame:
    """Applied changes (change_id, key, field, proposed) whose value is not there."""
    out = applied.join(current.select("key", "field", "value"), ["key", "field"], "left")
    return out.filter(~F.col("value").eqNullSafe(F.col("proposed"))).select("change_id", "key", "field", "proposed", "value")
