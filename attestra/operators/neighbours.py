"""Documents beside those that share their identifiers: for a target, the few that share most, and the identifiers shared."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import Scratch

# Words that mark a field as an identifier of business, and the lengths of an identifier.
MARKS = ("ack", "job", "project", "po", "purchase", "invoice", "order", "payment", "check", "remit", "reference", "transaction", "payee", "payer", "vendor", "customer", "supplier", "party")
SHORTEST, LONGEST = 3, 120

FIND, VERIFY = "cross_packet_", "cross_packet_verification_"
NONE, DEFERRED = "no_shared_source_identifier", "deferred_by_cap"


def identifiers(leaves: DataFrame) -> DataFrame:
    """(document_id, token), each once: texts under a marked name, without case and with single blanks.

    ``leaves`` is (document_id, path, value) as :func:`attestra.operators.paths.flatten` gives them.  A name anywhere on the
    path marks what is below it.  Numbers, null paths, and texts of under 3 or over 120 characters or without a
    letter or digit give nothing.
    """
    texts = leaves.filter(F.col("value").startswith('"') & F.lower("path").rlike("|".join(MARKS)))
    token = F.trim(F.regexp_replace(F.lower(F.get_json_object(F.concat(F.lit("["), "value", F.lit("]")), "$[0]")), r"(?U)\s+", " "))
    out = texts.select("document_id", token.alias("token")).filter(F.length("token").between(SHORTEST, LONGEST) & F.col("token").rlike(r"[\p{L}\p{N}]"))
    return out.distinct()


def neighbourhoods(tokens: DataFrame, targets: DataFrame, max_documents: int, max_neighbourhoods: int | None = None, verify: bool = False, light: int = 64) -> tuple[DataFrame, DataFrame]:
    """(document_id, related, tokens) of the targets, and (document_id, reason) of those passed over.

    ``tokens`` is (document_id, token), ``targets`` (document_id, ordinal).  Related are the max_documents - 1 documents that
    share most identifiers, ties by id; ``tokens`` are the identifiers shared with any of them, sorted.  A target that shares none
    is passed over; of the rest the first ``max_neighbourhoods`` by ordinal are taken (ties by id) and the others deferred.

    No pairs are listed inside an identifier of more than ``light`` documents.  Such heavy identifiers make classes, the
    documents that hold the same ones; a class keeps its max_documents smallest ids, and classes are paired instead.  That
    loses nothing: a document that shares heavy identifiers alone comes after the smaller ids of its class, which share as
    much or more.  Documents that share a lighter one are found by it, with their whole count.  Nulls and repeated rows count for nothing.
    """
    if max_documents < 2 or (max_neighbourhoods is not None and max_neighbourhoods < 1):
        raise ValueError("a neighbourhood takes at least two documents, and a cap is positive")
    s = Scratch(tokens.sparkSession, "neighbours")
    base = s.table(tokens.select("document_id", "token").dropna().distinct())
    counts = s.table(base.groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    held = s.table(base.join(counts, "token"))
    some = lambda c: F.sort_array(F.collect_list(F.when(c, F.col("token"))))
    docs = s.table(held.groupBy("document_id").agg(some(F.lit(True)).alias("tokens"), some(F.col("n") > light).alias("heavy")))
    asked = targets.select("document_id", "ordinal").dropna(subset=["document_id"]).groupBy("document_id").agg(F.min("ordinal").alias("ordinal"))
    told = s.table(asked.join(docs, "document_id", "left"))
    place = F.struct(F.col("ordinal"), F.col("document_id"))
    able = told.filter("tokens is not null")
    chosen = able
    if max_neighbourhoods is not None:
        last = able.select(place.alias("at")).orderBy("at").limit(max_neighbourhoods).agg(F.max("at").alias("last"))
        chosen = able.crossJoin(F.broadcast(last)).filter(place <= F.col("last")).drop("last")  # one row
    chosen = s.table(chosen)
    # by lighter identifiers: at most ``light`` documents each, counted with the heavy ones that both hold
    few = held.filter(F.col("n") <= light).select("document_id", "token")
    mine = few.join(chosen.select("document_id"), "document_id", "left_semi")
    pairs = mine.join(few.withColumnRenamed("document_id", "other"), "token").filter("document_id <> other").groupBy("document_id", "other").agg(F.count(F.lit(1)).alias("light"))
    pairs = pairs.join(chosen.select("document_id", "heavy"), "document_id").join(docs.select(F.col("document_id").alias("other"), F.col("heavy").alias("theirs")), "other")
    near = pairs.select("document_id", "other", (F.col("light") + F.size(F.array_intersect("heavy", "theirs"))).alias("shared"))
    # by heavy ones: classes
    first = Window.partitionBy("heavy").orderBy("document_id")
    kept = docs.filter(F.size("heavy") > 0).withColumn("k", F.row_number().over(first)).filter(F.col("k") <= max_documents)
    classes = s.table(kept.groupBy("heavy").agg(F.sort_array(F.collect_list("document_id")).alias("ids")).withColumn("class", F.sha2(F.to_json("heavy"), 256)))
    from_ = chosen.filter(F.size("heavy") > 0).select("heavy").distinct().select(F.sha2(F.to_json("heavy"), 256).alias("class"), F.explode("heavy").alias("token"))
    to = classes.select(F.col("class").alias("with"), F.explode("heavy").alias("token"))
    met = from_.join(to, "token").groupBy("class", "with").agg(F.count(F.lit(1)).alias("shared"))
    met = met.join(classes.select(F.col("class").alias("with"), "ids"), "with").select("class", "shared", F.explode("ids").alias("other"))
    best = Window.partitionBy("class").orderBy(F.desc("shared"), "other")
    met = met.withColumn("k", F.row_number().over(best)).filter(F.col("k") <= max_documents).select("class", "other", "shared")
    far = chosen.select("document_id", F.sha2(F.to_json("heavy"), 256).alias("class")).join(met, "class").filter("document_id <> other").select("document_id", "other", "shared")
    every = near.unionByName(far).groupBy("document_id", "other").agg(F.max("shared").alias("shared"))
    w = Window.partitionBy("document_id").orderBy(F.desc("shared"), "other")
    top = every.withColumn("k", F.row_number().over(w)).filter(F.col("k") < max_documents)
    top = top.join(docs.select(F.col("document_id").alias("other"), F.col("tokens").alias("theirs")), "other").join(chosen.select("document_id", "tokens"), "document_id")
    listed = F.sort_array(F.collect_list(F.struct("k", "other", F.array_intersect("tokens", "theirs").alias("t"))))
    out = top.groupBy("document_id").agg(listed.alias("x")).select("document_id", F.transform("x", lambda r: r["other"]).alias("related"), F.array_sort(F.array_distinct(F.flatten(F.transform("x", lambda r: r["t"])))).alias("tokens"))
    lead = VERIFY if verify else FIND
    lead_deferred = VERIFY if verify else FIND + "discovery_"
    lone = told.filter("tokens is null").select("document_id", F.lit(lead + NONE).alias("reason"))
    later = able.join(chosen.select("document_id"), "document_id", "left_anti").select("document_id", F.lit(lead_deferred + DEFERRED).alias("reason"))
    return out, lone.unionByName(later)


def packets(found: DataFrame, records: DataFrame, max_bytes: int) -> DataFrame:
    """(document_id, documents, bytes, reason): a neighbourhood's size, target and related records together.

    ``records`` is (document_id, record: text).  A packet over ``max_bytes`` is no packet: its row says so in ``reason``.
    A null or missing record counts zero bytes.
    """
    sizes = records.groupBy("document_id").agg(F.sum(F.octet_length(F.coalesce("record", F.lit("")))).alias("b"))
    parts = found.select("document_id", F.explode(F.concat(F.array("document_id"), "related")).alias("part"))
    out = parts.join(sizes.withColumnRenamed("document_id", "part"), "part", "left").groupBy("document_id").agg(F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum("b"), F.lit(0)).cast("long").alias("bytes"))
    return out.withColumn("reason", F.when(F.col("bytes") > max_bytes, "packet_exceeds_context_bytes"))
