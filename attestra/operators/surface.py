"""What unsettled readings hold: candidates by field, signals in their texts, and the scope of a second reading.

Nothing here is a fact: candidates have passed no consensus, so no row of these tables may become a value or a node.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import Scratch

# Words of a field's name by topic, and patterns that a text is searched for.
TOPICS = {
    "address": ("address",),
    "contact": ("contact", "email", "e_mail", "phone", "telephone", "mobile", "fax", "attn"),
    "party": ("buyer", "seller", "vendor", "customer", "dealer", "payer", "payee", "shipper", "consignee", "brand", "origin", "destination", "sales_rep", "representative"),
    "sales_representative": ("sales_rep", "sales_representative", "salesperson", "sales_person", "representative", "account_manager", "account_executive", "agent"),
}
SIGNALS = {
    "attention": r"(?iU)\b(?:attn\.?|attention)\b",
    "contact_or_representative_label": r"(?iU)\b(?:contact|sales\s*(?:rep(?:resentative)?|person)|representative|account\s*(?:manager|executive))\b",
    "email": r"(?iU)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b",
    "phone": r"(?iU)(?<!\w)(?:\+\d{1,3}[ .-]?)?(?:\(?\d{2,4}\)?[ .-]){1,3}\d{3,4}(?:\s*(?:x|ext\.?|extension)\s*\d{1,6})?(?!\w)",
}
MAX_SAMPLES = 1000


def topics(field: Column) -> Column:
    """The topics that a field's name speaks of, in order of their names."""
    name = F.regexp_replace(F.lower(field), "[^a-z0-9]+", "_")
    return F.array_compact(F.array(*(F.when(name.rlike("|".join(words)), F.lit(t)) for t, words in sorted(TOPICS.items()))))


def signals(text: Column) -> Column:
    """The signals found in a text, in order of their names."""
    return F.array_compact(F.array(*(F.when(text.rlike(p), F.lit(k)) for k, p in sorted(SIGNALS.items()))))


def _step(name: Column) -> Column:
    return F.concat(F.lit("/"), F.replace(F.replace(name, F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1")))


class Retained:
    """The unsettled candidates of ``documents``: (index, document_id, fields: JSON text, an object of claims by field).

    A claim is an object with candidate_values, and perhaps accepted and consensus_flag.  ``candidates`` is (document_id, field,
    pointer, value: JSON, flag), ``signals`` (signal, document_id, field, pointer, text: every text inside a candidate),
    ``exceptions`` (index, document_id, field, reason).  Accepted claims, claims without candidates and null candidates give
    nothing.  A blank id, fields that are no object (null too), a claim that is none or has a blank name, and candidates that are no
    list are exceptions.  Candidates are written once; containers are opened a level at a time,
    whatever their depth, and a level is written without the texts that are done.
    """

    def __init__(self, documents: DataFrame):
        spark = documents.sparkSession
        s = self.scratch = Scratch(spark, "surface")
        none = F.lit(None).cast("string")
        kind = lambda c: F.coalesce(F.schema_of_variant(c), F.lit("VOID"))
        base = documents.select("index", F.col("document_id").cast("string").alias("document_id"), F.try_parse_json("fields").alias("v"))
        base = base.select("index", "document_id", F.to_json("v").alias("fields"), kind("v").startswith("OBJECT<").alias("object"))
        named = F.trim(F.coalesce("document_id", F.lit(""))) != ""
        bad = [
            base.filter(~named).select("index", none.alias("document_id"), none.alias("field"), F.lit("candidate_inventory_document_id_missing").alias("reason")),
            base.filter(named & ~F.col("object")).select("index", "document_id", none.alias("field"), F.lit("candidate_inventory_fields_missing").alias("reason")),
        ]
        opened = base.filter(named & F.col("object")).select("index", "document_id", F.parse_json("fields").alias("v"))
        claims = opened.lateralJoin(spark.tvf.variant_explode(F.col("v").outer())).select("index", "document_id", F.col("key").alias("field"), F.col("value").alias("claim"))
        whole = kind("claim").startswith("OBJECT<") & (F.trim("field") != "")
        values = F.variant_get("claim", "$.candidate_values", "variant")
        flag = F.variant_get("claim", "$.consensus_flag", "variant")
        claims = claims.select(
            "index", "document_id", "field", whole.alias("whole"), kind(values).alias("kind"), F.when(whole, F.to_json(values)).alias("values"),
            F.when(kind(flag) == "STRING", F.variant_get("claim", "$.consensus_flag", "string")).alias("flag"), (F.coalesce(F.to_json(F.variant_get("claim", "$.accepted", "variant")), F.lit("")) == "true").alias("accepted"),
        )
        bad.append(claims.filter("not whole").select("index", "document_id", "field", F.lit("candidate_inventory_field_claim_malformed").alias("reason")))
        unsettled = claims.filter("whole and not accepted and kind <> 'VOID'")
        array = F.col("kind").startswith("ARRAY<")
        bad.append(unsettled.filter(~array).select("index", "document_id", "field", F.lit("candidate_inventory_values_malformed").alias("reason")))
        listed = unsettled.filter(array).select("index", "document_id", "field", "flag", F.parse_json("values").alias("l"))
        listed = listed.lateralJoin(spark.tvf.variant_explode(F.col("l").outer()))
        pointer = F.concat(F.lit("/documents/"), F.col("index").cast("string"), F.lit("/fields"), _step(F.col("field")), F.lit("/candidate_values/"), F.col("pos").cast("string"))
        self.candidates = s.table(listed.select("document_id", "field", pointer.alias("pointer"), F.to_json("value").alias("value"), "flag").filter("value <> 'null'"))
        self.exceptions = bad[0]
        for b in bad[1:]:
            self.exceptions = self.exceptions.unionByName(b)
        self.signals = self._signals()

    def _signals(self) -> DataFrame:
        s, spark = self.scratch, self.scratch.spark
        key, text = ["document_id", "field", "pointer"], F.get_json_object(F.concat(F.lit("["), "value", F.lit("]")), "$[0]")
        inside = F.col("value").rlike(r"^[\[{].") & ~F.col("value").isin("{}", "[]")
        heard = F.when(F.col("value").startswith('"'), signals(text))

        def told(df: DataFrame) -> DataFrame:
            return df.filter(F.size("heard") > 0).select(F.explode("heard").alias("signal"), *key, text.alias("text"))

        now = self.candidates.select(*key, "value").withColumn("heard", heard)
        found = [told(now)]
        while not now.filter(inside).isEmpty():
            parts = now.filter(inside).select(*key, F.parse_json("value").alias("v")).lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
            step = F.when(F.col("key").isNull(), F.concat(F.lit("/"), F.col("pos").cast("string"))).otherwise(_step(F.col("key")))
            opened = parts.select("document_id", "field", F.concat("pointer", step).alias("pointer"), F.to_json("value").alias("value")).withColumn("heard", heard)
            # a level keeps what is still to be opened and what has a signal, no other text
            now = s.table(opened.filter(inside | (F.size("heard") > 0)))
            found.append(told(now))
        out = found[0]
        for f in found[1:]:
            out = out.unionByName(f)
        return s.table(out)


def _first(df: DataFrame, group: list[str], order: list[str], shown: int) -> DataFrame:
    """The ``shown`` first rows of each group; a task passes on that many of a group at most."""
    return df.withColumn("_k", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).filter(F.col("_k") <= shown).drop("_k")


def _samples(n: int) -> int:
    if not 1 <= n <= MAX_SAMPLES:
        raise ValueError("samples are between 1 and 1000")
    return n


def surface(kept: Retained, samples: int) -> DataFrame:
    """One row a field of unsettled candidates: occurrences, documents, distinct values, and the first ``samples`` of each.

    (field, occurrences, documents, distinct_values, values, document_ids, pointers, flags, topics).  Values are compared and
    ordered as JSON text with sorted names.  Each kind is made distinct by shuffle and only its first few are gathered; flags are
    gathered whole, as they are a consensus's own few words.
    """
    n = _samples(samples)
    kinds = {"value": F.col("value"), "document": F.col("document_id"), "pointer": F.col("pointer"), "flag": F.col("flag")}
    items = kept.candidates.select("field", F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), c.alias("item")) for k, c in kinds.items()))).alias("x")).select("field", "x.*")
    items = kept.scratch.table(items.filter("item is not null").distinct())
    sums = items.groupBy("field").agg(*(F.count_if(F.col("kind") == k).alias(f"_{k}") for k in kinds))
    head = _first(items.filter("kind <> 'flag'"), ["field", "kind"], ["item"], n).unionByName(items.filter("kind = 'flag'"))
    lists = head.groupBy("field").agg(*(F.sort_array(F.collect_list(F.when(F.col("kind") == k, F.col("item")))).alias(k) for k in kinds))
    out = sums.join(lists, "field")
    return out.select("field", F.col("_pointer").alias("occurrences"), F.col("_document").alias("documents"), F.col("_value").alias("distinct_values"), F.col("value").alias("values"), F.col("document").alias("document_ids"), F.col("pointer").alias("pointers"), F.col("flag").alias("flags"), topics(F.col("field")).alias("topics"))


def signal_summary(kept: Retained, samples: int) -> DataFrame:
    """(signal, occurrences, documents, fields, examples): examples are the first distinct by document, field, pointer, text."""
    key = ["document_id", "field", "pointer", "text"]
    rows = kept.signals
    sums = rows.groupBy("signal").agg(F.count(F.lit(1)).alias("occurrences"), F.count_distinct("document_id").alias("documents"), F.count_distinct("field").alias("fields"))
    first = _first(rows.distinct(), ["signal"], key, _samples(samples)).groupBy("signal").agg(F.sort_array(F.collect_list(F.struct(*key))).alias("examples"))
    return sums.join(first, "signal")


def recovery_scope(kept: Retained, wanted_topics: tuple[str, ...] = (), wanted_signals: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """What a second, independent reading should look at: ``candidates`` (their places, no values), ``signals`` and ``documents``.

    Candidates are of fields that speak of a wanted topic, signals of a wanted kind.  Nothing asked, or an unknown name, is an error.
    """
    unknown = (set(wanted_topics) - set(TOPICS)) | (set(wanted_signals) - set(SIGNALS))
    if unknown or not (wanted_topics or wanted_signals):
        raise ValueError("unknown topic or signal: " + ", ".join(sorted(unknown)) if unknown else "a topic or a signal is needed")
    asked = F.array(*map(F.lit, wanted_topics)).cast("array<string>")
    picked = kept.candidates.select("document_id", "field", "pointer", topics(F.col("field")).alias("topics"), "flag").filter(F.arrays_overlap("topics", asked))
    heard = kept.signals.filter(F.col("signal").isin(*wanted_signals)) if wanted_signals else kept.signals.limit(0)
    ids = picked.groupBy("document_id").agg(F.count(F.lit(1)).alias("candidates")).join(heard.groupBy("document_id").agg(F.count(F.lit(1)).alias("signals")), "document_id", "full")
    documents = ids.select("document_id", F.coalesce("candidates", F.lit(0)).alias("candidates"), F.coalesce("signals", F.lit(0)).alias("signals"))
    return {"candidates": picked, "signals": heard, "documents": documents}
