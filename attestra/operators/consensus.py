"""Field consensus, voting and agreement over the long readings table (document_id, row_index, field, vendor, value, handwritten)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELL = ("document_id", "row_index", "field")


# Names that make a field an identifier, and names that make it a number.
IDENTIFIERS = ("account", "code", "identifier", "invoice_number", "number", "postal", "reference", "tracking", "zip")
NUMBERS = ("amount", "total", "subtotal", "price", "qty", "quantity", "weight", "rate", "tax", "freight", "discount", "value", "duty", "count", "pieces")
TOLERANCE = 0.005


def field_kind(field: Column) -> Column:
    """identifier, number or prose, by the field's name; an identifier is never compared as a number."""
    low = F.lower(field)
    named = lambda hints: reduce(lambda a, b: a | b, (F.contains(low, F.lit(h)) for h in hints))
    return F.when(named(IDENTIFIERS), "identifier").when(named(NUMBERS), "number").otherwise("prose")


def as_number(value: Column) -> Column:
    """A reading as a number to four decimals, or null."""
    # a text without a digit is none, and a failed cast is dear
    return F.when(value.rlike(r"\p{Nd}"), F.translate(value, ",$ ", "").try_cast("decimal(38,4)"))


def folded(value: Column) -> Column:
    """A reading without case, outer blanks or runs of blanks."""
    low = F.lower(value)
    return F.when(low.rlike(r"\s"), F.trim(F.regexp_replace(low, r"\s+", " "))).otherwise(low)


def comparable(value: Column) -> Column:
    """What makes two readings of no known field equal: a number to four decimals, else folded text."""
    return F.coalesce(as_number(value).cast("string"), folded(value))


def _prose(value: Column) -> Column:
    return F.regexp_replace(F.lower(value), "[^0-9a-z]+", "")


def agreement_key(kind: Column, value: Column) -> Column:
    """What readings of a field share when they agree, but for numbers, which also agree within a tolerance."""
    prose = _prose(value)
    return F.when(kind == "number", F.coalesce(as_number(value).cast("string"), F.nullif(folded(value), F.lit("")))).when(kind == "identifier", folded(value)).otherwise(prose)


def values_agree(field: Column, a: Column, b: Column) -> Column:
    """Whether two readings of a named field agree: numbers within the tolerance, identifiers without case and runs of blanks, prose without punctuation."""
    kind = field_kind(field)
    x, y = (F.when(kind == "number", as_number(v)) for v in (a, b))
    return F.coalesce(F.abs(x - y) <= F.lit(TOLERANCE).cast("decimal(38,6)"), agreement_key(kind, a).eqNullSafe(agreement_key(kind, b)))


def _reading_order(number: Column, text: Column) -> Column:
    """The order in which readings are clustered: as text, numbers by their shortest decimal form, nulls last; number and text as :func:`clusters` has them."""
    short = F.rtrim(number, F.lit("0"))
    number = F.when(short.endswith("."), F.concat(short, F.lit("0"))).otherwise(short)
    return F.coalesce(number, F.concat(F.lit('"'), F.nullif(text, F.lit("")), F.lit('"')), F.lit("null"))


def clusters(readings: DataFrame, tolerance: float = TOLERANCE, numeric: Column | None = None) -> DataFrame:
    """(cell, kind, handwritten, readers, clusters, ambiguous): complete-linkage clusters of each cell's readings.

    Clusters hold what they agree on, their readers and first value, largest first.  A reading joins
    the one cluster all of whose members it agrees with; one that fits several stays alone
    and makes the cell ambiguous.  A cell's readings are as many as its readers, so the
    fold is over a short list, after a single shuffle.
    """
    kinds = field_kind(F.col("field")) if numeric is None else F.when(numeric, "number").otherwise("prose")
    # each form of a reading is made once
    readings = readings.withColumns({"kind": kinds, "_number": as_number(F.col("value")), "_folded": folded(F.col("value"))}).withColumn("_digits", F.col("_number").cast("string"))
    kind, digits, text = F.col("kind"), F.col("_digits"), F.col("_folded")
    key = F.when(kind == "number", F.coalesce(digits, F.nullif(text, F.lit("")))).when(kind == "identifier", text).otherwise(_prose(F.col("value")))
    one = F.struct(_reading_order(digits, text).alias("o"), F.col("vendor").alias("vendor"), F.col("value").alias("value"), key.alias("key"), F.when(kind == "number", F.col("_number")).alias("x"))
    cells = readings.groupBy(*CELL).agg(F.sort_array(F.collect_list(one)).alias("r"), F.max("handwritten").alias("handwritten"), F.first("kind").alias("kind"))
    shape = "array<struct<n:int,o:string,value:string,key:string,lo:decimal(38,4),hi:decimal(38,4),vendors:array<string>>>"
    start = F.struct(F.array().cast(shape).alias("c"), F.lit(False).alias("ambiguous"))

    def fits(c: Column, r: Column) -> Column:
        near = (F.abs(r["x"] - c["lo"]) <= F.lit(tolerance).cast("decimal(38,6)")) & (F.abs(r["x"] - c["hi"]) <= F.lit(tolerance).cast("decimal(38,6)"))
        return F.coalesce(near, c["key"].eqNullSafe(r["key"]))

    def step(s: Column, r: Column) -> Column:
        k = F.size(F.filter(s["c"], lambda c: fits(c, r)))
        own = F.struct(F.lit(1).alias("n"), r["o"].alias("o"), r["value"].alias("value"), r["key"].alias("key"), r["x"].alias("lo"), r["x"].alias("hi"), F.array(r["vendor"]).alias("vendors"))

        def grown(c: Column) -> Column:
            return F.struct((c["n"] + 1).alias("n"), c["o"].alias("o"), c["value"].alias("value"), c["key"].alias("key"), F.least(c["lo"], r["x"]).alias("lo"), F.greatest(c["hi"], r["x"]).alias("hi"), F.concat(c["vendors"], F.array(r["vendor"])).alias("vendors"))

        joined = F.transform(s["c"], lambda c: F.when(fits(c, r), grown(c)).otherwise(c))
        return F.struct(F.when(k == 1, joined).otherwise(F.concat(s["c"], F.array(own))).cast(shape).alias("c"), (s["ambiguous"] | (k > 1)).alias("ambiguous"))

    # most cells are unanimous, which needs no fold
    one = F.col("r")[0]
    alone = F.struct(F.size("r").alias("n"), one["o"].alias("o"), one["value"].alias("value"), one["key"].alias("key"), one["x"].alias("lo"), one["x"].alias("hi"), F.col("r.vendor").alias("vendors"))
    unanimous = F.struct(F.array(alone).cast(shape).alias("c"), F.lit(False).alias("ambiguous"))
    same = F.size(F.array_distinct("r.key")) == 1
    found = cells.withColumn("f", F.when(same, unanimous).otherwise(F.aggregate("r", start, step)))
    ranked = F.transform(F.array_sort(F.transform("f.c", lambda c: F.struct((-c["n"]).alias("m"), c["o"].alias("o"), c.alias("c")))), lambda x: x["c"])
    ranked = F.when(F.size("f.c") == 1, F.col("f.c")).otherwise(ranked)
    return found.select(*CELL, "kind", "handwritten", F.size("r").alias("readers"), ranked.alias("clusters"), F.col("f.ambiguous").alias("ambiguous"))


def field_consensus(readings: DataFrame, numeric: Column | None = None, policy: str = "strict") -> DataFrame:
    """One row a cell: value if accepted, flag, rule, agreeing readers, whether it is queued, and its clusters.

    Printed cells need two readers, handwritten numbers three, handwritten text most of
    at least two; one reader never suffices; a tie or an ambiguous reading has no value.
    What a field is goes by its name, or by ``numeric``, over the cell's columns, where that is given.
    """
    cells = clusters(readings, numeric=numeric).withColumn("top", F.col("clusters")[0])
    n, agree, hw = F.col("readers"), F.col("top.n"), F.coalesce("handwritten", F.lit(False))
    comment = hw & F.lit(policy == "comment_only")
    numeric = F.col("kind") == "number"
    needed = F.when(comment, 0).when(hw & numeric, 3).when(hw, F.greatest(F.lit(2), F.floor(n / 2).cast("int") + 1)).when(n >= 2, 2).otherwise(1)
    majority = (agree * 2 > n) & ~F.col("ambiguous")
    accepted = ~comment & (n > 1) & majority & (agree >= needed) & (n >= needed)
    flag = F.when(n == 1, "single_engine").when(~majority, "no_consensus").otherwise(F.concat(F.lit("consensus_"), agree, F.lit("of"), n))
    flag = F.when((n > 1) & majority & ~accepted & (needed > agree), F.concat(flag, F.lit("_below_required_"), needed)).otherwise(flag)
    rule = F.when(comment, "handwritten_comment_only").when(hw & numeric, "handwritten_numeric_3of3").when(hw, "handwritten_text_majority").otherwise("printed_majority")
    queued = ~comment & (~accepted | ((agree < n) & (n >= 2)))
    candidates = F.col("clusters.value")
    return cells.select(*CELL, F.when(accepted, F.col("top.value")).alias("value"), flag.alias("consensus_flag"), rule.alias("rule"), agree.alias("agree_count"), n.alias("engine_count"), accepted.alias("accepted"), hw.alias("is_handwritten"), (~comment).alias("blocking"), queued.alias("queue_for_review"), F.when(~accepted, candidates).alias("candidates"), "clusters")


def derive_ordinals(readings: DataFrame, fields: tuple[str, ...] = ("line_number",)) -> tuple[DataFrame, DataFrame]:
    """(readings to vote on, cells whose value is the row's own position, with what each reader put there)."""
    ordinal = F.col("field").isin(*fields) & F.col("row_index").isNotNull()
    mine = readings.filter(ordinal).groupBy(*CELL).agg(F.count(F.lit(1)).cast("int").alias("engine_count"), F.sort_array(F.collect_list(F.struct("vendor", "value"))).alias("engine_readings"))
    out = mine.select(*CELL, F.col("row_index").cast("string").alias("value"), F.lit("derived_ordinal").alias("consensus_flag"), F.lit("derived_row_position").alias("rule"), "engine_count", F.lit(True).alias("accepted"), F.lit(False).alias("queue_for_review"), "engine_readings")
    return readings.filter(~F.coalesce(ordinal, F.lit(False))), out


def merge_documents(cells: DataFrame, engines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents with their status and counts, exceptions of queued cells) of consensus cells; engines (document_id, vendor) read the document.

    A field that some engine of the document did not return is queued even where the others agree.
    """
    readers = engines.groupBy("document_id").agg(F.sort_array(F.collect_set("vendor")).alias("engines"))
    read_by = F.array_distinct(F.flatten("clusters.vendors"))
    full = cells.join(readers, "document_id").withColumn("missing", F.array_except("engines", read_by))
    late = (F.size("missing") > 0) & (F.col("consensus_flag") != "no_consensus")
    full = full.withColumn("queue_for_review", F.col("queue_for_review") | late)
    hard = (F.col("consensus_flag") == "no_consensus") & F.col("blocking")
    out = full.groupBy("document_id").agg(F.max("engines").alias("engines"), F.count(F.lit(1)).alias("field_count"), F.sum(F.col("accepted").cast("long")).alias("accepted_field_count"), F.sum(hard.cast("long")).alias("hard"), F.sum(F.col("queue_for_review").cast("long")).alias("exception_count"), F.sum(F.col("is_handwritten").cast("long")).alias("handwritten_field_count"))
    status = F.when(F.col("hard") > 0, "open_exception").when(F.col("exception_count") > 0, "review_queued").otherwise("auto_accepted")
    cause = F.when(F.col("consensus_flag") == "no_consensus", "no_majority").otherwise("partial_disagreement")
    exceptions = full.filter("queue_for_review").select(*CELL, F.col("consensus_flag").alias("flag"), "rule", "is_handwritten", "accepted", "blocking", F.coalesce("candidates", F.array("value")).alias("candidates"), "missing", cause.alias("cause"))
    return out.withColumn("review_status", status), exceptions


def apply_resolutions(cells: DataFrame, resolutions: DataFrame) -> DataFrame:
    """Cells with each resolved value put in place, what accepted it, and what consensus had recorded."""
    r = resolutions.filter("resolved_value is not null").select(*CELL, "resolved_value", F.col("agreeing").alias("agreeing_vendors"))
    out = cells.join(r, list(CELL), "left")
    hit = F.col("resolved_value").isNotNull()
    return out.withColumns({"superseded_flag": F.when(hit, F.col("consensus_flag")), "accepted_by": F.when(hit, "vendor_agreement"), "value": F.coalesce("resolved_value", "value"), "accepted": F.col("accepted") | hit}).drop("resolved_value")


def apply_corroboration(cells: DataFrame, corroborations: DataFrame, authorization: str, unique_only: bool = False) -> DataFrame:
    """Open cells take the corroborated value (cell, value, occurrences) under an authorisation; an accepted cell is never overwritten."""
    good = corroborations.filter("value is not null" + (" and occurrences = 1" if unique_only else ""))
    good = good.select(*CELL, F.col("value").alias("supported"), "occurrences")
    out = cells.join(good, list(CELL), "left")
    hit = ~F.col("accepted") & F.col("supported").isNotNull()
    return out.withColumns({"superseded_flag": F.when(hit, F.col("consensus_flag")), "superseded_value": F.when(hit, F.col("value")), "value": F.when(hit, F.col("supported")).otherwise(F.col("value")), "blocking": F.col("blocking") & ~hit, "queue_for_review": F.col("queue_for_review") & ~hit, "authorization": F.when(hit, authorization), "accepted": F.col("accepted") | hit}).drop("supported")


def document_rollup(cells: DataFrame) -> DataFrame:
    """Accepted and open cells of each document, and its status."""
    out = cells.groupBy("document_id").agg(F.count(F.lit(1)).alias("cells"), F.sum(F.col("accepted").cast("long")).alias("accepted_cells"))
    return out.withColumn("status", F.when(F.col("cells") == F.col("accepted_cells"), "clear").otherwise("needs_review"))


def vendor_vote(cells: DataFrame, minimum: int = 2) -> DataFrame:
    """The outright leader of each open cell of :func:`field_consensus`; a tie or too few vendors stays unresolved, with the reason."""
    best = F.col("clusters")[0]
    leaders = F.size(F.filter("clusters", lambda c: c["n"] == F.col("clusters")[0]["n"]))
    reason = F.when(F.size("clusters") == 0, "no_vendor_read_this_field").when(leaders > 1, "vendors_tied").when(best["n"] < minimum, "below_minimum_vendor_agreement")
    open_ = cells.filter(~F.col("accepted"))
    return open_.select(*CELL, F.when(reason.isNull(), best["value"]).alias("resolved_value"), F.coalesce(best["n"], F.lit(0)).alias("agreeing"), reason.alias("reason"))


def classification_consensus(votes: DataFrame, minimum: int = 2) -> DataFrame:
    """(document_id, type): the one type that at least ``minimum`` vendors give."""
    per = votes.groupBy("document_id", "type").agg(F.countDistinct("vendor").alias("n")).filter(F.col("n") >= minimum)
    out = per.groupBy("document_id").agg(F.count(F.lit(1)).alias("k"), F.max("type").alias("type"), F.max("n").alias("vendors"))
    every = votes.select("document_id").distinct()
    return every.join(out, "document_id", "left").select("document_id", F.when(F.col("k") == 1, F.col("type")).alias("type"), F.when(F.col("k") == 1, "agreed").when(F.col("k") > 1, "contradictory").otherwise("no_agreement").alias("status"))


def engine_agreement(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two readers' (row_index, field) slots of each document: shared, equal, and values recalled anywhere in the document.

    One shuffle by slot and one by (document, value), each a partial aggregation of the union.
    """
    key = agreement_key(field_kind(F.col("field")), F.col("value"))
    both = a.select(*CELL, key.alias("k"), F.lit(True).alias("ref")).unionByName(b.select(*CELL, key.alias("k"), F.lit(False).alias("ref")))
    ka, kb = (F.max(F.when(F.col("ref") == side, F.col("k"))) for side in (True, False))
    slots = both.groupBy(*CELL).agg(ka.alias("ka"), kb.alias("kb")).groupBy("document_id").agg(F.count("ka").alias("reference_slots"), F.count("kb").alias("candidate_slots"), F.sum((F.col("ka") == F.col("kb")).cast("long")).alias("equal_slots"))
    values = both.groupBy("document_id", "k").agg(F.sum(F.col("ref").cast("long")).alias("n"), F.bool_or(~F.col("ref")).alias("known")).filter("known and k is not null")
    recalled = values.groupBy("document_id").agg(F.sum("n").alias("recalled"))
    return slots.join(recalled, "document_id", "left").withColumns({"recalled": F.coalesce("recalled", F.lit(0)), "equal_slots": F.coalesce("equal_slots", F.lit(0))})


def slot_equivalence(cells: DataFrame, least: int = 3) -> DataFrame:
    """Pairs of fields of one row that hold the same value, with how often; a self-join on (document, row, value)."""
    k = cells.select("document_id", "row_index", "field", comparable(F.col("value")).alias("k"))
    l, r = k.alias("l"), k.alias("r")
    on = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in ("document_id", "row_index", "k")] + [F.col("l.field") < F.col("r.field")]
    pairs = l.join(r, on).groupBy(F.col("l.field").alias("field_a"), F.col("r.field").alias("field_b"))
    return pairs.agg(F.count(F.lit(1)).alias("observations"), F.countDistinct("l.document_id").alias("documents"), F.countDistinct("l.k").alias("values")).filter(F.col("observations") >= least)


def corroboration(cells: DataFrame, pages: DataFrame) -> DataFrame:
    """Open cells against the page's text: exactly one candidate present settles the cell.  cells: (document_id, field, candidates)."""
    c = cells.select("document_id", "field", F.explode("candidates").alias("candidate"))
    hit = c.join(pages, "document_id").filter(F.contains(F.lower("text"), F.lower("candidate")))
    per = hit.groupBy("document_id", "field").agg(F.count(F.lit(1)).alias("present"), F.min("candidate").alias("value"))
    out = cells.select("document_id", "field").join(per, ["document_id", "field"], "left")
    return out.select("document_id", "field", F.coalesce("present", F.lit(0)).alias("present"), F.when(F.col("present") == 1, F.col("value")).alias("value"))


def tolerance_clusters(readings: DataFrame, tolerance: float = 0.005) -> DataFrame:
    """Complete-linkage clusters of numeric readings of a cell; a reading that fits two clusters makes the cell ambiguous.

    In sorted order a reading fits a cluster if it is within the tolerance of its first, and
    touches it if it is within the tolerance of its last: one fold over the sorted readings.
    """
    none = F.lit(None).cast("double")
    start = F.struct(none.alias("first"), none.alias("last"), F.lit(0).alias("size"), F.lit(0).alias("clusters"), F.lit(0).alias("largest"), none.alias("value"), F.lit(False).alias("ambiguous"))

    def step(s: Column, v: Column) -> Column:
        new = s["first"].isNull() | (v - s["first"] > tolerance + 1e-12)
        size = F.when(new, 1).otherwise(s["size"] + 1)
        first = F.when(new, v).otherwise(s["first"])
        touch = new & s["first"].isNotNull() & (v - s["last"] <= tolerance + 1e-12)
        return F.struct(first.alias("first"), v.alias("last"), size.alias("size"), (s["clusters"] + new.cast("int")).alias("clusters"), F.greatest(s["largest"], size).alias("largest"), F.when(size > s["largest"], first).otherwise(s["value"]).alias("value"), (s["ambiguous"] | F.coalesce(touch, F.lit(False))).alias("ambiguous"))

    rows = readings.withColumn("number", F.col("value").try_cast("double")).filter("number is not null")
    folded = rows.groupBy(*CELL).agg(F.aggregate(F.sort_array(F.collect_list("number")), start, step).alias("s"))
    return folded.select(*CELL, "s.clusters", "s.largest", "s.value", "s.ambiguous")


def independent_readers(readings: DataFrame, vendor_of: dict[str, str]) -> DataFrame:
    """One vote a vendor: of the engines that a vendor's models answer through, the first in name order speaks."""
    names = F.create_map(*(F.lit(x) for kv in vendor_of.items() for x in kv))
    v = readings.withColumn("engine", F.col("vendor")).withColumn("vendor", F.coalesce(names[F.col("vendor")], F.col("vendor")))
    first = F.row_number().over(Window.partitionBy(*CELL, "vendor").orderBy("engine"))
    return v.withColumn("_k", first).filter("_k = 1").drop("_k")


