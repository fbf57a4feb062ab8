"""Registered queries of readings, documents and their proof, merging, attribution, chunks and the change journal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .functions import values
from .operators import attribution, changes, chunks, consensus, entities, graph, loading, pages, proof, review, search, variants
from .registry import register
from .scratch import Scratch
from .sources.driver_tables import Driver, twin


def literal(d: Driver, rows: list[tuple], schema: str) -> DataFrame:
    return d.spark.createDataFrame(rows, schema)


# ---- scalar readings, with answers by hand --------------------------------------------


def _printed(d: Driver) -> DataFrame:
    """Amounts of lines as pages print them: every fifth order with decimal commas, one in thirty of those with both."""
    e, k = F.format_string("%.2f", F.col("l_extendedprice")), F.col("l_orderkey")
    comma = F.regexp_replace(e, r"\.", ",")
    text = F.when(k % 5 == 0, F.when((k % 150 == 0) & (F.col("l_linenumber") == 1), e).otherwise(comma)).when(k % 5 == 1, F.concat(F.lit("$"), e)).when(k % 5 == 2, F.concat(e, F.lit(" CAD"))).when(k % 5 == 3, F.concat(F.lit("("), e, F.lit(")"))).otherwise("n/a")
    return d.raw("lineitem").select(k.alias("document_id"), F.col("l_linenumber").alias("line"), text.alias("reading"))


@register("loadable_amounts", """WITH r AS (SELECT l_orderkey AS k, l_linenumber AS n, printf('%.2f', l_extendedprice) AS e FROM lineitem), m AS (SELECT k, bool_or(n = 1) AS one, bool_or(n <> 1) AS more FROM r GROUP BY 1)
SELECT CASE k % 5 WHEN 0 THEN 'comma' WHEN 1 THEN 'dollar' WHEN 2 THEN 'code' WHEN 3 THEN 'negative' ELSE 'none' END AS kind,
 CASE WHEN k % 5 = 2 THEN 'CAD' ELSE '' END AS currency, count(*) AS cells, count(v) AS loadable, round(CAST(coalesce(sum(v), 0) AS DOUBLE), 2) AS total FROM (
SELECT r.k, CASE WHEN k % 5 = 4 THEN NULL WHEN k % 5 = 0 AND k % 150 = 0 AND n = 1 THEN CASE WHEN NOT more OR one THEN CAST(e AS DECIMAL(18,2)) END
 WHEN k % 5 = 0 AND k % 150 = 0 AND one THEN NULL WHEN k % 5 = 3 THEN -CAST(e AS DECIMAL(18,2)) ELSE CAST(e AS DECIMAL(18,2)) END AS v FROM r JOIN m USING (k)) GROUP BY 1, 2""")
def _(d):
    printed = _printed(d)
    full = printed.join(values.separator_convention(printed, "document_id", "reading"), "document_id")
    amount, code = values.loadable_amount(F.col("reading"), F.col("convention"))
    k = F.col("document_id") % 5
    kind = F.when(k == 0, "comma").when(k == 1, "dollar").when(k == 2, "code").when(k == 3, "negative").otherwise("none")
    out = full.select(kind.alias("kind"), code.alias("currency"), F.nullif(amount, F.lit("")).cast("decimal(18,2)").alias("v"))
    return out.groupBy("kind", "currency").agg(F.count(F.lit(1)).alias("cells"), F.count("v").alias("loadable"), F.round(F.coalesce(F.sum("v"), F.lit(0)).cast("double"), 2).alias("total"))


@register("date_order_by_document", """WITH x AS (SELECT l_orderkey AS k, CAST(l_shipdate AS DATE) AS s FROM lineitem), g AS (SELECT k, bool_or(CASE WHEN k % 2 = 0 THEN month(s) > 12 ELSE day(s) > 12 END) AS a, bool_or(CASE WHEN k % 2 = 0 THEN day(s) > 12 ELSE month(s) > 12 END) AS b FROM x GROUP BY 1)
SELECT CASE WHEN a AND b THEN NULL WHEN b THEN 'month_first' WHEN a THEN 'day_first' END AS date_order, count(*) AS documents FROM g GROUP BY 1""")
def _(d):
    s, k = F.col("l_shipdate"), F.col("l_orderkey")
    cells = d.raw("lineitem").select(k.alias("document_id"), F.when(k % 2 == 0, F.date_format(s, "MM/dd/yyyy")).otherwise(F.date_format(s, "dd/MM/yyyy")).alias("cell"))
    return values.date_order(cells, "document_id", "cell").groupBy("date_order").agg(F.count(F.lit(1)).alias("documents"))


@register("names_one_edit_apart", "WITH n AS (SELECT DISTINCT p_brand AS n FROM part) SELECT a.n AS a, b.n AS b FROM n a JOIN n b ON a.n < b.n WHERE levenshtein(a.n, b.n) = 1")
def _(d):
    return variants.one_edit_pairs(d.raw("part"), "p_brand")


@register("customers_one_edit_apart", "WITH n AS (SELECT DISTINCT 'C' || c_custkey AS n FROM customer) SELECT a.n AS a, b.n AS b FROM n a JOIN n b ON a.n < b.n AND abs(length(a.n) - length(b.n)) <= 1 WHERE levenshtein(a.n, b.n) = 1")
def _(d):
    return variants.one_edit_pairs(d.raw("customer").select(F.concat(F.lit("C"), "c_custkey").alias("n")), "n")


@register("absorbed_customers")
def _(d):
    """Customers by the number of their orders: names one digit off and three times as often mentioned take them over; held against the list one by one in tests/test_variants.py."""
    n = d.raw("orders").groupBy(F.col("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias("mention_count"))
    name = F.concat(F.lit("customer "), "k")
    parties = n.select(F.concat(F.lit("C"), "k").alias("party_key"), name.alias("canonical_name"), name.alias("normalized_name"), "mention_count", F.array(name).alias("name_variants"))
    return variants.absorb_variants(parties, 3)[1]


# ---- consensus: edges by hand, and what is done with it -------------------------------


_H = """k AS (SELECT *, coalesce(CAST(TRY_CAST(value AS DECIMAL(38,4)) AS VARCHAR), lower(trim(value))) AS k FROM readings), c AS (SELECT document_id, row_index, field, k, count(*) AS n, bool_or(handwritten) AS hw FROM k GROUP BY ALL),
f AS (SELECT document_id, row_index, field, CAST(sum(n) AS BIGINT) AS readers, max(n) AS agree, count(*) FILTER (n = 1) AS singles, count(*) AS sets, bool_or(hw) AS hw FROM c GROUP BY ALL),
g AS (SELECT *, CASE WHEN hw AND field = 'extended_amount' THEN 3 WHEN hw THEN greatest(2, readers // 2 + 1) WHEN readers >= 2 THEN 2 ELSE 1 END AS needed, agree * 2 > readers AS majority FROM f),
h AS (SELECT *, readers > 1 AND majority AND agree >= needed AS accepted, readers > 1 AND NOT majority AS hard FROM g)"""


@register("merged_documents", twin(f"""WITH {_H}, e AS (SELECT document_id, count(DISTINCT vendor) AS engines FROM readings GROUP BY 1),
q AS (SELECT h.*, NOT accepted OR agree < readers OR (NOT hard AND readers < engines) AS queued, engines FROM h JOIN e USING (document_id))
SELECT document_id, max(engines) AS engines, count(*) AS field_count, CAST(count(*) FILTER (accepted) AS BIGINT) AS accepted_field_count, CAST(count(*) FILTER (queued) AS BIGINT) AS exception_count,
 CASE WHEN bool_or(hard) THEN 'open_exception' WHEN bool_or(queued) THEN 'review_queued' ELSE 'auto_accepted' END AS review_status FROM q GROUP BY 1""", "readings"))
def _(d):
    r = d.readings()
    docs, _ = consensus.merge_documents(consensus.field_consensus(r), r.select("document_id", "vendor").distinct())
    return docs.select("document_id", F.size("engines").cast("long").alias("engines"), "field_count", "accepted_field_count", "exception_count", "review_status")


@register("merge_exceptions", twin(f"""WITH {_H}, e AS (SELECT document_id, count(DISTINCT vendor) AS engines FROM readings GROUP BY 1),
q AS (SELECT h.*, engines FROM h JOIN e USING (document_id) WHERE NOT accepted OR agree < readers OR (NOT hard AND readers < engines))
SELECT field, CASE WHEN hard THEN 'no_majority' ELSE 'partial_disagreement' END AS cause, accepted, CAST(engines - readers AS INTEGER) AS missing, count(*) AS cells FROM q GROUP BY ALL""", "readings"))
def _(d):
    r = d.readings()
    _, exceptions = consensus.merge_documents(consensus.field_consensus(r), r.select("document_id", "vendor").distinct())
    return exceptions.groupBy("field", "cause", "accepted", F.size("missing").alias("missing")).agg(F.count(F.lit(1)).alias("cells"))


@register("resolutions_applied", twin(f"""WITH {_H}, l AS (SELECT document_id, row_index, field, count(*) FILTER (n = best) AS leaders, max(best) AS best FROM (SELECT *, max(n) OVER (PARTITION BY document_id, row_index, field) AS best FROM c) GROUP BY ALL)
SELECT field, accepted AS before, accepted OR (leaders = 1 AND best >= 2) AS after, count(*) AS cells FROM h JOIN l USING (document_id, row_index, field) GROUP BY ALL""", "readings"))
def _(d):
    # the votes come from the cells and go back to them, so the cells are made once
    cells = Scratch(d.spark, "cells").table(consensus.field_consensus(d.readings()).select(*consensus.CELL, "value", "consensus_flag", "accepted", "clusters"))
    done = consensus.apply_resolutions(cells.withColumn("before", F.col("accepted")), consensus.vendor_vote(cells))
    return done.groupBy("field", "before", F.col("accepted").alias("after")).agg(F.count(F.lit(1)).alias("cells"))


@register("corroboration_applied", twin(f"WITH {_H} SELECT field, accepted OR row_index % 2 = 0 AS accepted, NOT accepted AND row_index % 2 = 0 AS superseded, count(*) AS cells FROM h GROUP BY ALL", "readings"))
def _(d):
    cells = consensus.field_consensus(d.readings())
    even = cells.filter("row_index % 2 = 0").select(*consensus.CELL, F.lit("seen").alias("value"), F.lit(1).alias("occurrences"))
    done = consensus.apply_corroboration(cells, even, "approval-1", unique_only=True)
    return done.groupBy("field", "accepted", F.col("superseded_flag").isNotNull().alias("superseded")).agg(F.count(F.lit(1)).alias("cells"))


@register("derived_ordinals", "SELECT 'D' || l_orderkey AS document_id, l_linenumber AS row_index, CAST(l_linenumber AS VARCHAR) AS value, 2 AS engine_count FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)")
def _(d):
    x = d.raw("lineitem").select(F.concat(F.lit("D"), "l_orderkey").alias("document_id"), F.col("l_linenumber").alias("row_index"), "l_orderkey").distinct()
    read = x.select("document_id", "row_index", F.lit("line_number").alias("field"), F.explode(F.array(F.struct(F.lit("a").alias("vendor"), F.col("row_index").cast("string").alias("value")), F.struct(F.lit("b").alias("vendor"), F.col("l_orderkey").cast("string").alias("value")))).alias("r"), F.lit(False).alias("handwritten"))
    _, ordinals = consensus.derive_ordinals(read.select("document_id", "row_index", "field", "r.*", "handwritten"))
    return ordinals.select("document_id", "row_index", "value", "engine_count")


@register("independent_readers", twin("SELECT field, CASE WHEN vendor IN ('a', 'b') THEN 'x' ELSE vendor END AS vendor, count(DISTINCT document_id || '/' || row_index) AS cells FROM readings GROUP BY 1, 2", "readings"))
def _(d):
    one = consensus.independent_readers(d.readings(), {"a": "x", "b": "x"})
    return one.groupBy("field", "vendor").agg(F.count(F.lit(1)).alias("cells"))


# ---- proof ----------------------------------------------------------------------------

_HEADER = """l AS (SELECT document_id, CAST(substr(document_id, 2) AS BIGINT) AS k, CAST(line_number AS INTEGER) AS line, quantity AS q, unit_price AS u, extended_amount AS e FROM invoice_line),
s AS (SELECT document_id, k, sum(e) AS s, count(*) AS n, count(*) FILTER (q IS NULL OR u IS NULL) AS missing, count(*) FILTER (q IS NOT NULL AND u IS NOT NULL) AS run, count(*) FILTER (abs(round(CAST(e - q * u AS DECIMAL(38,8)), 4)) > 0.01) AS bad, max(CASE WHEN abs(round(CAST(e - q * u AS DECIMAL(38,8)), 4)) > 0.01 THEN abs(round(CAST(e - q * u AS DECIMAL(38,8)), 4)) END) AS worst FROM l GROUP BY 1, 2),
h AS (SELECT *, CASE WHEN k % 17 <> 0 AND k % 29 <> 0 THEN s + CASE WHEN k % 13 = 0 THEN 5 ELSE 0 END END AS subtotal, k % 3 AS tax, k % 2 AS freight, CASE WHEN k % 5 = 0 THEN 3 ELSE 0 END AS access, CASE WHEN k % 4 = 0 THEN 1 ELSE 0 END AS disc, CASE WHEN k % 7 = 0 THEN 2 ELSE 0 END AS cred FROM s),
t AS (SELECT *, CASE WHEN k % 19 <> 0 AND k % 29 <> 0 THEN s + tax + freight + access - disc + CASE WHEN k % 11 = 0 THEN 1 ELSE 0 END END AS total FROM h),
c AS (SELECT *, list_filter([CASE WHEN subtotal IS NOT NULL THEN {'d': abs(subtotal - s), 't': 0.01 + 0.01 * (n - 1)} END, CASE WHEN subtotal IS NOT NULL AND total IS NOT NULL THEN {'d': abs(total - (subtotal + tax + freight + access - disc)), 't': 0.01} END,
 CASE WHEN total IS NOT NULL THEN {'d': CASE WHEN k % 23 = 0 THEN 1 ELSE 0 END, 't': 0.01} END, CASE WHEN k % 5 = 0 THEN {'d': CASE WHEN k % 25 = 0 THEN 1 ELSE 0 END, 't': 0.02} END], lambda x: x IS NOT NULL) AS checks FROM t)"""


def _proof_tables(d: Driver) -> tuple[DataFrame, DataFrame, DataFrame]:
    lines = d.invoice_line().select("document_id", F.col("line_number").alias("line"), "quantity", "unit_price", "extended_amount", F.lit(None).cast("double").alias("discount"), F.lit(False).alias("handwritten"))
    k = F.substring("document_id", 2, 20).cast("long")
    wide = lambda c: c.cast("decimal(18,2)")
    s = lines.groupBy("document_id").agg(F.sum("extended_amount").cast("decimal(18,2)").alias("s")).withColumn("k", k)
    kk = F.col("k")
    some = kk % 29 != 0
    h = s.withColumns({"subtotal": F.when((kk % 17 != 0) & some, wide(F.col("s") + F.when(kk % 13 == 0, 5).otherwise(0))), "tax": wide(kk % 3), "freight": wide(kk % 2), "accessorial": wide(F.when(kk % 5 == 0, 3).otherwise(0)), "discount": F.when(kk % 4 == 0, wide(F.lit(1))), "credits": F.when(kk % 7 == 0, wide(F.lit(2)))})
    total = F.col("s") + F.col("tax") + F.col("freight") + F.col("accessorial") - F.coalesce("discount", F.lit(0)) + F.when(kk % 11 == 0, 1).otherwise(0)
    h = h.withColumn("total", F.when((kk % 19 != 0) & some, wide(total)))
    h = h.withColumn("due", wide(F.col("total") - F.coalesce("credits", F.lit(0)) + F.when(kk % 23 == 0, 1).otherwise(0)))
    acc = s.filter(kk % 5 == 0).select("document_id", F.explode(F.array(F.lit(1), F.when(kk % 25 == 0, 1).otherwise(2))).alias("charge"))
    return h, lines, acc


@register("document_proof_chain", twin(f"""WITH {_HEADER}, r AS (SELECT *, run + len(checks) AS checks_run, bad + len(list_filter(checks, lambda x: x.d > x.t)) AS checks_failed, greatest(coalesce(worst, 0), coalesce(list_max(list_transform(list_filter(checks, lambda x: x.d > x.t), lambda x: x.d)), 0)) AS w FROM c)
SELECT document_id, CASE WHEN checks_run = 0 THEN 'not_provable' WHEN checks_failed > 0 THEN 'failed' WHEN missing > 0 THEN 'proved_with_unproved_lines' ELSE 'proved' END AS arithmetic_status, CAST(checks_run AS BIGINT) AS checks_run, CAST(checks_failed AS BIGINT) AS checks_failed, CAST(round(CAST(w AS DECIMAL(38,6)), 2) AS DOUBLE) AS largest_discrepancy, CAST(missing AS BIGINT) AS lines_missing_fields FROM r""", "invoice_line"))
def _(d):
    h, lines, acc = _proof_tables(d)
    return proof.document_proof(h, lines, acc).select("document_id", "arithmetic_status", "checks_run", "checks_failed", "largest_discrepancy", "lines_missing_fields")


@register("commission_proof", """WITH l AS (SELECT l_orderkey AS k, CAST(CAST(l_extendedprice AS DECIMAL(16,2)) AS DOUBLE) AS b, CASE WHEN l_orderkey % 10 = 0 THEN NULL ELSE CAST(1 + l_linenumber AS DOUBLE) END AS r, CASE WHEN l_orderkey % 3 = 0 OR (l_orderkey % 7 = 0 AND l_linenumber = 1) THEN 1 ELSE 100 END AS div, CASE WHEN l_partkey % 31 = 0 THEN 3 ELSE 0 END AS off FROM lineitem),
c AS (SELECT k, b, r, round(b * r / div + off, 2) AS c FROM l), x AS (SELECT *, b IS NOT NULL AND r IS NOT NULL AND c IS NOT NULL AS whole, abs(c - b * r / 100) <= 0.01 AS p, abs(c - b * r) <= 0.01 AS f FROM c),
u AS (SELECT k, CASE WHEN bool_or(p AND NOT f) AND bool_or(f AND NOT p) THEN 'mixed' WHEN bool_or(p AND NOT f) THEN 'percent' WHEN bool_or(f AND NOT p) THEN 'fraction' END AS unit, count(*) FILTER (whole) AS n, count(*) FILTER (whole AND NOT p) AS fp, count(*) FILTER (whole AND NOT f) AS ff FROM x GROUP BY 1)
SELECT unit AS rate_unit, CASE WHEN unit IS NULL OR unit = 'mixed' THEN 'not_provable' WHEN CASE unit WHEN 'percent' THEN fp ELSE ff END > 0 THEN 'failed' ELSE 'proved' END AS arithmetic_status, count(*) AS documents FROM u GROUP BY 1, 2""")
def _(d):
    k, b = F.col("l_orderkey"), F.col("l_extendedprice").cast("decimal(16,2)").cast("double")
    r = F.when(k % 10 != 0, (F.col("l_linenumber") + 1).cast("double"))
    div = F.when((k % 3 == 0) | ((k % 7 == 0) & (F.col("l_linenumber") == 1)), 1).otherwise(100)
    lines = d.raw("lineitem").select(k.alias("document_id"), b.alias("base"), r.alias("rate"), F.round(b * r / div + F.when(F.col("l_partkey") % 31 == 0, 3).otherwise(0), 2).alias("commission"))
    return proof.commission_proof(lines).groupBy("rate_unit", "arithmetic_status").agg(F.count(F.lit(1)).alias("documents"))


# ---- attribution ----------------------------------------------------------------------

_PAIRS = "SELECT d.o_orderkey AS document_id, count(*) AS candidates, list_slice(list_sort(list(DISTINCT 'J' || m.o_orderkey)), 1, 10) AS jobs FROM orders d JOIN orders m ON d.o_custkey = m.o_custkey AND m.o_orderkey % 4 <> 0 AND abs(date_diff('day', CAST(d.o_orderdate AS DATE), CAST(m.o_orderdate AS DATE))) <= 400 AND abs(m.o_totalprice - d.o_totalprice) <= m.o_totalprice * 0.3 GROUP BY 1"


@register("attribution_ambiguous", f"SELECT document_id, candidates, array_to_string(jobs, ',') AS jobs FROM ({_PAIRS}) WHERE candidates > 1")
def _(d):
    o = d.raw("orders").select("o_orderkey", F.col("o_custkey").alias("customer"), F.to_date("o_orderdate").alias("day"), F.col("o_totalprice").alias("amount"))
    master = o.filter("o_orderkey % 4 <> 0").withColumn("job", F.concat(F.lit("J"), "o_orderkey"))
    return attribution.fuzzy_ambiguous(o.withColumnRenamed("o_orderkey", "document_id"), master, 400, 0.3).withColumn("jobs", F.array_join("jobs", ","))


def _lines(d: Driver) -> DataFrame:
    p = F.col("l_partkey")
    x = d.raw("lineitem").select(F.col("l_orderkey").alias("document_id"), F.col("l_linenumber").alias("line"), F.when(p % 9 != 0, F.concat(F.lit("A"), p % 50)).alias("ack"), F.when(p % 18 == 0, "bad key").when(p % 9 == 0, "J7").alias("job_key"), F.when(p % 4 != 0, F.col("l_extendedprice")).alias("amount_a"), F.when(p % 8 != 0, F.lit(1.5)).alias("amount_b"))
    return x


_CREDITS = """x AS (SELECT l_orderkey AS document_id, l_linenumber AS line, CASE WHEN l_partkey % 9 <> 0 THEN 'A' || (l_partkey % 50) WHEN l_partkey % 18 = 0 THEN 'bad key' ELSE 'J7' END AS key, CASE WHEN l_partkey % 9 <> 0 THEN 'ack' ELSE 'job_key' END AS key_field,
 CASE WHEN l_partkey % 4 <> 0 THEN l_extendedprice WHEN l_partkey % 8 <> 0 THEN 1.5 END AS amount FROM lineitem), m AS (SELECT * FROM x WHERE amount <> 0), g AS (SELECT document_id FROM m GROUP BY 1 HAVING bool_and(regexp_matches(key, '^[AJ][0-9]+$')))"""


@register("credits_by_line", f"WITH {_CREDITS} SELECT document_id, line, key_field, key, round(amount, 2) AS amount FROM m SEMI JOIN g USING (document_id)")
def _(d):
    return attribution.credit_by_line(_lines(d), ["ack", "job_key"], "^[AJ][0-9]+$", ["amount_a", "amount_b"])


def _attributed(d: Driver) -> tuple[DataFrame, DataFrame]:
    k = F.col("o_orderkey")
    docs = d.raw("orders").select(k.alias("document_id"), F.col("o_totalprice").cast("decimal(16,2)").alias("amount"), F.when(k % 3 == 0, F.concat(F.lit("J"), k)).alias("job"))
    return docs, docs.filter("document_id % 5 = 0").select("document_id", F.when(F.col("document_id") % 2 == 0, "rebate").otherwise("not_a_code").alias("reason_code"))


_REGISTER = f"""{_CREDITS}, r AS (SELECT o_orderkey AS document_id, CAST(o_totalprice AS DECIMAL(16,2)) AS amount, CASE WHEN o_orderkey % 5 = 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'rebate' ELSE 'not_a_code' END WHEN o_orderkey IN (SELECT document_id FROM g) THEN 'credited_by_line' ELSE 'unresolved' END AS reason_code FROM orders WHERE o_orderkey % 3 <> 0)"""


@register("attribution_register", f"WITH {_REGISTER} SELECT document_id, CAST(amount AS DOUBLE) AS amount, reason_code, reason_code NOT IN ('rebate', 'credited_by_line') AS is_failure FROM r")
def _(d):
    docs, given = _attributed(d)
    return attribution.register(docs, given, attribution.credit_by_line(_lines(d), ["ack", "job_key"], "^[AJ][0-9]+$", ["amount_a", "amount_b"]))


@register("attribution_gate", f"""WITH {_REGISTER}, f AS (SELECT *, reason_code NOT IN ('rebate', 'credited_by_line') AS bad FROM r)
SELECT (SELECT count(*) FROM orders) AS documents, CAST((SELECT sum(CAST(o_totalprice AS DECIMAL(16,2))) FROM orders) AS DOUBLE) AS total_value, (SELECT count(*) FROM orders WHERE o_orderkey % 3 = 0) AS attributed, CAST((SELECT sum(CAST(o_totalprice AS DECIMAL(16,2))) FROM orders WHERE o_orderkey % 3 = 0) AS DOUBLE) AS attributed_value,
 count(*) FILTER (bad) AS failures, CAST(coalesce(sum(amount) FILTER (bad), 0) AS DOUBLE) AS failure_value, CAST(coalesce(sum(amount) FILTER (NOT bad), 0) AS DOUBLE) AS disposed_value, CASE WHEN count(*) FILTER (bad) > 0 THEN 'closed' ELSE 'open' END AS gate FROM f""")
def _(d):
    docs, given = _attributed(d)
    credits = attribution.credit_by_line(_lines(d), ["ack", "job_key"], "^[AJ][0-9]+$", ["amount_a", "amount_b"])
    return attribution.gate(docs, attribution.register(docs, given, credits))


# ---- chunks ---------------------------------------------------------------------------


def _chunks(d: Driver) -> DataFrame:
    i = d.invoice_header()
    docs = i.select(F.col("source_document_id").alias("document_id"), F.concat("invoice_number", F.lit(".pdf")).alias("source_file"), F.lit("1").alias("source_page_range"), F.sha2("invoice_number", 256).alias("source_sha256"), "review_status")
    return chunks.document_chunks(docs, i, d.invoice_line(), d.party(), d.attribution())


@register("document_chunks", twin("""SELECT h.source_document_id AS document_id, 1 AS n_invoices, CAST(coalesce(n, 0) AS BIGINT) AS n_lines, CASE WHEN a.target_key IS NULL THEN 0 ELSE 1 END AS n_attributions, sha256(invoice_number) AS source_sha256, true AS names_payer
FROM invoice_header h LEFT JOIN (SELECT invoice_key, count(*) AS n FROM invoice_line GROUP BY 1) l USING (invoice_key) LEFT JOIN attribution a ON a.target_key = invoice_key WHERE review_status = 'clear'""", "invoice_header", "invoice_line", "attribution"))
def _(d):
    c = _chunks(d)
    payer = d.invoice_header().join(d.party().select(F.col("party_key").alias("payer_party_key"), "canonical_name"), "payer_party_key").select(F.col("source_document_id").alias("document_id"), "canonical_name")
    return c.join(payer, "document_id").select("document_id", "n_invoices", F.col("n_lines").cast("long").alias("n_lines"), "n_attributions", "source_sha256", F.contains("content", F.concat(F.lit('"payer":"'), "canonical_name", F.lit('"'))).alias("names_payer"))


# ---- graph, review and the journal ----------------------------------------------------


@register("graph_merged_nodes", "SELECT 'P' || l_partkey AS node_id, CASE WHEN count(DISTINCT l_returnflag) > 1 THEN 'conflicting_content' END AS reason FROM lineitem GROUP BY 1")
def _(d):
    nodes = d.raw("lineitem").select(F.concat(F.lit("P"), "l_partkey").alias("node_id"), F.lit("part").alias("node_type"), F.col("l_returnflag").alias("label"))
    good, bad = graph.merge_nodes(nodes)
    return good.select("node_id", F.lit(None).cast("string").alias("reason")).unionByName(bad)


@register("graph_provenance_rank", "SELECT CAST(l_partkey AS VARCHAR) AS subject, 'flag' AS property, l_returnflag AS value, count(DISTINCT l_orderkey) AS artifacts FROM lineitem GROUP BY ALL")
def _(d):
    return graph.rank_by_provenance(d.raw("lineitem").select(F.col("l_partkey").cast("string").alias("subject"), F.lit("flag").alias("property"), F.col("l_returnflag").alias("value"), F.col("l_orderkey").alias("artifact_id")))


@register("evidence_tally", "SELECT l_returnflag AS grade, count(*) AS rows, CAST(sum(abs(CAST(l_extendedprice AS DECIMAL(16,2)))) AS DOUBLE) AS absolute FROM lineitem GROUP BY 1")
def _(d):
    rows = d.raw("lineitem").select(F.col("l_returnflag").alias("grade"), F.col("l_extendedprice").cast("decimal(16,2)").alias("amount"))
    return pages.evidence_tally(rows, "grade", "amount")


@register("decision_cover", "SELECT group_id, CASE WHEN g IS NULL THEN 'unknown_group' WHEN n IS NULL THEN 'undecided' ELSE 'decided_more_than_once' END AS problem FROM (SELECT DISTINCT p_partkey AS group_id, true AS g FROM part WHERE p_partkey % 3 <> 0) FULL JOIN (SELECT p_partkey AS group_id, CASE WHEN p_partkey % 5 = 0 THEN 2 ELSE 1 END AS n FROM part WHERE p_partkey % 4 <> 0) USING (group_id) WHERE g IS NULL OR n IS NULL OR n > 1")
def _(d):
    p = d.raw("part").select(F.col("p_partkey").alias("group_id"))
    decided = p.filter("group_id % 4 <> 0").select("group_id", F.explode(F.sequence(F.lit(1), F.when(F.col("group_id") % 5 == 0, 2).otherwise(1))))
    return review.exact_cover(p.filter("group_id % 3 <> 0"), decided)


@register("amended_classes", """SELECT o_orderkey AS document_id, o_orderstatus AS prior_type, CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 5 <> 0 AND o_orderkey % 2 = 0 THEN 'new' ELSE o_orderstatus END AS type,
 CASE WHEN o_orderkey % 3 <> 0 THEN 'unchanged' WHEN o_orderkey % 5 = 0 THEN 'conflicting' WHEN o_orderkey % 2 = 0 THEN 'amended' ELSE 'vendor_agreement_stands' END AS outcome FROM orders""")
def _(d):
    k = F.col("document_id")
    docs = d.raw("orders").select(F.col("o_orderkey").alias("document_id"), F.col("o_orderstatus").alias("type")).withColumn("vendor_agreed", k % 2 != 0)
    entries = docs.filter(k % 3 == 0).select("document_id", F.explode(F.array(F.struct(F.lit(1).alias("entry"), F.lit("old").alias("type")), F.struct(F.lit(2).alias("entry"), F.lit("new").alias("type")), F.struct(F.lit(2).alias("entry"), F.when(k % 5 == 0, "other").otherwise("new").alias("type")))).alias("e")).select("document_id", "e.*")
    return review.amend_classification(docs, entries)


def _changes(d: Driver) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(current values, previews, gated changes): each part has a proposal to raise its size, some of them stale."""
    k = F.col("p_partkey")
    now = d.raw("part").select(k.cast("string").alias("key"), F.lit("size").alias("field"), F.col("p_size").cast("string").alias("value"), k)
    prop = now.select(F.concat(F.lit("c"), "key").alias("change_id"), F.lit("o").alias("owner"), "key", "field", F.when(k % 4 == 0, "stale").otherwise(F.col("value")).alias("expected"), F.when(k % 7 == 0, F.col("value")).otherwise((F.col("value").cast("int") + 1).cast("string")).alias("proposed"))
    seen = changes.preview(prop, now.drop("p_partkey"))
    auth = now.filter(k % 3 != 0).select(F.concat(F.lit("c"), "key").alias("change_id"), F.when(k % 5 == 0, "o").otherwise("m").alias("authorised_by"), F.when(k % 11 == 0, "2020").otherwise("2025").alias("expires_at"))
    return now.drop("p_partkey"), seen, changes.authorised(seen, auth, "2024")


_STATUS = "CASE WHEN p_partkey % 4 = 0 THEN 'stale' WHEN p_partkey % 7 = 0 THEN 'no_change' ELSE 'ready' END"
_GATE = "CASE WHEN p_partkey % 3 = 0 OR p_partkey % 11 = 0 THEN 'not_authorised' WHEN p_partkey % 5 = 0 THEN 'same_person' ELSE 'open' END"


@register("change_requests", "SELECT CAST(o_orderkey AS VARCHAR) AS request_key, CASE WHEN o_orderkey % 5 = 0 THEN 'conflicting' WHEN o_orderkey % 2 <> 0 THEN 'new' WHEN o_orderkey % 3 = 0 THEN 'repeated' ELSE 'conflicting' END AS outcome FROM orders")
def _(d):
    k = F.col("o_orderkey")
    base = d.raw("orders").select(F.lit("o").alias("owner"), F.lit("edit").alias("kind"), k.cast("string").alias("request_key"), F.sha2(k.cast("string"), 256).alias("request_hash"), k)
    past = base.filter(k % 2 == 0).withColumn("request_hash", F.when(k % 3 == 0, F.col("request_hash")).otherwise("other"))
    both = base.unionByName(base.filter(k % 5 == 0).withColumn("request_hash", F.lit("second")))
    return changes.admit(past, both).select("request_key", "outcome")


@register("change_previews", f"SELECT CAST(p_partkey AS VARCHAR) AS key, {_STATUS} AS status FROM part")
def _(d):
    return _changes(d)[1].select("key", "status")


@register("change_gates", f"SELECT CAST(p_partkey AS VARCHAR) AS key, {_GATE} AS gate FROM part WHERE {_STATUS} = 'ready'")
def _(d):
    return _changes(d)[2].select("key", "gate")


@register("change_applied", f"SELECT CAST(p_partkey AS VARCHAR) AS key, CAST(p_size AS VARCHAR) AS prior_value, CAST(CASE WHEN {_STATUS} = 'ready' AND {_GATE} = 'open' THEN p_size + 1 ELSE p_size END AS VARCHAR) AS value FROM part")
def _(d):
    now, _, gated = _changes(d)
    return changes.apply_once(now, gated, literal(d, [], "change_id string"))[0].select("key", "prior_value", "value")


@register("change_not_in_effect", f"SELECT 'c' || p_partkey AS change_id FROM part WHERE {_STATUS} = 'ready' AND {_GATE} = 'open'")
def _(d):
    now, _, gated = _changes(d)
    return changes.reconcile(gated.filter("gate = 'open'").select("change_id", "key", "field", "proposed"), now).select("change_id")


# ---- what goes to a loader ------------------------------------------------------------


@register("manifest_documents", """WITH p AS (SELECT CASE WHEN l_partkey % 6 = 0 THEN 'page-' || l_orderkey || '-' || l_linenumber ELSE 'D' || l_orderkey END AS document_id, l_linenumber AS n, 'f' || (l_orderkey % 5) AS f, CASE WHEN l_partkey % 4 <> 0 THEN CAST(l_linenumber AS VARCHAR) END AS r FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey) = 1))
SELECT document_id, arg_min(f, n) AS source_file, coalesce(string_agg(r, ',' ORDER BY n), '') AS source_page_range, count(*) AS page_count FROM p GROUP BY 1""")
def _(d):
    one = d.raw("lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("p"))
    p, n = F.col("p"), F.col("l_linenumber")
    pages_ = one.select(F.when(p % 6 != 0, F.concat(F.lit("D"), "l_orderkey")).otherwise(" ").alias("document_id"), F.concat_ws("-", F.lit("page"), "l_orderkey", n).alias("page_id"), n.alias("ordinal"), F.concat(F.lit("f"), F.col("l_orderkey") % 5).alias("source_file"), F.lit("0").alias("source_sha256"), F.when(p % 4 != 0, n.cast("string")).alias("source_page_range"))
    return loading.manifest_documents(pages_).drop("source_sha256")


@register("export_withheld", "SELECT 'D' || o_orderkey AS document_id, CASE WHEN o_orderkey % 5 = 0 THEN 'no_manifest_page' ELSE 'no_record' END AS reason FROM orders WHERE (o_orderkey % 5 = 0) <> (o_orderkey % 7 = 0)")
def _(d):
    x = d.raw("orders").select("o_orderkey", F.concat(F.lit("D"), "o_orderkey").alias("document_id"))
    return loading.export_withheld(x.filter("o_orderkey % 5 <> 0"), x.filter("o_orderkey % 7 <> 0"))


@register("load_plan", "SELECT 1 AS step, 'region' AS \"table\", (SELECT count(*) FROM region) AS records, 'r_regionkey' AS keys, CAST(NULL AS VARCHAR) AS finding UNION ALL SELECT 2, 'nation', (SELECT count(*) FROM nation), 'n_nationkey', NULL UNION ALL SELECT 4, 'supplier', (SELECT count(*) FROM supplier), 's_suppkey,s_nationkey', NULL")
def _(d):
    tables = {t: d.raw(t) for t in ("supplier", "nation", "region")}
    return loading.load_plan(tables, ["region", "nation", "customer", "supplier"], {"region": ["r_regionkey"], "nation": ["n_nationkey"], "supplier": ["s_suppkey", "s_nationkey"]}).drop("checksum")


@register("untyped_columns", "SELECT 'o_orderstatus' AS \"column\", count(*) AS rows, 'status' AS kind, 'no_typed_companion' AS reason FROM orders WHERE trim(o_orderstatus) <> ''")
def _(d):
    o = d.raw("orders").select("o_orderstatus", "o_orderpriority", F.lit(1).alias("o_orderpriority__amount"), F.lit("").alias("empty"))
    return loading.untyped_columns(o, ["o_orderstatus", "o_orderpriority", "empty", "absent"], "__amount", "status")


@register("implausible_years", "SELECT o_orderkey, 'day__iso' AS \"column\", '0' || substr(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), 2) AS value, 'read ' || o_orderkey AS reading FROM orders WHERE o_orderkey % 10 = 0")
def _(d):
    iso = F.date_format("o_orderdate", "yyyy-MM-dd")
    o = d.raw("orders").select("o_orderkey", F.concat(F.lit("read "), "o_orderkey").alias("day"), F.when(F.col("o_orderkey") % 10 == 0, F.concat(F.lit("0"), F.substring(iso, 2, 9))).otherwise(iso).alias("day__iso"), F.date_format("o_orderdate", "yyyy-MM").alias("period__month"))
    return loading.year_issues(o, ["o_orderkey"])


@register("union_first", "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'first' WHEN p_partkey % 3 = 0 THEN 'second' ELSE 'third' END AS origin FROM part")
def _(d):
    p = d.raw("part").select("p_partkey")
    return loading.union_first([p.filter("p_partkey % 2 = 0").withColumn("origin", F.lit("first")), p.filter("p_partkey % 3 = 0").withColumn("origin", F.lit("second")), p.withColumn("origin", F.lit("third"))], ["p_partkey"])


@register("json_leaves", "SELECT event_id, '/' || replace(replace(CAST(key AS VARCHAR), '~', '~0'), '/', '~1') AS pointer, value ->> '$' AS value FROM (SELECT event_id, unnest(json_keys(props)) AS key, props FROM events), LATERAL (SELECT json_extract(props, '$.\"' || key || '\"') AS value)")
def _(d):
    return loading.json_leaves(d.raw("events"), "event_id", "props")


@register("account_cards", twin("""WITH t AS (SELECT DISTINCT party_key, invoice_key, currency_code, total_amount, source_document_id FROM (SELECT payer_party_key AS party_key, * FROM invoice_header UNION ALL SELECT biller_party_key, * FROM invoice_header)),
m AS (SELECT party_key, currency_code, count(*) AS n, sum(total_amount) AS v FROM t GROUP BY 1, 2), g AS (SELECT party_key, CAST(sum(n) AS BIGINT) AS invoice_count, count(*) AS currencies, max(v) AS v FROM m GROUP BY 1),
q AS (SELECT payer_party_key AS party_key, count(*) AS payment_count FROM payment GROUP BY 1), x AS (SELECT party_key, count(DISTINCT source_document_id) AS missing_documents FROM t WHERE CAST(substr(source_document_id, 2) AS BIGINT) % 9 = 0 GROUP BY 1)
SELECT party_key, role AS roles, coalesce(invoice_count, 0) AS invoice_count, coalesce(payment_count, 0) AS payment_count, coalesce(missing_documents, 0) AS missing_documents, CASE WHEN currencies = 1 THEN CAST(v AS DOUBLE) END AS invoice_value, coalesce(currencies > 1, false) AS cross_currency_totals_suppressed
FROM party LEFT JOIN g USING (party_key) LEFT JOIN q USING (party_key) LEFT JOIN x USING (party_key)""", "party", "invoice_header", "payment"))
def _(d):
    i = d.invoice_header()
    docs = i.filter("ordinal % 9 <> 0").select(F.col("source_document_id").alias("document_id"))
    cards = loading.account_cards(d.party().select("party_key"), d.party().select("party_key", "role"), i, d.payment(), docs)
    return cards.select("party_key", F.array_join("roles", ",").alias("roles"), "invoice_count", "payment_count", "missing_documents", "invoice_value", "cross_currency_totals_suppressed")


@register("chunk_search", twin("WITH t AS (SELECT h.source_document_id FROM invoice_header h WHERE review_status = 'clear' AND currency_code = 'CAD' AND payer_party_key = 'C1') SELECT count(*) AS documents FROM t", "invoice_header"))
def _(d):
    """Full text over the chunks: documents of one payer in one currency, best twenty thousand."""
    words = "c1 cad"
    found = search.search(_chunks(d), "document_id", "content", words, 20_000)
    return found.agg(F.count(F.lit(1)).alias("documents"))
