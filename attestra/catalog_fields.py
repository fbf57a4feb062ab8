"""Registered queries of field validation, party readings, decisions over parties and selling locations."""

from __future__ import annotations

from pyspark.sql import functions as F

from .operators import attribution, brands, fields, mentions
from .registry import register

# ---- field validation --------------------------------------------------------------------


_PRINTED = """SELECT l_orderkey AS k, l_linenumber AS n, l_partkey AS p, l_shipdate AS s, l_extendedprice AS e FROM lineitem"""


@register("field_issues_all", f"""WITH l AS ({_PRINTED}), o AS (SELECT k, bool_or(CAST(strftime(CAST(s AS DATE), '%d') AS INTEGER) > 12) AS proved FROM l WHERE p % 4 = 0 GROUP BY k)
SELECT reason, count(*) AS issues FROM (
 SELECT 'invalid_or_ambiguous_iso_date' AS reason FROM l JOIN o USING (k) WHERE p % 4 = 0 AND NOT proved
 UNION ALL SELECT 'negative_value_requires_review' FROM l WHERE p % 10 = 0
 UNION ALL SELECT 'implausible_identifier_format' FROM l WHERE p < 100
 UNION ALL SELECT 'unsupported_currency' FROM orders WHERE o_orderkey % 3 = 2 AND o_orderkey IN (SELECT k FROM l)
 UNION ALL SELECT 'missing_field_provenance' FROM l WHERE n = 4) q GROUP BY reason""")
def _(d):
    """Ship dates, slashed month first or ISO, amounts, parts as job numbers, and each order's currency."""
    line = d.raw("lineitem")
    at = lambda name: F.concat(F.lit("lines["), F.col("l_linenumber"), F.lit(f"].{name}"))
    day, p = F.col("l_shipdate").cast("date"), F.col("l_partkey")
    cell = lambda path, value, source=F.lit("p1"): F.struct(path.alias("path"), value.cast("string").alias("value"), source.alias("source"))
    amount = F.when(p % 10 == 0, F.concat(F.lit("("), F.col("l_extendedprice").cast("decimal(16,2)"), F.lit(")"))).otherwise(F.col("l_extendedprice").cast("decimal(16,2)").cast("string"))
    cells = F.array(
        cell(at("ship_date"), F.when(p % 4 == 0, F.date_format(day, "MM/dd/yyyy")).otherwise(F.date_format(day, "yyyy-MM-dd"))),
        cell(at("extended_amount"), amount), cell(at("job_number"), p), cell(at("note"), F.lit("x"), F.when(F.col("l_linenumber") == 4, "").otherwise("p1")),
        cell(F.lit("header.currency"), F.when(F.col("l_orderkey") % 3 == 0, "USD").when(F.col("l_orderkey") % 3 == 1, "EUR").otherwise("ZZZ")),
    )
    rows = line.select(F.col("l_orderkey").alias("document_id"), F.explode(cells).alias("x")).select("document_id", "x.*")
    return fields.field_issues(rows, ("USD", "EUR")).groupBy("reason").agg(F.count("*").alias("issues"))


@register("field_validation_status", "SELECT CASE WHEN o_orderstatus = 'P' OR o_totalprice < 1000 THEN 'client_review_required' ELSE 'clear' END AS status, count(*) AS documents, CAST(sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END + CASE WHEN o_totalprice < 1000 THEN 1 ELSE 0 END) AS BIGINT) AS findings FROM orders GROUP BY 1")
def _(d):
    """Orders as documents: a status P prints an unsupported currency, a total under a thousand is printed negative."""
    orders = d.raw("orders").select(F.col("o_orderkey").alias("document_id"), "o_orderstatus", "o_totalprice")
    cell = lambda path, value: F.struct(F.lit(path).alias("path"), value.cast("string").alias("value"), F.lit("p1").alias("source"))
    total = F.when(F.col("o_totalprice") < 1000, F.lit("-1")).otherwise(F.lit("1"))
    cells = F.array(cell("header.currency", F.when(F.col("o_orderstatus") == "P", "ABC").otherwise("EUR")), cell("header.total_amount", total))
    rows = orders.select("document_id", F.explode(cells).alias("x")).select("document_id", "x.*")
    out = fields.validation_status(orders.select("document_id"), fields.field_issues(rows, ("EUR",)))
    return out.groupBy(F.col("field_validation_status").alias("status")).agg(F.count("*").alias("documents"), F.sum("findings").alias("findings"))


# ---- party readings ----------------------------------------------------------------------


@register("party_mentions_all", """SELECT role, reason, count(*) AS readings FROM (
 SELECT 'customer' AS role, CASE WHEN o_custkey % 5 = 0 THEN 'party_name_carries_no_letter' END AS reason FROM orders
 UNION ALL SELECT 'dealer', CASE WHEN o_orderstatus = 'F' THEN 'party_name_is_a_label_or_placeholder' WHEN o_orderstatus = 'P' THEN 'the_client_is_not_a_counterparty' END FROM orders) q GROUP BY ALL""")
def _(d):
    orders = d.raw("orders")
    customer = F.when(F.col("o_custkey") % 5 == 0, F.col("o_custkey").cast("string")).otherwise(F.concat(F.lit("Customer "), "o_custkey"))
    dealer = F.when(F.col("o_orderstatus") == "F", "N/A").when(F.col("o_orderstatus") == "P", "Quelena Inc").otherwise("Kestrel")
    rows = orders.select(F.concat(F.lit("D"), "o_orderkey").alias("document_id"), F.lit("header").alias("scope"), F.create_map(F.lit("customer_name"), customer, F.lit("dealer_name"), dealer).alias("values"))
    return mentions.party_mentions(rows, ("Quelena",)).groupBy("role", "reason").agg(F.count("*").alias("readings"))


@register("decided_customers", """WITH p AS (SELECT c_custkey AS k, c_custkey - c_custkey % 3 AS g FROM customer WHERE c_custkey - c_custkey % 3 IN (SELECT c_custkey FROM customer) UNION ALL SELECT c_custkey, c_custkey FROM customer WHERE c_custkey - c_custkey % 3 NOT IN (SELECT c_custkey FROM customer))
SELECT max(k) AS party_key, sum(k) AS mention_count, count(*) AS spellings FROM p GROUP BY g""")
def _(d):
    """Customers whose keys share a whole third are one party, by decisions that name the first of each three."""
    c = d.raw("customer").select(F.col("c_custkey").alias("k"))
    name = lambda k: F.concat(F.lit("Customer "), k)
    parties = c.select(F.col("k").alias("ordinal"), F.col("k").alias("party_key"), name(F.col("k")).alias("canonical_name"), F.lit(None).cast("array<string>").alias("name_variants"), F.col("k").alias("mention_count"))
    given = c.filter("k % 3 <> 0").select(F.col("k").alias("decision_id"), name(F.col("k") - F.col("k") % 3).alias("a"), name(F.col("k")).alias("b"), F.lit("same_party").alias("decision"), F.lit(None).cast("string").alias("canonical_name"))
    return mentions.decide_parties(parties, given)[0].select("party_key", "mention_count", F.size("name_variants").cast("long").alias("spellings"))


# ---- where a sale was made ---------------------------------------------------------------


@register("selling_locations", """WITH m AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 2 = 0 THEN 'Lodge ' || o_orderkey % 7 END AS place FROM orders WHERE o_orderkey % 5 <> 0)
SELECT method, selling_location, ship_from, count(*) AS documents FROM (SELECT CASE WHEN o_orderstatus = 'F' THEN 'explicit_field' WHEN o_custkey % 6 = 0 THEN 'letterhead' WHEN place IS NOT NULL THEN 'reference_table_via_ack'
 WHEN o_orderkey % 3 = 0 THEN 'ack_prefix_inferred' WHEN o_orderpriority LIKE '1%' THEN 'salesperson_needs_territory_table' ELSE 'unresolved' END AS method,
 CASE WHEN o_orderstatus = 'F' THEN 'Branch' WHEN o_custkey % 6 = 0 THEN 'Town' WHEN place IS NOT NULL THEN place WHEN o_orderkey % 3 = 0 THEN 'AB' END AS selling_location,
 CASE WHEN o_orderkey % 4 = 0 THEN 'Port' ELSE 'Quay' END AS ship_from FROM orders LEFT JOIN m ON k = o_orderkey) q GROUP BY ALL""")
def _(d):
    orders, k = d.raw("orders"), F.col("o_orderkey")
    key = F.concat(F.when(k % 3 == 0, "ab-").otherwise(""), k)
    docs = orders.select(k.alias("document_id"), key.alias("ack_number"), F.when(F.col("o_orderstatus") == "F", " Branch ").otherwise("").alias("branch"), F.when(F.col("o_custkey") % 6 == 0, "Town").alias("letterhead_city"), F.when(F.col("o_orderpriority").startswith("1"), "Mara").alias("salesperson"), F.when(k % 4 == 0, "Port").alias("origin_city"), F.lit("Quay").alias("ship_from_city"))
    master = orders.filter(k % 5 != 0).select(key.alias("ack_number"), k.alias("ordinal"), F.when(k % 2 == 0, F.concat(F.lit("Lodge "), k % 7)).alias("selling_location"))
    return attribution.selling_location(docs, master).groupBy("method", "selling_location", "ship_from").agg(F.count("*").alias("documents"))


# ---- makers of pages ---------------------------------------------------------------------


@register("letterhead_names_all", """WITH v AS (SELECT DISTINCT regexp_replace(lower(split_part(text, ' ', 1) || split_part(text, ' ', 2)), '[^a-z0-9]', '', 'g') AS key FROM documents),
h AS (SELECT doc_id, regexp_replace(lower(substring(text, 1, 600)), '[^a-z0-9]', '', 'g') AS head FROM documents)
SELECT doc_id, count(*) AS names, CAST(min(strpos(head, key)) AS BIGINT) AS first_at FROM h, v WHERE length(key) >= 5 AND strpos(head, key) > 0 GROUP BY doc_id""")
def _(d):
    """Names are the first two words of every document."""
    docs = d.raw("documents")
    words = F.split("text", " ", 3)
    known = docs.groupBy(F.concat_ws(" ", F.get(words, F.lit(0)), F.get(words, F.lit(1))).alias("name")).agg(F.count("*").alias("documents"))
    return brands.letterhead_places(docs, known, "doc_id").groupBy("doc_id").agg(F.count("*").alias("names"), F.min("at").cast("long").alias("first_at"))


@register("layout_signatures", """WITH w AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[a-z][a-z0-9]{2,}')) AS word FROM documents),
k AS (SELECT word FROM w GROUP BY word HAVING count(*) BETWEEN 5 AND 0.5 * (SELECT count(*) FROM documents)), l AS (SELECT * FROM w JOIN k USING (word)), s AS (SELECT doc_id, lang AS maker FROM documents WHERE doc_id % 2 = 0),
g AS (SELECT word, min(maker) AS maker FROM l JOIN s USING (doc_id) GROUP BY word HAVING count(DISTINCT maker) = 1 AND count(*) >= 5)
SELECT doc_id, min(maker) AS maker, count(*) AS own_words FROM l JOIN g USING (word) WHERE doc_id NOT IN (SELECT doc_id FROM s) GROUP BY doc_id HAVING count(DISTINCT maker) = 1 AND count(*) >= 3""")
def _(d):
    """Every other document is settled, by its language; the rest are signed by words of one language."""
    docs = d.raw("documents")
    settled = docs.filter("doc_id % 2 = 0").select("doc_id", F.col("lang").alias("maker"))
    return brands.signed_makers(docs, settled, "doc_id")


_FORM = """f AS (SELECT p_partkey AS page_id, p_type || (p_size % 7) AS layout, CASE WHEN p_size % 7 = 3 AND p_partkey % 2 = 0 THEN 'rival works' ELSE 'maker ' || lower(p_type) || CASE WHEN p_partkey % 5 < 2 THEN ' inc' ELSE '' END END AS maker FROM part)"""


@register("opening_makers", f"""WITH {_FORM}, c AS (SELECT layout, maker, count(*) AS n FROM f WHERE page_id % 3 <> 0 GROUP BY ALL),
o AS (SELECT layout, bool_or(maker = 'rival works') AND bool_or(maker <> 'rival works') AS mixed, max({{'n': n, 'maker': maker}}).maker AS maker, CAST(sum(n) AS BIGINT) AS alike FROM c GROUP BY 1)
SELECT page_id, o.maker, alike FROM f JOIN o USING (layout) WHERE page_id % 3 = 0 AND NOT mixed AND alike >= 2""")
def _(d):
    """Forms of parts open alike by type and size; two of three print their maker, and one layout is used by two makers."""
    k, size = F.col("p_partkey"), F.col("p_size") % 7
    maker = F.when((size == 3) & (k % 2 == 0), "rival works").otherwise(F.concat(F.lit("maker "), F.lower("p_type"), F.when(k % 5 < 2, " inc").otherwise("")))
    said = F.when(k % 3 != 0, F.concat(F.initcap(maker), F.lit(" "))).otherwise("")
    form = F.concat(said, "p_type", F.lit(" order form of "), F.element_at(F.split(F.lit("abcdefg"), ""), (size + 1).cast("int")), F.lit(" please remit payment for "), "p_name")
    pages = d.raw("part").select(k.alias("page_id"), form.alias("text"), maker.alias("maker"))
    settled = pages.filter("page_id % 3 <> 0").select("page_id", "maker")
    return brands.opening_makers(pages, settled, settled.select(F.col("maker").alias("name")).distinct())
