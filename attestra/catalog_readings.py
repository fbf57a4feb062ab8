"""Registered queries of the scalar readings and column faults, over texts made from whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import values
from .functions.address import parse_address
from .numbering import tasks
from .operators import arithmetic, consensus, controls, entities, mentions, pages, paths, recovery, review
from .registry import register

_E = "CAST(l_extendedprice AS DECIMAL(16,2))"


@register("money_readings", f"""SELECT l_orderkey AS document_id, l_linenumber AS line, CASE k WHEN 0 THEN '$' || e WHEN 1 THEN e || ' CAD' WHEN 2 THEN '(' || e || ')' WHEN 3 THEN replace(e, '.', ',') ELSE e || ' or so' END AS reading,
 CASE WHEN k = 3 THEN 'decimal_comma' ELSE '' END AS convention, CASE k WHEN 2 THEN '-' || e WHEN 4 THEN '' ELSE e END AS loadable, CASE WHEN k = 1 THEN 'CAD' ELSE '' END AS currency,
 CASE k WHEN 0 THEN CAST(e AS DOUBLE) WHEN 2 THEN -CAST(e AS DOUBLE) END AS money
 FROM (SELECT l_orderkey, l_linenumber, l_partkey % 5 AS k, CAST({_E} AS VARCHAR) AS e FROM lineitem) q""")
def _(d):
    """Amounts with a dollar sign, a code, in parentheses, with a decimal comma where the document has that, and as an unclear text."""
    e, k = F.col("l_extendedprice").cast("decimal(16,2)").cast("string"), F.col("l_partkey") % 5
    text = F.when(k == 0, F.concat(F.lit("$"), e)).when(k == 1, F.concat(e, F.lit(" CAD"))).when(k == 2, F.concat(F.lit("("), e, F.lit(")"))).when(k == 3, F.replace(e, F.lit("."), F.lit(","))).otherwise(F.concat(e, F.lit(" or so")))
    amount, code = values.loadable_amount(F.col("reading"), F.col("convention"))
    rows = d.raw("lineitem").select(F.col("l_orderkey").alias("document_id"), F.col("l_linenumber").alias("line"), text.alias("reading"), F.when(k == 3, "decimal_comma").otherwise("").alias("convention"))
    return rows.select("document_id", "line", "reading", "convention", amount.alias("loadable"), code.alias("currency"), values.parse_money(F.col("reading")).alias("money"))


@register("date_readings", """SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 4 THEN NULL ELSE strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') END AS iso, CASE WHEN o_orderkey % 6 = 4 THEN strftime(CAST(o_orderdate AS DATE), '%Y-%m') ELSE '' END AS month FROM orders""")
def _(d):
    """Order days as ISO text, month first, day first, by name, by name with a time, and as a month alone."""
    k, day = F.col("o_orderkey") % 6, F.col("o_orderdate")
    forms = {0: "yyyy-MM-dd", 1: "MM/dd/yyyy", 2: "dd/MM/yyyy", 3: "MMM d, yyyy", 4: "MMMM yyyy", 5: "MMMM d, yyyy"}
    text = F.coalesce(*(F.when(k == i, F.date_format(day, f)) for i, f in forms.items()))
    text = F.when(k == 5, F.concat(text, F.lit(", 9:26 AM"))).otherwise(text)
    order = F.when(k == 1, "month_first").when(k == 2, "day_first")
    rows = d.raw("orders").select("o_orderkey", text.alias("cell"), order.alias("date_order"))
    return rows.select("o_orderkey", values.loadable_date(F.col("cell"), F.col("date_order")).cast("string").alias("iso"), values.loadable_month(F.col("cell")).alias("month"))


@register("count_readings", "SELECT l_partkey % 3 AS kind, CASE WHEN l_partkey % 3 = 2 THEN '' ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || CASE WHEN l_partkey % 3 = 1 THEN '000' ELSE '' END END AS loadable, count(*) AS cells FROM lineitem GROUP BY ALL")
def _(d):
    """Quantities plain, in thousands with a comma, and with a unit, which is no count."""
    q, k = F.col("l_quantity").cast("long").cast("string"), F.col("l_partkey") % 3
    text = F.when(k == 0, q).when(k == 1, F.concat(q, F.lit(",000"))).otherwise(F.concat(q, F.lit(" EA")))
    return d.raw("lineitem").select(k.alias("kind"), values.loadable_count(text).alias("loadable")).groupBy("kind", "loadable").agg(F.count("*").alias("cells"))


@register("percent_readings", "SELECT l_partkey % 3 AS kind, CASE WHEN l_partkey % 3 = 1 THEN '' ELSE CAST(CAST(l_discount * 100 AS DECIMAL(5,2)) AS VARCHAR) END AS loadable, count(*) AS cells FROM lineitem GROUP BY ALL")
def _(d):
    """Discounts with a sign, without one, and without one where the document proves its unit."""
    p, k = (F.col("l_discount") * 100).cast("decimal(5,2)").cast("string"), F.col("l_partkey") % 3
    text = F.when(k == 0, F.concat(p, F.lit("%"))).otherwise(p)
    rows = d.raw("lineitem").select(k.alias("kind"), text.alias("cell"), (k == 2).alias("proven"))
    return rows.select("kind", values.loadable_percent(F.col("cell"), F.col("proven")).alias("loadable")).groupBy("kind", "loadable").agg(F.count("*").alias("cells"))


@register("scalar_readings", """SELECT c_custkey AS k, '+1416555' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS phone, lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS postal, regexp_replace(c_name, '[0-9]', '#', 'g') AS shape FROM customer""")
def _(d):
    k = F.col("c_custkey")
    phone = F.concat(F.lit("1 (416) 555-"), F.lpad((k % 10000).cast("string"), 4, "0"), F.when(k % 2 == 0, " ext 3").otherwise(""))
    place = F.concat(F.lit("Oakton, IL "), F.lpad((k % 100000).cast("string"), 5, "0"), F.when(k % 3 == 0, "-1234").otherwise(""))
    return d.raw("customer").select(k.alias("k"), values.phone_e164(phone).alias("phone"), values.postal_key(place).alias("postal"), values.key_shape(F.col("c_name")).alias("shape"))


@register("address_parse", """SELECT c_custkey AS k, c_custkey || ' Mill St, Oakton, IL ' || lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS raw, c_custkey || ' Mill St' AS line1, CAST(NULL AS VARCHAR) AS line2, CAST(NULL AS VARCHAR) AS reason, 'Oakton' AS city, 'IL' AS region, lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS postal, 'US' AS country FROM customer""")
def _(d):
    k = F.col("c_custkey")
    raw = F.concat(k, F.lit(" Mill St, Oakton, IL "), F.lpad((k % 100000).cast("string"), 5, "0"))
    return d.raw("customer").select(k.alias("k"), raw.alias("raw"), parse_address(raw).alias("a")).select("k", "raw", "a.*")


@register("name_edges", """SELECT p_partkey AS k, trim(regexp_replace(regexp_replace(lower(p_name), '[^a-z0-9 ]', ' ', 'g'), ' +', ' ', 'g')) || CASE WHEN p_partkey % 3 = 0 THEN ' manufacturing' ELSE '' END AS norm, p_partkey % 3 = 2 AS truncated FROM part""")
def _(d):
    """Part names as firms': with an abbreviation and a suffix, as they are, and cut off."""
    k = F.col("p_partkey") % 3
    raw = F.when(k == 0, F.concat(F.lit("The "), F.upper("p_name"), F.lit(" Mfg. Co., Inc."))).when(k == 1, F.col("p_name")).otherwise(F.concat("p_name", F.lit("…")))
    return d.raw("part").select(F.col("p_partkey").alias("k"), entities.normalise_name(raw).alias("norm"), entities.is_truncated(raw).alias("truncated"))


@register("values_agree_pairs", """SELECT l_partkey % 4 AS kind, l_partkey % 4 <> 3 AS agree, count(*) AS cells FROM lineitem GROUP BY ALL""")
def _(d):
    """Amounts against themselves with a sign and commas, within the tolerance, and a cent too far off."""
    e, k = F.col("l_extendedprice").cast("decimal(16,2)"), F.col("l_partkey") % 4
    other = F.when(k == 0, F.concat(F.lit("$"), F.format_number(e, 2))).when(k == 1, F.concat(F.lit(" "), e)).when(k == 2, (e.cast("decimal(18,3)") + F.lit(0.004).cast("decimal(4,3)")).cast("string")).otherwise((e.cast("decimal(18,3)") + F.lit(0.02).cast("decimal(4,3)")).cast("string"))
    rows = d.raw("lineitem").select(k.alias("kind"), F.lit("total_amount").alias("f"), e.cast("string").alias("a"), other.alias("b"))
    return rows.select("kind", consensus.values_agree(F.col("f"), F.col("a"), F.col("b")).alias("agree")).groupBy("kind", "agree").agg(F.count("*").alias("cells"))


@register("review_protection", """SELECT p_partkey AS k, 'formatting_review' AS reason, CASE p_partkey % 3 WHEN 0 THEN 'notes' WHEN 1 THEN 'tax_note' ELSE 'total_paid' END AS about, CASE p_partkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'field_token:tax' ELSE 'field_token:total' END AS causes FROM part""")
def _(d):
    k = F.col("p_partkey") % 3
    rows = d.raw("part").select(F.col("p_partkey").alias("k"), F.lit("formatting_review").alias("reason"), F.when(k == 0, "notes").when(k == 1, "tax_note").otherwise("total_paid").alias("about"))
    return rows.select("k", "reason", "about", F.array_join(review.protection(F.col("reason"), F.col("about")), ",").alias("causes"))


@register("document_events", """SELECT 'D' || o_orderkey AS document_id, CASE WHEN o_orderkey % 3 = 0 THEN 'UNKNOWN' ELSE 'S' || o_custkey % 9 END AS vendor, CASE WHEN o_orderkey % 2 = 0 THEN 'INV-' || o_orderkey ELSE 'P-' || o_orderkey END AS invoice_number,
 strftime(CAST(o_orderdate AS DATE), '%Y-%m') AS month, CASE WHEN o_orderkey % 7 = 0 THEN CAST(CAST(o_totalprice AS DECIMAL(16,2)) AS DOUBLE) ELSE 0.0 END AS credits, lower(o_orderstatus) AS explicit_status FROM orders""")
def _(d):
    k = F.col("o_orderkey")
    heads = d.raw("orders").select(
        F.concat(F.lit("D"), k).alias("document_id"), F.when(k % 3 == 1, F.concat(F.lit(" S"), F.col("o_custkey") % 9)).otherwise("").alias("seller_name"), F.when(k % 3 == 2, F.concat(F.lit("S"), F.col("o_custkey") % 9)).alias("brand_name"),
        F.when(k % 2 == 0, F.concat(F.lit("INV-"), k)).alias("invoice_number"), F.concat(F.lit("P-"), k).alias("pro_number"), F.when(k % 5 == 0, F.date_format("o_orderdate", "MMM-yyyy")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("statement_date"),
        F.when(k % 7 == 0, F.concat(F.lit("("), F.col("o_totalprice").cast("decimal(16,2)"), F.lit(")"))).alias("credit_amount"), F.concat("o_orderstatus", F.lit(" ")).alias("payment_status"),
    )
    return controls.document_events(heads).drop("date")


@register("rate_holds_amount", """WITH l AS (SELECT l_orderkey AS k, l_extendedprice AS e, l_partkey AS p FROM lineitem) SELECT p % 8 = 0 AS holds, count(*) AS lines FROM l GROUP BY 1""")
def _(d):
    """Every order states 5 percent on a line of its own that reconciles; an eighth of its lines has its commission in the rate's column."""
    l = d.raw("lineitem")
    e, p = F.col("l_extendedprice").cast("double"), F.col("l_partkey")
    rows = l.select(F.col("l_orderkey").alias("document_id"), F.lit(2).alias("line"), F.lit(10000.0).alias("base"), F.when(p % 8 == 0, 500.0).otherwise(5.0).alias("rate"), F.when(p % 8 == 0, F.lit(None).cast("double")).otherwise(500.0).alias("amount"), F.when(p % 8 == 0, "").otherwise("reconciles").alias("label"))
    proof = l.select("l_orderkey").distinct().select(F.col("l_orderkey").alias("document_id"), F.lit(1).alias("line"), F.lit(10000.0).alias("base"), F.lit(5.0).alias("rate"), F.lit(500.0).alias("amount"), F.lit("reconciles").alias("label"))
    out = arithmetic.rate_holds_amount(rows.unionByName(proof), "document_id", "amount", "base", "rate", "label").filter("line = 2")
    return out.groupBy(F.col("rate_holds_amount").alias("holds")).agg(F.count("*").alias("lines"))


@register("refiled_columns", """WITH o AS (SELECT 'f' || o_orderkey || '__p' || (o_custkey % 10) AS document_id, o_custkey % 10 < 3 AND o_orderkey % 4 <> 0 AS moves, o_orderkey % 4 = 0 AS has FROM orders)
SELECT document_id, 'header' AS line, CASE WHEN moves THEN 'code' ELSE 'brand' END AS field, 'X1' AS value, CASE WHEN moves THEN 'brand' END AS refiled_from FROM o UNION ALL SELECT document_id, 'header', 'code', 'X1', NULL FROM o WHERE has""")
def _(d):
    """Pages of three in ten customers print codes under the brand; a quarter of the documents has a code already, so theirs stay."""
    k = F.col("o_orderkey")
    page = F.concat(F.lit("f"), k, F.lit("__p"), F.col("o_custkey") % 10)
    o = d.raw("orders")
    cell = lambda df, f: df.select(page.alias("document_id"), F.lit("header").alias("line"), F.lit(f).alias("field"), F.lit("X1").alias("value"))
    rules = o.select(F.concat(F.lit("p"), F.col("o_custkey") % 10).alias("page"), F.lit("brand").alias("source"), F.lit("code").alias("target")).distinct().filter(F.col("page").isin("p0", "p1", "p2"))
    return pages.refile(cell(o, "brand").unionByName(cell(o.filter(k % 4 == 0), "code")), rules, "A-3")[0].drop("authorization")


@register("printed_row_codes", """SELECT 'p' || l_orderkey AS page, l_linenumber AS position, 'AB-' || l_linenumber AS code FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) q""")
def _(d):
    """Each line of an order is a printed row with its code and an amount of its own, ten points high."""
    l, n = d.raw("lineitem").select("l_orderkey", "l_linenumber").distinct(), F.col("l_linenumber")
    page, amount = F.concat(F.lit("p"), "l_orderkey"), F.concat(n, F.lit("00.00"))
    token = lambda at, text: l.select(page.alias("page"), (n * 2 + at).cast("int").alias("index"), text.alias("reading"), (n * 10.0).alias("top"), (n * 10.0 + 8).alias("bottom"))
    tokens = token(0, F.concat(F.lit("AB-"), n)).unionByName(token(1, F.concat(F.lit("$"), amount)))
    return pages.printed_row_codes(l.select(page.alias("page"), n.cast("int").alias("position"), F.array(amount).alias("amounts")), tokens, r"AB-\d+")


@register("one_person_groups", """SELECT c_custkey AS reading_id, min(c_custkey) OVER (PARTITION BY c_custkey // 3) AS person_id, '' AS reasons FROM customer""")
def _(d):
    """Customers three by three have one email."""
    k = F.col("c_custkey")
    rows = d.raw("customer").select(k.cast("long").alias("reading_id"), F.concat(F.lit("Kim "), F.translate((k / 3).cast("long").cast("string"), "0123456789", "abcdefghij")).alias("name"), F.concat(F.lit("kim"), (k / 3).cast("long"), F.lit("@quarry.example")).alias("email"))
    return recovery.one_person(rows).withColumn("reasons", F.array_join("reasons", ","))


@register("company_of_email", """WITH s AS (SELECT s_suppkey AS k, 'quarry' || translate(CAST(s_suppkey AS VARCHAR), '0123456789', 'abcdefghij') AS word FROM supplier),
e AS (SELECT k * 7 AS row_id, 'D' || k AS document_id, 'kim@' || word || '.example' AS email FROM s UNION ALL SELECT k * 7 + 1, 'D' || k, 'Jo@' || upper(word) || '-Furniture.example' FROM s UNION ALL SELECT k * 7 + 2, 'D' || k, 'lee@' || word || 'lathe.example' FROM s
 UNION ALL SELECT k * 7 + 3, 'D' || k, 'ann@gmail.example' FROM s UNION ALL SELECT k * 7 + 4, 'E' || k, 'kim@' || word || '.example' FROM s UNION ALL SELECT k * 7 + 5, 'D' || k, 'max@qua.example' FROM s UNION ALL SELECT k * 7 + 6, 'D' || k, NULL FROM s),
n AS (SELECT k, CASE WHEN word = 'quarryde' THEN 'quarry' ELSE word END AS short FROM s),
p AS (SELECT 'D' || k AS document_id, 'k' || k AS party_key, short FROM n UNION ALL SELECT 'D' || k, 'l' || k, short || 'lathe' FROM n UNION ALL SELECT 'D' || k, 's' || k, 'qua' FROM s),
h AS (SELECT row_id, min(party_key) AS party_key FROM e JOIN p USING (document_id) WHERE length(short) >= 4 AND starts_with(regexp_replace(lower(split_part(split_part(email, '@', 2), '.', 1)), '[^a-z0-9]', '', 'g'), short) GROUP BY 1 HAVING count(DISTINCT party_key) = 1)
SELECT row_id, document_id, email, party_key, 'Quarry ' || substring(word, 7) AS name FROM e JOIN s ON k = row_id // 7 LEFT JOIN h USING (row_id)""")
def _(d):
    """Every supplier has a document of two companies and a short name, and seven emails: its own domain, a longer one, one that names both companies, a free one, its own on another document, the short name's, and none.  A name's word ``de`` does not count."""
    s = d.raw("supplier").select(F.col("s_suppkey").alias("k"), F.translate(F.col("s_suppkey").cast("string"), "0123456789", "abcdefghij").alias("word"))
    k, word = F.col("k"), F.col("word")
    own, text = F.concat(F.lit("D"), k), lambda *x: F.concat(*(F.lit(v) if isinstance(v, str) else v for v in x))
    kinds = [(own, text("kim@quarry", word, ".example")), (own, text("Jo@QUARRY", F.upper(word), "-Furniture.example")), (own, text("lee@quarry", word, "lathe.example")), (own, F.lit("ann@gmail.example")), (text("E", k), text("kim@quarry", word, ".example")), (own, F.lit("max@qua.example")), (own, F.lit(None).cast("string"))]
    each = F.explode(F.array(*(F.struct((k * len(kinds) + i).alias("row_id"), doc.alias("document_id"), mail.alias("email")) for i, (doc, mail) in enumerate(kinds))))
    rows = s.select(text("Quarry ", word).alias("name"), each.alias("e")).select("e.*", "name")
    parties = F.explode(F.array(*(F.struct(key.alias("party_key"), name.alias("name")) for key, name in ((text("k", k), text("Quarry ", word)), (text("l", k), text("Quarry ", word, " Lathe Inc")), (text("s", k), F.lit("Qua"))))))
    known = s.select(own.alias("document_id"), parties.alias("p")).select("document_id", "p.*")
    out = mentions.company_of_email(rows.select("row_id", "document_id", "email"), known)
    return out.join(rows.select("row_id", "document_id", "name"), "row_id").select("row_id", "document_id", "email", "party_key", "name")


_ORDERS = """SELECT l_orderkey AS k, l_linenumber AS n, max(l_quantity) AS q, min(l_returnflag) AS f FROM lineitem GROUP BY ALL"""


@register("path_leaves", f"""WITH l AS ({_ORDERS}), r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY n) - 1 AS i FROM l)
SELECT k, 'lines[' || i || '].quantity' AS path, CAST(CAST(q AS BIGINT) AS VARCHAR) AS value FROM r UNION ALL SELECT k, 'lines[' || i || '].flag', '"' || f || '"' FROM r UNION ALL SELECT DISTINCT k, 'order', CAST(k AS VARCHAR) FROM l""")
def _(d):
    return paths.flatten(_documents(d), "k", "t")


@register("path_rebuilt", f"""WITH l AS ({_ORDERS}) SELECT k, '{{"lines":[' || string_agg('{{"flag":"' || f || '","quantity":' || CAST(q AS BIGINT) || '}}', ',' ORDER BY n) || '],"order":' || k || '}}' AS text FROM l GROUP BY k
UNION ALL SELECT -1 - event_id, json(props) FROM events""")
def _(d):
    """Orders with their lines, and the events' own properties, flattened and built again."""
    events = d.raw("events").select((-1 - F.col("event_id")).cast("long").alias("k"), F.col("props").alias("t"))
    return paths.unflatten(paths.flatten(_documents(d).unionByName(events), "k", "t"), "k")


def _documents(d):
    raw = d.raw("lineitem")
    # dealt once by order, for the lines and for their documents
    dealt = raw.select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag").repartition(tasks(d.spark, raw.count()), "l_orderkey")
    line = dealt.groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").cast("long").alias("quantity"), F.min("l_returnflag").alias("flag"))
    rows = line.groupBy(F.col("l_orderkey").cast("long").alias("k")).agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "quantity", "flag"))).alias("x"))
    lines = F.transform("x", lambda x: F.struct(x["quantity"].alias("quantity"), x["flag"].alias("flag")))
    return rows.select("k", F.to_json(F.struct(lines.alias("lines"), F.col("k").alias("order"))).alias("t"))
