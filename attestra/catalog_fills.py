"""Registered queries of the fills: orders print their customer's purchase order, a third of them no customer."""

from __future__ import annotations

from pyspark.sql import functions as F

from .operators import fills
from .registry import register

KEYS = ("purchase_order_number", "job_number")


def _lines(d):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    known = k % 3 != 0
    party = F.when(known, F.concat(F.lit("C"), F.when(k % 97 == 0, c + 1).otherwise(c)))
    return d.raw("orders").select(
        k.alias("row_id"), k.alias("ordinal"), F.concat(F.lit("D"), k % 500).alias("document_id"), F.concat(F.lit("S"), k % 2).alias("maker"), F.concat(F.lit("PO-"), c).alias("purchase_order_number"),
        F.when(k % 5 == 0, F.concat(F.lit("JOB"), (k / 40).cast("long"))).otherwise("none").alias("job_number"), F.when(known, F.concat(F.lit("Customer "), c)).alias("text"), party.alias("party_key"), F.lit(None).cast("string").alias("party_name"), (k % 41 == 0).alias("barred"),
    )


_BASE = """x AS (SELECT o_orderkey AS k, 'S' || (o_orderkey % 2) AS maker, o_custkey AS c, 'PO-' || o_custkey AS po, CASE WHEN o_orderkey % 5 = 0 THEN 'JOB' || (o_orderkey // 40) END AS job, o_orderkey % 3 <> 0 AS known, o_orderkey % 41 = 0 AS barred,
 CASE WHEN o_orderkey % 3 <> 0 THEN 'C' || CASE WHEN o_orderkey % 97 = 0 THEN o_custkey + 1 ELSE o_custkey END END AS party FROM orders),
keyed AS (SELECT k, maker, 0 AS rank, 'purchase_order_number' AS col, po AS key, party, known, barred, c FROM x WHERE length(po) >= 4 UNION ALL SELECT k, maker, 1, 'job_number', job, party, known, barred, c FROM x WHERE length(job) >= 4),
told AS (SELECT * FROM keyed WHERE known AND NOT barred),
held AS (SELECT a.k, a.col, any_value(a.party) AS party, any_value(a.maker) AS maker, count(DISTINCT b.party) AS m, min(b.party) AS said FROM told a JOIN told b ON a.maker = b.maker AND a.col = b.col AND a.key = b.key AND a.k <> b.k GROUP BY a.k, a.col),
answer AS (SELECT k, any_value(party) AS party, any_value(maker) AS maker, min(said) AS said FROM held GROUP BY k HAVING max(m) = 1 AND count(DISTINCT said) = 1),
num AS (SELECT maker, party, count(*) AS n, min(k) AS o FROM x WHERE known AND NOT barred GROUP BY ALL),
usual AS (SELECT maker, arg_max(party, (n, -o)) AS party FROM num GROUP BY 1),
score AS (SELECT (SELECT count(*) FROM x WHERE known AND NOT barred) AS held_out, count(*) AS proposed, count(*) FILTER (WHERE said = answer.party) AS correct, count(*) FILTER (WHERE usual.party = answer.party) AS usually FROM answer JOIN usual USING (maker)),
met AS (SELECT o.k, o.rank, o.col, o.key, count(DISTINCT b.party) AS m, min(b.party) AS said, count(*) AS n, count(DISTINCT b.k % 500) AS docs, arg_min('Customer ' || b.c, b.k) AS name FROM keyed o JOIN told b ON o.maker = b.maker AND o.col = b.col AND o.key = b.key WHERE NOT o.known GROUP BY ALL),
found AS (SELECT k, max(m) = 1 AND count(DISTINCT said) = 1 AS good, min(said) AS said, arg_max(name, (n, -rank)) AS name, max(n) AS n FROM met GROUP BY k)"""


@register("fill_shared_key_scores", f"""WITH {_BASE} SELECT 'customer_name' AS field, held_out, proposed, correct, round_even(correct / proposed, 4) AS accuracy, round_even(usually / proposed, 4) AS chance_baseline,
 CASE WHEN round_even(correct / proposed, 4) >= 0.9 THEN (SELECT count(*) FROM found WHERE good) ELSE 0 END AS filled, CASE WHEN round_even(correct / proposed, 4) >= 0.9 THEN (SELECT count(*) FROM found WHERE NOT good) ELSE 0 END AS left_empty_where_keys_disagree FROM score""")
def _(d):
    return fills.shared_keys(_lines(d), "customer_name", KEYS, 0.9)[1]


@register("fill_shared_keys", f"""WITH {_BASE} SELECT k AS row_id, name AS value, said AS party_key, 'same_key_on_other_lines' AS method, n AS lines FROM found, score WHERE good AND round_even(correct / proposed, 4) >= 0.9""")
def _(d):
    out = fills.shared_keys(_lines(d), "customer_name", KEYS, 0.9)[0]
    return out.select("row_id", "value", "party_key", "method", F.regexp_extract("evidence", r"on (\d+) lines of", 1).cast("long").alias("lines"))


@register("fill_same_line", """WITH l AS (SELECT l_orderkey AS o, l_partkey AS key, CASE WHEN l_suppkey % 4 <> 0 THEN 'S' || CASE WHEN l_orderkey % 53 = 0 THEN 9 ELSE l_partkey % 5 END END AS v FROM lineitem),
g AS (SELECT key, count(DISTINCT o) AS docs, count(DISTINCT v) AS vals, min(v) AS v, count(DISTINCT o) FILTER (WHERE v IS NOT NULL) AS c FROM l GROUP BY 1)
SELECT g.v AS value, c AS statements, count(*) AS cells FROM l JOIN g USING (key) WHERE l.v IS NULL AND docs >= 3 AND vals = 1 AND c >= 2 GROUP BY ALL""")
def _(d):
    """Lines of one part are one printed line; a quarter of the suppliers leave its mark empty, some orders misprint it."""
    mark = F.concat(F.lit("S"), F.when(F.col("l_orderkey") % 53 == 0, 9).otherwise(F.col("l_partkey") % 5))
    cells = d.raw("lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber", "l_suppkey").alias("row_id"), F.col("l_orderkey").cast("string").alias("document_id"), F.col("l_partkey").cast("string").alias("key"), F.lit("mark").alias("column"), F.when(F.col("l_suppkey") % 4 != 0, mark).alias("value"))
    return fills.same_line(cells, ())[0].groupBy("value", F.regexp_extract("evidence", r"^(\d+)", 1).cast("long").alias("statements")).agg(F.count("*").alias("cells"))


@register("fill_places", """WITH n AS (SELECT c_custkey AS k, c_mktsegment AS n, CASE c_custkey % 5 WHEN 0 THEN 'Oak Desks - ' || c_mktsegment WHEN 1 THEN 'Oak Desks-FL' WHEN 2 THEN c_custkey || ' Oak Desks' WHEN 3 THEN 'Oak Desks - Tulsa, OK' ELSE c_name END AS v FROM customer)
SELECT row_part, value, count(*) AS cells FROM (SELECT 'c_name_branch' AS row_part, n AS value FROM n WHERE k % 5 = 0 AND NOT (length(n) <= 4 AND NOT contains(n, ' ')) UNION ALL SELECT 'c_name_state', 'FL' FROM n WHERE k % 5 = 1
 UNION ALL SELECT 'c_name_location_number', CAST(k AS VARCHAR) FROM n WHERE k % 5 = 2 AND k BETWEEN 10 AND 999999 UNION ALL SELECT unnest(['c_name_city', 'c_name_state']), unnest(['Tulsa', 'OK']) FROM n WHERE k % 5 = 3) q GROUP BY ALL""")
def _(d):
    k = F.col("c_custkey")
    made = F.when(k % 5 == 0, F.concat(F.lit("Oak Desks - "), "c_mktsegment")).when(k % 5 == 1, "Oak Desks-FL").when(k % 5 == 2, F.concat(k, F.lit(" Oak Desks"))).when(k % 5 == 3, "Oak Desks - Tulsa, OK").otherwise(F.col("c_name"))
    names = d.raw("customer").select(k.alias("row_id"), F.lit("c_name").alias("column"), made.alias("value"))
    return fills.places(names, ()).groupBy(F.col("column").alias("row_part"), "value").agg(F.count("*").alias("cells"))


@register("fill_phones", """SELECT c_custkey AS row_id, CASE WHEN c_custkey % 3 = 0 THEN 'phone' ELSE 'phone_direct' END AS "column", '+1310555' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS value FROM customer WHERE c_custkey % 7 <> 0
UNION ALL SELECT c_custkey, 'phone_office', '+12135550100;ext=' || c_custkey % 90 FROM customer WHERE c_custkey % 7 <> 0 AND c_custkey % 3 <> 0""")
def _(d):
    k = F.col("c_custkey")
    own = F.concat(F.lit("(310) 555-"), F.lpad((k % 10000).cast("string"), 4, "0"))
    said = F.when(k % 7 == 0, "see the card").when(k % 3 == 0, own).otherwise(F.concat(F.lit("O. 1 213-555-0100 x "), k % 90, F.lit("; D. "), own))
    return fills.phones(d.raw("customer").select(k.alias("row_id"), F.lit("phone").alias("column"), said.alias("value")))[0].select("row_id", "column", "value")


@register("fill_letterhead_brands", """SELECT l_orderkey AS document_id, 'B' || (l_orderkey % 9) AS value, count(*) AS lines FROM lineitem WHERE l_partkey % 4 = 0 AND l_orderkey % 9 > 1 GROUP BY ALL""")
def _(d):
    """Every ninth document's head is empty, another ninth names the client."""
    k = F.col("o_orderkey") % 9
    heads = d.raw("orders").select(F.col("o_orderkey").alias("document_id"), F.when(k == 0, "").when(k == 1, "Quelena Ltd").otherwise(F.concat(F.lit("B"), k)).alias("brand_name"))
    lines = d.raw("lineitem").select(F.col("l_orderkey").alias("row_id"), F.col("l_orderkey").alias("document_id"), F.when(F.col("l_partkey") % 4 != 0, "Own").alias("brand_name"))
    return fills.letterhead_brands(lines, heads, ("Quelena",)).groupBy(F.col("row_id").alias("document_id"), "value").agg(F.count("*").alias("lines"))
