"""Registered queries of the page review: each order is a page, its lines are the export, the parts' keys make the faults."""

from __future__ import annotations

from pyspark.sql import functions as F

from .operators import page_review as pr
from .registry import register

M = "decimal(38,6)"


class _Pages:
    """The tables of :mod:`attestra.operators.page_review` over orders and lineitem."""

    def __init__(self, d):
        rows = d.raw("lineitem").select(F.col("l_orderkey").alias("k"), F.concat(F.lit("D"), "l_orderkey").alias("page"), F.col("l_linenumber").cast("string").alias("line"), F.col("l_partkey").alias("p"), F.col("l_extendedprice").cast("decimal(16,2)").alias("e"))
        # dealt once by page, which what is asked of a page's cells and figures needs not do again
        self.line = rows.filter("page is not null").repartition(d.line_tasks(), "page").groupBy("page", "line").agg(F.max("k").alias("k"), F.max("p").alias("p"), F.max("e").alias("e"))
        self.orders = d.raw("orders").select(F.col("o_orderkey").alias("k"), F.concat(F.lit("D"), "o_orderkey").alias("page"), F.col("o_totalprice").cast("decimal(16,2)").alias("total"), F.col("o_orderstatus").alias("status"))
        k, p, e = F.col("k"), F.col("p"), F.col("e")
        line, column, held = F.col("line"), F.lit("extended_amount"), (e + F.when(p % 6 == 0, 10).otherwise(0)).cast(M)
        is_cell, excluded = k % 19 != 0, p % 16 == 0
        seen, read, second = (k % 5 != 0) & (p % 7 != 0), p % 9 == 0, (k % 3 != 0) & (p % 11 != 0) & (p % 13 != 0)
        self.cells = self.line.filter(is_cell).select("page", "line", column.alias("column"), held.alias("amount"), excluded.alias("excluded"))
        self.second = self.line.filter(second).select("page", "line", column.alias("column"), e.cast(M).alias("amount"))
        # a line's own figure, and the one that its cell holds instead
        live, other = is_cell & ~excluded, p % 6 == 0
        self.facts = pr.facts_of(self.line, pr.fact(line, column, e, cell=live & ~other, printed=seen, reading=read, second=second), F.when(live & other, pr.fact(line, column, held, cell=live)))
        wrong = self.line.filter(other & is_cell).select("page", (line.cast("int") * 2).alias("ordinal"), "line", column.alias("column"), (e + 10).cast("string").alias("export"), F.concat(e.cast("string"), F.when(p % 4 == 0, F.lit(" (see the note)")).otherwise("")).alias("said"))
        gone = self.line.filter(p % 13 == 0).select("page", (line.cast("int") * 2 + 1).alias("ordinal"), "line", F.lit("").alias("column"), F.lit("").alias("export"), F.lit("The page never prints it").alias("said"))
        self.findings = wrong.unionByName(gone)
        self.header = self.orders.select("page", F.lit("total_amount").alias("column"), F.col("total").cast(M).alias("amount"))
        shown = self.line.filter(p % 13 != 0).groupBy("page").agg(F.sort_array(F.collect_list(F.when(p % 5 == 0, F.concat(F.lit("$"), e.cast("string"), F.lit(" USD"))).otherwise(e.cast("string")))).alias("page_money"), F.count(F.lit(1)).alias("n"))
        self.reviews = self.orders.join(shown, "page").select(
            "page", F.col("status").alias("document_kind"), F.when(k % 17 == 0, "").when(k % 29 != 0, "extended_amount").alias("money_column"), F.col("n").alias("page_rows"),
            F.col("n").alias("money_cells_checked"), (k % 2).alias("money_cells_wrong"), "page_money", F.when(k % 2 == 0, F.col("total").cast("string")).alias("page_total"),
        )
        counts = self.line.filter(seen).groupBy("page", e.cast(M).alias("amount")).agg(F.count(F.lit(1)).alias("n"))
        self.printed = counts.unionByName(self.orders.filter(k % 5 != 0).select("page", F.lit(None).cast(M).alias("amount"), F.lit(0).cast("long").alias("n")))


_BASE = """l AS (SELECT l_orderkey AS k, 'D' || l_orderkey AS page, CAST(l_linenumber AS VARCHAR) AS line, max(l_partkey) AS p, max(CAST(l_extendedprice AS DECIMAL(16,2))) AS e FROM lineitem GROUP BY ALL),
o AS (SELECT o_orderkey AS k, 'D' || o_orderkey AS page, CAST(o_totalprice AS DECIMAL(16,2)) AS total, o_orderstatus AS status FROM orders),
cells AS (SELECT k, page, line, p, e, CAST(e + CASE WHEN p % 6 = 0 THEN 10 ELSE 0 END AS DECIMAL(16,2)) AS amount, p % 16 = 0 AS excluded FROM l WHERE k % 19 <> 0),
rev AS (SELECT o.k, o.page, o.status, o.total, count(*) AS n FROM o JOIN l USING (page) WHERE p % 13 <> 0 GROUP BY ALL),
sound AS (SELECT *, CASE WHEN k % 17 <> 0 THEN 'extended_amount' ELSE '' END AS col FROM rev WHERE k % 17 = 0 OR k % 29 <> 0),
seen AS (SELECT page, e AS amount, count(*) AS n FROM l WHERE k % 5 <> 0 AND p % 7 <> 0 GROUP BY ALL)"""

_BALANCE = f"""{_BASE},
asked AS (SELECT * FROM sound WHERE col <> ''),
own AS (SELECT page, amount, excluded FROM cells SEMI JOIN asked USING (page)),
parts AS (SELECT page, e AS amount, 'printed' AS side FROM l SEMI JOIN sound USING (page) WHERE p % 13 <> 0
 UNION ALL SELECT page, amount, 'retained' FROM own
 UNION ALL SELECT page, total, 'retained' FROM asked ANTI JOIN own USING (page)
 UNION ALL SELECT page, amount, 'countable' FROM own WHERE NOT excluded
 UNION ALL SELECT page, total, 'countable' FROM asked ANTI JOIN (SELECT page FROM own WHERE NOT excluded) USING (page)
 UNION ALL SELECT page, total, 'total' FROM sound ANTI JOIN (SELECT page FROM own WHERE NOT excluded) USING (page) WHERE k % 2 = 0),
sums AS (SELECT page, amount, count(*) FILTER (WHERE side = 'printed') AS a, count(*) FILTER (WHERE side = 'retained') AS b, count(*) FILTER (WHERE side = 'countable') AS c, count(*) FILTER (WHERE side = 'total') AS t FROM parts GROUP BY ALL),
bal AS (SELECT page, 'lost' AS kind, amount, a - b AS n FROM sums WHERE a > b UNION ALL SELECT page, 'invented', amount, c - a - t FROM sums WHERE c > a + t)"""


@register("page_balance", f"WITH {_BALANCE} SELECT page, kind, CAST(amount AS DOUBLE) AS amount, n FROM bal")
def _(d):
    x = _Pages(d)
    return pr.page_balance(x.reviews, x.cells, x.header)


@register("page_review_errors", f"WITH {_BASE} SELECT page, 'money_column' AS missing FROM rev ANTI JOIN sound USING (page)")
def _(d):
    return pr.review_errors(_Pages(d).reviews).select("page", F.array_join("missing", ",").alias("missing"))


@register("page_review_summary", f"""WITH {_BALANCE}, m AS (SELECT rev.*, rev.page IN (SELECT page FROM bal) AS off, rev.page NOT IN (SELECT page FROM sound) AS bad FROM rev)
SELECT status AS document_kind, count(*) AS pages, count(*) FILTER (WHERE NOT bad AND NOT off) AS reconciling, count(*) FILTER (WHERE NOT bad AND off) AS disagreeing, count(*) FILTER (WHERE bad) AS schema_errors,
 CAST(sum(n) AS BIGINT) AS cells_checked, CAST(sum(k % 2) AS BIGINT) AS cells_wrong FROM m GROUP BY 1""")
def _(d):
    x = _Pages(d)
    return pr.review_summary(x.reviews, pr.page_balance(x.reviews, x.cells, x.header))


@register("page_lost_values", f"""WITH {_BALANCE} SELECT bal.page, CAST(bal.amount AS DOUBLE) AS amount, bal.n,
 CASE WHEN k % 5 = 0 THEN 'no_extractor_response' WHEN seen.n > 0 THEN 'extractor_saw_it' ELSE 'extractor_missed_it' END AS evidence FROM bal JOIN o USING (page) LEFT JOIN seen USING (page, amount) WHERE kind = 'lost'""")
def _(d):
    x = _Pages(d)
    return pr.lost_values(pr.page_balance(x.reviews, x.cells, x.header), x.printed)


_FIXES = f"""{_BASE},
fix AS (SELECT c.k, c.page, c.line, c.p, c.e AS page_value, c.amount AS was, CASE WHEN c.p % 9 = 0 AND seen.n > 0 THEN 'extractor_text_and_engine' WHEN seen.n > 0 THEN 'extractor_text' WHEN c.p % 9 = 0 THEN 'engine' ELSE 'reviewer_only' END AS grade,
 (SELECT coalesce(string_agg(x.line, ',' ORDER BY CAST(x.line AS INTEGER)), '') FROM cells x WHERE x.page = c.page AND NOT x.excluded AND x.amount = c.e AND x.line <> c.line) AS moves,
 (SELECT count(*) FROM cells x WHERE x.page = c.page AND NOT x.excluded AND x.amount = c.e AND x.line <> c.line) AS elsewhere
 FROM cells c SEMI JOIN sound USING (page) LEFT JOIN seen ON seen.page = c.page AND seen.amount = c.e WHERE c.p % 6 = 0),
sec AS (SELECT page, e AS amount, count(*) AS n FROM l WHERE k % 3 <> 0 AND p % 11 <> 0 AND p % 13 <> 0 GROUP BY ALL),
graded AS (SELECT fix.*, CASE WHEN grade = 'reviewer_only' AND coalesce(sec.n, 0) > elsewhere THEN 'second_vendor' ELSE grade END AS evidence FROM fix LEFT JOIN sec ON sec.page = fix.page AND sec.amount = page_value)"""


@register("page_corrections", f"WITH {_FIXES} SELECT page, line, CAST(page_value AS DOUBLE) AS page_value, CAST(was - page_value AS DOUBLE) AS difference, evidence, moves AS moves_from_lines, CASE WHEN p % 9 = 0 THEN 1 ELSE 0 END AS engines FROM graded")
def _(d):
    return _graded(_Pages(d)).select("page", "line", "page_value", "difference", "evidence", F.array_join("moves_from_lines", ",").alias("moves_from_lines"), F.size("retained_readings").alias("engines"))


def _graded(x):
    return pr.corrections(x.reviews, x.findings, x.facts, ("vendor b", "vendor a"))


@register("page_rows_not_printed", f"""WITH {_FIXES}, live AS (SELECT page, amount, count(*) AS n FROM cells WHERE NOT excluded GROUP BY ALL),
short AS (SELECT live.*, count(*) OVER (PARTITION BY page) AS figures FROM live LEFT JOIN sec USING (page, amount) WHERE coalesce(sec.n, 0) < live.n),
gone AS (SELECT c.k, c.page, c.line, c.amount AS value, live.n AS countable, CASE WHEN c.k % 5 = 0 THEN 'no_extractor_response' WHEN coalesce(seen.n, 0) < live.n THEN 'extractor_prints_it_fewer_times' ELSE 'extractor_prints_it_as_often' END AS grade
 FROM cells c JOIN live USING (page, amount) SEMI JOIN (SELECT page FROM sound WHERE col <> '') USING (page) LEFT JOIN seen ON seen.page = c.page AND seen.amount = c.amount WHERE c.p % 13 = 0 AND NOT c.excluded)
SELECT page, line, CAST(value AS DOUBLE) AS value, countable, CASE WHEN grade = 'extractor_prints_it_as_often' AND figures = 1 AND page IN (SELECT page FROM sec) THEN 'second_vendor_prints_it_fewer_times' ELSE grade END AS evidence
FROM gone LEFT JOIN short ON short.page = gone.page AND short.amount = gone.value""".replace("SELECT page, line, CAST(value", "SELECT gone.page, line, CAST(value").replace("AND page IN (SELECT page FROM sec)", "AND gone.page IN (SELECT page FROM sec)"))
def _(d):
    x = _Pages(d)
    absent = pr.rows_not_printed(x.reviews, x.findings, x.cells, x.printed)
    return pr.second_read(absent, x.cells, x.second, "vendor b", "vendor a").select("page", "line", "value", "countable", "evidence")


def _documents(d, x):
    """The documents as they are when amendments are planned: some cells have changed since the review, some pages are gone."""
    k, p = F.col("k"), F.col("p")
    now = (F.col("e") + F.when(p % 10 == 0, 77).when(p % 6 == 0, 10).otherwise(0)).cast("decimal(16,2)").cast("string")
    return x.line.filter((k % 19 != 0) & (k % 23 != 0)).select("page", "line", F.lit("extended_amount").alias("column"), now.alias("value"), F.lit("consensus").alias("accepted_by"))


_PLAN = f"""{_FIXES},
r0 AS (SELECT *, CASE WHEN evidence = 'reviewer_only' THEN 'evidence_not_selected' WHEN k % 23 = 0 THEN 'no_such_document' WHEN p % 10 = 0 THEN 'the_field_changed_since_the_review' END AS no FROM graded),
plan AS (SELECT *, coalesce(no, CASE WHEN moves <> '' AND EXISTS (SELECT 1 FROM (SELECT unnest(string_split(r0.moves, ',')) AS m) u WHERE m NOT IN (SELECT line FROM r0 y WHERE y.page = r0.page AND y.no IS NULL))
 THEN 'moves_a_figure_whose_other_half_is_not_proved' END) AS refused FROM r0)"""


@register("page_amendments_planned", f"WITH {_PLAN} SELECT page, line, evidence, coalesce(refused, 'applied') AS outcome FROM plan")
def _(d):
    x = _Pages(d)
    documents = _documents(d, x)
    return pr.apply_amendments(pr.plan_amendments(_graded(x), documents), documents, "A-1")[1].select("page", "line", "evidence", "outcome")


@register("page_amended_fields", f"""WITH {_PLAN} SELECT l.page, l.line, CAST(CASE WHEN f.page IS NULL THEN l.e + CASE WHEN l.p % 10 = 0 THEN 77 WHEN l.p % 6 = 0 THEN 10 ELSE 0 END ELSE l.e END AS DOUBLE) AS value,
 CASE WHEN f.page IS NULL THEN 'consensus' ELSE 'amended_from_page_review' END AS accepted_by, CAST(CASE WHEN f.page IS NOT NULL THEN l.e + 10 END AS DOUBLE) AS superseded
 FROM l LEFT JOIN (SELECT page, line FROM plan WHERE refused IS NULL) f USING (page, line) WHERE k % 19 <> 0 AND k % 23 <> 0""")
def _(d):
    x = _Pages(d)
    documents = _documents(d, x)
    out = pr.apply_amendments(pr.plan_amendments(_graded(x), documents), documents, "A-1")[0]
    return out.select("page", "line", F.col("value").cast("double").alias("value"), "accepted_by", F.col("superseded_value").cast("double").alias("superseded"))
