"""Registered queries of neighbourhoods, question packs, unsettled candidates and payments narrowed to one invoice."""

from __future__ import annotations

from functools import cache

from pyspark.sql import functions as F

from .catalog_review import _items
from .operators import neighbours, paths, payments, questions, surface
from .registry import register


# ---- neighbourhoods: orders share a customer's purchase order, a hot seller, and pairs of cheques ----------


def _records(d):
    k = F.col("o_orderkey")
    po = F.concat(F.lit("PO  "), "o_custkey", F.lit("-"), (k % 5).cast("string"))
    seller = F.struct(F.when(k % 3 == 0, F.concat(F.lit("Seller "), (k % 10).cast("string"))).alias("name"))
    checks = F.when(k % 7 == 0, F.array(F.struct(F.concat(F.lit("CHK "), F.floor(k / 2).cast("string")).alias("number"))))
    record = F.to_json(F.struct(po.alias("po_number"), seller.alias("vendor"), checks.alias("checks"), F.lit("kept back").alias("note")))
    return d.raw("orders").select(F.concat(F.lit("D"), k).alias("document_id"), k.alias("ordinal"), record.alias("record"))


def _near(d, resolved, size, cap=None):
    rows = _records(d)
    tokens = neighbours.identifiers(paths.flatten(rows, "document_id", "record"))
    targets = rows.filter((F.col("ordinal") % 4 == 0) == resolved).select("document_id", "ordinal")
    return rows, neighbours.neighbourhoods(tokens, targets, size, cap, verify=resolved)


_TOKENS = """tok AS (SELECT DISTINCT 'D' || o_orderkey AS document_id, unnest(list_filter(['po ' || o_custkey || '-' || (o_orderkey % 5), CASE WHEN o_orderkey % 3 = 0 THEN 'seller ' || (o_orderkey % 10) END, CASE WHEN o_orderkey % 7 = 0 THEN 'chk ' || (o_orderkey // 2) END], lambda x: x IS NOT NULL)) AS token FROM orders)"""


def _top(wanted, size):
    return f"""{_TOKENS}, pair AS (SELECT a.document_id, b.document_id AS other, count(*) AS n FROM tok a JOIN tok b ON a.token = b.token AND a.document_id <> b.document_id WHERE CAST(substr(a.document_id, 2) AS BIGINT) % 4 {wanted} 0 GROUP BY ALL),
top AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY n DESC, other) AS k FROM pair QUALIFY k < {size})"""


@register("cross_packet_neighbours", f"""WITH {_top('<>', 6)}, said AS (SELECT DISTINCT a.document_id, a.token FROM top JOIN tok a ON a.document_id = top.document_id JOIN tok b ON b.document_id = top.other AND a.token = b.token),
names AS (SELECT document_id, string_agg(token, ',' ORDER BY token) AS tokens FROM said GROUP BY 1)
SELECT document_id, string_agg(other, ',' ORDER BY k) AS related, any_value(tokens) AS tokens FROM top JOIN names USING (document_id) GROUP BY 1""")
def _(d):
    return _near(d, False, 6)[1][0].select("document_id", F.array_join("related", ",").alias("related"), F.array_join("tokens", ",").alias("tokens"))


@register("cross_packet_passed_over", f"""WITH {_TOKENS}, has AS (SELECT DISTINCT a.document_id FROM tok a JOIN tok b ON a.token = b.token AND a.document_id <> b.document_id),
t AS (SELECT o_orderkey AS k, 'D' || o_orderkey AS document_id, 'D' || o_orderkey IN (SELECT document_id FROM has) AS able FROM orders WHERE o_orderkey % 4 = 0), r AS (SELECT *, count(*) FILTER (WHERE able) OVER (ORDER BY k) AS n FROM t)
SELECT CASE WHEN able THEN 'cross_packet_verification_deferred_by_cap' ELSE 'cross_packet_verification_no_shared_source_identifier' END AS reason, count(*) AS documents FROM r WHERE NOT able OR n > 100 GROUP BY 1""")
def _(d):
    return _near(d, True, 4, 100)[1][1].groupBy("reason").agg(F.count("*").alias("documents"))


@register("cross_packet_sizes", f"""WITH {_top('=', 4)}, size AS (SELECT 'D' || o_orderkey AS document_id, length('{{"po_number":"PO  ' || o_custkey || '-' || (o_orderkey % 5) || '","vendor":{{' || CASE WHEN o_orderkey % 3 = 0 THEN '"name":"Seller ' || (o_orderkey % 10) || '"' ELSE '' END || '}}' ||
 CASE WHEN o_orderkey % 7 = 0 THEN ',"checks":[{{"number":"CHK ' || (o_orderkey // 2) || '"}}]' ELSE '' END || ',"note":"kept back"}}') AS b FROM orders), part AS (SELECT document_id, other FROM top UNION ALL SELECT DISTINCT document_id, document_id FROM top),
p AS (SELECT part.document_id, count(*) AS documents, CAST(sum(b) AS BIGINT) AS bytes FROM part JOIN size ON size.document_id = part.other GROUP BY 1) SELECT *, CASE WHEN bytes > 300 THEN 'packet_exceeds_context_bytes' END AS reason FROM p""")
def _(d):
    rows, (found, _) = _near(d, True, 4)
    return neighbours.packets(found, rows, 300)


# ---- questions: line items by reason and field ---------------------------------------------------------


def _findings(d):
    rows = _items(d).withColumn("group_id", F.when(F.col("ordinal") < 7, F.concat_ws("/", "reason", "field", (F.col("ordinal") % 4).cast("string"))))
    level = F.when(F.col("ordinal") == 3, "critical").when(F.col("ordinal") == 2, "High")
    return rows.select(F.col("item_id").alias("item_index"), "group_id", "document_id", "page_id", "field", "reason", F.col("evidence").alias("candidates"), level.alias("priority"))


def _pack(d, most=None):
    rows = _findings(d)
    groups = rows.filter("group_id is not null").select("group_id", "reason", "field").distinct().select("group_id", F.col("reason").alias("finding_family"), (F.col("field") == "amount").alias("protected"))
    wording = d.spark.createDataFrame([("no_majority", "Which of these readings is right?", "choose_reading")], "finding_family string, headline string, decision_choice string")
    blank = rows.filter("document_id like '%0'").select(F.col("document_id").alias("page_id"))
    return questions.pack(groups, rows, wording, most, blank)


_FOUND = """f AS (SELECT 'R' || l_orderkey || '-' || l_linenumber || '-' || l_partkey AS item_index, 'D' || l_orderkey AS document_id, CASE WHEN l_returnflag = 'A' THEN 'notes' ELSE 'amount' END AS field, CASE WHEN l_suppkey % 3 = 0 THEN 'formatting_review' ELSE 'no_majority' END AS reason, l_linenumber AS o, 'P' || l_partkey AS seen FROM lineitem),
i AS (SELECT *, CASE WHEN o < 7 THEN reason || '/' || field || '/' || (o % 4) END AS group_id FROM f),
g AS (SELECT group_id, any_value(reason) AS reason, any_value(field) = 'amount' AS protected, count(*) AS items, count(DISTINCT document_id) AS documents, min(CASE o WHEN 3 THEN 0 WHEN 2 THEN 1 ELSE 2 END) AS level FROM i WHERE group_id IS NOT NULL GROUP BY 1),
q AS (SELECT *, row_number() OVER (ORDER BY protected, items DESC, group_id) AS number FROM g)"""
_SHOWN = """m AS (SELECT group_id, document_id, arg_min(item_index, field || item_index) AS item_index, arg_min(seen, field || item_index) AS seen FROM i WHERE group_id IS NOT NULL GROUP BY ALL),
e AS (SELECT *, document_id LIKE '%0' AS dull, bool_and(document_id LIKE '%0') OVER (PARTITION BY group_id) AS all_dull FROM m), s AS (SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY document_id) AS place, count(*) OVER (PARTITION BY group_id) AS n FROM e WHERE all_dull OR NOT dull),
x AS (SELECT * FROM s WHERE n <= 3 OR place - 1 IN (0, n - 1, CAST(round_even((n - 1) / 2, 0) AS BIGINT)))"""


@register("question_pack", f"""WITH {_FOUND}, {_SHOWN}, u AS (SELECT group_id, seen, min(place) AS p FROM x GROUP BY ALL), r AS (SELECT group_id, string_agg(seen, ' | ' ORDER BY p) AS read FROM u GROUP BY 1)
SELECT 'Q' || lpad(CAST(number AS VARCHAR), 3, '0') AS question_id, group_id, items, documents, ['critical', 'high', 'normal'][level + 1] AS priority, protected, NOT protected AS batch_clear_permitted, reason <> 'no_majority' AS generic_wording, read AS what_we_read, number > 5 AS deferred FROM q JOIN r USING (group_id)""")
def _(d):
    return _pack(d, 5)["questions"].select("question_id", "group_id", "items", "documents", "priority", "protected", "batch_clear_permitted", "generic_wording", "what_we_read", "deferred")


@register("question_examples", f"WITH {_FOUND}, {_SHOWN} SELECT group_id, place, document_id FROM x")
def _(d):
    return _pack(d)["examples"].select("group_id", "place", "document_id")


@register("question_members", f"WITH {_FOUND} SELECT item_index, 'Q' || lpad(CAST(number AS VARCHAR), 3, '0') AS question_id FROM i LEFT JOIN q USING (group_id)")
def _(d):
    return _pack(d)["members"].select("item_index", "question_id")


@register("question_summary", f"""WITH {_FOUND}, k AS (SELECT * FROM q WHERE number <= 5) SELECT count(*) AS questions, count(*) FILTER (WHERE protected) AS protected, count(*) FILTER (WHERE reason <> 'no_majority') AS generic, CAST(sum(items) AS BIGINT) AS items_covered,
 (SELECT count(*) FROM q WHERE number > 5) AS deferred, (SELECT count(*) FROM i) AS queue_items, round(100.0 * sum(items) / (SELECT count(*) FROM i), 2) AS coverage_pct FROM k""")
def _(d):
    return _pack(d, 5)["summary"].select("questions", "protected", "generic", "items_covered", "deferred", "queue_items", "coverage_pct")


@register("review_blocks", f"""WITH {_FOUND}, b AS (SELECT CASE WHEN reason = 'no_majority' THEN 'consensus' ELSE 'unclassified' END AS control FROM f WHERE o <> 2 AND (o <> 3 OR field = 'notes'))
SELECT control, count(*) AS blocking_items, CASE control WHEN 'consensus' THEN 1000000 ELSE 1 END AS threshold, control = 'unclassified' OR count(*) >= 1000000 AS triggered FROM b GROUP BY control""")
def _(d):
    rows = _items(d).withColumns({"blocking": F.when(F.col("ordinal") == 2, False), "disposition": F.when((F.col("ordinal") == 3) & (F.col("field") == "amount"), "No_Action_needed")})
    return questions.blocks(rows, ("reason",), {"consensus": 1000000})


# ---- unsettled candidates: the texts of documents, their sources, and broken claims --------------------------


@cache
def _claims():
    k = F.col("doc_id")
    note = F.struct(F.array(F.struct(F.array("text").alias("body"), F.col("lang").alias("language"))).alias("candidate_values"), F.lit("single_engine").alias("consensus_flag"))
    rep = F.struct(F.array("source", F.lit("Sales Rep of the house")).alias("candidate_values"), F.when(k % 2 == 0, "no_majority").otherwise("split").alias("consensus_flag"), (k % 4 == 0).alias("accepted"))
    odd = F.when(k % 10 == 0, 5)
    bare = F.struct(F.when(k % 11 == 0, "text").alias("candidate_values"))
    fields = F.to_json(F.struct(note.alias("contact/note"), rep.alias("header.sales_rep"), odd.alias("odd"), bare.alias("bare")))
    return k.alias("index"), F.when(k % 17 != 0, F.concat(F.lit("T"), k)).alias("document_id"), F.when(k % 19 != 0, fields).alias("fields")


def _retained(d):
    return surface.Retained(d.raw("documents").select(*_claims()))


_KEPT = "k AS (SELECT *, 'T' || doc_id AS document_id FROM documents WHERE doc_id % 17 <> 0 AND doc_id % 19 <> 0), u AS (SELECT * FROM k WHERE doc_id % 4 <> 0)"
_WORD = r"[^\pL\pN_]"


@register("schema_surface", f"""WITH {_KEPT}, x AS (SELECT 'contact/note' AS field, document_id, coalesce(text, '') || chr(1) || coalesce(lang, '') AS v, 'single_engine' AS flag FROM k UNION ALL SELECT 'header.sales_rep', document_id, source, CASE WHEN doc_id % 2 = 0 THEN 'no_majority' ELSE 'split' END FROM u WHERE source IS NOT NULL
 UNION ALL SELECT 'header.sales_rep', document_id, 'Sales Rep of the house', NULL FROM u)
SELECT field, count(*) AS occurrences, count(DISTINCT document_id) AS documents, count(DISTINCT v) AS distinct_values, array_to_string(list_sort(list(DISTINCT document_id))[:3], ',') AS document_ids, CASE field WHEN 'contact/note' THEN 'contact' ELSE 'party,sales_representative' END AS topics, count(DISTINCT flag) AS flags FROM x GROUP BY field""")
def _(d):
    s = surface.surface(_retained(d), 3)
    return s.select("field", "occurrences", "documents", "distinct_values", F.array_join("document_ids", ",").alias("document_ids"), F.array_join("topics", ",").alias("topics"), F.size("flags").cast("long").alias("flags"))


_HEARD = rf"""said AS (SELECT document_id, 'contact/note' AS field, text AS t FROM k UNION ALL SELECT document_id, 'contact/note', lang FROM k UNION ALL SELECT document_id, 'header.sales_rep', source FROM u UNION ALL SELECT document_id, 'header.sales_rep', 'Sales Rep of the house' FROM u),
heard AS (SELECT 'attention' AS signal, * FROM said WHERE regexp_matches(t, '(?:^|{_WORD})(?:attn\.|(?:attn|attention)(?:{_WORD}|$))', 'i') UNION ALL SELECT 'contact_or_representative_label', * FROM said WHERE regexp_matches(t, '(?:^|{_WORD})(?:contact|sales\s*(?:rep(?:resentative)?|person)|representative|account\s*(?:manager|executive))(?:{_WORD}|$)', 'i')
 UNION ALL SELECT 'email', * FROM said WHERE regexp_matches(t, '\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{{2,}}\b', 'i') UNION ALL SELECT 'phone', * FROM said WHERE regexp_matches(t, '(?:^|{_WORD})(?:\+\d{{1,3}}[ .-]?)?(?:\(?\d{{2,4}}\)?[ .-]){{1,3}}\d{{3,4}}(?:\s*(?:x|ext\.?|extension)\s*\d{{1,6}})?(?:{_WORD}|$)', 'i'))"""


@register("schema_signals", f"WITH {_KEPT}, {_HEARD} SELECT signal, count(*) AS occurrences, count(DISTINCT document_id) AS documents, count(DISTINCT field) AS fields, min(document_id) AS first FROM heard GROUP BY signal")
def _(d):
    return surface.signal_summary(_retained(d), 5).select("signal", "occurrences", "documents", "fields", F.col("examples")[0]["document_id"].alias("first"))


@register("recovery_scope", f"""WITH {_KEPT}, {_HEARD}, c AS (SELECT document_id, count(source) + count(*) AS candidates FROM u GROUP BY 1), h AS (SELECT document_id, count(*) AS signals FROM heard WHERE signal IN ('email', 'phone') GROUP BY 1)
SELECT coalesce(c.document_id, h.document_id) AS document_id, coalesce(candidates, 0) AS candidates, coalesce(signals, 0) AS signals FROM c FULL JOIN h ON c.document_id = h.document_id""")
def _(d):
    return surface.recovery_scope(_retained(d), ("sales_representative",), ("email", "phone"))["documents"]


@register("surface_exceptions", """SELECT reason, count(*) AS rows FROM (SELECT 'candidate_inventory_document_id_missing' AS reason FROM documents WHERE doc_id % 17 = 0 UNION ALL SELECT 'candidate_inventory_fields_missing' FROM documents WHERE doc_id % 17 <> 0 AND doc_id % 19 = 0
 UNION ALL SELECT 'candidate_inventory_field_claim_malformed' FROM documents WHERE doc_id % 17 <> 0 AND doc_id % 19 <> 0 AND doc_id % 10 = 0 UNION ALL SELECT 'candidate_inventory_values_malformed' FROM documents WHERE doc_id % 17 <> 0 AND doc_id % 19 <> 0 AND doc_id % 11 = 0) GROUP BY 1""")
def _(d):
    return _retained(d).exceptions.groupBy("reason").agg(F.count("*").alias("rows"))


# ---- payments: a number is used by two vendors, and some payments name one ------------------------------------


def _events(d):
    o, k = d.raw("orders"), F.col("o_orderkey")
    status = F.when(k % 29 == 0, "Disputed")
    return o.select(F.concat(F.lit("D"), k).alias("document_id"), F.when(k % 31 == 0, "memo").otherwise("invoice").alias("doc_type"), F.concat(F.lit("Vendor "), (k % 2).cast("string")).alias("vendor"), F.concat(F.lit("N"), F.floor(k / 2).cast("string")).alias("invoice_number"), F.when(k % 3 == 0, "usd").otherwise("EUR").alias("currency"), F.col("o_totalprice").cast("decimal(16,2)").alias("amount"), F.lit(0).alias("credits"), status.alias("explicit_status"))


def _export(d):
    """One payment a customer, its orders as nested applications; a tenth name no vendor, some no number."""
    k = F.col("o_orderkey")
    part = F.col("o_totalprice").cast("decimal(16,2)") - F.when(k % 4 == 0, 100).otherwise(0)
    line = F.struct(F.when(k % 13 != 0, F.concat(F.lit("N"), F.floor(k / 2).cast("string"))).alias("invoice_number"), F.when(k % 10 != 0, F.concat(F.lit("VENDOR "), (k % 2).cast("string"))).alias("vendor_name"), part.cast("string").alias("amount_applied"))
    return d.raw("orders").filter("o_orderstatus <> 'O'").select(F.lit(None).cast("string").alias("currency"), F.array(line).alias("applied"))


_PAID = """a AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 13 <> 0 THEN 'N' || (o_orderkey // 2) END AS num, CASE WHEN o_orderkey % 10 <> 0 THEN 'vendor ' || (o_orderkey % 2) END AS v, CAST(o_totalprice AS DECIMAL(16,2)) - CASE WHEN o_orderkey % 4 = 0 THEN 100 ELSE 0 END AS paid FROM orders WHERE o_orderstatus <> 'O'),
e AS (SELECT o_orderkey AS k, 'N' || (o_orderkey // 2) AS num, 'vendor ' || (o_orderkey % 2) AS v, CAST(o_totalprice AS DECIMAL(16,2)) AS amount FROM orders),
c AS (SELECT a.*, count(e.k) AS n, min(e.k) AS to_k FROM a LEFT JOIN e ON a.num = e.num AND (a.v IS NULL OR a.v = e.v) GROUP BY ALL), p AS (SELECT to_k AS k, sum(paid) AS applied FROM c WHERE n = 1 GROUP BY 1),
r AS (SELECT e.k, e.v, e.num, amount, coalesce(applied, 0) AS applied, amount - coalesce(applied, 0) AS balance, CASE WHEN e.k % 29 = 0 OR abs(amount - coalesce(applied, 0)) <= 0.01 THEN 'closed' WHEN applied > 0 AND applied < amount THEN 'partial' ELSE 'unresolved' END AS closure FROM e LEFT JOIN p USING (k) WHERE e.k % 31 <> 0)"""


@register("payment_closure", f"WITH {_PAID} SELECT closure, count(*) AS invoices, CAST(sum(balance) AS DOUBLE) AS balance FROM r GROUP BY 1")
def _(d):
    return payments.close_open_items(_events(d), payments.applications(_export(d)))[0].groupBy("closure").agg(F.count("*").alias("invoices"), F.sum("balance").alias("balance"))


@register("payment_exceptions", f"WITH {_PAID} SELECT CASE WHEN num IS NULL THEN 'payment_row_has_no_invoice_number' WHEN n = 0 THEN 'no_invoice' ELSE 'ambiguous' END AS reason, count(*) AS applications, CAST(sum(paid) AS DOUBLE) AS paid FROM c WHERE n <> 1 GROUP BY 1")
def _(d):
    bad = payments.close_open_items(_events(d), payments.applications(_export(d)))[1]
    return bad.groupBy("reason").agg(F.sum("applications").alias("applications"), F.sum("paid").alias("paid"))


@register("largest_unresolved", f"WITH {_PAID} SELECT 'D' || k AS document_id, v AS vendor, CAST(balance AS DOUBLE) AS balance, (SELECT count(*) FROM r WHERE closure = 'unresolved') AS all_items FROM r WHERE closure = 'unresolved' ORDER BY r.balance DESC, 'D' || k LIMIT 50")
def _(d):
    out = payments.close_open_items(_events(d), payments.applications(_export(d)))[0]
    return payments.largest(out, "unresolved").select("document_id", "vendor", "balance", "all_items")
