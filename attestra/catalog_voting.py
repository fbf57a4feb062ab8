"""Registered queries of the votes' tie breaks and of corroboration, each resolution by its kind."""

from __future__ import annotations

from pyspark.sql import functions as F

from .catalog import _CONSENSUS, _consensus
from .operators import consensus, voting
from .registry import register
from .sources.driver_tables import twin


def _texts(d):
    """The text of every other order: the amounts that reader a has on it."""
    return d.readings().filter("vendor = 'a' and field = 'extended_amount' and cast(substr(document_id, 2) as long) % 2 = 0").groupBy("document_id").agg(F.concat_ws(" ; ", F.sort_array(F.collect_list("value"))).alias("text"))


_TEXTS = "t AS (SELECT document_id, string_agg(value, ' ; ' ORDER BY value) AS text FROM readings WHERE vendor = 'a' AND field = 'extended_amount' AND CAST(substr(document_id, 2) AS BIGINT) % 2 = 0 GROUP BY 1)"
_TIES = f"""{_CONSENSUS}, top AS (SELECT c.*, max(n) OVER (PARTITION BY document_id, row_index, field) AS best FROM c),
lead AS (SELECT document_id, row_index, field, count(*) FILTER (WHERE n = best) AS leaders, max(best) AS agreeing, arg_max(k, n) AS k FROM top GROUP BY ALL),
open AS (SELECT lead.*, accepted FROM lead JOIN h USING (document_id, row_index, field)), tied AS (SELECT * FROM open WHERE NOT accepted AND leaders > 1),
norm AS (SELECT DISTINCT document_id, row_index, field, value, coalesce(CAST(TRY_CAST(value AS DECIMAL(18,2)) AS VARCHAR), lower(value)) AS v, CAST(TRY_CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS num FROM readings),
won AS (SELECT r.document_id, r.v, count(DISTINCT r0.vendor) AS n, r.row_index, r.field FROM norm r JOIN readings r0 ON r0.document_id = r.document_id AND r0.row_index = r.row_index AND r0.field = r.field AND r0.value = r.value GROUP BY ALL),
best AS (SELECT document_id, row_index, field, arg_max(v, m) AS v FROM (SELECT document_id, row_index, field, v, sum(n) AS m FROM won GROUP BY ALL) GROUP BY ALL),
settled AS (SELECT DISTINCT document_id, v FROM best JOIN open USING (document_id, row_index, field) WHERE accepted),
said AS (SELECT norm.* FROM norm SEMI JOIN tied USING (document_id, row_index, field)),
local AS (SELECT document_id, row_index, field FROM said SEMI JOIN settled USING (document_id, v) GROUP BY ALL HAVING count(*) = 1),
page AS (SELECT document_id, row_index, field FROM said JOIN t USING (document_id) WHERE contains(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')), trim(regexp_replace(lower(value), '[^a-z0-9]+', ' ', 'g'))) GROUP BY ALL HAVING count(*) = 1)"""


@register("vendor_vote_ties", twin(f"""WITH {_TEXTS}, {_TIES} SELECT field, CASE WHEN leaders > 1 THEN CASE WHEN (document_id, row_index, field) IN (SELECT (document_id, row_index, field) FROM local) THEN 'same_document'
 WHEN (document_id, row_index, field) IN (SELECT (document_id, row_index, field) FROM page) THEN 'independent_extractor' END WHEN agreeing >= 2 THEN 'vendor_agreement' END AS resolved_by, count(*) AS cells FROM open WHERE NOT accepted GROUP BY ALL""", "readings"))
def _(d):
    return voting.vote_with_ties(_consensus(d), d.readings(), _texts(d)).groupBy("field", "resolved_by").agg(F.count("*").alias("cells"))


def _weighed(d):
    """Open cells weighed on the page of their order: all their readings are candidates, and a flag is a token of one letter."""
    cells = _consensus(d).filter(~F.col("accepted")).select(*consensus.CELL)
    candidates = d.readings().join(cells, list(consensus.CELL), "left_semi").groupBy("document_id", "row_index", "field").agg(F.sort_array(F.collect_set("value")).alias("candidates"))
    return voting.corroborate(candidates, voting.page_evidence(_texts(d)))


_WEIGHED = f"""{_TEXTS}, {_CONSENSUS}, cand AS (SELECT document_id, row_index, field, list_sort(list(DISTINCT value)) AS cs FROM readings SEMI JOIN (SELECT * FROM h WHERE NOT accepted) USING (document_id, row_index, field) GROUP BY ALL),
seen AS (SELECT cand.*, text, CASE WHEN text IS NULL THEN [] ELSE list_filter(cs, lambda c: CASE WHEN length(c) < 3 THEN list_contains(string_split(text, ' ; '), c) ELSE contains(replace(text, ' ', ''), c) END) END AS hit FROM cand LEFT JOIN t USING (document_id)),
told AS (SELECT *, CASE WHEN text IS NULL THEN 'unresolved' WHEN len(cs) = 1 AND len(hit) = 1 THEN 'corroboration' WHEN len(cs) = 2 AND len(hit) = 1 THEN 'tie_break' ELSE 'unresolved' END AS outcome FROM seen)"""


@register("corroboration_outcomes", twin(f"""WITH {_WEIGHED} SELECT field, outcome, CASE WHEN outcome <> 'unresolved' THEN NULL WHEN text IS NULL THEN 'no_independent_evidence_for_page' WHEN len(cs) = 1 THEN 'value_absent_from_independent_evidence'
 WHEN len(cs) = 2 THEN CASE WHEN len(hit) = 2 THEN 'both_candidates_present' ELSE 'neither_candidate_present' END ELSE 'no_candidate_value_to_weigh_against_evidence' END AS reason, count(*) AS cells FROM told GROUP BY ALL""", "readings"))
def _(d):
    return _weighed(d).groupBy("field", "outcome", "reason").agg(F.count("*").alias("cells"))


@register("corroborated_values", twin(f"""WITH {_WEIGHED} SELECT document_id, row_index, field, hit[1] AS value, 'substring' AS match_mode, CAST((length(replace(text, ' ', '')) - length(replace(replace(text, ' ', ''), hit[1], ''))) / length(hit[1]) AS INTEGER) AS occurrences FROM told WHERE outcome <> 'unresolved'""", "readings"))
def _(d):
    return _weighed(d).filter("outcome <> 'unresolved'").select("document_id", "row_index", "field", "value", "match_mode", "occurrences")
