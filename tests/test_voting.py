"""Tie breaks and corroboration on small cells."""

from attestra.operators import consensus, voting

READ = "document_id string, row_index int, field string, vendor string, value string, handwritten boolean"


def test_ties_break_by_the_document_then_by_the_page(spark):
    rows = [("d", 1, "extended_amount", v, x, False) for v, x in (("a", "100.00"), ("b", "100.00"))]
    rows += [("d", 2, "extended_amount", v, x, False) for v, x in (("a", "100.0"), ("b", "7.00"))]  # settled elsewhere
    rows += [("d", 3, "extended_amount", v, x, False) for v, x in (("a", "55.10"), ("b", "66.20"))]  # one is printed
    rows += [("d", 4, "extended_amount", v, x, False) for v, x in (("a", "100.00"), ("b", "$100.00"), ("c", "8"), ("e", "8"))]  # two spellings of the settled one
    rows += [("e", 1, "extended_amount", v, x, False) for v, x in (("a", "1.50"), ("b", "2.50"))]  # both printed
    rows += [("f", 1, "extended_amount", v, x, False) for v, x in (("a", "3.50"), ("b", "4.50"))]  # no page
    rows += [("g", 1, "extended_amount", "a", "9", False)]
    readings = spark.createDataFrame(rows, READ)
    pages = spark.createDataFrame([("d", "Total: 66.20 only"), ("e", "1.50 and 2.50"), ("e", None)], "document_id string, text string")
    cells = consensus.field_consensus(readings)
    got = {(r.document_id, r.row_index): (r.resolved_value, r.resolved_by, r.reason) for r in voting.vote_with_ties(cells, readings, pages).collect()}
    assert got == {("d", 2): ("100.0", "same_document", None), ("d", 3): ("66.20", "independent_extractor", None), ("d", 4): (None, None, "vendors_tied"), ("e", 1): (None, None, "vendors_tied"), ("f", 1): (None, None, "vendors_tied"), ("g", 1): (None, None, "below_minimum_vendor_agreement")}
    blind = {(r.document_id, r.row_index): r.resolved_by for r in voting.vote_with_ties(cells, readings).collect()}
    assert blind[("d", 2)] == "same_document" and blind[("d", 3)] is None


def test_corroboration_by_token_and_count(spark):
    pages = spark.createDataFrame([("p", "Qty 2 at $5,193.60\nbase 12.345"), ("p", "5193.60"), ("q", "  "), ("r", None)], "document_id string, text string")
    asked = [("p", "a", ["5,193.60"]), ("p", "b", ["2"]), ("p", "c", ["3"]), ("p", "d", ["12", None]), ("p", "e", ["12.345", "99.00"]), ("p", "f", ["2", "5193.60"]), ("p", "g", ["x9", "y9"]), ("p", "h", []), ("p", "i", None), ("q", "a", ["2"]), ("z", "a", ["2"]), ("p", "j", ["1", "2", "3"]), ("p", "k", [""])]
    findings = spark.createDataFrame(asked, "document_id string, field string, candidates array<string>")
    got = {(r.document_id, r.field): (r.outcome, r.value, r.match_mode, r.occurrences) if r.reason is None else r.reason for r in voting.corroborate(findings, voting.page_evidence(pages)).collect()}
    nothing, none = "no_candidate_value_to_weigh_against_evidence", "no_independent_evidence_for_page"
    assert got == {
        ("p", "a"): ("corroboration", "5,193.60", "substring", 2), ("p", "b"): ("corroboration", "2", "token", 1), ("p", "c"): "value_absent_from_independent_evidence", ("p", "d"): "value_absent_from_independent_evidence",
        ("p", "e"): ("tie_break", "12.345", "substring", 1), ("p", "f"): "both_candidates_present", ("p", "g"): "neither_candidate_present", ("p", "h"): nothing, ("p", "i"): nothing, ("q", "a"): none, ("z", "a"): none, ("p", "j"): nothing, ("p", "k"): "value_absent_from_independent_evidence",
    }
