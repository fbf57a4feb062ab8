"""Rows worked out by hand: fields."""

import pytest
from pyspark.sql import functions as F

from attestra.operators import brands, fields, mentions

from .worked import Worked

WORKED = Worked()
worked = WORKED.add


#: (document, path, value, source, reasons)
_CELLS = [
    ("D1", "header.invoice_date", "2024-03-05", "p1", ""), ("D1", "header.due_date", "2024-03-01", "p1", ""), ("D1", "header.currency", "usd", "p1", ""), ("D1", "currency", "XXX", None, ""),
    ("D1", "header.invoice_number", "A 7", "p1", "implausible_identifier_format"), ("D1", "header.po_number", "P-100", "", "missing_field_provenance"), ("D1", "header.vendor_name", "ACME, Inc.", "p1", "engagement_party_named_as_supplier"),
    ("D2", "lines[0].order_date", "13/02/2024", "p1", ""), ("D2", "lines[1].order_date", "03/02/2024 10:15 AM", "p1", ""), ("D2", "lines[2].order_date", "03/02/2024 late", "p1", "date_field_holds_a_non_date"),
    ("D2", "lines[0].total_amount", "(12.50)", "p1", "negative_value_requires_review"), ("D2", "lines[1].total_amount", "$1,200", "p1", ""), ("D2", "lines[2].total_amount", "n/a", "p1", "invalid_numeric_value"), ("D2", "currency", "ABC", "p1", "unsupported_currency"),
    ("D3", "order_date", "03/02/2024", "p1", "invalid_or_ambiguous_iso_date"), ("D3", "ship_date", "####", "p1", "date_not_rendered_in_source"), ("D3", "period_end", "March 2024", "p1", "date_lacks_a_day"), ("D3", "period_start", "TBD", "p1", "date_field_holds_a_non_date"),
    ("D3", "paid_date", "Tue, March 5, 2024", "p1", ""), ("D3", "note_date", "", "p1", ""), ("D3", "memo_number", None, "", ""), ("D3", "check_date", "4.5E+4", "p1", "date_not_rendered_in_source"), ("D3", "job_number", "12", None, "implausible_identifier_format"),
    ("D4", "order_date", "13/02/2024", "p1", "invalid_or_ambiguous_iso_date"), ("D4", "ship_date", "02/13/2024", "p1", "invalid_or_ambiguous_iso_date"), ("D4", "delivery_date", "2024-02-30", "p1", ""), ("D4", "quantity", "", "p1", "invalid_numeric_value"),
    ("D5", "ship_date", "2024-05-02", "p1", ""), ("D5", "delivery_date", "2024-05-01", "p1", ""), (None, "quantity", "-1", "p1", "negative_value_requires_review"),
]

_OF_CELLS = [(d, "currency" if r == "unsupported_currency" else p, r, v) for d, p, v, _, r in _CELLS if r]

_OF_DOCUMENTS = [("D1", "header.due_date", "due_date_before_invoice_date", None), ("D5", "header.delivery_date", "delivery_date_before_ship_date", None)]

@worked("field_issues", ("document_id VARCHAR, field VARCHAR, reason VARCHAR, value VARCHAR", _OF_CELLS + _OF_DOCUMENTS))
def _(d):
    rows = d.spark.createDataFrame([r[:4] for r in _CELLS], "document_id string, path string, value string, source string")
    return fields.field_issues(rows, ("USD", "EUR"), ("Acme LLC",))

#: (field, name, account, location, reason)
_NAMES = [
    ("vendor_name", "3390 TR Quill", "TR Quill", "3390", None), ("buyer_name", "212-VLO", "VLO", "212", None), ("buyer_name", "  Kestrel Ltd ", "Kestrel Ltd", "", None), ("brand_name", "40731", None, None, "party_name_carries_no_letter"),
    ("payee_name", "Quelena Co.", None, None, "the_client_is_not_a_counterparty"), ("payee_name", "QUEL", None, None, "the_client_is_not_a_counterparty"), ("payee_name", "Quelena & Co total", None, None, "the_client_is_not_a_counterparty"), ("payee_name", "Quelenas", "Quelenas", "", None),
    ("payee_name", "77 SW 9th Ave", None, None, "party_name_is_a_street_address"), ("dealer_name", "COMPANY", None, None, "party_name_is_a_label_or_placeholder"), ("dealer_name", "Total Fees this year:", None, None, "party_name_is_a_label_or_placeholder"),
    ("dealer_name", "-15% Specify Region", None, None, "party_name_is_a_label_or_placeholder"), ("dealer_name", "THE GLADE:", "THE GLADE:", "", None), ("dealer_name", "Total Pens & Ink", "Total Pens & Ink", "", None), ("customer_name", "614 Harborline", "Harborline", "614", None),
    ("sold_to_name", "N/A", None, None, "party_name_is_a_label_or_placeholder"), ("agent_name", "58 N Mill", "58 N Mill", "", None), ("specifier_name", "Émile Studio", "Émile Studio", "", None),
]

@worked("party_mentions", ("field VARCHAR, raw_name VARCHAR, account_name VARCHAR, location_identifier VARCHAR, reason VARCHAR", [(f, n.strip(), *r) for f, n, *r in _NAMES]))
def _(d):
    rows = d.spark.createDataFrame([(f"D{i}", "header", {f: n, "contact_name": "Mara"}) for i, (f, n, *_) in enumerate(_NAMES)] + [("D99", "lines[0]", None)], "document_id string, scope string, values map<string,string>")
    return mentions.party_mentions(rows, ("Quelena & Co",)).select("field", "raw_name", "account_name", "location_identifier", "reason")

#: (ordinal, key, name, variants, mentions)
_PARTIES = [
    (0, "k1", "Kestrel", ["KESTREL ltd"], 5), (1, "k2", "Kestral", None, 9), (2, "k3", "Brannick", ["Brannick Group"], 4), (3, "k4", "Brannick West", [], 2), (4, "k5", "Lot 7", [], 1), (5, "k6", "Tavish", [], 3), (6, "k7", "Orrickel", [], 3), (7, "k8", "Kestrell", [], 1),
]

#: (id, a, b, decision, declared, outcome, reason)
_DECISIONS = [
    (0, "kestrel", "KESTRAL", "same_party", "kestrelLTD", "applied", None), (1, "Kestrell", "Kestral", "same_party", None, "applied", None), (2, "Brannick", "brannick west", "branch_of", None, "applied", None), (3, "Lot7", "Nobody", "not_a_party", None, "applied", None),
    (4, "Tavish", "Orrickel", "same_party", "Other", "unmatched", "declared_name_is_not_a_printed_spelling"), (5, "Tavish", "Orrickel", "different_parties", None, "applied", None), (6, "Kestrel", "Kestral", "different_parties", None, "unmatched", "clustering_already_joined_them"),
    (7, "Nobody", "Tavish", "same_party", None, "unmatched", "a_name_resolved_to_no_party"), (8, "Nobody", "No one", "not_a_party", None, "unmatched", "neither_name_resolved_to_a_party"), (9, "Brannick", "Lot 7", "branch_of", None, "unmatched", "a_name_resolved_to_no_party"),
]

_DECIDED = [
    ("k2", "KESTREL ltd", "KESTREL ltd,Kestral,Kestrel,Kestrell", 15, None, "kept"), ("k3", "Brannick", "Brannick,Brannick Group", 4, None, "kept"), ("k4", "Brannick West", "Brannick West", 2, "k3", "kept"), ("k5", "Lot 7", "Lot 7", 1, None, "removed"),
    ("k6", "Tavish", "Tavish", 3, None, "kept"), ("k7", "Orrickel", "Orrickel", 3, None, "kept"),
]

def _decided(d):
    parties = d.spark.createDataFrame(_PARTIES, "ordinal int, party_key string, canonical_name string, name_variants array<string>, mention_count long")
    given = d.spark.createDataFrame([r[:5] for r in _DECISIONS], "decision_id int, a string, b string, decision string, canonical_name string")
    return mentions.decide_parties(parties, given)

@worked("decided_parties", ("party_key VARCHAR, canonical_name VARCHAR, name_variants VARCHAR, mention_count BIGINT, parent_party_key VARCHAR, state VARCHAR", _DECIDED))
def _(d):
    return _decided(d)[0].withColumn("name_variants", F.array_join("name_variants", ","))

@worked("party_decision_outcomes", ("decision_id INTEGER, decision VARCHAR, outcome VARCHAR, reason VARCHAR", [(r[0], r[3], *r[5:]) for r in _DECISIONS]))
def _(d):
    return _decided(d)[1].select("decision_id", "decision", "outcome", "reason")

#: (row, document, email, company)
_EMAILS = [
    (1, "D1", "mara@quelena.example", "k1"), (2, "D1", "jan@brannickfurniture.example", "k2"), (3, "D1", "x@gmail.example", None), (4, "D2", "y@quelena.example", None), (5, "D3", "z@tavishorrickel.example", None), (6, "D3", None, None), (7, "D3", "q@trq.example", None),
]

_OF_DOCUMENT = [("D1", "k1", "Quelena & Co"), ("D1", "k1", "Quelena"), ("D1", "k2", "BRANNICK"), ("D3", "k3", "Tavish"), ("D3", "k4", "Tavish Orrickel"), ("D3", "k5", "TRQ")]

@worked("company_of_email", ("row_id INTEGER, email VARCHAR, party_key VARCHAR", [(r, e, k) for r, _, e, k in _EMAILS]))
def _(d):
    emails = d.spark.createDataFrame([r[:3] for r in _EMAILS], "row_id int, document_id string, email string")
    return mentions.company_of_email(emails, d.spark.createDataFrame(_OF_DOCUMENT, "document_id string, party_key string, name string"))

#: (document, stated brand) and (is it read as a brand, name)
_STATED = [
    ("D1", "Tavish / Orrickel"), ("D2", "tavish / orrickel"), ("D3", "Tavish/Orrickel Inc."), ("D4", "Brannick"), ("D5", "9-ABC"), ("D6", "Quelena Co"), ("D7", "40731"), ("D8", "Ostrel"), ("D9", "Trq"), ("D10", "Cedars Realm"), ("D11", None),
]

_READ = [(True, "Tavish Orrickel"), (True, "Tavish/Orrickel Inc"), (True, "Brannick"), (True, "BRANNICK"), (False, "brannick"), (True, "Ostrel"), (False, "Ostrel"), (True, "Quelena Co"), (True, "Cedars Realm"), (True, "TRQ"), (True, None)]

_TOPS = [(1, "TAVISH / ORRICKEL order report"), (2, "Brannick and Tavish Orrickel"), (3, "brannick"), (4, None), (5, "Cedars Realm")]

@worked("brand_vocabulary", ("name VARCHAR, documents BIGINT", [("tavish / orrickel", 2), ("brannick", 1)]))
def _(d):
    stated = d.spark.createDataFrame(_STATED, "document_id string, name string")
    read = d.spark.createDataFrame(_READ, "is_brand boolean, name string")
    return brands.brand_vocabulary(stated, read, d.spark.createDataFrame(_TOPS, "page_id int, text string"), ("Quelena",))

#: (page, text, maker, method, candidates)
_HEADS = [
    (1, "Tavish/Orrickel statement", "tavish / orrickel", "letterhead", "tavish / orrickel"), (2, "CEDARW REALM of chairs", "cedars realm", "letterhead_one_letter_off", "cedars realm"), (3, "Cedar Realm", "cedars realm", "letterhead_one_letter_off", "cedars realm"),
    (4, "Brannick and Cedars Realm", None, "letterhead_names_several_brands", "brannick,cedars realm"), (5, "Brannick " + "x" * 120 + " Cedars Realm", "brannick", "letterhead", "brannick,cedars realm"), (6, "Brancink", None, None, None),
    (7, None, None, None, None), (8, "", None, None, None), (9, "x" * 600 + "Brannick", None, None, None), (10, "Tavish Orricke", "tavish / orrickel", "letterhead_one_letter_off", "tavish / orrickel"),
]

@worked("letterhead_makers", ("page_id INTEGER, maker VARCHAR, method VARCHAR, candidates VARCHAR", [(p, *r) for p, _, *r in _HEADS if r[1]]))
def _(d):
    pages = d.spark.createDataFrame([r[:2] for r in _HEADS], "page_id int, text string")
    known = d.spark.createDataFrame([("tavish / orrickel", 4), ("tavish orrickel", 2), ("orricke", 1), ("brannick", 3), ("cedars realm", 2)], "name string, documents long")
    return brands.letterhead_makers(pages, known).withColumn("candidates", F.array_join("candidates", ","))


@pytest.mark.parametrize("name", sorted(WORKED.cases))
def test_worked(spark, name):
    WORKED.check(spark, name)
