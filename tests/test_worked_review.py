"""Rows worked out by hand: review."""

import pytest
from pyspark.sql import functions as F

from attestra.operators import arithmetic, controls, pages, recovery, review, sampling

from .worked import Worked

WORKED = Worked()
worked = WORKED.add


#: (reason, what the item is about, causes)
_PROTECTION = [
    ("no_majority", "", "reason:no_majority"), ("formatting_review", "notes", ""), ("formatting_review", "tax_total", "field_token:tax,field_token:total"),
    (" Missing_Signature ", "", "reason_token:missing,reason_token:signature"), ("brand_new", "", "unclassified_reason"), (None, None, "unclassified_reason"), ("document_type_proposal", "Vendor_Name", "field_token:vendor"),
]

@worked("review_protection", ("reason VARCHAR, about VARCHAR, causes VARCHAR", _PROTECTION))
def _(d):
    rows = d.spark.createDataFrame([r[:2] for r in _PROTECTION], "reason string, about string")
    return rows.select("reason", "about", F.array_join(review.protection(F.col("reason"), F.col("about")), ",").alias("causes"))

#: (ordinal, document, recorded, audited, outcome)
_OUTCOMES = [
    (0, "D1", 10.0, 10.0, "reviewed_correct"), (1, " D2 ", 20.0, 15.0, "reviewed_error"), (2, "D1", 10.0, 9.0, "reviewed_error"), (3, "D3", 31.0, 30.0, "reviewed_error"), (4, "D4", 40.0, None, "abstained"),
    (5, "D5", 50.0, 50.0, "reviewed_error"), (6, "", 1.0, 1.0, "reviewed_correct"), (7, None, 1.0, 1.0, "reviewed_correct"), (8, "D9", 90.0, 90.0, "reviewed_correct"), (9, "D6", 60.0, None, "reviewed_correct"), (10, "D7", 70.0, 70.0, "looks_fine"), (11, "D8", float("inf"), 80.0, "reviewed_error"),
]

_SELECTED = [("D1", 10.0), ("D2", 20.0), ("D3", 30.0), ("D4", 40.0), ("D5", 50.0), ("D6", 60.0), ("D7", 70.0), ("D8", 80.0), ("D10", 100.0)]

_STATES = [
    ("D1", "complete", 1), ("D2", "complete", 0), ("D3", "recorded_value_differs", 0), ("D4", "unresolved", 0), ("D5", "outcome_contradicts_value", 0), ("", "no_document_id", 0), ("D9", "extra", 0),
    ("D6", "invalid_outcome", 0), ("D7", "invalid_outcome", 0), ("D8", "recorded_value_differs", 0), ("D10", "missing", 0),
]

def _reconciled(d):
    chosen = d.spark.createDataFrame(_SELECTED, "document_id string, value double")
    given = d.spark.createDataFrame(_OUTCOMES, "ordinal int, document_id string, recorded double, audited double, outcome string")
    return sampling.reconcile_results(chosen, given)

@worked("sample_results", ("document_id VARCHAR, state VARCHAR, repeated BIGINT", _STATES))
def _(d):
    return _reconciled(d).select("document_id", "state", "repeated")

@worked("sample_review_status", ("status VARCHAR, documents BIGINT", [("blocked", 11)]))
def _(d):
    return sampling.review_complete(_reconciled(d), True)

#: (document, line, base, rate, amount, label, found)
_RATES = [
    ("D1", 1, 100.0, 5.0, 5.0, "reconciles", False), ("D1", 2, 2410.4, 120.52, None, "", True), ("D1", 3, 2410.4, 120.52, 1.0, "", False), ("D1", 4, 200.0, 7.0, None, "", False), ("D1", 5, None, 9.0, None, "", False),
    ("D2", 1, 2410.4, 120.52, None, "", False), ("D3", 1, 100.0, 150.0, 150.0, "reconciles", False), ("D3", 2, 200.0, 300.0, None, "", False), ("D1", 6, 2410.4, 120.52, 0.0, "", True), ("D1", 7, 0.0, 0.0, None, "", False),
]

@worked("rate_holds_amount", ("document_id VARCHAR, line INTEGER, rate_holds_amount BOOLEAN", [(*r[:2], r[6]) for r in _RATES]))
def _(d):
    rows = d.spark.createDataFrame([r[:6] for r in _RATES], "document_id string, line int, base double, rate double, amount double, label string")
    return arithmetic.rate_holds_amount(rows, "document_id", "amount", "base", "rate", "label").select("document_id", "line", "rate_holds_amount")

#: (document, line, field, value)
_FILED = [
    ("f__p01", "lines[0]", "brand", "Acme"), ("f__p01", "lines[0]", "code", ""), ("f__p01", "lines[1]", "brand", "Bolt"), ("f__p01", "lines[1]", "code", "X1"), ("f__p01", "lines[2]", "brand", " "), ("f__p02", "lines[0]", "brand", "Coil"),
    ("f__p03", "header", "brand", "Dyne"), ("f__p03", "header", "vendor", "Dyne Co"), ("f__p04", "header", "brand", "Echo"), ("f__p04", "header", "vendor", "Foxx"),
]

_FILING = [("p01", "brand", "code"), ("p03", "brand", "maker"), ("p04", "brand", "maker"), ("p04", "vendor", "maker")]

_AFTER = [
    ("f__p01", "lines[0]", "code", "Acme", "brand"), ("f__p01", "lines[1]", "brand", "Bolt", None), ("f__p01", "lines[1]", "code", "X1", None), ("f__p01", "lines[2]", "brand", " ", None), ("f__p02", "lines[0]", "brand", "Coil", None),
    ("f__p03", "header", "maker", "Dyne", "brand"), ("f__p03", "header", "vendor", "Dyne Co", None), ("f__p04", "header", "brand", "Echo", None), ("f__p04", "header", "vendor", "Foxx", None),
]

_REFUSED = [("f__p01", "lines[1]", "brand", "the_target_field_holds_a_reading"), ("f__p04", "header", "brand", "two_readings_for_one_target"), ("f__p04", "header", "vendor", "two_readings_for_one_target")]

def _refiled(d):
    rows = d.spark.createDataFrame(_FILED, "document_id string, line string, field string, value string")
    return pages.refile(rows, d.spark.createDataFrame(_FILING, "page string, source string, target string"), "A-3")

@worked("refiled_columns", ("document_id VARCHAR, line VARCHAR, field VARCHAR, value VARCHAR, refiled_from VARCHAR", _AFTER))
def _(d):
    return _refiled(d)[0].drop("authorization")

@worked("refile_refusals", ("document_id VARCHAR, line VARCHAR, field VARCHAR, reason VARCHAR", _REFUSED))
def _(d):
    return _refiled(d)[1].drop("target")

#: (page, index, reading, top, bottom): row 1 prints one code, row 2 two, row 3 and 4 overlap one code, 9.99 stands twice
_TOKENS = [
    ("p1", 0, "(AB-1)", 0.0, 10.0), ("p1", 1, "$1,200.00", 1.0, 9.0), ("p1", 2, "AB-2", 20.0, 30.0), ("p1", 3, "AB-3", 21.0, 29.0), ("p1", 4, "7.50", 20.0, 30.0), ("p1", 5, "AB-4", 40.0, 60.0), ("p1", 6, "3.00", 42.0, 50.0),
    ("p1", 7, "4.00", 51.0, 58.0), ("p1", 8, "AB-5", 70.0, 80.0), ("p1", 9, "9.99", 70.0, 80.0), ("p1", 10, "9.99", 90.0, 99.0), ("p2", 0, "AB-6", 0.0, 10.0), ("p2", 1, "5.00", 8.0, 30.0), ("p2", 2, "AB-7.", 18.0, 22.0), ("p2", 3, None, 0.0, 1.0),
]

_ROWS = [("p1", 1, ["1200.00", ""]), ("p1", 2, ["7.50"]), ("p1", 3, ["3.00"]), ("p1", 4, ["4.00"]), ("p1", 5, ["9.99"]), ("p2", 1, ["5.00", "5.00"]), ("p2", 2, None)]

@worked("printed_row_codes", ("page VARCHAR, position INTEGER, code VARCHAR", [("p1", 1, "AB-1"), ("p2", 1, "AB-7")]))
def _(d):
    lines = d.spark.createDataFrame(_ROWS, "page string, position int, amounts array<string>")
    return pages.printed_row_codes(lines, d.spark.createDataFrame(_TOKENS, "page string, index int, reading string, top double, bottom double"), r"AB-\d+")

#: (document, seller, brand, invoice number, pro number, invoice date, statement date, credit, credits applied, status)
_HEADERS = [
    ("D1", " Acme ", "Bolt", "INV-1", None, "2024-05-31", "2023-01-01", "(5.00)", None, "PAID "), ("D2", "", "Bolt", "", "P-9", " ", "May 31, 2024", None, "7.25", None),
    ("D3", None, None, None, None, None, None, None, None, ""), ("D4", None, "Coil", None, None, None, "Dec-2024", "n/a", "3", "Open"),
]

_EVENTS = [
    ("D1", "Acme", "INV-1", "2024-05-31", "2024-05", 5.0, "paid"), ("D2", "Bolt", "P-9", "May 31, 2024", "2024-05", 7.25, ""), ("D3", "UNKNOWN", None, None, None, 0.0, ""), ("D4", "Coil", None, "Dec-2024", "2024-12", 0.0, "open"),
]

@worked("document_events", ("document_id VARCHAR, vendor VARCHAR, invoice_number VARCHAR, date VARCHAR, month VARCHAR, credits DOUBLE, explicit_status VARCHAR", _EVENTS))
def _(d):
    names = "document_id seller_name brand_name invoice_number pro_number invoice_date statement_date credit_amount credits_applied payment_status".split()
    return controls.document_events(d.spark.createDataFrame(_HEADERS, ", ".join(f"{n} string" for n in names)))

#: (page, text)
_PRINTED = [
    ("a", "P.O.\nPO-17\n 1/2/2023 \n\nStudio Larch LLC\nPO-17\n1/3/2023\nOther Firm"), ("b", "PO-9\n01/16/2023\n30118 01/16/2023\nPO-8\n1/1/23\n91.09\nTotal\n2/2/23\nReal Firm"),
    ("c", "PO-5\r\n3/3/23\r\nTable Co\rPO-6\r3/4/23\rAtelier 54321"), ("d", "1/1/23\nFirst Line"), ("e", None), ("f", "PO-1\n4/4/23\n5/5/23\nLate Firm"),
]

_SPECIFIERS = [("a", "PO-17", "Studio Larch LLC"), ("c", "PO-6", "Atelier 54321")]

def _specifiers(d):
    return recovery.specifiers_by_order(d.spark.createDataFrame(_PRINTED, "page string, text string"), "page", "text")

@worked("specifiers_by_order", ("page VARCHAR, order_number VARCHAR, specifier VARCHAR", _SPECIFIERS))
def _(d):
    return _specifiers(d)

#: (page, order number, specifier, brand), then (outcome, brand holds it, specifier after)
_LINES = [("a", "PO-17", None, "studio larch llc ", "attached", True, "Studio Larch LLC"), ("a", "PO-17", "Own", "x", "already_stated", False, "Own"), ("a", "PO-1", " ", "x", "none_printed", False, " "), ("c", "PO-6", "", None, "attached", False, "Atelier 54321"), ("a", None, None, None, "none_printed", False, None)]

@worked("specifiers_attached", ("page VARCHAR, order_number VARCHAR, outcome VARCHAR, brand_holds_specifier BOOLEAN, specifier_name VARCHAR", [(r[0], r[1], *r[4:]) for r in _LINES]))
def _(d):
    lines = d.spark.createDataFrame([r[:4] for r in _LINES], "page string, order_number string, specifier_name string, brand_name string")
    return recovery.attach_specifiers(lines, _specifiers(d), "page").drop("brand_name")

_CUT = [("Ridgeli", "continued_in_mid_word"), ("RIDGELINE DESIGN SERVICES", None), ("Ridgeline Furniture Int.", None), ("Regional", "begins_several_names"), ("Regional Parcel", None), ("Regional - Slate", None), ("Solo", None), ("Solo Firm", None), ("Two Words", None), ("Two Words Here", None), ("Two Words There", None), ("--", None), (None, None)]

@worked("cut_off_names", ("name VARCHAR, why VARCHAR", [r for r in _CUT if r[1]]))
def _(d):
    return recovery.cut_off_names(d.spark.createDataFrame([r[:1] for r in _CUT], "name string"), "name")

#: (id, name, email, person, reasons)
_PEOPLE = [
    (1, "PETRA BRANNICKSEN", None, 1, "a middle initial,the same email,the same letters"), (2, "Petra Brannicksen", "petra@northgate.example", 1, "a middle initial,the same email,the same letters"), (3, "Petra K. Brannicksen", None, 1, "a middle initial,the same email,the same letters"), (4, "Petra Bronnicksen", " PETRA@northgate.example", 1, "a middle initial,the same email,the same letters"),
    (5, "Petra Halverson", None, 5, ""), (6, "Sam Poe", "", 6, ""), (7, "Sam Poe", None, 6, ""), (8, None, None, 8, ""), (9, "", "x@y.example", 9, ""), (10, None, None, 10, ""),
]

@worked("one_person_groups", ("reading_id BIGINT, person_id BIGINT, reasons VARCHAR", [(r[0], *r[3:]) for r in _PEOPLE]))
def _(d):
    rows = d.spark.createDataFrame([r[:3] for r in _PEOPLE], "reading_id long, name string, email string")
    return recovery.one_person(rows).withColumn("reasons", F.array_join("reasons", ","))


@pytest.mark.parametrize("name", sorted(WORKED.cases))
def test_worked(spark, name):
    WORKED.check(spark, name)
