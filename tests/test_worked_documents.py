"""Rows worked out by hand: documents."""

import pytest
from pyspark.sql import functions as F

from attestra.functions import values
from attestra.functions.address import parse_address
from attestra.operators import consensus, entities, loading, proof

from .worked import Worked

WORKED = Worked()
worked = WORKED.add


def literal(d, rows: list[tuple], schema: str):
    return d.spark.createDataFrame(rows, schema)

#: (reading, the document's convention, loadable text, currency, plain money)
_MONEY = [
    ("$4,318.00", "", "4318.00", "", 4318.0), ("731.45 USD", "", "731.45", "USD", None), ("(518.27)", "", "-518.27", "", -518.27),
    ("n/a", "", "", "", None), ("3 407,15", "decimal_comma", "3407.15", "", None), ("3 407,15", "", "", "", None),
    ("2,583", "decimal_comma", "", "", 2583.0), ("12,34", "", "", "", None), ("1.234,50", "decimal_comma", "1234.50", "", None),
    ("12-34", "", "", "", None), ("2024-01-05", "", "", "", None), ("(5) 3", "", "", "", None), ("2,904,113.08", "", "2904113.08", "", 2904113.08),
    ("(CAD 12.50)", "", "-12.50", "CAD", None), ("", "", "", "", None), (None, "", "", "", None), ("£ 7.25", "", "7.25", "", None), ("-3.10", "", "-3.10", "", -3.1), ("$ 1 200.00", "", "", "", None),
]

@worked("money_readings", ("reading VARCHAR, convention VARCHAR, loadable VARCHAR, currency VARCHAR, money DOUBLE", _MONEY))
def _(d):
    rows = literal(d, [r[:2] for r in _MONEY], "reading string, convention string")
    amount, code = values.loadable_amount(F.col("reading"), F.col("convention"))
    return rows.select("reading", "convention", amount.alias("loadable"), code.alias("currency"), values.parse_money(F.col("reading")).alias("money"))

#: (cell, order, date, month)
_DATES = [
    ("2024-05-31", None, "2024-05-31", ""), ("May 31, 2024", None, "2024-05-31", ""), ("05/06/2024", None, None, ""), ("05/06/2024", "month_first", "2024-05-06", ""),
    ("05/06/2024", "day_first", "2024-06-05", ""), ("Wed, Oct 9, 2019, 8:41 AM", None, "2019-10-09", ""), ("8/19/2021 3:17 PM", "month_first", "2021-08-19", ""),
    ("2021-0618", None, "2021-06-18", ""), ("01/08/20...", "month_first", None, ""), ("December-24", None, None, ""), ("December 2025", None, None, "2025-12"),
    ("Dec-2024", None, None, "2024-12"), ("Sept 2024", None, None, "2024-09"), ("05/24/0122", "month_first", None, ""), ("0122-05-24", None, None, ""), ("2024-02-30", None, None, ""),
    ("Foo 3, 2024", None, None, ""), ("3/4/22", "month_first", "2022-03-04", ""), ("", None, None, ""), (None, None, None, ""), ("Jul 22, 2021 at 11:03:52 AM ET", None, "2021-07-22", ""),
]

@worked("date_readings", ("cell VARCHAR, date_order VARCHAR, iso VARCHAR, month VARCHAR", _DATES))
def _(d):
    rows = literal(d, [r[:2] for r in _DATES], "cell string, date_order string")
    return rows.select("cell", "date_order", values.loadable_date(F.col("cell"), F.col("date_order")).alias("iso"), values.loadable_month(F.col("cell")).alias("month"))

_COUNTS = [("12", "12"), ("2.5", "2.5"), ("1,200", "1200"), ("***", ""), ("12 EA", ""), ("-3", "-3"), ("1,20", ""), ("", ""), (None, "")]

@worked("count_readings", ("cell VARCHAR, loadable VARCHAR", _COUNTS))
def _(d):
    return literal(d, [r[:1] for r in _COUNTS], "cell string").select("cell", values.loadable_count(F.col("cell")).alias("loadable"))

_PERCENTS = [("10%", False, "10"), ("10.00", False, ""), ("10.00", True, "10.00"), ("1.00", False, ""), ("−5 %", False, "-5"), ("abc%", True, ""), ("1,000%", True, ""), (None, True, "")]

@worked("percent_readings", ("cell VARCHAR, proven BOOLEAN, loadable VARCHAR", _PERCENTS))
def _(d):
    return literal(d, [r[:2] for r in _PERCENTS], "cell string, proven boolean").select("cell", "proven", values.loadable_percent(F.col("cell"), F.col("proven")).alias("loadable"))

_SCALARS = [
    ("phone", "(416) 555-0199 ext 3", "+14165550199"), ("phone", "1-416-555-0199", "+14165550199"), ("phone", "555-0199", None),
    ("postal", "Springfield, IL 62704-1234", "62704"), ("postal", "Laval QC h7a 1b2", "H7A"), ("postal", "none", None), ("shape", "AB-1204", "AB-####"),
]

@worked("scalar_readings", ("kind VARCHAR, cell VARCHAR, reading VARCHAR", _SCALARS))
def _(d):
    rows = literal(d, [r[:2] for r in _SCALARS], "kind string, cell string")
    c = F.col("cell")
    return rows.withColumn("reading", F.when(F.col("kind") == "phone", values.phone_e164(c)).when(F.col("kind") == "postal", values.postal_key(c)).otherwise(values.key_shape(c)))

_ADDRESSES = [
    ("1 Main St, Springfield, IL 62704", "1 Main St", None, "Springfield", "IL", "62704", "US", None), ("Unit 4, 2 Rue Nord, Laval QC H7A 1B2, Canada", "Unit 4", "2 Rue Nord", "Laval", "QC", "H7A1B2", "CA", None),
    ("1 High St, Leeds 62704, UK", "1 High St", None, "Leeds 62704", None, None, "GB", "address_country_postal_mismatch"), ("", None, None, None, None, None, None, "address_parse_incomplete"),
]

@worked("address_parse", ("raw VARCHAR, line1 VARCHAR, line2 VARCHAR, city VARCHAR, region VARCHAR, postal VARCHAR, country VARCHAR, reason VARCHAR", _ADDRESSES))
def _(d):
    return literal(d, [r[:1] for r in _ADDRESSES], "raw string").withColumn("a", parse_address(F.col("raw"))).select("raw", "a.*")

_NAMES = [
    ("Company LLC", "company llc", False), ("L.L.C.", "l l c", False), ("The Acme Mfg. Co., Inc.", "acme manufacturing", False), ("A.B.C. Freight & Sons", "abc freight sons", False),
    ("Intl Frt Svcs GmbH", "international freight services", False), ("Northgate Ind…", "northgate industries", True), ("Cut off...", "cut off", True), ("", "", False), (None, None, False),
]

@worked("name_edges", ("raw VARCHAR, norm VARCHAR, truncated BOOLEAN", _NAMES))
def _(d):
    return literal(d, [r[:1] for r in _NAMES], "raw string").select("raw", entities.normalise_name(F.col("raw")).alias("norm"), entities.is_truncated(F.col("raw")).alias("truncated"))

#: (document, field, readings by a, b, c; accepted value, flag)
_CELLS = [
    ("d1", "invoice_number", ("007", "7", None), None, "no_consensus"), ("d2", "invoice_number", ("INV 7", "inv  7", None), "INV 7", "consensus_2of2"), ("d3", "invoice_number", ("A-7", "A7", None), None, "no_consensus"),
    ("d4", "total_amount", ("100.000", "100.004", None), "100.000", "consensus_2of2"), ("d5", "total_amount", ("100.000", "100.004", "100.008"), "100.000", "consensus_2of3"),
    ("d6", "total_amount", ("10.003", "9.995", "9.999"), None, "no_consensus"), ("d7", "total_amount", ("$1,000.00", "1000", "1 000"), "$1,000.00", "consensus_3of3"), ("d8", "total_amount", ("5", None, None), None, "single_engine"),
    ("d9", "seller_name", ("Northgate & Co", "Northgate Co", None), "Northgate & Co", "consensus_2of2"), ("e1", "seller_name", ("fern hollow", "Fernhollow", "other"), "fern hollow", "consensus_2of3"), ("e2", "seller_name", ("x", "y", "z"), None, "no_consensus"),
]

@worked("consensus_edges", ("document_id VARCHAR, field VARCHAR, value VARCHAR, consensus_flag VARCHAR", [(c[0], c[1], c[3], c[4]) for c in _CELLS]))
def _(d):
    rows = [(doc, 1, field, v, x, False) for doc, field, readings, _, _ in _CELLS for v, x in zip("abc", readings) if x is not None]
    cells = consensus.field_consensus(literal(d, rows, "document_id string, row_index int, field string, vendor string, value string, handwritten boolean"))
    return cells.select("document_id", "field", "value", "consensus_flag")

_HAND = [("h1", "total_amount", 2, None, "consensus_2of2_below_required_3", "handwritten_numeric_3of3"), ("h2", "total_amount", 3, "5", "consensus_3of3", "handwritten_numeric_3of3"), ("h3", "note", 2, "5", "consensus_2of2", "handwritten_text_majority")]

@worked("consensus_handwritten", ("document_id VARCHAR, field VARCHAR, engine_count INTEGER, value VARCHAR, consensus_flag VARCHAR, rule VARCHAR", _HAND))
def _(d):
    rows = [(doc, 1, field, v, "5", True) for doc, field, n, *_ in _HAND for v in "abc"[:n]]
    cells = consensus.field_consensus(literal(d, rows, "document_id string, row_index int, field string, vendor string, value string, handwritten boolean"))
    return cells.select("document_id", "field", "engine_count", "value", "consensus_flag", "rule")

_AMENDED = [("d1", 1, 4.0, 5.0, 20.0, True, "pass"), ("d1", 2, 2.0, 3.0, 6.0, False, "pass"), ("d2", 1, None, 3.0, 6.0, False, "not_applicable"), ("d2", 2, 2.0, 3.0, 9.0, True, "fail")]

@worked("amended_line_proof", ("document_id VARCHAR, line INTEGER, quantity DOUBLE, unit_price DOUBLE, extended_amount DOUBLE, handwritten BOOLEAN, status VARCHAR", _AMENDED))
def _(d):
    lines = literal(d, [("d1", 1, 3.0, 5.0, 20.0), ("d1", 2, 2.0, 3.0, 6.0), ("d2", 1, None, 3.0, 6.0), ("d2", 2, 2.0, 3.0, 6.0)], "document_id string, line int, quantity double, unit_price double, extended_amount double")
    lines = lines.withColumns({"discount": F.lit(None).cast("double"), "handwritten": F.lit(False)})
    amended = literal(d, [("d1", 1, "quantity", 9.0, 1), ("d1", 1, "quantity", 4.0, 2), ("d2", 2, "extended_amount", 9.0, 1), ("d2", 1, "note", 1.0, 1), ("d2", 1, "quantity", None, 2)], "document_id string, line int, column string, value double, ordinal int")
    out = proof.line_checks(proof.amended_lines(lines, amended))
    return out.select("document_id", "line", "quantity", "unit_price", "extended_amount", "handwritten", "status")

_AGREE = [("invoice_number", "007", "7", False), ("invoice_number", "INV 7", "inv  7", True), ("total_amount", "100.000", "100.004", True), ("total_amount", "100.000", "100.008", False), ("total_amount", "$1,000", "1000.00", True), ("total_amount", "abc", "ABC ", True), ("seller_name", "Northgate & Co", "northgate co", True), ("seller_name", None, None, True), ("seller_name", "x", None, False), ("total_amount", "", None, True)]

@worked("values_agree_edges", ("field VARCHAR, a VARCHAR, b VARCHAR, agree BOOLEAN", _AGREE))
def _(d):
    rows = literal(d, [r[:3] for r in _AGREE], "field string, a string, b string")
    return rows.withColumn("agree", consensus.values_agree(F.col("field"), F.col("a"), F.col("b")))

_JSON = [("a", "/x/0", "1"), ("a", "/x/1/y", "two"), ("a", "/q~1r", None), ("a", "/s~0", "true"), ("b", "", "5"), ("c", None, None)]

@worked("json_leaves_nested", ("doc VARCHAR, pointer VARCHAR, value VARCHAR", _JSON))
def _(d):
    rows = literal(d, [("a", '{"x": [1, {"y": "two"}], "q/r": null, "s~": true}'), ("b", "5"), ("c", "{broken"), ("d", None), ("e", "[]")], "doc string, text string")
    return loading.json_leaves(rows, "doc", "text")


@pytest.mark.parametrize("name", sorted(WORKED.cases))
def test_worked(spark, name):
    WORKED.check(spark, name)
