"""Field validation: what each printed value earns, by the kind of its field, as rows with a reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import MONTHS, NUMBER

# Fields by kind, legal suffixes, month abbreviations, and the forms that a date cell takes.
NON_NEGATIVE = ("quantity", "unit_price", "extended_amount", "subtotal", "tax_amount", "freight_amount", "accessorial_total", "discount_amount", "total_amount", "amount_due", "total_paid", "weight", "piece_count", "volume")
IDENTIFIERS = ("invoice_number", "po_number", "purchase_order_number", "ack_number", "job_number", "pro_number", "bol_number", "awb_number", "memo_number", "cheque_number")
SUPPLIERS = ("brand_name", "manufacturer_name", "supplier_name", "vendor_name")
PERIODS = ("period_start", "period_end")
LEGAL = ("inc", "llc", "ltd", "co", "corp", "company")
SHORT_MONTHS = ("jan", "feb", "mar", "apr", "jun", "jul", "aug", "sept", "sep", "oct", "nov", "dec")
MONTH = "(?:" + "|".join((*MONTHS, *SHORT_MONTHS)) + ")"
NOT_RENDERED = r"^#+$|^[+-]?[0-9]+(?:\.[0-9]+)?[Ee][+-]?[0-9]+$|(?:\.\.\.|…)$"
# slashed dates whose first or second number is over twelve
FIRST_IS_DAY = r"^(?:1[3-9]|[2-9][0-9])[/-][0-9]{1,2}[/-][0-9]{2,4}"
SECOND_IS_DAY = r"^[0-9]{1,2}[/-](?:1[3-9]|[2-9][0-9])[/-][0-9]{2,4}"
# a date's greedy reading is kept, and a time of day may follow it
TIME = r"\s*(?:[,\s]*(?:at\s+)?[0-9]{1,2}:[0-9]{2}(?::[0-9]{2})?\s*(?:[APap]\.?[Mm]\.?)?\s*[A-Za-z]{0,4})?$"
SETTLED = rf"(?i)^(?>[0-9]{{4}}[/-][0-9]{{1,2}}[/-][0-9]{{1,2}}|(?:(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*\.?,?\s+)?(?:[0-9]{{1,2}}[ -]{MONTH}\.?[ -][0-9]{{2,4}}|{MONTH}\.?[ -][0-9]{{1,2}},?[ -][0-9]{{2,4}})){TIME}"
UNSETTLED = rf"^(?>[0-9]{{1,2}}[/-][0-9]{{1,2}}[/-][0-9]{{2,4}}){TIME}"
NO_DAY = rf"(?i)^(?:{MONTH}\.?(?:[ -][0-9]{{2,4}})?|[0-9]{{1,2}}[/-][0-9]{{2,4}}|[0-9]{{4}})$"
STRICT = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"


def _bare(c: Column) -> Column:
    # few values have blanks at an end; the others are not written anew
    return F.when(c.rlike(r"^\s|\s$"), F.regexp_replace(c, r"^\s+|\s+$", "")).otherwise(c)


def party_words(name: Column) -> Column:
    """A party's name without punctuation, case or legal suffixes."""
    words = F.split(F.trim(F.regexp_replace(F.lower(name), "[^a-z0-9 ]+", " ")), " +")
    return F.array_join(F.filter(words, lambda w: ~w.isin(*LEGAL)), " ")


AMBIGUOUS = "invalid_or_ambiguous_iso_date"


def date_issue(value: Column) -> Column:
    """Why a date cell needs a person, else null: unrendered, slashed (unless its document proves the order), without a day, or no date."""
    return _date_issue(_bare(value))


def _date_issue(text: Column) -> Column:
    out = F.when(text.rlike(NOT_RENDERED), "date_not_rendered_in_source").when(text.rlike(SETTLED), None).when(text.rlike(UNSETTLED), AMBIGUOUS)
    return F.when(text != "", out.when(text.rlike(NO_DAY), "date_lacks_a_day").otherwise("date_field_holds_a_non_date"))


def number_issue(value: Column) -> Column:
    """Why a value that cannot be negative needs a person, else null."""
    return _number_issue(_bare(value))


def _number_issue(bare: Column) -> Column:
    text = F.when(bare.rlike("[,$]"), F.regexp_replace(bare, "[,$]", "")).otherwise(bare)
    text = F.when(text.rlike(r"^\(.*\)$"), F.concat(F.lit("-"), F.substr(text, F.lit(2), F.length(text) - 2))).otherwise(text)
    number = F.when(text.rlike(NUMBER), text.try_cast("double"))
    return F.when(bare.isNotNull(), F.when(number.isNull(), "invalid_numeric_value").when(number < 0, "negative_value_requires_review"))


def identifier_issue(value: Column) -> Column:
    """implausible_identifier_format under three characters, without a digit or with a blank inside; else null."""
    return _identifier_issue(_bare(value))


def _identifier_issue(text: Column) -> Column:
    return F.when((F.length(text) < 3) | ~text.rlike("[0-9]") | text.rlike(r"\s"), "implausible_identifier_format")


def field_issues(readings: DataFrame, currencies: tuple[str, ...], own_names: tuple[str, ...] = ()) -> DataFrame:
    """(document_id, field, reason, value) of readings (document_id, path, value, source) that need a person.

    An empty ``source`` is a value without provenance, a null one a bare value that carries none.  Slashed dates
    are settled only by their own document.  The header's dates and currency count where a document has a header,
    else its own; of repeated paths the smallest value counts there.  Null values earn nothing.  Two reasons of one
    value are two rows, and repeated readings repeat.  Readings without a document id are judged value by value alone.
    Clean cells are never shuffled.
    """
    field = F.substring_index("path", ".", -1)
    dated = field.endswith("_date") | field.isin(*PERIODS)
    value = F.col("value")
    known = readings.filter("document_id is not null")
    # no text is cast to a number for it: dates that no order proves would be many failed casts
    first, second = (F.coalesce(_bare(value).rlike(p), F.lit(False)) for p in (FIRST_IS_DAY, SECOND_IS_DAY))
    orders = known.filter(dated & (F.contains(value, F.lit("/")) | F.contains(value, F.lit("-")))).select("document_id", first.alias("day"), second.alias("month")).filter("day or month")
    proved = orders.groupBy("document_id").agg(F.bool_or("day").alias("d"), F.bool_or("month").alias("m")).filter("coalesce(d, false) <> coalesce(m, false)").select(F.col("document_id").alias("_d"))
    pick = lambda name: F.min(F.when(F.col("path") == name, value))
    names = ("due_date", "invoice_date", "delivery_date", "ship_date", "currency")
    # only paths that a document's own findings read, so that lines stay out of this shuffle
    facts = known.filter(F.startswith("path", F.lit("header.")) | F.col("path").isin(*names)).groupBy("document_id").agg(
        F.bool_or(F.startswith("path", F.lit("header."))).alias("headed"), F.bool_or(F.col("path") == "header.currency").alias("priced"),
        *(pick(p + n).alias(p.replace(".", "_") + n) for p in ("header.", "") for n in names),
    )
    own = party_words(value).isin(*{w for n in own_names if (w := " ".join(x for x in "".join(c if c.isascii() and c.isalnum() else " " for c in n.lower()).split() if x not in LEGAL))}) if own_names else F.lit(False)
    # a value's kind and its bare text are made once; exploding every reason and leaving out the null ones judges it once
    kind = F.when(dated, "dated").when(field.isin(*NON_NEGATIVE), "number").when(field.isin(*IDENTIFIERS), "identifier").when(field.isin(*SUPPLIERS), "supplier")
    named, text = lambda k: F.coalesce(F.col("kind") == k, F.lit(False)), F.col("text")
    reasons = F.array(
        F.when(value.isNotNull() & (F.col("source") == ""), "missing_field_provenance"),
        F.when(named("supplier") & own, "engagement_party_named_as_supplier"),
        F.when(named("dated"), _date_issue(text)),
        F.when(named("number"), _number_issue(text)),
        F.when(named("identifier"), _identifier_issue(text)),
    )
    judged = readings.filter(value.isNotNull()).select("document_id", F.col("path").alias("field"), "value", "source", kind.alias("kind"), _bare(value).alias("text"))
    judged = judged.filter(F.col("kind").isNotNull() | (F.col("source") == ""))
    cells = judged.select("document_id", "field", F.explode(reasons).alias("reason"), "value").filter("reason is not null")
    by_cell = cells.join(proved, (F.col("document_id") == F.col("_d")) & (F.col("reason") == AMBIGUOUS), "left_anti")
    of = lambda n: F.when(F.col("headed"), F.col("header_" + n)).otherwise(F.col(n))
    date = lambda n: F.when(of(n).rlike(STRICT), of(n).try_cast("date"))
    currency = F.when(F.col("priced"), F.col("header_currency")).otherwise(F.col("currency"))
    row = lambda name, reason, held: F.struct(F.lit(name).alias("field"), F.lit(reason).alias("reason"), held.alias("value"))
    none = F.lit(None).cast("string")
    found = F.array(
        F.when(~F.upper(currency).isin(*currencies), row("currency", "unsupported_currency", currency)),
        F.when(date("due_date") < date("invoice_date"), row("header.due_date", "due_date_before_invoice_date", none)),
        F.when(date("delivery_date") < date("ship_date"), row("header.delivery_date", "delivery_date_before_ship_date", none)),
    )
    by_document = facts.select("document_id", F.explode(F.array_compact(found)).alias("x")).select("document_id", "x.*")
    return by_cell.unionByName(by_document)


def validation_status(documents: DataFrame, issues: DataFrame) -> DataFrame:
    """``documents`` with field_validation_status (clear, client_review_required) and its findings' count."""
    n = issues.groupBy("document_id").agg(F.count(F.lit(1)).alias("findings"))
    out = documents.join(n, "document_id", "left").withColumn("findings", F.coalesce("findings", F.lit(0)))
    return out.withColumn("field_validation_status", F.when(F.col("findings") == 0, "clear").otherwise("client_review_required"))
