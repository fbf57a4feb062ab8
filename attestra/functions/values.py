"""Scalar readings: money, counts, dates, months, percents, phones and postal keys, as column expressions.

A reading is taken whole or refused; nothing is inferred from a number's size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(38,6)"
# Currency codes, month names, and the forms that readings take.
CURRENCIES = ("USD", "CAD", "EUR", "GBP", "AUD", "CHF", "MXN")
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
UNCLEAR = r"[0-9][\s\u00a0\u202f][0-9]|,[0-9]{1,2}$"
DECIMAL_COMMA = r"^-?(?:[0-9]{1,3}(?:[ \u00a0\u202f.][0-9]{3})+|[0-9]+),[0-9]{2}$"
DECIMAL_POINT = r"^-?(?:[0-9]{1,3}(?:,[0-9]{3})+|[0-9]+)\.[0-9]+$"
NUMBER = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"
COUNT = r"^-?(?:[0-9]{1,3}(?:,[0-9]{3})+|[0-9]+)(?:\.[0-9]+)?$"
WEEKDAY = r"(?i)^(?:mon|tue|tues|wed|thu|thur|thurs|fri|sat|sun)[a-z]*\.?,?\s+"
TIME_OF_DAY = r"(?i),?\s+(?:at\s+)?[0-9]{1,2}:[0-9]{2}(?::[0-9]{2})?\s*(?:[ap]\.?m\.?)?(?:\s+[a-z]{2,4})?$"
ISO = r"^([0-9]{4})-([0-9]{2})-?([0-9]{2})$"
SLASHED = r"^([0-9]{1,2})/([0-9]{1,2})/([0-9]{2,4})$"
NAMED = r"^([A-Za-z]{3,9})\.?\s+([0-9]{1,2})(?:st|nd|rd|th)?,?\s+([0-9]{4})$"
MONTH_LABEL = r"^([A-Za-z]{3,9})\.?[\s,/-]*([0-9]{4})$"
FIRST_YEAR = 1000


def _text(c: Column) -> Column:
    return F.trim(F.coalesce(c.cast("string"), F.lit("")))


def parse_money(c: Column, default: float | None = None) -> Column:
    """Money as text: dollar signs, commas and blanks go, whole parentheses and a closing minus are minus; an unclear separator or anything else is ``default``."""
    text = _text(c)
    unclear = F.trim(F.regexp_replace(text, "[$\u00a3]", "")).rlike(UNCLEAR)
    bare = F.regexp_replace(text, "[,$ ]", "")
    bare = F.when(bare.rlike(r"^\(.*\)$"), F.concat(F.lit("-"), F.substr(bare, F.lit(2), F.length(bare) - 2))).otherwise(bare)
    bare = F.when(bare.rlike("^[0-9.]+-$"), F.concat(F.lit("-"), F.substr(bare, F.lit(1), F.length(bare) - 1))).otherwise(bare)
    out = F.when(~unclear & bare.rlike(NUMBER), bare.try_cast("double").try_cast(MONEY))
    out = F.when(bare.rlike(r"^[+-]?[0-9]+\.?[0-9]*$") & ~unclear, bare.try_cast(MONEY)).otherwise(out)
    return F.coalesce(out, F.lit(default).cast(MONEY)) if default is not None else out


def bare_amount(c: Column) -> tuple[Column, Column, Column]:
    """(text without currency, the first code it names or empty, whether it stood in parentheses)."""
    text = _text(c)
    code = F.coalesce(*(F.when(text.rlike(rf"(?i)\b{k}\b"), k) for k in CURRENCIES), F.lit(""))
    for k in reversed(CURRENCIES):
        text = F.when(code == k, F.trim(F.regexp_replace(_text(c), rf"(?i)\b{k}\b", ""))).otherwise(text)
    text = F.trim(F.regexp_replace(text, "[$\u00a3\u20ac]", ""))
    negative = text.startswith("(") & text.endswith(")")
    return F.when(negative, F.trim(F.substr(text, F.lit(2), F.length(text) - 2))).otherwise(text), code, negative


def loadable_amount(c: Column, convention: Column | None = None) -> tuple[Column, Column]:
    """(plain decimal text or empty, currency code or empty).

    A decimal comma is read only where the document's ``convention`` is decimal_comma, and there
    every other comma is refused; elsewhere a sign of one is refused.
    """
    text, code, negative = bare_amount(c)
    comma = F.coalesce(convention == "decimal_comma", F.lit(False)) if convention is not None else F.lit(False)
    european = comma & text.rlike(DECIMAL_COMMA)
    refused = ~european & (text.rlike(UNCLEAR) | (comma & text.contains(",")))
    plain = F.when(european, F.regexp_replace(F.regexp_replace(text, "[ \u00a0\u202f.]", ""), ",", ".")).otherwise(F.regexp_replace(text, ",", ""))
    signed = F.when(negative & ~plain.startswith("-"), F.concat(F.lit("-"), plain)).otherwise(plain)
    return F.when(~refused & plain.rlike(NUMBER), signed).otherwise(""), code


def separator_convention(amounts: DataFrame, document: str, amount: str) -> DataFrame:
    """(document, convention): decimal_comma where the document's own amounts print decimal commas and never a decimal point."""
    text, _, _ = bare_amount(F.col(amount))
    seen = amounts.groupBy(document).agg(F.bool_or(text.rlike(DECIMAL_COMMA)).alias("c"), F.bool_or(text.rlike(DECIMAL_POINT)).alias("p"))
    return seen.select(document, F.when(F.col("c") & ~F.col("p"), "decimal_comma").otherwise("").alias("convention"))


def loadable_count(c: Column) -> Column:
    """A count as plain digits, or empty."""
    text = _text(c)
    return F.when(text.rlike(COUNT), F.regexp_replace(text, ",", "")).otherwise("")


def date_text(c: Column) -> Column:
    """A date cell without a weekday before it or a time of day after it."""
    return F.trim(F.regexp_replace(F.regexp_replace(_text(c), WEEKDAY, ""), TIME_OF_DAY, ""))


def month_number(name: Column) -> Column:
    """A month's number from its name or the start of it."""
    low = F.lower(name)
    return F.coalesce(*(F.when(F.lit(m).startswith(low), i) for i, m in enumerate(MONTHS, 1)))


def _part(text: Column, form: str, k: int) -> Column:
    return F.nullif(F.regexp_extract(text, form, k), F.lit(""))


def _day(year: Column, month: Column, day: Column) -> Column:
    """A real date of a four-digit year, else null."""
    padded = F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad(month.cast("string"), 2, "0"), F.lpad(day.cast("string"), 2, "0"))
    return F.when(year.isNotNull() & month.isNotNull() & day.isNotNull() & (year >= FIRST_YEAR), padded.try_cast("date"))


def loadable_date(c: Column, order: Column | None = None) -> Column:
    """ISO, ISO with a hyphen lost, a named month, or slashes once their order (month_first, day_first) is settled; else null."""
    text = date_text(c)
    i = [_part(text, ISO, k).try_cast("int") for k in (1, 2, 3)]
    n = [_part(text, NAMED, k) for k in (1, 2, 3)]
    a, b, y = (_part(text, SLASHED, k).try_cast("int") for k in (1, 2, 3))
    y = F.when(y < 100, y + 2000).otherwise(y)
    order = F.lit(None).cast("string") if order is None else order
    month, day = F.when(order == "month_first", a).when(order == "day_first", b), F.when(order == "month_first", b).when(order == "day_first", a)
    named = _day(n[2].try_cast("int"), month_number(n[0]), n[1].try_cast("int"))
    return F.coalesce(_day(*i), named, _day(y, month, day))


def parse_date(c: Column, day_first: Column | None = None) -> Column:
    """A date of any form that states its own order, or slashed once ``day_first`` is known; for reference lists, which print more forms than pages."""
    order = None if day_first is None else F.when(day_first, "day_first").when(~day_first, "month_first")
    text = _text(c)
    more = [F.when(text.rlike(form), F.try_to_date(text, pattern)) for form, pattern in ((r"^[0-9]{8}$", "yyyyMMdd"), (r"^[0-9]{1,2} [A-Za-z]{3} [0-9]{4}$", "d MMM yyyy"))]
    iso = F.when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"), F.substring(text, 1, 10).try_cast("date"))
    d = F.coalesce(loadable_date(c, order), iso, *more)
    return F.when(F.year(d) >= FIRST_YEAR, d)


def slash_order(c: Column) -> Column:
    """What one slashed date proves: true for day first, false for month first, null if it could be either."""
    a, b = (_part(_text(c), SLASHED, k).try_cast("int") for k in (1, 2))
    return F.when((a > 12) & (b <= 12), True).when((b > 12) & (a <= 12), False)


def date_order(dates: DataFrame, document: str, date: str) -> DataFrame:
    """(document, date_order): what the document's own slashed dates prove; both orders, or none, settle nothing."""
    text = date_text(F.col(date))
    a, b = (_part(text, SLASHED, k).try_cast("int") for k in (1, 2))
    seen = dates.groupBy(document).agg(F.bool_or(a > 12).alias("d"), F.bool_or(b > 12).alias("m"))
    d, m = F.coalesce("d", F.lit(False)), F.coalesce("m", F.lit(False))
    return seen.select(document, F.when(d & m, None).when(m, "month_first").when(d, "day_first").alias("date_order"))


def loadable_month(c: Column) -> Column:
    """The month of a cell that names a month and a four-digit year and no day, as YYYY-MM, or empty."""
    text = date_text(c)
    month, year = month_number(_part(text, MONTH_LABEL, 1)), _part(text, MONTH_LABEL, 2).try_cast("int")
    return F.when(month.isNotNull() & (year >= FIRST_YEAR), F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad(month.cast("string"), 2, "0"))).otherwise("")


def loadable_percent(c: Column, proven: Column) -> Column:
    """The percent a rate cell states where its unit is certain: printed, or proven by its line; else empty."""
    text = F.regexp_replace(_text(c), "\u2212", "-")
    number = F.when(text.endswith("%"), F.trim(F.substr(text, F.lit(1), F.length(text) - 1))).otherwise(text)
    return F.when(number.rlike(r"^-?[0-9]+(?:\.[0-9]+)?$") & (text.endswith("%") | F.coalesce(proven, F.lit(False))), number).otherwise("")


def parse_percent(c: Column) -> tuple[Column, Column]:
    """(fraction, ambiguous): over 1 or with a sign it is a percent, 0 is 0, between it could be either."""
    text = _text(c)
    signed = text.endswith("%")
    number = parse_money(F.when(signed, F.substr(text, F.lit(1), F.length(text) - 1)).otherwise(text))
    return F.when(signed | (number > 1), number / 100).when(number == 0, number), F.coalesce(~signed & (number > 0) & (number <= 1), F.lit(False))


def phone_e164(c: Column) -> Column:
    """A ten-digit North American number, with or without the leading 1, as +1NXXNXXXXXX; else null."""
    digits = F.regexp_replace(F.regexp_replace(c, r"(?i)(ext|x).*$", ""), r"\D", "")
    ten = F.regexp_extract(digits, r"^1?([2-9]\d{2}[2-9]\d{6})$", 1)
    return F.when(ten != "", F.concat(F.lit("+1"), ten))


def postal_key(c: Column) -> Column:
    """Five digits of a US ZIP or the first three of a Canadian code."""
    zip5, fsa = F.regexp_extract(c, r"\b(\d{5})(?:-\d{4})?\b", 1), F.regexp_extract(F.upper(c), r"\b([A-Z]\d[A-Z]) ?\d[A-Z]\d\b", 1)
    return F.coalesce(F.nullif(fsa, F.lit("")), F.nullif(zip5, F.lit("")))


def key_shape(c: Column) -> Column:
    """Digits as #."""
    return F.regexp_replace(c, r"\d", "#")
