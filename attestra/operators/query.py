"""The one-table query dialect of the record service: filter, sort, page, project, look up, export."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPERATORS = ("eq", "ne", "contains", "starts_with", "in", "gte", "lte", "is_null")
MAX_FIELDS, MAX_FILTERS, MAX_SORT, MAX_PAGE, MAX_IN = 50, 10, 3, 200, 100
NUMBER = "decimal(38,9)"


def as_text(c: Column) -> Column:
    return c.cast("string")


def order_parts(c: Column) -> tuple[Column, Column, Column]:
    """(kind, number, folded text): numbers come before text, null counts as empty text."""
    number = as_text(c).try_cast(NUMBER)
    return F.when(number.isNull(), 1).otherwise(0), number, F.when(number.isNull(), F.lower(F.coalesce(as_text(c), F.lit(""))))


def condition(c: Column, spec: object) -> Column:
    """A service predicate; ``ne`` is the exact negation of ``eq``, so nulls pass it."""
    op, want = (spec["operator"], spec.get("value")) if isinstance(spec, dict) else ("eq", spec)
    if op not in OPERATORS:
        raise ValueError(f"unsupported filter operator {op}")
    text = as_text(c)
    if op == "is_null":
        if not isinstance(want, bool):
            raise ValueError("is_null takes true or false")
        return (text.isNull() | (text == "")) == F.lit(want)
    if op == "in":
        if not isinstance(want, list) or len(want) > MAX_IN:
            raise ValueError("in takes a list of at most 100 values")
        return reduce(lambda a, b: a | b, (condition(c, w) for w in want), F.lit(False))
    if isinstance(want, (list, dict)):
        raise ValueError("filter value must be scalar")
    if op in ("contains", "starts_with"):
        test = F.contains if op == "contains" else F.startswith
        return test(F.lower(F.coalesce(text, F.lit(""))), F.lit(str(want).lower()))
    same = text.eqNullSafe(F.lit(None if want is None else str(want)))
    if op in ("eq", "ne"):
        return same if op == "eq" else ~same
    kind, number, folded = order_parts(c)
    k, n, t = order_parts(F.lit(None if want is None else str(want)))
    ahead = (number >= n, folded >= t) if op == "gte" else (number <= n, folded <= t)
    return (kind == k) & F.when(kind == 0, ahead[0]).otherwise(ahead[1])


def filtered(table: DataFrame, filters: dict[str, object]) -> DataFrame:
    if len(filters) > MAX_FILTERS:
        raise ValueError("too many filters")
    if set(filters) - set(table.columns):
        raise ValueError(f"unknown columns {sorted(set(filters) - set(table.columns))}")
    return reduce(lambda t, f: t.filter(condition(F.col(f[0]), f[1])), filters.items(), table)


def sort_columns(keys: list[str], ordinal: str) -> list[Column]:
    """Kind, number, text of each key; the ordinal breaks ties upwards in both directions."""
    if len(keys) > MAX_SORT:
        raise ValueError("at most 3 sort keys")
    out = []
    for key in keys:
        parts = order_parts(F.col(key.lstrip("-")))
        out += [p.desc_nulls_last() if key.startswith("-") else p.asc_nulls_first() for p in parts]
    return [*out, F.col(ordinal).asc()]


def page(table: DataFrame, key: list[str], ordinal: str, filters: dict | None = None, sort: list[str] | None = None, fields: list[str] | None = None, limit: int = MAX_PAGE, offset: int = 0) -> tuple[DataFrame, DataFrame]:
    """(page rows, a frame with total and next_offset)."""
    if not 1 <= limit <= MAX_PAGE or offset < 0:
        raise ValueError("limit must be 1 to 200 and offset not negative")
    rows = filtered(table, filters or {})
    names = list(dict.fromkeys([*key, *(fields if fields is not None else table.columns)]))
    if fields is not None and (len(fields) > MAX_FIELDS or set(fields) - set(table.columns)):
        raise ValueError("unknown or too many fields")
    ordered = rows.orderBy(*sort_columns(sort or [], ordinal)).offset(offset).limit(limit).select(*names)
    total = rows.agg(F.count(F.lit(1)).alias("total"))
    return ordered, total.withColumn("next_offset", F.when(F.col("total") > offset + limit, F.lit(offset + limit)))


def lookup(table: DataFrame, key: dict[str, object]) -> DataFrame:
    """The row of one key: an equality filter that reaches the scan."""
    return reduce(lambda t, kv: t.filter(F.col(kv[0]) == F.lit(kv[1])), key.items(), table)


def neutral_text(c: Column) -> Column:
    """A cell that a spreadsheet would run as a formula gets a quote in front."""
    return F.when(as_text(c).rlike(r"^[=+\-@\t\r]"), F.concat(F.lit("'"), as_text(c))).otherwise(as_text(c))


def export_csv(table: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """Write stable columns with formula prefixes neutralised; an existing path is refused."""
    names = columns or table.columns
    table.select(*(neutral_text(F.col(c)).alias(c) if t == "string" else F.col(c) for c, t in table.select(*names).dtypes)).write.mode("errorifexists").option("header", True).csv(path)
