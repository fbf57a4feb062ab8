"""The governed semantic layer: a closed plan, checked on the driver, compiled to one lazy DataFrame.

A model names datasets (a base table, many-to-one joins, typed dimensions, metrics); a plan
picks from it.  Scan, join, filter, group, having, sort and page are DataFrame steps in
that order, so Catalyst prunes and pushes down through all of them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AGGREGATES = ("sum", "count", "count_distinct", "average", "minimum", "maximum")
GRAINS = ("day", "month", "quarter", "year", "fiscal_quarter", "fiscal_year")
TYPES = ("string", "number", "date")
OPERATORS = ("eq", "ne", "in", "not_in", "contains", "starts_with", "ends_with", "gt", "gte", "lt", "lte", "between", "is_null", "not_null")
NUMBER = "decimal(38,6)"
#: Bounds of a plan.
LIMITS = {"dimensions": 8, "metrics": 12, "joins": 12, "sort": 5, "in": 100}
PLAN_KEYS = {"dataset", "dimensions", "metrics", "filters", "having", "date_grains", "sort", "limit", "offset", "include_totals"}


@dataclass(frozen=True)
class Join:
    table: str
    local: str
    foreign: str
    fields: dict[str, str]  # alias -> foreign field


@dataclass(frozen=True)
class Metric:
    field: str | None
    aggregate: str
    currency: str | None = None


@dataclass(frozen=True)
class Dataset:
    base: str
    dimensions: dict[str, tuple[str, str]]  # name -> (field, type)
    metrics: dict[str, Metric]
    joins: tuple[Join, ...] = ()
    fiscal_start: int = 1


@dataclass
class Answer:
    """Rows, totals by currency, groups whose metric was refused, and a coverage frame; all lazy."""

    rows: DataFrame
    totals: DataFrame | None
    exceptions: DataFrame
    coverage: DataFrame
    unpaged: DataFrame = field(repr=False, default=None)


class PlanError(ValueError):
    """A plan or model outside the closed grammar."""


def check_dataset(d: Dataset, tables: dict[str, DataFrame]) -> None:
    if d.base not in tables:
        raise PlanError(f"unknown base table {d.base}")
    if len(d.joins) > LIMITS["joins"]:
        raise PlanError("too many joins")
    have = set(tables[d.base].columns)
    base = set(have)
    for j in d.joins:
        if j.table not in tables or j.foreign not in tables[j.table].columns or set(j.fields.values()) - set(tables[j.table].columns):
            raise PlanError(f"join to {j.table} names unknown columns")
        if j.local not in base:
            raise PlanError("join keys must be base columns")
        if have & set(j.fields):
            raise PlanError("join alias hides a column")
        have |= set(j.fields)
    for name, (col, kind) in d.dimensions.items():
        if col not in have or kind not in TYPES:
            raise PlanError(f"dimension {name} is not defined over the dataset")
    for name, m in d.metrics.items():
        if m.aggregate not in AGGREGATES or (m.aggregate != "count" and m.field not in have) or (m.currency and m.currency not in d.dimensions):
            raise PlanError(f"metric {name} is not defined over the dataset")


def check_plan(d: Dataset, plan: dict) -> None:
    if set(plan) - PLAN_KEYS:
        raise PlanError(f"unknown plan keys {sorted(set(plan) - PLAN_KEYS)}")
    dims, metrics = plan.get("dimensions", []), plan.get("metrics", [])
    if len(dims) > LIMITS["dimensions"] or not metrics or len(metrics) > LIMITS["metrics"]:
        raise PlanError("a plan has up to 8 dimensions and 1 to 12 metrics")
    if set(dims) - set(d.dimensions) or set(metrics) - set(d.metrics) or len(set(dims)) < len(dims) or len(set(metrics)) < len(metrics):
        raise PlanError("dimensions and metrics must be distinct names of the dataset")
    for name, c in plan.get("filters", {}).items():
        if name not in d.dimensions:
            raise PlanError(f"filter on unknown dimension {name}")
        _check_condition(c)
    for name, c in plan.get("having", {}).items():
        if name not in metrics:
            raise PlanError("having names a metric of the plan")
        _check_condition(c)
    for name, grain in plan.get("date_grains", {}).items():
        if name not in dims or grain not in GRAINS or d.dimensions[name][1] != "date":
            raise PlanError("date grains apply to chosen date dimensions")
    sort = plan.get("sort", [])
    if len(sort) > LIMITS["sort"] or {s.lstrip("-") for s in sort} - set(dims) - set(metrics):
        raise PlanError("sort names up to 5 chosen dimensions or metrics")
    if plan.get("limit", 1) < 1 or plan.get("offset", 0) < 0:
        raise PlanError("limit and offset must not be negative")


def _check_condition(c: object) -> None:
    if isinstance(c, dict):
        if set(c) != {"operator", "value"} or c["operator"] not in OPERATORS:
            raise PlanError("a condition has an operator and a value")
        if c["operator"] in ("in", "not_in") and (not isinstance(c["value"], list) or len(c["value"]) > LIMITS["in"]):
            raise PlanError("in takes a list of at most 100 values")
        if c["operator"] == "between" and (not isinstance(c["value"], list) or len(c["value"]) != 2):
            raise PlanError("between takes two values")


def typed(c: Column, kind: str) -> Column:
    """The column in its dimension's type; what does not convert is null."""
    if kind == "number":
        return c.cast("string").try_cast(NUMBER)
    return c.cast("string").try_cast("date") if kind == "date" else c.cast("string")


def condition(c: Column, spec: object, kind: str = "string") -> Column:
    """The semantic dialect: a null passes only ``eq null`` and ``is_null true``; text tests ignore case."""
    op, want = (spec["operator"], spec["value"]) if isinstance(spec, dict) else ("eq", spec)
    x = typed(c, kind)
    lit: Callable[[object], Column] = lambda v: typed(F.lit(None if v is None else str(v)), kind)
    if op in ("is_null", "not_null"):
        return (x.isNull() if op == "is_null" else x.isNotNull()) if want is True else F.lit(False)
    if op == "eq" and want is None:
        return x.isNull()
    if op in ("contains", "starts_with", "ends_with"):
        if kind != "string":
            raise PlanError(f"{op} needs a string dimension")
        test = {"contains": F.contains, "starts_with": F.startswith, "ends_with": F.endswith}[op]
        out = test(F.lower(x), F.lit(str(want).lower()))
    elif op in ("in", "not_in"):
        out = x.isin(*[lit(v) for v in want]) if want else F.lit(False)
        out = out if op == "in" else ~out
    elif op == "between":
        out = (x >= lit(want[0])) & (x <= lit(want[1]))
    else:
        y = lit(want)
        out = {"eq": x == y, "ne": x != y if want is not None else F.lit(True), "gt": x > y, "gte": x >= y, "lt": x < y, "lte": x <= y}[op]
    return x.isNotNull() & F.coalesce(out, F.lit(False))


def bucket(c: Column, grain: str, fiscal_start: int = 1) -> Column:
    """A date's period as text; null and empty values stay as they are."""
    d = c.cast("string").try_cast("date")
    y, m = F.year(d), F.month(d)
    fiscal = F.when(m >= fiscal_start, y + 1).otherwise(y) if fiscal_start != 1 else y
    text = {
        "day": lambda: F.date_format(d, "yyyy-MM-dd"),
        "month": lambda: F.date_format(d, "yyyy-MM"),
        "quarter": lambda: F.format_string("%04d-Q%d", y, F.quarter(d)),
        "year": lambda: y.cast("string"),
        "fiscal_year": lambda: F.format_string("FY%04d", fiscal),
        "fiscal_quarter": lambda: F.format_string("FY%04d-Q%d", fiscal, (F.floor(F.pmod(m - fiscal_start, F.lit(12)) / 3) + 1).cast("int")),
    }[grain]()
    return F.when(c.isNull() | (c.cast("string") == ""), c.cast("string")).otherwise(text)


def metric(m: Metric) -> Column:
    """A metric over a group; one value that is no number makes sum, average, minimum and maximum null."""
    if m.aggregate == "count":
        return F.count(F.lit(1)).cast("decimal(38,6)")
    text = F.col(m.field).cast("string")
    if m.aggregate == "count_distinct":
        return F.countDistinct(F.when(text != "", text)).cast("decimal(38,6)")
    number = text.try_cast(NUMBER)
    whole = F.count(number) == F.count(F.lit(1))
    f = {"sum": F.sum, "average": F.avg, "minimum": F.min, "maximum": F.max}[m.aggregate](number)
    return F.when(whole & (F.count(F.lit(1)) > 0), f).cast("decimal(38,6)")


def joined(d: Dataset, tables: dict[str, DataFrame], check_fan_out: bool = True) -> DataFrame:
    """The base table with its joined fields; null keys meet null keys.  A foreign key that occurs twice is refused."""
    rows = tables[d.base]
    for j in d.joins:
        other = tables[j.table]
        key = other[j.foreign].cast("string").alias("_key")
        if check_fan_out and other.groupBy(key).count().filter("count > 1").limit(1).count():
            raise PlanError("the join is not many-to-one; fan-out is refused")
        side = other.select(key, *(other[f].alias(a) for a, f in j.fields.items()))
        rows = rows.join(side, rows[j.local].cast("string").eqNullSafe(side["_key"]), "left").drop("_key")
    return rows


def compile_plan(d: Dataset, tables: dict[str, DataFrame], plan: dict, check_fan_out: bool = True) -> Answer:
    """A checked plan as lazy frames."""
    check_dataset(d, tables)
    check_plan(d, plan)
    chosen = list(plan.get("dimensions", []))
    metrics = plan["metrics"]
    money = sorted({d.metrics[m].currency for m in metrics if d.metrics[m].currency})
    dims = chosen + [c for c in money if c not in chosen]
    grains = plan.get("date_grains", {})
    rows = joined(d, tables, check_fan_out)
    kept = rows
    for name, spec in plan.get("filters", {}).items():
        col, kind = d.dimensions[name]
        kept = kept.filter(condition(F.col(col), spec, kind))
    shape = {n: bucket(F.col(d.dimensions[n][0]), grains[n], d.fiscal_start) if n in grains else F.col(d.dimensions[n][0]) for n in dims}
    need = sorted({d.metrics[m].field for m in metrics if d.metrics[m].field})
    base = kept.select(*(c.alias(f"_d_{n}") for n, c in shape.items()), *need)
    grouped = base.groupBy(*(f"_d_{n}" for n in dims)).agg(*(metric(d.metrics[m]).alias(m) for m in metrics))
    grouped = grouped.withColumnsRenamed({f"_d_{n}": n for n in dims})
    if not dims:
        grouped = grouped.filter(F.lit(True))
    having = grouped
    for name, spec in plan.get("having", {}).items():
        having = having.filter(condition(F.col(name), spec, "number"))
    totals = None
    if plan.get("include_totals"):
        totals = base.groupBy(*(f"_d_{c}" for c in money)).agg(*(metric(d.metrics[m]).alias(m) for m in metrics)).withColumnsRenamed({f"_d_{c}": c for c in money})
    refused = [m for m in metrics if d.metrics[m].aggregate not in ("count", "count_distinct")]
    cases = F.array(*(F.when(F.col(m).isNull(), F.lit(m)) for m in refused)) if refused else F.array().cast("array<string>")
    exceptions = grouped.select(*dims, F.explode(F.filter(cases, lambda x: x.isNotNull())).alias("metric"), F.lit("value_is_not_a_number").alias("reason"))
    coverage = rows.agg(F.count(F.lit(1)).alias("input_rows")).crossJoin(base.agg(F.count(F.lit(1)).alias("selected_rows"))).crossJoin(grouped.agg(F.count(F.lit(1)).alias("groups"))).crossJoin(having.agg(F.count(F.lit(1)).alias("groups_after_having")))
    order: list[Column] = []
    for s in plan.get("sort", []):
        name = s.lstrip("-")
        c = F.col(name) if name in metrics else F.col(name).cast("string")
        order.append(c.desc_nulls_first() if s.startswith("-") else c.asc_nulls_last())
    order += [F.col(n).cast("string").asc_nulls_last() for n in dims if n not in {s.lstrip("-") for s in plan.get("sort", [])}]
    page = having.orderBy(*order) if order else having
    if plan.get("offset"):
        page = page.offset(plan["offset"])
    if plan.get("limit"):
        page = page.limit(plan["limit"])
    return Answer(page, totals, exceptions, coverage, having)
