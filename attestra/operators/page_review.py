"""Page review: an export held against what reviewers read on its pages, and the amendments that follow.

Amounts travel as long tables, one row a cell, so every comparison of multisets is one
aggregation by page and amount.  Nothing here changes an export by itself: proposals carry
their evidence, and :func:`plan_amendments` says of each why it may not be applied.

Tables: reviews (page, document_kind, money_column, page_rows, money_cells_checked,
money_cells_wrong, page_money array<string>, page_total); cells (page, line, column, amount,
excluded), the export's lines, amount null where a cell holds no money; header (page, column,
amount); findings (page, ordinal, line, column, export, said), what a reviewer says of one
cell; printed (page, amount, n), the numbers that an independent extractor saw, with one row of
null amount for a page on which it saw none; readings (page, line, column, amount), what the
retained readers read; facts, the figures that stand on a page in one long table, marked by who holds them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.values import MONEY, loadable_amount
from ..scratch import Scratch

# What a review must state, names of money columns, and how reviewers say that a row is not there.
REQUIRED = ("page", "document_kind", "page_rows", "money_cells_checked", "money_cells_wrong", "page_money", "money_column")
HEADER_MONEY = r"amount|total|paid|commission"
TYPED = r"__(?:amount|iso|currency)$"
MONEY_COLUMNS = (
    "commission_amount", "commissionable_amount", "sales_amount", "invoice_amount", "extended_amount", "total_amount",
    "applied_amount", "deposit_amount", "amount_due", "total_paid", "unit_price",
)
NOT_PRINTED = (
    r"(?i)not printed|not on the page|never prints|does not print|doesn't print|no such row|second pass|spurious|duplicat|repeat|re-walk"
    r"|subtotal|not a (?:data )?row|heading row|page never"
)
LEADING_MONEY = r"^\s*(\(?-?\$?(?:\d{1,3}(?:,\d{3})+(?:\.\d{2})?|\d+\.\d{2})\)?)(?=\s|$)"
INDEPENDENT = ("extractor_text_and_engine", "extractor_text", "engine", "second_vendor")
ARITHMETIC = ("commissionable_amount", "stated_commission_rate", "commission_amount")


def printed_money(c: Column) -> Column:
    """Money as a page prints it: a currency code at either end, dollar signs and commas go, parentheses are minus; else null."""
    said = F.trim(F.coalesce(c.cast("string"), F.lit("")))
    text = F.regexp_replace(said, r"^[A-Z]{3}\s+|\s+[A-Z]{3}$", "")
    text = F.regexp_replace(text, "[,$]", "")
    bare = F.trim(F.regexp_replace(text, r"^\(+|\)+$", ""))
    value = F.when(bare.rlike(r"^[+-]?(?:\d+\.?\d*|\.\d+)$"), bare.try_cast(MONEY))
    # most figures are bare digits, which need no more
    return F.when(said.rlike(r"^\d+(?:\.\d+)?$"), said.try_cast(MONEY)).otherwise(value * F.when(text.rlike(r"^\(.*\)$"), -1).otherwise(1)).cast(MONEY)


def stated_money(c: Column) -> Column:
    """A reviewer's figure, a note after it set aside."""
    # over an array the reading is compiled once and apart; in line it makes its stage's method too long to be compiled
    return F.get(F.array_compact(F.transform(F.array(c, F.regexp_extract(c, LEADING_MONEY, 1)), printed_money)), F.lit(0))


def review_errors(reviews: DataFrame) -> DataFrame:
    """(page, missing) of the reviews that lack a required value; an empty money column is not a lack."""
    missing = F.filter(F.array(*(F.when(F.col(k).isNull(), k) for k in sorted(REQUIRED))), lambda x: x.isNotNull())
    return reviews.withColumn("missing", missing).filter(F.size("missing") > 0).select("page", "missing")


def _sound(reviews: DataFrame) -> DataFrame:
    ok = F.lit(True)
    for k in REQUIRED:
        ok = ok & F.col(k).isNotNull()
    return reviews.filter(ok)


def _counted(df: DataFrame, name: str) -> DataFrame:
    return df.groupBy("page", "amount").agg(F.count(F.lit(1)).alias("n")).select("page", "amount", F.lit(name).alias("side"), "n")


def page_balance(reviews: DataFrame, cells: DataFrame, header: DataFrame) -> DataFrame:
    """(page, kind, amount, n): money that a page prints and the export lost, and money that the export invented.

    Lost is judged against all lines, the flagged ones too; invented against the countable
    ones.  A page without line money is judged by its header: by the money column where
    the header has it, else by every column named as money, each figure once; there a printed page
    total may stand too.  Reviews with a missing value are left out.
    """
    r = _sound(reviews).select("page", "money_column", "page_money", printed_money(F.col("page_total")).alias("page_total"))
    shown = r.select("page", F.explode("page_money").alias("m")).select("page", printed_money(F.col("m")).alias("amount")).filter("amount is not null")
    ask = r.filter("money_column <> ''").select("page", F.col("money_column").alias("column"))
    lines = cells.filter("amount is not null").join(ask, ["page", "column"])
    by_page = lines.groupBy("page").agg(F.count(F.lit(1)).alias("any"), F.sum((~F.col("excluded")).cast("long")).alias("live"))
    head = header.join(ask.withColumnRenamed("column", "asked"), "page")
    named = head.filter(~F.col("column").rlike(TYPED) & F.col("column").rlike(HEADER_MONEY))
    own = head.filter(F.col("column") == F.col("asked"))
    has = own.select("page").distinct()
    asked = own.unionByName(named.join(has, "page", "left_anti"))
    figures = lambda x: x.filter("amount is not null").select("page", "amount").distinct()
    without = lambda x, what: x.join(by_page.filter(f"{what} > 0").select("page"), "page", "left_anti")
    total = without(r.filter("page_total is not null").select("page", F.col("page_total").alias("amount")), "live")
    sides = [
        (shown, "printed"), (lines.select("page", "amount"), "retained"), (without(figures(named), "any"), "retained"),
        (lines.filter("not excluded").select("page", "amount"), "countable"), (without(figures(asked), "live"), "countable"), (total, "total"),
    ]
    every = _counted(*sides[0])
    for s in sides[1:]:
        every = every.unionByName(_counted(*s))
    n = {k: F.coalesce(F.sum(F.when(F.col("side") == k, F.col("n"))), F.lit(0)).alias(k) for k in ("printed", "retained", "countable", "total")}
    g = every.groupBy("page", "amount").agg(*n.values())
    kinds = F.array(F.struct(F.lit("lost").alias("kind"), (F.col("printed") - F.col("retained")).alias("n")), F.struct(F.lit("invented").alias("kind"), (F.col("countable") - F.col("printed") - F.col("total")).alias("n")))
    return g.select("page", "amount", F.explode(kinds).alias("x")).select("page", "x.kind", "amount", "x.n").filter("n > 0")


def review_summary(reviews: DataFrame, balance: DataFrame) -> DataFrame:
    """One row a document kind: pages, how many reconcile, disagree or lack a value, and the cells that reviewers counted."""
    off = balance.select("page").distinct().withColumn("off", F.lit(True))
    bad = review_errors(reviews).select("page").distinct().withColumn("bad", F.lit(True))
    r = reviews.join(off, "page", "left").join(bad, "page", "left")
    is_bad, is_off = (F.coalesce(c, F.lit(False)) for c in ("bad", "off"))
    count = lambda c: F.sum(c.cast("long"))
    return r.groupBy(F.coalesce("document_kind", F.lit("?")).alias("document_kind")).agg(
        F.count(F.lit(1)).alias("pages"), count(~is_bad & ~is_off).alias("reconciling"), count(~is_bad & is_off).alias("disagreeing"), count(is_bad).alias("schema_errors"),
        F.coalesce(F.sum("money_cells_checked"), F.lit(0)).alias("cells_checked"), F.coalesce(F.sum("money_cells_wrong"), F.lit(0)).alias("cells_wrong"),
    )


def _seen(rows: DataFrame, printed: DataFrame, amount: str) -> DataFrame:
    """rows with ``read``, whether the extractor read the page, and ``seen``, how often it saw the amount."""
    pages = printed.select("page").distinct().withColumn("read", F.lit(True))
    counts = printed.filter("amount is not null").groupBy("page", "amount").agg(F.max("n").alias("seen")).withColumnRenamed("amount", amount)
    out = rows.join(pages, "page", "left").join(counts, ["page", amount], "left")
    return out.withColumns({"read": F.coalesce("read", F.lit(False)), "seen": F.coalesce("seen", F.lit(0))})


#: Columns of a fact, a figure that stands on a page, and the marks of those who hold it: a countable cell, the extractor, a retained reader, a second vendor's reading.
FACT = {"line": "string", "column": "string", "amount": MONEY}
MARKS = ("cell", "printed", "reading", "second")


def fact(line: Column, column: Column, amount: Column, **marks: Column) -> Column:
    """One fact as a struct; a mark that is not given is false."""
    cells = [c.cast(t).alias(n) for (n, t), c in zip(FACT.items(), (line, column, amount))]
    return F.struct(*cells, *(F.coalesce(marks.get(m, F.lit(False)), F.lit(False)).alias(m) for m in MARKS))


def facts_of(rows: DataFrame, *made: Column) -> DataFrame:
    """(page, line, column, amount, marks) of the facts made from each row; a null makes none."""
    return rows.select("page", F.explode(F.array(*made)).alias("x")).filter("x is not null").select("page", "x.*")


def facts(cells: DataFrame, printed: DataFrame, readings: DataFrame, second: DataFrame | None = None) -> DataFrame:
    """The facts of separate tables; where these come from the same rows, :func:`facts_of` makes them in one pass."""
    out = facts_of(cells.filter("not excluded"), fact(F.col("line"), F.col("column"), F.col("amount"), cell=F.lit(True)))
    out = out.unionByName(facts_of(printed, fact(F.lit(None), F.lit(None), F.col("amount"), printed=F.col("n") > 0)))
    for mark, t in (("reading", readings), ("second", second)):
        if t is not None:
            out = out.unionByName(facts_of(t, fact(F.col("line"), F.col("column"), F.col("amount"), **{mark: F.lit(True)})))
    return out


def corrections(reviews: DataFrame, findings: DataFrame, facts: DataFrame, vendors: tuple[str, str] | None = None) -> DataFrame:
    """The figures that reviewers read in money cells: page, ordinal, line, column, export_value, page_value, difference, evidence, retained_readings, moves_from_lines.

    The evidence says whether the extractor saw the figure on the page and whether a retained
    reader read the cell so.  ``moves_from_lines`` are the other countable lines that hold the figure
    in that column: a shifted row takes both halves.  A finding that names no money column,
    no figure, or neither a line nor the header proposes nothing.

    With ``vendors``, of the second reading and of the reviews, a correction that the reviewer alone supports
    becomes second_vendor where the second reading holds the figure in its header cell, or in the column of
    its lines more often than the export's other lines do.  Tables dealt by page are not shuffled again.
    """
    if vendors is not None:
        check_second_reader(*vendors)
    said, head = F.col("said"), F.col("line") == "header"
    f = findings.filter(~F.coalesce(said, F.lit("")).rlike(NOT_PRINTED) & F.col("column").isin(*MONEY_COLUMNS))
    # what proposes nothing has no figure, and falls out with the figures that nothing seeks; a filter would read it twice and be moved before the deal
    figure = F.when(F.col("line").rlike("^(?:[0-9]+|header)$"), stated_money(said))
    f = f.select("page", "line", "column", figure.alias("amount"), F.struct("ordinal", F.coalesce("export", F.lit("")).alias("export_value")).alias("finding"))
    finding = F.col("finding").isNotNull()
    x = f.unionByName(facts, allowMissingColumns=True)
    of_figure, of_cell = Window.partitionBy("page", "amount"), Window.partitionBy("page", "line", "column")
    kept = F.col("sought") & (finding | F.col("cell") | F.col("second"))
    x = x.withColumns({"seen": F.coalesce(F.bool_or("printed").over(of_figure), F.lit(False)), "sought": F.bool_or(finding & F.col("amount").isNotNull()).over(of_figure)}).filter(kept | F.col("reading"))
    x = x.withColumn("retained_readings", F.collect_list(F.when(F.col("reading"), F.col("amount"))).over(of_cell)).filter(kept)
    # findings and the lines that hold their figure meet as two lists, so that no other row carries the lines
    g = x.groupBy("page", "column", F.col("amount").alias("page_value")).agg(
        F.collect_list(F.when(finding, F.struct("finding.*", "line", "seen", "retained_readings"))).alias("found"),
        F.collect_set(F.when(F.col("cell"), F.struct(F.col("line").try_cast("long").alias("i"), "line"))).alias("lines"),
        F.count(F.when(F.col("second") & ~head, 1)).alias("holds_it"), F.coalesce(F.bool_or(F.col("second") & head), F.lit(False)).alias("in_header"),
    )
    f = g.select("page", "column", "page_value", F.sort_array("lines").alias("lines"), "holds_it", "in_header", F.explode("found").alias("f")).select("*", "f.*").drop("f")
    f = f.join(_sound(reviews).select("page"), "page", "left_semi").withColumn("retained_readings", F.sort_array("retained_readings"))
    others = F.filter("lines", lambda x: x["line"] != F.col("line"))
    moves = F.when((F.col("page_value") != 0) & ~head, F.transform(others, lambda x: x["line"])).otherwise(F.array().cast("array<string>"))
    engine, text = F.array_contains("retained_readings", F.col("page_value")), F.col("seen")
    agrees = F.when(head, F.col("in_header")).otherwise(F.col("holds_it") > F.size(others)) if vendors is not None else F.lit(False)
    evidence = F.when(engine & text, "extractor_text_and_engine").when(text, "extractor_text").when(engine, "engine").when(agrees, "second_vendor").otherwise("reviewer_only")
    difference = F.abs(F.col("page_value") - F.coalesce(printed_money(F.col("export_value")), F.lit(0).cast(MONEY))).cast(MONEY)
    return f.select("page", "ordinal", "line", "column", "export_value", "page_value", difference.alias("difference"), evidence.alias("evidence"), "retained_readings", moves.alias("moves_from_lines"))


def rows_not_printed(reviews: DataFrame, findings: DataFrame, cells: DataFrame, printed: DataFrame) -> DataFrame:
    """Rows that reviewers say the page never prints: page, ordinal, line, column, value, countable, evidence.

    The extractor bears it out where it saw the figure fewer times than the export counts
    it.  A row that is missing or already excluded, and a page without a money column, propose nothing.
    """
    r = _sound(reviews).filter("money_column <> ''").select("page", F.col("money_column").alias("column"))
    f = findings.filter(F.coalesce("said", F.lit("")).rlike(NOT_PRINTED)).select("page", "ordinal", "line").join(r, "page")
    rows = cells.groupBy("page", "line").agg(F.bool_or("excluded").alias("excluded")).filter("not excluded").select("page", "line")
    value = cells.filter("amount is not null").groupBy("page", "line", "column").agg(F.max("amount").alias("value"))
    count = cells.filter("amount is not null and not excluded").groupBy("page", "column", F.col("amount").alias("value")).agg(F.count(F.lit(1)).alias("countable"))
    f = f.join(rows, ["page", "line"]).join(value, ["page", "line", "column"], "left").join(count, ["page", "column", "value"], "left")
    f = _seen(f, printed, "value")
    evidence = F.when(F.col("value").isNull(), "no_money_on_row").when(~F.col("read"), "no_extractor_response").when(F.col("seen") < F.col("countable"), "extractor_prints_it_fewer_times").otherwise("extractor_prints_it_as_often")
    return f.select("page", "ordinal", "line", "column", "value", F.coalesce("countable", F.lit(0)).alias("countable"), evidence.alias("evidence"))


def lost_values(balance: DataFrame, printed: DataFrame) -> DataFrame:
    """Lost money, (page, amount, n), and whether the extractor saw it."""
    x = _seen(balance.filter("kind = 'lost'").select("page", "amount", "n"), printed, "amount")
    return x.select("page", "amount", "n", F.when(~F.col("read"), "no_extractor_response").when(F.col("seen") > 0, "extractor_saw_it").otherwise("extractor_missed_it").alias("evidence"))


def check_second_reader(vendor: str | None, reviewer_vendor: str | None) -> None:
    """A second read must be by another vendor than the reviews, and both must be known."""
    a, b = (str(x or "").strip().casefold() for x in (vendor, reviewer_vendor))
    if not b:
        raise ValueError("a second read needs the vendor that wrote the reviews")
    if not a:
        raise ValueError("the vendor of the second read is not known")
    if a == b:
        raise ValueError(f"the second read is by {a}, who wrote the reviews")


def second_read(absent: DataFrame, cells: DataFrame, second: DataFrame, vendor: str, reviewer_vendor: str) -> DataFrame:
    """Rows not printed, regraded by another vendor's reading (page, line, column, amount), line ``header`` for its header.

    A row the extractor prints as often becomes second_vendor_prints_it_fewer_times
    where the reading holds every other figure of the column as often as the export counts it, and this
    one fewer times.  A page that the reading has no line of offers no evidence on lines.
    """
    check_second_reader(vendor, reviewer_vendor)
    lines = second.filter("line <> 'header'")
    read = lines.select("page").distinct().withColumn("lines_read", F.lit(True))
    held = lines.filter("amount is not null").groupBy("page", "column", F.col("amount").alias("x")).agg(F.count(F.lit(1)).alias("holds_it"))
    counted = cells.filter("amount is not null and not excluded").groupBy("page", "column", F.col("amount").alias("x")).agg(F.count(F.lit(1)).alias("n"))
    short = counted.join(held, ["page", "column", "x"], "left").filter(F.coalesce("holds_it", F.lit(0)) < F.col("n"))
    missed = short.groupBy("page", "column").agg(F.count(F.lit(1)).alias("figures_short"))
    b = absent.withColumn("x", F.col("value")).join(read, "page", "left").join(missed, ["page", "column"], "left").join(short.select("page", "column", "x", F.lit(True).alias("short")), ["page", "column", "x"], "left")
    bears = F.coalesce("lines_read", F.lit(False)) & F.coalesce("short", F.lit(False)) & (F.col("figures_short") == 1)
    return b.withColumn("evidence", F.when((F.col("evidence") == "extractor_prints_it_as_often") & bears, "second_vendor_prints_it_fewer_times").otherwise(F.col("evidence"))).select(*absent.columns)


def commission_reconciles(base: Column, rate: Column, commission: Column) -> Column:
    """Whether base times the printed rate is the commission, to the rate's own places; null if a term is missing or zero.

    ``base`` and ``commission`` are numbers, ``rate`` is text as printed.
    """
    b, c = base.cast("double"), commission.cast("double")
    text = F.regexp_replace(F.trim(F.coalesce(rate, F.lit(""))), "%+$", "")
    r = F.regexp_replace(text, ",", "").try_cast("double")
    places = F.when(F.contains(text, F.lit(".")), F.length(F.substring_index(text, ".", -1))).otherwise(0)
    unit = F.pow(F.lit(10.0), places)
    close = F.abs(b * r / 100 - c) <= F.greatest(F.lit(0.02), F.abs(c) * 0.001)
    # the two rates in units of the last printed place
    apart = F.abs(F.round(c / b * 100 * unit) - F.round(r * unit))
    known = b.isNotNull() & r.isNotNull() & c.isNotNull() & (b != 0) & (r != 0)
    return F.when(known, close | (apart <= F.when(places >= 2, 1.0).otherwise(0.0)))


def plan_amendments(fixes: DataFrame, fields: DataFrame, grades: tuple[str, ...] = INDEPENDENT) -> DataFrame:
    """The corrections with ``now``, what their field holds, and ``refused``: why one may not be applied, or null.

    ``fixes`` are corrections with a unique, ordered ``ordinal``; a null export_value is not
    checked.  ``fields`` (page, line, column, value) are the documents as they are now.  Refused are: evidence
    not selected, pages without a document, cells that hold neither the value that was reviewed nor
    the page's, figures moved from a line whose own correction is not applied, and corrections
    that break a line's arithmetic which held.  The last two feed each other within a page, so they run until neither
    refuses more: a round reads only pages that can still lose a correction.  Inputs dealt by page are not shuffled first.
    """
    s = Scratch(fixes.sparkSession, "amend")
    kept = [*fixes.columns, "now", "refused"]
    is_fix, is_terms = F.col("fix").isNotNull(), [F.col(f"is_{c}") for c in ARITHMETIC]
    at = ["page", "line", "column"]
    both = fixes.select(*at, F.struct(*(c for c in fixes.columns if c not in at)).alias("fix"), F.lit(None).cast("string").alias("value"))
    # a field without a line or a column makes its page known, and no more
    value = F.when(F.col("line").isNotNull() & F.col("column").isNotNull(), F.col("value").cast("string"))
    both = both.unionByName(fields.filter("page is not null").select(*at, F.lit(None).cast(both.schema["fix"].dataType).alias("fix"), value.alias("value")))
    # one sort serves the page, its lines and their cells
    page = Window.partitionBy("page").orderBy("line", "column").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    of_line, of_cell = Window.partitionBy("page", "line"), Window.partitionBy(*at)
    x = both.withColumns({"known": F.bool_or(~is_fix).over(page), "any": F.bool_or(is_fix).over(page)}).filter("any")
    x = x.withColumns({f"is_{c}": F.max(F.when(F.col("column") == c, F.col("value"))).over(of_line) for c in ARITHMETIC})
    x = x.withColumn("now", F.first("value", ignorenulls=True).over(of_cell)).filter(is_fix).select(*at, "fix.*", "known", "now", *is_terms)
    same = lambda a, b: a.eqNullSafe(b)
    x = x.withColumns({"held": printed_money(F.col("now")), "reviewed": printed_money(F.col("export_value"))})
    moved = F.col("export_value").isNotNull() & ~same(F.col("held"), F.col("reviewed")) & ~same(F.col("held"), F.col("page_value"))
    first = F.when(~F.coalesce(F.col("evidence").isin(*grades), F.lit(False)), "evidence_not_selected").when(~F.col("known"), "no_such_document").when(moved, "the_field_changed_since_the_review")
    may_fall = (F.size("moves_from_lines") > 0) | ((F.col("line") != "header") & F.concat(*is_terms).isNotNull())
    judged = x.withColumn("refused", first).withColumn("again", F.bool_or(F.col("refused").isNull() & may_fall).over(page))
    judged = s.table(judged.select(*kept, "again", *is_terms))
    live, done = judged.filter("refused is null and again"), [judged.filter("refused is not null or not again").select(*kept)]
    # money is read once and written, so that the rounds compare plain numbers
    base, rate, got = ARITHMETIC
    amount = lambda c: F.nullif(loadable_amount(F.col(f"is_{c}"))[0], F.lit("")).cast("double")
    if not live.isEmpty():
        live = s.table(live.select(*kept, amount(base).alias(f"is_{base}"), f"is_{rate}", amount(got).alias(f"is_{got}")))
    while not live.isEmpty():
        lines = F.collect_set("line").over(Window.partitionBy("page", "column"))
        fresh = lambda c, kind: F.coalesce(F.max_by(F.col("page_value").cast(kind), F.when(F.col("column") == c, F.col("ordinal"))).over(of_line), F.col(f"is_{c}"))
        y = live.repartition("page").withColumns({"lines_": lines, f"new_{base}": fresh(base, "double"), f"new_{rate}": fresh(rate, "string"), f"new_{got}": fresh(got, "double")})
        held_before, holds_after = (commission_reconciles(*(F.col(f"{x}_{c}") for c in ARITHMETIC)) for x in ("is", "new"))
        breaks = (F.col("line") != "header") & F.coalesce(held_before, F.lit(False)) & ~F.coalesce(holds_after, F.lit(False))
        half = F.size(F.array_except("moves_from_lines", "lines_")) > 0
        why = F.when(half, "moves_a_figure_whose_other_half_is_not_proved").when(breaks, "breaks_the_line_arithmetic")
        told = y.withColumn("refused", why).withColumn("again", F.bool_or(F.col("refused").isNotNull()).over(Window.partitionBy("page")))
        told = s.table(told.select(*kept, "again", *is_terms))
        done.append(told.filter("refused is not null or not again").select(*kept))
        live = told.filter("refused is null and again")
    every = done[0]
    for d in done[1:]:
        every = every.unionByName(d)
    return every


def apply_amendments(planned: DataFrame, fields: DataFrame, authorization: str) -> tuple[DataFrame, DataFrame]:
    """(fields amended, outcome of each correction beside its evidence).

    ``planned`` are corrections of :func:`plan_amendments`, ``fields`` (page, line, column, value, accepted_by) the documents that it read.
    An amended field takes the page's value and
    keeps what it replaced beside it; a field that the document lacks is added.  Corrections of one field go by
    their ordinal, so the last one stands; one that changes nothing already reads the page.
    """
    if not authorization:
        raise ValueError("amending needs a named authorization")
    key = ["page", "line", "column"]
    order = Window.partitionBy(*key, F.col("refused").isNull()).orderBy("ordinal")
    before = F.coalesce(F.lag("page_value").over(order), printed_money(F.col("now")))
    x = planned.withColumn("outcome", F.coalesce("refused", F.when(before.eqNullSafe(F.col("page_value")), "already_reads_the_page").otherwise("applied")))
    outcome = x.select("page", "ordinal", *key[1:], "evidence", "outcome")
    last = x.filter("refused is null and outcome = 'applied'").groupBy(*key).agg(F.max_by("page_value", "ordinal").alias("page_value"), F.max_by("evidence", "ordinal").alias("evidence"))
    out = fields.join(last, key, "full")
    amended = F.col("page_value").isNotNull()
    return out.select(
        *key,
        F.when(amended, F.regexp_replace(F.col("page_value").cast("string"), r"\.?0+$", "")).otherwise(F.col("value")).alias("value"),
        F.when(amended, "amended_from_page_review").otherwise(F.col("accepted_by")).alias("accepted_by"),
        "evidence",
        F.when(amended, authorization).alias("authorization"),
        F.when(amended, F.col("value")).alias("superseded_value"),
        F.when(amended, F.col("accepted_by")).alias("superseded_accepted_by"),
    ), outcome
