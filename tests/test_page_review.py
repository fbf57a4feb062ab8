"""Page review and amendments on small pages, the plan against a plain fixpoint."""

import random
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from attestra import catalog_pages
from attestra.operators import page_review as pr
from attestra.scratch import Scratch
from attestra.sources.driver_tables import Driver

FIX = "page string, ordinal int, line string, column string, export_value string, page_value decimal(38,6), evidence string, moves_from_lines array<string>"
FIELD = "page string, line string, column string, value string, accepted_by string"


def test_money_as_printed(spark):
    said = ["57.06 USD", "USD 57.06", "($1,204.50)", "-3", "", None, "12-3", "799.67 (1,404.13 is another job's)", "2 rows: 100.00", "1.2.3", "(5", ".5"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(said)], "i int, t string").select("i", pr.printed_money(F.col("t")).alias("a"), pr.stated_money(F.col("t")).alias("b"))
    got = {r.i: (None if r.a is None else float(r.a), None if r.b is None else float(r.b)) for r in rows.collect()}
    assert [got[i] for i in range(len(said))] == [(57.06,) * 2, (57.06,) * 2, (-1204.5,) * 2, (-3.0,) * 2, (None,) * 2, (None,) * 2, (None,) * 2, (None, 799.67), (None,) * 2, (None,) * 2, (5.0,) * 2, (0.5,) * 2]


def test_header_stands_in_for_lines(spark):
    reviews = spark.createDataFrame([("a", "k", "paid", 1, 1, 0, ["10.00"], None), ("b", "k", "amount", 1, 1, 0, ["10.00"], "12"), ("c", "k", "amount", 1, 1, 0, ["10.00", "10.00"], None), ("d", "k", None, 1, 1, 0, ["1"], None)],
                                    "page string, document_kind string, money_column string, page_rows int, money_cells_checked int, money_cells_wrong int, page_money array<string>, page_total string")
    header = spark.createDataFrame([("a", "paid", D("10")), ("a", "total_due", D("99")), ("a", "total__amount", D("98")), ("b", "total", D("12")), ("b", "total_paid", D("12")), ("c", "total", D("10"))], "page string, column string, amount decimal(38,6)")
    cells = spark.createDataFrame([("c", "1", "amount", D("10"), True), ("c", "2", "note", None, False)], "page string, line string, column string, amount decimal(38,6), excluded boolean")
    got = sorted((r.page, r.kind, float(r.amount), r.n) for r in pr.page_balance(reviews, cells, header).collect())
    # b: the header restates the printed total, its rows are lost; c: one of two printed figures is held, by an excluded line
    assert got == [("b", "lost", 10.0, 1), ("c", "lost", 10.0, 1)]
    assert [(r.page, r.missing) for r in pr.review_errors(reviews).collect()] == [("d", ["money_column"])]


def test_arithmetic_to_the_printed_places(spark):
    rows = [(100.0, "2.38%", 2.3751), (100.0, "2.4", 2.3751), (100.0, "2.5", 2.3751), (100.0, "10", 10.0), (0.0, "1", 1.0), (100.0, "", 1.0), (100.0, "5%", None), (1000.0, "3", 36.0)]
    df = spark.createDataFrame(rows, "b double, r string, c double")
    assert [r[0] for r in df.select(pr.commission_reconciles(F.col("b"), F.col("r"), F.col("c"))).collect()] == [True, True, False, True, None, None, None, False]


def plain_plan(fixes, fields):
    now = {(p, n, c): v for p, n, c, v, _ in fields}
    docs = {p for p, *_ in now}
    num = lambda v: None if v in (None, "") else D(v)
    why = {}
    for p, i, n, c, was, value, grade, moves in fixes:
        if grade not in pr.INDEPENDENT:
            why[p, i] = "evidence_not_selected"
        elif p not in docs:
            why[p, i] = "no_such_document"
        elif was is not None and num(now.get((p, n, c))) not in (num(was), value):
            why[p, i] = "the_field_changed_since_the_review"

    def holds(p, n, over):
        b, r, c = (over.get(k, num(now.get((p, n, k)))) for k in pr.ARITHMETIC)
        return None not in (b, r, c) and b != 0 and r != 0 and abs(b * r / 100 - c) <= max(D("0.02"), abs(c) / 1000)

    while True:
        live = [f for f in fixes if (f[0], f[1]) not in why]
        refused = {}
        for p, i, n, c, _, value, _, moves in live:
            if set(moves) - {f[2] for f in live if f[0] == p and f[3] == c}:
                refused[p, i] = "moves_a_figure_whose_other_half_is_not_proved"
            elif n != "header":
                over = {f[3]: f[5] for f in live if f[0] == p and f[2] == n}
                if holds(p, n, {}) and not holds(p, n, over):
                    refused[p, i] = "breaks_the_line_arithmetic"
        if not refused:
            return why
        why |= refused


def test_plan_against_a_plain_fixpoint(spark):
    rng = random.Random(4)
    fixes, fields = [], []
    for k in range(60):
        page = f"p{k}"
        if k % 13:
            for n in range(1, 5):
                base = 100 * n
                fields += [(page, str(n), "commissionable_amount", f"{base}.00", "consensus"), (page, str(n), "stated_commission_rate", "5", "consensus"), (page, str(n), "commission_amount", str(base * 5 / 100 + rng.choice([0, 0, 3])), "consensus")]
            fields.append((page, "header", "total_amount", "50.00", "consensus"))
        for i in range(rng.randrange(1, 7)):
            n = rng.choice(["1", "2", "3", "4", "header"])
            c = "total_amount" if n == "header" else rng.choice(["commission_amount", "commissionable_amount"])
            was = next((v for p, m, x, v, _ in fields if (p, m, x) == (page, n, c)), None)
            moves = [m for m in "1234" if m != n and rng.random() < 0.2] if n != "header" else []
            fixes.append((page, i, n, c, rng.choice([was, was, None, "7.77"]), D(rng.choice(["5", "10", "15", "20", "100", "200"])), rng.choice([*pr.INDEPENDENT, "reviewer_only"]), moves))
    f, now = spark.createDataFrame(fixes, FIX), spark.createDataFrame(fields, FIELD)
    got = {(r.page, r.ordinal): r.refused for r in pr.plan_amendments(f, now).collect()}
    want = plain_plan(fixes, fields)
    assert got == {(x[0], x[1]): want.get((x[0], x[1])) for x in fixes}
    assert set(want.values()) >= {"the_field_changed_since_the_review", "moves_a_figure_whose_other_half_is_not_proved", "breaks_the_line_arithmetic", "no_such_document"}


def test_amended_fields_keep_what_they_replace(spark):
    fields = spark.createDataFrame([("p", "1", "extended_amount", "9.00", "vendor_vote"), ("p", "2", "extended_amount", "4.00", None)], FIELD)
    fixes = spark.createDataFrame([("p", 1, "1", "extended_amount", "9", D("100"), "engine", []), ("p", 2, "1", "extended_amount", "9", D("100"), "engine", []), ("p", 3, "2", "extended_amount", None, D("4"), "engine", []), ("p", 4, "header", "total_amount", None, D("7.5"), "second_vendor", [])], FIX)
    out, outcome = pr.apply_amendments(pr.plan_amendments(fixes, fields), fields, "A-7")
    assert {r.ordinal: r.outcome for r in outcome.collect()} == {1: "applied", 2: "already_reads_the_page", 3: "already_reads_the_page", 4: "applied"}
    got = {(r.line, r.column): (r.value, r.accepted_by, r.evidence, r.authorization, r.superseded_value, r.superseded_accepted_by) for r in out.collect()}
    amended = "amended_from_page_review"
    assert got == {("1", "extended_amount"): ("100", amended, "engine", "A-7", "9.00", "vendor_vote"), ("2", "extended_amount"): ("4.00", None, None, None, None, None), ("header", "total_amount"): ("7.5", amended, "second_vendor", "A-7", None, None)}
    with pytest.raises(ValueError):
        pr.apply_amendments(fixes, fields, "")


def test_second_reader_must_be_another():
    for pair in (("a", ""), ("", "a"), ("A ", "a")):
        with pytest.raises(ValueError):
            pr.check_second_reader(*pair)


MONEY_T = "decimal(38,6)"


def test_corrections_against_plain_counts(spark):
    rng = random.Random(7)
    pages, figures, cols = [f"p{k}" for k in range(25)], [D("5"), D("7.5"), D("12"), D("0")], ["extended_amount", "unit_price"]
    pick = lambda n, *of: [tuple(rng.choice(x) for x in of) for _ in range(n)]
    lines = ["1", "2", "3", "10"]
    cells = [(*c, rng.random() < 0.2) for c in dict.fromkeys(pick(150, pages, lines, cols))]
    cells = [(p, n, c, rng.choice([*figures, None]), x) for p, n, c, x in cells]
    findings = [(p, i, n, c, rng.choice(["9.00", None]), said) for i, (p, n, c, said) in enumerate(pick(120, pages, [*lines, "header", "x"], [*cols, "note"], ["5.00", "$7.50 USD", "7.50 as printed", "12", "0", "illegible", "not printed", None]))]
    printed = [(p, a, rng.randrange(3)) for p, a in dict.fromkeys(pick(60, pages, [*figures, None]))]
    readings, second = ([(*x, rng.choice([*figures, None])) for x in pick(120, pages, [*lines, "header"], cols)] for _ in range(2))
    reviews = [(p, None if p == "p3" else "k", "amount", 1, 1, 0, ["1"], None) for p in pages[1:]]
    make = lambda rows, schema: spark.createDataFrame(rows, schema.replace("amount money", f"amount {MONEY_T}"))
    four = "page string, line string, column string, amount money"
    facts = pr.facts(make(cells, four + ", excluded boolean"), make(printed, "page string, amount money, n long"), make(readings, four), make(second, four))
    r = make(reviews, "page string, document_kind string, m string, page_rows int, m_c int, m_w int, page_m array<string>, page_total string").toDF("page", "document_kind", "money_column", "page_rows", "money_cells_checked", "money_cells_wrong", "page_money", "page_total")
    got = {x.ordinal: (x.page_value, x.evidence, x.retained_readings, x.moves_from_lines, x.difference) for x in pr.corrections(r, make(findings, "page string, ordinal int, line string, column string, export string, said string"), facts, ("b", "a")).collect()}
    value = {"5.00": D("5"), "$7.50 USD": D("7.5"), "7.50 as printed": D("7.5"), "12": D("12"), "0": D("0")}
    want = {}
    for p, i, n, c, export, said in findings:
        if p in ("p0", "p3") or n == "x" or c == "note" or said not in value:
            continue
        v = value[said]
        held = sorted(a for q, m, d, a in readings if (q, m, d) == (p, n, c) and a is not None)
        others = sorted((m for q, m, d, a, x in cells if (q, d, a) == (p, c, v) and not x and m != n), key=int)
        text, engine = any((q, a) == (p, v) and k > 0 for q, a, k in printed), v in held
        read = [m == "header" for q, m, d, a in second if (q, d, a) == (p, c, v)]
        agrees = any(read) if n == "header" else read.count(False) > len(others)
        evidence = "extractor_text_and_engine" if engine and text else "extractor_text" if text else "engine" if engine else "second_vendor" if agrees else "reviewer_only"
        want[i] = (v, evidence, held, others if v and n != "header" else [], abs(v - (D("9") if export else 0)))
    assert got == want and len({x[1] for x in want.values()}) == 5 and any(x[3] for x in want.values())


def test_a_page_is_dealt_once(spark):
    d = Driver(spark, "/root/testdata/sf0.001")
    x = catalog_pages._Pages(d)
    plan = catalog_pages._graded(x)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == plan.count("REPARTITION_BY_NUM") > 0
    assert x.line.rdd.getNumPartitions() == d.line_tasks()


def test_rounds_read_only_pages_that_can_lose_a_correction(spark, monkeypatch):
    fields = [(f"p{k}", n, "extended_amount", "9.00", "consensus") for k in range(20) for n in "12"]
    fixes = [(f"p{k}", 1, "1", "extended_amount", "9", D("5"), "engine", ["2"] if k < 2 else []) for k in range(20)] + [("p0", 2, "2", "extended_amount", "9", D("7"), "engine", [])]
    read, table = [], Scratch.table

    def counted(self, df, tasks=None):
        out = table(self, df, tasks)
        read.append(out.count())
        return out

    monkeypatch.setattr(Scratch, "table", counted)
    got = {(r.page, r.ordinal): r.refused for r in pr.plan_amendments(spark.createDataFrame(fixes, FIX), spark.createDataFrame(fields, FIELD)).collect()}
    assert got == {(x[0], x[1]): "moves_a_figure_whose_other_half_is_not_proved" if x[0] == "p1" else None for x in fixes}
    assert read[0] == 21 and all(n <= 3 for n in read[1:])
