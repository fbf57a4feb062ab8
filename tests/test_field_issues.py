"""Order of dates proved within a document, and values judged once."""

from attestra.operators import fields


def test_orders_proved_without_casts(spark):
    cells = [(1, "a[0].ship_date", "01/02/2020"), (1, "a[1].ship_date", " 13/02/2020 "), (2, "a[0].ship_date", "01/02/2020"), (2, "a[1].ship_date", "2020-13-02"), (3, "a[0].due_date", "1/12/2020"), (4, "a[0].due_date", "2/3/20"), (4, "a[1].due_date", "12-13-20"), (5, "a[0].due_date", "13/14/2020"), (5, "a[1].due_date", "2/3/2020"), (6, "x.period_start", "99/1/20")]
    rows = [(*c, "p") for c in cells] + [(7, "total_amount", "(5)\t", "p"), (7, "total_amount", "$1,0", "p"), (7, "job_number", " a1 ", ""), (7, "note", None, "")]
    found = fields.field_issues(spark.createDataFrame(rows, "document_id int, path string, value string, source string"), ("USD",))
    got = sorted((r.document_id, r.field, r.reason, r.value) for r in found.collect())
    late = lambda k, *vs: [(k, c[1], fields.AMBIGUOUS, c[2]) for c in cells if c[0] == k and c[2] in vs]
    want = late(2, "01/02/2020") + late(3, "1/12/2020") + late(5, "13/14/2020", "2/3/2020")
    want += [(7, "total_amount", "negative_value_requires_review", "(5)\t"), (7, "job_number", "implausible_identifier_format", " a1 "), (7, "job_number", "missing_field_provenance", " a1 ")]
    assert got == sorted(want)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "as int)" not in plan and not any("Filter" in line and "array_compact" in line and "no_day" in line for line in plan.split("\n"))
