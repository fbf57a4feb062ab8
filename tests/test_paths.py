"""Flatten and unflatten against Python's own JSON."""

import json
import random

from attestra.operators import paths


def invented(rng, depth):
    kind = rng.random()
    if depth == 0 or kind < 0.3:
        return rng.choice([1, 2.5, "x", "a.b", "", None, True, {}, [], "é\n\"q\""])
    if kind < 0.65:
        return {rng.choice(["a", "b", "c d", "x.y", "", "q[0]", 'say "hi"', "é", "k\\z"]): invented(rng, depth - 1) for _ in range(rng.randrange(1, 5))}
    return [invented(rng, depth - 1) for _ in range(rng.randrange(1, 12))]


def test_there_and_back(spark):
    rng = random.Random(7)
    docs = {i: invented(rng, i % 7) for i in range(150)} | {900: {"lines": [{"amount": "5"}, {"amount": "6"}]}}
    df = spark.createDataFrame([(i, json.dumps(v)) for i, v in docs.items()] + [(901, "{broken"), (902, None)], "i int, t string")
    flat = paths.flatten(df, "i", "t")
    assert sorted((r.path, r.value) for r in flat.filter("i = 900").collect()) == [("lines[0].amount", '"5"'), ("lines[1].amount", '"6"')]
    assert [(r.path, r.value) for r in flat.filter("i >= 901").collect()] == [(None, None)]
    back = {r.i: json.loads(r.text) for r in paths.unflatten(flat, "i").collect()}
    assert back == docs


def test_contradictory_places_are_no_document(spark):
    rows = [(1, "a.b", "1"), (1, "a[0]", "2"), (2, "a", "1"), (2, "a.b", "2"), (3, "a[5]", "1"), (3, "a[2]", "2"), (4, "a", "1"), (4, "a", "1"), (5, None, None), (6, "z", None)]
    got = {r.i: r.text for r in paths.unflatten(spark.createDataFrame(rows, "i int, path string, value string"), "i").collect()}
    assert got == {1: None, 2: None, 3: '{"a":[2,1]}', 4: None, 6: '{"z":null}'}
    assert paths.unflatten(spark.createDataFrame([], "i int, path string, value string"), "i").count() == 0


def test_names_that_json_escapes_come_back(spark):
    names = ["a\n", "b\\", 'c"', "\x7f", " ", "é", "[0", "]", "a[1]", " ", "d\x01", "x.\n"]
    docs = {i: {"o": [{n: i, "z": [n]}]} for i, n in enumerate(names)}
    flat = paths.flatten(spark.createDataFrame([(i, json.dumps(v)) for i, v in docs.items()], "i int, t string"), "i", "t")
    got = {r.i: r.text and json.loads(r.text) for r in paths.unflatten(flat, "i").collect()}
    assert {i: got[i] for i in docs if not names[i].endswith("\n")} == {i: v for i, v in docs.items() if not names[i].endswith("\n")}


def test_a_level_is_dealt_once(spark, monkeypatch):
    seen, table = [], paths.Scratch.table
    monkeypatch.setattr(paths.Scratch, "table", lambda self, df, *more: seen.append(df._jdf.queryExecution().executedPlan().toString()) or table(self, df, *more))
    paths.unflatten(spark.createDataFrame([(1, "a[0].b", "1"), (1, "a[1].b", "2")], "i int, path string, value string"), "i")
    assert len(seen) == 4 and max(plan.count("Exchange hashpartitioning") for plan in seen) == 1
