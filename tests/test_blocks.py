"""Tables that repeat themselves, against all pairs of their rows."""

import random
from collections import defaultdict

from attestra import numbering
from attestra.operators import labels


def test_repeats_are_dealt_by_lines(spark, monkeypatch):
    monkeypatch.setattr(numbering, "TASK_ROWS", 100)
    rng = random.Random(3)
    rows = []
    for k in range(120):
        table = [rng.choice("abc") for _ in range(rng.randrange(1, 9))]
        table = table * 2 + [rng.choice("abc")] * rng.randrange(2) if k % 2 else table
        rows += [(k, 3 * i, s) for i, s in enumerate(table)] + [(k, 0, rng.choice("abc"))] * (k % 3)
    found = labels.repeated_blocks(spark.createDataFrame(rows, "k int, o int, s string"), "k", "o", ["s"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" in plan and all(f", {len(rows) // 100})" in x or f", {len(rows) // 100}), REPARTITION" in x for x in plan.split("\n") if "Exchange hashpartitioning" in x)
    want = set()
    for k in range(120):
        mine = {(o // 3 + 1, s) for d, o, s in rows if d == k}
        n, met = max(i for i, _ in mine), defaultdict(list)
        for i, s in mine:
            for j, t in mine:
                if s == t and i < j and (j - i) * 2 >= n:
                    met[j - i].append(s)
        want |= {(k, o, len(ss), len(set(ss)), n) for o, ss in met.items() if len(ss) >= 3 and len(set(ss)) >= 2 and len(ss) >= 0.8 * (n - o)}
    assert want and {tuple(r) for r in found.collect()} == want
