"""URL templates below the third segment, against a plain recursion."""

import math
import random
import re
from collections import defaultdict

from attestra.llm import urltree

VARIABLE = re.compile(r"^[0-9]+([._-].*)?$|^[0-9a-fA-F]{8,}$|[0-9]{4,}|%[0-9a-fA-F]{2}")


def templates(rows, least_rows=5, z=1.64):
    """rows (host, path, n, labelled, bad) -> {(host, path): template}, branch by branch to the last segment."""
    out = {}

    def branch(template, members, k):
        kids = defaultdict(lambda: [0, 0, 0])
        for segs, (_, _, *counts) in members:
            if len(segs) > k and not VARIABLE.search(segs[k]):
                kids[segs[k]] = [a + b for a, b in zip(kids[segs[k]], counts, strict=True)]
        labelled, bad = sum(x[1] for x in kids.values()), sum(x[2] for x in kids.values())
        rate = (bad + 1) / (labelled + 2)
        below = defaultdict(list)
        for segs, row in members:
            if len(segs) <= k:
                out[row[:2]] = template
                continue
            n, lab, b = kids.get(segs[k], (0, 0, 0))
            alike = lab > 0 and labelled > lab and abs((b + rate) / (lab + 1) - rate) <= z * math.sqrt(rate * (1 - rate) / (lab + 1))
            literal = not VARIABLE.search(segs[k]) and n >= least_rows and not alike
            below[template + "/" + (segs[k] if literal else "*")].append((segs, row))
        for t, m in below.items():
            branch(t, m, k + 1)

    hosts = defaultdict(list)
    for row in rows:
        hosts[row[0]].append(([x for x in row[1].split("/") if x], row))
    for m in hosts.values():
        branch("", m, 0)
    return out


def test_good_pages_below_the_third_segment_are_allowed(spark):
    paths = [f"/{x}/p/q/bad" for x in ("es", "fr") for _ in range(40)] + ["/12/p/q/good"] * 6
    df = spark.createDataFrame([(i, f"http://x.net{p}") for i, p in enumerate(paths)], "page_id long, url string")
    got = {(r.path, r.verdict, r.template, r.purity) for r in urltree.url_verdicts(df).collect()}
    assert ("/12/p/q/good", "allow", "/*/p/q/good", 0.1) in got and {v for p, v, _, _ in got if p.endswith("bad")} == {"block"}


def test_deep_templates_equal_the_recursion(spark):
    draw = random.Random(3)
    urls = [f"http://{draw.choice(['a.net', 'b.net', 'c.org'])}/" + "/".join(draw.choice(["es", "fr", "x", "y", "12", "77777"]) for _ in range(draw.randrange(9))) + draw.choice(["", "/"]) for _ in range(1500)]
    urls += ["http://one.org/" + "/".join(["a", "7", "b"] * 20)] * 6 + ["http://few.org/a/b/c/d/e"] * 4
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = urltree.url_verdicts(df).collect()
    count = defaultdict(lambda: [0, 0, 0])
    for r in got:
        c = count[r.host, r.path]
        c[0], c[1], c[2] = c[0] + 1, c[1] + (r.rule is not None), c[2] + (r.rule is not None and r.verdict == "block")
    want = templates([(h, p, *c) for (h, p), c in count.items()])
    assert {(r.host, r.path): r.template for r in got} == want and len(got) == len(urls)
