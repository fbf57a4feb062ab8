"""Pairs and searches whose tasks must not grow with the tables."""

import math
import re
from itertools import combinations

from attestra.catalog import QUERIES
from attestra.operators import graph, search


def test_common_neighbours_in_many_parts(spark, monkeypatch):
    monkeypatch.setattr(graph, "PAIRS", 5)
    edges = [(i, i % m + 100 * m) for i in range(60) for m in (2, 3, 7)] + [(None, 200), (1, None), (1, 201), (1, 201)]
    got = graph.candidates(None, spark.createDataFrame([(*e, "in") for e in edges], "from_id long, to_id long, edge_type string"), "in")
    near = {i: {t for f, t in edges if f == i} - {None} for i in range(60)}
    want = {(a, b, len(near[a] & near[b])) for a, b in combinations(range(60), 2) if near[a] & near[b]}
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    assert got.rdd.getNumPartitions() > 100


def test_a_search_asks_for_every_hundredth_document(spark, tmp_path):
    rows = [(i, f"alpha beta w{i % 2} v{i % 2}", f"l{i % 2}", "web", 10) for i in range(195, 305)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted((r.page_id, r.label) for r in QUERIES["nearest_label"](spark, str(tmp_path)).collect()) == [(200, "l0"), (300, "l0")]


def test_a_search_reads_its_texts_once(spark):
    rows = [(1, "red fox, red hen"), (2, "fox"), (2, "RED red hen"), (3, None), (4, "redfox"), (5, "fox red"), (6, "Fox-red red")]
    df = spark.createDataFrame(rows, "i int, t string")
    found = search.search(df, "i", "t", "Red fox")
    assert "LocalTableScan" not in found._jdf.queryExecution().optimizedPlan().toString().replace("LocalRelation", "LocalTableScan")
    texts = [re.findall("[a-z0-9]+", (t or "").lower()) for _, t in rows]
    mean, score = sum(map(len, texts)) / len(texts), {}
    per = {i: [w for (k, _), w in zip(rows, texts) if k == i] for i, _ in rows}
    for word in ("fox", "red"):
        holders = {i for i, ws in per.items() if any(word in w for w in ws)}
        idf = math.log(1 + (len(rows) - len(holders) + 0.5) / (len(holders) + 0.5))
        for i in holders:
            tf, length = sum(w.count(word) for w in per[i]), max(len(w) for w in per[i] if word in w)
            score[i] = score.get(i, []) + [idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / mean))]
    want = sorted(((-round(sum(s), 6), i) for i, s in score.items() if len(s) == 2))
    assert [(-r.score, r.i) for r in found.collect()] == want
