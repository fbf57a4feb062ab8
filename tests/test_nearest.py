"""Nearest pages against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from attestra.catalog import QUERIES
from attestra.operators import dimensions


def brute(pages, settled, k, least):
    """pages {id: words}, settled {id: (words, label)}: every page against every settled page."""
    out = {}
    for i, words in pages.items():
        a = set(words)
        ranked = sorted(((len(a & set(w)) / len(a | set(w)) if a | set(w) else 0.0, j, label) for j, (w, label) in settled.items() if j != i), reverse=True)[:k]
        if len(ranked) == k and ranked[0][0] >= least and len({x[2] for x in ranked}) == 1:
            out[i] = (ranked[0][2], round(ranked[0][0], 6))
    return out


@pytest.mark.parametrize("block_words", [2_000_000, 3_000])
def test_words_on_many_pages_open_pairs(spark, block_words):
    draw = random.Random(7)
    settled = {i: ([f"common{i % 2}"] + [f"w{draw.randrange(40)}" for _ in range(i % 4)], f"m{i % 2}") for i in range(2100)}
    pages = {-1: ["common0"], -2: ["common1", "none"], -3: ["nothing"], -4: [], 5: settled[5][0], 8: settled[8][0]}
    p = spark.createDataFrame(list(pages.items()), "page_id long, words array<string>")
    s = spark.createDataFrame([(i, w, x) for i, (w, x) in settled.items()], "page_id long, words array<string>, label string")
    got = {r.page_id: (r.label, r.likeness) for r in dimensions.nearest(p, s, 5, 0.3, block_words=block_words).collect()}
    want = brute(pages, settled, 5, 0.3)
    assert got == want and want[-1] == ("m0", 1.0)


def test_query_reads_whole_documents(spark, tmp_path):
    draw = random.Random(11)
    docs = []
    for i in range(60):
        own = [f"t{i % 2}x{draw.randrange(60)}" for _ in range(30 if i % 3 else 500)]
        docs.append((i * 100, ". ".join([f"s{n}" for n in range(12)] + own) + ".", f"l{i % 2}"))
    rows = [(i, t, x, "web", len(t)) for i, t, x in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.page_id: (r.label, r.likeness) for r in QUERIES["nearest_label"](spark, str(tmp_path)).collect()}
    words = {i: [w for w in re.split(r"[\s.,]+", t) if w] for i, t, _ in docs}
    want = brute(words, {i: (words[i], x) for i, _, x in docs}, 5, 0.05)
    assert got == want and len(want) > 40 and any(len(t) >= 2000 for i, t, _ in docs if i in want)


@pytest.mark.parametrize("block_words", [32_000_000, 9_000])
def test_fewer_settled_pages_than_pages(spark, monkeypatch, block_words):
    monkeypatch.setattr(dimensions, "AT_ONCE", 16)
    draw = random.Random(3)
    page = lambda: [f"w{int(draw.random() ** 3 * 60)}" for _ in range(draw.randrange(20))]
    pages, settled = {f"p{i}": page() for i in range(150)}, {f"p{i}": (page(), draw.choice("ab")) for i in range(130, 170)}
    p = spark.createDataFrame(list(pages.items()), "page_id string, words array<string>")
    s = spark.createDataFrame([(i, w, x) for i, (w, x) in settled.items()], "page_id string, words array<string>, label string")
    for few, many, left, right in ((p, s, pages, settled), (s.select("page_id", "words"), p.withColumn("label", F.lit("a")), {i: w for i, (w, _) in settled.items()}, {i: (w, "a") for i, w in pages.items()})):
        got = {r.page_id: (r.label, r.likeness) for r in dimensions.nearest(few, many, 3, 0.1, block_words=block_words).collect()}
        assert got == brute(left, right, 3, 0.1) and len(got) > 15


def test_a_search_reads_all_documents_once(spark, monkeypatch):
    draw = random.Random(4)
    settled = {i: ([f"w{draw.randrange(3000)}" for _ in range(40)], "x") for i in range(1500)}
    s = spark.createDataFrame([(i, w, x) for i, (w, x) in settled.items()], "page_id long, words array<string>, label string")
    jobs = []
    monkeypatch.setattr(dimensions, "Scratch", lambda *a: jobs.append(a))
    got = dimensions.nearest(s.filter("page_id % 100 = 0").select("page_id", "words"), s, 5, 0.0, block_words=12_000)
    assert not jobs and {r.page_id: (r.label, r.likeness) for r in got.collect()} == brute({i: settled[i][0] for i in range(0, 1500, 100)}, settled, 5, 0.0)
