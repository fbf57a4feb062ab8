"""Candidate pairs and components of names."""

from pyspark.sql import functions as F

from attestra.catalog import QUERIES
from attestra.operators import entities


def keys(name):
    w = name.split(" ")
    return {k for k in (w[0][:6], "".join(x[0] for x in w[:4]) if len(w) > 1 else "", name.replace(" ", "")[:6]) if k}


def test_large_blocks_are_paired(spark):
    names = sorted({f"supply {a}{b}x house" for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnopqrst"} | {"fernhollow", "fern hollow", "other"})
    df = spark.createDataFrame([(n,) for n in names], "norm string")
    got = [tuple(r) for r in entities.candidate_pairs(df).collect()]
    k = {n: keys(n) for n in names}
    want = {(a, b) for i, a in enumerate(names) for b in names[i + 1 :] if k[a] & k[b]}
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 520 * 519 // 2


def test_review_band_does_not_unite(spark, tmp_path):
    names = [(1, "amber tall linden works"), (2, "amber tall linden work"), (3, "birch low harbour mills east"), (4, "birch low harbour millss east yard"), (5, "cedar"), (6, "fernhollow hill"), (9, "fern hollow hill")]
    spark.createDataFrame(names, "p_partkey long, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    rows = QUERIES["entity_components"](spark, str(tmp_path)).collect()
    scored = spark.createDataFrame([(a, b) for i, (_, a) in enumerate(names) for _, b in names[i + 1 :]], "a string, b string").withColumn("s", entities.similarity(F.col("a"), F.col("b"))).collect()
    near = {tuple(sorted((x.a, x.b))): x.s for x in scored if keys(x.a) & keys(x.b) and x.s >= entities.REVIEW}
    review = {p: s for p, s in near.items() if s < entities.MERGE}
    assert {(r.a, r.b): r.score for r in rows if r.kind == "review"} == review and review
    assert [p for p, s in near.items() if s >= entities.MERGE] == [("fern hollow hill", "fernhollow hill")]
    assert {r.root: r.mentions for r in rows if r.kind == "party"} == {n: 1 for _, n in names if "hollow hill" not in n} | {"fern hollow hill": 2}
