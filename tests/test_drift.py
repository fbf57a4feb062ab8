"""Template drift where very many templates look alike."""

import time

from pyspark.sql import functions as F

from attestra.operators import evaluate


def test_alike_templates_are_scored_once(spark):
    k = F.col("id") % 2
    t = spark.range(30000).select(F.col("id").alias("template_id"), F.when(k == 0, "a").otherwise("b").alias("family"), F.array(F.lit("blue"), F.when(k == 0, "ring").otherwise("bolt")).alias("headers"))
    more = spark.createDataFrame([(-1, "a", ["blue", "ring", "x"]), (-2, "c", ["none"]), (-3, "a", None)], "template_id long, family string, headers array<string>")
    start = time.time()
    got = {tuple(r) for r in evaluate.template_drift(t.unionByName(more), t).filter("template_id < 2").collect()}
    assert got == {(0, "ambiguous", 0, 1.0), (1, "ambiguous", 1, 1.0), (-1, "drift", 0, 0.733333), (-2, "new", None, None), (-3, "new", None, None)}
    assert time.time() - start < 60
