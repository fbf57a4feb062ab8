"""Connected components by alternating stars (Kiveris et al., SoCC 2014).

Each round moves every node's larger neighbours, then its smaller ones, to the
smallest neighbour.  A round is two partial aggregations and two joins, which
Spark splits where a node has very many neighbours; nothing is gathered in one
task and the driver sees two numbers a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch


def connected_components(edges: DataFrame, scratch: Scratch, max_rounds: int = 60) -> DataFrame:
    """edges (a, b), any order, repeats and loops allowed -> (node, root), root the smallest node reached.

    Nodes with no edge to another node do not appear.  No edges give no rows.
    Raises if ``max_rounds`` rounds do not settle the stars.
    """
    now = scratch.table(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    for _ in range(max_rounds):
        both = now.select("a", "b").unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # the minima are written, so that the joins can split a node of very many neighbours
        low = scratch.table(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m")))
        large = both.filter("b > a").join(low, F.col("a") == F.col("k")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = scratch.table(large.filter("a <> b"))
        least = scratch.table(large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), "m"))
        joined = large.join(least, F.col("a") == F.col("k"))
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("k").alias("a"), F.col("m").alias("b")))
        after = scratch.table(small.filter("a <> b").distinct())
        count = after.count()
        # rows are distinct, so tables of one size are equal if one holds no row that the other lacks
        settled = count == seen and after.join(now, ["a", "b"], "left_anti").isEmpty()
        scratch.drop(now, low, large, least)
        now, seen = after, count
        if settled:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    raise RuntimeError(f"components not settled after {max_rounds} rounds")
