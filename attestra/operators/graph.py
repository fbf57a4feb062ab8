"""The evidence graph: two tables, merged and checked; property queries, shortest paths, contradictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch

MAX_DEPTH = 12
#: Pairs of common neighbours that one task counts.
PAIRS = 250_000


def content_id(kind: Column, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("\x1f", kind, *parts), 256)


def merge_nodes(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(one row a node_id, ids given with several contents)."""
    per = nodes.groupBy("node_id").agg(F.countDistinct("node_type", "label").alias("k"), F.min("node_type").alias("node_type"), F.min("label").alias("label"))
    return per.filter("k = 1").drop("k"), per.filter("k > 1").select("node_id", F.lit("conflicting_content").alias("reason"))


def orphan_edges(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges with an endpoint that is no node."""
    ids = nodes.select("node_id")
    no_from = edges.join(ids, edges.from_id == ids.node_id, "left_anti").withColumn("missing", F.lit("from"))
    no_to = edges.join(ids, edges.to_id == ids.node_id, "left_anti").withColumn("missing", F.lit("to"))
    return no_from.unionByName(no_to)


def inventory(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    n = nodes.groupBy(F.lit("node").alias("kind"), F.col("node_type").alias("type")).agg(F.count(F.lit(1)).alias("n"))
    return n.unionByName(edges.groupBy(F.lit("edge").alias("kind"), F.col("edge_type").alias("type")).agg(F.count(F.lit(1)).alias("n")))


def neighbours(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("from_id").alias("a"), F.col("to_id").alias("b")).unionByName(edges.select(F.col("to_id").alias("a"), F.col("from_id").alias("b"))).filter("a <> b").distinct()


def shortest_path(edges: DataFrame, source: str, target: str, depth: int = MAX_DEPTH) -> DataFrame:
    """(step, node_id) of an undirected shortest path; of several, each step back goes to the smallest node.

    Each frontier is a written table of nodes with their parent, so no plan nests in the next and no
    path is carried along; the way back looks up one parent a step.  The loop ends at the target, at an
    empty frontier, or at ``depth``.
    """
    if not 1 <= depth <= MAX_DEPTH:
        raise ValueError("depth must be 1 to 12")
    spark = edges.sparkSession
    s = Scratch(spark, "path")
    both = s.table(neighbours(edges))
    frontiers = [spark.createDataFrame([(source, source)], "node string, parent string")]
    found = source == target
    for _ in range(depth):
        if found:
            break
        near = frontiers[-1].select("node").join(both, F.col("node") == F.col("a")).groupBy("b").agg(F.min("a").alias("parent"))
        # in an undirected graph a neighbour of a frontier lies in the next, in itself or in the one before
        seen = frontiers[-1].select("node").unionByName(frontiers[-2].select("node")) if len(frontiers) > 1 else frontiers[-1].select("node")
        frontier = s.table(near.join(seen, near["b"] == seen["node"], "left_anti").select(F.col("b").alias("node"), "parent"))
        if frontier.isEmpty():
            break
        frontiers.append(frontier)
        found = not frontier.filter(F.col("node") == target).isEmpty()
    way = [target] if found else []
    for f in reversed(frontiers[1:] if found else []):
        way.append(f.filter(F.col("node") == way[-1]).first().parent)
    return spark.createDataFrame(list(enumerate(reversed(way))), "step int, node_id string")


def candidates(nodes: DataFrame, edges: DataFrame, edge_type: str) -> DataFrame:
    """Pairs of nodes with a common neighbour over ``edge_type``, with how many; a node's most connected first.

    The pairs grow with the square of a neighbour's nodes.  A neighbour's smaller ids are cut into parts by hash, each of which
    meets all its nodes, and the pairs are dealt by their smaller id into as many tasks as they ask for, so what a task holds does not grow.
    """
    e = edges.filter(F.col("edge_type") == edge_type).select("from_id", "to_id").dropna().distinct()
    n = F.col("n")
    met = e.groupBy("to_id").agg(F.count(F.lit(1)).cast("double").alias("n")).agg(F.sum(n * (n - 1) / 2)).first()[0] or 0
    least = int(e.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = 1 + int(met // (4 * PAIRS))
    parts = F.lit(many).cast("long")
    l = e.select(F.pmod(F.xxhash64("from_id"), parts).alias("part"), "to_id", F.col("from_id").alias("a")).repartition(max(least, many), "part", "to_id")
    r = e.select(F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"), "to_id", F.col("from_id").alias("b")).repartition(max(least, many), "part", "to_id")
    pairs = l.join(r.hint("merge"), ["part", "to_id"]).filter("a < b").select("a", "b").repartition(max(least, int(met // PAIRS)), "a")
    return pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"))


def contradictions(claims: DataFrame) -> DataFrame:
    """Subjects whose functional property has several values: claims (subject, property, value)."""
    per = claims.groupBy("subject", "property").agg(F.sort_array(F.collect_set("value")).alias("values"))
    return per.filter(F.size("values") > 1)


def rank_by_provenance(claims: DataFrame) -> DataFrame:
    """Values of a claim by the number of artifacts that carry them."""
    return claims.groupBy("subject", "property", "value").agg(F.countDistinct("artifact_id").alias("artifacts"))
