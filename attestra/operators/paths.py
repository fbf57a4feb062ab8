"""JSON documents as rows of dotted, indexed paths, and back, at any depth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..numbering import tasks
from ..scratch import Scratch

#: A step of a path: a quoted name, an index, or a plain name.
STEP = r'\["(?:[^"\\]|\\.)*"\]|\[\d+\]|[^.\[\]]+'
PLAIN = r'^[^.\[\]"\\\x00-\x1f]+$'
#: Levels that one pass takes apart.
LEVELS = 4
#: A name that JSON writes as it stands.
UNESCAPED = r'^[^"\\\x00-\x1f]+\z'


def _quoted(name: Column) -> Column:
    return F.to_json(F.array(name))


def flatten(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, path, value) of JSON text: one row a leaf, the value as JSON; an empty object or array is a leaf.

    Steps are joined by dots and indexes stand in brackets, as in ``lines[0].amount``; names that hold a dot, a bracket, a quote or
    nothing are quoted in brackets.  A document that is a leaf has the empty path.  Text that is no JSON has a null path and value;
    a null text gives no row.  Every few levels are written, so the source is parsed once and the work follows the data's own depth.
    """
    s = Scratch(docs.sparkSession, "flatten")
    now = docs.filter(F.col(text).isNotNull()).select(F.col(key).alias("_k"), F.lit("").alias("path"), F.try_parse_json(F.col(text)).alias("v"))
    found = []
    while True:
        for _ in range(LEVELS):
            # what has no parts goes on as it is
            parts = now.lateralJoin(docs.sparkSession.tvf.variant_explode_outer(F.col("v").outer()))
            name = F.col("key")
            named = F.when(name.rlike(PLAIN), F.concat(F.when(F.col("path") != "", ".").otherwise(""), name)).otherwise(_quoted(name))
            step = F.when(name.isNotNull(), named).when(F.col("pos").isNotNull(), F.concat(F.lit("["), F.col("pos"), F.lit("]"))).otherwise("")
            now = parts.select("_k", F.concat("path", step).alias("path"), F.when(F.col("pos").isNotNull(), F.col("value")).otherwise(F.col("v")).alias("v"))
        done = s.table(now.select("_k", "path", F.to_json("v").alias("value")))
        open_ = F.coalesce(F.col("value").rlike(r"^[\[{].") & ~F.col("value").isin("{}", "[]"), F.lit(False))
        leaf = done.filter(~open_)
        found.append(leaf.select(F.col("_k").alias(key), F.when(F.col("value").isNotNull(), F.col("path")).alias("path"), "value"))
        inner = done.filter(open_)
        if inner.isEmpty():
            break
        now = inner.select("_k", "path", F.parse_json("value").alias("v"))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def unflatten(leaves: DataFrame, key: str) -> DataFrame:
    """(key, text): the documents of :func:`flatten` again, names in order; built level by level from the deepest.

    Rows with a null path are left out.  A place that is named both as an object and as an array, or both as a leaf and a
    container, is no document: its text is null.  Arrays keep the order of their indexes and close gaps.
    """
    s = Scratch(leaves.sparkSession, "unflatten")
    steps = F.regexp_extract_all("path", F.lit(STEP), F.lit(0))
    rows = s.table(leaves.filter("path is not null").select(F.col(key), steps.alias("steps"), F.coalesce("value", F.lit("null")).alias("value"), F.lit(True).alias("sound")))
    parts = tasks(s.spark, rows.count())
    deepest = rows.agg(F.max(F.size("steps"))).first()[0] or 0
    built = None
    for depth in range(deepest, 0, -1):
        here = rows.filter(F.size("steps") == depth)
        if built is not None:
            here = here.unionByName(built)
        last = F.element_at("steps", -1)
        # a step in brackets is quoted or an index; most names are their own JSON
        quoted = F.startswith(last, F.lit('["'))
        index, inside = F.startswith(last, F.lit("[")) & ~quoted, F.substr(last, F.lit(2), F.length(last) - 2)
        odd = F.expr("substr(to_json(array(element_at(steps, -1))), 2, length(to_json(array(element_at(steps, -1)))) - 2)")
        name = F.when(quoted, inside).when(last.rlike(UNESCAPED), F.concat(F.lit('"'), last, F.lit('"'))).otherwise(odd)
        # the step itself comes last, so that it sorts nothing but tells places apart without another shuffle
        child = F.struct(F.when(index, inside.cast("long")).alias("at"), F.when(~index, name).alias("name"), F.col("value").alias("value"), last.alias("step"))
        g = here.groupBy(key, F.slice("steps", 1, depth - 1).alias("steps")).agg(F.sort_array(F.collect_list(child)).alias("c"), F.bool_and(index).alias("every"), F.bool_or(index).alias("some"), F.bool_and("sound").alias("inner"))
        g = g.withColumns({"n": F.size("c"), "places": F.size(F.array_distinct(F.transform("c", lambda x: x["step"])))})
        array = F.concat(F.lit("["), F.array_join(F.transform("c", lambda x: x["value"]), ","), F.lit("]"))
        object_ = F.concat(F.lit("{"), F.array_join(F.transform("c", lambda x: F.concat(x["name"], F.lit(":"), x["value"])), ","), F.lit("}"))
        sound = F.col("inner") & (F.col("every") == F.col("some")) & (F.col("n") == F.col("places"))
        built = s.table(g.select(key, "steps", F.when(F.col("every"), array).otherwise(object_).alias("value"), sound.alias("sound")), parts)
    top = rows.filter(F.size("steps") == 0)
    every = top if built is None else top.unionByName(built)
    return every.repartition(parts, key).groupBy(key).agg(F.when(F.bool_and("sound") & (F.count(F.lit(1)) == 1), F.first("value")).alias("text"))
