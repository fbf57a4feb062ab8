"""Mixing sources to target weights by iterative proportional fitting, native to Spark SQL.

Documents are counted into cells (source, language, topic) of tokens.  A cell's kept
tokens start at its share of the budget and are raked in turn to each marginal's
targets until they settle.  No cell can keep more than it has: a marginal's scale is the one
that meets its target with the cells that reach their tokens held there, and a target
above what its value has is cut to that and the rest raised in proportion.  A document is kept
with probability kept tokens / tokens of its cell.  The draw is a hash of the id, so it
repeats on every run and every layout.

Cells are as many as distinct triples.  Up to ``max_cells`` they are raked as plain numbers on
the driver; beyond that by windows over the cell table.  Both ways compute the same weights.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import Scratch
from .names import free_name

AXES = ("source", "lang", "topic")
#: (topic, marks) in order: the topic whose marks occur most often in the text, ties to the first; prose has none.
TOPICS = (
    ("licence", ("icense", "icence", "opyright", "arranty")),
    ("contact", ("@", "(")),
    ("table", ("|",)),
    ("markup", ("<", "{")),
    ("loud", ("!",)),
    ("question", ("?",)),
)
#: Kept tokens are settled when no cell moves by more than this share of its tokens.
SETTLED = 1e-12


def topic_of(text: Column, topics: tuple[tuple[str, tuple[str, ...]], ...] = TOPICS) -> Column:
    """The topic whose marks occur most often, the first of several; ``prose`` without a mark."""

    def count(mark: str) -> Column:
        without = F.replace(text, F.lit(mark), F.lit(""))
        # most texts lack most marks, and looking is cheaper than replacing
        return F.when(F.contains(text, F.lit(mark)), (F.octet_length(text) - F.octet_length(without)) / len(mark.encode())).otherwise(0.0)

    found = F.array(*(F.struct(reduce(lambda a, b: a + b, map(count, marks)).alias("n"), F.lit(-k).alias("k"), F.lit(name).alias("name")) for k, (name, marks) in enumerate(topics)))
    return F.transform(F.array(F.array_max(found)), lambda x: F.when(x["n"] > 0, x["name"]).otherwise("prose"))[0]


def draw(key: Column, seed: str) -> Column:
    """A uniform number in [0, 1) from the id, the same in any engine with md5."""
    hexed = F.substr(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary")), F.lit(1), F.lit(12))
    return F.conv(hexed, 16, 10).cast("double") / float(16**12)


def capped_scale(x: np.ndarray, cap: np.ndarray, group: np.ndarray, target: np.ndarray) -> np.ndarray:
    """min(cap, f * x), with f of each group such that its sum is the group's target, at most the sum of its caps.

    Any number of capped cells bounds f from below, and the right number reaches it, so f is the largest bound.
    """
    live = np.flatnonzero(x > 0)
    order = live[np.lexsort((cap[live] / x[live], group[live]))]
    g, first = group[order], np.searchsorted(group[order], np.arange(len(target)))
    before = np.cumsum(cap[order]) - cap[order]  # caps of the cells that are capped sooner
    before -= np.append(before, 0)[first][g]
    after = np.cumsum(x[order][::-1])[::-1]
    ends = np.searchsorted(g, np.arange(len(target)), "right")
    after = after - np.append(after, 0)[ends][g]
    f = np.full(len(target), -np.inf)
    np.maximum.at(f, g, (target[g] - before) / after)
    out = np.zeros_like(x)
    out[live] = np.minimum(cap[live], np.maximum(f, 0)[group[live]] * x[live])
    return out


def reachable(wanted: dict[str, float], tokens: dict[str, float], budget: float) -> dict[str, float]:
    """Token targets by value: ``budget`` in the wanted shares, none above its tokens, the rest raised in proportion."""
    names = sorted(tokens)
    share = np.array([max(float(wanted.get(k, 0.0)), 0.0) for k in names])
    cap = np.array([float(tokens[k]) for k in names])
    if not share.sum():
        return dict.fromkeys(names, 0.0)
    some = min(budget, float(cap[share > 0].sum()))
    return dict(zip(names, capped_scale(share / share.sum() * some, cap, np.zeros(len(names), int), np.array([some])).tolist()))


def rake(cells: list[tuple], targets: list[dict[str, float]], rounds: int) -> list[float]:
    """Kept tokens of cells (axis values..., tokens): scaled to each marginal in turn until settled."""
    cap = np.array([float(c[-1]) for c in cells])
    x = cap * (sum(targets[0].values()) / max(cap.sum(), 1))
    axes = []
    for k, target in enumerate(targets):
        values, group = np.unique(np.array([c[k] for c in cells], object).astype(str), return_inverse=True)
        axes.append((group, np.array([target.get(v, 0.0) for v in values])))
    for _ in range(rounds):
        before = x
        for group, target in axes:
            x = capped_scale(x, cap, group, target)
        if not len(x) or np.max(np.abs(x - before) / cap) <= SETTLED:
            break
    return x.tolist()


def _rake_table(cells: DataFrame, targets: list[DataFrame], rounds: int, start: float, s: Scratch) -> DataFrame:
    """The same fitting over a cell table of any size: (axes, tokens) -> (axes, tokens, kept); targets (value, target)."""
    now = cells.withColumn("kept", F.col("tokens") * F.lit(start))
    for _ in range(rounds):
        before = now
        for axis, t in zip(AXES, targets):
            whole = Window.partitionBy(axis)
            ordered = whole.orderBy(F.when(F.col("kept") > 0, F.col("tokens") / F.col("kept")).asc_nulls_last(), *(a for a in AXES if a != axis))
            live = F.when(F.col("kept") > 0, F.col("tokens").cast("double"))
            sums = now.withColumns({"sooner": F.coalesce(F.sum(live).over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)), "rest": F.sum("kept").over(ordered.rowsBetween(0, Window.unboundedFollowing))})
            bound = F.when(F.col("kept") > 0, (F.coalesce("target", F.lit(0.0)) - F.col("sooner")) / F.col("rest"))
            scaled = sums.join(t.withColumnRenamed("value", axis), axis, "left").withColumn("f", F.max(bound).over(whole))
            now = scaled.select(*AXES, "tokens", F.coalesce(F.least(F.col("tokens").cast("double"), F.greatest("f", F.lit(0.0)) * F.col("kept")), F.lit(0.0)).alias("kept"))
        now = s.table(now)
        moved = now.join(before.withColumnRenamed("kept", "was"), [*AXES, "tokens"]).agg(F.max(F.abs(F.col("kept") - F.col("was")) / F.col("tokens"))).first()[0]
        if moved is None or moved <= SETTLED:
            break
    return now


def _keys(source_col: str, lang_col: str, text: Column, topic: Column | None) -> dict[str, Column]:
    plain = {a: F.coalesce(F.col(c).cast("string"), F.lit("")) for a, c in (("source", source_col), ("lang", lang_col))}
    return plain | {"topic": F.coalesce(topic.cast("string"), F.lit("")) if topic is not None else topic_of(text)}


def fit_cells(cells: DataFrame, s: Scratch, targets: dict[str, dict[str, float]] | None = None, power: float = 0.5, budget: float = 0.5, rounds: int = 500, max_cells: int = 50_000) -> tuple[DataFrame, bool]:
    """((axes, tokens, kept), whether they are at most ``max_cells``) of a cell table (axes, tokens > 0)."""
    spark, given = cells.sparkSession, targets or {}
    rows = cells.limit(max_cells + 1).collect()
    small = len(rows) <= max_cells
    if small:
        plain = sorted(tuple(r) for r in rows)
        total = sum(r[-1] for r in plain)
        aims = []
        for k, axis in enumerate(AXES):
            have: dict[str, float] = {}
            for r in plain:
                have[r[k]] = have.get(r[k], 0) + r[-1]
            aims.append(reachable(given.get(axis) or {v: (n / total) ** power for v, n in have.items()}, have, budget * total))
        kept = rake(plain, aims, rounds)
        return spark.createDataFrame([(*r, x) for r, x in zip(plain, kept)], "source string, lang string, topic string, tokens long, kept double"), True
    total = cells.agg(F.sum("tokens")).first()[0]
    aims = []
    for axis in AXES:
        have = cells.groupBy(F.col(axis).alias("value")).agg(F.sum("tokens").cast("double").alias("tokens"))
        if axis in given:
            have = have.join(spark.createDataFrame(list(given[axis].items()), "value string, share double"), "value", "left").na.fill(0.0, ["share"])
        else:
            have = have.withColumn("share", F.pow(F.col("tokens") / total, F.lit(power)))
        have = s.table(have)
        norm, some = have.agg(F.sum("share"), F.sum(F.when(F.col("share") > 0, F.col("tokens")))).first()
        some = min(budget * total, some or 0.0)
        # one window over an axis's values: they are far fewer than cells
        ordered = Window.orderBy(F.col("tokens") / F.col("share"), "value")
        sums = have.filter("share > 0").withColumn("x", F.col("share") / (norm or 1.0) * some).withColumns({"sooner": F.coalesce(F.sum("tokens").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)), "rest": F.sum("x").over(ordered.rowsBetween(0, Window.unboundedFollowing))})
        f = sums.agg(F.max((F.lit(some) - F.col("sooner")) / F.col("rest"))).first()[0] or 0.0
        aims.append(s.table(sums.select("value", F.least("tokens", F.col("x") * f).alias("target"))))
    return _rake_table(cells, aims, rounds, (aims[0].agg(F.sum("target")).first()[0] or 0.0) / total, s), False


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    lang_col: str = "lang",
    topic: Column | None = None,
    targets: dict[str, dict[str, float]] | None = None,
    power: float = 0.5,
    budget: float = 0.5,
    rounds: int = 500,
    seed: str = "mix",
    max_cells: int = 50_000,
) -> DataFrame:
    """The sampled rows of ``docs``, every column, with ``n_tokens``, ``mix_topic``, ``mix_weight`` and ``mix_probability``.

    ``targets`` may give the shares of an axis (source, lang, topic); other axes aim at
    their token shares raised to ``power``.  ``budget``, at most 1, is the share of all tokens to
    keep; a document's probability is its cell's kept tokens over its tokens, to nine digits, and
    the weight is the cell's share of the kept tokens.  Null sources and languages are the value
    ``""``; documents without tokens (null or empty texts) are in no cell and are not
    sampled; long texts count whole; rows of one id share one draw.  An empty table gives no
    rows.  Where ``docs`` has a column of a result's name, it stays and the result's name ends
    in an underscore.
    """
    s = Scratch(docs.sparkSession, "mixing")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    tokens = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    keys = _keys(source_col, lang_col, text, topic)
    counted = docs.select(*(c.alias(a) for a, c in keys.items()), tokens.alias("tokens")).groupBy(*AXES).agg(F.sum("tokens").alias("tokens"))
    cells = s.table(counted.filter("tokens > 0"))
    fitted, small = fit_cells(cells, s, targets, power, budget, rounds, max_cells)
    taken, name = list(docs.columns), {}
    for n in ("n_tokens", "mix_topic", "mix_weight", "mix_probability", "mix_source", "mix_lang"):
        name[n] = free_name(n, taken)
        taken.append(name[n])
    kept = fitted.agg(F.sum("kept")).first()[0] or 1.0
    p = F.round(F.col("kept") / F.col("tokens"), 9)
    on = {"source": name["mix_source"], "lang": name["mix_lang"], "topic": name["mix_topic"]}
    chance = fitted.select(*(F.col(a).alias(c) for a, c in on.items()), (F.col("kept") / kept).alias(name["mix_weight"]), p.alias(name["mix_probability"]))
    if small:
        chance = F.broadcast(chance)  # at most max_cells rows
    keyed = docs.withColumns({name["n_tokens"]: tokens} | {on[a]: c for a, c in keys.items()})
    # one test of both sides stays above the join, so that words are counted once
    chosen = draw(F.col(id_col), seed) < F.when(F.col(name["n_tokens"]) > 0, F.col(name["mix_probability"])).otherwise(0.0)
    out = keyed.join(chance, list(on.values())).filter(chosen)
    return out.select(*docs.columns, *(name[n] for n in ("n_tokens", "mix_topic", "mix_weight", "mix_probability")))


def mixing_report(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, power: float = 0.5, budget: float = 0.5, source_col: str = "source", lang_col: str = "lang", text_col: str = "text", topic: Column | None = None, rounds: int = 500, max_cells: int = 50_000) -> DataFrame:
    """(axis, value, tokens, kept, share): what the fit gives each value; a share off its target is one that no sample can meet."""
    s = Scratch(docs.sparkSession, "mixing")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keys = _keys(source_col, lang_col, text, topic)
    counted = docs.select(*(c.alias(a) for a, c in keys.items()), F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("tokens"))
    cells = s.table(counted.groupBy(*AXES).agg(F.sum("tokens").alias("tokens")).filter("tokens > 0"))
    fitted, _ = fit_cells(cells, s, targets, power, budget, rounds, max_cells)
    total = fitted.agg(F.sum("kept")).first()[0] or 1.0
    rows = [fitted.groupBy(F.lit(a).alias("axis"), F.col(a).alias("value")).agg(F.sum("tokens").alias("tokens"), F.sum("kept").alias("kept")) for a in AXES]
    return reduce(DataFrame.unionByName, rows).withColumn("share", F.col("kept") / total)


def mixing_sql(table: str, power: float, budget: float, rounds: int, seed: str) -> str:
    """DuckDB SQL for the rows of :func:`mix` over ``table``: a recursive table of the cells, a round a step."""
    count = lambda m: f"(len(t) - len(replace(t, '{m}', ''))) / {len(m)}"
    tries = [f"struct_pack(n := {' + '.join(map(count, marks))}, k := {-k}, name := '{name}')" for k, (name, marks) in enumerate(TOPICS)]
    parts = [
        rf"counted AS (SELECT *, list_max([{', '.join(tries)}]) AS best, coalesce(source, '') AS s_, coalesce(lang, '') AS l_, CAST(len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens FROM (SELECT *, coalesce(text, '') AS t FROM {table}))",
        "keyed AS (SELECT * EXCLUDE (best), CASE WHEN best.n > 0 THEN best.name ELSE 'prose' END AS mix_topic FROM counted)",
        "cells AS MATERIALIZED (SELECT s_ AS source, l_ AS lang, mix_topic AS topic, CAST(sum(n_tokens) AS DOUBLE) AS tokens FROM keyed WHERE n_tokens > 0 GROUP BY ALL)",
        f"b AS (SELECT {budget} * sum(tokens) AS budget, sum(tokens) AS total FROM cells)",
    ]
    sums = "coalesce(sum(CASE WHEN {x} > 0 THEN tokens END) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sooner, sum({x}) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest"
    for a in AXES:
        parts += [
            f"m_{a} AS (SELECT {a}, sum(tokens) AS tokens FROM cells GROUP BY 1)",
            f"x_{a} AS (SELECT {a}, tokens, budget * share / sum(share) OVER () AS x, budget FROM (SELECT {a}, tokens, budget, pow(tokens / total, {power}) AS share FROM m_{a}, b))",
            f"y_{a} AS (SELECT *, {sums.format(x='x')} FROM x_{a} WINDOW w AS (ORDER BY tokens / x, {a}))",
            f"t_{a} AS MATERIALIZED (SELECT {a}, least(tokens, x * max((budget - sooner) / rest) OVER ()) AS target FROM y_{a})",
        ]
    step = "fit"
    for a in AXES:
        others = ", ".join(o for o in AXES if o != a)
        step = f"""(SELECT r, source, lang, topic, tokens, least(tokens, greatest(f, 0) * x) AS x FROM (SELECT *, max((target - sooner) / rest) OVER (PARTITION BY {a}) AS f FROM
 (SELECT q.*, target, {sums.format(x='x')} FROM {step} q JOIN t_{a} USING ({a}) WINDOW w AS (PARTITION BY q.{a} ORDER BY tokens / x, {others}))))"""
    parts.append(f"fit AS (SELECT 0 AS r, source, lang, topic, tokens, tokens * {budget} AS x FROM cells UNION ALL SELECT r + 1, source, lang, topic, tokens, x FROM {step} WHERE r < {rounds})")
    parts.append(f"last AS (SELECT *, x / sum(x) OVER () AS w, round(x / tokens, 9) AS p FROM fit WHERE r = {rounds})")
    u = f"CAST(('0x' || substr(md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12)) AS BIGINT) / {float(16**12)!r}"
    parts.append("chosen AS (SELECT k.*, p, w FROM keyed k JOIN last c ON k.s_ = c.source AND k.l_ = c.lang AND k.mix_topic = c.topic WHERE n_tokens > 0)")
    return f"WITH RECURSIVE {', '.join(parts)} SELECT doc_id, n_tokens, mix_topic, round(w, 9) AS mix_weight, p AS mix_probability FROM chosen WHERE {u} < p"
