"""Quality rules: a learned decision list of threshold conjunctions, native to Spark SQL.

Statistics are column expressions over each whole text.  Labelled rows are cut into
bins by quantile and counted into cells; sequential covering then grows a conjunction by
FOIL gain on one part of the cells, prunes it on the other, takes away what it covers
and starts again.  Each step is one small aggregation; the driver sees counts by
(statistic, bin).  The list becomes one ordered ``CASE WHEN`` expression.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch

WORD_GAP = r"[\x20\x09-\x0D]+"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with value computed once: a lambda binds it."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column) -> Column:
    """Words inside three-word windows that occur at least twice in the text."""

    def of(w: Column) -> Column:
        grams = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.struct(F.xxhash64(w[i], w[i + 1], w[i + 2]).alias("h"), F.struct(w[i], w[i + 1], w[i + 2]).alias("g"), i.alias("i")))
        return F.when(F.size(w) < 3, F.lit(0)).otherwise(_let(F.array_sort(grams), spread))

    def spread(g: Column) -> Column:
        # sorted by hash, then by the words themselves, which decide
        same = lambda y, x: F.coalesce((y["h"] == x["h"]) & (y["g"] == x["g"]), F.lit(False))
        again = F.filter(g, lambda x, k: same(F.get(g, k - 1), x) | same(F.get(g, k + 1), x))
        return _let(F.array_sort(F.transform(again, lambda x: x["i"])), size)

    def size(at: Column) -> Column:
        gaps = F.zip_with(at, F.slice(at, 2, F.greatest(F.size(at), F.lit(1))), lambda a, b: F.least(b - a, F.lit(3)))
        return F.aggregate(gaps, F.lit(0), lambda total, x: total + x)

    return _let(words, of).cast("long")


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: ``id`` and counts over the whole text; a null text is empty."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return base.select(
        "id",
        _let(
            F.array_remove(F.split("text", WORD_GAP), ""),
            lambda w: F.struct(F.size(w).cast("long").alias("n_words"), F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"), _repeat_words(w).alias("n_repeat_words"), F.size(F.array_distinct(w)).cast("long").alias("n_distinct")),
        ).alias("w"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count("text", F.lit("[A-Z]")).cast("long").alias("n_upper"),
        F.regexp_count("text", F.lit("!")).cast("long").alias("n_bangs"),
        _let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))).alias("l"),
    ).select("id", "w.*", "n_symbols", "n_upper", "n_bangs", "l.*")


def ratios() -> dict[str, Column]:
    """The statistics rules are learned over, from the counts of :func:`text_statistics`."""
    words, chars, lines = (F.greatest(F.col(c), F.lit(1)).cast("double") for c in ("n_words", "word_chars", "n_lines"))
    return {
        "words": F.col("n_words").cast("double"),
        "word_length": F.col("word_chars") / words,
        "symbols_per_word": F.col("n_symbols") / words,
        "upper_share": F.col("n_upper") / chars,
        "bangs_per_word": F.col("n_bangs") / words,
        "repeated_words": F.col("n_repeat_words") / words,
        "repeated_lines": F.col("n_dup_lines") / lines,
        "distinct_words": F.col("n_distinct") / words,
    }


@dataclass(frozen=True)
class Condition:
    """statistic > cut, or statistic <= cut."""

    name: str
    above: bool
    cut: float
    bin: int  # the cut's number among the statistic's cuts

    def column(self) -> Column:
        return F.col(self.name) > self.cut if self.above else F.col(self.name) <= self.cut

    def on_bins(self) -> Column:
        return F.col(f"b_{self.name}") > self.bin if self.above else F.col(f"b_{self.name}") <= self.bin

    def __str__(self) -> str:
        return f"{self.name} {'>' if self.above else '<='} {self.cut:.6g}"


Rule = tuple[Condition, ...]


def _all(conditions: Rule | list[Condition]) -> Column:
    return reduce(lambda a, b: a & b, (c.on_bins() for c in conditions), F.lit(True))


def _gain(bad: float, good: float, bad0: float, good0: float) -> float:
    """FOIL's information gain with Laplace counts."""
    return bad * (math.log2((bad + 1) / (bad + good + 2)) - math.log2((bad0 + 1) / (bad0 + good0 + 2)))


def learn_rules(
    labelled: DataFrame,
    names: list[str],
    scratch: Scratch,
    label: str = "y",
    bins: int = 24,
    max_rules: int = 8,
    max_conditions: int = 3,
    least_precision: float = 0.9,
    least_covered: int = 8,
) -> list[Rule]:
    """A decision list for label 0 over rows (names..., label); no labels of either kind give no rules.

    ``labelled`` also carries ``part``, 0 to 2: parts 0 and 1 grow rules, part 2 prunes them.
    """
    shares = [(i + 1) / (bins + 1) for i in range(bins)] + [0.005, 0.01, 0.02, 0.98, 0.99, 0.995]
    found = labelled.agg(*(F.percentile_approx(n, shares, 10_000).alias(n) for n in names)).first()
    cuts = {n: sorted(set(found[n])) for n in names if found[n]}
    if not cuts:
        return []
    number = {n: reduce(lambda a, b: a + b, [(F.col(n) > c).cast("int") for c in cs]) for n, cs in cuts.items()}  # of cuts below the value
    cells = labelled.select((F.col("part") < 2).alias("grow"), F.col(label).alias("y"), *(c.alias(f"b_{n}") for n, c in number.items()))
    cells = scratch.table(cells.groupBy("grow", *(f"b_{n}" for n in cuts)).agg(F.sum(1 - F.col("y")).alias("bad"), F.sum("y").alias("good")))
    rules: list[Rule] = []
    for _ in range(max_rules):
        left = cells.filter(~reduce(lambda a, b: a | b, (_all(r) for r in rules), F.lit(False)))
        grown: list[Condition] = []
        while len(grown) < max_conditions:
            rows = left.filter(F.col("grow") & _all(grown)).select("bad", "good", F.explode(F.array(*(F.struct(F.lit(n).alias("name"), F.col(f"b_{n}").alias("bin")) for n in cuts))).alias("s"))
            counts: dict[str, dict[int, tuple[float, float]]] = {}
            for r in rows.groupBy("s.name", "s.bin").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).collect():
                counts.setdefault(r.name, {})[r.bin] = (r.bad, r.good)
            best = _best(counts, cuts, least_covered)
            if best is None:
                break
            grown.append(best)
        if not grown:
            break
        held = left.filter(~F.col("grow"))
        seen = held.agg(*(F.sum(F.when(_all(grown[: k + 1]), F.col(c)).otherwise(0)).alias(f"{c}{k}") for k in range(len(grown)) for c in ("bad", "good"))).first()
        scored = [((seen[f"bad{k}"] or 0), (seen[f"good{k}"] or 0), k) for k in range(len(grown))]
        worth, k = max(((b - g) / (b + g + 1), -k) for b, g, k in scored)
        kept = tuple(grown[: 1 - k])
        bad, good, _ = scored[-k]
        if (bad + 1) / (bad + good + 2) < least_precision:
            break
        rules.append(kept)
    return _centred(rules, labelled)


def _centred(rules: list[Rule], labelled: DataFrame) -> list[Rule]:
    """The same rules with each cut moved half-way to the next labelled value, so that it leaves a margin on both sides."""
    flat = [c for r in rules for c in r]
    if not flat:
        return rules
    ends = labelled.agg(*(f(F.when(side, F.col(c.name))).alias(f"{e}{i}") for i, c in enumerate(flat) for e, f, side in (("low", F.max, F.col(c.name) <= c.cut), ("high", F.min, F.col(c.name) > c.cut)))).first()
    moved = iter(Condition(c.name, c.above, (ends[f"low{i}"] + ends[f"high{i}"]) / 2 if ends[f"high{i}"] is not None and ends[f"low{i}"] is not None else c.cut, c.bin) for i, c in enumerate(flat))
    return [tuple(next(moved) for _ in r) for r in rules]


def _best(counts: dict, cuts: dict[str, list[float]], least: int) -> Condition | None:
    """The condition of most gain; ties go to the first name and cut."""
    best, most = None, 1e-9
    for n in sorted(counts):
        have = counts[n]
        bad0, good0 = (sum(v[i] for v in have.values()) for i in (0, 1))
        if not good0:
            return None  # nothing is left to part
        bad = good = 0.0
        for b, cut in enumerate(cuts[n]):  # bin b holds values over b cuts: those <= cut b are bins 0..b
            x = have.get(b, (0, 0))
            bad, good = bad + x[0], good + x[1]
            for above, p, q in ((False, bad, good), (True, bad0 - bad, good0 - good)):
                if p >= least and q < good0 and (g := _gain(p, q, bad0, good0)) > most:
                    best, most = Condition(n, above, cut, b), g
    return best


def verdict(rules: list[Rule]) -> Column:
    """The first rule that fires, as text, else null: an ordered conditional expression over the ratios."""
    out = F.lit(None).cast("string")
    for r in reversed(rules):
        out = F.when(reduce(lambda a, b: a & b, (c.column() for c in r)), " and ".join(map(str, r))).otherwise(out)
    return out


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """One row per document row: (id_col, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, rule).

    base_failed: under 50 words, or over half of the words repeated.  kept: not
    base_failed and no learned rule fires; ``rule`` names the first that fires.  Null
    texts are empty and fail the base.  Labels other than 0 and 1 are ignored, of
    several for one id the largest holds; without labels there are no rules.
    """
    s = Scratch(docs.sparkSession, "rules")
    stats = s.table(text_statistics(docs, id_col, text_col)).withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    full = stats.select("*", *(c.alias(n) for n, c in ratios().items()))
    known = labels.filter(F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("y"))
    part = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("part")), F.lit(3))
    labelled = s.table(full.filter(~F.col("base_failed")).join(known, "id").select(*ratios(), "y", part.alias("part")))
    rules = learn_rules(labelled, list(ratios()), s)
    out = full.withColumn("rule", verdict(rules))
    kept = ~F.col("base_failed") & F.col("rule").isNull()
    return out.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "rule")
