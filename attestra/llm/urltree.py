"""URL filters by a tree of path templates, native to Spark SQL.

Paths are counted once by (host, path).  Level by level, each host's segments are
generalised: a segment stays literal if it recurs and is no number-like token, else it
becomes ``*``; literal siblings that carry labels and whose block rates do not differ
from the pooled rate of their branch by ``z`` standard errors merge into ``*`` as well.
A template is rejected if its labelled purity, smoothed towards a prior, reaches the
limit.  Explicit host rules label the pages they fit, and outrank the tree.

Every level is a partial aggregation and a join by branch, which Spark splits for hot
hosts.  Levels go on while a branch holds several paths and rows enough for a segment to
recur; each is written, so the plan does not grow with the depth.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch

#: (verdict, host, path) of the explicit rules.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host after the first ``://``, A-Z lower-cased, and the path; both empty without ``://`` or for null."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    at = F.locate("://", text)
    rest = F.when(at > 0, F.substr(text, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.char_length(host) + 1), r"^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path


def rule_columns(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...]) -> tuple[Column, Column]:
    """(rule text, its verdict) of the longest rule that fits, else nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1:])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def _variable(seg: Column) -> Column:
    """Whether a segment is a number-like token."""
    return seg.rlike(r"^[0-9]+([._-].*)?$|^[0-9a-fA-F]{8,}$|[0-9]{4,}|%[0-9a-fA-F]{2}")


def _templates(paths: DataFrame, s: Scratch, least_rows: int, z: float) -> DataFrame:
    """(host, path, n, n_labelled, n_bad) -> the same with ``template``; each level is written, as the next reads it twice."""
    now = s.table(paths.withColumn("segs", F.filter(F.split("path", "/"), lambda x: x != "")).withColumn("template", F.lit("")))
    done, k = [], 0
    while True:
        branch = s.table(now.groupBy("host", "template").agg(F.sum("n").alias("b_n"), (F.min("segs") == F.max("segs")).alias("b_one")))
        seen = now.join(branch, ["host", "template"])
        # of a branch with too few rows nothing recurs, and of one path nothing has a sibling: all levels below are known
        known = (F.size("segs") <= k) | (F.col("b_n") < least_rows) | F.col("b_one")
        below = F.transform(F.slice("segs", F.lit(k + 1), F.size("segs")), lambda x: F.concat(F.lit("/"), F.when((F.col("b_n") < least_rows) | _variable(x), "*").otherwise(x)))
        done.append(s.table(seen.filter(known).withColumn("template", F.concat("template", F.array_join(below, ""))).drop("segs", "b_n", "b_one")))
        before, now = now, s.table(seen.filter(~known).drop("b_n", "b_one"))
        s.drop(before, branch)
        if now.isEmpty():
            return s.together(done)
        seg = F.get("segs", F.lit(k))
        marked = now.withColumn("seg", seg).withColumn("variable", _variable(seg))
        kids = marked.filter(F.col("seg").isNotNull() & ~F.col("variable")).groupBy("host", "template", "seg").agg(*(F.sum(c).alias(f"k_{c}") for c in ("n", "n_labelled", "n_bad")))
        kids = s.table(kids)  # written like the pooled rates, so that the joins can split a hot host
        pooled = kids.groupBy("host", "template").agg(F.sum("k_n_labelled").alias("p_labelled"), F.sum("k_n_bad").alias("p_bad"))
        pooled = s.table(pooled)
        rate = (F.col("p_bad") + 1) / (F.col("p_labelled") + 2)
        off = F.abs((F.col("k_n_bad") + rate) / (F.col("k_n_labelled") + 1) - rate)
        alike = (F.col("k_n_labelled") > 0) & (F.col("p_labelled") > F.col("k_n_labelled")) & (off <= z * F.sqrt(rate * (1 - rate) / (F.col("k_n_labelled") + 1)))
        literal = kids.join(pooled, ["host", "template"]).filter((F.col("k_n") >= least_rows) & ~alike).select("host", "template", "seg", F.lit(True).alias("literal"))
        joined = marked.join(literal, ["host", "template", "seg"], "left")
        step = F.when(F.coalesce("literal", F.lit(False)), F.concat(F.lit("/"), F.col("seg"))).otherwise("/*")
        before, now = now, s.table(joined.withColumn("template", F.concat("template", step)).drop("seg", "variable", "literal"))
        s.drop(before, kids, pooled)
        k += 1


def url_verdicts(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: tuple[tuple[str, str, str], ...] = RULES,
    least_rows: int = 5,
    z: float = 1.64,
    prior: float = 0.1,
    strength: float = 4.0,
    limit: float = 0.5,
) -> DataFrame:
    """One row per page row: (id_col, host, path, rule, verdict, template, purity).

    ``verdict`` is the rule's if one fits, else block where the smoothed purity
    (n_bad + strength * prior) / (n_labelled + strength) of the page's template is at least
    ``limit``, else allow.  Pages with a rule are the labelled ones.  A null url, or one
    without ``://``, has empty host and path and is judged by that template.  Repeated
    rows repeat; an empty table gives no rows; only two columns are read.
    """
    host, path = host_and_path(F.col(url_col))
    base = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    name, given = rule_columns(F.col("host"), F.col("path"), rules)
    ruled = base.withColumns({"rule": name, "given": given})
    paths = ruled.groupBy("host", "path").agg(F.count("*").alias("n"), F.count("given").alias("n_labelled"), F.sum(F.when(F.col("given") == "block", 1).otherwise(0)).alias("n_bad"))
    s = Scratch(pages.sparkSession, "urltree")
    tree = _templates(paths, s, least_rows, z)
    purity = (F.col("t_bad") + strength * prior) / (F.col("t_labelled") + strength)
    judged = tree.groupBy("host", "template").agg(F.sum("n_labelled").alias("t_labelled"), F.sum("n_bad").alias("t_bad"))
    judged = s.table(judged.select("host", "template", purity.alias("purity")))
    by_path = tree.select("host", "path", "template").join(judged, ["host", "template"])
    out = ruled.join(by_path, ["host", "path"])
    verdict = F.coalesce("given", F.when(F.col("purity") >= limit, "block").otherwise("allow"))
    return out.select(id_col, "host", "path", "rule", verdict.alias("verdict"), "template", "purity")


def template_report(judged: DataFrame) -> DataFrame:
    """(host, template, n_pages, n_blocked, purity) of :func:`url_verdicts` rows."""
    blocked = reduce(lambda a, b: a + b, [F.when(F.col("verdict") == "block", 1).otherwise(0)])
    return judged.groupBy("host", "template").agg(F.count("*").alias("n_pages"), F.sum(blocked).alias("n_blocked"), F.max("purity").alias("purity"))
