"""Entity resolution: normalised names, blocking keys, similarity of candidates, components, survivors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..components import connected_components
from ..scratch import Scratch

# Legal suffixes and words that say nothing about who a party is, and usual abbreviations.
SUFFIXES = ("inc", "incorporated", "corp", "corporation", "co", "company", "llc", "llp", "lp", "ltd", "limited", "plc", "gmbh", "ag", "sa", "sas", "srl", "bv", "nv", "pty", "pte", "kk", "ab", "as", "oy", "spa", "sl", "cv", "ev")
NOISE = ("the", "and", "of", "de", "du", "der", "den")
ABBREVIATIONS = {
    "intl": "international", "int": "international", "mfg": "manufacturing", "mfrs": "manufacturers", "svcs": "services", "svc": "service",
    "distr": "distribution", "dist": "distribution", "transp": "transport", "trans": "transport", "logist": "logistics", "log": "logistics",
    "ind": "industries", "indus": "industries", "bros": "brothers", "assoc": "associates", "natl": "national", "nat": "national",
    "amer": "american", "am": "american", "grp": "group", "hldgs": "holdings", "hldg": "holdings", "ent": "enterprises",
    "sys": "systems", "tech": "technologies", "whse": "warehouse", "frt": "freight", "shpg": "shipping",
}
MERGE, REVIEW = 0.86, 0.72


def normalise_name(c: Column) -> Column:
    """Lower case, & as and, no punctuation, runs of initials joined, abbreviations spelled out, suffixes and noise gone.

    A name that would lose every word keeps them.
    """
    text = F.regexp_replace(F.regexp_replace(F.lower(c), "&", " and "), r"(?U)[^\w\s]", " ")
    text = F.trim(F.regexp_replace(text, r"\s+", " "))
    joined = F.regexp_replace(text, r"(?<=\b[a-z]) (?=[a-z]\b)", "")
    table = F.create_map(*(F.lit(x) for kv in ABBREVIATIONS.items() for x in kv))
    words = F.transform(F.split(joined, " "), lambda w: F.coalesce(table[w], w))
    kept = F.array_join(F.filter(words, lambda w: ~w.isin(*SUFFIXES, *NOISE) & (w != "")), " ")
    return F.when(kept != "", kept).otherwise(text)


def is_truncated(c: Column) -> Column:
    """Whether the source cut a name off and marked it."""
    return F.coalesce(c.rlike(r"(?:\.\.\.|\u2026)\s*$"), F.lit(False))


def blocking_keys(norm: Column, postal: Column | None = None) -> Column:
    """First word's six letters, initials of four words, six letters without blanks, the postal key."""
    words = F.split(norm, " ")
    keys = [F.substring(words[0], 1, 6), F.when(F.size(words) > 1, F.array_join(F.transform(F.slice(words, 1, 4), lambda w: F.substring(w, 1, 1)), "")), F.substring(F.regexp_replace(norm, " ", ""), 1, 6)]
    if postal is not None:
        keys.append(F.concat(F.lit("pc:"), postal))
    return F.array_distinct(F.filter(F.array(*keys), lambda k: k.isNotNull() & (k != "")))


def _bigrams(c: Column) -> Column:
    return F.array_distinct(F.when(F.length(c) > 1, F.transform(F.sequence(F.lit(1), F.length(c) - 1), lambda i: F.substr(c, i, F.lit(2)))).otherwise(F.array().cast("array<string>")))


def similarity(a: Column, b: Column) -> Column:
    """0.6 of the Jaccard of words and 0.4 of the Dice of letter pairs; 1 when equal but for blanks."""
    x, y = F.array_distinct(F.split(a, " ")), F.array_distinct(F.split(b, " "))
    jaccard = F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y))
    p, q = _bigrams(a), _bigrams(b)
    pairs = F.size(p) + F.size(q)
    dice = F.when((F.size(p) > 0) & (F.size(q) > 0), 2 * F.size(F.array_intersect(p, q)) / pairs).otherwise(0.0)
    return F.when(F.regexp_replace(a, " ", "") == F.regexp_replace(b, " ", ""), 1.0).otherwise(F.round(0.6 * jaccard + 0.4 * dice, 4))


def one_edit_apart(a: Column, b: Column) -> Column:
    return F.levenshtein(a, b, 1) == 1


def candidate_pairs(names: DataFrame, slice_names: int = 400) -> DataFrame:
    """(a, b): every pair of distinct normalised names that share a block.

    Identical readings meet once, before any pairing.  A block is dealt into slices of about
    ``slice_names`` names by hash, and each two slices meet under a key of their own, so that
    a large block is paired in many tasks.
    """
    distinct = names.select("norm").distinct().filter("norm <> ''")
    keyed = distinct.select("norm", F.explode(blocking_keys(F.col("norm"))).alias("block"))
    size = keyed.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / slice_names).alias("slices"))
    dealt = keyed.join(size, "block").withColumn("own", F.pmod(F.xxhash64("norm"), F.col("slices")))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)))
    met = met.select("norm", "block", "own", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"))
    l, r = met.alias("l"), met.alias("r")
    same = (F.col("l.block") == F.col("r.block")) & (F.col("l.lo") == F.col("r.lo")) & (F.col("l.hi") == F.col("r.hi"))
    once = (F.col("l.own") != F.col("r.own")) | (F.col("l.lo") == F.col("l.hi"))  # two names of one slice meet under its own key only
    return l.join(r, same & once & (F.col("l.norm") < F.col("r.norm"))).select(F.col("l.norm").alias("a"), F.col("r.norm").alias("b")).distinct()


def score_pairs(pairs: DataFrame) -> DataFrame:
    """(a, b, score, decision): merge from 0.86, review from 0.72."""
    s = pairs.withColumn("score", similarity(F.col("a"), F.col("b")))
    return s.withColumn("decision", F.when(F.col("score") >= MERGE, "merge").when(F.col("score") >= REVIEW, "review").otherwise("different"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reached over edges (a, b), also of the roots; see :mod:`attestra.components`."""
    found = connected_components(edges, Scratch(edges.sparkSession, "entities"))
    return found.unionByName(found.select(F.col("root").alias("node"), "root").distinct())


def survivors(mentions: DataFrame, groups: DataFrame) -> DataFrame:
    """Of each group the most frequent spelling, longer first, then by name; with counts.  mentions (norm, raw), groups (norm, root)."""
    m = mentions.join(groups, "norm", "left").withColumn("root", F.coalesce("root", "norm"))
    per = m.groupBy("root", "raw").agg(F.count(F.lit(1)).alias("n"))
    best = per.groupBy("root").agg(F.min(F.struct((-F.col("n")).alias("c"), (-F.length("raw")).alias("l"), F.col("raw").alias("raw"))).alias("t"), F.sum("n").alias("mentions"), F.count(F.lit(1)).alias("spellings"))
    return best.select("root", F.col("t.raw").alias("survivor"), "mentions", "spellings")


# Fields whose readings name a party.
PARTY_FIELDS = ("brand_name", "manufacturer_name", "supplier_name", "vendor_name", "customer_name", "dealer_name", "payer_name", "payee_name", "seller_name", "specifier_name")


def party_of_reading(readings: DataFrame, parties: DataFrame) -> DataFrame:
    """``readings`` with canonical_name and party_key of the party that a reading spells, on party fields only.

    ``parties`` is (ordinal, party_key, canonical_name, name_variants); of several parties with one spelling, case and outer
    blanks aside, the first wins.  A field may be a header's or a line's.
    """
    folded = lambda c: F.lower(F.trim(c))
    spelt = parties.select("ordinal", "party_key", "canonical_name", F.posexplode(F.concat(F.array("canonical_name"), F.coalesce("name_variants", F.array().cast("array<string>")))).alias("place", "spelling"))
    index = spelt.filter("spelling is not null and spelling <> ''").groupBy(folded(F.col("spelling")).alias("_spelt")).agg(F.min(F.struct("ordinal", "place", "party_key", "canonical_name")).alias("_party"))
    base = F.regexp_replace("field", r"^(header\.|lines\[.*\]\.)", "")
    named = base.isin(*PARTY_FIELDS) & (F.coalesce(F.col("reading"), F.lit("")) != "")
    out = readings.withColumn("_spelt", F.when(named, folded(F.col("reading")))).join(index, "_spelt", "left")
    return out.select(*readings.columns, F.col("_party.canonical_name").alias("canonical_name"), F.col("_party.party_key").alias("party_key"))
