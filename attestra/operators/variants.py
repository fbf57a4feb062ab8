"""Misread spellings: names one letter apart by deletion neighbourhoods, and their absorption into far more common names."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..numbering import tasks
from ..scratch import Scratch

#: Shortest name that one letter may change.
MIN_NAME = 6
#: Names above which a word is common: such words are few and go to every task, their names are not gathered in one.
COMMON = 10_000
ONE_EDIT, FRAGMENT = "one_character_variant_of_a_far_more_common_name", "every_word_appears_in_a_far_more_common_name"


def one_edit_pairs(names: DataFrame, name: str) -> DataFrame:
    """(a, b), a < b: all pairs of distinct names that one inserted, deleted or changed letter parts.

    Each name is keyed by what it leaves without its i-th letter.  Two names of one place
    and rest differ in that letter alone, and a name that is another's rest lacks one letter: every
    pair that meets is a result, so no block of names is paired.  Null and equal names give none.
    """
    n = names.select(F.col(name).alias("n")).filter("n is not null").distinct()
    cut = n.filter("length(n) > 0").select("n", F.explode(F.sequence(F.lit(1), F.length("n"))).alias("i"))
    cut = cut.select("n", "i", F.concat(F.expr("left(n, i - 1)"), F.expr("substr(n, i + 1)")).alias("rest"))
    parts = tasks(names.sparkSession, n.agg(F.sum(F.length("n"))).first()[0] or 0)
    dealt = cut.repartition(parts, "rest", "i")
    l, r = dealt.alias("l"), dealt.alias("r")
    changed = l.join(r, (F.col("l.rest") == F.col("r.rest")) & (F.col("l.i") == F.col("r.i")) & (F.col("l.n") < F.col("r.n"))).select(F.col("l.n").alias("x"), F.col("r.n").alias("y"))
    # of equal letters in a row each leaves the same, so the first one stands for all, and no pair comes twice
    once = cut.filter("i = 1 or substr(n, i, 1) <> substr(n, i - 1, 1)").select("n", "rest").repartition(parts, "rest")
    shorter = once.join(n.select(F.col("n").alias("rest")), "rest").select(F.col("rest").alias("x"), F.col("n").alias("y"))
    return changed.unionByName(shorter).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def sole_holders(names: DataFrame, name: str) -> DataFrame:
    """(fragment, whole): names all of whose words stand in exactly one other name, which has further words.

    ``names`` holds a name once for each party, as two parties of one name are two holders.  A name is looked up by
    its rarest word, so the work is the sum of those words' names.  A common word that is no name's rarest is not looked up.
    """
    n = names.select(F.col(name).alias("n")).filter("trim(n) <> ''").groupBy("n").agg(F.count(F.lit(1)).alias("parties"))
    n = n.withColumn("words", F.array_distinct(F.array_remove(F.split("n", r"\s+"), "")))
    posted = n.select(F.col("n").alias("whole"), F.col("words").alias("many"), "parties", F.explode("words").alias("word"))
    often = posted.groupBy("word").agg(F.count(F.lit(1)).alias("names"))
    common = F.broadcast(often.filter(F.col("names") > COMMON))
    few, many = posted.join(common, "word", "left_anti"), posted.join(common, "word")
    rarest = few.select("whole", "word").join(often, "word").unionByName(many.select("whole", "word", "names")).groupBy("whole").agg(F.min_by("word", F.struct("names", "word")).alias("word"))
    small = rarest.withColumnRenamed("whole", "fragment").withColumn("few", F.array_distinct(F.array_remove(F.split("fragment", r"\s+"), "")))
    sought = rarest.join(common, "word", "left_semi").select("word").distinct()
    large = few.unionByName(many.drop("names").join(F.broadcast(sought), "word", "left_semi"))
    held = small.join(large, "word").filter((F.size("many") > F.size("few")) & (F.size(F.array_except("few", "many")) == 0))
    return held.groupBy("fragment").agg(F.min("whole").alias("whole"), F.sum("parties").alias("holders")).filter("holders = 1").drop("holders")


def absorb_variants(parties: DataFrame, min_ratio: float, kept_apart: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(parties left, absorptions).

    parties (party_key, canonical_name, normalized_name, mention_count, name_variants), keys unique.  From the most
    mentioned down, equal ones by key, a party goes into the first party before it that is left,
    that a decision does not keep apart (``kept_apart``: a, b), that has at least ``min_ratio`` times its mentions
    by then, and whose name is one letter off, both of six letters or more, or alone holds all its words.
    The survivor takes over its mentions and spellings.

    The outcome is that of going through the list one by one.  It is found in rounds: in each, every
    party is settled whose choice hangs on no unsettled party, counts being known between bounds.
    The most mentioned unsettled party always is, so the rounds end.  A ratio of 0 or less absorbs nothing.
    """
    s = Scratch(parties.sparkSession, "variants")
    if min_ratio <= 0:
        return parties, parties.limit(0).select(*_absorption(parties))
    p = s.table(parties)
    parts = tasks(s.spark, p.count())
    named = p.select("party_key", "normalized_name", (-F.col("mention_count")).alias("minus"))
    letters = s.table(one_edit_pairs(named.filter(F.length("normalized_name") >= MIN_NAME), "normalized_name").withColumn("reason", F.lit(ONE_EDIT)), parts)
    long_, apart_ = (F.length("fragment") >= MIN_NAME) & (F.length("whole") >= MIN_NAME), F.levenshtein("fragment", "whole") == 1
    words = sole_holders(named, "normalized_name").filter(~(long_ & apart_)).select(F.col("fragment").alias("a"), F.col("whole").alias("b"), F.lit(FRAGMENT).alias("reason"))  # the reason of one letter comes first
    parts = max(parts, tasks(s.spark, letters.count()))
    side = lambda x: named.select(F.col("normalized_name").alias(x), F.struct(F.col("minus"), F.col("party_key").alias("key")).alias(f"{x}_"))
    low, high = F.least("a_", "b_"), F.greatest("a_", "b_")
    # of two names one letter apart either may be the rarer, a fragment only goes into its holder
    e = letters.unionByName(words).join(side("a"), "a").join(side("b"), "b").filter((F.col("reason") == ONE_EDIT) | (F.col("b_") < F.col("a_")))
    e = e.select(high["key"].alias("rare"), low["key"].alias("common"), "reason", high["minus"].alias("rare_minus"), low["minus"].alias("common_minus"))
    if kept_apart is not None:
        apart = kept_apart.select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).distinct()
        e = e.join(apart, (F.least("rare", "common") == F.col("x")) & (F.greatest("rare", "common") == F.col("y")), "left_anti")
    e = s.table(e, parts)
    # what is known of each party that has somewhere to go: none is absorbed by one that is not in ``rare``
    state = s.table(e.select("rare").distinct().select(F.col("rare").alias("party"), F.lit(None).cast("string").alias("state"), F.lit(None).cast("string").alias("into")), parts)
    place = Window.partitionBy("common").orderBy("rare_minus", "rare").rowsBetween(Window.unboundedPreceding, -1)
    while True:
        of = lambda who: state.select(F.col("party").alias(who), F.col("state").alias(f"{who}_state"), F.col("into").alias(f"{who}_into"))
        # in the order of the list, what a party has at least and at most when each of its rarer ones comes up;
        # one that is too common for all it may have by then adds nothing.  A party has as many as its name has neighbours
        one = F.struct("rare_minus", "rare", "rare_state", F.coalesce(F.col("rare_into") == F.col("common"), F.lit(False)).alias("mine"))
        line = e.join(of("rare"), "rare").groupBy("common", "common_minus").agg(F.array_sort(F.collect_list(one)).alias("line"))
        long = lambda c: c.cast("long")
        empty = F.array().cast("array<struct<rare:string,rare_minus:bigint,rare_state:string,least:bigint,most:bigint>>")
        first = F.struct(long(-F.col("common_minus")).alias("least"), long(-F.col("common_minus")).alias("most"), empty.alias("out"))

        def step(acc, r):
            n = -r["rare_minus"]
            may = r["rare_state"].isNull() & (n * min_ratio <= acc["most"])
            seen = F.struct(r["rare"].alias("rare"), long(r["rare_minus"]).alias("rare_minus"), r["rare_state"].alias("rare_state"), acc["least"].alias("least"), acc["most"].alias("most"))
            return F.struct(long(acc["least"] + F.when(r["mine"], n).otherwise(0)).alias("least"), long(acc["most"] + F.when(r["mine"] | may, n).otherwise(0)).alias("most"), F.concat(acc["out"], F.array(seen)).alias("out"))

        x = line.select("common", "common_minus", F.explode(F.aggregate("line", first, step, lambda acc: acc["out"])).alias("r")).select("common", "common_minus", "r.*")
        x = x.filter("rare_state is null").join(of("common").withColumn("moves", F.lit(True)), "common", "left")
        size = -F.col("rare_minus")
        gone, stays = F.coalesce(F.col("common_state") == "absorbed", F.lit(False)), F.coalesce(F.col("common_state") == "kept", F.col("moves").isNull())
        no = gone | (size * min_ratio > F.col("most"))
        yes = stays & (size * min_ratio <= F.col("least"))
        at = F.struct("common_minus", "common")
        g = x.groupBy("rare").agg(F.min(F.when(yes, at)).alias("yes"), F.min(F.when(~yes & ~no, at)).alias("maybe"))
        found = F.when(F.col("yes").isNotNull() & (F.col("maybe").isNull() | (F.col("yes") < F.col("maybe"))), "absorbed").when(F.col("maybe").isNull(), "kept")
        told = g.select(F.col("rare").alias("party"), found.alias("new"), F.when(found == "absorbed", F.col("yes.common")).alias("new_into"))
        after = s.table(state.join(told, "party", "left").select("party", F.coalesce("state", "new").alias("state"), F.coalesce("into", "new_into").alias("into")), parts)
        s.drop(state)
        state = after
        if state.filter("state is null").isEmpty():
            break
    moved = e.join(state.filter("state = 'absorbed'").select(F.col("party").alias("rare"), F.col("into").alias("common")), ["rare", "common"])
    then = F.coalesce(F.sum(-F.col("rare_minus")).over(place), F.lit(0)) - F.col("common_minus")
    moved = s.table(moved.select("rare", "common", "reason", then.alias("then")), parts)
    r, c = p.select(*(F.col(x).alias(f"r_{x}") for x in p.columns)), p.select(*(F.col(x).alias(f"c_{x}") for x in p.columns))
    full = moved.repartition(parts, "rare").join(r, F.col("rare") == F.col("r_party_key")).repartition(parts, "common").join(c, F.col("common") == F.col("c_party_key"))
    absorptions = full.select(
        F.col("rare").alias("absorbed_party_key"), F.col("r_canonical_name").alias("absorbed_name"), F.col("r_mention_count").alias("absorbed_mentions"),
        F.col("common").alias("surviving_party_key"), F.col("c_canonical_name").alias("surviving_name"), F.col("then").alias("surviving_mentions"),
        F.bround(F.col("then") / F.greatest(F.col("r_mention_count"), F.lit(1)), 1).alias("mention_ratio"), "reason",
    )
    gained = full.groupBy(F.col("common").alias("party_key")).agg(F.sum("r_mention_count").alias("more"), F.flatten(F.collect_list("r_name_variants")).alias("theirs"))
    left = p.join(moved.select(F.col("rare").alias("party_key")), "party_key", "left_anti").join(gained, "party_key", "left")
    none = F.array().cast("array<string>")
    out = {"mention_count": F.col("mention_count") + F.coalesce("more", F.lit(0)), "name_variants": F.array_sort(F.array_union(F.coalesce("name_variants", none), F.coalesce("theirs", none)))}
    return left.select(*(out.get(k, F.col(k)).alias(k) for k in p.columns)), absorptions


def _absorption(parties: DataFrame) -> list:
    key, name, n = F.col("party_key"), F.col("canonical_name"), F.col("mention_count")
    return [key.alias("absorbed_party_key"), name.alias("absorbed_name"), n.alias("absorbed_mentions"), key.alias("surviving_party_key"), name.alias("surviving_name"), n.alias("surviving_mentions"), (n / 1.0).alias("mention_ratio"), F.lit("").alias("reason")]
