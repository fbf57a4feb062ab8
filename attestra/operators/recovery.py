"""Names recovered or grouped from what pages print: specifiers beside orders, cut names, readings of one person."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..components import connected_components
from ..scratch import Scratch

# A printed date, and headings that stand in the text beside values.
PRINTED_DATE = r"^\d{1,2}/\d{1,2}/\d{2,4}$"
HEADING = r"(?i)^(p\.?o\.?\s*total|total|invoice|qty|style|job\s*number|number|date|billed|commissions|furn|table|lea|fab|masq|fixed|company|ack#|specifier)\b"


def firm_like(text: Column) -> Column:
    """Whether a reading can be a firm's name: three letters or more, and half of what is printed."""
    letters, dense = F.regexp_count(text, F.lit(r"\p{L}")), F.regexp_count(text, F.lit(r"\S"))
    return (letters >= 3) & (letters * 2 >= dense)


def specifiers_by_order(pages: DataFrame, page: str, text: str) -> DataFrame:
    """(page, order_number, specifier): where a date stands alone on a line, the line before is an order and the line after its specifier.

    Blank lines are passed over; of several specifiers of one order on a page the first wins.  A page's lines
    stay in its row: there is no shuffle before the last aggregation.  A null text has none.
    """
    lines = F.filter(F.transform(F.split(text, r"\r\n|\r|\n"), lambda x: F.trim(x)), lambda x: x != "")
    rows = pages.select(page, lines.alias("l")).filter(F.size("l") >= 3)
    at = F.filter(F.sequence(F.lit(2), F.size("l") - 1), lambda i: F.element_at("l", i).rlike(PRINTED_DATE))
    near = rows.select(page, "l", F.explode(at).alias("i")).select(page, "i", F.element_at("l", F.col("i") - 1).alias("order_number"), F.element_at("l", F.col("i") + 1).alias("specifier"))
    plain = lambda c: ~c.rlike(PRINTED_DATE) & ~c.rlike(HEADING)
    good = near.filter(plain(F.col("order_number")) & plain(F.col("specifier")) & firm_like(F.col("specifier")))
    return good.groupBy(page, "order_number").agg(F.min_by("specifier", "i").alias("specifier"))


def attach_specifiers(lines: DataFrame, found: DataFrame, page: str) -> DataFrame:
    """Lines (page, order_number, specifier_name, brand_name) with the printed specifier as an unaccepted single reading.

    A line that states one keeps it, as a conflict; brand_holds_specifier marks a brand that is that name.
    """
    out = lines.join(found.select(page, "order_number", F.col("specifier").alias("_s")), [page, "order_number"], "left")
    states = F.coalesce(F.trim("specifier_name"), F.lit("")) != ""
    outcome = F.when(F.col("_s").isNull(), "none_printed").when(states, "already_stated").otherwise("attached")
    attached = outcome == "attached"
    holds = attached & F.coalesce(F.lower(F.trim("brand_name")) == F.lower("_s"), F.lit(False))
    return out.withColumns({"outcome": outcome, "brand_holds_specifier": holds, "specifier_name": F.when(attached, F.col("_s")).otherwise(F.col("specifier_name"))}).drop("_s")


def cut_off_names(names: DataFrame, name: str) -> DataFrame:
    """(name, why) of names that others continue in mid-word, or lone words that begin names with different second words.

    Names meet by their prefixes, each name under every shorter prefix of its own, so none is held against all.
    """
    loose = F.trim(F.regexp_replace(F.lower(name), "[^a-z0-9]+", " "))
    short = names.select(name, loose.alias("short")).filter("short <> ''").distinct()
    whole = short.select(F.col("short").alias("longer")).distinct().filter(F.length("longer") > 1)
    cuts = whole.select("longer", F.explode(F.sequence(F.lit(1), F.length("longer") - 1)).alias("n"))
    tails = cuts.select(F.expr("left(longer, n)").alias("short"), F.expr("substring(longer, n + 1, 1) <> ' '").alias("inside"), F.try_element_at(F.split("longer", " "), F.lit(2)).alias("second")).filter("short not like '% '")
    seen = tails.join(short.select("short").distinct(), "short", "left_semi").groupBy("short").agg(F.bool_or("inside").alias("inside"), F.countDistinct("second").alias("seconds"))
    why = F.when(F.col("inside"), "continued_in_mid_word").when(~F.contains("short", F.lit(" ")) & (F.col("seconds") > 1), "begins_several_names")
    return short.join(seen, "short").select(name, why.alias("why")).filter("why is not null")


def one_person(readings: DataFrame) -> DataFrame:
    """(reading_id, person_id, reasons) of readings (reading_id long, name, email): person_id is the smallest id joined.

    Joined are the same letters, a middle initial that the other spelling lacks, and the same email, through
    any chain.  The reasons are those that joined different spellings.  A null name or email joins nothing.
    """
    letters = F.regexp_replace(F.lower("name"), "[^a-z]", "")
    words = F.split(F.trim(F.regexp_replace(F.lower("name"), "[^a-z0-9]+", " ")), " ")
    initial = F.when((F.size(words) == 3) & (F.length(words[1]) == 1), F.regexp_replace(F.concat(words[0], words[2]), "[^a-z]", ""))
    key = lambda kind, value, why: F.when(value != "", F.struct(F.lit(kind).alias("kind"), value.alias("value"), F.lit(why).alias("why")))
    keys = F.array_compact(F.array(key("name", letters, "the same letters"), key("name", initial, "a middle initial"), key("email", F.lower(F.trim("email")), "the same email")))
    s = Scratch(readings.sparkSession, "people")
    shown = s.table(readings.select("reading_id", "name", F.explode(keys).alias("k")).select("reading_id", "name", "k.*"))
    first = s.table(shown.groupBy("kind", "value").agg(F.min(F.struct("reading_id", "name", "why")).alias("f")))
    joined = s.table(shown.join(first, ["kind", "value"]).filter("reading_id <> f.reading_id").select(F.col("reading_id").alias("a"), F.col("f.reading_id").alias("b"), F.when(F.col("name") != F.col("f.name"), F.when(F.col("why") == "the same letters", F.col("f.why")).otherwise(F.col("why"))).alias("why")))
    roots = connected_components(joined.select("a", "b"), s).toDF("reading_id", "person_id")
    out = s.table(readings.select("reading_id").join(roots, "reading_id", "left").select("reading_id", F.coalesce("person_id", "reading_id").alias("person_id")))
    reasons = joined.filter("why is not null").join(out, F.col("a") == F.col("reading_id")).groupBy("person_id").agg(F.sort_array(F.collect_set("why")).alias("reasons"))
    return out.join(reasons, "person_id", "left").select("reading_id", "person_id", F.coalesce("reasons", F.array().cast("array<string>")).alias("reasons"))
