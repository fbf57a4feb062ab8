"""Fills of empty cells from what the same run prints elsewhere, each with its method and evidence beside it.

A fill is a row (row_id, column, value, method, evidence, party_key) for the cell that it stands beside; no cell is
overwritten.  Empty and blank cells are alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .mentions import numbered_name, of_client, plain

# The method's bound, keys that name no job, states, and the forms of places and phones.
MIN_ACCURACY = 0.95
MIN_KEY_LENGTH = 4
PLACEHOLDER_KEY = r"(?i)^(?:0+|n/?a|none|stock|tbd)$"
MIN_STATEMENTS = 3
STATES = {
    "alabama": "AL", "alaska": "AK", "arizona": "AZ", "arkansas": "AR", "california": "CA", "colorado": "CO", "connecticut": "CT", "delaware": "DE",
    "district of columbia": "DC", "florida": "FL", "georgia": "GA", "hawaii": "HI", "idaho": "ID", "illinois": "IL", "indiana": "IN", "iowa": "IA",
    "kansas": "KS", "kentucky": "KY", "louisiana": "LA", "maine": "ME", "maryland": "MD", "massachusetts": "MA", "michigan": "MI", "minnesota": "MN",
    "mississippi": "MS", "missouri": "MO", "montana": "MT", "nebraska": "NE", "nevada": "NV", "new hampshire": "NH", "new jersey": "NJ", "new mexico": "NM",
    "new york": "NY", "north carolina": "NC", "north dakota": "ND", "ohio": "OH", "oklahoma": "OK", "oregon": "OR", "pennsylvania": "PA", "puerto rico": "PR",
    "rhode island": "RI", "south carolina": "SC", "south dakota": "SD", "tennessee": "TN", "texas": "TX", "utah": "UT", "vermont": "VT", "virginia": "VA",
    "washington": "WA", "west virginia": "WV", "wisconsin": "WI", "wyoming": "WY",
}
UNCLEAR_STATE = "LA"
CITY_AND_STATE = r"\s[-–]\s+([A-Za-z][A-Za-z.' ]*?),\s*([A-Z]{2})\s*$"
BRANCH = r"\s[-–]\s+([A-Za-z][A-Za-z.' ]*[A-Za-z.])\s*$"
STATE_CODE = r"[-,/(.]\s*([A-Z]{2})\)?\s*$"
PHONE = r"(?i)(?:\+?1[\s.-]*)?\(?([2-9]\d{2})\)?[\s.-]*([2-9]\d{2})[\s.-]*(\d{4})(?:\s*(?:x|ext\.?|extension)\s*(\d{1,6}))?"
PHONE_KINDS = {"O": "office", "D": "direct", "M": "mobile", "C": "mobile"}


def _blank(c: Column | str) -> Column:
    return F.trim(F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))) == ""


def _fill(df: DataFrame, column: Column, value: Column, method: str, evidence: Column, party: Column | None = None) -> DataFrame:
    none = F.lit(None).cast("string")
    return df.select("row_id", column.alias("column"), value.alias("value"), F.lit(method).alias("method"), evidence.alias("evidence"), (none if party is None else party).alias("party_key"))


def usable_key(c: Column) -> Column:
    """Whether a printed key can name one job: long enough, and no placeholder."""
    text = F.trim(F.coalesce(c.cast("string"), F.lit("")))
    return (F.length(text) >= MIN_KEY_LENGTH) & ~text.rlike(PLACEHOLDER_KEY)


def _keys(lines: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """One row a usable key of a line, ``rank`` the key's place among the columns."""
    each = F.array(*(F.struct(F.lit(i).alias("rank"), F.lit(k).alias("key_column"), F.trim(F.col(k).cast("string")).alias("key")) for i, k in enumerate(keys)))
    return lines.withColumn("k", F.explode(each)).select(*lines.columns, "k.*").filter(usable_key(F.col("key")))


def shared_keys(lines: DataFrame, field: str, keys: tuple[str, ...], least: float = MIN_ACCURACY) -> tuple[DataFrame, DataFrame]:
    """(fills of ``field``, its score as one row).

    lines: row_id, ordinal, document_id, maker, the ``keys``, ``text`` as printed, ``party_key`` and ``party_name`` of the party that it
    names, ``barred`` where the reading is no party.  A line without a party takes the one that all its keys name on
    other lines of its maker.  First each line with a party is asked as if it were hidden: what the others say follows from its
    group's counts less its own, with no line joined to another.  Below ``least`` nothing is filled.  Keys that name two parties,
    and keys that disagree, settle nothing.
    """
    maker = F.coalesce("maker", F.lit(""))
    lines = lines.withColumn("maker", maker)
    speaks = ~_blank("party_key") & ~F.coalesce("barred", F.lit(False))
    told = lines.filter(speaks)
    posted = _keys(told, keys)
    by = ["maker", "key_column", "key"]
    per = posted.groupBy(*by, "party_key").agg(F.count(F.lit(1)).alias("own"))
    group = posted.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("document_id").alias("documents"), F.min_by(F.coalesce(F.nullif(F.trim("party_name"), F.lit("")), F.col("text")), "ordinal").alias("name"))
    group = group.join(per.groupBy(*by).agg(F.count(F.lit(1)).alias("parties"), F.min("party_key").alias("low"), F.max("party_key").alias("high")), by)
    # each line that names its party, asked of the others
    asked = posted.select("row_id", "maker", "party_key", "rank", "key_column", "key").join(group.drop("documents", "name"), by).join(per, [*by, "party_key"])
    alone = F.col("own") == 1
    others = F.col("parties") - alone.cast("int")
    said = F.when(others == 1, F.when(alone, F.when(F.col("low") == F.col("party_key"), F.col("high")).otherwise(F.col("low"))).otherwise(F.col("party_key")))
    answer = asked.select("row_id", "maker", "party_key", (others > 1).alias("torn"), said.alias("said")).groupBy("row_id", "maker", "party_key").agg(F.bool_or("torn").alias("torn"), F.min("said").alias("lo"), F.max("said").alias("hi"))
    answer = answer.filter(~F.col("torn") & F.col("lo").isNotNull() & (F.col("lo") == F.col("hi")))
    count = told.groupBy("maker", "party_key").agg(F.count(F.lit(1)).alias("c"), F.min("ordinal").alias("o"))
    usual = count.groupBy("maker").agg(F.max_by("party_key", F.struct("c", (-F.col("o")).alias("o"))).alias("usual"))
    right = lambda a, b: F.sum((F.col(a) == F.col(b)).cast("long"))
    score = answer.join(usual, "maker").agg(F.count(F.lit(1)).alias("proposed"), F.coalesce(right("lo", "party_key"), F.lit(0)).alias("correct"), F.coalesce(right("usual", "party_key"), F.lit(0)).alias("by_chance"))
    score = score.crossJoin(told.agg(F.count(F.lit(1)).alias("held_out")))  # one row each
    rate = lambda c: F.bround(F.col(c) / F.nullif(F.col("proposed"), F.lit(0)), 4)
    score = score.select(F.lit(field).alias("field"), "held_out", "proposed", "correct", rate("correct").alias("accuracy"), rate("by_chance").alias("chance_baseline"))
    # the open lines
    open_ = lines.filter(_blank("text") & _blank("party_key")).select("row_id", "maker", *keys)
    met = _keys(open_, keys).select("row_id", "maker", "rank", "key_column", "key").join(group, by)
    best = F.max_by(F.struct("key_column", "key", "name", "n", "documents"), F.struct("n", (-F.col("rank")).alias("r")))
    found = met.groupBy("row_id").agg(F.max("parties").alias("most"), F.min("low").alias("lo"), F.max("high").alias("hi"), best.alias("b"))
    settled = (F.col("most") == 1) & (F.col("lo") == F.col("hi"))
    gated = found.crossJoin(F.broadcast(score)).filter(F.coalesce(F.col("accuracy") >= least, F.lit(False)))  # score is one row
    evidence = F.concat(F.col("b.key_column"), F.lit(" "), F.col("b.key"), F.lit(" names this party on "), F.col("b.n"), F.lit(" lines of "), F.col("b.documents"), F.lit(" documents; held out, the method was right on "), F.col("correct"), F.lit(" of "), F.col("proposed"), F.lit(" lines"))
    fills = _fill(gated.filter(settled), F.lit(field), F.col("b.name"), "same_key_on_other_lines", evidence, F.col("lo"))
    done = gated.agg(F.coalesce(F.sum(settled.cast("long")), F.lit(0)).alias("filled"), F.coalesce(F.sum((~settled).cast("long")), F.lit(0)).alias("left_empty_where_keys_disagree"))
    return fills, score.crossJoin(done)


def document_types(documents: DataFrame, lines: DataFrame, engine: DataFrame, reviewed: DataFrame, kinds: dict[str, tuple[str, str]]) -> DataFrame:
    """Types of untyped documents and of their untyped lines where the engine's type and the reviewed kind are one.

    documents (row_id, document_id, document_type), lines likewise, engine (document_id, type), reviewed (document_id, kind);
    ``kinds`` says of an engine's type which kind it agrees with and which type that is.
    """
    at = lambda i: F.create_map(*(F.lit(x) for k, v in kinds.items() for x in (k, v[i])))
    untyped = F.trim(F.coalesce("document_type", F.lit(""))).isin("", "unknown")
    x = documents.filter(untyped).join(engine, "document_id").join(reviewed, "document_id").filter(at(0)[F.col("type")] == F.col("kind")).withColumn("found", at(1)[F.col("type")])
    own = _fill(x, F.lit("document_type"), F.col("found"), "two_vendors_agree", F.concat(F.lit("the engines read "), "type", F.lit("; the page review read "), "kind"))
    of_lines = lines.filter(untyped).join(x.select("document_id", "found"), "document_id")
    return own.unionByName(_fill(of_lines, F.lit("document_type"), F.col("found"), "two_vendors_agree", F.lit("its document's type")))


def letterhead_brands(lines: DataFrame, documents: DataFrame, clients: tuple[str, ...]) -> DataFrame:
    """The brand of a line from its own document's, never the client's name.  lines (row_id, document_id, brand_name), documents (document_id, brand_name)."""
    head = documents.select("document_id", F.trim("brand_name").alias("b")).filter(~_blank("b") & ~of_client(F.col("b"), clients))
    return _fill(lines.filter(_blank("brand_name")).join(head, "document_id"), F.lit("brand_name"), F.col("b"), "document_letterhead", F.lit("the brand its own document prints"))


def same_line(cells: DataFrame, clients: tuple[str, ...], statements: int = MIN_STATEMENTS) -> tuple[DataFrame, DataFrame]:
    """(fills, empty cells left by column because statements disagree) of cells (row_id, document_id, key, column, value[, party_key]).

    Cells with one ``key`` are one line printed on several statements.  Where at least ``statements`` documents print it and two
    or more carry a value that none contradicts, the empty cells take it, with the party's key if all carriers hold one.
    """
    c = cells.withColumn("value", F.trim(F.coalesce("value", F.lit(""))))
    if "party_key" not in c.columns:
        c = c.withColumn("party_key", F.lit(""))
    live, party = F.col("value") != "", F.coalesce("party_key", F.lit(""))
    seen = c.filter("key is not null").groupBy("key").agg(F.count_distinct("document_id").alias("documents")).filter(F.col("documents") >= statements)
    g = c.join(seen.select("key"), "key").groupBy("key", "column").agg(
        F.count_distinct(F.when(live, F.col("value"))).alias("values"), F.max(F.when(live, F.col("value"))).alias("found"), F.count_distinct(F.when(live, F.col("document_id"))).alias("carriers"),
        F.min(F.when(live, party)).alias("lo"), F.max(F.when(live, party)).alias("hi"),
    )
    empty = c.filter(~live).select("row_id", "key", "column").join(g.filter("values > 0"), ["key", "column"])
    good = (F.col("values") == 1) & (F.col("carriers") >= 2) & ~of_client(F.col("found"), clients)
    fills = _fill(empty.filter(good), F.col("column"), F.col("found"), "same_line_on_other_statements", F.concat("carriers", F.lit(" statements print this job and amount with it")), F.when((F.col("lo") == F.col("hi")) & (F.col("lo") != ""), F.col("lo")))
    return fills, empty.filter("values > 1").groupBy("column").agg(F.count(F.lit(1)).alias("left_empty"))


def projects(lines: DataFrame) -> DataFrame:
    """A project that a party field holds, for lines without one.  lines (row_id, project_name, party_field, party_value, number), party_field named by the line's flag."""
    x = lines.filter(_blank("project_name") & ~_blank("party_field") & ~_blank("party_value"))
    return _fill(x, F.lit("project_name"), F.trim("party_value"), "party_field_holds_the_project", F.concat("party_field", F.lit(" repeats the row's description, job or project "), F.coalesce("number", F.lit(""))))


def with_places(names: DataFrame, column: str) -> DataFrame:
    """``names`` with the location_number, city, state and branch that the names in ``column`` print plainly; null where they do not."""
    codes = sorted(set(STATES.values()))
    # read in steps, so that no pattern is read twice
    x = names.withColumn("_read", numbered_name(F.col(column))).withColumns({"_number": F.nullif(F.col("_read.key"), F.lit("")), "_rest": F.col("_read.account")})
    got = lambda pattern, i: F.nullif(F.trim(F.regexp_extract("_rest", pattern, i)), F.lit(""))
    x = x.withColumns({"_city": got(CITY_AND_STATE, 1), "_of": got(CITY_AND_STATE, 2), "_branch": got(BRANCH, 1), "_code": got(STATE_CODE, 1)})
    branch, spaced = F.col("_branch"), F.contains("_branch", F.lit(" "))
    spell = F.create_map(*(F.lit(x) for kv in STATES.items() for x in kv))
    spelt = F.when((F.length(branch) == 2) & F.upper(branch).isin(*codes), F.upper(branch)).otherwise(spell[F.lower(branch)])
    letters = F.length(F.regexp_replace(branch, r"[^\p{L}]", ""))
    x = x.withColumns({"_in": F.coalesce(F.col("_of").isin(*codes), F.lit(False)), "_spelt": spelt, "_likely": (letters >= 4) & ~(~spaced & (F.upper(branch) == branch) & (letters <= 4)), "_last": F.when(spaced, F.element_at(F.split(branch, r"\s+"), -1))})
    tail = F.when(F.col("_likely") & F.col("_last").isin(*codes), F.col("_last"))
    clear = lambda c: F.when(F.col(c) != UNCLEAR_STATE, F.col(c))
    state = F.when(F.col("_in"), F.col("_of")).when(branch.isNotNull(), F.when(F.col("_spelt").isNotNull(), clear("_spelt")).otherwise(tail)).when(F.col("_code").isin(*codes), clear("_code"))
    found = {"location_number": F.col("_number"), "city": F.when(F.col("_in"), F.col("_city")), "state": state, "branch": F.when(~F.col("_in") & F.col("_spelt").isNull() & F.col("_likely"), branch)}
    return x.select(*names.columns, *(v.alias(k) for k, v in found.items()))


def places(names: DataFrame, clients: tuple[str, ...]) -> DataFrame:
    """What parties' names say about where they are, one row a part.  names (row_id, column, value)."""
    x = with_places(names.select("row_id", "column", "value").filter(~_blank("value") & ~of_client(F.col("value"), clients)), "value")
    parts = F.array(*(F.struct(F.lit(k).alias("part"), F.col(k).alias("found")) for k in ("location_number", "city", "state", "branch")))
    x = x.withColumn("p", F.explode(parts)).filter("p.found is not null")
    return _fill(x, F.concat("column", F.lit("_"), "p.part"), F.col("p.found"), "printed_in_the_name", F.concat("column", F.lit(" prints "), "value"))


def countries(cells: DataFrame, codes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(two-letter codes of country names, names without one with their count).  cells (row_id, column, value), codes (name, code)."""
    x = cells.filter(~_blank("value") & ~F.trim("value").rlike("^[A-Z]{2}$")).withColumn("loose", plain(F.col("value")))
    table = codes.groupBy(plain(F.col("name")).alias("loose")).agg(F.min("code").alias("code"))
    x = x.join(table, "loose", "left")
    return _fill(x.filter("code is not null"), F.col("column"), F.col("code"), "iso_3166_1_alpha2", F.concat(F.lit("the ISO short name "), F.trim("value"))), x.filter("code is null").groupBy(F.trim("value").alias("name")).agg(F.count(F.lit(1)).alias("cells"))


def phone_numbers(text: Column) -> Column:
    """array of (kind, number): every North American number of a cell in E.164, with the kind named before it or an empty one."""

    def of(segment: Column) -> Column:
        letter = F.regexp_extract(segment, r"^\s*([ODMC])\.\s", 1)
        kind = F.coalesce(F.create_map(*(F.lit(x) for kv in PHONE_KINDS.items() for x in kv))[letter], F.lit(""))
        part = lambda m, i: F.regexp_extract(m, PHONE, i)
        number = lambda m: F.concat(F.lit("+1"), part(m, 1), part(m, 2), part(m, 3), F.when(part(m, 4) != "", F.concat(F.lit(";ext="), part(m, 4))).otherwise(""))
        return F.transform(F.regexp_extract_all(segment, F.lit(PHONE), F.lit(0)), lambda m: F.struct(kind.alias("kind"), number(m).alias("number")))

    return F.flatten(F.transform(F.split(F.coalesce(text, F.lit("")), ";"), of))


def phones(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(numbers in E.164, columns with how many cells held none).  cells (row_id, column, value).

    A cell of one number fills its own column; of several, each goes to the column with its kind or its place, and of
    one kind the later ones with its place among them.
    """
    x = cells.filter(~_blank("value")).withColumn("numbers", phone_numbers(F.col("value")))
    some = x.filter(F.size("numbers") > 0).select("*", F.posexplode("numbers").alias("at", "n"))
    label = F.when(F.col("n.kind") != "", F.col("n.kind")).otherwise((F.col("at") + 1).cast("string"))
    before = F.size(F.filter(F.slice("numbers", F.lit(1), F.col("at")), lambda y: (y["kind"] != "") & (y["kind"] == F.col("n.kind"))))
    target = F.when(F.size("numbers") == 1, F.col("column")).otherwise(F.concat("column", F.lit("_"), label, F.repeat(F.lit("_2"), before)))
    return _fill(some, target, F.col("n.number"), "e164", F.concat("column", F.lit(" prints "), "value")), x.filter(F.size("numbers") == 0).groupBy("column").agg(F.count(F.lit(1)).alias("unparsed"))


def identities(names: DataFrame, facts: DataFrame) -> DataFrame:
    """Who a party is by a public source.  names (row_id, column, value); facts (name, identity, city, state, website, source, confidence, retrieved), of several for one name the last by source."""
    f = facts.groupBy(plain(F.col("name")).alias("loose")).agg(F.max(F.struct("source", "identity", "city", "state", "website", "confidence", "retrieved")).alias("f"))
    x = names.filter(~_blank("value")).withColumn("loose", plain(F.col("value"))).join(f, "loose")
    full = lambda c: F.nullif(F.col(c), F.lit(""))
    value = F.concat_ws(" · ", full("f.identity"), F.nullif(F.concat_ws(", ", full("f.city"), full("f.state")), F.lit("")), full("f.website"))
    evidence = F.concat("f.source", F.lit(" ("), F.coalesce(full("f.confidence"), F.lit("unrated")), F.lit(", retrieved "), F.coalesce(full("f.retrieved"), F.lit("undated")), F.lit(")"))
    return _fill(x, F.concat("column", F.lit("_identity")), value, "public_source", evidence)
