"""Who a document names, and what a person decided about the parties: mentions, refused readings, decisions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..components import connected_components
from ..scratch import Scratch
from .entities import normalise_name

# Fixed values: (field of a name, field of its address, role), street words, and readings that name nobody.
ROLES = (
    ("seller_name", "seller_address", "biller"), ("buyer_name", "buyer_address", "payer"), ("ship_to_name", "ship_to_address", "consignee"),
    ("shipper_name", "origin_address", "shipper"), ("consignee_name", "destination_address", "consignee"), ("vendor_name", "vendor_address", "biller"),
    ("carrier_name", None, "carrier"), ("payer_name", None, "payer"), ("payee_name", None, "biller"),
    ("brand_name", None, "brand"), ("manufacturer_name", None, "brand"), ("supplier_name", None, "brand"),
    ("customer_name", "customer_address", "customer"), ("sold_to_name", "sold_to_address", "customer"), ("bill_to_name", "bill_to_address", "customer"),
    ("dealer_name", None, "dealer"), ("remit_to_name", "remit_to_address", "biller"), ("broker_name", None, "broker"),
    ("agent_name", None, "agent"), ("warehouse_name", None, "warehouse"), ("specifier_name", None, "specifier"),
)
STREET = ("st", "street", "ave", "avenue", "rd", "road", "blvd", "boulevard", "dr", "drive", "ln", "lane", "way", "pkwy", "parkway", "hwy", "highway", "cir", "circle", "ct", "court", "pl", "place", "ter", "terrace", "suite", "ste")
#: A number before a name that has a letter and does not begin with a direction.
NUMBERED = r"^([0-9]{2,6})\s*[-\s]\s*((?=[^\d\s])(?=.*\p{L})(?!(?i:[ns][ew]?|[ew]|north|south|east|west)\b).*)$"
NOBODY = ("company", "dealer of", "install rep", "none", "n a", "na", "tbd", "unknown", "various")
TOTAL = r"(?i)^(?:grand\s+|sub\s*)?totals?\b[^:]*:\s*$"
SIGNED_PERCENT = r"^[-+−]\s*[0-9]+(?:\.[0-9]+)?\s*%"
LETTER = r"\p{L}"
LEAST_PREFIX = 4


def bare(c: Column) -> Column:
    """Text without outer blanks."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def words(c: Column) -> Column:
    """The words of a name without case; an ampersand is a word of its own, and legal suffixes stay."""
    parts = F.split(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "&", " and "), r"(?U)\W+")
    return F.array_remove(parts, "")


def plain(c: Column) -> Column:
    """The words of a name, with single blanks."""
    return F.array_join(words(c), " ")


def _on_street(name: Column) -> Column:
    return F.arrays_overlap(words(name), F.array(*map(F.lit, STREET)))


def numbered_name(name: Column) -> Column:
    """A struct of a name's leading location ``key`` (or empty) and the ``account`` after it; a house number is no key."""
    text = bare(name)
    rest = bare(F.regexp_extract(text, NUMBERED, 2))
    keyed = (rest != "") & ~_on_street(rest)
    return F.struct(F.when(keyed, F.regexp_extract(text, NUMBERED, 1)).otherwise("").alias("key"), F.when(keyed, rest).otherwise(text).alias("account"))


def of_client(name: Column, clients: tuple[str, ...], least: int = LEAST_PREFIX) -> Column:
    """Whether a name is the client's: the same but for legal suffixes, cut inside a word, or with further words after it."""
    account = numbered_name(name)["account"]
    own, said, core = words(account), plain(account), normalise_name(account)
    found = []
    for client in map(F.lit, filter(str.strip, clients)):
        theirs, spelt = words(client), plain(client)
        same = (core != "") & (core == normalise_name(client))
        longer = (F.size(own) > F.size(theirs)) & (F.slice(own, 1, F.size(theirs)) == theirs)
        cut = (F.length(said) >= least) & F.startswith(spelt, said) & F.substr(spelt, F.length(said) + 1, F.lit(1)).rlike(LETTER)
        found.append((F.size(theirs) > 0) & (same | longer | cut))
    return reduce(lambda a, b: a | b, found, F.lit(False))


def why_no_party(name: Column, clients: tuple[str, ...]) -> Column:
    """Why a reading names no party, the first cause that holds; null for a mention."""
    text = bare(name)
    causes = {
        "party_name_carries_no_letter": ~text.rlike(LETTER),
        "the_client_is_not_a_counterparty": of_client(text, clients),
        "party_name_is_a_street_address": text.rlike(r"^[0-9]{1,6}\s") & _on_street(text),
        "party_name_is_a_label_or_placeholder": plain(text).isin(*NOBODY) | text.rlike(TOTAL) | text.rlike(SIGNED_PERCENT),
    }
    return F.coalesce(*(F.when(holds, cause) for cause, holds in causes.items()))


def party_mentions(holders: DataFrame, clients: tuple[str, ...] = ()) -> DataFrame:
    """One row per party reading of holders (document_id, scope, values: map of field to text), with why it names no party.

    (document_id, scope, field, role, raw_name, account_name, location_identifier, raw_address, reason): ``reason`` is
    null for a mention; a refused reading keeps its name and has no account.  A holder is a header or one line; no
    shuffle is made.  Null maps, null and blank names give no row; repeated holders repeat.
    """
    cell = lambda f: F.try_element_at("values", F.lit(f))
    none = F.lit(None).cast("string")
    seen = F.array(*(F.struct(F.lit(n).alias("field"), F.lit(r).alias("role"), bare(cell(n)).alias("raw_name"), (bare(cell(a)) if a else none).alias("raw_address")) for n, a, r in ROLES))
    rows = holders.select("document_id", "scope", F.explode(F.filter(seen, lambda x: F.coalesce(x["raw_name"], F.lit("")) != "")).alias("x")).select("document_id", "scope", "x.*")
    mention = F.col("reason").isNull()
    out = rows.withColumns({"reason": why_no_party(F.col("raw_name"), clients), "_n": numbered_name(F.col("raw_name"))})
    kept = {"account_name": F.col("_n.account"), "location_identifier": F.col("_n.key"), "raw_address": F.nullif(F.col("raw_address"), F.lit(""))}
    return out.withColumns({c: F.when(mention, x) for c, x in kept.items()}).drop("_n")


# ---- decisions of a person over named pairs ----------------------------------------------

SAME, NO_PARTY, BRANCH, APART = "same_party", "not_a_party", "branch_of", "different_parties"


def squashed(c: Column) -> Column:
    """A name without blanks and case."""
    return F.lower(F.regexp_replace(c, r"(?U)\s+", ""))


def decide_parties(parties: DataFrame, decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parties after a person's decisions, and what became of each decision.

    ``parties`` is (ordinal, party_key, canonical_name, name_variants, mention_count), ``decisions`` is (decision_id, a, b,
    decision, canonical_name).  A name finds the first party that spells it, blanks and case aside.  Parties joined by
    same_party, over any chain, become the most mentioned of them, ties by key, with all spellings and mentions; a declared name
    must be a spelling of one of the two, and the last declared wins.  not_a_party takes parties away, as
    state ``removed``; branch_of makes a the parent of b, the last decision winning.  Folding comes first,
    then removal.  Returns (party_key, canonical_name, name_variants, mention_count, parent_party_key, state) and
    (decision_id, decision, outcome, reason, a_key, b_key).  Clustering that joined what a decision keeps apart is reported, not undone.
    """
    s = Scratch(parties.sparkSession, "decided")
    spellings = F.concat(F.array("canonical_name"), F.coalesce("name_variants", F.array().cast("array<string>")))
    base = s.table(parties.select("ordinal", "party_key", "canonical_name", "mention_count", F.array_compact(spellings).alias("spellings")))
    index = base.select("ordinal", "party_key", "spellings", F.explode("spellings").alias("x")).groupBy(squashed(F.col("x")).alias("spelt")).agg(F.min(F.struct("ordinal", "party_key", "spellings")).alias("p"))
    index = s.table(index.select("spelt", "p.party_key", "p.spellings"))
    named = decisions.select("decision_id", "decision", squashed(F.col("a")).alias("a"), squashed(F.col("b")).alias("b"), bare(F.coalesce("canonical_name", F.lit(""))).alias("declared"))
    for side in "ab":
        named = named.join(index.select(F.col("spelt").alias(side), F.col("party_key").alias(f"{side}_given"), F.col("spellings").alias(f"{side}_spellings")), side, "left")
    printed = F.get(F.filter(F.concat("a_spellings", "b_spellings"), lambda x: squashed(x) == squashed(F.col("declared"))), F.lit(0))
    named = s.table(named.withColumn("printed", F.when(F.col("declared") != "", printed)))
    folds = named.filter((F.col("decision") == SAME) & F.col("a_given").isNotNull() & F.col("b_given").isNotNull() & ((F.col("declared") == "") | F.col("printed").isNotNull()))
    roots = s.table(connected_components(folds.select(F.col("a_given").alias("a"), F.col("b_given").alias("b")), s))
    members = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    grouped = base.join(members, base["party_key"] == members["node"], "left").withColumn("root", F.coalesce("root", "party_key")).drop("node")
    best = grouped.groupBy("root").agg(F.min(F.struct((-F.col("mention_count")).alias("n"), F.col("party_key").alias("k"), F.col("canonical_name").alias("c"))).alias("t"), F.sum("mention_count").alias("mention_count"))
    words = grouped.select("root", F.explode("spellings").alias("x")).groupBy("root").agg(F.sort_array(F.collect_set("x")).alias("name_variants"))
    to = s.table(grouped.select("party_key", "root").join(best.select("root", F.col("t.k").alias("survivor")), "root").select(F.col("party_key").alias("given"), "root", "survivor"))
    declared = folds.filter("printed is not null").join(to, F.col("a_given") == F.col("given")).groupBy("root").agg(F.max_by("printed", "decision_id").alias("declared"))
    for side in "ab":
        named = named.join(to.select(F.col("given").alias(f"{side}_given"), F.col("survivor").alias(f"{side}_key")), f"{side}_given", "left")
    named = s.table(named.select("decision_id", "decision", "declared", "printed", "a_key", "b_key"))
    removed = named.filter(F.col("decision") == NO_PARTY).select(F.explode(F.array_compact(F.array("a_key", "b_key"))).alias("gone")).distinct()
    later = named.filter(F.col("decision").isin(BRANCH, APART))
    for side in "ab":  # a removed party is found by no later decision
        gone = removed.select(F.col("gone").alias(f"{side}_key"), F.lit(True).alias("_g"))
        later = later.join(gone, f"{side}_key", "left").withColumn(f"{side}_key", F.when(F.col("_g").isNull(), F.col(f"{side}_key"))).drop("_g")
    seen = s.table(named.filter(~F.col("decision").isin(BRANCH, APART)).unionByName(later))
    missing = F.col("a_key").isNull() | F.col("b_key").isNull()
    kind = F.col("decision")
    reason = F.when(kind == NO_PARTY, F.when(F.col("a_key").isNull() & F.col("b_key").isNull(), "neither_name_resolved_to_a_party")).when(missing, "a_name_resolved_to_no_party")
    reason = reason.when((kind == SAME) & (F.col("declared") != "") & F.col("printed").isNull(), "declared_name_is_not_a_printed_spelling")
    reason = reason.when((kind != SAME) & (F.col("a_key") == F.col("b_key")), "clustering_already_joined_them")
    outcomes = seen.select("decision_id", "decision", F.when(reason.isNull(), "applied").otherwise("unmatched").alias("outcome"), reason.alias("reason"), "a_key", "b_key")
    parents = outcomes.filter((kind == BRANCH) & (F.col("outcome") == "applied")).groupBy(F.col("b_key").alias("party_key")).agg(F.max_by("a_key", "decision_id").alias("parent_party_key"))
    out = best.join(words, "root", "left").join(declared, "root", "left").select(F.col("t.k").alias("party_key"), F.coalesce("declared", "t.c").alias("canonical_name"), "name_variants", "mention_count")
    out = out.join(parents, "party_key", "left").join(removed.withColumnRenamed("gone", "party_key").withColumn("_g", F.lit("removed")), "party_key", "left")
    return out.withColumn("state", F.coalesce("_g", F.lit("kept"))).drop("_g"), outcomes


# ---- the company of an address -----------------------------------------------------------

LEAST_IN_DOMAIN = 4


def company_of_email(emails: DataFrame, candidates: DataFrame) -> DataFrame:
    """(row_id, email, party_key): the one company that an email's domain names among its document's parties, else null.

    ``emails`` is (row_id, document_id, email), ``candidates`` is (document_id, party_key, name).  The domain's first label is the name,
    or begins with it; a domain that names two parties names neither, and names of under four characters name nobody.
    """
    label = F.regexp_replace(F.lower(F.element_at(F.split(F.element_at(F.split("email", "@"), -1), r"\."), 1)), "[^a-z0-9]", "")
    name = F.regexp_replace(normalise_name(F.col("name")), "[^a-z0-9]", "")
    able = candidates.select("document_id", "party_key", name.alias("short")).filter(F.length("short") >= LEAST_IN_DOMAIN).distinct()
    hit = emails.select("row_id", "document_id", label.alias("label")).join(able, "document_id").filter(F.startswith("label", F.col("short")))
    one = hit.groupBy("row_id").agg(F.min("party_key").alias("party_key"), F.max("party_key").alias("_m")).filter("party_key = _m").drop("_m")
    return emails.join(one, "row_id", "left").select("row_id", "email", "party_key")
