"""Readings handed over by independent readers: who read, whether two are one, and whether anything was changed since.

``headers`` has one row a handoff: handoff, ordinal, schema_version, adapter_type, provider, engine, model, configured_model,
independence_group, source_read_by, lane, raw_retention, context_sha256, records_digest.  ``records`` has handoff, document_id, engine,
engine_version, raw_response (a path), raw_sha256, page_sha256, review_status, flags: array, payload.  ``raw`` is (path, sha256),
as :func:`hashes` makes it.  A handoff with any finding gives no readings; findings are rows, nothing is raised.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..scratch import Scratch

# The schema, the lanes, each provider's engine prefix, the provider that routes to others, and the mark of a reader of its own.
SCHEMA, ADAPTER = "independent_extraction_handoff_v1", "ocr"
LANES = ("consensus_primary", "consensus_secondary", "consensus_tiebreaker")
PREFIXES = {"openai": "openai/", "google": "google_genai_vertex/", "openrouter": "openrouter/", "anthropic": "anthropic/"}
ROUTERS = ("openrouter",)
READ_BY_MODEL = "model"
# Suspects up to which the executors get all their hashes, and rows that one task of a meeting holds.
MOST_SENT, MEET_ROWS = 4_000_000, 500_000
RECORD = ("handoff", "document_id", "engine", "engine_version", "raw_response", "raw_sha256", "page_sha256", "review_status", "flags", "payload")


def hashes(spark: SparkSession, folder: str) -> DataFrame:
    """(path, sha256) of every file under ``folder``, each hashed in the task that reads it; paths are relative to the folder.

    A file is read whole, so it must stay under 2 GB; a raw response is one page.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    cut = F.regexp_replace("path", r"^[a-z]+:/*", "/")
    return files.select(F.substring(cut, len("/" + folder.split(":", 1)[-1].strip("/") + "/") + 1, 1 << 20).alias("path"), F.sha2("content", 256).alias("sha256"))


def digests(records: DataFrame) -> DataFrame:
    """(handoff, digest): a hash of a handoff's records that does not hang on their order; repeated records count.

    It sums the hashes of the records, so partial sums leave a task and not rows.
    """
    row = F.sha2(F.to_json(F.struct(*(c for c in RECORD if c != "handoff")), {"ignoreNullFields": "false"}), 256)
    long = lambda at: F.conv(F.substring(row, at, 15), 16, 10).cast("long")
    # sums of the upper and the lower 30 bits, each a long
    total = lambda x: (F.sum(F.shiftright(x, 30)).cast("decimal(28,0)") * (1 << 30) + F.sum(x.bitwiseAND(F.lit((1 << 30) - 1)))).cast("decimal(38,0)").cast("string")
    return records.groupBy("handoff").agg(F.concat_ws("-", F.count(F.lit(1)), total(long(1)), total(long(16))).alias("digest"))


def vendor_of(provider: Column, model: Column) -> Column:
    """Who made the model: the provider, or behind a router the first part of the model's name; null where that names nobody."""
    routed = F.lower(F.nullif(F.regexp_extract(model, "^([^/]+)/.", 1), F.lit("")))
    return F.when(provider.isin(*ROUTERS), routed).otherwise(provider)


def _lanes(headers: DataFrame) -> DataFrame:
    """Headers with their vendor and the first reason to refuse each; of two that clash the later is refused."""
    c = F.col
    first = headers.agg(F.min_by(F.struct("context_sha256"), "ordinal").alias("_first"))
    h = headers.withColumn("vendor", vendor_of(c("provider"), c("model"))).crossJoin(F.broadcast(first))  # one row
    earlier = lambda *k: F.row_number().over(Window.partitionBy(*k).orderBy("ordinal")) > 1
    h = h.withColumns({"_vendor_again": earlier("vendor"), "_lane_again": earlier("lane"), "_before": F.lag(F.struct("source_read_by")).over(Window.partitionBy("independence_group").orderBy("ordinal"))})
    prefix = F.create_map(*(F.lit(x) for kv in PREFIXES.items() for x in kv))[c("provider")]
    not_ = lambda x: ~F.coalesce(x, F.lit(False))
    own = F.coalesce((c("source_read_by") == READ_BY_MODEL) & (c("_before.source_read_by") == READ_BY_MODEL), F.lit(False))
    tests = {
        "invalid_schema_version": not_(c("schema_version") == SCHEMA),
        "adapter_type_is_not_ocr": not_(c("adapter_type") == ADAPTER),
        "unsupported_provider_or_engine": prefix.isNull() | c("engine").isNull(),
        "provider_does_not_match_engine": ~F.startswith(c("engine"), prefix) | (c("engine") == prefix),
        "model_does_not_match_engine": not_(c("engine") == F.concat(prefix, c("model"))),
        "configuration_does_not_match_model": F.coalesce(c("configured_model") != c("model"), F.lit(False)),
        "independence_group_is_not_the_provider": not_(c("independence_group") == c("provider")),
        "routed_vendor_unresolved": c("vendor").isNull(),
        "duplicate_vendor": c("_vendor_again"),
        "shared_router_without_own_reading": c("_before").isNotNull() & ~own,
        "invalid_lane": not_(c("lane").isin(*LANES)),
        "duplicate_lane": c("_lane_again"),
        "raw_retention_not_required": not_(c("raw_retention")),
        "corpus_context_differs": ~c("context_sha256").eqNullSafe(c("_first.context_sha256")),
    }
    return h.select(*headers.columns, "vendor", F.coalesce(*(F.when(t, n) for n, t in tests.items())).alias("reason"))


def _unproven(records: DataFrame, raw: DataFrame, tasks: int) -> DataFrame:
    """(_p): hashes of the paths whose records and files do not all state one SHA-256, or that no file has.

    A path goes by 64 bits and a SHA-256 by 127 of a hash of its own, so that three numbers a row are shuffled; the last bit tells files from records.
    """
    c = F.col
    last = F.lit(1).cast("long")
    side = lambda df, path, sha, bit: df.select(F.xxhash64(path).alias("_p"), F.xxhash64(sha).alias("_v"), F.shiftleft(F.xxhash64(F.lit("+"), sha), 1).bitwiseOR(F.lit(bit).cast("long")).alias("_w"))
    both = side(records, "raw_response", "raw_sha256", 0).unionByName(side(raw, "path", "sha256", 1)).repartition(tasks, "_p")
    rest, bit = F.shiftright("_w", 1), c("_w").bitwiseAND(last)
    met = both.groupBy("_p").agg(((F.min("_v") == F.max("_v")) & (F.min(rest) == F.max(rest)) & (F.max(bit) == 1)).alias("_same"), (F.min(bit) == 0).alias("_recorded"))
    return met.filter(c("_recorded") & ~c("_same")).select("_p")


def _judged(records: DataFrame, lanes: DataFrame, raw: DataFrame, s: Scratch) -> DataFrame:
    """(handoff, document_id, reason) of every record that has a reason.

    Files and equal documents are first sought by hashes alone; only the records that these or a record's own columns
    speak against are kept, and held against their files and each other by the whole text.
    """
    c = F.col
    same = lambda a, b: F.coalesce(c(a) == c(b), F.lit(False))
    blank = lambda x: F.trim(F.coalesce(c(x).cast("string"), F.lit(""))) == ""
    hexed = lambda x: F.coalesce((F.length(x) == 64) & (F.lower(F.hex(F.unhex(x))) == c(x)), F.lit(False))
    rows = records.select(*RECORD).join(F.broadcast(lanes.select("handoff", c("engine").alias("_engine"), c("model").alias("_model"))), "handoff", "left")
    stranger = c("_engine").isNull() & c("_model").isNull()
    mismatch = ~(same("engine", "_engine") & same("engine_version", "_model"))
    tasks = max(1, (records.count() + raw.count()) // MEET_ROWS)
    unproven = s.table(_unproven(records, raw, tasks))
    key = F.xxhash64("engine", "document_id")
    again = records.filter("engine is not null and document_id is not null").select(key.alias("_d")).repartition(tasks, "_d").groupBy("_d").agg(F.count(F.lit(1)).alias("_n"))
    again = s.table(again.filter("_n > 1").select("_d"))
    few = lambda df: (F.broadcast(df) if (n := df.count()) <= MOST_SENT else df, n)
    (bad, n_bad), (twice, n_twice) = few(unproven), few(again)
    held = rows.select("handoff", "document_id", "engine", "raw_response", "raw_sha256", "page_sha256", stranger.alias("_stranger"), mismatch.alias("_mismatch"), F.xxhash64("raw_response").alias("_p"), key.alias("_d"))
    held = held.join(bad.select("_p", F.lit(True).alias("_bad")), "_p", "left") if n_bad else held.withColumn("_bad", F.lit(None).cast("boolean"))
    held = held.join(twice.select("_d", F.lit(True).alias("_twice")), "_d", "left") if n_twice else held.withColumn("_twice", F.lit(None).cast("boolean"))
    own = c("_stranger") | c("_mismatch") | blank("raw_response") | ~hexed("raw_sha256") | ~hexed("page_sha256") | blank("document_id")
    held = s.table(held.filter(own | c("_bad") | c("_twice")).drop("_p", "_d"))
    files = raw.join(bad, F.xxhash64("path") == c("_p"), "left_semi") if n_bad else raw.limit(0)
    held = held.join(files.groupBy(c("path").alias("raw_response")).agg(F.min("sha256").alias("_found")), "raw_response", "left")
    held = held.join(held.filter("_twice").groupBy("engine", "document_id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1"), ["engine", "document_id"], "left")
    tests = {
        "record_of_no_handoff": c("_stranger"),
        "record_engine_does_not_match_handoff": c("_mismatch"),
        "record_has_no_raw_response": blank("raw_response"),
        "record_raw_evidence_invalid": ~hexed("raw_sha256") | (c("_bad").isNotNull() & c("_found").isNull()),
        "record_raw_response_changed": c("_bad").isNotNull() & ~same("raw_sha256", "_found"),
        "record_page_hash_invalid": ~hexed("page_sha256"),
        "record_has_no_document_id": blank("document_id"),
        "duplicate_engine_for_document": c("_n").isNotNull(),
    }
    return held.select("handoff", "document_id", F.coalesce(*(F.when(t, n) for n, t in tests.items())).alias("reason")).filter("reason is not null")


def load(headers: DataFrame, records: DataFrame, raw: DataFrame, expected: tuple[str, ...] = (), comment_only: bool = False) -> tuple[DataFrame, DataFrame]:
    """(readings, findings): verified readings, and (handoff, document_id, reason) of all that speaks against a handoff.

    A record must be of its handoff's engine and model, keep a raw response whose file has the stated hash, state a page's
    hash and a document, and be the only one of its engine for the document.  The records together must have the stated digest.
    A lane of ``expected`` that no handoff brings, and records of a handoff without a header, are findings too.  With ``comment_only``
    flags about handwriting do not block.  Lanes are a few rows whatever the corpus; records meet files by hashes of path and
    content, and are read again as readings, so that no record is shuffled or written whole.
    """
    s = Scratch(records.sparkSession, "handoffs")
    c = F.col
    told = s.table(_lanes(headers).join(digests(records), "handoff", "left"))
    lanes = told.drop("digest")
    none = F.lit(None).cast("string")
    empty = F.lit("0")
    changed = told.filter(~F.coalesce(c("records_digest") == F.coalesce("digest", empty), F.lit(False)))
    brought = lanes.select(c("lane")).distinct()
    wanted = records.sparkSession.createDataFrame([(x,) for x in expected], "lane string").join(brought, "lane", "left_anti")
    findings = lanes.filter("reason is not null").select("handoff", none.alias("document_id"), "reason")
    findings = findings.unionByName(changed.select("handoff", none.alias("document_id"), F.lit("records_digest_mismatch").alias("reason")))
    findings = findings.unionByName(_judged(records, lanes, raw, s))
    findings = s.table(findings.unionByName(wanted.select(none.alias("handoff"), none.alias("document_id"), F.concat(F.lit("handoff_missing:"), "lane").alias("reason"))))
    sound = lanes.join(findings.select("handoff").distinct(), "handoff", "left_anti").select("handoff", "lane", "provider", "model", "vendor")
    flags = F.coalesce("flags", F.array().cast("array<string>"))
    flags = F.filter(flags, lambda x: ~F.lower(x).contains("handwrit")) if comment_only else flags
    blocked = F.coalesce(c("review_status") == "open_exception", F.lit(False)) | (F.size(flags) > 0)
    readings = records.select(*RECORD).join(F.broadcast(sound), "handoff").select("document_id", "engine", "handoff", "lane", "provider", "model", "vendor", "page_sha256", "payload", blocked.alias("provider_blocked"))
    return readings, findings
