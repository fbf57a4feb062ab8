"""Handoffs written as files, then changed."""

import hashlib
import random

import pytest

from attestra.sources import handoffs

HEAD = "handoff string, ordinal int, schema_version string, adapter_type string, provider string, engine string, model string, configured_model string, independence_group string, source_read_by string, lane string, raw_retention boolean, context_sha256 string, records_digest string"
REC = "handoff string, document_id string, engine string, engine_version string, raw_response string, raw_sha256 string, page_sha256 string, review_status string, flags array<string>, payload string"


def head(name, i, provider="openai", model="m", lane="consensus_primary", digest=None, reader="model", context="n", **other):
    row = {"handoff": name, "ordinal": i, "schema_version": handoffs.SCHEMA, "adapter_type": "ocr", "provider": provider, "engine": handoffs.PREFIXES.get(provider, "?/") + (model or ""), "model": model, "configured_model": None, "independence_group": provider, "source_read_by": reader, "lane": lane, "raw_retention": True, "context_sha256": context, "records_digest": digest}
    return tuple((row | other).values())


def test_files_hashed_and_tampering_found(spark, tmp_path):
    (tmp_path / "x").mkdir()
    for n, text in (("1", "one"), ("2", "two")):
        (tmp_path / "x" / n).write_text(text)
    raw = handoffs.hashes(spark, str(tmp_path))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert sorted(map(tuple, raw.collect())) == [("x/1", sha("one")), ("x/2", sha("two"))]
    page = sha("page")
    rec = [("a", "D1", "openai/m", "m", "x/1", sha("one"), page, "clear", ["Handwriting seen"], "p"), ("a", "D2", "openai/m", "m", "x/2", sha("two"), page, "open_exception", None, "q")]
    records = spark.createDataFrame(rec, REC)
    digest = handoffs.digests(records).first().digest
    assert handoffs.digests(spark.createDataFrame(rec[::-1], REC)).first().digest == digest
    ok = spark.createDataFrame([head("a", 0, digest=digest)], HEAD)
    readings, findings = handoffs.load(ok, records, raw, ("consensus_primary",))
    assert findings.count() == 0 and {r.document_id: r.provider_blocked for r in readings.collect()} == {"D1": True, "D2": True}
    assert {r.document_id: r.provider_blocked for r in handoffs.load(ok, records, raw, comment_only=True)[0].collect()} == {"D1": False, "D2": True}
    (tmp_path / "x" / "2").write_text("two!")
    changed = spark.createDataFrame([(*rec[0][:9], "other"), rec[1]], REC)
    readings, findings = handoffs.load(ok, changed, handoffs.hashes(spark, str(tmp_path)), ("consensus_secondary",))
    assert readings.count() == 0
    assert sorted((r.handoff or "", r.document_id or "", r.reason) for r in findings.collect()) == [("", "", "handoff_missing:consensus_secondary"), ("a", "", "records_digest_mismatch"), ("a", "D2", "record_raw_response_changed")]


def test_identity_of_lanes(spark):
    rows = [
        head("a", 0), head("b", 1, "openrouter", "openai/m", "consensus_secondary"), head("c", 2, "openrouter", "ink/m", "consensus_secondary", reader=None), head("d", 3, "google", "g", "consensus_primary"),
        head("e", 4, "nobody"), head("f", 5, "anthropic", "c", "consensus_tiebreaker", context=None), head("g", 6, "openrouter", "slug"), head("h", 7, model=None), head("i", 8, configured_model="z"), head("j", 9, adapter_type="text"), head("k", 10, schema_version=None),
    ]
    got = {r.handoff: r.reason for r in handoffs._lanes(spark.createDataFrame(rows, HEAD)).collect()}
    assert got == {
        "a": None, "b": "duplicate_vendor", "c": "shared_router_without_own_reading", "d": "duplicate_lane", "e": "unsupported_provider_or_engine", "f": "corpus_context_differs", "g": "routed_vendor_unresolved",
        "h": "provider_does_not_match_engine", "i": "configuration_does_not_match_model", "j": "adapter_type_is_not_ocr", "k": "invalid_schema_version",
    }


def test_bad_records(spark):
    sha = "0" * 64
    rec = [("a", None, "openai/m", "m", "p", sha, sha, None, None, None), ("a", "D", "openai/m", "m", "", sha, sha, None, None, None), ("a", "E", "openai/m", "m", "p", "xyz", sha, None, None, None), ("a", "F", "openai/m", "m", "p", sha, None, None, None, None), ("a", "G", "openai/m", "m", "p", sha, sha, None, None, None), ("a", "G", "openai/m", "m", "p", sha, sha, None, None, None), ("z", "H", "x", "y", "p", sha, sha, None, None, None)]
    records = spark.createDataFrame(rec, REC)
    raw = spark.createDataFrame([("p", sha)], "path string, sha256 string")
    found = handoffs.load(spark.createDataFrame([head("a", 0)], HEAD), records, raw)[1]
    assert sorted((r.document_id or "", r.reason) for r in found.filter("reason like 'record_%' or reason like 'dup%'").collect()) == [
        ("", "record_has_no_document_id"), ("", "records_digest_mismatch"), ("D", "record_has_no_raw_response"), ("E", "record_raw_evidence_invalid"), ("F", "record_page_hash_invalid"), ("G", "duplicate_engine_for_document"), ("G", "duplicate_engine_for_document"), ("H", "record_of_no_handoff"),
    ]
    none = handoffs.load(spark.createDataFrame([], HEAD), records.limit(0), raw.limit(0))
    assert none[0].count() == 0 and none[1].count() == 0


def random_handoff(draw, n=400):
    """Records and files with every fault, and the reasons by plain search."""
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    raw = [(f"r{i}", draw.choice([sha(f"r{i}"), sha(f"r{i}"), sha("x"), sha(f"r{i}").upper(), None, "zz"])) for i in range(40) if i % 9] + [("r1", sha("x")), ("r2", sha("y")), (None, sha("x"))]
    rec = []
    for _ in range(n):
        path = draw.choice(["r%d" % draw.randrange(40)] * 9 + [None, " "])
        doc = draw.choice([f"D{draw.randrange(4 * n)}"] * 20 + [None, " "])
        rec.append((draw.choice("aaaz"), doc, draw.choice(["openai/m"] * 20 + ["openai/n", None]), draw.choice(["m"] * 20 + [None]), path, draw.choice([sha(str(path))] * 9 + [sha("x"), None, "zz", sha(str(path)).upper()]), draw.choice([sha("page")] * 20 + ["no", None]), "clear", None, "p"))
    found, same = {}, {}
    for path, x in raw:
        if x is not None:
            found[path] = min(found.get(path, x), x)
    for r in rec:
        same[r[2], r[1]] = same.get((r[2], r[1]), 0) + (r[1] is not None and r[2] is not None)
    hexed = lambda x: x is not None and len(x) == 64 and not set(x) - set("0123456789abcdef")
    reasons = []
    for h, doc, engine, version, path, stated, page, *_ in rec:
        at = found.get(path) if path is not None else None
        tests = (
            (h != "a", "record_of_no_handoff"), ((engine, version) != ("openai/m", "m"), "record_engine_does_not_match_handoff"), (not (path or "").strip(), "record_has_no_raw_response"), (not hexed(stated) or at is None, "record_raw_evidence_invalid"),
            (stated != at, "record_raw_response_changed"), (not hexed(page), "record_page_hash_invalid"), (not (doc or "").strip(), "record_has_no_document_id"), (same[engine, doc] > 1, "duplicate_engine_for_document"),
        )
        reasons += [(h, doc or "", name) for bad, name in tests if bad][:1]
    return rec, raw, sorted(reasons)


@pytest.mark.parametrize("sent", [0, 4_000_000])
def test_every_fault_by_both_ways(spark, monkeypatch, sent):
    monkeypatch.setattr(handoffs, "MOST_SENT", sent)
    monkeypatch.setattr(handoffs, "MEET_ROWS", 50)
    rec, raw, want = random_handoff(random.Random(5))
    found = handoffs.load(spark.createDataFrame([head("a", 0)], HEAD), spark.createDataFrame(rec, REC), spark.createDataFrame(raw, "path string, sha256 string"))[1]
    assert sorted((r.handoff, r.document_id or "", r.reason) for r in found.collect() if r.reason != "records_digest_mismatch") == want and len({x[2] for x in want}) == 8


def test_records_are_not_written_whole(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("attestra.scratch.base_dir", lambda _: f"file://{tmp_path}")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    payload = lambda i: "".join(sha(f"{i} {n}") for n in range(30))
    records = spark.createDataFrame([("a", f"D{i}", "openai/m", "m", f"r{i}", sha(f"r{i}"), sha("page"), "clear", None, payload(i)) for i in range(500)], REC)
    raw = spark.createDataFrame([(f"r{i}", sha(f"r{i}")) for i in range(500)], "path string, sha256 string")
    readings, findings = handoffs.load(spark.createDataFrame([head("a", 0, digest=handoffs.digests(records).first().digest)], HEAD), records, raw)
    assert findings.count() == 0 and {(r.document_id, r.payload) for r in readings.collect()} == {(f"D{i}", payload(i)) for i in range(500)}
    assert sum(p.stat().st_size for p in tmp_path.rglob("*") if p.is_file()) < 100_000
