"""Neighbourhoods, question packs, unsettled candidates and payments against plain Python."""

import json
import random

import pytest

from attestra.numbering import numbered
from attestra.operators import neighbours, payments, questions, surface
from attestra.scratch import Scratch


def plain(tokens, targets, size, cap):
    held = {}
    for d, t in tokens:
        if d is not None and t is not None:
            held.setdefault(d, set()).add(t)
    out, skipped = {}, {}
    for d, _ in sorted(targets, key=lambda x: (x[1], x[0])):
        shared = {o: held[o] & held.get(d, set()) for o in held if o != d and held[o] & held.get(d, set())}
        if not shared:
            skipped[d] = "cross_packet_no_shared_source_identifier"
        elif cap is not None and len(out) >= cap:
            skipped[d] = "cross_packet_discovery_deferred_by_cap"
        else:
            near = sorted(shared, key=lambda o: (-len(shared[o]), o))[: size - 1]
            out[d] = (near, sorted(set().union(*(shared[o] for o in near))))
    return out, skipped


@pytest.mark.parametrize("light,cap", [(1, None), (3, None), (3, 20), (64, None)])
def test_neighbourhoods(spark, light, cap):
    rng = random.Random(light)
    tokens = [(f"d{i:03}", f"t{min(int(rng.expovariate(0.12)), 60)}") for i in range(90) for _ in range(rng.randrange(0, 6))] + [("d001", None), (None, "t1"), ("d002", "t0"), ("d002", "t0")]
    targets = [(f"d{i:03}", (i * 7) % 13) for i in range(95) if i % 4]
    got, skipped = neighbours.neighbourhoods(spark.createDataFrame(tokens, "document_id string, token string"), spark.createDataFrame(targets, "document_id string, ordinal int"), 5, cap, light=light)
    want, wanted = plain(tokens, targets, 5, cap)
    assert {r.document_id: (r.related, r.tokens) for r in got.collect()} == want
    assert {r.document_id: r.reason for r in skipped.collect()} == wanted


def test_identifiers_and_packets(spark):
    leaves = [("a", "lines[0].po_number", '"  PO   7 "'), ("a", "note", '"PO 7"'), ("a", "vendor.name", '"Ä"'), ("a", "vendor.name", '"---"'), ("a", "job", "17"), ("b", "Party[1]", '"po 7"'), ("b", None, None), ("b", "job", '"' + "x" * 121 + '"')]
    got = neighbours.identifiers(spark.createDataFrame(leaves, "document_id string, path string, value string"))
    assert sorted(map(tuple, got.collect())) == [("a", "po 7"), ("b", "po 7")]
    found, none = neighbours.neighbourhoods(got, spark.createDataFrame([("a", 1)], "document_id string, ordinal int"), 2)
    sizes = neighbours.packets(found, spark.createDataFrame([("a", "ää"), ("b", "xyz"), ("c", None)], "document_id string, record string"), 6)
    assert [tuple(r) for r in sizes.collect()] == [("a", 2, 7, "packet_exceeds_context_bytes")] and none.count() == 0
    empty = spark.createDataFrame([], "document_id string, token string")
    assert neighbours.neighbourhoods(empty, spark.createDataFrame([("a", 1)], "document_id string, ordinal int"), 2)[0].count() == 0
    with pytest.raises(ValueError):
        neighbours.neighbourhoods(empty, empty, 1)


def test_numbered_over_ranges(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["hot", "hot", "hot", "b", None]), i) for i in range(400)]
    got = numbered(spark.createDataFrame(rows, "g string, i int"), Scratch(spark, "t"), ("g",), ("i",)).collect()
    for g in {"hot", "b", None}:
        assert [r.position for r in sorted((r for r in got if r.g == g), key=lambda r: r.i)] == list(range(1, sum(x == g for x, _ in rows) + 1))


def test_pack(spark):
    rng = random.Random(5)
    groups = [("g1", "amounts", False), ("g2", "amounts", True), ("g3", "document_wrapper", None), ("g4", "new", False), ("g5", "new", False)]
    items = [(i, rng.choice(["g1", "g1", "g1", "g2", "g3", "g4", None]), rng.choice([f"d{i % 37:02}", f"d{i % 11:02}", None]), rng.choice([f"p{i % 50}", ""]), f"f{i % 3}", "r", [f" {i % 9} ", ""], rng.choice(["High", "normal", None])) for i in range(300)]
    schema = "item_index long, group_id string, document_id string, page_id string, field string, reason string, candidates array<string>, priority string"
    wording = spark.createDataFrame([("amounts", "Which is right?", "choose_reading"), ("document_wrapper", "Covers", None)], "finding_family string, headline string, decision_choice string")
    dull = [(f"p{i}",) for i in range(0, 50, 3)] + [("d03",), (None,)]
    got = questions.pack(spark.createDataFrame(groups, "group_id string, finding_family string, protected boolean"), spark.createDataFrame(items, schema), wording, 3, spark.createDataFrame(dull, "page_id string"))
    asked = {r.group_id: r for r in got["questions"].collect()}
    size = lambda g: sum(x[1] == g for x in items)
    order = sorted(groups, key=lambda g: (bool(g[2]), -size(g[0]), g[0]))
    assert [asked[g[0]].question_id for g in order] == ["Q001", "Q002", "Q003", "Q004", "Q005"]
    assert [asked[g[0]].deferred for g in order] == [False, False, False, True, True]
    assert not asked["g3"].client_answer_permitted and not asked["g2"].batch_clear_permitted and asked["g4"].generic_wording and asked["g5"].items == 0
    members = {r.item_index: r.question_id for r in got["members"].collect()}
    assert members == {x[0]: asked[x[1]].question_id if x[1] else None for x in items}
    shown = {}
    for r in got["examples"].collect():
        shown.setdefault(r.group_id, []).append((r.place, r.document_id, r.page_id, r.field))
    read = [str(int(x)) for x in dict.fromkeys(r.candidates[0] for r in sorted((r for r in got['examples'].collect() if r.group_id == 'g1'), key=lambda r: r.place))]
    assert asked['g1'].what_we_read == ' | '.join(read)
    pages = {p for (p,) in dull}
    for g in ("g1", "g2", "g3", "g4"):
        mine = sorted((x for x in items if x[1] == g), key=lambda x: (not (x[3] or x[2]), x[2] or "", x[4], x[0]))
        docs = {}
        for x in mine:
            docs.setdefault(x[2] or x[3] or "", x)
        good = [x for x in docs.values() if (x[3] or x[2] or "") not in pages] or list(docs.values())
        at = range(len(good)) if len(good) <= 3 else [round(i * (len(good) - 1) / 2) for i in range(3)]
        assert sorted(shown[g]) == [(i + 1, good[i][2] or "", good[i][3] or good[i][2] or "", good[i][4]) for i in at]
    total = got["summary"].first()
    assert (total.questions, total.deferred, total.queue_items) == (3, 2, 300) and total.items_covered == sum(size(g[0]) for g in order[:3])


def test_blocks(spark):
    rows = [("consensus_x", None, None), ("table_y", None, "No_Action"), ("odd", None, None), ("graph", False, None), ("validate", True, ""), ("validate", None, "")]
    got = questions.blocks(spark.createDataFrame(rows, "source string, blocking boolean, disposition string"), ("source",), {"validation": 3})
    assert {r.control: (r.blocking_items, r.threshold, r.triggered) for r in got.collect()} == {"consensus": (1, 1, True), "unclassified": (1, 1, True), "validation": (2, 3, False)}


def test_surface(spark):
    deep = {"z": [{"note": "ask for Attn. Ines"}], "a/b": "ines@host.example", "n": 5}
    docs = [
        (0, "A", json.dumps({"sales/rep": {"candidate_values": ["Ines", None, deep], "consensus_flag": "split"}, "total": {"candidate_values": [1], "accepted": True}, "odd": 3, "list": {"candidate_values": "x"}, "none": {}})),
        (1, " ", "{}"), (2, "B", None), (3, "C", "[1]"), (4, "D", json.dumps({"sales/rep": {"candidate_values": ["Ines", "+1 (555) 555-0123", "2024-01-05"], "accepted": "true", "consensus_flag": 7}})),
    ]
    kept = surface.Retained(spark.createDataFrame(docs, "index long, document_id string, fields string"))
    assert sorted((r["index"], r.reason.removeprefix("candidate_inventory_")) for r in kept.exceptions.collect()) == [(0, "field_claim_malformed"), (0, "values_malformed"), (1, "document_id_missing"), (2, "fields_missing"), (3, "fields_missing")]
    at = "/documents/0/fields/sales~1rep/candidate_values/2"
    assert sorted((r.signal, r.pointer, r.text) for r in kept.signals.collect()) == [("attention", at + "/z/0/note", "ask for Attn. Ines"), ("email", at + "/a~1b", "ines@host.example"), ("phone", "/documents/4/fields/sales~1rep/candidate_values/1", "+1 (555) 555-0123")]
    (r,) = surface.surface(kept, 2).collect()
    assert (r.field, r.occurrences, r.documents, r.distinct_values, r.flags, r.document_ids, len(r.values)) == ("sales/rep", 5, 2, 4, ["split"], ["A", "D"], 2)
    assert surface.surface(kept, 2).first().topics == ["party", "sales_representative"]
    scope = surface.recovery_scope(kept, (), ("email",))
    assert [tuple(x) for x in scope["documents"].collect()] == [("A", 0, 1)] and scope["candidates"].count() == 0
    assert {x.document_id: x.candidates for x in surface.recovery_scope(kept, ("party",))["documents"].collect()} == {"A": 2, "D": 3}
    assert surface.surface(surface.Retained(spark.createDataFrame([], "index long, document_id string, fields string")), 1).count() == 0
    with pytest.raises(ValueError):
        surface.recovery_scope(kept, ("weather",))


def test_payments(spark, tmp_path):
    data = {"payments": [
        {"vendor": "Alder", "currency": "usd", "applied": [{"invoice_number": "1", "amount_applied": "60"}, {"invoice_number": " ", "amount_applied": "3"}, {"invoice_number": "1", "vendor": "Birch", "amount": "5"}]},
        {"invoice_number": "2", "total_paid": "10.00"}, {"invoice_number": "3", "amount": "1"}, {"invoice_number": "9", "amount": "1"}, {"payee": "ALDER ", "invoice_number": "2", "amount": "30", "applied": []},
    ]}
    (tmp_path / "p.json").write_text(json.dumps(data))
    applied = payments.applications(payments.read_payments(spark, str(tmp_path / "p.json")))
    assert sorted((r.invoice_number or "", r.vendor or "", r.currency or "", float(r.amount)) for r in applied.collect()) == [("", "alder", "USD", 3.0), ("1", "alder", "USD", 60.0), ("1", "birch", "USD", 5.0), ("2", "", "", 10.0), ("2", "alder", "", 30.0), ("3", "", "", 1.0), ("9", "", "", 1.0)]
    events = [("a", "invoice", "ALDER", "1", "USD", 100, 0, ""), ("b", "invoice", "Birch", "1", "USD", 5, 0, None), ("c", "invoice", "Alder", "2", "", 30, 0, ""), ("d", "invoice", "Birch", "2", "", 10, 0, ""), ("e", "invoice", "X", "3", None, 1, 0, ""), ("f", "invoice", "X", "3", None, 1, 0, "Paid"), ("g", "memo", "X", "4", None, 1, 0, ""), ("h", "unknown", None, None, None, 7, 7, "")]
    out, bad = payments.close_open_items(spark.createDataFrame(events, "document_id string, doc_type string, vendor string, invoice_number string, currency string, amount int, credits int, explicit_status string"), applied)
    assert {r.document_id: (r.closure, float(r.balance)) for r in out.collect()} == {"a": ("partial", 40.0), "b": ("closed", 0.0), "c": ("closed", 0.0), "d": ("unresolved", 10.0), "e": ("unresolved", 1.0), "f": ("closed", 1.0), "h": ("closed", 0.0)}
    assert sorted((r.invoice_number or "", r.reason, r.candidates) for r in bad.collect()) == [("", "payment_row_has_no_invoice_number", 0), ("2", "ambiguous", 2), ("3", "ambiguous", 2), ("9", "no_invoice", 0)]
    assert [(r.document_id, r.all_items, float(r.all_balance)) for r in payments.largest(out, "unresolved", 1).collect()] == [("d", 2, 11.0)]
    (tmp_path / "p.csv").write_text('Invoice Number,Vendor Name,amount\n1,"Al, der",5\n')
    assert payments.applications(payments.read_payments(spark, str(tmp_path / "p.csv"))).first().vendor == "al, der"
