"""The change journal and addresses."""

import pytest
from pyspark.sql import functions as F

from attestra.functions.address import parse_address
from attestra.operators import changes


@pytest.mark.parametrize(
    "text, want",
    [
        ("1 Main St, Springfield, IL 62704", ("1 Main St", None, "Springfield", "IL", "62704", "US", None)),
        ("1 Main St, Springfield, IL, 62704", ("1 Main St", None, "Springfield", "IL", "62704", "US", None)),
        ("Unit 4, 2 Rue Nord, Laval QC H7A 1B2, Canada", ("Unit 4", "2 Rue Nord", "Laval", "QC", "H7A1B2", "CA", None)),
        ("1 High St, Leeds 62704, UK", ("1 High St", None, "Leeds 62704", None, None, "GB", "address_country_postal_mismatch")),
        ("", (None, None, None, None, None, None, "address_parse_incomplete")),
    ],
)
def test_address(spark, text, want):
    r = spark.createDataFrame([(text,)], "c string").select(parse_address(F.col("c")).alias("a")).first().a
    assert tuple(r) == want


def test_journal_flow(spark):
    past = spark.createDataFrame([("o", "p", "k1", "h1")], "owner string, kind string, request_key string, request_hash string")
    req = spark.createDataFrame([("o", "p", "k1", "h1"), ("o", "p", "k1", "h1"), ("o", "p", "k2", "h2"), ("x", "p", "k1", "h9")], past.schema)
    assert {(r.owner, r.request_key): r.outcome for r in changes.admit(past, req).collect()} == {("o", "k1"): "repeated", ("o", "k2"): "new", ("x", "k1"): "new"}
    now = spark.createDataFrame([("a", "f", "1"), ("b", "f", "2"), ("c", "f", "3")], "key string, field string, value string")
    prop = spark.createDataFrame([("c1", "o", "a", "f", "1", "9"), ("c2", "o", "b", "f", "1", "9"), ("c3", "o", "c", "f", "3", "8")], "change_id string, owner string, key string, field string, expected string, proposed string")
    seen = changes.preview(prop, now)
    assert {r.change_id: r.status for r in seen.collect()} == {"c1": "ready", "c2": "stale", "c3": "ready"}
    auth = spark.createDataFrame([("c1", "m", "2025"), ("c3", "o", "2025")], "change_id string, authorised_by string, expires_at string")
    gated = changes.authorised(seen, auth, "2024")
    assert {r.change_id: r.gate for r in gated.collect()} == {"c1": "open", "c3": "same_person"}
    none = spark.createDataFrame([], "change_id string")
    rows, log = changes.apply_once(now, gated, none)
    assert {r.key: (r.prior_value, r.value) for r in rows.collect()} == {"a": ("1", "9"), "b": ("2", "2"), "c": ("3", "3")}
    again, more = changes.apply_once(rows.select("key", "field", "value"), gated, log)
    assert more.count() == 0 and {r.key: r.value for r in again.collect()}["a"] == "9"
    assert changes.reconcile(prop.filter("change_id = 'c1'"), rows).count() == 0
