"""Sources: envelopes, side channels, snapshots that refuse tampering."""

import json

import pytest
from pyspark.sql import types as T

from attestra.sources import snapshot

ROW = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])


def test_envelope_and_record_list(spark, tmp_path):
    (tmp_path / "e.json").write_text(json.dumps({"batch_id": "b", "tables": {"t": [{"k": "x", "v": 1}, {"k": None, "v": 2}]}}))
    got = snapshot.export_tables(spark, str(tmp_path / "e.json"), {"t": ROW})["t"].collect()
    assert [(r.k, r.v, r._batch_id, r.ordinal) for r in got] == [("x", 1, "b", 0), (None, 2, "b", 1)]
    (tmp_path / "r.json").write_text(json.dumps({"results": [{"k": "x", "v": 1}]}))
    assert snapshot.record_list(spark, str(tmp_path / "r.json"), ROW).count() == 1


def test_side_channel(spark, tmp_path):
    (tmp_path / "l.csv").write_text("Period,Amount\n2024-01,\"1,000\"\n2024-02,abc\n,5\n")
    good, bad = snapshot.side_channel(spark, str(tmp_path / "l.csv"), ["period", "amount"], ["amount"])
    assert good.count() == 1 and {r.reason for r in bad.collect()} == {"amount_is_not_a_number", "period_is_empty"}
    with pytest.raises(ValueError, match="missing columns"):
        snapshot.side_channel(spark, str(tmp_path / "l.csv"), ["vendor"])


def test_snapshot_round_trip_and_tamper(spark, tmp_path):
    t = spark.createDataFrame([("x", 1), ("", 2), (None, 3)], ROW)
    path = str(tmp_path / "s")
    snapshot.build(spark, {"t": t, "u": t.limit(0)}, path)
    got = snapshot.open_snapshot(spark, path)
    assert {tuple(r) for r in got["t"].collect()} == {("x", 1), ("", 2), (None, 3)} and got["u"].count() == 0
    with pytest.raises(Exception):
        snapshot.build(spark, {"t": t}, path)
    lost = spark.read.parquet(f"{path}/t").filter("v <> 3").collect()
    spark.createDataFrame(lost, "k string, v long, row_sha256 string").write.mode("overwrite").parquet(f"{path}/t")
    with pytest.raises(ValueError, match="manifest"):
        snapshot.open_snapshot(spark, path)


def test_import_package_names_what_is_left(spark):
    t = spark.createDataFrame([("x", 1)], ROW)
    out, left = snapshot.import_package({"t": t}, {"o": ("t", {"k": "key"})})
    assert out["o"].columns == ["key"] and left == {"t": ["v"]}


def test_staging_package(spark, tmp_path):
    t = spark.createDataFrame([('a "q", b\nnew', 1), ("", 2), (None, None), (" pad ", 4), ("back\\slash", 5)], ROW)
    where = str(tmp_path / "stage")
    snapshot.stage_package(spark, [("t", t), ("none", t.limit(0))], where)
    back = snapshot.open_package(spark, where)
    assert sorted(map(str, back["t"].collect())) == sorted(str(r) for r in t.select("k", t.v.cast("string")).collect())
    assert back["none"].count() == 0
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        snapshot.stage_package(spark, [("t", t)], where)
    part = next(p for p in (tmp_path / "stage" / "00_t").glob("part-*.csv") if "pad" in p.read_text())
    part.write_text(part.read_text().replace(" pad ,", " bad ,"))
    (part.parent / f".{part.name}.crc").unlink(missing_ok=True)
    with pytest.raises(ValueError, match="columns that differ"):
        snapshot.open_package(spark, where)
