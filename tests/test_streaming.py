"""The journal as a stream gives the batch's latest state."""

from attestra.streaming import journal


def test_latest_state_by_stream(spark, tmp_path):
    rows = [(u, f"2024-01-01 00:{m:02d}:00", m, f"t{m}") for u in (1, 2) for m in range(6)]
    df = spark.createDataFrame(rows, "user_id int, ts string, event_id int, event_type string")
    src = str(tmp_path / "in")
    df.repartition(3).write.parquet(src)
    stream = journal.stream_of(spark, src, df.schema)
    journal.run_latest_state(stream, str(tmp_path / "out"), str(tmp_path / "ck"), "user_id", "ts", "event_id", ["event_type"])
    out = journal.latest_state(spark.read.parquet(str(tmp_path / "out")).drop("batch"), "user_id", "ts", "event_id", ["event_type"])
    assert {(r.user_id, r.event_type) for r in out.collect()} == {(1, "t5"), (2, "t5")}
