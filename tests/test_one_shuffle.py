"""Readings are dealt once, by document; what is asked of their cells needs no further shuffle."""

import pytest
from pyspark.sql import functions as F

from attestra.operators import consensus, decisions
from attestra.sources import driver_tables
from attestra.sources.driver_tables import Driver

FOLDER = "/root/testdata/sf0.001"


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.mark.parametrize("make", [consensus.field_consensus, lambda r: consensus.document_rollup(consensus.field_consensus(r)), lambda r: consensus.independent_readers(r, {"a": "x", "b": "x"}), lambda r: decisions.handwriting(r.select("document_id", F.col("row_index").alias("page_id"), F.col("field").alias("region_id"), F.col("field").alias("kind"), F.lit(False).alias("numeric"), F.col("vendor").alias("group"), "value", F.lit(1).alias("iteration")))])
def test_cells_are_not_shuffled_again(spark, make):
    assert exchanges(make(Driver(spark, FOLDER).readings())) == 1


def test_tasks_follow_the_lines(spark, monkeypatch):
    monkeypatch.setattr(driver_tables, "LINES", 100)
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet").count()
    assert Driver(spark, FOLDER).readings().rdd.getNumPartitions() == lines // 100


def test_texts_with_digits_of_any_script_are_numbers(spark):
    df = spark.createDataFrame([("1,200.50",), ("$7",), ("-.5",), ("A",), ("",), (None,), ("1a",), ("٧",), ("x7",)], "v string")
    before = F.translate("v", ",$ ", "").try_cast("decimal(38,4)")
    got = df.select(consensus.as_number(F.col("v")).alias("a"), before.alias("b")).collect()
    assert [r.a for r in got] == [r.b for r in got] and sum(r.a is not None for r in got) >= 3


REGION = "document_id string, page_id int, region_id string, kind string, numeric boolean, group string, value string, iteration int"


def test_handwriting_counts_groups_once_and_names_ties(spark):
    row = lambda i, group, value, numeric=False: ("D", i, "r", "text", numeric, group, value, 1)
    rows = [row(1, "a", "Yes"), row(1, "a", "yes"), row(1, "b", "no"), row(2, "a", "yes"), row(2, "b", "YES "), row(2, "c", "no"), row(3, None, "x"), row(3, "a", None), row(4, "a", "1", True), row(4, "b", "1.0", True), row(4, "c", "$1", True), row(5, None, "x"), row(5, "b", "y")]
    got = {r.page_id: (r.value, r.review_reason) for r in decisions.handwriting(spark.createDataFrame(rows, REGION)).collect()}
    assert got == {1: (None, "text_below_agreement"), 2: ("yes", None), 3: (None, "missing_or_invalid_reading"), 4: ("1.0000", "numeric_requires_review"), 5: (None, "text_below_agreement")}
