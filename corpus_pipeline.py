"""The training-data pipeline: five stages, each a dealt operator over all its predecessor kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; :func:`run` writes each
result as Parquet in the shared folder and reads it again as the next stage's documents.

In all stages a null text is an empty one, texts of any length are read whole, further columns come
through whatever their names, and an empty table gives an empty table.  A null id is an id
like others and comes before them in order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestra.llm.decontaminate import contamination
from attestra.llm.mixing import mix
from attestra.llm.quality import keep_quality
from attestra.llm.simhash import one_of_each
from attestra.llm.suffix import remove_repeats
from attestra.scratch import Scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go.

    Each row is judged by its own text: repeated rows and rows of one id each keep or lose their
    place on their own, a null id is unlabelled, and an empty text has a score like others.
    """
    return keep_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component one row stays: that with the smallest id, null last.

    Of several rows with that id the one with the smallest hash of its text stays, of rows that
    also share the text that with the smallest hash of all columns, and of equal rows one.  Empty
    and null texts are one component.
    """
    return one_of_each(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every 100-byte string that starts earlier is cut; a character cut in two goes whole, n_chars follows.

    Every row stays, if with an empty text; rows of one id do not cut each other's equal places.
    """
    plain, name = _numbered(docs)
    rest = tuple(name[c] for c in docs.columns if c not in ("doc_id", "text", "n_chars"))
    cut = remove_repeats(plain, name["doc_id"], name["text"], keep="text", carry=rest)
    made = {"text": F.col("kept"), "n_chars": F.char_length("kept").cast("long")}
    return cut.select(*(made.get(c, F.col(name[c])).alias(c) for c in docs.columns))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated with benchmark passages go; rows are judged one by one, empty texts are clean."""
    plain, name = _numbered(docs)
    rest = tuple(name[c] for c in docs.columns if c != "doc_id")
    found = contamination(plain, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), name["doc_id"], name["text"], carry=rest)
    return found.filter(~F.col("contaminated")).select(*(F.col(name[c]).alias(c) for c in docs.columns))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled to raked weights of source, language and topic.

    A row's draw hangs on its id alone, so rows of one id in one cell stay or go together; empty
    texts are in no cell and go.
    """
    return mix(docs)


def _numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """(docs with columns called by number, the name of each): no name clashes with an operator's results."""
    name = {c: f"column_{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*name.values()), name


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_strings", repeated_strings),
    ("decontaminate", decontaminate),
    ("mixture", mixture),
]

#: The quality classifier and the fingerprints can't be put in SQL; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    s = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES[:-1]:
        docs = s.table(stage(spark, docs, sf_dir))
        if before is not None:
            s.drop(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
