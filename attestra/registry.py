"""Where queries are registered, each beside its DuckDB twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .sources.driver_tables import Driver

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def edge(df: DataFrame) -> DataFrame:
    """Decimals leave as doubles, dates as text, so that both engines return one type."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        out.append(c.cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else c.cast("string").alias(f.name) if isinstance(f.dataType, T.DateType) else c)
    return df.select(*out)


def register(name: str, sql: str | None = None):
    """Register a query of the driver's tables under ``name``."""

    def wrap(f: Callable[[Driver], DataFrame]):
        QUERIES[name] = lambda spark, folder: edge(f(Driver(spark, folder)))
        if sql:
            SQL[name] = sql
        return f

    return wrap
