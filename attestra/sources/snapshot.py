"""Exports and snapshots: the JSON envelope, record lists, side-channel CSV, and immutable Parquet snapshots.

A snapshot is a folder of one Parquet table a relation, each row with its place and hash,
and a manifest of counts and checksums.  It is built once; opening verifies it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def export_tables(spark: SparkSession, path: str, schemas: dict[str, T.StructType]) -> dict[str, DataFrame]:
    """The tables of an export envelope {batch_id, registry_version, tables}, each row with its batch and ordinal."""
    shape = T.StructType([T.StructField("batch_id", T.StringType()), T.StructField("registry_version", T.StringType()), T.StructField("tables", T.StructType([T.StructField(n, T.ArrayType(s)) for n, s in schemas.items()]))])
    doc = spark.read.schema(shape).json(path, multiLine=True)
    out = {}
    for name in schemas:
        rows = doc.select("batch_id", F.posexplode(F.col(f"tables.{name}")).alias("ordinal", "row"))
        out[name] = rows.select("row.*", F.col("batch_id").alias("_batch_id"), "ordinal")
    return out


def record_list(spark: SparkSession, path: str, record: T.StructType) -> DataFrame:
    """Records under any of documents, results, attributions or records of a JSON file."""
    names = ("documents", "results", "attributions", "records")
    shape = T.StructType([T.StructField(n, T.ArrayType(record)) for n in names])
    doc = spark.read.schema(shape).json(path, multiLine=True)
    return doc.select(F.posexplode(F.coalesce(*names)).alias("ordinal", "r")).select("r.*", "ordinal")


def side_channel(spark: SparkSession, path: str, required: list[str], numbers: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with a reason) of a CSV whose header is normalised to snake case."""
    raw = spark.read.option("header", True).option("mode", "PERMISSIVE").csv(path)
    named = raw.toDF(*(c.strip().lower().replace(" ", "_") for c in raw.columns))
    if set(required) - set(named.columns):
        raise ValueError(f"missing columns {sorted(set(required) - set(named.columns))}")
    reason = F.lit(None).cast("string")
    for c in reversed(numbers):
        bad = F.col(c).isNotNull() & F.regexp_replace(c, r"[,$\s]", "").try_cast("decimal(38,6)").isNull()
        reason = F.when(bad, f"{c}_is_not_a_number").otherwise(reason)
    for c in reversed(required):
        reason = F.when(F.col(c).isNull() | (F.trim(c) == ""), f"{c}_is_empty").otherwise(reason)
    judged = named.withColumn("reason", reason)
    return judged.filter("reason is null").drop("reason"), judged.filter("reason is not null")


def row_hash(columns: list[str]) -> Column:
    """SHA-256 of the row's columns in name order; null and the empty text differ."""
    return F.sha2(F.concat_ws("\x1f", *(F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("0")) for c in sorted(columns))), 256)


def _state(table: DataFrame) -> DataFrame:
    """Count and an order-free checksum of the row hashes."""
    return table.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.conv(F.substring("row_sha256", 1, 12), 16, 10).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).cast("string").alias("checksum"))


def build(spark: SparkSession, tables: dict[str, DataFrame], path: str) -> None:
    """Write a snapshot; an existing one is never replaced.  The manifest comes last, so a half-built folder does not open."""
    for name, t in tables.items():
        t.withColumn("row_sha256", row_hash(t.columns)).write.mode("errorifexists").parquet(f"{path}/{name}")
    states = [_state(spark.read.parquet(f"{path}/{name}")).select(F.lit(name).alias("table"), "rows", "checksum") for name in tables]
    manifest = states[0]
    for s in states[1:]:
        manifest = manifest.unionByName(s)
    manifest.coalesce(1).write.mode("errorifexists").json(f"{path}/_snapshot_manifest")


def open_snapshot(spark: SparkSession, path: str, verify: bool = True) -> dict[str, DataFrame]:
    """The tables of a snapshot; a changed row, a lost row or a lost table is refused."""
    manifest = spark.read.schema("table string, rows long, checksum string").json(f"{path}/_snapshot_manifest").collect()
    out = {}
    for m in manifest:
        t = spark.read.parquet(f"{path}/{m.table}")
        if verify:
            hashed = [c for c in t.columns if c != "row_sha256"]
            if t.filter(row_hash(hashed) != F.col("row_sha256")).limit(1).count():
                raise ValueError(f"snapshot table {m.table} has a changed row")
            now = _state(t).first()
            if (now.rows, now.checksum) != (m.rows, m.checksum):
                raise ValueError(f"snapshot table {m.table} does not match its manifest")
        out[m.table] = t.drop("row_sha256")
    return out


def import_package(tables: dict[str, DataFrame], mapping: dict[str, tuple[str, dict[str, str]]]) -> tuple[dict[str, DataFrame], dict[str, list[str]]]:
    """(import objects by rename maps {object: (table, {source: target})}, source columns that no map carries)."""
    out, used = {}, {}
    for name, (table, columns) in mapping.items():
        out[name] = tables[table].select(*(F.col(a).alias(b) for a, b in columns.items()))
        used.setdefault(table, set()).update(columns)
    return out, {t: sorted(set(tables[t].columns) - used.get(t, set())) for t in tables}


CANONICAL, CANONICAL_SHA256 = "__canonical_row_json", "__canonical_row_sha256"
_CSV = {"header": True, "escape": '"', "emptyValue": "", "multiLine": True, "enforceSchema": False, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
_STEP = "step int, table string, path string, columns array<string>, rows long, checksum string"


def stage_package(spark: SparkSession, plan: list[tuple[str, DataFrame]], path: str) -> None:
    """Write a staging package: a CSV folder a load step, each row with its canonical JSON and that text's hash.

    Every file is read back and held against the rows it came from before the manifest, which publishes
    the package, is written.  An existing package is never replaced.
    """
    steps = []
    for i, (name, t) in enumerate(plan):
        if {CANONICAL, CANONICAL_SHA256} & set(t.columns):
            raise ValueError(f"table {name} has a control column of its own")
        texts = t.select(*(F.col(f"`{c}`").cast("string").alias(c) for c in t.columns))
        rows = texts.withColumn(CANONICAL, F.to_json(F.struct(*(F.col(f"`{c}`") for c in sorted(t.columns))))).withColumn(CANONICAL_SHA256, F.sha2(CANONICAL, 256))
        where = f"{i:02d}_{name}"
        rows.write.mode("errorifexists").options(**_CSV).csv(f"{path}/{where}")
        state = _state(rows.select(F.col(CANONICAL_SHA256).alias("row_sha256"))).first()
        steps.append((i, name, where, rows.columns, state.rows, state.checksum))
    manifest = spark.createDataFrame(steps, _STEP)
    for step in manifest.collect():
        _staged(spark, path, step)
    manifest.coalesce(1).write.mode("errorifexists").json(f"{path}/_staging_manifest")


def _staged(spark: SparkSession, path: str, step: T.Row) -> DataFrame:
    """A step's rows as texts, or an error that names what differs."""
    shape = T.StructType([T.StructField(c, T.StringType()) for c in step.columns])
    rows = spark.read.schema(shape).options(**_CSV).csv(f"{path}/{step.path}")
    shown = [c for c in step.columns if c not in (CANONICAL, CANONICAL_SHA256)]
    held = F.from_json(CANONICAL, "map<string,string>")
    text = lambda c: F.coalesce(c, F.lit(""))
    same = F.lit(True)
    for c in shown:
        same = same & (text(F.col(f"`{c}`")) == text(F.try_element_at(held, F.lit(c))))
    whole = F.coalesce(F.sha2(CANONICAL, 256) == F.col(CANONICAL_SHA256), F.lit(False))
    bad = rows.select(F.when(~whole, "a row whose checksum differs").when(~same, "columns that differ from their row").alias("why")).filter("why is not null").first()
    if bad:
        raise ValueError(f"staged table {step.table} has {bad.why}")
    now = _state(rows.select(F.col(CANONICAL_SHA256).alias("row_sha256"))).first()
    if (now.rows, now.checksum) != (step.rows, step.checksum):
        raise ValueError(f"staged table {step.table} does not match its manifest")
    return rows.select(*(F.try_element_at(held, F.lit(c)).alias(c) for c in shown))


def open_package(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables of a published package as texts, nulls and empty texts apart; a changed, lost or added row is refused."""
    steps = spark.read.schema(_STEP).json(f"{path}/_staging_manifest").orderBy("step").collect()
    return {s.table: _staged(spark, path, s) for s in steps}
