"""One citation-bearing chunk a document: its facts, invoices with parties and lines, and attributions, as JSON text to search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Columns that say how a row came here and are no facts of it.
BOOKKEEPING = ("batch_id", "review_status")
ALLOWED = ("clear", "approved")


def allowed(df: DataFrame) -> DataFrame:
    """Rows whose review is done; a table without the column has nothing under review."""
    return df.filter(F.col("review_status").isin(*ALLOWED)) if "review_status" in df.columns else df


def _facts(df: DataFrame, *more: Column) -> Column:
    """A row's facts by column name, so that equal rows give equal text."""
    return F.struct(*(F.col(c) for c in sorted(set(df.columns) - set(BOOKKEEPING))), *more)


def document_chunks(documents: DataFrame, invoices: DataFrame, lines: DataFrame, parties: DataFrame, attributions: DataFrame) -> DataFrame:
    """(document_id, content, counts, citation columns) of each allowed document.

    Parties enter by their canonical names.  Lines are gathered by invoice and invoices by document,
    each after its own aggregation, so only one document's facts meet in a row.
    """
    for c in ("document_id", "source_file", "source_page_range", "source_sha256"):
        if c not in documents.columns:
            raise ValueError(f"document rows require {c}")
    names = allowed(parties).select("party_key", "canonical_name")
    by_invoice = allowed(lines).select("invoice_key", _facts(lines).alias("line")).groupBy("invoice_key").agg(F.sort_array(F.collect_list("line")).alias("lines"))
    full = allowed(invoices)
    roles = [r for r in ("biller", "payer", "ship_to") if f"{r}_party_key" in invoices.columns]
    for role in roles:
        full = full.join(names.toDF(f"{role}_party_key", role), f"{role}_party_key", "left")
    full = full.join(by_invoice, "invoice_key", "left")
    facts = _facts(invoices, *(F.col(r) for r in roles), F.col("lines"))
    per = full.groupBy("source_document_id").agg(F.sort_array(F.collect_list(F.struct("invoice_key", F.to_json(facts).alias("json")))).alias("i"), F.sum(F.coalesce(F.size("lines"), F.lit(0))).alias("n_lines"))
    invoice_facts = per.select(F.col("source_document_id").alias("document_id"), F.transform("i", lambda x: x["json"]).alias("invoices"), "n_lines")
    given = allowed(attributions).groupBy("source_document_id").agg(F.sort_array(F.collect_list(F.to_json(_facts(attributions)))).alias("attributions"))
    docs = allowed(documents)
    out = docs.join(invoice_facts, "document_id", "left").join(given.withColumnRenamed("source_document_id", "document_id"), "document_id", "left")
    listed = lambda c: F.concat(F.lit("["), F.array_join(F.coalesce(c, F.array().cast("array<string>")), ","), F.lit("]"))
    content = F.concat(F.lit('{"attributions":'), listed(F.col("attributions")), F.lit(',"document":'), F.to_json(_facts(documents)), F.lit(',"invoices":'), listed(F.col("invoices")), F.lit("}"))
    count = lambda c: F.coalesce(F.size(c), F.lit(0))
    citation = [F.col(c) for c in ("source_file", "source_page_range", "source_sha256", "review_status") if c in documents.columns]
    return out.select("document_id", content.alias("content"), count("invoices").alias("n_invoices"), F.coalesce("n_lines", F.lit(0)).alias("n_lines"), count("attributions").alias("n_attributions"), *citation)
