"""Which documents go where: early exits, recognition jobs, back-filled pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .lines import has_text


def route(manifest: DataFrame) -> DataFrame:
    """manifest (with duplicate_of and extracted) with route and reason: the first that applies of failed, duplicate, reference only,
    summary, not extracted; null for documents to be parsed."""
    c = F.col
    # Reasons as documents report them.
    rules = [
        (c("status") != "ok", "failed", F.substring(F.coalesce("error", F.lit("")), 1, 200)),
        (c("duplicate_of").isNotNull(), "skipped", F.concat(F.lit("duplicate of "), c("duplicate_of").cast("string"), F.lit(" (same sha256)"))),
        (c("role") == "reference_only", "skipped", F.lit("reference only")),
        (c("role") == "summary", "skipped", F.lit("summary document: totals only, not parsed into dividends")),
        (~F.coalesce("extracted", F.lit(False)), "failed", F.concat(F.lit("not extracted"), F.when(c("pdf_kind") == "scanned", "; scanned, needs OCR").otherwise(""))),
    ]
    where, why = F.lit(None).cast("string"), F.lit(None).cast("string")
    for condition, name, reason in reversed(rules):
        where, why = F.when(condition, name).otherwise(where), F.when(condition, reason).otherwise(why)
    return manifest.withColumn("route", where).withColumn("reason", why)


def text_jobs(triage: DataFrame, roles: tuple[str, ...] = ("list", "settled_claims", "check_relevance")) -> DataFrame:
    """Documents with a text layer in roles that are parsed."""
    return triage.filter(F.col("pdf_kind").isin("text", "mixed") & F.col("role").isin(*roles))


def recognition_jobs(stats: DataFrame, triage: DataFrame, roles: tuple[str, ...] = ("list", "settled_claims", "check_relevance")) -> DataFrame:
    """doc_id of documents with pages without text, and of scanned ones; each once."""
    holes = stats.filter((F.col("textless_pages") > 0) & (F.col("role") != "summary")).select("doc_id")
    scans = triage.filter((F.col("pdf_kind") == "scanned") & F.col("role").isin(*roles)).select(F.col("id").alias("doc_id"))
    return holes.union(scans).distinct()


def pages_without_text(pages: DataFrame, recognised: DataFrame) -> DataFrame:
    """Recognised pages (doc_id, page, text) of which pages has no text; others are not needed."""
    return recognised.join(pages.filter(has_text(F.col("text"))).select("doc_id", "page"), ["doc_id", "page"], "left_anti")


def back_fill(rows: DataFrame, recognised: DataFrame) -> DataFrame:
    """rows and, for pages that gave none, recognised rows, which get the tag ocr. One row a (doc_id, page, row_on_page) results."""
    missing = recognised.join(rows.select("doc_id", "page").distinct(), ["doc_id", "page"], "left_anti")
    tagged = missing.withColumn("issues", F.when(F.coalesce("issues", F.lit("")) == "", "ocr").otherwise(F.concat("issues", F.lit(";ocr"))))
    return rows.unionByName(tagged)
