"""From a manifest and page texts to documents, items, holders, review pairs and settled claims.

Rows of the extractors, verdicts and items are written to the shared folder in between: each is read several times, and plans stay short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import scalars as S
from ..operators import marts, records, resolve, route, totals
from ..sources.stored import stored


def _runs(line: str, name: str) -> F.Column:
    """Values of the numbers that follow the name in the line at once."""
    at = F.expr(f"locate({name}, {line})")
    words = S.tokens(F.when(at > 0, F.expr(f"substring({line}, locate({name}, {line}) + length({name}))")).otherwise(""))
    first = F.get(F.filter(F.sequence(F.lit(0), F.size(words)), lambda i: ~F.coalesce(F.get(words, i).rlike(S.NUMBER), F.lit(False))), F.lit(0))
    return F.transform(F.filter(words, lambda t, i: i < first), S.number)


def extract_all(pages: DataFrame, recognised: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows of all extractors with method, and statistics; pages: doc_id, title, page, text. recognised: the same of pages without text, whose rows go
    with the generic extractor's."""
    events = stored(records.extract_records(pages), "events")
    named = lambda df, name: df.withColumn("method", F.lit(name))
    rows, stats = records.record_rows(events), records.document_stats(events, pages).withColumn("ocr_rows", F.lit(0))
    if recognised is not None:
        own = stored(records.extract_recognised(recognised), "recognised")
        rows, stats = route.back_fill(rows, own), records.with_recognised(stats.drop("ocr_rows"), recognised, own)
    rows = named(rows, "text_regex")
    for name, extract in (("year_columns", records.extract_year_columns), ("column_position", records.extract_by_column), ("paired_lines", records.extract_paired)):
        rows = rows.unionByName(named(extract(pages), name))
    return stored(rows, "rows"), stored(stats, "stats")


def choose_rows(rows: DataFrame, stats: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of each document's best extractor, and the choices."""
    by_year = rows.filter("method = 'year_columns'")
    share = by_year.groupBy("doc_id").agg(totals.mostly_shares(F.col("dividend_type")).alias("_s"))
    sums = by_year.join(share, "doc_id").groupBy("doc_id", "dividend_year").agg(F.sum(F.when(F.col("_s"), F.col("shares")).otherwise(F.col("net_amount"))).alias("v"))
    values = stats.select("doc_id", totals.candidates(F.col("totals"), F.col("total_lines")).alias("candidates"))
    choice = stored(totals.choose_method(totals.method_scores(rows, stats), totals.year_scores(sums, values)), "choices")
    return rows.join(choice.select("doc_id", "method"), ["doc_id", "method"]), choice


def build(manifest: DataFrame, pages: DataFrame, documents_only: bool = False, recognised: DataFrame | None = None, currency: str = "BDT") -> dict[str, DataFrame]:
    """documents, recognition_jobs, items, published, holders, holder_items, top_holders, review_queue, settled_claims.

    manifest: position, id, company, title, role, status, sha256, error, pdf_kind and, if known, url. pages: doc_id, page, text; recognised: the
    same of pages that character recognition has read, of which those without text in pages are used. Shuffles are by document or page until
    rows are chosen, then by holder key, block and claim keys; nothing is collected. documents_only stops at the documents.
    """
    files = resolve.mark_duplicate_files(manifest)
    extra_pages = None if recognised is None else route.pages_without_text(pages, recognised.select("doc_id", "page", "text"))
    there = pages.select("doc_id") if extra_pages is None else pages.select("doc_id").union(extra_pages.select("doc_id"))
    present = there.distinct().select(F.col("doc_id").alias("id"), F.lit(True).alias("extracted"))
    routed = route.route(files.join(present, "id", "left"))
    active = routed.filter("route IS NULL").select(F.col("id").alias("doc_id"), "title", "company", "role", "position")
    titled = lambda df: df.join(active.select("doc_id", "title"), "doc_id").select("doc_id", "title", "page", S.fold_digits(F.col("text")).alias("text"))
    rows, stats = extract_all(titled(pages), None if extra_pages is None else titled(extra_pages))
    chosen, choice = choose_rows(rows, stats)
    # Claims are numbered among all raw rows of their document.
    raw = Window.partitionBy("doc_id").orderBy("page", "row_on_page", "dividend_year")
    chosen = chosen.withColumn("row_no", F.row_number().over(raw))
    extra = totals.total_row_values(chosen)
    values = stats.join(extra, "doc_id", "left").select("doc_id", totals.candidates(F.col("totals"), F.col("total_lines"), F.col("extra")).alias("candidates"))
    guarded = totals.guard_rows(chosen).withColumn("runs", _runs("line", "holder_name_raw"))
    guarded = stored(totals.resolve_ambiguous(guarded, values).drop("runs"), "guarded")
    verdict = stored(totals.document_verdict(guarded, stats, extra), "verdicts")
    method = F.when((F.col("method") == "text_regex") & (F.col("ocr_rows") > 0), "text_regex+ocr").otherwise(F.col("method"))
    methods = choice.join(stats.select("doc_id", "ocr_rows"), "doc_id").select(F.col("doc_id").alias("id"), method.alias("extraction_method"), "approximate", "ocr_rows")
    documents = routed.select("id", "company", "title", "role", "route", "reason").join(verdict.withColumnRenamed("doc_id", "id"), "id", "left").join(methods, "id", "left")
    documents = documents.withColumn("status", F.coalesce("route", F.when(F.col("approximate"), "partial").otherwise(F.col("status")))).drop("route", "approximate")
    if documents_only:
        return {"documents": documents}
    triage = manifest.select("id", "role", "pdf_kind")
    jobs = route.recognition_jobs(stats.join(active.select("doc_id", "role"), "doc_id"), triage.join(stats.filter("ocr_rows > 0").select(F.col("doc_id").alias("id")), "id", "left_anti"))

    facts = guarded.join(active.drop("title"), "doc_id").join(verdict.select("doc_id", "status", "total_check"), "doc_id")
    valid = F.when(F.col("bo_id").rlike(S.BO), F.col("bo_id")).otherwise("")
    facts = facts.withColumn("bo_id", valid).withColumn("row_idx", F.struct("position", "page", "row_on_page", "dividend_year"))
    facts = marts.with_row_json(facts.withColumn("amount", F.coalesce("net_amount", "shares")))
    claims = facts.filter("role = 'settled_claims'").withColumn("settled_id", F.format_string("%s-S%d", F.col("doc_id").cast("string"), "row_no"))
    claims = claims.select("settled_id", "doc_id", "company", "bo_id", "folio_no", "holder_name_raw", "amount", "row_idx", "raw_row_json")
    items = facts.filter("role <> 'settled_claims' AND (role <> 'check_relevance' OR status = 'parsed')").drop("row_no")
    tags = S.with_tag(F.col("tags"), "institution", S.is_institution(F.col("holder_name_raw")))
    items = items.withColumn("tags", tags).withColumn("tags", S.with_tag(F.col("tags"), "unverified_int_amount", S.has_tag(F.col("tags"), "int_amount") & (F.col("total_check") != "match")))
    identity = F.when(F.col("bo_id") != "", F.col("bo_id")).otherwise(F.col("folio_no"))
    items = resolve.mark_repeated_rows(items, [F.col("company"), F.col("dividend_year"), identity, F.col("amount")], identity != "")
    items = items.withColumn("tags", S.with_tag(F.col("tags"), "dup_row", F.col("dup_row"))).drop("dup_row")
    items = items.withColumn("item_id", F.format_string("%s-p%d-r%d", F.col("doc_id").cast("string"), "page", "row_on_page")).withColumn("year_start", S.year_start(F.col("dividend_year")))
    row_key = F.concat_ws("/", "doc_id", "page", "row_on_page", "dividend_year")
    items = items.withColumn("holder_key", resolve.holder_key(F.col("bo_id"), F.col("company"), F.col("folio_no"), row_key))
    numbered = resolve.number_holders(items.select("holder_key", "row_idx"))
    items = items.join(numbered.select("holder_key", "holder_id", F.col("items").alias("_n")), "holder_key").withColumn("match_method", resolve.match_method(F.col("bo_id"), F.col("folio_no"), F.col("_n"))).drop("_n", "holder_key")
    items = marts.with_constants(resolve.settled_flags(items, claims), currency)
    items = stored(items.withColumnsRenamed({"holder_name_raw": "name", "net_amount": "net"}), "items")
    words = S.name_tokens(F.col("name"))
    named = items.withColumn("block", F.array_join(F.array_sort(words), " ")).withColumn("n_tokens", F.size(words)).withColumn("amount", F.col("net"))
    holders = marts.holder_mart(items)
    published = marts.lookup_items(marts.first_listed(items))
    if "url" in manifest.columns:
        published = marts.with_document_url(published, manifest.select("id", "url"))
    return {
        "documents": documents, "recognition_jobs": jobs, "items": items, "published": published, "holders": holders, "holder_items": marts.holder_items(holders, items), "top_holders": marts.top_holders(holders),
        "review_queue": resolve.review_queue(named), "settled_claims": claims,
    }
