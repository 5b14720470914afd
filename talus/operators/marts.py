"""Marts: holders, their items, the largest holders, reports and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.scalars import folio_key, has_tag, tokens
from ..schemas import LOOKUP_ITEM, NAME_VARIANTS, OUT_OF_CASH, TOP_CASH, TOP_COMPANIES, UNVERIFIED


def most_common(df: DataFrame, by: str, column: str) -> DataFrame:
    """The most frequent value of each group, the smallest of equals."""
    counts = df.groupBy(by, column).agg(F.count("*").alias("_n"))
    return counts.groupBy(by).agg(F.min_by(column, F.struct(-F.col("_n"), F.col(column))).alias(column))


def holder_mart(items: DataFrame) -> DataFrame:
    """One row a holder of items: holder_id, row_idx, bo_id, company, folio_no, name, dividend_type, net, shares, year_start, tags, settled_flag.

    One aggregation in one shuffle. Money is rounded to 2 places; cash leaves out share dividends and tags of OUT_OF_CASH.
    """
    doubtful = has_tag(F.col("tags"), *OUT_OF_CASH)
    cash = F.col("dividend_type") != "stock"
    folio = F.when(F.col("folio_no") != "", F.concat_ws(":", "company", "folio_no"))
    money = lambda c: F.round(F.coalesce(F.sum(c), F.lit(0.0)), 2)
    return items.groupBy("holder_id").agg(
        F.coalesce(F.min_by(F.when(F.col("bo_id") != "", F.col("bo_id")), F.when(F.col("bo_id") != "", F.col("row_idx"))), F.lit("")).alias("bo_id"),
        F.array_join(F.array_sort(F.collect_set(folio)), "; ").alias("folio_numbers"),
        F.mode("name", True).alias("name_canonical"),
        F.array_join(F.slice(F.array_sort(F.collect_set("name")), 1, NAME_VARIANTS), "; ").alias("name_variants"),
        F.count_distinct("company").alias("companies_count"),
        F.count("*").alias("items_count"),
        money(F.when(cash & ~doubtful, F.col("net"))).alias("total_cash"),
        money(F.when(cash & doubtful, F.col("net"))).alias("total_cash_unverified"),
        money(F.col("shares")).alias("total_shares"),
        F.min("year_start").alias("first_year"),
        F.max("year_start").alias("last_year"),
        F.bool_and(F.col("settled_flag") == 1).cast("int").alias("settled_all"),
        F.bool_or(has_tag(F.col("tags"), "institution")).cast("int").alias("institution"),
    )


def holder_items(holders: DataFrame, items: DataFrame) -> DataFrame:
    return holders.select("holder_id", "name_canonical", "companies_count").join(items, "holder_id")


def top_holders(holders: DataFrame, cash: float = TOP_CASH, companies: int = TOP_COMPANIES) -> DataFrame:
    """Holders of much cash or several companies, neither settled nor institutions, by cash."""
    chosen = ((F.col("total_cash") >= cash) | (F.col("companies_count") >= companies)) & (F.col("settled_all") == 0) & (F.col("institution") == 0)
    return holders.filter(chosen).orderBy(F.desc("total_cash"), "holder_id")


def publishable(items: DataFrame, flags_kept: tuple[str, ...] = ("dup_row", "institution", "ocr")) -> DataFrame:
    """items with verified (no tag of UNVERIFIED) and flags (what is kept of the tags, joined)."""
    kept = F.array_intersect("tags", F.array(*map(F.lit, flags_kept)))
    return items.filter("bo_id <> '' OR folio_no <> ''").withColumn("verified", ~has_tag(F.col("tags"), *UNVERIFIED)).withColumn("flags", F.array_join(kept, ";"))


def first_listed(items: DataFrame) -> DataFrame:
    """Items with an identity, each from the first of the documents that list the same company, identity, year, type and amounts; repeats within that
    document stay."""
    from .resolve import keep_first_document

    folio = F.concat(F.lit("F"), F.regexp_replace("folio_no", "[ -]", ""))
    keys = {"_who": F.when(F.col("bo_id") != "", F.col("bo_id")).otherwise(folio), "_year": F.coalesce("dividend_year", F.lit("")), "_type": F.coalesce("dividend_type", F.lit("")), "_net": F.coalesce("net", F.lit(-1.0)), "_shares": F.coalesce("shares", F.lit(-1.0))}
    return keep_first_document(items.filter("bo_id <> '' OR folio_no <> ''").withColumns(keys), ["company", *keys]).drop(*keys)


def lookup_items(items: DataFrame, most: int | None = None) -> DataFrame:
    """Published items in the layout of LOOKUP_ITEM; those with an account have no folio. most: an upload of that many rows for trial."""
    published = publishable(items, (*UNVERIFIED, "ocr", "dup_row", "institution"))
    folio = lambda c: F.when(F.coalesce("bo_id", F.lit("")) == "", c).otherwise("")
    own = {"folio_key": folio(folio_key(F.col("folio_no"))), "folio_no": folio(F.col("folio_no")), "year": F.col("dividend_year"), "dtype": F.col("dividend_type")}
    df = published.select(*(own.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in LOOKUP_ITEM.fields))
    return df if most is None else df.limit(most)


def with_document_url(items: DataFrame, documents: DataFrame) -> DataFrame:
    """items with the url of their document (id, url); null without one. Documents are unique by id."""
    return items.join(documents.select(F.col("id").alias("doc_id"), "url"), "doc_id", "left")


def with_constants(items: DataFrame, currency: str) -> DataFrame:
    """items with columns that the listings never give."""
    return items.withColumns({"currency": F.lit(currency), "father_or_spouse": F.lit(""), "address": F.lit("")})


def with_row_json(rows: DataFrame, columns: tuple[str, ...] = ("line",)) -> DataFrame:
    """rows with raw_row_json: an object of the columns, nulls kept."""
    return rows.withColumn("raw_row_json", F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))


def unfinished(documents: DataFrame) -> DataFrame:
    return documents.filter(F.col("status").isin("failed", "partial"))


def clean_rows(rows: DataFrame) -> DataFrame:
    """Rows without issues that have an amount and a name: those that a spot check is drawn from."""
    return rows.filter((F.coalesce("issues", F.lit("")) == "") & F.col("net_amount").isNotNull() & (F.coalesce("holder_name_raw", F.lit("")) != ""))


def service_info(items: DataFrame, group: str, updated: str) -> DataFrame:
    """One row: how many companies there are and when they were last updated."""
    return items.agg(F.count_distinct(group).alias("companies"), F.max(updated).alias("updated"))


def companies_of(items: DataFrame, group: str) -> DataFrame:
    return items.select(group).distinct().orderBy(group)


def sums_by(df: DataFrame, by: list[str], measure: str, places: int = 2) -> DataFrame:
    """Count and sum of each group, in the groups' order."""
    return df.groupBy(*by).agg(F.count("*").alias("n"), F.round(F.sum(measure), places).alias("total")).orderBy(*by)


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n"))


def largest_groups(df: DataFrame, by: str, measure: str, n: int = 10) -> DataFrame:
    sums = df.groupBy(by).agg(F.round(F.coalesce(F.sum(measure), F.lit(0.0)), 2).alias("total"))
    return sums.orderBy(F.desc("total"), by).limit(n)


def missing_keys(df: DataFrame, required: list[str]) -> DataFrame:
    """Counts of rows whose required columns are null or empty, by column, and of rows with any."""
    empty = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) == "" for c in required}
    anyone = F.lit(False)
    for e in empty.values():
        anyone = anyone | e
    return df.agg(*(F.count_if(e).alias(f"empty_{c}") for c, e in empty.items()), F.count_if(anyone).alias("rows_with_any"), F.count("*").alias("rows"))


def side_by_side(left: DataFrame, right: DataFrame, key: str, measures: list[str]) -> DataFrame:
    """Both sides' measures and their difference by key, keys of either side."""
    a = left.select(key, *(F.col(m).alias(f"{m}_a") for m in measures))
    b = right.select(key, *(F.col(m).alias(f"{m}_b") for m in measures))
    return a.join(b, key, "full").withColumns({f"{m}_diff": F.coalesce(f"{m}_a", F.lit(0)) - F.coalesce(f"{m}_b", F.lit(0)) for m in measures})


def unparsed_lines(lines: DataFrame, rows: DataFrame) -> DataFrame:
    """Lines with a digit that no row of the document was made from."""
    made = rows.select("doc_id", F.trim("line").alias("_line")).distinct()
    return lines.filter(F.col("line").rlike("[0-9]")).withColumn("_line", F.trim("line")).join(made, ["doc_id", "_line"], "left_anti").drop("_line")


def found_on_page(rows: DataFrame, pages: DataFrame, columns: list[str]) -> DataFrame:
    """rows with on_page: whether all values stand on the page that the row names, whatever the case."""
    df = rows.join(pages.select("doc_id", "page", F.lower("text").alias("_text")), ["doc_id", "page"], "left")
    ok = F.lit(True)
    for c in columns:
        ok = ok & F.coalesce(F.contains(F.col("_text"), F.lower(F.col(c).cast("string"))), F.lit(False))
    return df.withColumn("on_page", ok).drop("_text")


def spot_check(rows: DataFrame, pages: DataFrame) -> DataFrame:
    """rows (doc_id, page, holder_name_raw, net_amount, bo_id, folio_no) with name_ok, amount_ok, id_ok and good, held against the page's text.

    The name's first two words stand there in any case; the amount with or without commas, or its whole part; the account, else the folio,
    spaces apart. A row without an identity needs none; one whose page is missing is not good.
    """
    text = F.regexp_replace(F.coalesce("text", F.lit("")), r"(?U)\s+", " ")
    df = rows.join(pages.select("doc_id", "page", text.alias("_text")), ["doc_id", "page"], "left").withColumn("_text", F.coalesce("_text", F.lit("")))
    start = F.lower(F.array_join(F.slice(tokens(F.col("holder_name_raw")), 1, 2), " "))
    printed = [F.format_string(f, "net_amount") for f in ("%,.2f", "%.2f")] + [F.col("net_amount").cast("long").cast("string")]
    identity = F.replace(F.coalesce(F.nullif("bo_id", F.lit("")), "folio_no", F.lit("")), F.lit(" "), F.lit(""))
    amount = F.lit(False)
    for p in printed:
        amount = amount | F.contains(F.col("_text"), p)
    df = df.withColumns({
        "name_ok": (start != "") & F.contains(F.lower("_text"), start),
        "amount_ok": F.col("net_amount").isNotNull() & F.coalesce(amount, F.lit(False)),
        "id_ok": F.contains(F.replace("_text", F.lit(" "), F.lit("")), identity),
    })
    return df.withColumn("good", F.col("name_ok") & F.col("amount_ok") & F.col("id_ok")).drop("_text")
