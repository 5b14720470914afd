"""Keyed lookups over published items, answered for a table of requests at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import digits_only, folio_key


def result_for(hits: DataFrame, by: str = "request_id") -> DataFrame:
    """by, name, totals and companies: items nested in companies, both in order, with their sums. Two aggregations."""
    item = F.struct("year", "dtype", "shares", "net", "verified", "doc_id", "page")
    cash = F.col("dtype") != "stock"
    money = lambda c: F.round(F.coalesce(F.sum(c), F.lit(0.0)), 2)
    companies = hits.groupBy(by, "company").agg(money(F.when(cash, F.col("net"))).alias("cash"), money("shares").alias("shares"), F.array_sort(F.collect_list(item)).alias("items"), F.min("name").alias("name"))
    nested = F.array_sort(F.collect_list(F.struct("company", "cash", "shares", "items")))
    totals = F.struct(F.round(F.sum("cash"), 2).alias("cash"), F.round(F.sum("shares"), 2).alias("shares"), F.count("*").alias("companies"))
    return companies.groupBy(by).agg(F.min("name").alias("name"), totals.alias("totals"), nested.alias("companies"))


def _answer(requests: DataFrame, valid: Column, error: str, keys: list[Column], items: DataFrame, item_keys: list[str]) -> DataFrame:
    asked = requests.withColumn("_ok", F.coalesce(valid, F.lit(False))).withColumns({f"_q{i}": k for i, k in enumerate(keys)})
    on = [F.col(f"_q{i}") == F.col(k) for i, k in enumerate(item_keys)]
    hits = asked.filter("_ok").select("request_id", *(f"_q{i}" for i in range(len(keys)))).join(items, on)
    found = result_for(hits)
    df = asked.select("request_id", "_ok").join(found, "request_id", "left")
    return df.select("request_id", F.when(~F.col("_ok"), error).alias("error"), F.when(F.col("_ok"), F.col("totals").isNotNull()).alias("found"), "name", "totals", "companies")


def lookup_account(requests: DataFrame, items: DataFrame, length: int = 16) -> DataFrame:
    """request_id, bo -> error or found, name, totals, companies. An account has 16 digits, whatever stands between them."""
    account = digits_only(F.col("bo"))
    return _answer(requests, F.length(account) == length, "invalid_bo", [account], items, ["bo_id"])


def lookup_folio(requests: DataFrame, items: DataFrame) -> DataFrame:
    """request_id, company_asked, folio -> as above; a folio key has 1 to 30 characters, a company is named."""
    key = folio_key(F.col("folio"))
    valid = F.length(key).between(1, 30) & (F.coalesce("company_asked", F.lit("")) != "")
    return _answer(requests, valid, "invalid_folio", [F.col("company_asked"), key], items, ["company", "folio_key"])
