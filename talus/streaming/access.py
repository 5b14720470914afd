"""Gated lookups: the gate and the lookup behind it as one operator. Whether a lookup finds anything decides what its call leaves at the gate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..functions.scalars import digits_only, folio_key
from ..operators.lookup import result_for
from ..sources.stored import stored
from .gate import Limits, gate_all


@dataclass(frozen=True)
class Access:
    """code_sha256: of the lower-case access code without spaces around it; None: no code is asked for. length: digits of an account."""

    code_sha256: str | None = None
    length: int = 16


def outcomes(requests: DataFrame, items: DataFrame, access: Access = Access()) -> DataFrame:
    """Each request (request_id, ip, ts, code, bo, company_asked, folio) with code_ok, its key, invalid (invalid_bo, invalid_folio or null) and
    found. A request with a company or folio and no account asks by folio, any other by account."""
    digest = F.sha2(F.lower(F.trim("code")), 256)
    code_ok = F.lit(True) if access.code_sha256 is None else F.coalesce(digest == access.code_sha256, F.lit(False))
    by_folio = F.col("bo").isNull() & (F.col("folio").isNotNull() | F.col("company_asked").isNotNull())
    account, key = digits_only(F.coalesce("bo", F.lit(""))), folio_key(F.coalesce("folio", F.lit("")))
    named = F.coalesce("company_asked", F.lit("")) != ""
    invalid = F.when(by_folio & ~(F.length(key).between(1, 30) & named), "invalid_folio").when(~by_folio & (F.length(account) != access.length), "invalid_bo")
    asked = requests.select(
        "request_id", "ip", "ts", code_ok.alias("code_ok"), invalid.alias("invalid"),
        F.when(by_folio, F.col("company_asked")).alias("of"), F.when(by_folio, key).otherwise(account).alias("key"),
    )
    accounts = items.filter("bo_id <> ''").select(F.lit(None).cast("string").alias("of"), F.col("bo_id").alias("key"))
    known = accounts.union(items.select(F.col("company").alias("of"), F.col("folio_key").alias("key"))).distinct()
    known = known.select(F.col("of").alias("_of"), F.col("key").alias("_key"))
    df = asked.join(known, F.col("of").eqNullSafe(F.col("_of")) & (F.col("key") == F.col("_key")), "left")
    return df.withColumn("found", F.col("invalid").isNull() & F.col("_key").isNotNull()).drop("_of", "_key")


def answer_lookups(requests: DataFrame, items: DataFrame, limits: Limits = Limits(), access: Access = Access(), before: DataFrame | None = None) -> DataFrame:
    """request_id, error, found, name, totals, companies of every request, given items (bo_id, company, folio_key, name and the fields of
    lookup.result_for).

    error is the gate's answer unless it lets the call pass, then that of an invalid key. A call that passes with a valid key and finds
    nothing is a miss, which the gate counts against later ones: what each call would find is looked up first for all, by
    keys only; items are nested for the calls that pass. Request ids are unique.
    """
    tried = stored(outcomes(requests, items, access), "outcomes")
    calls = tried.select("request_id", "ip", "ts", "code_ok", (F.col("invalid").isNull() & ~F.col("found")).alias("missed"))
    answers = gate_all(calls, limits, before).select("request_id", "answer")
    passed = tried.join(answers, "request_id")
    hits = passed.filter("answer = 'ok' AND found").select("request_id", "of", "key")
    by_account = hits.filter("of IS NULL").join(items, F.col("key") == F.col("bo_id"))
    by_folio = hits.filter("of IS NOT NULL").join(items, (F.col("of") == F.col("company")) & (F.col("key") == F.col("folio_key")))
    results = result_for(by_account.unionByName(by_folio))
    error = F.when(F.col("answer") != "ok", F.col("answer")).otherwise(F.col("invalid"))
    df = passed.withColumn("error", error).join(results, "request_id", "left")
    return df.select("request_id", "error", F.when(F.col("error").isNull(), F.col("found")).alias("found"), "name", "totals", "companies")
