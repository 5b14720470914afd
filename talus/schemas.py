"""Record layouts, enumerations, issue tags and thresholds, in one place."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _L, _D, _B, _TS = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.TimestampType()


def _of(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


WORK_LIST = _of(id=_S, company=_S, type=_S, title=_S, url=_S, kind=_S, role=_S, source=_S, note=_S)
MANIFEST = _of(
    id=_S, parent_id=_S, company=_S, title=_S, url=_S, final_url=_S, kind=_S, role=_S, status=_S, http_status=_S, content_type=_S,
    local_path=_S, bytes=_L, sha256=_S, pages=_I, error=_S, downloaded_at=_TS,
)
DISCOVERED = _of(parent_id=_S, child_id=_S, company=_S, link_text=_S, url=_S)
TRIAGE = _of(id=_S, company=_S, role=_S, path=_S, pages=_I, pdf_kind=_S, lang=_S, sample=_S)
PAGE_TEXT = _of(doc_id=_S, page=_I, text=_S)
RAW_ROW = _of(
    doc_id=_S, page=_I, row_on_page=_I, dividend_year=_S, dividend_type=_S, warrant_no=_S, folio_or_bo_raw=_S, bo_id=_S, folio_no=_S,
    holder_name_raw=_S, shares=_D, gross_amount=_D, tax_amount=_D, net_amount=_D, issues=_S, line=_S,
)
STATS = _of(
    doc_id=_S, role=_S, rows=_I, pages=_I, textless_pages=_I, unparsed_idlike=_I, stated_total=_D, extracted_total=_D, extracted_shares=_D,
    error=_S, dtype=_S, year=_S, totals=T.ArrayType(_D), total_lines=T.ArrayType(T.ArrayType(_D)), unreadable_totals=_I, ocr=_B, ocr_pages=_I, ocr_rows=_I,
)
LOOKUP_ITEM = _of(
    bo_id=_S, company=_S, folio_key=_S, folio_no=_S, year=_S, year_start=_I, dtype=_S, net=_D, shares=_D, name=_S, doc_id=_S, page=_I,
    verified=_B, flags=_S,
)

#: Enumerations.
ROLES = ("list", "summary", "settled_claims", "reference_only", "check_relevance")
PDF_KINDS = ("text", "scanned", "mixed", "spreadsheet", "other", "error")
DIVIDEND_TYPES = ("cash", "stock", "fraction", "right", "ipo_refund", "other")
SHARE_TYPES = ("stock", "right")

#: Tags that do not count as flags, that keep an amount out of verified cash, and that make a published item unverified.
INFORMATIONAL = (
    "amount_repaired", "year_column", "col_amount", "paired_lines", "int_amount", "shares_first_number_verified_by_total",
    "shares_last_number_verified_by_total",
)
OUT_OF_CASH = ("implausible_amount", "name_looks_like_address", "unverified_int_amount")
UNVERIFIED = ("implausible_amount", "name_looks_like_address", "unverified_int_amount", "unreadable_amount", "name_missing")

#: Thresholds.
SUM_TOLERANCE = 0.05
TOTAL_TOLERANCE = 0.005
LEAST_TOTAL = 100.0
UNREADABLE_FROM = 1e9
IMPLAUSIBLE_OVER = 1_000_000.0
FLAGGED_BELOW = 0.02
EXTRACTOR_GUARD = 3.0
APPROX_YEARS, APPROX_SHARE, APPROX_ERROR = 3, 0.8, 0.06
TEXTLESS_BELOW, SAMPLED_TEXT_OVER = 40, 80
REVIEW_TOKENS, REVIEW_HOLDERS, REVIEW_CAP = 3, 6, 5000
TOP_CASH, TOP_COMPANIES, NAME_VARIANTS = 50_000.0, 3, 8
SINK_BATCH = 4000
#: Limits of the gate, as (count, seconds).
GATE_FAIL, GATE_MISS, GATE_MINUTE, GATE_DAY, GATE_GLOBAL = (5, 900), (15, 3600), (20, 60), (300, 86400), (3000, 86400)
EVENT_TTL_SECONDS = 2 * 86400

#: Fixed value: pages of a file that are extracted at a time.
PAGE_CHUNK = 100
#: Seconds that a lookup may take, and the share of calls that purge the logs.
STATEMENT_SECONDS, PURGE_SHARE = 5.0, 0.02
