"""The engine's functions in SQL: scalars as temporary functions, extractors as table functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from ..operators import records
from ..schemas import RAW_ROW
from . import scalars as S

_TYPE = " ".join(f"WHEN lower(s) RLIKE '{pattern}' THEN '{name}'".replace("\\", "\\\\") for name, pattern in S.TYPE_PATTERNS)
DEFINITIONS = {
    "fold_digits(s STRING) RETURNS STRING": "translate(s, '০১২৩৪৫৬৭৮৯', '0123456789')",
    "number_of(s STRING) RETURNS DOUBLE": "CASE WHEN btrim(replace(s, ',', ''), '()') RLIKE '^-?[0-9]+(\\\\.[0-9]*)?$' THEN try_cast(btrim(replace(s, ',', ''), '()') AS DOUBLE) END",
    "year_start(s STRING) RETURNS INT": "try_cast(nullif(regexp_extract(coalesce(s, ''), '(?:19|20)[0-9]{2}', 0), '') AS INT)",
    "digits_only(s STRING) RETURNS STRING": "regexp_replace(coalesce(s, ''), '[^0-9]', '')",
    "folio_key(s STRING) RETURNS STRING": "upper(regexp_replace(coalesce(s, ''), '[\\\\s-]', ''))",
    "code_hash(s STRING) RETURNS STRING": "sha2(lower(btrim(s)), 256)",
    "dividend_type(s STRING) RETURNS STRING": f"CASE {_TYPE} WHEN lower(s) RLIKE 'bonus|stock' AND NOT lower(s) RLIKE 'cash div' THEN 'stock' WHEN lower(s) RLIKE 'cash|dividend|unclaim|unpaid' THEN 'cash' END",
    "sorted_words(s STRING) RETURNS STRING": "array_join(array_sort(filter(split(coalesce(s, ''), '\\\\s+'), t -> t <> '')), ' ')",
    "client_ip(headers STRING) RETURNS STRING": "coalesce(nullif(split_part(coalesce(get_json_object(headers, '$[\\'x-forwarded-for\\']'), ''), ',', 1), ''), 'unknown')",
    "stamp(t TIMESTAMP) RETURNS STRING": "date_format(t, 'yyyy-MM-dd HH:mm:ss')",
}


def _of_pages(rows: Callable[[], Callable]):
    """A table function of pages (doc_id, title, page, text), given by TABLE(...) PARTITION BY doc_id ORDER BY page: what an extractor knows of a document
    holds from page to page."""

    class Rows:
        def __init__(self):
            self.on_page = rows()

        def eval(self, page):
            page = page.asDict()
            yield from self.on_page(page) if page["text"] is not None else ()

    return udtf(Rows, returnType=RAW_ROW)


class _Record:
    """A table function of a line with the year and type that hold there: its record, or no row."""

    def eval(self, line: str, year: str, kind: str):
        if line is not None and (r := records.parse_record(line, year or "", kind)):
            yield tuple(r.get(name) for name in RAW_ROW.fieldNames())


TABLES = {
    "rows_by_column": lambda: _of_pages(records.column_rows),
    "rows_by_year_column": lambda: _of_pages(records.year_column_rows),
    "rows_of_paired_lines": lambda: _of_pages(records.paired_rows),
    "listing_record": lambda: udtf(_Record, returnType=RAW_ROW),
}


def register(spark: SparkSession) -> None:
    for signature, body in DEFINITIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
    for name, table in TABLES.items():
        spark.udtf.register(name, table())
