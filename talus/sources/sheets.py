"""Spreadsheets as rows: zipped XML workbooks, read as streams of rows. Cells are texts, as the file holds them."""

from __future__ import annotations

import re
import zipfile
from collections.abc import Callable, Iterator
from typing import BinaryIO
from xml.etree.ElementTree import Element, iterparse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .pages import list_files, open_file

#: Rows of an Arrow batch at most.
BATCH_ROWS = 1024
_COLUMN = re.compile(r"[A-Z]+")


def _name(e: Element) -> str:
    return e.tag.rsplit("}", 1)[-1]


def _elements(stream: BinaryIO, wanted: str) -> Iterator[Element]:
    """The elements of one name as they end; each is forgotten after it, and so is what lies between them."""
    root = None
    for event, e in iterparse(stream, events=("start", "end")):
        root = e if root is None else root
        if event == "end" and _name(e) == wanted:
            yield e
            e.clear()
            if len(root):
                for child in list(root):
                    child[:] = [c for c in child if c is not e]


def _text(e: Element) -> str:
    """The text of a string item: its runs joined, phonetic guides left out."""
    parts = [c for c in e if _name(c) in ("t", "r")]
    return "".join((p.text or "") if _name(p) == "t" else "".join(t.text or "" for t in p if _name(t) == "t") for p in parts)


def column_number(name: str) -> int:
    """A is 0, Z 25, AA 26."""
    n = 0
    for c in name:
        n = 26 * n + ord(c) - 64
    return n - 1


def sheet_rows(file: BinaryIO) -> Iterator[tuple[int, int, list[str | None]]]:
    """Sheet (from 1, by its file's number), row number and cells of every row that has some, sheet by sheet. A cell that the row skips is null.

    Shared strings are held, as a workbook's cells refer to them by number; sheets are not. What is no such workbook is a ValueError.
    """
    try:
        book = zipfile.ZipFile(file)
    except zipfile.BadZipFile as e:
        raise ValueError(f"not a zipped workbook: {e}") from e
    with book:
        names = set(book.namelist())
        shared: list[str] = []
        if "xl/sharedStrings.xml" in names:
            with book.open("xl/sharedStrings.xml") as f:
                shared = [_text(e) for e in _elements(f, "si")]
        sheets = sorted((int(m[1]), n) for n in names if (m := re.fullmatch(r"xl/worksheets/sheet(\d+)\.xml", n)))
        for number, name in sheets:
            with book.open(name) as f:
                last = 0
                for row in _elements(f, "row"):
                    last = int(row.get("r", last + 1))
                    cells: list[str | None] = []
                    for c in row:
                        at = column_number(m[0]) if (m := _COLUMN.match(c.get("r", ""))) else len(cells)
                        cells += [None] * (at - len(cells))
                        kind, found = c.get("t", "n"), {_name(x): x for x in c}
                        if kind == "inlineStr":
                            value = _text(found["is"]) if "is" in found else None
                        else:
                            value = found["v"].text if "v" in found else None
                            value = shared[int(value)] if kind == "s" and value is not None else value
                        cells.append(value)
                    if cells:
                        yield number, last, cells


def read_sheets(spark: SparkSession, path: str, opened: Callable[[str], BinaryIO] = open_file) -> DataFrame:
    """doc_id, sheet, row, cells (array of texts), error of the workbooks of a folder. A file that is none has one row with its error."""
    schema = pa.schema([("doc_id", pa.string()), ("sheet", pa.int32()), ("row", pa.int32()), ("cells", pa.list_(pa.string())), ("error", pa.string())])

    def run(batches):
        for b in batches:
            for file, doc in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                held: list[dict] = []
                try:
                    with opened(file) as f:
                        for sheet, row, cells in sheet_rows(f):
                            held.append({"doc_id": doc, "sheet": sheet, "row": row, "cells": cells})
                            if len(held) == BATCH_ROWS:
                                yield pa.RecordBatch.from_pylist(held, schema=schema)
                                held = []
                except (OSError, ValueError) as e:
                    held.append({"doc_id": doc, "error": f"{type(e).__name__}: {e}"[:200]})
                yield pa.RecordBatch.from_pylist(held, schema=schema)

    files = list_files(spark, path).select("file", "doc_id")
    return files.repartition(max(1, files.count())).mapInArrow(run, "doc_id string, sheet int, row int, cells array<string>, error string")


def as_lines(rows: DataFrame) -> DataFrame:
    """doc_id, page (the sheet), line_no, line of sheet rows: cells joined by spaces, as the extractors of lines read them."""
    line = F.array_join(F.filter("cells", lambda c: F.coalesce(c, F.lit("")) != ""), " ")
    return rows.filter("error IS NULL").select("doc_id", F.col("sheet").alias("page"), F.col("row").alias("line_no"), line.alias("line"))
