"""Downloads: work fetched, links of web pages followed one step as child documents, files kept, and a manifest row for what came of each."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import sniffed_suffix, stamp
from . import readers
from .fetch import Get, fetch, save_bytes
from .sinks import file_path
from .stored import shared_folder, stored

_WORK = ("id", "parent_id", "company", "title", "url", "kind", "role")
MANIFEST_ROW = (*_WORK[:5], "final_url", "kind", "role", "status", "http_status", "content_type", "local_path", "bytes", "sha256", "error", "downloaded_at")
#: What a manifest says of pages that are no documents.
NO_DRIVE = "Drive returned a web page (file may be private or need sign-in)"
NO_LINKS = "page loaded but no document links found (may need a real browser / JavaScript)"
NO_CHILD = "child link returned a web page"


def is_document(content: Column, content_type: Column) -> Column:
    """Whether what was fetched is a file and no web page: a PDF whatever its type, else anything that isn't HTML."""
    return (F.substring(content, 1, 4) == F.lit(b"%PDF")) | ~F.lower(F.coalesce(content_type, F.lit(""))).startswith("text/html")


def write_files(rows: DataFrame, folder: str) -> DataFrame:
    """local_path, bytes of rows (local_path, content), whose contents become files under folder, an address that all tasks reach. A task that runs
    again writes the same files anew."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        where, root = fs.FileSystem.from_uri(folder)
        for b in batches:
            paths, contents = b.column(0).to_pylist(), b.column(1).to_pylist()
            for path, content in zip(paths, contents, strict=True):
                save_bytes(where, f"{root}/{path}", content)
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(list(map(len, contents)), pa.int64())], ["local_path", "bytes"])

    return rows.select("local_path", "content").mapInArrow(run, "local_path string, bytes long")


def _fetched(work: DataFrame, get: Get, spacing: float, kept: str) -> DataFrame:
    """work with what was fetched, and is_file."""
    found = fetch(work.select("id", "url"), get, spacing, kept=kept)
    df = work.join(found, "id").withColumn("is_file", F.coalesce((F.col("status") == "ok") & is_document(F.col("content"), F.col("content_type")), F.lit(False)))
    return stored(df, "fetched")


def _rows(fetched: DataFrame, reason: Column) -> DataFrame:
    """Manifest rows with content; reason: of fetched pages that are no files."""
    suffix = sniffed_suffix(F.col("content"), F.col("content_type"), F.col("disposition"), F.col("final_url"))
    own = F.col("is_file")
    df = fetched.withColumn("local_path", F.when(own, file_path(F.col("company"), F.col("id"), F.col("final_url"), F.col("title"), suffix)))
    df = df.withColumns({
        "error": F.when(own, "").when(F.col("status") == "ok", reason).otherwise(F.col("error")), "status": F.when(own, "ok").otherwise("failed"),
        "downloaded_at": stamp(F.current_timestamp()), **{c: F.when(own, F.col(c)) for c in ("bytes", "sha256", "content")},
    })
    return df.select(*MANIFEST_ROW, "content")


def download(work: DataFrame, get: Get, folder: str, spacing: float = 1.5, kept: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Manifest rows and discovered links of work (id, company, title, url, kind, role); files go under folder as local_path says.

    A response that is a document is kept. A web page's links to documents become child documents <id>-01, ..., fetched in turn; a page without
    any, a shared-drive page (kind gdrive) and a child that is a page again are failed rows, as are refusals and errors. Responses are kept
    in a folder (by default in the shared one) while this runs, so a lost task asks for nothing twice.
    """
    kept = kept or f"{shared_folder(work.sparkSession)}/responses"
    first = _fetched(work.select("id", F.lit("").alias("parent_id"), *_WORK[2:]), get, spacing, kept)
    page = (F.col("status") == "ok") & ~F.col("is_file") & (F.coalesce("kind", F.lit("")) != "gdrive")
    pages = first.filter(page).select(F.col("id").alias("page_id"), F.col("final_url").alias("url"), F.col("content").cast("string").alias("html"))
    links = stored(readers.child_documents(readers.page_links(pages), first.select("id", "company")), "links")
    parents = first.select(F.col("id").alias("parent_id"), F.col("title").alias("_title"), "kind", "role")
    title = F.substring(F.coalesce(F.nullif("link_text", F.lit("")), "_title"), 1, 150)
    children = links.join(parents, "parent_id").select(F.col("child_id").alias("id"), "parent_id", "company", title.alias("title"), "url", "kind", "role")
    second = _fetched(children, get, spacing, kept)
    # A page whose links are followed has rows for these, and none of its own.
    followed = links.select(F.col("parent_id").alias("id")).distinct()
    rows = _rows(first.join(followed, "id", "left_anti"), F.when(F.col("kind") == "gdrive", NO_DRIVE).otherwise(NO_LINKS))
    rows = stored(rows.unionByName(_rows(second, F.lit(NO_CHILD))), "manifest")
    written = write_files(rows.filter("local_path IS NOT NULL"), folder).agg(F.count("*").alias("n")).first()["n"]
    assert written == rows.filter("status = 'ok'").count()
    return rows.drop("content"), links
