"""Pages of files, planned by file and chunk of pages: a large file is many tasks' work, and only chunks with a wanted page are opened.

Files are listed by Spark and planned in parallel: an extractor says where each chunk of pages begins. Chunks are then dealt over tasks,
each of which opens its file at that place and yields the pages one after the other. The extractor of a format (a PDF text layer,
character recognition) is the caller's; one for texts with form feeds, as text converters write them, is here.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import BinaryIO, Protocol

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..schemas import PAGE_CHUNK
from .stored import stored

#: Pages that an Arrow batch holds at most, and files or chunks that a task takes on average.
BATCH_PAGES, TASK_ROWS = 256, 16


class Extractor(Protocol):
    def chunks(self, file: BinaryIO, size: int) -> Iterator[tuple[int, int, int]]:
        """First page, last page and place (what texts needs to begin there) of each chunk of `size` pages; pages count from 1."""

    def texts(self, file: BinaryIO, place: int, first: int, wanted: list[int]) -> Iterator[str]:
        """The texts of the wanted pages, ascending, of the chunk that begins at place with page first."""


class FormFeeds:
    """Pages of UTF-8 text that end at form feeds; what follows the last one is a page if there is any. A place is a byte offset. Reads go on
    block by block, so no file is held whole; bytes that are no UTF-8 become replacement characters."""

    BLOCK = 1 << 20

    def chunks(self, file: BinaryIO, size: int) -> Iterator[tuple[int, int, int]]:
        done, place, at, last = 0, 0, 0, 0
        while block := file.read(self.BLOCK):
            k = block.find(b"\f")
            while k >= 0:
                done, last = done + 1, at + k + 1
                if done % size == 0:
                    yield done - size + 1, done, place
                    place = last
                k = block.find(b"\f", k + 1)
            at += len(block)
        pages = done + (at > last)
        if pages > (begun := done // size * size):
            yield begun + 1, pages, place

    def texts(self, file: BinaryIO, place: int, first: int, wanted: list[int]) -> Iterator[str]:
        file.seek(place)
        page, rest, more = first, b"", True
        for want in wanted:
            while page < want or (more and b"\f" not in rest):
                cut = rest.find(b"\f")
                if page < want and cut >= 0:
                    page, rest = page + 1, rest[cut + 1 :]
                    continue
                block = file.read(self.BLOCK)
                more = bool(block)
                # What belongs to a page that isn't wanted is not kept.
                rest = (b"" if page < want else rest) + block
                if not more and page < want:
                    return
            cut = rest.find(b"\f")
            yield (rest if cut < 0 else rest[:cut]).decode("utf-8", "replace")
            page, rest = page + 1, b"" if cut < 0 else rest[cut + 1 :]


def open_file(uri: str) -> BinaryIO:
    """A file by its address, wherever pyarrow reaches."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    where, path = fs.FileSystem.from_uri(uri)
    return where.open_input_file(path)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """file (its address), doc_id (its name without suffix) of a folder's files; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(F.col("path").alias("file"), F.regexp_replace("_metadata.file_name", r"(?<=.)\.[^.]*$", "").alias("doc_id"))


def _spread(df: DataFrame) -> DataFrame:
    return df.repartition(max(1, -(-df.count() // TASK_ROWS)))


def plan_chunks(files: DataFrame, extractor: Extractor, size: int = PAGE_CHUNK, opened: Callable[[str], BinaryIO] = open_file) -> DataFrame:
    """file, doc_id, pages (of the whole file), first, last, place of every chunk; a file that cannot be read has one row with its error."""

    def run(batches):
        for b in batches:
            out = []
            for file, doc in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                try:
                    with opened(file) as f:
                        found = list(extractor.chunks(f, size))
                except (OSError, ValueError) as e:
                    out.append({"file": file, "doc_id": doc, "error": f"{type(e).__name__}: {e}"[:200]})
                    continue
                n = found[-1][1] if found else 0
                out += [{"file": file, "doc_id": doc, "pages": n, "first": a, "last": z, "place": p} for a, z, p in found]
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    schema = pa.schema([("file", pa.string()), ("doc_id", pa.string()), ("pages", pa.int32()), ("first", pa.int32()), ("last", pa.int32()), ("place", pa.int64()), ("error", pa.string())])
    return _spread(files.select("file", "doc_id")).mapInArrow(run, "file string, doc_id string, pages int, first int, last int, place long, error string")


def read_chunks(chunks: DataFrame, extractor: Extractor, wanted: Column | None = None, opened: Callable[[str], BinaryIO] = open_file) -> DataFrame:
    """doc_id, page, text of the pages of chunks that meet `wanted`, a condition on doc_id, page and pages (all, if None). A chunk without such a
    page is not opened, and the rest of a chunk's pages is not extracted."""
    each = chunks.filter("error IS NULL").select("file", "doc_id", "pages", "first", "place", F.explode(F.sequence("first", "last")).alias("page"))
    each = each if wanted is None else each.filter(wanted)
    work = each.groupBy("file", "doc_id", "first", "place").agg(F.array_sort(F.collect_list("page")).alias("wanted"))

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                with opened(r["file"]) as f:
                    texts = extractor.texts(f, r["place"], r["first"], r["wanted"])
                    for lo in range(0, len(r["wanted"]), BATCH_PAGES):
                        own = r["wanted"][lo : lo + BATCH_PAGES]
                        # A page that the extractor does not give is empty.
                        found = [next(texts, "") for _ in own]
                        yield pa.RecordBatch.from_arrays([pa.array([r["doc_id"]] * len(own), pa.string()), pa.array(own, pa.int32()), pa.array(found, pa.string())], ["doc_id", "page", "text"])

    return _spread(work).mapInArrow(run, "doc_id string, page int, text string")


def read_pages(spark: SparkSession, path: str, extractor: Extractor, wanted: Column | None = None, size: int = PAGE_CHUNK) -> DataFrame:
    """doc_id, page, text of the files of a folder; see read_chunks."""
    return read_chunks(stored(plan_chunks(list_files(spark, path), extractor, size), "chunks"), extractor, wanted)


def sampled() -> Column:
    """Condition for the first, middle and last page of a document."""
    n = F.col("pages")
    return (F.col("page") == 1) | (F.col("page") == n) | (F.col("page") == F.floor(n / 2) + 1)


def read_documents(spark: SparkSession, path: str, extractor: Extractor) -> DataFrame:
    """doc_id, pages, text of whole documents: pages in order with a form feed behind each, as extractors without chunks see them."""
    rows = read_pages(spark, path, extractor)
    whole = F.array_sort(F.collect_list(F.struct("page", "text")))
    return rows.groupBy("doc_id").agg(F.count("*").cast("int").alias("pages"), F.concat_ws("", F.transform(whole, lambda p: F.concat(p["text"], F.lit("\f")))).alias("text"))
