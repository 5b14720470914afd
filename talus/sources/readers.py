"""Sources: CSV with declared schemas, JSON statistics, text and binary files, links of pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.scalars import FILE_SUFFIX, LINK_WORDS, joined_url
from ..schemas import STATS


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header: read as strings, cast without failing (what isn't a value becomes null). A byte-order mark at the beginning is
    dropped. Columns are taken by name; missing ones are null."""
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    raw = raw.toDF(*(c.lstrip("﻿") for c in raw.columns))
    return raw.select(*(F.expr(f"try_cast(`{f.name}` AS {f.dataType.simpleString()})").alias(f.name) if f.name in raw.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields))


def read_csv_text(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """CSV as strings throughout; an empty field is an empty string, not null."""
    return read_csv(spark, path, T.StructType([T.StructField(c, T.StringType()) for c in columns])).na.fill("")


def read_stats(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object a file, optional keys null."""
    return spark.read.schema(STATS).option("multiLine", True).json(path)


def read_table(spark: SparkSession, url: str, table: str, columns: list[str], options: dict[str, str] | None = None) -> DataFrame:
    """Columns of a table of a database by JDBC (the driver is the session's); options partition the read."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **(options or {})).load().select(*columns)


def read_whole_text(spark: SparkSession, path: str) -> DataFrame:
    """file, text of every file."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("text"))


def list_ids(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """Ids of a folder's files: names without the suffix."""
    files = spark.read.format("binaryFile").load(path).select("_metadata.file_name")
    return files.filter(F.col("file_name").endswith(suffix)).select(F.expr(f"substring(file_name, 1, length(file_name) - {len(suffix)})").alias("id"))


def page_links(pages: DataFrame, suffix: str = FILE_SUFFIX, words: str = LINK_WORDS) -> DataFrame:
    """page_id, position, link, text: links of pages (page_id, url, html) to documents, each link of a page once, in order.

    Anchors with their text, and sources of embedded frames (text `embedded`). A link counts if it looks like a file (suffix or a
    download parameter) and it or its text has one of the words. Patterns are parameters.
    """
    anchors = F.regexp_extract_all("html", F.lit(r"""(?is)<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["'][^>]*>.*?</a>"""), F.lit(0))
    frames = F.regexp_extract_all("html", F.lit(r"""(?is)<(?:iframe|embed|object)\b[^>]*>"""), F.lit(0))
    part = lambda c, p: F.regexp_extract(c, p, 1)
    of_anchor = lambda a: F.struct(part(a, r"""(?is)\bhref\s*=\s*["']([^"']*)["']""").alias("href"), F.trim(F.regexp_replace(F.regexp_replace(a, r"(?s)<[^>]*>", " "), r"\s+", " ")).alias("text"))
    of_frame = lambda f: F.struct(part(f, r"""(?is)\b(?:src|data)\s*=\s*["']([^"']*)["']""").alias("href"), F.lit("embedded").alias("text"))
    every = F.concat(F.transform(anchors, of_anchor), F.filter(F.transform(frames, of_frame), lambda x: x["href"] != ""))
    rows = pages.filter(F.col("html").isNotNull()).select("page_id", "url", F.posexplode(every).alias("position", "l"))
    rows = rows.select("page_id", "position", joined_url(F.col("url"), F.col("l.href")).alias("link"), F.col("l.text").alias("text"))
    rows = rows.filter(looks_like_file(F.col("link"), suffix) & (F.col("link").rlike(words) | F.col("text").rlike(words) | F.col("link").contains("wpdmdl=")))
    return rows.groupBy("page_id", "link").agg(F.min_by(F.struct("position", "text"), "position").alias("f")).select("page_id", "f.position", "link", "f.text")


def looks_like_file(link: Column, suffix: str = FILE_SUFFIX) -> Column:
    return link.rlike(suffix) | link.contains("wpdmdl=") | link.contains("drive.google.com/file") | link.contains("download=")


def child_documents(links: DataFrame, parents: DataFrame) -> DataFrame:
    """parent_id, child_id, company, link_text, url: links numbered within their parent as <id>-01, <id>-02, ..."""
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy("page_id").orderBy("position"))
    df = links.withColumn("n", n).join(parents.select(F.col("id").alias("page_id"), "company"), "page_id")
    return df.select(F.col("page_id").alias("parent_id"), F.format_string("%s-%02d", F.col("page_id").cast("string"), "n").alias("child_id"), "company", F.col("text").alias("link_text"), F.col("link").alias("url"))
