"""Incremental batches: what is new, and sinks that can be repeated."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.marts import holder_mart
from ..schemas import SINK_BATCH


def new_files(spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "parquet", **options) -> DataFrame:
    """A stream of the files of a folder; with trigger(availableNow=True) and a checkpoint each file is read once. options: the source's, such
    as maxFilesPerTrigger."""
    return spark.readStream.format(fmt).schema(schema).options(**options).load(folder)


def undone(work: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """Work whose root id (up to the first hyphen) is not among the done ones' root ids."""
    root = lambda df: df.select(F.split_part(F.col(key), F.lit("-"), F.lit(1)).alias("_root")).distinct()
    return work.withColumn("_root", F.split_part(F.col(key), F.lit("-"), F.lit(1))).join(root(done), "_root", "left_anti").drop("_root")


def to_fetch(work: DataFrame, manifest: DataFrame, only: list[str] | None = None, reference: bool = False, retry_failed: bool = False) -> DataFrame:
    """The rows of a work list (id, role) that are to be fetched, given the manifest (id, status) of earlier runs.

    Named ids (only) are fetched whether done or not; else those done are left out. Reference documents are fetched if asked for.
    With retry_failed only those are left of which a row failed. Ids of the manifest count by their root, up to the first hyphen.
    """
    root = F.split_part("id", F.lit("-"), F.lit(1)).alias("id")
    if not reference:
        work = work.filter(F.coalesce("role", F.lit("")) != "reference_only")
    if only is not None:
        work = work.filter(F.col("id").isin(*only))
    else:
        work = work.join(manifest.filter("status = 'ok'").select(root).distinct(), "id", "left_anti")
    if retry_failed:
        work = work.join(manifest.filter("status IS NULL OR status <> 'ok'").select(root).distinct(), "id", "left_semi")
    return work


def in_batches(df: DataFrame, send: Callable[[list[dict]], None], size: int = SINK_BATCH, tries: int = 4) -> None:
    """Send rows in lists of `size` from each partition; a list that fails is sent again up to `tries` times, each wait twice as long.

    send must bear repetition: a lost task sends its partition's lists again.
    """
    import time

    def deliver(rows: list[dict]) -> None:
        for attempt in range(tries):
            try:
                send(rows)
                return
            except OSError:
                if attempt + 1 == tries:
                    raise
                time.sleep(2**attempt)

    def run(rows: Iterator) -> None:
        batch: list[dict] = []
        for r in rows:
            batch.append(r.asDict(recursive=True))
            if len(batch) == size:
                deliver(batch)
                batch = []
        if batch:
            deliver(batch)

    df.foreachPartition(run)


def stream_in_batches(df: DataFrame, checkpoint: str, send: Callable[[list[dict]], None], size: int = SINK_BATCH):
    """The same for a stream: every micro-batch goes through in_batches."""
    return df.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(lambda batch, _: in_batches(batch, send, size)).start()


#: Parts of a mart's keys, by hash: a batch rewrites those that it touches.
MART_BUCKETS = 64


def marts_in_batches(items: DataFrame, folder: str, checkpoint: str, mart: Callable[[DataFrame], DataFrame] = holder_mart, key: str = "holder_id", buckets: int = MART_BUCKETS):
    """Keeps a mart up to date with a stream of items: folder/items holds the items of every batch, folder/mart the mart of all so far.

    Keys are dealt over buckets. A batch stores its items by bucket and makes the mart anew from all items of the buckets that it touches, which
    are overwritten and the others left alone, so any aggregate will do. A batch that is run again replaces what it wrote. Starts a query
    that takes what is there and ends; with the same checkpoint the next one goes on.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        own = batch.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
        own.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/items/batch={number}")
        there = spark.read.schema(T.StructType([*own.schema.fields, T.StructField("batch", T.LongType())])).parquet(f"{folder}/items").filter(F.col("batch") <= number)
        touched = [r["bucket"] for r in there.filter(F.col("batch") == number).select("bucket").distinct().collect()]
        if not touched:
            return
        whole = mart(there.filter(F.col("bucket").isin(*touched)).drop("batch", "bucket"))
        whole = whole.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
        whole.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(f"{folder}/mart")

    return items.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(merge).start()
