"""Tables written to the folder that driver and executors share: they cut lineage and outlive lost executors."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir; on one machine (tests), where it may be unset, a folder in the warehouse."""
    own = spark.conf.get("spark.checkpoint.dir", None)
    if not own and not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return own or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back; later jobs start from the table."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
