"""Sinks: CSV and Parquet marts, upserts by anti-join, insert-or-ignore, purges, a summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.scalars import slug


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """The named columns (others are ignored) with a header; arrays must be joined before."""
    df.select(*(columns or df.columns)).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_marts(marts: dict[str, DataFrame], folder: str, fmt: str = "parquet", skip_empty: tuple[str, ...] = ()) -> list[str]:
    """Write each mart to its folder; those in skip_empty only if they have rows. Returns the names written."""
    done = []
    for name, df in marts.items():
        if name in skip_empty and df.isEmpty():
            continue
        df.write.mode("overwrite").format(fmt).option("header", True).save(f"{folder}/{name}")
        done.append(name)
    return done


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def upsert(old: DataFrame, new: DataFrame, todo: DataFrame, key: str = "id") -> DataFrame:
    """Rows of old whose root id (up to the first hyphen) was not to do, and all of new."""
    root = F.split_part(F.col(key), F.lit("-"), F.lit(1))
    roots = todo.select(F.col(key).alias("_root")).distinct()
    kept = old.withColumn("_root", root).join(roots, "_root", "left_anti").drop("_root")
    return kept.unionByName(new, allowMissingColumns=True)


def insert_or_ignore(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    return old.unionByName(new.join(old.select(key), key, "left_anti").select(*old.columns))


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def file_path(company: Column, id_: Column, url: Column, title: Column, suffix: Column) -> Column:
    """Where a fetched file is kept: <company>/<id>__<name><suffix>; the name is that of the url's path, else the title."""
    last = F.regexp_extract(F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit("")), "([^/]*)/*$", 1)
    stem = F.regexp_replace(F.coalesce(F.try_url_decode(last), last), r"(?<=.)\.[^.]*$", "")
    return F.concat(slug(company, 40), F.lit("/"), id_, F.lit("__"), slug(F.coalesce(F.nullif(stem, F.lit("")), title)), suffix)


def append_csv(df: DataFrame, path: str) -> None:
    """Rows added to a folder of CSV files, each with a header that readers drop; rows of earlier runs stay, repeated ones too."""
    df.write.mode("append").option("header", True).option("escape", '"').csv(path)


def rebuild_tables(tables: dict[str, DataFrame], schemas: dict[str, T.StructType], database: str = "default") -> None:
    """Every table of the database dropped, declared by its schema, and filled; columns go by name, and those a table lacks are null."""
    for name, df in tables.items():
        spark, full = df.sparkSession, f"`{database}`.`{name}`"
        spark.sql(f"DROP TABLE IF EXISTS {full}")
        spark.sql(f"CREATE TABLE {full} ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in schemas[name].fields)}) USING parquet")
        there = set(df.columns)
        df.select(*((F.col(f.name) if f.name in there else F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas[name].fields)).write.insertInto(full)


def purge(df: DataFrame, dead: Column) -> DataFrame:
    """Rows for which the condition is not true."""
    return df.filter(~F.coalesce(dead, F.lit(False)))


def batch_number(df: DataFrame, order: list[str], size: int) -> DataFrame:
    """df with batch: which of the lists of `size` rows of its partition key a row goes in; numbered within each hash of the first order column,
    so that no task orders all rows."""
    from pyspark.sql import Window

    spread = F.pmod(F.xxhash64(order[0]), F.lit(64))
    at = F.row_number().over(Window.partitionBy("_spread").orderBy(*order))
    return df.withColumn("_spread", spread).withColumn("batch", F.concat_ws("-", F.col("_spread").cast("string"), F.floor((at - 1) / size).cast("string"))).drop("_spread")


def summary(items: DataFrame, holders: DataFrame, documents: DataFrame, top: int = 10) -> str:
    """A short report in Markdown; only counts and the largest groups reach the driver."""
    from ..operators.marts import largest_groups

    status = {r["status"]: r["n"] for r in documents.groupBy("status").agg(F.count("*").alias("n")).collect()}
    lines = ["# Summary", "", f"- documents: {sum(status.values())} ({', '.join(f'{k} {v}' for k, v in sorted(status.items()))})", f"- items: {items.count()}", f"- holders: {holders.count()}", "", "| company | cash |", "|-|-|"]
    lines += [f"| {r['company']} | {r['total']:.2f} |" for r in largest_groups(items, "company", "net", top).collect()]
    return "\n".join(lines) + "\n"
