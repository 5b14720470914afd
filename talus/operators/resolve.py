"""Entities: duplicate files and rows, holder keys, candidate pairs for review, settled claims."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scalars import no_spaces
from ..schemas import REVIEW_CAP, REVIEW_HOLDERS, REVIEW_TOKENS
from ..sources.stored import stored


def _with_group(rows: DataFrame, keys: list[str], **measures: Column) -> DataFrame:
    """rows with aggregates of the rows with the same keys (nulls alike), by an aggregation that is joined back: a key that very many rows share is
    pre-aggregated, and the join may split it, where a window would bring all its rows to one task."""
    groups = rows.groupBy(*(F.col(k).alias(f"_g{i}") for i, k in enumerate(keys))).agg(*(v.alias(n) for n, v in measures.items()))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_g{i}"))
    return rows.join(groups, same, "left").drop(*(f"_g{i}" for i in range(len(keys))))


def mark_duplicate_files(files: DataFrame, key: str = "sha256", order: str = "position", id_: str = "id") -> DataFrame:
    """files with duplicate_of: the first file of the same content, null for the first itself and where the key is null."""
    firsts = files.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.min_by(id_, order).alias("_first"))
    df = files.join(firsts, F.col(key) == F.col("_key"), "left")
    return df.withColumn("duplicate_of", F.when(F.col(id_) != F.col("_first"), F.col("_first"))).drop("_key", "_first")


def mark_repeated_rows(rows: DataFrame, keys: list, has_id: Column) -> DataFrame:
    """rows with dup_row: whether another row has the same keys (nulls alike) and the row has an identifier."""
    names = [f"_k{i}" for i in range(len(keys))]
    df = _with_group(rows.withColumns(dict(zip(names, keys, strict=True))), names, _n=F.count("*"))
    return df.withColumn("dup_row", has_id & (F.col("_n") > 1)).drop("_n", *names)


def keep_first_document(rows: DataFrame, keys: list[str], doc: str = "doc_id") -> DataFrame:
    """Rows whose document is the smallest with the same keys: repeats within that document survive."""
    return _with_group(rows, keys, _least=F.min(doc)).filter(F.col(doc) == F.col("_least")).drop("_least")


def holder_key(bo_id: Column, company: Column, folio: Column, row: Column) -> Column:
    """Rows are one holder by account, else by company and folio (spaces apart), else a holder of their own."""
    return F.when(bo_id != "", F.concat(F.lit("B"), bo_id)).when(folio != "", F.concat(F.lit("F"), company, F.lit("\x01"), no_spaces(folio))).otherwise(F.concat(F.lit("R"), row.cast("string")))


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """rows with their number from 1 in the order of columns. Each range of the order is numbered by itself and moved on by the ranges before
    it, so that no task holds all rows."""
    # Written, since ranges come from a sample: both uses below must see the same ones.
    ranged = stored(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranges")
    within = ranged.withColumn("_n", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_size"))
    before = F.coalesce(F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return within.join(sizes.select("_part", before.alias("_before")), "_part").withColumn(name, F.col("_n") + F.col("_before")).drop("_part", "_n", "_before")


def number_holders(rows: DataFrame, key: str = "holder_key", row: str = "row_idx") -> DataFrame:
    """holder_key, holder_id, first_row, items of each key, numbered by first row. Only the table of keys is ordered."""
    keys = rows.groupBy(key).agg(F.min(row).alias("first_row"), F.count("*").alias("items"))
    return numbered(keys, ["first_row"], "_number").select(key, F.format_string("H%06d", "_number").alias("holder_id"), "first_row", "items")


def match_method(bo_id: Column, folio: Column, items: Column) -> Column:
    return F.when(items < 2, "unmatched").when(bo_id != "", "bo_exact").when(folio != "", "folio_company").otherwise("unmatched")


def all_review_pairs(rows: DataFrame, least_tokens: int = REVIEW_TOKENS, most: int = REVIEW_HOLDERS) -> DataFrame:
    """Pairs of holders with the same words in their names: rows have row_idx, holder_id, bo_id, block, n_tokens, amount, company.

    In each block the first `most` holders in order of their first row meet, but for two with different accounts: the self-join is
    by block and at most most * (most - 1) / 2 pairs a block. first_row is the block's.
    """
    named = rows.filter(F.col("n_tokens") >= least_tokens)
    firsts = named.groupBy("block", "holder_id").agg(F.min_by(F.struct("row_idx", "bo_id", "amount", "company"), "row_idx").alias("r")).select("block", "holder_id", "r.*")
    block = Window.partitionBy("block")
    ranked = firsts.withColumns({"rk": F.row_number().over(block.orderBy("row_idx")), "first_row": F.min("row_idx").over(block)}).filter(F.col("rk") <= most)
    side = lambda s: ranked.select("block", *(F.col(c).alias(f"{c}_{s}") for c in ("holder_id", "row_idx", "bo_id", "amount", "company", "rk", "first_row")))
    conflict = (F.col("bo_id_a") != "") & (F.col("bo_id_b") != "") & (F.col("bo_id_a") != F.col("bo_id_b"))
    pairs = side("a").join(side("b").drop("first_row_b"), "block").filter((F.col("rk_a") < F.col("rk_b")) & ~conflict)
    weight = F.coalesce("amount_a", F.lit(0.0)) + F.coalesce("amount_b", F.lit(0.0))
    pairs = pairs.withColumn("weight", weight).withColumn("same_company", F.col("company_a") == F.col("company_b"))
    return pairs.select("block", "holder_id_a", "holder_id_b", "row_idx_a", "row_idx_b", "same_company", "weight", F.col("first_row_a").alias("first_row"), "rk_a", "rk_b")


_PAIR = ["block", "holder_id_a", "holder_id_b", "row_idx_a", "row_idx_b", "same_company", "weight"]


def review_pairs(rows: DataFrame, least_tokens: int = REVIEW_TOKENS, most: int = REVIEW_HOLDERS, cap: int = REVIEW_CAP) -> DataFrame:
    """The pairs of all_review_pairs; over `cap` of them, those of the largest amounts."""
    pairs = all_review_pairs(rows, least_tokens, most)
    return pairs.select(_PAIR).orderBy(F.desc("weight"), "row_idx_a", "row_idx_b").limit(cap)


def review_queue(rows: DataFrame, least_tokens: int = REVIEW_TOKENS, most: int = REVIEW_HOLDERS, cap: int = REVIEW_CAP) -> DataFrame:
    """The pairs with review_id, evidence, score and an empty decision. All pairs are numbered, by their block's first row and their holders' places there,
    before the cap: ids of a capped queue have gaps. rows may be many; the queue is at most `cap` rows."""
    pairs = numbered(all_review_pairs(rows, least_tokens, most), ["first_row", "rk_a", "rk_b"], "_number")
    where = F.when(F.col("same_company"), "same company").otherwise("different companies")
    evidence = F.concat(F.lit("same normalised name; no father/address in list to confirm; "), where)
    queue = pairs.orderBy(F.desc("weight"), "_number").limit(cap)
    return queue.select(F.format_string("R%06d", "_number").alias("review_id"), *_PAIR, evidence.alias("evidence"), F.lit(100.0).alias("score"), F.lit("").alias("decision"))


def settled_flags(rows: DataFrame, settled: DataFrame) -> DataFrame:
    """rows with settled_flag: a claim with the same account and amount, or the same company, folio (spaces apart) and amount, is settled.

    Two equi-joins against distinct keys, not one join by OR. A null claim amount matches nothing; a null row amount counts as 0.
    """
    amount = lambda: F.round("amount", 2)
    by_account = settled.filter("bo_id <> '' AND amount IS NOT NULL").select(F.col("bo_id").alias("_b"), amount().alias("_a")).distinct().withColumn("_hit1", F.lit(True))
    by_folio = settled.filter("folio_no <> '' AND amount IS NOT NULL").select(F.col("company").alias("_c"), no_spaces(F.col("folio_no")).alias("_f"), amount().alias("_d")).distinct().withColumn("_hit2", F.lit(True))
    df = rows.withColumn("_amount", F.round(F.coalesce("amount", F.lit(0.0)), 2)).withColumn("_folio", no_spaces(F.col("folio_no")))
    df = df.join(by_account, (F.col("bo_id") == F.col("_b")) & (F.col("_amount") == F.col("_a")), "left")
    df = df.join(by_folio, (F.col("company") == F.col("_c")) & (F.col("_folio") == F.col("_f")) & (F.col("_amount") == F.col("_d")), "left")
    return df.withColumn("settled_flag", F.coalesce("_hit1", "_hit2", F.lit(False)).cast("int")).drop("_b", "_a", "_hit1", "_c", "_f", "_d", "_hit2", "_amount", "_folio")
