"""A corpus pipeline: language identification, near and exact duplicates, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All but the last return the columns
of documents; run() writes each stage's rows as Parquet to the shared folder and reads them back for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from talus.llm import langid, neardup, packing, pii, repeats
from talus.llm.scratch import materialize


def _apart(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """docs with the columns that no stage needs renamed, so that a stage's own columns can't clash with them, and the way back."""
    names = {c: f"_other_{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text", "lang")}
    return docs.withColumnsRenamed(names), {v: k for k, v in names.items()}


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: null texts, texts without letters, and those whose posterior is under a half.
    The model is fitted on the labelled rows of docs."""
    own, back = _apart(docs)
    labelled = langid.label(own, langid.fit(docs))
    return labelled.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= 0.5)).select(*own.columns).withColumnsRenamed(back)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that with the smallest doc_id: five-word shingles, a similarity of 0.8 or more. Of rows that share an id all
    stay if one does."""
    gone = neardup.near_duplicates(docs, size=5, percent=80).groupBy("doc_id").agg(F.bool_or("kept").alias("kept")).filter(~F.col("kept"))
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of 13-word windows that a document with a smaller doc_id has are cut; documents left without a word go."""
    own, back = _apart(docs)
    cut = repeats.repeated(own, carry=tuple(c for c in own.columns if c not in ("doc_id", "text")))
    cut = cut.filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    return _counted(cut.select(*own.columns).withColumnsRenamed(back))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by their kind in brackets. The span classifier is trained on docs."""
    own, back = _apart(docs)
    return _counted(pii.redact(own).withColumnsRenamed(back))


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 ids, every window with the corpus's mixture of sources."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", drop_repeats),
    ("personal_data", redact_personal_data),
    ("packing", pack_sequences),
]

#: SQL cannot express the classifiers and the packing; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
