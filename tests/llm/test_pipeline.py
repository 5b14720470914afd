import re

import corpus_pipeline
import pytest

from test_neardup import brute as groups
from test_repeats import brute as cut


def test_stages_one_by_one(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        docs = corpus_pipeline.materialize(stage(spark, docs, data), f"test-{name}")
        assert docs.columns == columns
        after = {r.doc_id: r for r in docs.collect()}
        assert set(after) <= set(before)
        if name == "language":
            assert all(re.search(r"[^\W\d_]", before[i].text or "") is None for i in set(before) - set(after))
        if name == "near_duplicates":
            want = groups([(i, r.text) for i, r in before.items()], 5, 80)
            assert set(after) == {i for i, (_, _, kept) in want.items() if kept}
        if name == "repeats":
            for i, n, lost, _ in cut([(i, r.text) for i, r in before.items()]):
                assert (i in after) == (lost < n or n == 0)
                assert lost > 0 or after[i].text == before[i].text
        if name == "personal_data":
            assert all("@" not in r.text or not re.search(r"[a-z0-9]@[a-z0-9-]+\.[a-z]", r.text) for r in after.values())
        assert all(r.n_chars == len(r.text) for r in after.values() if name in ("repeats", "personal_data"))


def test_run(spark, data):
    pieces = corpus_pipeline.run(spark, data).collect()
    assert len({p.doc_id for p in pieces}) > 100
    assert sum(p.length for p in pieces) == sum({p.doc_id: p.doc_tokens for p in pieces}.values())


@pytest.mark.parametrize("stage", [s for s in corpus_pipeline.STAGES if s[0] != "packing"], ids=lambda s: s[0])
def test_nulls_and_empty_tables(spark, data, stage):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, "the house of the people and the other things", "en", None, None), (2, None, None, "a", 0), (3, "", "en", "b", None), (None, "another text of words for us all to read", "en", "c", 9)]
    kept = stage[1](spark, spark.createDataFrame(rows, schema), data)
    assert {r.doc_id for r in kept.collect()} >= {1, None}
    assert stage[1](spark, spark.createDataFrame([], schema), data).collect() == []


@pytest.mark.parametrize("stage", [s for s in corpus_pipeline.STAGES if s[0] != "packing"], ids=lambda s: s[0])
def test_columns_with_the_names_of_a_stage_stay(spark, data, stage):
    others = ["n_removed", "n_words", "removed", "score", "lang_pred", "kept", "component_id", "n_shingles", "base", "spans", "grp", "ref", "th"]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in others)
    text = "the house of the people and the other things that they had seen there"
    rows = [(k, f"{text} {k}", "en", "s", 0, *(f"{c}-{k}" for c in others)) for k in range(3)]
    docs = spark.createDataFrame(rows, schema)
    kept = stage[1](spark, docs, data)
    assert kept.columns == docs.columns
    assert all(r[c] == f"{c}-{r.doc_id}" for r in kept.collect() for c in others)
