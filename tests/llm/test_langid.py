import zlib

import numpy as np
import pytest

from talus.llm import langid


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.collect()}
    from talus.llm.queries import queries

    rows = queries()["op7_language_id"](spark, d).collect()
    assert len(rows) == len(lang)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out and lang[r.doc_id] is not None]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held) > 100


def test_learns_only_from_rows_that_are_not_held_out(spark):
    out = [i for i in range(300) if zlib.crc32(str(i).encode()) % 3 == 1]
    rows = [(i, "zzz qqq" if i in out else "the of and", "xx" if i in out else "en") for i in range(300)]
    labels, _ = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert labels == ["en"]


def test_unlettered_null_long_and_repeated(spark):
    rows = [(i, "the cat of the house and " * 3, "en") for i in range(0, 40)] + [(100 + i, "der die das und nicht ein " * 3, "de") for i in range(40)]
    rows += [(500, None, "en"), (501, "", None), (502, "123 !? \n", "de"), (None, "das und die", "de"), (503, "und die " * 60_000, None), (503, "und die " * 60_000, None), (504, "日本語", None)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, score int")
    got = [tuple(r) for r in langid.predict(df, langid.fit(df)).collect()]
    by = {g[0]: g for g in got}
    assert len(got) == len(rows)
    assert [by[i][2:] for i in (500, 501, 502)] == [("und", 0.0)] * 3
    assert by[None][1:3] == (False, "de") and by[503][2] == "de" and by[504][2] in ("de", "en")
    assert sum(g == by[503] for g in got) == 2
    assert by[3][2] == "en" and by[103][2] == "de"


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [tuple(r)[2:] for r in langid.predict(df, langid.fit(df)).collect()] == [("und", 0.0)]
    assert langid.predict(df.limit(0), langid.fit(df.limit(0))).collect() == []


def test_grams_do_not_span_texts():
    a, owner = langid.gram_buckets(["ab", "cd"])
    one, _ = langid.gram_buckets(["ab"])
    other, _ = langid.gram_buckets(["cd"])
    assert sorted(a[owner == 0]) == sorted(one) and sorted(a[owner == 1]) == sorted(other)


def test_long_texts_take_several_passes(monkeypatch):
    """The n-grams of a text are the same in one pass or in many, whatever its length."""
    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(list("abc 7é日😀\n"), n)) for n in (0, 1, 2, 3, 15, 16, 17, 31, 32, 33, 34, 100, 5)]
    want = [sorted(langid.gram_buckets([t])[0].tolist()) for t in texts]
    for size in (16, 1, 2, 1000):
        monkeypatch.setattr(langid, "PASS_CHARS", size)
        got = [[] for _ in texts]
        for lo, hi, buckets, owner in langid._passes(texts):
            assert len(owner) == len(buckets) and (not len(owner) or owner.max() < hi - lo)
            for b, o in zip(buckets.tolist(), owner.tolist(), strict=True):
                got[lo + o].append(b)
        assert [sorted(g) for g in got] == want


def test_labels_are_bounded(spark, monkeypatch):
    df = spark.createDataFrame([(k, "some text", f"l{k}") for k in range(40)], "doc_id long, text string, lang string")
    monkeypatch.setattr(langid, "MOST_LABELS", 5)
    with pytest.raises(ValueError, match="more than 5 labels"):
        langid.fit(df)


def test_like_brute_force(spark):
    """Posteriors by the definition, n-grams counted in dictionaries."""
    import math
    from collections import Counter

    rng = np.random.default_rng(9)
    own = {"x": "abcdef ghi", "y": "uvwxyz éab", "z": "日本語 abc"}
    rows = [(k, "".join(rng.choice(list(own[lang]), rng.integers(0, 60))), lang) for k, lang in enumerate(rng.choice(list(own), 300))]
    df = spark.createDataFrame([(int(i), str(t), str(lang)) for i, t, lang in rows], "doc_id long, text string, lang string")
    grams = lambda t: Counter(langid.gram_buckets([t])[0].tolist())
    learnt = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 != 1]
    sizes, counts = Counter(r[2] for r in learnt), {k: Counter() for k in own}
    for _, t, lang in learnt:
        counts[lang].update(grams(t))
    whole = {k: sum(c.values()) + 0.1 * langid.BUCKETS for k, c in counts.items()}
    for r in langid.predict(df, langid.fit(df)).collect():
        t = rows[r.doc_id][1]
        if not any(map(str.isalpha, t)):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        odds = {k: math.log(sizes[k] / len(learnt)) + sum(n * math.log((counts[k][b] + 0.1) / whole[k]) for b, n in grams(t).items()) for k in own}
        best = max(odds, key=odds.get)
        p = 1 / sum(math.exp(v - odds[best]) for v in odds.values())
        assert abs(r.score - p) < 1e-3 and (r.lang_pred == best or abs(p - 0.5) < 1e-3)
