import hashlib
import random
import re

import numpy as np
import pytest

from talus.llm import repeats
from talus.llm.repeats import rank, repeated
from talus.llm.words import Words

WIDTH = 13


def brute(rows, width=WIDTH):
    """Kept words of each row, by the definition."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    first = {}
    for (i, _), w in zip(rows, words):
        for k in range(len(w) - width + 1):
            if i is not None:
                g = tuple(w[k : k + width])
                first[g] = min(first.get(g, i), i)
    out = []
    for (i, _), w in zip(rows, words):
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if i is not None and first[tuple(w[k : k + width])] < i:
                gone[k : k + width] = [True] * width
        out.append((i, len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone) if not g).encode()).hexdigest()))
    return out


def corpus(seed=5):
    rng = random.Random(seed)
    voc = [f"w{k}" for k in range(400)] + ["é", "日本", "a", "b"]
    say = lambda n: [rng.choice(voc) for _ in range(n)]
    passage, exact13 = say(60), say(13)
    rows = []
    for i in range(120):
        w = say(rng.randint(0, 90))
        if i % 3 == 0:
            at, lo = rng.randint(0, len(w)), rng.randint(0, 20)
            w[at:at] = passage[lo : lo + rng.randint(12, 40)]
        if i % 5 == 0:
            w[len(w) // 2 : len(w) // 2] = exact13
        if i % 7 == 0:
            w += ["x"] * rng.randint(0, 40)
        if i % 11 == 0:
            w += ["p", "q"] * 15
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(w)))
    rows += [(200 + i, rows[3 * i][1]) for i in range(8)]
    rows += [(300, None), (301, ""), (302, " \n"), (303, "one"), (None, rows[0][1]), (-5, rows[30][1]), (3, rows[3][1])]
    rows += [(400, " ".join(say(30_000))), (401, " ".join(passage * 3))]
    return rows


@pytest.mark.parametrize(("heavy", "in_task"), [(4096, 256), (4096, 1), (2, 256), (0, 0)])
@pytest.mark.parametrize("width", [13, 6])
def test_like_brute_force(spark, heavy, in_task, width):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, repeated(df, width, digest=True, groups=5, heavy=heavy, heavy_in_task=in_task).collect()), key=repr)
    assert got == sorted(brute(rows, width), key=repr)


def test_small_chunks_carry_heavy_prefixes(spark, monkeypatch):
    """A prefix with more rows than a chunk: whole windows are settled chunk by chunk, shorter prefixes are held together."""
    monkeypatch.setattr(repeats, "CHUNK_ROWS", 4)
    rows = corpus(6)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for heavy in (0, 4096):
        got = sorted(map(tuple, repeated(df, digest=True, groups=40, heavy=heavy).collect()), key=repr)
        assert got == sorted(brute(rows), key=repr)


def mirrored(n, a, b):
    """Two different sequences of 2^n symbols whose polynomial hashes modulo a power of two agree."""
    x, y = [a], [b]
    for _ in range(n):
        x, y = x + y, y + x
    return x, y


def test_words_and_runs_that_sums_of_powers_confuse(spark):
    x, y = mirrored(10, "a", "b")
    pad = " ".join(f"w{k}" for k in range(12))
    p, q = mirrored(11, "p", "q")
    rows = [(1, f"{pad} {''.join(x)}"), (2, f"{pad} {''.join(y)}"), (3, " ".join(p[1:])), (4, " ".join(q[1:]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, repeated(df, digest=True).collect())) == sorted(brute(rows))
    one, two = (Words([" ".join(t).encode()]) for t in (p, q))
    assert one.grams(2048)[0] != two.grams(2048)[0]


def test_rank_is_the_order_of_runs():
    rng = np.random.default_rng(1)
    tokens = rng.integers(0, 3, 500)
    for width in (1, 2, 3, 6, 13):
        runs = [tuple(tokens[i : i + width]) for i in range(len(tokens) - width + 1)]
        order = {r: k for k, r in enumerate(sorted(set(runs)))}
        got = rank(tokens, width)
        assert [order[r] for r in runs] == (got if width > 1 else np.unique(tokens, return_inverse=True)[1]).tolist()


def test_other_ids_are_refused(spark):
    with pytest.raises(TypeError):
        repeated(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


def test_texts_spans_and_carried_columns(spark):
    shared = " ".join(f"s{k}" for k in range(20))
    rows = [(1, shared, "a", 1), (2, "x\n" + shared + " y", "b", None), (3, "as  it\nwas", None, 3), (4, None, "d", 4)]
    df = spark.createDataFrame(rows, "doc_id int, text string, n_words string, grp int")
    got = {r[0]: tuple(r) for r in repeated(df, carry=("grp",)).collect()}
    assert got[1][1:4] == (20, 0, shared)
    assert got[2][1:] == (22, 20, "x y", [[1, 21]], None)
    assert got[3][1:4] == (3, 0, "as  it\nwas") and got[4][1:4] == (0, 0, None)
    assert [got[k][-1] for k in (1, 3, 4)] == [1, 3, 4]


def test_empty_table(spark):
    assert repeated(spark.createDataFrame([], "doc_id long, text string"), digest=True).collect() == []


def test_words_and_runs():
    w = Words([b"a bb  a", b"", b"bb a\tbb"])
    assert w.first.tolist() == [0, 3, 3, 6] and w.doc.tolist() == [0, 0, 0, 2, 2, 2]
    assert w.hash[0] == w.hash[2] == w.hash[4] and w.hash[0] != w.hash[1]
    pairs = w.grams(2)
    assert pairs[1] == pairs[3] and pairs[0] != pairs[1] and len(pairs) == 5
    long = Words([b"x" * n for n in (7, 8, 9, 255, 256, 257, 300, 300)] + [b"x" * 299 + b"y"])
    assert len(set(long.hash.tolist())) == 8


def test_query(spark, data):
    from talus.llm.queries import queries

    docs = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, queries()["op1_substring_dedup"](spark, data).collect()))
    assert got == sorted(brute(docs))


def test_repetitive_texts_are_many_blocks_of_bounded_size():
    w = Words([b"na " * 5000, b"a b c d e f g h i j k l m n o p"])
    start, last, anchor = repeats.blocks(w, 13)
    assert (last - start).max() < repeats.MOST_WINDOWS and len(start) >= 4988 / repeats.MOST_WINDOWS
    whole = np.concatenate([np.arange(a, b + 1) for a, b in zip(start, last, strict=True)])
    assert whole.tolist() == w.starts(13).tolist()


def test_repetitive_texts_and_long_words(spark):
    """Words that repeat over thousands of windows with one other among them, and words of many kilobytes that differ at their ends."""
    rng = random.Random(11)
    long_ = ["x" * 5000 + c for c in "abc"]
    rows = []
    for k in range(60):
        words = ["na"] * rng.randint(300, 900)
        words[rng.randrange(len(words))] = f"w{k % 9}"
        rows.append((k, " ".join(words)))
    for k in range(60, 80):
        rows.append((k, " ".join(rng.choice(long_) for _ in range(40))))
    rows += [(90, " ".join([long_[0]] * 20)), (91, " ".join([long_[0]] * 20)), (92, " ".join([long_[1]] * 20)), (93, "\0" + "0" * 128 + " q" * 14)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for how in ({}, {"heavy": 50, "heavy_in_task": 20}):
        got = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in repeated(df, digest=True, **how).collect()]
        assert sorted(got) == brute(rows)
