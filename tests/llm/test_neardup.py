import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from talus.llm import neardup
from talus.llm.graph import components


def brute(rows, size, percent):
    """(set size, component) of each id, by the definition."""
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = frozenset(tuple(w[k : k + size]) for k in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])
    root, having = {i: i for i in sets}, defaultdict(list)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in sets.items():
        common = Counter(j for g in s for j in having[g])
        for g in s:
            having[g].append(i)
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def corpus(seed=3):
    rng = random.Random(seed)
    voc = [f"w{k}" for k in range(3000)]
    rows = []
    for _ in range(5):
        base = [rng.choice(voc) for _ in range(120)]
        for _ in range(50):
            w = list(base)
            for _ in range(rng.randint(0, 9)):
                w[rng.randrange(len(w))] = rng.choice(voc)
            rows.append((len(rows), " ".join(w)))
    rows += [(900 + k, rows[k][1].upper()) for k in range(5)]
    return rows + [(1000, None), (1001, ""), (1002, "  "), (1003, "A b"), (1004, "a B"), (1005, "a b c"), (1006, "a"), (-7, rows[9][1]), (1007, "long " * 50_000), (1008, "Long " * 50_000)]


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_like_brute_force(spark, size, percent):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r[0]: tuple(r)[1:] for r in neardup.near_duplicates(df, size, percent).collect()}
    assert got == brute(rows, size, percent)


def test_blocks_of_a_large_cluster(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 20)
    rows = corpus(4)
    df = spark.createDataFrame(rows, "doc_id int, text string")
    got = {r[0]: tuple(r)[1:] for r in neardup.near_duplicates(df).collect()}
    assert got == brute(rows, 3, 85)


def test_blocks_of_keys_that_many_documents_share(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 7)
    monkeypatch.setattr(neardup, "KEY_BLOCK", 5)
    rows = corpus(5)
    df = spark.createDataFrame(rows, "doc_id int, text string")
    got = {r[0]: tuple(r)[1:] for r in neardup.near_duplicates(df).collect()}
    assert got == brute(rows, 3, 85)


@pytest.mark.parametrize("most", [3, 50])
def test_across_finds_every_link_of_a_group(spark, most):
    """Links that do not carry over: two members may be linked although nothing that they are connected with is."""
    rng = random.Random(most)
    groups = [(g * 1000 + k, g) for g, n in ((1, 120), (2, 61), (3, 4)) for k in range(n)]
    true = {tuple(sorted(rng.sample([m for m, r in groups if r == g], 2))) for g, n in ((1, 70), (2, 100), (3, 2)) for _ in range(n)}
    true |= {(2000, 2000 + k) for k in range(1, 30)}
    links = spark.createDataFrame(sorted(true), "x long, y long")

    def compare(work):
        one, two = (work.select(F.col("member").alias(n), "root", "left", "right", F.col("part").alias(f"p{n}")) for n in "ab")
        both = one.join(two, ["root", "left", "right"]).filter("(pa = left AND pb = right) OR (pb = left AND pa = right)")
        return both.join(links, (F.col("a") == F.col("x")) & (F.col("b") == F.col("y"))).select("a", "b")

    large = spark.createDataFrame(groups, "member long, root long")
    got = {r.node: r.root for r in neardup.across(large, spark.createDataFrame([], "a long, b long"), compare, most).collect()}
    assert got == {r.node: r.root for r in components(links.toDF("a", "b")).collect()}


def test_nulls_repeats_and_other_columns(spark):
    rows = [(None, "a b c d", 1), (None, "a b c d", 2), (5, "a b c d", 3), (5, "a b c d", 3), (6, "A b c d", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id int")
    got = sorted((tuple(r) for r in neardup.near_duplicates(df).collect()), key=repr)
    assert got == sorted([(None, 2, None, True)] * 2 + [(5, 2, 5, True)] * 2 + [(6, 2, 5, False)], key=repr)
    assert neardup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_all_signatures_within_the_threshold_share_a_key():
    """The pigeonhole guarantee: whatever ERRORS symbols differ, a key is shared."""
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 32, (300, neardup.SKETCH)).astype(np.uint32)
    b = a.copy()
    for i in range(len(b)):
        at = rng.permutation(neardup.SYMBOLS)[: neardup.ERRORS]
        b[i, at] = rng.integers(0, 1 << 32, neardup.ERRORS)
    ka, kb = neardup.signature_keys(a), neardup.signature_keys(b)
    assert (ka == kb).any(1).all()


def test_sketch_distance():
    rng = np.random.default_rng(2)
    m = rng.integers(0, 1 << 32, (2, neardup.SKETCH)).astype(np.uint32)
    s = neardup.sketch(m)
    nib = [[(int(w) >> (4 * k)) & 15 for w in row for k in range(16)] for row in s]
    assert neardup.distance(s[0], s[1]) == sum(x != y for x, y in zip(*nib))


def apart(seed):
    """Two texts of 185 words with 170 in common (a similarity of 0.85 by words): the others are those whose minima decide most of the
    sketch beyond the signature."""
    words = [f"v{seed}x{k}" for k in range(200)]
    h, edges = neardup.shingles(neardup.Words([w.encode() for w in words], lower=True), 1)
    least = neardup.minima(h, edges).argmin(0)
    own = np.bincount(least[neardup.SYMBOLS :], minlength=200).argsort()[-30:].tolist()
    common = [w for k, w in enumerate(words) if k not in own]
    return [" ".join(common + [words[k] for k in part]) for part in (own[::2], own[1::2])]


def test_pairs_within_the_threshold_are_confirmed_however_far_their_sketches(spark):
    texts = []
    for seed in range(20):
        pair = apart(seed)
        m = neardup.minima(*neardup.shingles(neardup.Words([t.encode() for t in pair], lower=True), 1))
        a, b = neardup.mix(m.astype(np.uint64)) & np.uint64(255)
        sketch = neardup.sketch(m)
        if (a != b)[: neardup.SYMBOLS].sum() <= neardup.ERRORS and neardup.distance(sketch[0], sketch[1]) > 28:
            texts += pair
    assert len(texts) >= 20
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in neardup.near_duplicates(df, 1, 85).collect()} == {k: k - k % 2 for k in range(len(texts))}


@pytest.mark.parametrize("similarity", [0.80, 0.85])
def test_sketches_lose_less_than_keys(similarity):
    p, n, bound = (1 - similarity) * 15 / 16, neardup.SKETCH, neardup.sketch_bound(similarity)
    tail = sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(bound + 1, n + 1))
    q = (1 - similarity) * (1 - 2**-16)
    chunk = (1 - q) ** 4 + 4 * q * (1 - q) ** 3
    assert tail <= (1 - chunk) ** 8 / 10


def test_words_that_sums_of_powers_confuse_are_not_linked(spark):
    x, y = "a", "b"
    for _ in range(10):
        x, y = x + y, y + x
    rows = [(1, x), (2, y), (3, f"{x} {y}"), (4, f"{y} {x}"), (5, x)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in neardup.near_duplicates(df).collect()} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 1}


def test_components(spark):
    rng = random.Random(1)
    chain = [(k, k + 1) for k in range(40)]
    star = [(100, 100 + k) for k in range(1, 300)]
    edges = chain + star + [(rng.randint(500, 600), rng.randint(500, 600)) for _ in range(40)] + [(7, 7), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = brute([], 3, 85)
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    assert want == {} and got == {n: find(n) for n in root}


def test_query(spark, data):
    from talus.llm.queries import queries

    docs = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    got = {r[0]: tuple(r)[1:] for r in queries()["op3_near_dedup"](spark, data).collect()}
    assert got == brute(docs, 3, 85)


def test_recall_of_near_pairs():
    """Pairs of a similarity of 85 to 90 percent, of texts of 60 to 1,200 words, met under a key and near by their marks: all of 20,000."""
    from talus.llm.words import Words

    rng = np.random.default_rng(17)
    found = pairs = 0
    bound = neardup.sketch_bound(0.85)
    while pairs < 20_000:
        texts = []
        for _ in range(500):
            n = int(rng.choice([60, 150, 400, 1200]))
            a = rng.integers(0, 1 << 40, n)
            b = a.copy()
            # A changed word breaks three shingles: so many leave a similarity somewhat over 85 percent.
            b[rng.choice(n, max(1, int(n * rng.uniform(0.015, 0.027))), replace=False)] = rng.integers(0, 1 << 40)
            texts += [" ".join(map(str, a.tolist())).encode(), " ".join(map(str, b.tolist())).encode()]
        h, edges = neardup.shingles(Words(texts, lower=True), 3)
        m = neardup.minima(h, edges)
        keys, marks = neardup.signature_keys(m), neardup.marks(m)
        for i in range(0, len(texts), 2):
            x, y = (h[edges[k] : edges[k + 1]] for k in (i, i + 1))
            common = len(np.intersect1d(x, y))
            if 85 <= 100 * common / (len(x) + len(y) - common) < 90:
                pairs += 1
                found += bool((keys[i] == keys[i + 1]).any()) and bool(neardup.near(marks[i], marks[i + 1], bound))
    assert found == pairs, (found, pairs)
