import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from talus.llm import simhash


def brute_fp(text, size=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    s = [" ".join(w[k : k + size]) for k in range(len(w) - size + 1)] if len(w) >= size else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(rows, errors=4):
    """(doc_id, fingerprint, component) of each row, with all pairs compared."""
    fp = [brute_fp(t) for _, t in rows]
    distinct = sorted(set(fp))
    root = {f: f for f in distinct}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, a in enumerate(distinct):
        for b in distinct[k + 1 :]:
            if (a ^ b).bit_count() <= errors:
                root[find(a)] = find(b)
    least = {}
    for (i, _), f in zip(rows, fp, strict=True):
        r = find(f)
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    return sorted(((i, f"{f:016x}", least[find(f)]) for (i, _), f in zip(rows, fp, strict=True)), key=repr)


def got(df, **kw):
    return sorted((tuple(r) for r in simhash.simhash_groups(df, **kw).collect()), key=repr)


def corpus(seed=4):
    rng = random.Random(seed)
    voc = [f"w{k}" for k in range(800)]
    rows = []
    for _ in range(6):
        base = [rng.choice(voc) for _ in range(200)]
        for _ in range(40):
            w = list(base)
            for _ in range(rng.randint(0, 6)):
                w[rng.randrange(len(w))] = rng.choice(voc)
            rows.append((len(rows), " ".join(w)))
    rows += [(500 + k, " ".join(rng.choice(voc) for _ in range(rng.randint(1, 30)))) for k in range(200)]
    rows += [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "A  b"), (1004, "a\tB "), (1005, "a b c d"), (1006, "A B\nC\x0bD"), (-7, rows[9][1]), (None, rows[9][1]), (None, "alone in the world here"), (3, "a second text of this id")]
    return rows + [(2000, "é\u00a0x \u0085y 日本 z"), (2001, "long " * 100_000), (2002, "x" * 200_000), (2003, " ".join(map(str, range(60_000))))]


def test_like_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(t, i, "s", "f") for i, t in rows], "text string, doc_id long, component_id string, fingerprint string")
    want = brute_groups(rows)
    assert got(df.repartition(7)) == want
    assert len({c for _, _, c in want}) < len(want)


def test_query(spark, data):
    from talus.llm.queries import queries

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in queries()["op11_simhash_groups"](spark, data).collect()), key=repr) == brute_groups(rows)


def test_the_engine_hashes_alike(spark):
    text = "some four word shingle"
    assert f"{spark.sql('SELECT xxhash64(?)', args=[text]).first()[0] % (1 << 64):016x}" == got(spark.createDataFrame([(1, text)], "doc_id long, text string"))[0][1]


@pytest.mark.parametrize("errors", [2, 3, 4, 7])
def test_variants_meet(spark, errors):
    """Pairs within the distance share a key or, of keys that are cut further, a longer one of each shared key; others may."""
    rng = np.random.default_rng(errors)
    rows = []
    for k in range(300):
        a = int(rng.integers(0, 1 << 64, dtype=np.uint64))
        b = a
        for bit in rng.permutation(64)[: rng.integers(0, errors + 1)]:
            b ^= 1 << int(bit)
        rows += [(k, a - (a >> 63 << 64)), (k, b - (b >> 63 << 64))]
    df = spark.createDataFrame(rows, "pair int, fp long")
    keys = df.select("pair", simhash.F.explode(simhash.variants(simhash.F.col("fp"), errors)).alias("key"), "fp")
    long = keys.select("pair", "key", simhash.F.explode(simhash.finer(simhash.F.col("key"), simhash.F.col("fp"), errors)).alias("longer"))
    assert df.join(keys, ["pair", "fp"]).groupBy("pair").agg(simhash.F.count("*").alias("n"), simhash.F.count_distinct("key").alias("k")).filter("n = k").count() == 0
    shared = Counter((r.pair, r.key) for r in keys.collect())
    both = {pk for pk, n in shared.items() if n > 1}
    again = Counter((r.pair, r.key, r.longer) for r in long.collect())
    assert both == {(p, k) for (p, k, _), n in again.items() if n > 1}


def test_keys_are_cut_further_and_dealt_in_blocks(spark, monkeypatch):
    """Very small blocks: every way of dealing is taken, with chains, one large group and strangers under the same keys."""
    monkeypatch.setattr(simhash, "KEY_BLOCK", 3)
    rng = random.Random(1)
    fps = {0, (1 << 64) - 1}
    for _ in range(3):
        centre = rng.getrandbits(64)
        fps |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for _ in range(25)}
        for _ in range(10):
            centre ^= sum(1 << b for b in rng.sample(range(64), 4))
            fps.add(centre)
    fps |= {rng.getrandbits(43) for _ in range(30)}
    signed = {f - (f >> 63 << 64): f for f in fps}
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in fps:
        for b in fps:
            if (a ^ b).bit_count() <= 4:
                root[find(a)] = find(b)
    want = Counter(frozenset(f for f in fps if find(f) == r) for r in fps if find(r) == r)
    groups = {}
    for r in simhash.near_fingerprints(spark.createDataFrame([(f,) for f in signed], "fingerprint long")).collect():
        groups.setdefault(r.root, set()).add(signed[r.node])
    assert {frozenset(g) for g in groups.values()} == {g for g in want if len(g) > 1}


def test_links_within_a_group_are_few():
    rng = np.random.default_rng(0)
    near = np.uint64(1 << 40) ^ (np.uint64(1) << rng.integers(0, 64, 2000).astype(np.uint64))
    a, b = simhash.group_links(np.full(2000, 2000), near, 4)
    assert len(a) < 2 * 2000


def test_empty_table(spark):
    assert got(spark.createDataFrame([], "doc_id long, text string")) == []
    assert got(spark.createDataFrame([(None, None), (None, "a b")], "doc_id long, text string"))[0][2] is None


def test_errors_are_bounded(spark):
    with pytest.raises(ValueError, match="2 to 15"):
        simhash.variants(simhash.F.lit(1), 1)
