import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from talus.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf_of(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def lower(text):
    return text if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def tree(nodes, fanout):
    """Root, and of each node the siblings in its runs with its place there."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[k : k + fanout] for k in range(0, len(nodes), fanout)]
        for k, i in enumerate(at):
            run = runs[i // fanout]
            ways[k].append((i % fanout, "".join(run[: i % fanout] + run[i % fanout + 1 :])))
            at[k] = i // fanout
        nodes = ["".join(r) for r in runs]
        nodes = [sha(n) for n in nodes]
    return nodes[0], ways


def brute(rows, fanout=16):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subs = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        subs[g] = tree([leaf_of(r) for r in groups[g]], fanout)
    root, ways = tree([subs[g][0] for g in names], fanout)
    out = []
    for g, up in zip(names, ways, strict=True):
        for r, way in zip(groups[g], subs[g][1], strict=True):
            path = way + up
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            folded = leaf_of((*r[:4], lower(r[4]))) if hit else leaf_of(r)
            for at, others in path:
                folded = sha(others[: 64 * at] + folded + others[64 * at :])
            out.append((r[0], leaf_of(r), subs[g][0], root, sha("".join(o for _, o in path)), folded, folded == root, tuple(path)))
    return out


def held(df, rows):
    got = sorted((tuple(r) for r in merkle.tampered(df).collect()), key=repr)
    assert got == sorted((r[:7] for r in brute(rows)), key=repr)
    return got


def corpus(seed=5):
    rng = random.Random(seed)
    text = lambda: " ".join(rng.choice(["Alpha", "beta", "é", "日本", "🙂", "X"]) for _ in range(rng.randint(0, 6)))
    sizes = {None: 17, "": 1, "-": 16, "a": 257, "b": 700, "é": 33, "z:1": 2, "Z": 3}
    rows, i = [], -20
    for g, n in sizes.items():
        for _ in range(n):
            rows.append((i, g, rng.choice([None, "en", ""]), rng.choice([None, 0, -3, 12]), rng.choice([None, text(), text(), text()])))
            i += 1
    rows += [(None, "a", None, None, None), (None, "a", "x", 1, "Y"), (None, None, None, None, None)]
    rows += [(5, "b", "en", 1, "Same")] * 40 + [(5, "b", "en", 1, "Other")] + [(7, "long", "en", 0, "LONG " * 200_000)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("part_rows", [1 << 14, 64, 7])
def test_like_the_definition(spark, monkeypatch, part_rows):
    """Partitions larger than all groups, of a few runs, and smaller than a run."""
    monkeypatch.setattr(merkle, "PART_ROWS", part_rows)
    rows = corpus()
    got = held(spark.createDataFrame(rows, SCHEMA).repartition(5), rows)
    assert 0 < sum(not r[6] for r in got) < len(got) / 4


@pytest.mark.parametrize("part_rows", [1 << 14, 20])
def test_proofs(spark, monkeypatch, part_rows):
    monkeypatch.setattr(merkle, "PART_ROWS", part_rows)
    rows = corpus(6)
    out = merkle.manifest(spark.createDataFrame(rows, SCHEMA), fanout=4).collect()
    want = sorted(((r[0], r[1], r[2], r[3], r[7]) for r in brute(rows, 4)), key=repr)
    assert sorted(((r.doc_id, r.leaf, r.subroot, r.root, tuple((p.at, p.others) for p in r.proof)) for r in out), key=repr) == want
    assert all(merkle.fold(r.leaf, [tuple(p) for p in r.proof]) == r.root for r in out)
    assert not any(merkle.fold("0" * 64, [tuple(p) for p in r.proof]) == r.root for r in out)


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257])
def test_one_group(spark, monkeypatch, n):
    monkeypatch.setattr(merkle, "PART_ROWS", 30)
    rows = [(k, "s", "en", 1, f"Text {k}") for k in range(n)]
    got = held(spark.createDataFrame(rows, SCHEMA), rows)
    assert got[0][2] == got[0][3]


def test_every_row_its_own_group(spark, monkeypatch):
    monkeypatch.setattr(merkle, "PART_ROWS", 50)
    rows = [(k, f"s{k}", None, k, "T") for k in range(300)]
    held(spark.createDataFrame(rows, SCHEMA), rows)


def test_local_levels():
    digests = [f"{k:064x}" for k in range(100)]
    whole = merkle.local_levels(digests, 0, 100, 4)
    assert [(s, len(d), n) for s, d, n in whole] == [(0, 100, 100), (0, 25, 25), (0, 7, 7), (0, 2, 2), (0, 1, 1)]
    assert [(level, k) for level, k, _ in merkle._ragged(whole, 4)] == [(4, 0)]
    part = merkle.local_levels(digests[3:90], 3, 100, 4)
    assert [(s, len(d)) for s, d, _ in part] == [(3, 87), (1, 21), (1, 4)]
    assert [(level, k) for level, k, _ in merkle._ragged(part, 4)] == [(0, 3), (0, 88), (0, 89), (1, 1), (1, 2), (1, 3), (1, 20), (1, 21), (2, 1), (2, 2), (2, 3), (2, 4)]


def test_other_columns_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "s", "en", 2, "Ab", "x", 9)], SCHEMA + ", root string, part int")
    assert [r.leaf for r in merkle.tampered(df).collect()] == [leaf_of((1, "s", "en", 2, "Ab"))]
    assert merkle.tampered(df.limit(0)).collect() == []


def test_another_group_and_key(spark):
    df = spark.createDataFrame([(f"k{k}", k % 3, str(k)) for k in range(50)], "name string, shard int, body string")
    out = merkle.manifest(df, group="shard", key="name", fields=("name", "body"))
    assert out.columns[0] == "name" and out.agg(F.count_distinct("subroot"), F.count_distinct("root")).first()[:] == (3, 1)
