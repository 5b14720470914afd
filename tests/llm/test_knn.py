import math

import numpy as np
import pytest

from talus.llm import knn


def brute(rows, step=50, k=5):
    ok = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, qv in ok:
        if q % step == 0:
            s = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in ok if i != q and len(v) == len(qv))
            out += [(q, r, i, -x) for r, (x, i) in enumerate(s[:k], 1)]
    return sorted(out)


def got(df, **kw):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in knn.top_k(df, **kw).collect())


def test_query(spark, data):
    from talus.llm.queries import queries

    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{data}/embeddings.parquet").collect()]
    assert sorted(tuple(r) for r in queries()["op9_exact_top_k"](spark, data).select("query_id", "rank", "vec_id", "score").collect()) == brute(rows)


def test_ties_copies_and_bad_vectors(spark, monkeypatch):
    monkeypatch.setattr(knn, "LEAF", 8)
    rng = np.random.default_rng(3)
    same = [0.5, -0.25, 1.0]
    rows = [(i, same) for i in range(0, 300)] + [(300 + i, rng.normal(size=3).round(1).tolist()) for i in range(200)]
    rows += [(1000, None), (1050, []), (1100, [1.0, None, 2.0]), (1150, [float("nan"), 1.0, 1.0]), (1200, [float("inf"), 1.0, 1.0]), (None, same), (1250, [1.0, 2.0]), (1251, [1.0, 3.0]), (1300, [9.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, shard int")
    assert got(df) == brute(rows)


def test_several_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(knn, "SHARD_ROWS", 60)
    monkeypatch.setattr(knn, "BLOCK_QUERIES", 4)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(-200, 600)]
    assert got(spark.createDataFrame(rows, "vec_id long, embedding array<double>")) == brute(rows)


def test_empty(spark):
    assert got(spark.createDataFrame([], "vec_id long, embedding array<float>")) == []


@pytest.mark.parametrize("leaf", [1, 7, 1000])
def test_tree_boxes_bound_scores(leaf):
    rng = np.random.default_rng(5)
    x = rng.integers(-50, 50, (500, 5)).astype(float)
    t = knn.Tree(x, leaf)
    q = rng.integers(-50, 50, (20, 5)).astype(float)
    least = np.iinfo(np.int64).min
    bound = t.reached(q, np.full(20, least))
    assert sorted(t.order) == list(range(500))
    for k in range(len(t.edges) - 1):
        assert ((q @ t.x[t.edges[k] : t.edges[k + 1]].T).max(1) <= bound[:, k]).all()
        own = t.x[t.edges[k] : t.edges[k + 1]]
        assert (bound[:, k] == np.where(q > 0, q * own.max(0), q * own.min(0)).sum(1)).all()
    floor = np.sort(q @ x.T, 1)[:, -5].astype(np.int64)
    some = t.reached(q, floor)
    assert ((some == bound) | ((some == least) & (bound < floor[:, None]))).all() and (leaf == 1000 or (some == least).any())
