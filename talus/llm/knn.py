"""Exact top-k by inner product: a KD-tree per shard, best-first traversal, and a kth score handed on.

Trees split at medians of the widest dimension; every node has a tight bounding box. The largest inner product
that a box can hold is, dimension by dimension, the larger of query * low and query * high. All queries of a block walk the tree from the root
together: those whose bound for a node is below the kth score handed to them do not enter it. The leaves that a query has reached are opened best
first, while their bound is not below its kth score so far.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .scratch import materialize

LEAF = 256
#: Rows of a shard, and queries of a block, on average; a table has LEAST_SHARDS shards at least. A vector is sent once for each block of queries.
SHARD_ROWS, BLOCK_QUERIES, LEAST_SHARDS = 65_536, 8192, 12


class Tree:
    """A KD-tree over the rows of x: order (row numbers, leaf after leaf) and edges of leaves; of every node its box (low, high), its
    children (none: -1) and its leaf (an inner node: -1). Node 0 is the root."""

    def __init__(self, x: np.ndarray, leaf: int = LEAF):
        order, edges, todo = [], [0], [(np.arange(len(x)), -1, 0)]
        low, high, self.children, self.leaf = [], [], [], []
        while todo:
            rows, parent, side = todo.pop()
            node, part = len(low), x[rows]
            if parent >= 0:
                self.children[parent][side] = node
            low.append(part.min(0))
            high.append(part.max(0))
            self.children.append([-1, -1])
            spread = high[-1] - low[-1]
            d = int(spread.argmax())
            if len(rows) <= leaf or spread[d] == 0:
                self.leaf.append(len(edges) - 1)
                order.append(rows)
                edges.append(edges[-1] + len(rows))
                continue
            self.leaf.append(-1)
            half = np.argpartition(part[:, d], len(rows) // 2)
            todo += [(rows[half[len(rows) // 2 :]], node, 1), (rows[half[: len(rows) // 2]], node, 0)]
        self.order, self.edges = np.concatenate(order), np.array(edges)
        self.x, self.low, self.high = x[self.order], np.array(low), np.array(high)

    def reached(self, queries: np.ndarray, floor: np.ndarray) -> np.ndarray:
        """Bounds (query, leaf) of the leaves that queries reach from the root through nodes whose bound is not below their floor; the
        least integer for the others."""
        up, down = np.maximum(queries, 0), np.minimum(queries, 0)
        out = np.full((len(queries), len(self.edges) - 1), np.iinfo(np.int64).min, queries.dtype)
        todo = [(0, np.arange(len(queries)))]
        while todo:
            node, q = todo.pop()
            bound = up[q] @ self.high[node] + down[q] @ self.low[node]
            enter = bound >= floor[q]
            q = q[enter]
            if not len(q):
                continue
            if self.leaf[node] >= 0:
                out[q, self.leaf[node]] = bound[enter]
            else:
                todo += [(child, q) for child in self.children[node]]
        return out


def search(tree: Tree, ids: np.ndarray, queries: np.ndarray, own: np.ndarray, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scores and ids (query, k) of each query's best rows, higher score first, then smaller id; the least integer as a score fills up.

    floor: a score that k other rows are known to reach, so that rows below it are not needed.
    """
    ids = ids[tree.order]
    top_s = np.full((len(queries), k), np.iinfo(np.int64).min)
    top_i = np.zeros((len(queries), k), np.int64)
    bound = tree.reached(queries, floor)
    visit = np.argsort(-bound, axis=1, kind="stable")
    kth = floor.copy()
    live = np.arange(len(queries))
    for step in range(bound.shape[1]):
        at = visit[live, step]
        live, at = live[keep := bound[live, at] >= kth[live]], at[keep]
        if not len(live):
            break
        for leaf in np.unique(at):
            q = live[at == leaf]
            lo, hi = tree.edges[leaf], tree.edges[leaf + 1]
            s = (queries[q] @ tree.x[lo:hi].T).astype(np.int64)
            here = np.broadcast_to(ids[lo:hi], s.shape)
            s = np.where(here == own[q, None], np.iinfo(np.int64).min, s)
            all_s, all_i = np.hstack([top_s[q], s]), np.hstack([top_i[q], here])
            best = np.lexsort((all_i, ~all_s), axis=1)[:, :k]
            top_s[q], top_i[q] = np.take_along_axis(all_s, best, 1), np.take_along_axis(all_i, best, 1)
            full = top_s[q, k - 1] > np.iinfo(np.int64).min
            kth[q[full]] = np.maximum(kth[q[full]], top_s[q[full], k - 1])
    return top_s, top_i


def _number(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Floats while every inner product is exact in them, else 64-bit integers."""
    most = lambda a: max(int(a.max(initial=0)), -int(a.min(initial=0)))
    kind = np.float64 if most(x) * most(y) * max(1, x.shape[1]) < 1 << 53 else np.int64
    return x.astype(kind), y.astype(kind)


def top_k(vectors: DataFrame, query_step: int = 50, k: int = 5, scale: int = 256) -> DataFrame:
    """The k rows of highest integer inner product for each query, against every other row.

    vectors: vec_id long, embedding array. Components become floor(scale * x). Queries are the rows whose vec_id is
    divisible by query_step. Returns query_id, rank (from 1), vec_id, score; ties go to the smaller vec_id; a query with
    fewer candidates has fewer rows. Null ids, and vectors that are null, empty or hold null or non-finite components, take no part.
    Vectors meet only those of equal length. Repeated rows are candidates of their own; a query's own rows are all that
    share its id, and of several vectors with that id the least is the query.

    Shards are hashes of ids, so a vector with many copies is spread evenly. Queries are first answered from one of them, the seed,
    whose kth scores are handed to all shards as floors; the shards' answers are reduced by a window.
    """
    good = F.expr("embedding IS NOT NULL AND size(embedding) > 0 AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))")
    ints = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    rows = vectors.filter(good & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), ints.alias("v"))
    rows = materialize(rows.withColumn("d", F.size("v")), "vectors")
    n = rows.count()
    queries = rows.filter(F.col("vec_id") % query_step == 0).groupBy("vec_id", "d").agg(F.min("v").alias("v"))
    shards, blocks = max(LEAST_SHARDS, -(-n // SHARD_ROWS)), max(1, -(-queries.count() // BLOCK_QUERIES))
    shard = F.pmod(F.xxhash64("vec_id", F.lit("shard")), F.lit(shards)).cast("int")
    block = F.pmod(F.xxhash64("vec_id", F.lit("block")), F.lit(blocks)).cast("int")

    def arrays(t: pa.Table, prefix: str = "") -> tuple[np.ndarray, np.ndarray]:
        ids = t.column(prefix + "vec_id").to_numpy()
        flat = t.column(prefix + "v").combine_chunks().flatten().to_numpy()
        return ids, flat.reshape(len(ids), -1)

    def answer(key, q: pa.Table, x: pa.Table):
        schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
        if not q.num_rows or not x.num_rows:
            return schema.empty_table()
        own, qv = arrays(q, "q_")
        ids, xv = arrays(x)
        qv, xv = _number(qv, xv)
        floor = q.column("q_floor").to_numpy() if "q_floor" in q.column_names else np.full(len(own), np.iinfo(np.int64).min)
        s, i = search(Tree(xv), ids, qv, own, k, floor)
        hit = (s > np.iinfo(np.int64).min) & (s >= floor[:, None])
        return pa.table([np.repeat(own, hit.sum(1)), i[hit], s[hit]], schema=schema)

    def run(q: DataFrame, x: DataFrame) -> DataFrame:
        q = q.select(*(F.col(c).alias(f"q_{c}") for c in q.columns))
        return q.groupBy("q_d", "q_shard", "q_block").cogroup(x.groupBy("d", "shard", "block")).applyInArrow(answer, "query_id long, vec_id long, score long")

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    spread = lambda df, lo, hi: df.withColumn("shard", F.explode(F.sequence(F.lit(lo), F.lit(hi))))
    copies = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    q = queries.withColumn("block", block)
    # The seed: one shard of every query block; its kth score is a floor that k rows reach.
    seeded = run(spread(q, 0, 0), rows.withColumn("shard", shard).filter(F.col("shard") < 1).withColumn("block", copies))
    floors = seeded.groupBy(F.col("query_id").alias("vec_id")).agg(F.when(F.count("*") >= k, F.min("score")).alias("floor"))
    q = q.join(floors, "vec_id", "left").select("vec_id", "v", "d", "block", F.coalesce("floor", F.lit(-(1 << 63))).alias("floor"))
    found = run(spread(q, 0, shards - 1), rows.withColumn("shard", shard).withColumn("block", copies))
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
