"""Near duplicates: MinHash signatures, a multi-index Hamming join, and links confirmed on full shingle sets.

A document's signature is SYMBOLS minima of b = 16 bits. Signatures within ERRORS differing symbols are found by pigeonhole:
they are cut into CHUNKS chunks, and two signatures at a distance of at most ERRORS < 2 * CHUNKS have a chunk with at most one error;
all one-error patterns of a chunk are enumerated by leaving out one of its symbols in turn, so that such a pair shares a key.
Documents that meet under a key are candidates if their signatures are within ERRORS, or their finer sketches (more minima of 4 bits)
near enough, which keeps true links beyond ERRORS too. Candidates are gathered to clusters, and in a cluster every pair that is not yet linked is tried on the full sets.

Neither a key nor a cluster that very many documents share is one task's work, nor are all its pairs of blocks compared. It is cut into
blocks; blocks are compared within themselves, then the first documents of what that connected, block by block and again while they become
fewer; then pairs of blocks are left that hold different components (`across`). A group of copies is done after the first two steps.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .graph import components
from .scratch import materialize, small_side
from .words import U, Words, encoded, joined, mix, passes, slices

SYMBOLS, CHUNKS = 32, 8
#: The signature-distance threshold: all pairs within it are found, and of those beyond it the ones that share a key and have near sketches.
ERRORS = 2 * CHUNKS - 1
#: 4-bit minima of the finer sketch, packed in 64-bit words.
SKETCH = 64
#: Documents of a cluster that are compared pair by pair at once; larger clusters are cut into such blocks.
BLOCK = 128
#: Documents with one key that are compared at once; more are cut into such blocks.
KEY_BLOCK = 4096
#: Rows of one task of such comparisons, on average.
TASK_ROWS = 256
#: Another round over first documents is made while it leaves at most this share of them.
FEWER = 0.75

_PER = SYMBOLS // CHUNKS
_NIBBLE, _BYTE = U(0x1111111111111111), U(0x0101010101010101)


def shingles(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text and the edges between texts: runs of `size` words, the whole
    text as one if it has fewer, none without words."""
    n = np.diff(w.first)
    full = w.starts(size)
    grams = w.grams(size)[full]
    # A short text's one shingle is told from others by its number of words.
    short = np.flatnonzero((n > 0) & (n < size))
    own = mix(n[short].astype(U))
    for k in range(size - 1):
        there = np.flatnonzero(n[short] > k)
        own[there] = joined(own[there], w.hash[w.first[short[there]] + k])
    h, doc = np.concatenate([grams, own]), np.concatenate([w.doc[full], short])
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.concatenate(([True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1]))) if len(h) else np.zeros(0, bool)
    h, doc = h[new], doc[new]
    return h, np.searchsorted(doc, np.arange(len(n) + 1))


_SEEDS = mix(np.arange(1, SKETCH + 1, dtype=U) * U(0x9E3779B97F4A7C15))


def minima(h: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """MinHash values (text with shingles, SKETCH) as 32-bit integers."""
    x = (h >> U(16)).astype(np.uint32)
    y = h.astype(np.uint32)
    starts = edges[:-1][np.diff(edges) > 0]
    out = np.empty((len(starts), SKETCH), np.uint32)
    for k, seed in enumerate(_SEEDS):
        v = (x ^ np.uint32(seed & U(0xFFFFFFFF))) * np.uint32((seed >> U(32)) | U(1))
        v ^= y >> np.uint32(k % 7 + 9)
        v *= np.uint32(0x85EBCA6B)
        out[:, k] = np.minimum.reduceat(v, starts)
    return out


def symbols(m: np.ndarray) -> np.ndarray:
    """The signature's 16-bit symbols (document, SYMBOLS), in 64-bit integers."""
    return mix(m[:, :SYMBOLS].astype(U)) & U(0xFFFF)


def signature_keys(m: np.ndarray) -> np.ndarray:
    """Keys (document, CHUNKS * symbols of a chunk): chunk, symbol left out, and the chunk's other symbols, 48 bits, so that documents
    seldom share a key by chance however many there are."""
    symbol = symbols(m).reshape(len(m), CHUNKS, _PER)
    keys = []
    for c in range(CHUNKS):
        for out in range(_PER):
            key = np.full(len(m), c * _PER + out + 1, U)
            for s in range(_PER):
                if s != out:
                    key = key << U(16) | symbol[:, c, s]
            keys.append(key)
    return np.stack(keys, 1)


def sketch(m: np.ndarray) -> np.ndarray:
    """SKETCH 4-bit minima in 64-bit words (document, SKETCH / 16)."""
    nibble = (mix(m.astype(U)) >> U(40)) & U(15)
    shift = np.arange(16, dtype=U) * U(4)
    return (nibble.reshape(len(m), SKETCH // 16, 16) << shift).sum(2, dtype=U)


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing nibbles of sketches, broadcast over all but the last axis."""
    x = a ^ b
    x |= x >> U(2)
    x |= x >> U(1)
    return np.bitwise_count(x & _NIBBLE).sum(-1)


def marks(m: np.ndarray) -> np.ndarray:
    """Sketch and signature of every document in 64-bit words (document, SKETCH / 16 + SYMBOLS / 8). The low halves of the symbols do: by
    them signatures are never farther apart than by the whole."""
    return np.concatenate([sketch(m).astype("<u8"), (symbols(m) & U(255)).astype(np.uint8).view("<u8")], 1)


def near(a: np.ndarray, b: np.ndarray, bound: int) -> np.ndarray:
    """Whether marks have signatures within ERRORS or sketches within the bound, broadcast over all but the last axis."""
    cut = SKETCH // 16
    x = a[..., cut:] ^ b[..., cut:]
    for k in (4, 2, 1):
        x |= x >> U(k)
    return (np.bitwise_count(x & _BYTE).sum(-1) <= ERRORS) | (distance(a[..., :cut], b[..., :cut]) <= bound)


def keys_miss(similarity: float) -> float:
    """The probability that a pair of this similarity shares no key: every chunk has two errors or more."""
    p = (1 - similarity) * (1 - 2**-16)
    return (1 - (1 - p) ** _PER - _PER * p * (1 - p) ** (_PER - 1)) ** CHUNKS


def sketch_bound(similarity: float) -> int:
    """Differing nibbles that a pair of this similarity exceeds with at most a tenth of the probability that it shares no key:
    the exact binomial tail."""
    p, bound, tail = (1 - similarity) * 15 / 16, SKETCH, 0.0
    while bound and (tail := tail + comb(SKETCH, bound) * p**bound * (1 - p) ** (SKETCH - bound)) <= keys_miss(similarity) / 10:
        bound -= 1
    return bound


def forest(mk: np.ndarray, bound: int) -> list[tuple[int, int]]:
    """Edges (pivot, other) of a spanning forest of the rows whose marks are near, by search from pivots."""
    rest = np.arange(len(mk))
    edges = []
    while len(rest):
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            p = todo.pop()
            close = near(mk[p], mk[rest], bound)
            edges += [(p, q) for q in rest[close]]
            todo += rest[close].tolist()
            rest = rest[~close]
    return edges


def link_all(sets: list[np.ndarray], percent: int, half: int | None = None, known: list | None = None) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Roots of the rows and the forest of confirmed links. Pairs of one component (at first: with equal values in known) are not tried
    again; of the others, all whose sizes allow it are, on their full sets. With half, only pairs between rows before and from half on."""
    n = len(sets)
    size = np.fromiter(map(len, sets), np.int64, n)
    flat = np.concatenate(sets) if n else np.zeros(0, U)
    universe, flat = np.unique(flat, return_inverse=True)
    flat = flat.ravel()
    edge = np.concatenate(([0], np.cumsum(size)))
    mark = np.zeros(len(universe), bool)
    root = np.arange(n) if known is None else np.unique(np.array(known, np.int64), return_inverse=True)[1].ravel()
    links = []
    for i in range(n if half is None else half):
        lo = i + 1 if half is None else half
        others = np.arange(lo, n)
        s = size[lo:]
        others = others[(root[lo:] != root[i]) & (100 * np.minimum(s, size[i]) >= percent * np.maximum(s, size[i]))]
        if not len(others) or not size[i]:
            continue
        mine = flat[edge[i] : edge[i + 1]]
        mark[mine] = True
        for at in range(0, len(others), 512):
            j = others[at : at + 512]
            count = size[j]
            begin = np.cumsum(count) - count
            gather = np.repeat(edge[j] - begin, count) + np.arange(count.sum())
            common = np.add.reduceat(mark[flat[gather]], begin, dtype=np.int64)
            for q in j[100 * common >= percent * (size[i] + count - common)]:
                a, b = root[i], root[q]
                if a != b:
                    root[root == max(a, b)] = min(a, b)
                    links.append((i, int(q)))
        mark[mine] = False
    return root, links


def _dealt(groups: DataFrame, most: int, salt: int) -> DataFrame:
    """Members (member, root, comp, k: the group's size) with the block of at most about `most` that each falls to, compared with itself."""
    block = F.pmod(F.xxhash64("member", F.lit(salt)), F.ceil(F.col("k") / most)).cast("string")
    return groups.select("member", "root", "comp", block.alias("part"), block.alias("left"), block.alias("right"))


def _remaining(state: DataFrame, most: int) -> DataFrame:
    """Members of groups (member, root, comp) once for each pair of blocks that hold different components. Components of `most` or more
    members have blocks of their own, smaller ones lie whole in a common one."""
    sizes = state.groupBy("root", "comp").agg(F.count("*").alias("c"))
    small = sizes.groupBy("root").agg(F.coalesce(F.sum(F.when(F.col("c") < most, F.col("c"))), F.lit(0)).alias("s"))
    own = F.col("c") >= most
    home = F.when(own, F.col("comp").cast("string")).otherwise("-")
    number = F.pmod(F.when(own, F.xxhash64("member")).otherwise(F.xxhash64("comp")), F.greatest(F.ceil(F.when(own, F.col("c")).otherwise(F.col("s")) / most), F.lit(1)))
    placed = state.join(sizes, ["root", "comp"]).join(small, "root").withColumn("home", home).withColumn("part", F.concat_ws("/", "home", number.cast("string")))
    placed = materialize(placed.select("member", "root", "comp", "home", "part"), "blocks")
    blocks = placed.select("root", "home", "part").distinct()
    left = blocks.select("root", F.col("home").alias("a"), F.col("part").alias("left"))
    right = blocks.select("root", F.col("home").alias("b"), F.col("part").alias("right"))
    pairs = left.join(right, "root").filter((F.col("left") <= F.col("right")) & ((F.col("a") != F.col("b")) | (F.col("a") == "-"))).select("root", "left", "right")
    sides = pairs.withColumn("part", F.explode(F.array_distinct(F.array("left", "right"))))
    return placed.drop("home").join(sides, ["root", "part"])


def across(large: DataFrame, links: DataFrame, compare: Callable[[DataFrame], DataFrame], most: int) -> DataFrame:
    """node, root of the components of links and of all pairs that compare finds between members of one group.

    large: member, root (a group too large for one comparison, whose blocks have been compared within themselves: links). compare takes
    members with root, comp, left, right and part (left or right) and gives links between those of blocks left and right.
    The first member of each component stands for it as long as that makes components fewer; then all pairs of blocks with different components
    are compared, so nothing is lost where links do not carry over.
    """
    star, salt, before = components(links), 0, None
    while True:
        found = star.select(F.col("node").alias("member"), F.col("root").alias("known"))
        state = large.join(found, "member", "left").select("member", "root", F.coalesce("known", "member").alias("comp"))
        first = state.groupBy("root", "comp").agg(F.min("member").alias("member"))
        open_ = first.groupBy("root").agg(F.count("*").alias("k")).filter("k > 1")
        heads = materialize(first.join(open_, "root"), "heads")
        n = heads.count()
        if not n:
            return star
        if salt and n > FEWER * before:
            break
        salt, before = salt + 1, n
        star = components(_edges(star).union(compare(_dealt(heads, most, salt))))
    state = state.join(heads.select("root").distinct(), "root", "left_semi")
    return components(_edges(star).union(compare(_remaining(materialize(state, "open"), most))))


def _edges(star: DataFrame) -> DataFrame:
    return star.select(F.col("node").alias("a"), F.col("root").alias("b"))


def _tasks(work: DataFrame, rows: int) -> DataFrame:
    return work.withColumn("task", F.pmod(F.xxhash64("root", "left", "right"), F.lit(max(8, -(-rows // TASK_ROWS)))).cast("int"))


def _comparisons(t: pa.Table) -> tuple[pa.Table, list[tuple[int, int, int | None]]]:
    """The task's rows by comparison, and of each the ends and where its right block begins (None: one block)."""
    names = ("root", "left", "right", "part", "member")
    order = sorted(range(t.num_rows), key=list(zip(*(t.column(c).to_pylist() for c in names), strict=True)).__getitem__)
    t = t.take(pa.array(order, pa.int64()))
    of, part = list(zip(*(t.column(c).to_pylist() for c in names[:3]), strict=True)), t.column("part").to_pylist()
    out, at = [], 0
    while at < len(of):
        end = at
        while end < len(of) and of[end] == of[at]:
            end += 1
        _, left, right = of[at]
        out.append((at, end, None if left == right else sum(p == left for p in part[at:end])))
        at = end
    return t, out


def near_duplicates(docs: DataFrame, size: int = 3, percent: int = 85) -> DataFrame:
    """Groups of documents linked by a Jaccard similarity of at least percent / 100 of their word shingles.

    docs: doc_id (an integer), text. Texts are lower-cased (A-Z); a shingle is `size` consecutive words, the whole text if it has fewer.
    Returns a row for each row of docs: doc_id, n_shingles, component_id (the smallest doc_id that links reach) and kept
    (doc_id = component_id). Texts that are null, empty or without words have no shingles and are linked with nothing; a null doc_id is not
    linked either and is kept. Rows that share an id each have the component of their own text, and all are kept if it is theirs.

    Equal sets are brought together first by a fingerprint; one document stands for each. Keys, sketches and signatures are shuffled, not
    texts; only texts of clusters with more than one set are. Keys of over KEY_BLOCK sets and clusters of over BLOCK are dealt in blocks.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    bound = sketch_bound(percent / 100)

    def sign(batches):
        for b in slices(batches):
            texts = encoded(b.column(1).to_pylist())
            n, fp, mk, keys = [], [], [], []
            for lo, hi in passes(texts):
                h, edges = shingles(Words(texts[lo:hi], lower=True), size)
                count = np.diff(edges)
                some = count > 0
                m = minima(h, edges) if len(h) else np.zeros((0, SKETCH), np.uint32)
                s, k = marks(m), signature_keys(m).astype(np.int64)
                at = np.cumsum(some) - 1
                n += count.tolist()
                for i in range(hi - lo):
                    j = at[i]
                    fp.append(hashlib.blake2b(h[edges[i] : edges[i + 1]].tobytes(), digest_size=20).digest() if some[i] else None)
                    mk.append(s[j].tobytes() if some[i] else None)
                    keys.append(k[j] if some[i] else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(fp, pa.binary()), pa.array(mk, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "n_shingles", "fp", "marks", "keys"])

    base = docs.select("doc_id", "text")
    signed = materialize(base.mapInArrow(sign, f"doc_id {kind}, n_shingles long, fp binary, marks binary, keys array<long>"), "signatures")
    # One document for each set: the smallest id.
    known = signed.filter("fp IS NOT NULL AND doc_id IS NOT NULL")
    first = F.min_by(F.struct("doc_id", "marks", "keys"), "doc_id").alias("f")
    firsts = known.groupBy("fp").agg(first).select("fp", F.col("f.doc_id").cast("long").alias("rep"), "f.marks", "f.keys")
    # Written first: a join with a finished table may split a set that very many documents have.
    firsts = materialize(firsts, "firsts")
    reps = materialize(known.select("doc_id", "fp").join(firsts.select("fp", "rep"), "fp").select(F.col("doc_id").cast("long").alias("doc_id"), "fp", "rep"), "sets")

    def meet(batches):
        key, ids, mk = [], [], []
        for b in batches:
            key.append(b.column(0).to_numpy())
            ids.append(b.column(1).to_numpy())
            mk.append(np.frombuffer(b"".join(b.column(2).to_pylist()), "<u8").reshape(len(b), -1))
        if not key:
            return
        key, ids, mk = np.concatenate(key), np.concatenate(ids), np.concatenate(mk)
        order = np.lexsort((ids, key))
        key, ids, mk = key[order], ids[order], mk[order]
        new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        count = np.diff(np.append(new, len(key)))
        two = new[count == 2]
        close = near(mk[two], mk[two + 1], bound)
        found = [np.stack([ids[two[close]], ids[two[close] + 1]], 1)]
        for at, c in zip(new[count > 2].tolist(), count[count > 2].tolist(), strict=True):
            pairs = np.array(forest(mk[at : at + c], bound), np.int64).reshape(-1, 2)
            found.append(ids[at + pairs])
        pairs = np.unique(np.sort(np.concatenate(found), 1), axis=0)
        pairs = pairs[pairs[:, 0] != pairs[:, 1]]
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    def meet_blocks(t: pa.Table) -> pa.Table:
        t, ranges = _comparisons(t)
        member = t.column("member").to_numpy()
        mk = np.frombuffer(b"".join(t.column("marks").to_pylist()), "<u8").reshape(t.num_rows, -1)
        pairs = np.array([(lo + p, lo + q) for lo, hi, _ in ranges for p, q in forest(mk[lo:hi], bound)], np.int64).reshape(-1, 2)
        return pa.table([pa.array(member[pairs[:, 0]]), pa.array(member[pairs[:, 1]])], names=["a", "b"])

    def compare_marks(work: DataFrame) -> DataFrame:
        work = materialize(work, "marked")
        rows = work.count()
        marked = firsts.select(F.col("rep").alias("member"), "marks").join(small_side(work, rows), "member")
        return _tasks(marked, rows // 8).groupBy("task").applyInArrow(meet_blocks, "a long, b long")

    keyed = firsts.select(F.explode("keys").alias("key"), F.col("rep").alias("doc_id"), "marks")
    hot = materialize(keyed.groupBy("key").agg(F.count("*").alias("k")).filter(F.col("k") > KEY_BLOCK), "hot_keys")
    hots = hot.count()
    if hots:
        keyed = keyed.join(small_side(hot, hots), "key", "left")
        block = F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("k") / KEY_BLOCK))
        dealt = keyed.withColumn("key", F.when(F.col("k").isNull(), F.col("key")).otherwise(F.xxhash64("key", block))).select("key", "doc_id", "marks")
        candidates = dealt.repartition("key").mapInArrow(meet, "a long, b long")
        large = materialize(keyed.filter("k IS NOT NULL").select(F.col("doc_id").alias("member"), F.col("key").alias("root")), "in_hot_keys")
        clusters = across(large, candidates, compare_marks, KEY_BLOCK)
    else:
        clusters = components(keyed.repartition("key").mapInArrow(meet, "a long, b long"))
    sizes = clusters.groupBy("root").agg(F.count("*").alias("k"))
    members = materialize(clusters.join(sizes, "root").select(F.col("node").alias("member"), "root", F.col("node").alias("comp"), "k"), "members")
    texts = base.filter("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long").alias("member"), "text")

    def confirm(t: pa.Table) -> pa.Table:
        t, ranges = _comparisons(t)
        member, comp = t.column("member").to_pylist(), t.column("comp").to_pylist()
        texts = encoded(t.column("text").to_pylist())
        sets: list[np.ndarray] = []
        for lo, hi in passes(texts):
            h, edges = shingles(Words(texts[lo:hi], lower=True), size)
            sets += [h[edges[i] : edges[i + 1]] for i in range(hi - lo)]
        pairs = [(lo + i, lo + j) for lo, hi, half in ranges for i, j in link_all(sets[lo:hi], percent, half, comp[lo:hi])[1]]
        return pa.table([pa.array([member[i] for i, _ in pairs], pa.int64()), pa.array([member[j] for _, j in pairs], pa.int64())], names=["a", "b"])

    def compare_sets(work: DataFrame, texts: DataFrame = texts) -> DataFrame:
        work = materialize(work, "compared")
        rows = work.count()
        return _tasks(texts.join(small_side(work, rows), "member"), rows).groupBy("task").applyInArrow(confirm, "a long, b long")

    links = compare_sets(_dealt(members, BLOCK, 0))
    large = materialize(members.filter(F.col("k") > BLOCK).select("member", "root"), "large")
    linked = across(large, links, compare_sets, BLOCK) if large.count() else components(links)
    ids = reps.join(linked.withColumnRenamed("node", "rep"), "rep", "left").select(F.col("doc_id").alias("of"), F.col("fp").alias("of_fp"), F.coalesce("root", "rep").alias("component_id")).distinct()
    out = signed.join(ids, (F.col("doc_id") == F.col("of")) & (F.col("fp") == F.col("of_fp")), "left")
    component = F.coalesce("component_id", F.col("doc_id").cast("long"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
