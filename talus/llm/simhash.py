"""SimHash near duplicates: 64-bit fingerprints, deletion variants of segments as keys, links verified on whole fingerprints.

Fingerprints within `errors` bits are cut into errors // 2 + 1 segments, the fewest of which one must differ by at most one bit.
For every bit of a segment there is a variant with that bit left out, and segments that differ by at most one bit share a variant. So
every pair to be linked meets under a key (bit left out, other bits of its segment): three segments and 64 keys for 4 errors.

Distinct fingerprints are compared, not documents. A key that more than KEY_BLOCK of them have is cut further: of the bits outside
its segment, dealt into errors + 1 slices, one slice is equal in a pair, so its members meet again under (key, slice). What is
still larger, as the near copies of one text, goes in blocks, then by the first fingerprints of what these connect (`neardup.across`).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .graph import components
from .neardup import _comparisons, _tasks, across
from .scratch import materialize, small_side
from .words import encoded, passes, slices

BITS = 64
#: Distinct fingerprints under one key that are compared at once.
KEY_BLOCK = 4096
#: Shingles whose bits are counted at once.
CHUNK = 1 << 16

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def fingerprints(texts: list[bytes], size: int) -> np.ndarray:
    """The fingerprint of every text: a bit is set if over half of the hashes of its shingles, repeats included, have it."""
    b = np.frombuffer(b"\n".join([b"", *texts, b""]).lower(), np.uint8)
    space = _SPACE[b]
    begin = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    edge = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    first = np.concatenate(([0], np.searchsorted(begin, edge)))
    # Every word with one space behind it.
    kept = ~space
    kept[1:] |= ~space[:-1]
    words = np.where(space, np.uint8(32), b)[kept].tobytes()
    end = np.flatnonzero(np.frombuffer(words, np.uint8) == 32)
    start = np.concatenate(([0], end[:-1] + 1))
    count = np.diff(first)
    runs = np.where(count > 0, np.maximum(count - size + 1, 1), 0)
    doc = np.repeat(np.arange(len(texts)), runs)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(runs) - runs, runs) + first[doc]
    last = np.minimum(at + size, first[doc + 1]) - 1
    ones = np.zeros((len(texts), BITS), np.int64)
    hashed = xxhash.xxh64_intdigest
    for lo in range(0, len(doc), CHUNK):
        of = doc[lo : lo + CHUNK]
        ends = zip(start[at[lo : lo + CHUNK]].tolist(), end[last[lo : lo + CHUNK]].tolist(), strict=True)
        h = np.fromiter((hashed(words[s:e], 42) for s, e in ends), "<u8", len(of))
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        new = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
        ones[of[new]] += np.add.reduceat(bits, new, axis=0, dtype=np.int32)
    set_ = (2 * ones > runs[:, None]).astype(np.uint8)
    return np.packbits(set_, axis=1, bitorder="little").reshape(-1).view("<u8")


def borders(errors: int) -> list[int]:
    """Bits at which segments begin, and the end: the fewest segments of which one has at most one error."""
    if not 2 <= errors <= 15:
        raise ValueError("errors must be 2 to 15")
    k = errors // 2 + 1
    return [BITS * i // k for i in range(k + 1)]


def _bits(value: Column, lo: int, hi: int) -> Column:
    return F.shiftrightunsigned(value, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1).cast("long"))


def variants(fp: Column, errors: int) -> Column:
    """The keys of a fingerprint: for every bit its place, then the bits of its segment without it."""
    edge, keys = borders(errors), []
    for lo, hi in zip(edge, edge[1:], strict=False):
        for bit in range(lo, hi):
            rest = _bits(fp, lo, hi).bitwiseAND(F.lit(~(1 << (bit - lo))).cast("long"))
            keys.append(rest.bitwiseOR(F.lit(bit << 32).cast("long")))
    return F.array(*keys)


def finer(key: Column, fp: Column, errors: int) -> Column:
    """Longer keys for one that is shared by too many: with each slice of the bits outside the key's segment."""
    edge, out = borders(errors), None
    for lo, hi in zip(edge, edge[1:], strict=False):
        outside, width = _bits(fp, 0, lo), BITS - (hi - lo)
        if hi < BITS:
            outside = outside.bitwiseOR(F.shiftleft(_bits(fp, hi, BITS), lo))
        cut = [width * i // (errors + 1) for i in range(errors + 2)]
        keys = F.array(*(F.xxhash64(key, F.lit(i), _bits(outside, a, b)) for i, (a, b) in enumerate(zip(cut, cut[1:], strict=False))))
        inside = F.shiftright(key, 32).between(lo, hi - 1)
        out = F.when(inside, keys) if out is None else out.when(inside, keys)
    return out


def group_links(ends: np.ndarray, fp: np.ndarray, errors: int, begin: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links between rows within `errors` bits of each other that connect all such rows of a group; few of those that close a circle.
    ends: for each row the end of its group, whose rows stand together; begin: of each row the first row that it is compared with, if
    not the next."""
    root, rows, left, right = np.arange(len(fp)), np.arange(len(fp)), [], []
    other = rows + 1 if begin is None else begin
    while True:
        there = other < ends[rows]
        rows, other = rows[there], other[there]
        if not len(rows):
            break
        close = np.bitwise_count(fp[rows] ^ fp[other]) <= errors
        a, b = rows[close], other[close]
        x, y = root[a], root[b]
        fresh = x != y
        if fresh.any():
            left.append(a[fresh])
            right.append(b[fresh])
            np.minimum.at(root, np.maximum(x, y)[fresh], np.minimum(x, y)[fresh])
            while (root[root] != root).any():
                root = root[root]
        other = other + 1
    none = np.zeros(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def near_fingerprints(fps: DataFrame, errors: int = 4) -> DataFrame:
    """node, root of the connected distinct fingerprints (column fingerprint, a long) of which some other is within `errors` bits:
    root is the smallest of the component, as a signed integer."""

    def links(fp: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[pa.Array]:
        return [pa.array(fp[a].view(np.int64)), pa.array(fp[b].view(np.int64))]

    def meet(batches):
        """Rows come sorted by key; what follows the last change of key waits for the next batch."""
        key, fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for b in batches:
            key, fp = np.concatenate([key, b.column(0).to_numpy()]), np.concatenate([fp, b.column(1).to_numpy().view(np.uint64)])
            new = np.flatnonzero(key[1:] != key[:-1]) + 1
            if not len(new):
                continue
            cut = new[-1]
            ends = np.repeat(new, np.diff(np.concatenate(([0], new))))
            yield pa.RecordBatch.from_arrays(links(fp, *group_links(ends, fp[:cut], errors)), ["a", "b"])
            key, fp = key[cut:], fp[cut:]
        if len(key):
            yield pa.RecordBatch.from_arrays(links(fp, *group_links(np.full(len(fp), len(fp)), fp, errors)), ["a", "b"])

    def meet_blocks(t: pa.Table) -> pa.Table:
        t, ranges = _comparisons(t)
        fp, out = t.column("member").to_numpy().view(np.uint64), [[np.zeros(0, np.int64)] * 2]
        for lo, hi, half in ranges:
            part = fp[lo:hi]
            n = len(part)
            mine = n if half is None else half
            ends = np.concatenate([np.full(mine, n), np.zeros(n - mine, np.int64)])
            a, b = group_links(ends, part, errors, None if half is None else np.full(n, half))
            out.append([lo + a, lo + b])
        a, b = (np.concatenate(x) for x in zip(*out, strict=True))
        return pa.table(links(fp, a, b), names=["a", "b"])

    def compare(work: DataFrame) -> DataFrame:
        work = materialize(work, "compared")
        return _tasks(work, work.count()).groupBy("task").applyInArrow(meet_blocks, "a long, b long")

    def too_many(keyed: DataFrame) -> tuple[DataFrame, int]:
        hot = materialize(keyed.groupBy("key").agg(F.count("*").alias("k")).filter(F.col("k") > KEY_BLOCK).select("key"), "hot_keys")
        return hot, hot.count()

    keyed = fps.select(F.explode(variants(F.col("fingerprint"), errors)).alias("key"), "fingerprint")
    hot, n = too_many(keyed)
    large = None
    if n:
        cold = keyed.join(small_side(hot, n), "key", "left_anti")
        again = keyed.join(small_side(hot, n), "key").select(F.explode(finer(F.col("key"), F.col("fingerprint"), errors)).alias("key"), "fingerprint")
        again = materialize(again, "finer_keys")
        hot, n = too_many(again)
        if n:
            large = materialize(again.join(small_side(hot, n), "key").select(F.col("fingerprint").alias("member"), F.col("key").alias("root")), "in_hot_keys")
            again = again.join(small_side(hot, n), "key", "left_anti")
        keyed = cold.union(again)
    found = keyed.repartition("key").sortWithinPartitions("key").mapInArrow(meet, "a long, b long")
    if large is None:
        return components(found)
    size = large.groupBy("root").agg(F.count("*").alias("k"))
    block = F.pmod(F.xxhash64("member"), F.ceil(F.col("k") / KEY_BLOCK)).cast("string")
    dealt = large.join(size, "root").select("member", "root", F.col("member").alias("comp"), *(block.alias(c) for c in ("part", "left", "right")))
    return across(large, found.union(compare(dealt)), compare, KEY_BLOCK)


def simhash_groups(docs: DataFrame, size: int = 4, errors: int = 4) -> DataFrame:
    """Groups of documents linked by fingerprints that differ in at most `errors` (2 to 15) of 64 bits.

    docs: doc_id (any type with an order), text. Texts are lower-cased (A-Z); a shingle is `size` consecutive words joined by one space, the whole
    sequence if it has fewer. A bit of the fingerprint is set if over half of the XXH64 values (UTF-8, seed 42) of the shingles,
    repeats included, have it. Returns a row for each row of docs: doc_id, fingerprint (16 hexadecimal digits) and component_id,
    the smallest doc_id that links reach. A text that is null, empty or without words has fingerprint zero and is linked like any other.
    A row with a null doc_id is linked too, but gives its component no id; component_id is null if no row there has one. Rows
    that share an id each have their own text's group. Other columns are left out.

    Fingerprints with the smallest id of each are a table; keys and links are made of distinct fingerprints, so copies cost nothing more.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def sign(batches):
        for b in slices(batches):
            texts = encoded(b.column(1).to_pylist())
            fp = [fingerprints(texts[lo:hi], size) for lo, hi in passes(texts)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.concatenate([np.zeros(0, np.uint64), *fp]).view(np.int64))], ["doc_id", "fingerprint"])

    signed = materialize(docs.select("doc_id", "text").mapInArrow(sign, f"doc_id {kind}, fingerprint long"), "fingerprints")
    firsts = materialize(signed.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "firsts")
    star = near_fingerprints(firsts, errors).withColumnRenamed("node", "fingerprint")
    rooted = firsts.join(star, "fingerprint", "left").select("fingerprint", F.coalesce("root", "fingerprint").alias("root"), "first")
    # Written first: a join with a finished table may split a root or a fingerprint that very many rows have.
    rooted = materialize(rooted, "rooted")
    ids = materialize(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "ids")
    named = materialize(rooted.join(ids, "root").select("fingerprint", "component_id"), "named")
    return signed.join(named, "fingerprint").select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
