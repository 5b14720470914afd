"""Repeated passages across documents: sparse suffix trees over words, partitioned by prefixes of variable length.

A passage is a window of `width` consecutive words: a node of depth `width` or more of the suffix tree of all texts. Suffixes are
sampled at anchors: the anchor of a window is its lowest-hashed run of PREFIX words, so equal windows have equal anchors, and
windows that follow each other and share an anchor form a block, whose suffixes hang under one prefix.

1. Anchors are counted. One that a single document has is a leaf; its blocks go no further.
2. Blocks under a shared prefix are dealt by it, with their words. A prefix with more than HEAVY blocks, or very many in one
   task, is too large for one subtree and is lengthened to the whole window, which splits its blocks into windows.
3. Each prefix's subtree is built in memory: suffixes are ranked by prefix doubling over the words themselves, and suffixes of
   one rank at depth `width` hang under one deep node. All leaves of a node but those of its smallest document are repeats;
   neighbouring ones make up the maximal passages that are removed.

Hashes only deal: equality is that of words (of digests of 512 bits where a word is longer than LONG_WORD). Every step first resolves what a task's or a group's own documents decide and sends only
the smallest document of a node on, so a passage that a third of all documents share is a few rows of each task. A block has at most
MOST_WINDOWS windows of words of bounded length, so a subtree of HEAVY blocks is a few megabytes whatever the texts; buckets of anchors and groups of
documents number in proportion to the text, and are settled one at a time. A group is at least one text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from .scratch import materialize
from .words import U, Words, mix, passes, slices

#: Words of an anchor, the shorter prefix.
PREFIX = 6
#: Blocks under one anchor from which on its prefix is lengthened, in all and within one task's share.
HEAVY, HEAVY_IN_TASK = 4096, 256
#: Blocks that a task gathers before it sends what is left of them.
FLUSH_BLOCKS = 1 << 18
#: Bytes of text of a group of documents and of a bucket of anchors, on average.
GROUP_BYTES = 2 << 20
#: Windows of a block at most: where words repeat, neighbouring windows share an anchor on and on.
MOST_WINDOWS = 64
#: Bytes of a word that travel as they are; a longer one is told from others by a digest of 512 bits, which is longer than that.
LONG_WORD = 64
#: Bytes of dealt blocks of a partition of subtrees, on average, and rows that a subtree's task handles at once.
PART_BYTES, CHUNK_ROWS = 32 << 20, 1 << 15

OPEN = np.uint32(1 << 31)
_NONE = np.iinfo(np.int64).max


def blocks(words: Words, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last window start of each block, and its anchor's hash."""
    k = min(PREFIX, width)
    span = width - k + 1
    empty = np.zeros(0, np.int64)
    start = words.starts(width)
    if not len(start):
        return empty, empty, np.zeros(0, U)
    low = words.grams(k)
    step = 1
    while step * 2 <= span:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    if step < span:
        low = np.minimum(low[: len(low) - (span - step)], low[span - step :])
    anchor = low[start]
    first = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)))
    lo = np.flatnonzero(first)
    more = -(-np.diff(np.append(lo, len(start))) // MOST_WINDOWS)
    if (more > 1).any():
        lo = np.repeat(lo, more) + (np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more)) * MOST_WINDOWS
    return start[lo], start[np.append(lo[1:], len(start)) - 1], anchor[lo]


def ordinals(doc: np.ndarray) -> np.ndarray:
    """0, 1, 2 ... within runs of equal values."""
    if not len(doc):
        return doc
    new = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
    return np.arange(len(doc)) - np.repeat(new, np.diff(np.append(new, len(doc))))


def _planes(x: np.ndarray) -> bytes:
    """32-bit values as their low and then their high halves: small values leave runs of zeros to the shuffle's codec."""
    x = x.astype(np.uint32, copy=False)
    return (x & 0xFFFF).astype("<u2").tobytes() + (x >> 16).astype("<u2").tobytes()


def _unplanes(b: bytes) -> np.ndarray:
    h = np.frombuffer(b, "<u2").astype(np.uint32)
    return h[: len(h) // 2] | h[len(h) // 2 :] << np.uint32(16)


def _pack(doc: np.ndarray, ref: np.ndarray, which: np.ndarray, planes: tuple[np.ndarray, ...], wide: np.ndarray | None = None) -> bytes:
    """Rows of documents doc[which], ref[which] with 32-bit columns and perhaps a 64-bit one, as one binary value."""
    own, at = np.unique(which, return_inverse=True)
    parts = [doc[own].astype("<i8").tobytes(), ref[own].astype("<i8").tobytes(), *map(_planes, (at, *planes))]
    parts += [wide.astype("<u8").tobytes()] if wide is not None else []
    return np.array([len(parts), *map(len, parts)], "<u4").tobytes() + b"".join(parts)


def _unpack(b: bytes, planes: int, wide: bool = False) -> tuple[np.ndarray, ...]:
    """doc, ref, the 32-bit columns and the 64-bit one."""
    n = int.from_bytes(b[:4], "little")
    edges = 4 * (n + 1) + np.cumsum(np.concatenate(([0], np.frombuffer(b[4 : 4 * (n + 1)], "<u4"))))
    parts = [b[lo:hi] for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
    which = _unplanes(parts[2])
    out = [np.frombuffer(parts[0], "<i8")[which], np.frombuffer(parts[1], "<i8")[which], *map(_unplanes, parts[3 : 3 + planes])]
    return (*out, np.frombuffer(parts[3 + planes], "<u8")) if wide else tuple(out)


def _deal(bucket: np.ndarray, doc: np.ndarray, ref: np.ndarray, which: np.ndarray, planes: tuple[np.ndarray, ...], wide: np.ndarray | None = None) -> Iterator[tuple[int, bytes]]:
    """(bucket, parcel) of each bucket that has rows."""
    order = np.argsort(bucket, kind="stable")
    b = bucket[order]
    new = np.flatnonzero(np.concatenate(([True], b[1:] != b[:-1]))) if len(b) else np.zeros(0, np.int64)
    for lo, hi in zip(new.tolist(), [*new[1:].tolist(), len(b)], strict=True):
        i = order[lo:hi]
        yield int(b[lo]), _pack(doc, ref, which[i], tuple(p[i] for p in planes), None if wide is None else wide[i])


def _batches(rows: list[tuple[int, bytes]], name: str) -> Iterator[pa.RecordBatch]:
    for lo in range(0, len(rows), 1024):
        part = rows[lo : lo + 1024]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], pa.int32()), pa.array([r[1] for r in part], pa.binary())], [name, "parcel"])


def _texts(column) -> list[bytes]:
    """UTF-8 bytes of a column of strings; null becomes empty."""
    return pc.fill_null(pc.cast(column, pa.binary()), b"").to_pylist()


class _Marks:
    """Marks (doc, ref, place, count) gathered by a task and dealt to the documents' groups."""

    def __init__(self, groups: int):
        self.groups, self.held, self.size = groups, [], 0

    def add(self, doc: np.ndarray, ref: np.ndarray, place: np.ndarray, count: np.ndarray | None = None) -> None:
        if len(doc):
            self.held.append((doc, ref, place.astype(np.uint32), np.zeros(len(doc), np.uint32) if count is None else count.astype(np.uint32)))
            self.size += len(doc)

    def flush(self, least: int = 1) -> Iterator[pa.RecordBatch]:
        if self.size < least:
            return
        doc, ref, place, count = (np.concatenate(x) for x in zip(*self.held, strict=True))
        self.held, self.size = [], 0
        order = np.lexsort((place, ref, doc))
        doc, ref, place, count = doc[order], ref[order], place[order], count[order]
        rows = list(_deal(ref % self.groups, doc, ref, _runs(doc, ref), (place, count)))
        yield from _batches(rows, "grp")


def _runs(doc: np.ndarray, ref: np.ndarray) -> np.ndarray:
    """For sorted rows, the index of the first row of each row's (doc, ref)."""
    new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (ref[1:] != ref[:-1])))
    return np.maximum.accumulate(np.where(new, np.arange(len(doc)), 0))


def _marks_of(table: pa.Table) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
    """Places and counts by (doc, ref)."""
    found = [_unpack(p, 2) for p in table.column("parcel").to_pylist()]
    if not found:
        return {}
    doc, ref, place, count = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((place, ref, doc))
    doc, ref, place, count = doc[order], ref[order], place[order], count[order]
    new = np.unique(_runs(doc, ref)).tolist()
    return {(int(doc[i]), int(ref[i])): (place[i:j], count[i:j]) for i, j in zip(new, [*new[1:], len(doc)], strict=True)}


def _least(key: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """The smallest value of each key 0 .. n - 1."""
    out = np.full(n, _NONE)
    np.minimum.at(out, key, value)
    return out


def rank(tokens: np.ndarray, width: int) -> np.ndarray:
    """Ranks of the runs of `width` tokens by their first ones, by prefix doubling: equal ranks are equal runs, and their order is the
    order of the suffixes as far as width tokens. Runs that cross the end are left out."""
    now, k = tokens, 1
    while k < width:
        step = min(k, width - k)
        pair = now[: len(now) - step] * (np.int64(now.max()) + 1) + now[step:] if len(now) > step else now[:0]
        now = np.unique(pair, return_inverse=True)[1].ravel()
        k += step
    return now


def subtree(doc: np.ndarray, words: list[bytes], group: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Repeats among blocks: (row, window) pairs whose deep node has a leaf in a document with a smaller id.

    words: each block's words, joined by one space; group: its prefix. Equal blocks are one path of the tree."""
    paths: dict[tuple[int, bytes], int] = {}
    path = np.fromiter((paths.setdefault(k, len(paths)) for k in zip(group.tolist(), words, strict=True)), np.int64, len(words))
    least = _least(path, doc, len(paths))
    text = [w.split(b" ") for _, w in paths]
    size = np.fromiter(map(len, text), np.int64, len(text))
    windows = size - width + 1
    of = np.fromiter((g for g, _ in paths), np.int64, len(paths))
    # A prefix with one path: its windows are repeats of that path's smallest document. Others are ranked word by word.
    _, where, count = np.unique(of, return_inverse=True, return_counts=True)
    several = np.flatnonzero(count[where.ravel()] > 1)
    base = np.cumsum(windows) - windows
    lowest = np.repeat(least, windows)
    if len(several):
        known: dict[bytes, int] = {}
        tokens = np.array([known.setdefault(w, len(known)) for i in several.tolist() for w in text[i]], np.int64)
        ranks = rank(tokens, width)
        begin = np.cumsum(size[several]) - size[several]
        n = windows[several]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        node = ranks[np.repeat(begin, n) + step]
        low = _least(node, np.repeat(least[several], n), int(ranks.max()) + 1)
        lowest[np.repeat(base[several], n) + step] = low[node]
    n = windows[path]
    row = np.repeat(np.arange(len(doc)), n)
    window = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    gone = lowest[np.repeat(base[path], n) + window] < doc[row]
    return row[gone], window[gone]


def repeated(docs: DataFrame, width: int = 13, digest: bool = False, groups: int | None = None, heavy: int = HEAVY, heavy_in_task: int = HEAVY_IN_TASK, carry: tuple[str, ...] = ()) -> DataFrame:
    """Words that repeat a passage of an earlier document.

    A word is removed if a window of `width` words over it starts, word for word, in a document with a smaller doc_id too.
    docs: doc_id (an integer; another type is a TypeError), text. Returns a row for each row of docs: doc_id, n_words, n_removed and, with
    digest, kept_sha256 of the kept words joined by one space; else text (as it was if nothing is removed, else the kept words so joined;
    null stays null) and removed, an array of [first word, end) spans. Columns of docs named in `carry` follow.

    Null and empty texts have no words; texts of fewer words than `width` lose none. A null doc_id is no document with a smaller
    id and loses nothing. Rows that share an id do not remove each other's words. An empty table gives no rows. A very long text is
    handled as a whole, with about ten times its size in memory.
    """
    if not isinstance(docs.schema["doc_id"].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        raise TypeError("doc_id must be an integer")
    kind = docs.schema["doc_id"].dataType.simpleString()
    base = docs.select("doc_id", F.col("text").cast("string").alias("text"), *carry)
    if groups is None:
        size = base.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
        groups = max(16, -(-size // GROUP_BYTES))
    ref = F.xxhash64("doc_id", "text")
    dealt = base.select(F.pmod(ref, F.lit(groups)).cast("int").alias("grp"), "doc_id", "text", ref.alias("ref"), *(F.col(c).alias(f"carry_{i}") for i, c in enumerate(carry)))
    # What a text has no place for is settled without words.
    joining = dealt.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())

    def sample(batches):
        """Anchors of all blocks, dealt by anchor; parcels with a negative bucket are marks."""
        held, docs_, refs, size, n = [], [], [], 0, 0

        def flush():
            nonlocal held, docs_, refs, size, n
            anchor, which, place = (np.concatenate(x) for x in zip(*held, strict=True))
            doc, ref = np.concatenate(docs_), np.concatenate(refs)
            held, docs_, refs, size, n = [], [], [], 0, 0
            bucket = (mix(anchor) % U(groups)).astype(np.int64)
            value, where, count = np.unique(anchor, return_inverse=True, return_counts=True)
            many = count > heavy_in_task
            rows = []
            if many.any():
                wide = many[where.ravel()]
                d, r, p = which[wide], ref[which[wide]] % groups, place[wide] | OPEN
                rows += [(-1 - g, parcel) for g, parcel in _deal(r, doc, ref, d, (p, np.zeros(len(p), np.uint32)))]
                anchor, which, place, bucket = anchor[~wide], which[~wide], place[~wide], bucket[~wide]
                # A token of no document lengthens the prefix for the anchor's blocks of other tasks.
                doc, ref = np.append(doc, _NONE), np.append(ref, 0)
                anchor, which = np.append(anchor, value[many]), np.append(which, np.full(many.sum(), len(doc) - 1))
                place, bucket = np.append(place, np.zeros(many.sum(), np.uint32)), np.append(bucket, (mix(value[many]) % U(groups)).astype(np.int64))
            rows += _deal(bucket, doc, ref, which, (place,), anchor)
            yield from _batches(rows, "bucket")

        for b in slices(batches):
            texts = _texts(b.column(1))
            docs_.append(b.column(0).to_numpy(zero_copy_only=False).astype(np.int64))
            refs.append(b.column(2).to_numpy(zero_copy_only=False))
            for lo, hi in passes(texts):
                w = Words(texts[lo:hi])
                start, _, anchor = blocks(w, width)
                d = w.doc[start]
                held.append((anchor, n + lo + d, ordinals(d).astype(np.uint32)))
                size += len(start)
            n += len(texts)
            if size >= FLUSH_BLOCKS:
                yield from flush()
        if size:
            yield from flush()

    def settle(batches):
        """Marks the blocks of anchors that several documents share, one bucket after the other."""
        marks, parcels, now = _Marks(groups), [], None

        def bucket():
            doc, ref, place, anchor = (np.concatenate(x) for x in zip(*parcels, strict=True))
            order = np.argsort(anchor, kind="stable")
            a, d = anchor[order], doc[order]
            new = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1])))
            n = np.diff(np.append(new, len(a)))
            low, high = np.minimum.reduceat(d, new), np.maximum.reduceat(d, new)
            token = high == _NONE
            wide = np.repeat(token | (n > heavy), n)
            chosen = np.repeat(token | (low < high), n) & (d != _NONE)
            i = order[chosen]
            marks.add(doc[i], ref[i], np.where(wide[chosen], place[i] | OPEN, place[i]))

        for b in batches:
            for k, parcel in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if k < 0:
                    marks.add(*_unpack(parcel, 2))
                else:
                    if k != now and parcels:
                        bucket()
                        parcels = []
                    now = k
                    parcels.append(_unpack(parcel, 1, True))
            yield from marks.flush(FLUSH_BLOCKS)
        if parcels:
            bucket()
        yield from marks.flush()

    anchors = joining.select("doc_id", "text", "ref").mapInArrow(sample, "bucket int, parcel binary")
    shared = materialize(anchors.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(settle, "grp int, parcel binary"), "anchors")

    row = "key long, doc long, ref long, place int, count int, words binary"
    kinds = pa.schema([("key", pa.int64()), ("doc", pa.int64()), ("ref", pa.int64()), ("place", pa.int32()), ("count", pa.int32()), ("words", pa.binary())])

    def open_blocks(key, t: pa.Table, m: pa.Table) -> pa.Table:
        """Blocks of one group of documents under shared prefixes, with their words. Of equal ones, only those of the smallest document
        go on; the others are marks at once (rows without words)."""
        chosen = _marks_of(m)
        ids, refs = t.column("doc_id").to_pylist(), t.column("ref").to_pylist()
        at = [i for i, k in enumerate(zip(ids, refs, strict=True)) if k in chosen]
        texts = _texts(t.column("text").take(pa.array(at, pa.int64())))
        keys, doc, ref, place, count, words = [], [], [], [], [], []
        for lo, hi in passes(texts):
            w = Words(texts[lo:hi])
            start, last, anchor = blocks(w, width)
            window = w.grams(width).view(np.int64)
            edges = np.searchsorted(w.doc[start], np.arange(hi - lo + 1)).tolist()
            for i in range(hi - lo):
                d, r = ids[at[lo + i]], refs[at[lo + i]]
                p = chosen[d, r][0]
                own, first = [x if len(x) <= LONG_WORD else b"\0" + hashlib.blake2b(x).hexdigest().encode() for x in texts[lo + i].split()], int(w.first[i])
                wide = p >= OPEN
                block = edges[i] + (p & ~OPEN).astype(np.int64)
                for b, whole in zip(block.tolist(), (~wide).tolist(), strict=True):
                    s, e = int(start[b]) - first, int(last[b]) - first + 1
                    if whole:
                        keys.append(int(anchor[b].view(np.int64)))
                        place.append(s)
                        count.append(e - s)
                        words.append(b" ".join(own[s : e + width - 1]))
                    else:
                        keys += window[first + s : first + e].tolist()
                        place += range(s, e)
                        count += [1] * (e - s)
                        words += [b" ".join(own[k : k + width]) for k in range(s, e)]
                grown = len(keys) - len(doc)
                doc += [d] * grown
                ref += [r] * grown
        least: dict[tuple[int, bytes], int] = {}
        for k, d in zip(zip(keys, words, strict=True), doc, strict=True):
            if least.setdefault(k, d) > d:
                least[k] = d
        for i, k in enumerate(zip(keys, words, strict=True)):
            if doc[i] > least[k]:
                keys[i], words[i] = ref[i], None
        return pa.table([keys, doc, ref, place, count, words], schema=kinds)

    texts = dealt.select("grp", "doc_id", "text", "ref", *(c for c in dealt.columns if c.startswith("carry_")))
    opened = texts.groupBy("grp").cogroup(shared.groupBy("grp")).applyInArrow(open_blocks, row)

    def trees(batches):
        """Subtrees of the prefixes, which arrive in order; a prefix's rows come smallest document first."""
        marks, held, size = _Marks(groups), [], 0
        carried: dict[tuple[int, bytes], int] = {}

        def build(t: pa.Table, rest: bool) -> pa.Table:
            """Settles all of t but its last prefix, unless no more comes or all of t is one; returns what is left."""
            nonlocal carried
            keys = t.column("key").to_numpy()
            cut = len(keys) if rest else int(np.searchsorted(keys, keys[-1]))
            whole_window = bool(cut == 0 and pc.all(pc.equal(t.column("count"), 1)).as_py())
            if whole_window:
                cut = len(keys)
            left = t.slice(cut)
            t = t.slice(0, cut)
            single = pc.is_null(t.column("words"))
            done, t = t.filter(single), t.filter(pc.invert(single))
            column = lambda t, c: t.column(c).to_numpy()
            marks.add(*(column(done, c) for c in ("doc", "ref", "place", "count")))
            if t.num_rows:
                key, doc, ref, place = (column(t, c) for c in ("key", "doc", "ref", "place"))
                words = t.column("words").to_pylist()
                more = [(k, w, d) for (k, w), d in carried.items()]
                doc_ = np.concatenate([doc, np.array([d for *_, d in more], np.int64)])
                rows, window = subtree(doc_, words + [w for _, w, _ in more], np.concatenate([key, np.array([k for k, *_ in more], np.int64)]), width)
                real = rows < len(doc)
                rows, window = rows[real], window[real]
                marks.add(doc[rows], ref[rows], place[rows] + window, np.ones(len(rows), np.uint32))
                new: dict[tuple[int, bytes], int] = {}
                if whole_window:
                    for k, w, d in [*more, *zip(key.tolist(), words, doc.tolist(), strict=True)]:
                        if k == key[-1]:
                            new[k, w] = min(d, new.get((k, w), d))
                carried = new
            return left

        for b in batches:
            held.append(b)
            size += b.num_rows
            if size >= CHUNK_ROWS:
                left = build(pa.Table.from_batches(held).combine_chunks(), False)
                held, size = left.to_batches(), left.num_rows
                yield from marks.flush(FLUSH_BLOCKS)
        if size:
            build(pa.Table.from_batches(held).combine_chunks(), True)
        yield from marks.flush()

    n_blocks = shared.agg(F.sum(F.octet_length("parcel"))).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n_blocks * 20 // PART_BYTES))
    nodes = opened.repartition(parts, "key").sortWithinPartitions("key", "doc").mapInArrow(trees, "grp int, parcel binary")

    def take(key, t: pa.Table, m: pa.Table) -> pa.Table:
        marks = _marks_of(m)
        ids, raw, refs = t.column("doc_id").to_pylist(), t.column("text"), t.column("ref").to_pylist()
        texts = _texts(raw)
        n_words, n_removed, kept, spans = [], [], [], []
        for i, x in enumerate(texts):
            words = x.split()
            n = len(words)
            gone = np.zeros(n + 1, np.int32)
            if (found := marks.get((ids[i], refs[i]))) is not None:
                place, count = found[0].astype(np.int64), found[1].astype(np.int64)
                np.add.at(gone, place, 1)
                np.add.at(gone, place + count + width - 1, -1)
            drop = np.cumsum(gone)[:-1] > 0
            lost = int(drop.sum())
            n_words.append(n)
            n_removed.append(lost)
            if lost:
                words = [x for x, g in zip(words, drop.tolist(), strict=True) if not g]
            kept.append(hashlib.sha256(b" ".join(words)).hexdigest().encode() if digest else b" ".join(words) if lost else x)
            if not digest:
                edge = np.flatnonzero(np.diff(np.concatenate(([0], drop.astype(np.int8), [0]))))
                spans.append(edge.reshape(-1, 2).tolist())
        out = pa.array(kept, pa.binary()).cast(pa.string())
        if not digest:
            out = pc.if_else(pc.is_null(raw.combine_chunks()), pa.scalar(None, pa.string()), out)
        columns = [t.column("doc_id").combine_chunks(), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), out]
        names = ["doc_id", "n_words", "n_removed", "kept_sha256" if digest else "text"]
        if not digest:
            columns.append(pa.array(spans, pa.list_(pa.list_(pa.int64()))))
            names.append("removed")
        columns += [t.column(f"carry_{i}") for i in range(len(carry))]
        names += [f"carry_{i}" for i in range(len(carry))]
        return pa.table(columns, names=names)

    own = f"doc_id {kind}, n_words long, n_removed long, " + ("kept_sha256 string" if digest else "text string, removed array<array<long>>")
    result = T.StructType([*T.StructType.fromDDL(own).fields, *(T.StructField(f"carry_{i}", base.schema[c].dataType) for i, c in enumerate(carry))])
    done = texts.groupBy("grp").cogroup(nodes.groupBy("grp")).applyInArrow(take, result)
    names = [c for c in done.columns if not c.startswith("carry_")]
    return done.select(*names, *(F.col(f"carry_{i}").alias(c) for i, c in enumerate(carry)))
