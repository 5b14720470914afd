"""A Merkle manifest of a dataset: one tree a group over its rows in order, one tree over the groups' roots, a proof for every row.

1. Leaves are hashed by DataFrame functions; from here on rows are ids and digests, no texts.
2. Leaves are sorted by ranges of (group, order) and numbered within their partition. The counts of each (partition, group), summed
   over the partitions before, are offsets: they give every leaf its place in its group.
3. Each partition builds what is complete within it: every aligned run of `fanout` nodes whose members it all holds becomes a node, level
   by level. The nodes of its ragged ends, a run or two on each level, are shuffled by coordinate (group, level, run).
4. Upper levels are finished from these, one small job a level; the same is done over the groups' roots.
5. Siblings are handed down from the root to the ragged nodes, a join a level, and each partition completes the proofs of its leaves.

Hashes: lowercase hexadecimal sha256, digests concatenated as text. A group that holds a large part of all rows spans many partitions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import reduce
from operator import add

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from .scratch import materialize

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 16
#: Leaves of a range partition, on average; it is handled at once.
PART_ROWS = 1 << 14

PATH = "array<struct<at:int,others:string>>"
_ARROW_PATH = pa.list_(pa.struct([("at", pa.int32()), ("others", pa.string())]))
_HEX = 64

Path = list[tuple[int, str]]
Levels = list[tuple[int, list[str], int]]


def field(value: Column) -> Column:
    """A value as it goes into a leaf: `-` if null, else its length in UTF-8 bytes, `:`, itself."""
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def fold(digest: str, path: Path) -> str:
    """The root that a leaf's digest gives with its siblings: of each run the leaf's place and the others' digests, joined."""
    for at, others in path:
        digest = _sha(others[: _HEX * at] + digest + others[_HEX * at :])
    return digest


def proof_digest(path: Path) -> str:
    return _sha("".join(others for _, others in path))


def local_levels(digests: list[str], start: int, n: int, fanout: int) -> Levels:
    """What a partition can build over digests, the leaves from `start` on of a group of n: for each level the index of
    the first node, the nodes, and how many nodes the whole level has. A run is complete if all its nodes are there; the last may have fewer."""
    levels = [(start, digests, n)]
    while n > 1:
        end = start + len(digests)
        above = -(-n // fanout)
        low, high = -(-start // fanout), above if end == n else end // fanout
        if low >= high:
            break
        digests = [_sha("".join(digests[k * fanout - start : (k + 1) * fanout - start])) for k in range(low, high)]
        start, n = low, above
        levels.append((start, digests, n))
    return levels


def _ragged(levels: Levels, fanout: int):
    """Level, index and digest of the nodes whose run is not complete here, and of the top if it is here."""
    for level, (start, digests, n) in enumerate(levels):
        low, high = start, start
        if level + 1 < len(levels):
            above, nodes, _ = levels[level + 1]
            low, high = above * fanout, (above + len(nodes)) * fanout
        for k, d in enumerate(digests, start):
            if not low <= k < high:
                yield level, k, d


def _height(n: Column, fanout: int) -> Column:
    """Levels above the leaves of a tree of n leaves."""
    powers = [fanout**k for k in range(63) if fanout**k < 1 << 62]
    return reduce(add, (F.when(n > p, 1).otherwise(0) for p in powers))


def _groups(mine: pa.Table) -> dict[str, tuple[int, int]]:
    """Of a partition's leaves in order the first and the end of each group."""
    out: dict[str, tuple[int, int]] = {}
    for i, group in enumerate(mine.column("group").to_pylist()):
        out[group] = out.get(group, (i,))[0], i + 1
    return out


def _in_order(mine: pa.Table) -> pa.Table:
    return mine.take(pc.sort_indices(mine, [("_at", "ascending")]))


def _numbered(leaves: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
    """The leaves sorted by ranges, with part and _at (their order), and the segments: part, group, start (the place of the part's
    first leaf of that group), n (leaves of the group)."""
    by = ["group", "key", "digest", "tie"]
    ranged = leaves.repartitionByRange(max(1, -(-rows // PART_ROWS)), *by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
    # Written: a task that is run again must not deal by other ranges.
    placed = materialize(ranged.drop("tie").withColumn("part", F.shiftright("_at", 33)), "leaves")
    whole = Window.partitionBy("group")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # A row a partition and group meets in these windows, not a row a leaf.
    counts = placed.groupBy("part", "group").agg(F.count("*").alias("c"))
    return placed, materialize(counts.select("part", "group", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("start"), F.sum("c").over(whole).alias("n")), "segments")


def _local(placed: DataFrame, segments: DataFrame, fanout: int) -> DataFrame:
    """The nodes that partitions cannot put into a run by themselves, and the tops of groups that they could finish."""

    def build(mine: pa.Table, notes: pa.Table) -> pa.Table:
        mine, out = _in_order(mine), []
        digests, own = mine.column("digest").to_pylist(), _groups(mine)
        for s in notes.to_pylist():
            lo, hi = own[s["group"]]
            levels = local_levels(digests[lo:hi], s["start"], s["n"], fanout)
            out += [s | {"level": level, "index": k, "digest": d} for level, k, d in _ragged(levels, fanout)]
        return pa.Table.from_pylist(out, pa.schema([("group", pa.string()), ("n", pa.int64()), ("level", pa.int32()), ("index", pa.int64()), ("digest", pa.string()), ("part", pa.int64())]))

    pairs = placed.select("part", "_at", "group", "digest").groupBy("part").cogroup(segments.groupBy("part"))
    nodes = pairs.applyInArrow(build, "group string, n long, level int, index long, digest string, part long")
    return materialize(nodes.withColumn("height", _height(F.col("n"), fanout)), "nodes")


def _tree(leaves: DataFrame, rows: int, fanout: int, crown: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """The leaves (group, key, digest, altered, tie) placed, and what their partitions need for the proofs: a row for each segment
    (level null) and for each node they have sent, with its path. crown gives group, path and root for the tops (group, digest)."""
    placed, segments = _numbered(leaves, rows)
    local = _local(placed, segments, fanout)
    height = segments.agg(F.max(_height(F.col("n"), fanout))).first()[0] or 0
    tops, runs = [local.filter("level = height")], []
    for level in range(height):
        # At most `fanout` nodes meet in a run.
        members = F.sort_array(F.collect_list(F.struct("index", "digest", "part"))).alias("members")
        lower = local if level == 0 else local.unionByName(risen)
        lower = lower.filter((F.col("level") == level) & (F.col("level") < F.col("height")))
        run = lower.groupBy("group", "n", "height", F.floor(F.col("index") / fanout).alias("run")).agg(members)
        run = materialize(run.withColumn("digest", F.sha2(F.array_join("members.digest", ""), 256)), "runs")
        risen = run.select("group", "n", F.lit(level + 1).alias("level"), F.col("run").alias("index"), "digest", F.lit(None).cast("long").alias("part"), "height")
        runs.append(run)
        tops.append(risen.filter("level = height"))
    top = materialize(reduce(DataFrame.unionByName, tops).select("group", "digest", "level", "index", "part"), "tops")
    crowned = materialize(top.join(crown(top.select("group", "digest")), "group"), "crowned")
    sent = [crowned.filter("part IS NOT NULL").select("part", "group", "level", "index", "path")]
    for level in reversed(range(height)):
        above = crowned.select("group", "level", "index", "path")
        above = above if level == height - 1 else above.unionByName(down.drop("part"))
        above = above.filter(F.col("level") == level + 1).select("group", F.col("index").alias("run"), "path")
        one = runs[level].join(above, ["group", "run"]).select("group", "path", "members", F.posexplode("members").alias("at", "member"))
        others = F.array_join(F.filter("members", lambda m: m["index"] != F.col("member")["index"])["digest"], "")
        path = F.concat(F.array(F.struct("at", others.alias("others"))).cast(PATH), "path")
        down = materialize(one.select("group", F.lit(level).alias("level"), F.col("member.index").alias("index"), F.col("member.part").alias("part"), path.alias("path")), "paths")
        sent.append(down.filter("part IS NOT NULL"))
    ends = segments.join(crowned.select("group", F.col("digest").alias("subroot"), "root"), "group")
    return placed, reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sent, ends)


def _paths(levels: Levels, known: dict[tuple[int, int], Path], fanout: int):
    """Of each leaf its first siblings and the path from its run, which leaves of one run share, or an empty first step's place and the
    whole path if the leaf itself was sent."""
    above = {}
    for level in reversed(range(len(levels))):
        start, digests, n = levels[level]
        mine = {}
        for k, _ in enumerate(digests, start):
            if (level, k) in known:
                mine[k] = None, known[level, k]
                continue
            run = k // fanout
            members = digests[run * fanout - start : min((run + 1) * fanout, n) - start]
            at = k - run * fanout
            first, rest = above[run]
            step = at, "".join(members[:at] + members[at + 1 :])
            mine[k] = step, rest if first is None else [first, *rest]
        above = mine
    return above


def _proved(placed: DataFrame, notes: DataFrame, fanout: int, digest: bool) -> DataFrame:
    """key, leaf, subroot, root of all leaves with the proof, or with proof_sha256 and folded_root."""

    def complete(mine: pa.Table, notes: pa.Table) -> pa.Table:
        mine, rows = _in_order(mine), notes.to_pylist()
        known: dict[str, dict] = {}
        for r in rows:
            if r["level"] is not None:
                known.setdefault(r["group"], {})[r["level"], r["index"]] = [(p["at"], p["others"]) for p in r["path"]]
        leaves, altered = mine.column("digest").to_pylist(), mine.column("altered").to_pylist()
        own, ends, proofs = _groups(mine), [None] * len(leaves), [None] * len(leaves)
        for s in (r for r in rows if r["level"] is None):
            lo, hi = own[s["group"]]
            levels = local_levels(leaves[lo:hi], s["start"], s["n"], fanout)
            for k, (first, rest) in _paths(levels, known.get(s["group"], {}), fanout).items():
                path = rest if first is None else [first, *rest]
                i = lo + k - s["start"]
                ends[i] = s["subroot"], s["root"]
                proofs[i] = (proof_digest(path), fold(altered[i] or leaves[i], path)) if digest else path
        out = [mine.column("key"), pa.array(leaves, pa.string()), *(pa.array(c, pa.string()) for c in zip(*ends, strict=True))]
        if digest:
            return pa.table([*out, *(pa.array(c, pa.string()) for c in zip(*proofs, strict=True))], names=["key", "leaf", "subroot", "root", "proof_sha256", "folded_root"])
        return pa.table([*out, pa.array([[{"at": a, "others": o} for a, o in p] for p in proofs], _ARROW_PATH)], names=["key", "leaf", "subroot", "root", "proof"])

    kind = placed.schema["key"].dataType.simpleString()
    last = "proof_sha256 string, folded_root string" if digest else f"proof {PATH}"
    return placed.groupBy("part").cogroup(notes.groupBy("part")).applyInArrow(complete, f"key {kind}, leaf string, subroot string, root string, {last}")


def manifest(docs: DataFrame, group: str = "source", key: str = "doc_id", fields: tuple[str, ...] = FIELDS, fanout: int = FANOUT, altered: Column | None = None, digest: bool = False) -> DataFrame:
    """A row for each row of docs: key, leaf, subroot (of its group), root, and proof: for each level from the leaf to the root the leaf's
    place in its run and the digests of the run's others, joined (`fold` recomputes the root). With digest, instead of proof its
    proof_sha256 and folded_root, recomputed from the leaf of altered where that has one.

    A leaf is the hash of the fields of a row, each `-` if null, else its length in UTF-8 bytes, `:` and its decimal or text form. Leaves of a
    group ascend by key (null first), rows that share a key by their digests; equal rows are leaves of their own, which of them has
    which place is of no consequence. While a level has several nodes, every `fanout` consecutive ones (the last run may have
    fewer) become one. The groups' roots, by group (null first, then by UTF-8 bytes), are hashed up likewise. Without rows there
    is no root and no row. Texts of any length are read once; other columns of docs are left out.

    altered: a Column with another leaf, or null, for docs whose stored rows may differ from those that the tree was made of.
    """
    name = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    other = F.lit(None).cast("string") if altered is None else altered
    leaves = docs.select(name.alias("group"), F.col(key).alias("key"), leaf(*map(F.col, fields)).alias("digest"), other.alias("altered"))
    leaves = materialize(leaves.withColumn("tie", F.monotonically_increasing_id()), "digests")

    def roots(tops: DataFrame) -> DataFrame:
        up = tops.select(F.lit("").alias("group"), F.col("group").alias("key"), "digest", F.lit(None).cast("string").alias("altered"), F.lit(0).cast("long").alias("tie"))
        whole = lambda top: top.select("group", F.array().cast(PATH).alias("path"), F.col("digest").alias("root"))
        proofs = _proved(*_tree(up, tops.count(), fanout, whole), fanout, False)
        return proofs.select(F.col("key").alias("group"), F.col("proof").alias("path"), "root")

    return _proved(*_tree(leaves, leaves.count(), fanout, roots), fanout, digest).withColumnRenamed("key", key)


def tampered(docs: DataFrame) -> DataFrame:
    """The manifest's digests, with leaves of rows whose id's crc32 is divisible by 5 recomputed after the text's A-Z are lower-cased: doc_id,
    leaf, subroot, root, proof_sha256, folded_root, verified (whether the recomputed root is the root)."""
    upper = "".join(map(chr, range(65, 91)))
    text = F.translate("text", upper, upper.lower())
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    other = F.when(hit, leaf(*(text if c == "text" else F.col(c) for c in FIELDS)))
    return manifest(docs, altered=other, digest=True).withColumn("verified", F.col("folded_root") == F.col("root"))
