"""Mixture-controlled packing: deficit round-robin over source queues, in closed form.

A source's queue holds its documents' ids, cut into packets. In every round a source is credited
quantum = window * target share; a packet is served in the first round whose credit covers the queue up
to the packet's end, and what is left of the credit is carried on. A packet that ends at position e of
its queue is therefore served in round ceil(e / quantum), whatever came before: rounds need no sequential
state, and deficits carry across windows and partitions because e counts from the queue's beginning over all
partitions. Sequences are filled in the order of rounds; blocks of rounds are filled independently.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .bpe import Encoder
from .scratch import materialize, small_side

#: Blocks of rounds that a task fills one after the other, on average.
BLOCKS = 8

PIECE = "doc_id {kind}, source string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def queue_documents(docs: DataFrame, path: str, end_id: int = 0) -> DataFrame:
    """Ids of each document and its place in its source's queue.

    Returns part, doc_id, source, start, n, ids, written to the shared folder: part is the task that wrote the row,
    start the source's ids that the task had queued before. A null text gives the end id alone.
    """

    def run(batches):
        encoder, part = Encoder(path), TaskContext.get().partitionId()
        end, queued = np.array([end_id], encoder.dtype).tobytes(), {}
        for b in batches:
            ids = [encoder.encode(t or "") + end for t in b.column(2).to_pylist()]
            n = [len(x) // encoder.width for x in ids]
            start = []
            for source, k in zip(b.column(1).to_pylist(), n, strict=True):
                start.append(at := queued.get(source, 0))
                queued[source] = at + k
            yield pa.RecordBatch.from_arrays([pa.array([part] * len(n), pa.int32()), b.column(0), b.column(1), pa.array(start, pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.binary())], ["part", "doc_id", "source", "start", "n", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("source").cast("string"), "text").mapInArrow(run, f"part int, doc_id {kind}, source string, start long, n long, ids binary")
    return materialize(rows, "queues")


def pack(docs: DataFrame, path: str, window: int = 1024, targets: dict[str, float] | None = None, packet: int = 256, rounds: int = 512, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Pack every id of every document into sequences of at most `window` ids.

    targets: shares of the sources (normalised; sources not named share the least named share); default: each
    source's share of all ids, so that every window has the corpus's mixture. A source whose queue has ended
    gets no more credit; the others' packets close up. packet: ids served at once; rounds: rounds of a block.

    Returns a row for each piece: doc_id, source, start, length, ids_crc32 (of little-endian unsigned 32-bit ids),
    doc_tokens, sequence_id, offset, and ids (array) if asked for. Each id lies in one piece. The last sequence of a block
    is split into powers of two, so no sequence needs padding. Null texts hold the end id alone; a null source is
    a source of its own; repeated rows are packed as rows of their own; an empty table gives no rows.

    Scale: ids are made once, written, and shuffled once by block. A block holds about rounds * window ids, whatever
    the sources' sizes, so one source with a third of all rows is spread over all blocks.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = queue_documents(docs, path, end_id)
    totals = rows.groupBy("source", "part").agg(F.sum("n").alias("n"))
    queue = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = materialize(totals.select("source", "part", "n", F.coalesce(F.sum("n").over(queue), F.lit(0)).alias("base")), "bases")
    share = totals.groupBy(F.col("source").alias("of")).agg(F.sum("n").cast("double").alias("share"))
    if targets:
        low = min(targets.values())
        known = F.create_map(*[F.lit(x) for pair in targets.items() for x in pair])
        share = share.withColumn("share", F.coalesce(F.try_element_at(known, F.coalesce("of", F.lit(""))), F.lit(low)).cast("double"))
    whole = share.agg(F.sum("share").alias("whole"))
    bases = totals.join(share.crossJoin(F.broadcast(whole)), F.col("source").eqNullSafe(F.col("of"))).select("of", F.col("part").alias("of_part"), "base", (F.col("share") / F.col("whole") * window).alias("quantum"))
    bases = small_side(bases, totals.count())
    placed = rows.join(bases, F.col("source").eqNullSafe(F.col("of")) & (F.col("part") == F.col("of_part"))).select("doc_id", "source", (F.col("base") + F.col("start")).alias("at"), "n", "quantum", "ids")

    def cut(batches):
        for b in batches:
            width = 0
            out: list[list] = [[] for _ in range(4)]
            n = b.column(3).to_numpy()
            at, quantum, ids = b.column(2).to_numpy(), b.column(4).to_numpy(), b.column(5).to_pylist()
            for i, x in enumerate(ids):
                width = len(x) // int(n[i])
                edges = np.append(np.arange(0, n[i], packet), n[i])
                turn = np.ceil((at[i] + edges[1:]) / quantum[i]).astype(np.int64)
                # consecutive packets of one turn are served together
                last = np.flatnonzero(np.append(turn[1:] != turn[:-1], True))
                lo = np.concatenate(([0], last[:-1] + 1))
                out[0] += [i] * len(last)
                out[1] += turn[last].tolist()
                out[2] += edges[lo].tolist()
                out[3] += [x[s * width : e * width] for s, e in zip(edges[lo].tolist(), edges[last + 1].tolist(), strict=True)]
            take = pa.array(out[0], pa.int64())
            turn = np.array(out[1], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(turn // rounds), pa.array(turn), b.column(0).take(take), b.column(1).take(take), b.column(2).take(take), pa.array(out[2], pa.int64()), b.column(3).take(take), pa.array(out[3], pa.binary())], ["block", "turn", "doc_id", "source", "at", "start", "doc_tokens", "ids"])

    packets = placed.mapInArrow(cut, f"block long, turn long, doc_id {kind}, source string, at long, start long, doc_tokens long, ids binary")
    # As many partitions as the ids ask for, whatever the session's number.
    whole = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    parts = max(1, -(-whole // (rounds * window * BLOCKS)))
    ordered = packets.repartition(parts, "block").sortWithinPartitions("block", "turn", "source", "at", "start")

    def fill(batches):
        block, number, held, room = None, 0, [], window
        out: list[list] = [[] for _ in range(9)]

        def close(size: int) -> None:
            """The first `size` held ids become a sequence."""
            nonlocal held, number
            offset, rest = 0, []
            for doc, source, start, total, x in held:
                take = min(len(x), size - offset)
                if take:
                    piece = x[:take]
                    for column, value in zip(out, (doc, source, start, take, zlib.crc32(piece.astype("<u4").tobytes()), total, block << 32 | number, offset, piece if with_ids else None), strict=True):
                        column.append(value)
                    offset += take
                if take < len(x):
                    rest.append((doc, source, start + take, total, x[take:]))
            held, number = rest, number + 1

        def end() -> None:
            while left := sum(len(h[4]) for h in held):
                close(1 << left.bit_length() - 1)

        def emit():
            columns = [*out[:8], *[out[8]] * with_ids]
            arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
            for c in out:
                c.clear()
            return pa.RecordBatch.from_arrays(arrays, schema=schema)

        schema = None
        for b in batches:
            if schema is None:
                schema = pa.schema([("doc_id", b.column(2).type), ("source", b.column(3).type), *[(x, pa.int64()) for x in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")], *[("ids", pa.list_(pa.int32()))] * with_ids])
            columns = [b.column(k).to_pylist() for k in (0, 2, 3, 5, 6, 7)]
            for own, doc, source, start, total, raw in zip(*columns, strict=True):
                if own != block:
                    end()
                    block, number, room = own, 0, window
                x = np.frombuffer(raw, dtype)
                held.append((doc, source, start, total, x))
                room -= len(x)
                while room <= 0:
                    close(window)
                    room += window
            yield emit()
        if schema is not None:
            end()
            yield emit()

    dtype = Encoder(path).dtype
    return ordered.mapInArrow(fill, PIECE.format(kind=kind) + ", ids array<int>" * with_ids)
