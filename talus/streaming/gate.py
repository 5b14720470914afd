"""A rate-limiting gate over request logs: sliding counts, and the sequential rules in batch and as stateful streaming."""

from __future__ import annotations

import uuid
from bisect import bisect_left, bisect_right
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..schemas import EVENT_TTL_SECONDS, GATE_DAY, GATE_FAIL, GATE_GLOBAL, GATE_MINUTE, GATE_MISS, PURGE_SHARE
from ..sources.stored import shared_folder, stored


def sliding_counts(events: DataFrame, key: str, ts: str, counts: dict[str, tuple[F.Column, int]]) -> DataFrame:
    """For each named (condition, seconds), how many earlier events of the key within less than so many seconds meet the condition.

    The event itself and others at its instant count; the far end is exclusive, to the microsecond.
    """
    df = events.withColumn("_us", F.unix_micros(F.col(ts).cast("timestamp")))
    for name, (condition, seconds) in counts.items():
        w = Window.partitionBy(key).orderBy("_us").rangeBetween(1 - seconds * 1_000_000, 0)
        df = df.withColumn(name, F.coalesce(F.sum(F.when(condition, 1).otherwise(0)).over(w), F.lit(0)))
    return df.drop("_us")


def recent(events: DataFrame, ts: str, now, seconds: int = EVENT_TTL_SECONDS) -> DataFrame:
    """Events that are not older than their time to live."""
    return events.filter(F.col(ts) >= now - F.make_interval(secs=F.lit(seconds)))


def purging_calls(calls: DataFrame, share: float = PURGE_SHARE) -> DataFrame:
    """The calls (request_id, ts) that purge the logs: about `share` of them, by a hash of the id, so that a task that runs again chooses alike."""
    draw = F.conv(F.substring(F.sha2(F.concat(F.lit("purge:"), F.col("request_id").cast("string")), 256), 1, 8), 16, 10).cast("long")
    return calls.filter(draw < int(share * (1 << 32)))


def purged(log: DataFrame, calls: DataFrame, ts: str = "ts", share: float = PURGE_SHARE, seconds: int = EVENT_TTL_SECONDS) -> DataFrame:
    """What is left of a log after its calls: each purging call drops what is older than the time to live at its time."""
    last = purging_calls(calls, share).agg(F.unix_micros(F.max("ts").cast("timestamp"))).first()[0]
    return log if last is None else recent(log, ts, F.timestamp_micros(F.lit(last)), seconds)


@dataclass(frozen=True)
class Limits:
    fail: tuple[int, int] = GATE_FAIL
    miss: tuple[int, int] = GATE_MISS
    minute: tuple[int, int] = GATE_MINUTE
    day: tuple[int, int] = GATE_DAY
    overall: tuple[int, int] = GATE_GLOBAL


class Gate:
    """The rules in order of time, for any number of visitors. Logs hold times in seconds of accepted calls (hits), wrong codes (fails) and
    lookups that find nothing (misses), ascending; what is older than the time to live is dropped, so that the cap over all visitors,
    where it applies, bounds the logs."""

    def __init__(self, limits: Limits, overall: bool = False):
        self.limits, self.overall = limits, overall
        self.logs: dict[str, tuple[list[float], list[float], list[float]]] = {}
        self.all: deque[float] = deque()
        self._swept = 0.0

    def log(self, ip: str) -> tuple[list[float], list[float], list[float]]:
        return self.logs.setdefault(ip, ([], [], []))

    def _sweep(self, now: float) -> None:
        """Forgets visitors without calls within the time to live, once in that time."""
        if now - self._swept > EVENT_TTL_SECONDS:
            self.logs = {ip: logs for ip, logs in self.logs.items() if any(log and log[-1] >= now - EVENT_TTL_SECONDS for log in logs)}
            self._swept = now

    def record(self, ip: str, now: float, answer: str, missed: bool) -> None:
        """What a call with this answer leaves: a rejected call nothing, a wrong code a hit and a fail, a lookup that finds nothing a hit and a miss."""
        if answer not in ACCEPTED:
            return
        hits, fails, misses = self.log(ip)
        hits.append(now)
        if self.overall:
            self.all.append(now)
        if answer == "code_required":
            fails.append(now)
        elif missed:
            misses.append(now)

    def refusal(self, ip: str, now: float) -> str | None:
        """What the visitor's own rules answer to a call that they reject."""
        hits, fails, misses = logs = self.log(ip)
        for log in logs:
            if log and log[0] < now - EVENT_TTL_SECONDS:
                del log[: bisect_left(log, now - EVENT_TTL_SECONDS)]
        for log, (most, seconds), said in ((fails, self.limits.fail, "locked"), (misses, self.limits.miss, "locked"), (hits, self.limits.minute, "rate_limited"), (hits, self.limits.day, "daily_cap")):
            if len(log) - bisect_right(log, now - seconds) >= most:
                return said
        return None

    def full_after(self, now: float) -> float | None:
        """If the cap over all visitors is reached at this time: it is until the cap's window before a call no longer holds this time."""
        most, seconds = self.limits.overall
        while self.all and self.all[0] <= now - seconds:
            self.all.popleft()
        return self.all[len(self.all) - most] if len(self.all) >= most else None

    def call(self, ip: str, now: float, code_ok: bool, missed: bool) -> str:
        self._sweep(now)
        if said := self.refusal(ip, now):
            return said
        if self.overall and self.full_after(now) is not None:
            return "daily_cap"
        answer = "ok" if code_ok else "code_required"
        self.record(ip, now, answer, missed)
        return answer


ACCEPTED = ("ok", "code_required")
ANSWER = "request_id long, ip string, ts timestamp, answer string"
#: An answer with what a later call must know of it.
KEPT = ANSWER + ", code_ok boolean, missed boolean"
_CALL = ("request_id", "ip", "ts", "code_ok", "missed")


def _answers(gate: Gate, pdf: pd.DataFrame) -> pd.DataFrame:
    """Answers to calls that come in order; those with an answer already (a column `known`) only leave their marks."""
    known = pdf["known"] if "known" in pdf else [None] * len(pdf)
    said = []
    for ip, t, ok, missed, before in zip(pdf["ip"], pdf["ts"], pdf["code_ok"], pdf["missed"], known, strict=True):
        if before is None:
            said.append(gate.call(ip, t.timestamp(), bool(ok), bool(missed)))
        else:
            gate.record(ip, t.timestamp(), before, bool(missed))
            said.append(None)
    out = pdf[list(_CALL)].assign(answer=said)
    return out.loc[out["answer"].notna(), ["request_id", "ip", "ts", "answer", "code_ok", "missed"]]


def _by_visitor(calls: DataFrame, limits: Limits) -> DataFrame:
    """Answers with KEPT's columns to calls that may have `known`, by the rules of single visitors."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gate, last = Gate(limits), None
        for pdf in batches:
            for ip, own in pdf.groupby("ip", sort=False, dropna=False):
                if ip != last:
                    gate, last = Gate(limits), ip
                yield _answers(gate, own)

    return calls.repartition("ip").sortWithinPartitions("ip", *_order(calls)).mapInPandas(run, KEPT)


def _together(calls: DataFrame, limits: Limits) -> DataFrame:
    """The accepted ones of calls that may have `known`, with KEPT's columns, by all rules, in one task that streams in order of time; the cap bounds
    the logs that it holds.

    Calls are sorted and packed in parallel, so the task sorts packets alone. While the cap is reached, nothing is accepted, and calls up to
    the time at which it no longer is are passed over at once.
    """
    known = F.col("known") if "known" in calls.columns else F.lit(None).cast("string").alias("known")
    rows = calls.select(F.unix_micros("ts").alias("us"), "request_id", "ip", "code_ok", "missed", known)
    order = ["us", F.col("known").isNull(), "request_id"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for n, batch in enumerate(b for b in batches if b.num_rows):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(batch)
            yield pa.RecordBatch.from_pydict({"first": [batch["us"][0].as_py()], "n": [n], "packet": [sink.getvalue().to_pybytes()]})

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gate = Gate(limits, overall=True)
        for packet in (p for b in batches for p in b["packet"]):
            calls = pa.ipc.open_stream(packet.as_buffer()).read_next_batch()
            times, kept, said, k = calls["us"].to_numpy() / 1e6, [], [], 0
            late, earlier = times - limits.overall[1], np.flatnonzero(calls["known"].is_valid().to_numpy(zero_copy_only=False))
            ip, ok, missed, before = calls["ip"], calls["code_ok"], calls["missed"], calls["known"]
            while k < len(times):
                now, after = float(times[k]), gate.full_after(float(times[k]))
                if after is not None:
                    ahead = np.searchsorted(earlier, k)
                    to = min(k + int(np.searchsorted(late[k:], after)), int(earlier[ahead]) if ahead < len(earlier) else len(times))
                    if to > k:
                        k = to
                        continue
                if before[k].is_valid:
                    gate.record(ip[k].as_py(), now, before[k].as_py(), bool(missed[k].as_py()))
                elif (answer := gate.call(ip[k].as_py(), now, bool(ok[k].as_py()), bool(missed[k].as_py()))) in ACCEPTED:
                    kept.append(k)
                    said.append(answer)
                k += 1
            if kept:
                found = calls.take(pa.array(kept))
                ts = found["us"].cast(pa.timestamp("us", "UTC"))
                yield pa.RecordBatch.from_arrays([found["request_id"], found["ip"], ts, pa.array(said, pa.string()), found["code_ok"], found["missed"]], names=["request_id", "ip", "ts", "answer", "code_ok", "missed"])

    # Ranges are by time alone, so no two share a time; packets of one range come in its order.
    packed = rows.repartitionByRange("us").sortWithinPartitions(*order).mapInArrow(pack, "first long, n long, packet binary")
    return packed.repartition(1).sortWithinPartitions("first", "n").mapInArrow(walk, KEPT)


def _capped(calls: DataFrame, limits: Limits) -> DataFrame:
    """Answers with KEPT's columns to calls that have `known`, by all rules. Rejected calls leave nothing, so once the accepted ones are found,
    visitors are independent: a call that was not accepted is answered by its visitor's rules, and if they let it pass, it was the cap."""
    accepted = stored(_together(calls, limits), "accepted").withColumnRenamed("answer", "known")
    rows = calls.withColumn("turn", F.when(F.col("known").isNull(), 2).otherwise(0)).unionByName(accepted.withColumn("turn", F.lit(1)))
    rows = rows.select(*_CALL, "known", "turn", F.unix_micros("ts").alias("us"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gate, last, own = Gate(limits), None, deque()
        for b in batches:
            at, said = [], []
            for k, (id_, ip, missed, known, turn, us) in enumerate(zip(*(b[c].to_pylist() for c in ("request_id", "ip", "missed", "known", "turn", "us")), strict=True)):
                if ip != last:
                    gate, last = Gate(limits), ip
                if turn < 2:
                    gate.record(ip, us / 1e6, known, bool(missed))
                    if turn:
                        own.append((us, id_, known))
                    continue
                at.append(k)
                said.append(own.popleft()[2] if own and own[0][:2] == (us, id_) else gate.refusal(ip, us / 1e6) or "daily_cap")
            out = b.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([out["request_id"], out["ip"], out["ts"], pa.array(said, pa.string()), out["code_ok"], out["missed"]], names=["request_id", "ip", "ts", "answer", "code_ok", "missed"])

    return rows.repartition("ip").sortWithinPartitions("ip", "us", F.col("turn") > 0, "request_id", "turn").mapInArrow(run, KEPT)


def _order(calls: DataFrame) -> list:
    return ["ts", F.col("known").isNull(), "request_id"] if "known" in calls.columns else ["ts", "request_id"]


def _calls(requests: DataFrame) -> DataFrame:
    return requests.select("request_id", F.coalesce("ip", F.lit("unknown")).alias("ip"), F.col("ts").cast("timestamp").alias("ts"), "code_ok", "missed")


def gate_batch(requests: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Answers to requests (request_id, ip, ts, code_ok, missed) of a whole log by the rules of single visitors; the cap over all is left out.

    The rules are sequential within a visitor: a rejected call does not count, so no window function can say them. Each task walks
    its visitors' calls in order, as they come from the sort, and holds one visitor's recent log at a time.
    """
    return _by_visitor(_calls(requests), limits).drop("code_ok", "missed")


def _capped_spans(calls: DataFrame, before: DataFrame | None, limits: Limits) -> list[tuple[int, int, bool]]:
    """The log cut into spans of seconds (first, end, may the cap over all be reached?).

    Whatever the answers, a visitor has at most the daily limit of accepted calls within a day, and no more than calls. The sum of
    these bounds over the visitors of the cap's window, block by block of a 24th of it, is a bound of all accepted calls; where it
    is under the cap, the cap rejects nothing. Rows here are visitors' blocks, then blocks; what comes to the driver is a row a span.
    """
    most, seconds = limits.overall
    unit = max(1, seconds // 24)
    back = -(-seconds // unit)
    own = -(-(back + 1) * unit // limits.day[1]) * limits.day[0]
    block = F.floor(F.unix_seconds("ts") / unit).alias("block")
    counted = calls if before is None else calls.select("ip", "ts").union(before.select("ip", "ts"))
    counts = counted.groupBy("ip", block).agg(F.count("*").alias("n"))
    # Counts come with their block and leave after the window: a visitor's bound changes at these blocks alone.
    points = counts.union(counts.select("ip", F.col("block") + back + 1, -F.col("n"))).groupBy("ip", "block").agg(F.sum("n").alias("n"))
    by = Window.partitionBy("ip").orderBy("block")
    held = points.withColumn("held", F.least(F.sum("n").over(by.rowsBetween(Window.unboundedPreceding, 0)), F.lit(own)))
    change = held.withColumn("n", F.col("held") - F.coalesce(F.lag("held").over(by), F.lit(0))).groupBy("block").agg(F.sum("n").alias("n"))
    bounds = change.select("block", (F.sum("n").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, 0)) > most).alias("capped")).join(calls.select(block).distinct(), "block")
    turn = F.col("capped") != F.coalesce(F.lag("capped").over(Window.orderBy("block")), ~F.col("capped"))
    spans = bounds.withColumn("turn", turn).withColumn("span", F.sum(F.col("turn").cast("int")).over(Window.orderBy("block")))
    out: list[tuple[int, int, bool]] = []
    for r in spans.groupBy("span", "capped").agg(F.min("block").alias("first"), F.max("block").alias("last")).orderBy("span").collect():
        first = r["first"] * unit
        # Less than the cap's window between two capped spans is not worth jobs of its own.
        if r["capped"] and len(out) > 1 and out[-1][1] - out[-1][0] < seconds:
            first = out[-2][0]
            del out[-2:]
        out.append((first, (r["last"] + 1) * unit, r["capped"]))
    return out


def gate_all(requests: DataFrame, limits: Limits = Limits(), before: DataFrame | None = None) -> DataFrame:
    """The same with the cap over all visitors: once so many calls were accepted within the day, further ones get daily_cap, and leave nothing.

    The log is cut into spans. Where no answers whatever could reach the cap, visitors are independent and dealt over tasks; only a span
    in which it may be reached goes through one task in order of time, which looks for the accepted calls alone; the other answers follow from these. Spans
    follow one another, and each gets the accepted calls of the limits' longest window before it with their answers; so a capped day makes a
    task of that day's calls, and of no others. before: earlier answers (KEPT, as kept=True gives them) that count too; a call that
    comes late is judged by what was accepted before its own time. Times are not null; request ids tell calls of one time apart.
    """
    return _gate_all(requests, limits, before).drop("code_ok", "missed")


def _gate_all(requests: DataFrame, limits: Limits, before: DataFrame | None = None) -> DataFrame:
    spark = requests.sparkSession
    # By ranges of time, so that a span reads its own files only.
    calls = stored(_calls(requests).repartitionByRange("ts").sortWithinPartitions("ts"), "calls")
    horizon = max(rule[1] for rule in (limits.fail, limits.miss, limits.minute, limits.day, limits.overall))
    folder = f"{shared_folder(spark)}/answers-{uuid.uuid4().hex}"
    kept = T._parse_datatype_string(KEPT)
    spans = _capped_spans(calls, before, limits)
    second = lambda s: F.timestamp_seconds(F.lit(s))
    accepted = F.col("answer").isin(*ACCEPTED)
    for k, (first, end, capped) in enumerate(spans):
        rows = calls.filter((F.col("ts") >= second(first)) & (F.col("ts") < second(end))).withColumn("known", F.lit(None).cast("string"))
        recent = (F.col("ts") >= second(first - horizon)) & (F.col("ts") < second(end)) & accepted
        near = [j for j, span in enumerate(spans[:k]) if span[1] > first - horizon]
        for df in (spark.read.schema(kept).parquet(*(f"{folder}/span={j}" for j in near)) if near else None, before):
            if df is not None:
                rows = rows.unionByName(df.filter(recent).withColumnRenamed("answer", "known").select(*_CALL, "known"))
        (_capped if capped else _by_visitor)(rows, limits).write.mode("overwrite").parquet(f"{folder}/span={k}")
    return spark.read.schema(kept).parquet(*(f"{folder}/span={k}" for k in range(len(spans)))) if spans else spark.createDataFrame([], kept)


def gate_in_batches(requests: DataFrame, folder: str, checkpoint: str, limits: Limits = Limits()):
    """The rules with the cap over all visitors for a stream of requests: every micro-batch is a log that gate_all answers, given the answers
    of the batches before it. Answers (KEPT) go to folder/batch=<number>, so a batch that is run again replaces its own. Starts a query
    that takes what is there and ends; with the same checkpoint the next one goes on."""

    def answer(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        there = spark.read.schema(KEPT + ", batch long").parquet(folder).filter(F.col("batch") < number).drop("batch") if number else None
        _gate_all(batch, limits, there).write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return requests.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(answer).start()


class _Visitor(StatefulProcessor):
    """One visitor's log as list state. Spark forgets what is older than the time to live; a timer, moved on by every batch of calls, ends the
    visitor's state altogether."""

    def __init__(self, limits: Limits):
        self.limits = limits

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.log = handle.getListState("log", "kind int, t double", ttlDurationMs=EVENT_TTL_SECONDS * 1000)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        gate = Gate(self.limits)
        logs = gate.log(key[0])
        for kind, t in self.log.get() if self.log.exists() else ():
            logs[kind].append(t)
        yield _answers(gate, pd.concat(list(rows)).sort_values(["ts", "request_id"], kind="stable"))[["request_id", "ip", "ts", "answer"]]
        held = [(kind, t) for kind, log in enumerate(gate.log(key[0])) for t in log]
        if held:
            self.log.put(held)
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t[0] if isinstance(t, tuple) else t)
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + EVENT_TTL_SECONDS * 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.log.clear()
        return iter(())

    def close(self) -> None:
        pass


def gate_stream(requests: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The rules of single visitors for a stream, calls of one batch in order of time: list state by visitor with time to live and a timer. The
    session's state store must be RocksDB's (spark.sql.streaming.stateStore.providerClass). Timers go by the clock, so the query runs until it is
    stopped. With the cap over all: gate_in_batches."""
    keyed = _calls(requests).groupBy("ip")
    return keyed.transformWithStateInPandas(_Visitor(limits), ANSWER, "Append", "ProcessingTime")


def windowed_counts(stream: DataFrame, ts: str = "ts", kind: str = "event_type", length: str = "15 minutes", slide: str = "5 minutes", late: str = "30 minutes") -> DataFrame:
    """Counts by sliding window and kind with a watermark, for batch or streaming input."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, length, slide), kind).agg(F.count("*").alias("n")).select(F.col("window.start").alias("window_start"), kind, "n")
