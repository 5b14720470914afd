import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from talus.operators import lookup, marts, resolve
from talus.streaming import gate, ingest


def test_holder_keys(spark):
    rows = [(0, "", "c1", "A 1"), (1, "B", "c1", ""), (2, "", "c1", "A1"), (3, "B", "c2", "A1"), (4, "", "c2", "A1"), (5, "", "c1", ""), (6, "", "c1", ""), (7, "", "c1", "A-1")]
    df = spark.createDataFrame(rows, "row_idx long, bo_id string, company string, folio_no string")
    df = df.withColumn("holder_key", resolve.holder_key(F.col("bo_id"), F.col("company"), F.col("folio_no"), F.col("row_idx")))
    got = {r.row_idx: r.holder_id for r in df.join(resolve.number_holders(df), "holder_key").collect()}
    assert got == {0: "H000001", 1: "H000002", 2: "H000001", 3: "H000002", 4: "H000003", 5: "H000004", 6: "H000005", 7: "H000006"}


def test_review_pairs(spark):
    names = [(k, f"h{k}", "", "A B C", 3, 1.0 * k, "x") for k in range(8)]
    names += [(20, "p", "1", "D E F", 3, None, "x"), (21, "q", "2", "D E F", 3, 1.0, "y"), (22, "r", "", "D E F", 3, 1.0, "y"), (30, "s", "", "G H", 2, 1.0, "y"), (31, "t", "", "G H", 2, 1.0, "y")]
    df = spark.createDataFrame(names, "row_idx long, holder_id string, bo_id string, block string, n_tokens int, amount double, company string")
    pairs = resolve.review_pairs(df).collect()
    assert sum(p.block == "A B C" for p in pairs) == 15
    assert sorted((p.holder_id_a, p.holder_id_b) for p in pairs if p.block == "D E F") == [("p", "r"), ("q", "r")]
    assert not any(p.block == "G H" for p in pairs)
    assert len(resolve.review_pairs(df, cap=3).collect()) == 3


def test_settled(spark):
    rows = spark.createDataFrame([(1, "B", "c", "", 5.0), (2, "", "c", "F 1", 7.0), (3, "", "d", "F1", 7.0), (4, "B", "c", "", 6.0), (5, "", "c", "F1", None)], "id long, bo_id string, company string, folio_no string, amount double")
    claims = spark.createDataFrame([("B", "x", "", 5.0), ("", "c", "F1", 7.0), ("", "c", "F1", None)], "bo_id string, company string, folio_no string, amount double")
    assert {r.id: r.settled_flag for r in resolve.settled_flags(rows, claims).collect()} == {1: 1, 2: 1, 3: 0, 4: 0, 5: 0}


def test_mode_and_links(spark):
    df = spark.createDataFrame([("g", x) for x in "bac"] + [("h", x) for x in "zzy"], "k string, v string")
    assert {r.k: r.v for r in marts.most_common(df, "k", "v").collect()} == {"g": "a", "h": "z"}
    rows = spark.createDataFrame([("d", 1, "ALPHA", "5.00")], "doc_id string, page int, name string, net string")
    pages = spark.createDataFrame([("d", 1, "x alpha 5.00")], "doc_id string, page int, text string")
    assert marts.found_on_page(rows, pages, ["name", "net"]).first().on_page


def test_lookups(spark):
    items = spark.createDataFrame([("1" * 16, "c1", "F1", "2018", "cash", 2.0, 5.5, True, "d", 1, "N"), ("1" * 16, "c2", "G2", "2019", "stock", 3.0, None, True, "d", 2, "N")], "bo_id string, company string, folio_key string, year string, dtype string, shares double, net double, verified boolean, doc_id string, page int, name string")
    asked = spark.createDataFrame([(1, "1111-1111 1111 1111"), (2, "12"), (3, "2" * 16), (4, None)], "request_id long, bo string")
    got = {r.request_id: r for r in lookup.lookup_account(asked, items).collect()}
    assert got[1].found and (got[1].totals.cash, got[1].totals.shares, got[1].totals.companies) == (5.5, 5.0, 2) and got[1].companies[0]["items"][0].year == "2018"
    assert got[2].error == got[4].error == "invalid_bo" and got[3].found is False
    folio = spark.createDataFrame([(1, "c1", "f-1"), (2, "c1", ""), (3, "", "f1"), (4, "c2", "f1")], "request_id long, company_asked string, folio string")
    got = {r.request_id: r for r in lookup.lookup_folio(folio, items).collect()}
    assert got[1].found and got[2].error == got[3].error == "invalid_folio" and got[4].found is False


T0 = dt.datetime(2024, 1, 1)


def calls(*rows):
    return [(k, ip, T0 + dt.timedelta(seconds=s), ok, missed) for k, (ip, s, ok, missed) in enumerate(rows)]


CALL = "request_id long, ip string, ts timestamp, code_ok boolean, missed boolean"


def test_gate_rules(spark):
    fails = [("f", s, False, False) for s in range(5)] + [("f", 10, True, False), ("f", 900, True, False)]
    hits = [("h", s, True, False) for s in range(20)] + [("h", 21, True, False), ("h", 60, True, False)]
    misses = [("m", 61 * s, True, True) for s in range(15)] + [("m", 61 * 15, True, False)]
    rows = calls(*fails, *hits, *misses)
    df = spark.createDataFrame(rows, CALL)
    got = {r.request_id: r.answer for r in gate.gate_batch(df).collect()}
    said = [got[k] for k in range(len(rows))]
    assert said[:5] == ["code_required"] * 5 and said[5:7] == ["locked", "ok"]
    assert said[7:27] == ["ok"] * 20 and said[27] == "rate_limited" and said[28] == "ok"
    assert said[29:44] == ["ok"] * 15 and said[44] == "locked"


def simulated(rows, limits):
    """The rules by their definition, one call after the other."""
    hits, events, said = [], [], {}
    for k, ip, t, ok, missed in sorted(rows, key=lambda r: (r[2], r[0])):
        within = lambda log, kind, rule, own: sum(a > t - dt.timedelta(seconds=rule[1]) and (not own or i == ip) and (kind is None or x == kind) for a, i, x in log)  # noqa: B023, E731
        answer = None
        for log, kind, rule, own, name in ((events, "fail", limits.fail, 1, "locked"), (events, "miss", limits.miss, 1, "locked"), (hits, None, limits.minute, 1, "rate_limited"), (hits, None, limits.day, 1, "daily_cap"), (hits, None, limits.overall, 0, "daily_cap")):
            if answer is None and within(log, kind, rule, own) >= rule[0]:
                answer = name
        if answer is None:
            hits.append((t, ip, None))
            answer = "ok" if ok else "code_required"
            if not ok or missed:
                events.append((t, ip, "miss" if ok else "fail"))
        said[k] = answer
    return said


def test_overall_cap_lifts(spark):
    rows = calls(*[(f"v{k}", 61 * k, True, False) for k in range(30)])
    limits = gate.Limits(overall=(5, 600))
    got = {r.request_id: r.answer for r in gate.gate_all(spark.createDataFrame(rows, CALL), limits).collect()}
    assert got == simulated(rows, limits)
    assert [got[k] for k in range(12)] == ["ok"] * 5 + ["daily_cap"] * 5 + ["ok"] * 2


@pytest.mark.parametrize("cap", [3, 12, 40, 10_000])
def test_gate_like_the_definition(spark, cap):
    """Days of calls of few visitors, with the cap reached early, late, again and again, or never."""
    rng = random.Random(cap)
    at, rows = 0.0, []
    for k in range(600):
        at += rng.choice([0, 0.5, 7, 60, 900, 4000])
        rows.append((f"u{rng.randint(0, 6)}", at, rng.random() > 0.2, rng.random() < 0.3))
    rows = calls(*rows)
    limits = gate.Limits(fail=(2, 900), miss=(4, 3600), minute=(3, 60), day=(20, 86400), overall=(cap, 86400))
    got = {r.request_id: r.answer for r in gate.gate_all(spark.createDataFrame(rows, CALL), limits).collect()}
    assert got == simulated(rows, limits)
    assert len(set(got.values())) >= 3


def many_calls(seed, n=600):
    rng = random.Random(seed)
    at, rows = 0.0, []
    for _ in range(n):
        at += rng.choice([0, 0.5, 7, 60, 900, 4000])
        rows.append((f"u{rng.randint(0, 6)}", at, rng.random() > 0.2, rng.random() < 0.3))
    return calls(*rows)


def test_only_the_capped_day_is_one_task(spark):
    """A log of 12 days with one that is capped in its middle: equal to the simulation, and the calls of the other days are dealt over tasks."""
    rng = random.Random(2)
    rows = [(f"u{rng.randint(0, 30)}", 86400 * day + rng.random() * 86400, rng.random() > 0.1, rng.random() < 0.2) for day in range(12) for _ in range(400 if day == 5 else 40)]
    rows = calls(*sorted(rows, key=lambda r: r[1]))
    limits = gate.Limits(day=(20, 86400), overall=(120, 86400))
    df = spark.createDataFrame(rows, CALL)
    spans = gate._capped_spans(gate._calls(df), None, limits)
    assert [capped for _, _, capped in spans] == [False, True, False]
    assert sum(end - first for first, end, capped in spans if capped) < 3 * 86400
    want = simulated(rows, limits)
    assert {r.request_id: r.answer for r in gate.gate_all(df, limits).collect()} == want
    assert sum(a == "daily_cap" for a in want.values()) > 50
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = [f(gate._calls(df), limits).select(F.spark_partition_id().alias("p")).distinct().count() for f in (gate._by_visitor, gate._together)]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert tasks[0] > 1 and tasks[1] == 1


def test_spans_bound_what_is_accepted(spark):
    """Outside of capped spans the cap never says no, for logs of all kinds; many visitors over their own limits don't make a span."""
    for seed, cap in ((1, 12), (2, 30), (3, 60)):
        rows = many_calls(seed)
        limits = gate.Limits(fail=(2, 900), miss=(4, 3600), minute=(3, 60), day=(20, 86400), overall=(cap, 86400))
        free = gate.Limits(fail=limits.fail, miss=limits.miss, minute=limits.minute, day=limits.day, overall=(10**9, 86400))
        spans = gate._capped_spans(gate._calls(spark.createDataFrame(rows, CALL)), None, limits)
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))
        first = next((s for s in spans if s[2]), None)
        said, unlimited = simulated(rows, limits), simulated(rows, free)
        before = [r for r in rows if first is None or r[2].timestamp() < first[0]]
        assert all(said[r[0]] == unlimited[r[0]] for r in before)
    one = calls(*[("u", 60 * k, True, False) for k in range(1000)])
    assert [s[2] for s in gate._capped_spans(gate._calls(spark.createDataFrame(one, CALL)), None, gate.Limits(day=(20, 86400), overall=(50, 86400)))] == [False]


def test_a_capped_span_is_answered_by_many_tasks(spark):
    """Calls of a dense log, several at one time, that mostly come while the cap is reached, in packets of few: as simulated, and only the accepted
    ones come from the one task."""
    rng = random.Random(9)
    rows = calls(*sorted(((f"u{rng.randint(0, 40)}", rng.randint(0, 3 * 86400) + rng.choice([0, 0.25]), rng.random() > 0.2, rng.random() < 0.3) for _ in range(3000)), key=lambda r: r[1]))
    limits = gate.Limits(fail=(2, 900), miss=(4, 3600), minute=(3, 60), day=(5, 86400), overall=(25, 86400))
    df = gate._calls(spark.createDataFrame(rows, CALL)).withColumn("known", F.lit(None).cast("string"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = gate._capped(df, limits).withColumn("p", F.spark_partition_id()).collect()
        one = gate._together(df, limits).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = simulated(rows, limits)
    assert {r.request_id: r.answer for r in got} == want and len(got) == len(rows) and len({r.p for r in got}) > 1
    assert {r.request_id for r in one} == {k for k, a in want.items() if a in gate.ACCEPTED} and len(one) <= 4 * 25


def test_empty_log(spark):
    assert gate.gate_all(spark.createDataFrame([], CALL)).collect() == []


@pytest.mark.parametrize("cap", [9, 10_000])
def test_gate_in_micro_batches(spark, tmp_path, cap):
    """Three files of a log, one batch each and the query started anew for the last: as if it were one log. A batch that is run again changes nothing."""
    rows = many_calls(5, 240)
    limits = gate.Limits(fail=(2, 900), miss=(4, 3600), minute=(3, 60), day=(20, 86400), overall=(cap, 86400))
    schema = spark.createDataFrame(rows[:1], CALL).schema

    def more(part):
        spark.createDataFrame(part, CALL).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(1.1)

    more(rows[:100])
    more(rows[100:150])
    stream = ingest.new_files(spark, str(tmp_path / "in"), schema, maxFilesPerTrigger=1)
    start = lambda: gate.gate_in_batches(stream, str(tmp_path / "out"), str(tmp_path / "cp"), limits).awaitTermination()
    start()
    more(rows[150:])
    start()
    start()
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted({r.batch for r in got}) == [0, 1, 2] and len(got) == len(rows)
    assert {r.request_id: r.answer for r in got} == simulated(rows, limits)


ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def test_gate_stream_like_batch(spark, tmp_path):
    """Two batches of a stream with a state for each visitor, in a query that is started anew between them."""
    rows = calls(*[(f"u{k % 3}" if k % 7 else None, 7 * k, k % 4 != 0, k % 5 == 0) for k in range(120)])
    schema = spark.createDataFrame(rows[:1], CALL).schema
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    try:
        for part, n in ((rows[:50], 50), (rows[50:], 120)):
            spark.createDataFrame(part, CALL).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            answers = gate.gate_stream(ingest.new_files(spark, str(tmp_path / "in"), schema))
            q = answers.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).start()
            # With timers by the clock a query goes on without new data.
            for _ in range(240):
                if q.exception() or ((tmp_path / "out" / "_spark_metadata").exists() and spark.read.schema(gate.ANSWER).parquet(str(tmp_path / "out")).count() >= n):
                    break
                time.sleep(0.5)
            q.stop()
            assert q.exception() is None
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    want = {r.request_id: r.answer for r in gate.gate_batch(spark.createDataFrame(rows, CALL)).collect()}
    assert {r.request_id: r.answer for r in spark.read.parquet(str(tmp_path / "out")).collect()} == want


ITEMS = "bo_id string, company string, folio_key string, name string, year string, dtype string, shares double, net double, verified boolean, doc_id string, page int"


def test_gated_lookups(spark):
    """What a lookup finds decides what its call leaves: misses lock, finds and invalid keys don't; a rejected call is not looked up."""
    import hashlib

    from talus.streaming import access

    bo = "1201000000000001"
    items = spark.createDataFrame([(bo, "C1", "", "ALPHA", "2018", "cash", None, 5.0, True, "d", 1), (bo, "C2", "", "ALPHA", "2019", "cash", None, 7.0, True, "e", 1), ("", "C1", "F1", "BETA", "2018", "cash", None, 2.0, True, "d", 2)], ITEMS)
    asked = [
        ("a", 0, " Open ", bo, None, None, (None, True)), ("a", 1, "open", "1201-0000-0000-0001", None, None, (None, True)), ("a", 2, "wrong", bo, None, None, ("code_required", None)),
        ("a", 3, None, bo, None, None, ("code_required", None)), ("a", 4, "open", "12", None, None, ("invalid_bo", None)), ("a", 5, "open", None, "C1", "f-1", (None, True)), ("a", 6, "open", None, None, "F1", ("invalid_folio", None)),
        ("a", 7, "open", None, "C2", "F1", (None, False)), ("a", 8, "open", None, "C1", "", ("invalid_folio", None)), ("a", 9, "open", None, None, None, ("invalid_bo", None)),
        *[("m", k, "open", "9" * 16, None, None, (None, False)) for k in range(3)], ("m", 4, "open", bo, None, None, ("locked", None)), ("m", 4000, "open", bo, None, None, (None, True)),
        *[("i", k, "open", "1", None, None, ("invalid_bo", None)) for k in range(8)], ("i", 9, "open", bo, None, None, (None, True)),
    ]
    rows = [(k, ip, T0 + dt.timedelta(seconds=s), code, b, c, f) for k, (ip, s, code, b, c, f, _) in enumerate(asked)]
    requests = spark.createDataFrame(rows, "request_id long, ip string, ts timestamp, code string, bo string, company_asked string, folio string")
    own = access.Access(hashlib.sha256(b"open").hexdigest())
    got = {r.request_id: r for r in access.answer_lookups(requests, items, gate.Limits(miss=(3, 3600), minute=(1000, 60)), own).collect()}
    assert [(got[k].error, got[k].found) for k in range(len(asked))] == [want for *_, want in asked]
    assert (got[0].name, got[0].totals.cash, got[0].totals.companies, len(got[0].companies)) == ("ALPHA", 12.0, 2, 2) and got[5].totals.cash == 2.0
    assert all(got[k].companies is None for k in range(len(asked)) if not got[k].found)


def test_sliding_bounds(spark):
    df = spark.createDataFrame([(1, "a", T0), (2, "a", T0 + dt.timedelta(seconds=900)), (3, "a", T0 + dt.timedelta(seconds=901))], "id long, k string, ts timestamp")
    got = {r.id: r.n for r in gate.sliding_counts(df, "k", "ts", {"n": (F.lit(True), 900)}).collect()}
    assert got == {1: 1, 2: 1, 3: 2}
    old = gate.recent(df, "ts", F.lit(T0 + dt.timedelta(days=2)).cast("timestamp") + F.expr("INTERVAL 900 SECONDS"))
    assert sorted(r.id for r in old.collect()) == [2, 3]
