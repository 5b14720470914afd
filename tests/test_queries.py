"""Every query of the engine's own operators against its SQL on the same tables."""

import duckdb
import pytest

from talus.plans.queries import oracle_sql, queries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def sql(data):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return con


def plain(v):
    return round(v, 4) if isinstance(v, float) else v


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, sql, data, name):
    df = queries()[name](spark, data)
    columns = sorted(df.columns)
    got = sorted((tuple(map(plain, r)) for r in df.select(*columns).collect()), key=repr)
    if name not in oracle_sql():
        assert got
        return
    r = sql.execute(oracle_sql()[name])
    names = [x[0] for x in r.description]
    assert sorted(names) == columns
    want = sorted((tuple(plain(x[names.index(c)]) for c in columns) for x in r.fetchall()), key=repr)
    assert got == want


def test_gate_answers_are_those_of_the_definition(spark, data):
    """All answers occur, the cap over all visitors among them, and calls are in capped and in other spans."""
    from test_resolve_and_gate import simulated

    from talus.plans.queries import _LIMITS
    from talus.streaming import gate

    events = spark.read.parquet(f"{data}/events.parquet")
    rows = [(r.event_id, str(r.user_id), r.ts, r.event_type != "error", r.event_type == "click") for r in events.collect()]
    got = {r.request_id: r.answer for r in queries()["gate_answers"](spark, data).collect()}
    assert got == simulated(rows, _LIMITS) and set(got.values()) == {"ok", "code_required", "locked", "rate_limited", "daily_cap"}
    uncapped = gate.Limits(_LIMITS.fail, _LIMITS.miss, _LIMITS.minute, _LIMITS.day, (10**9, 86400))
    assert got != simulated(rows, uncapped)


def test_spot_check_of_letters_that_change_their_number(spark, sql, tmp_path):
    """A sharp s, ligatures and dotted capitals in names, blank texts, and words set apart by spaces that don't break."""
    texts = ["Und ßsch von", "Der ßer verch 12", "ﬁn ŉa x", "İş ǆa", "ΑΣ ΒΣ c", " \n\t", "", None, "two\u00a0halves of it", "plain words 12 here"]
    rows = [(3 * k + 1 + half, t) for k, t in enumerate(texts) for half in (0, 1)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    own = sql.cursor()
    own.execute(f"CREATE TEMP VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = queries()["spot_check"](spark, str(tmp_path)).select("doc_id", "name_ok", "amount_ok", "id_ok").collect()
    assert sorted(map(tuple, got)) == sorted(own.execute(oracle_sql()["spot_check"]).fetchall()) and len(got) == 14


def test_method_selection_of_orders_without_discount_and_tax(spark, sql, tmp_path):
    """Two extractors have the same amounts, whose rows lie in many files: the first stays, as in SQL, where both are summed in one order."""
    import random

    rng = random.Random(4)
    lines = [(k, n, rng.randint(90_000, 10_500_000) / 100, 0.0, 0.0) for k in range(3000) for n in range(1, rng.randint(3, 9))]
    rng.shuffle(lines)
    fields = "l_orderkey long, l_linenumber int, l_extendedprice double, l_discount double, l_tax double"
    spark.createDataFrame(lines, fields).repartition(12, "l_extendedprice").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(k, rng.randint(100_000, 50_000_000) / 100) for k in range(3000)], "o_orderkey long, o_totalprice double").write.parquet(str(tmp_path / "orders.parquet"))
    own = sql.cursor()
    for t in ("lineitem", "orders"):
        own.execute(f"CREATE TEMP VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    got = dict(map(tuple, queries()["method_selection"](spark, str(tmp_path)).select("doc_id", "method").collect()))
    assert got == dict(own.execute(oracle_sql()["method_selection"]).fetchall()) and len(got) == 3000
    assert set(got.values()) == {"text_regex", "paired_lines"}


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).limit(1).count() == 1


def test_the_engine_stands_without_llm():
    import ast
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent / "talus"
    for path in root.rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            for node in ast.walk(ast.parse(path.read_text())):
                names = [a.name for a in node.names] + [getattr(node, "module", None) or ""] if isinstance(node, (ast.Import, ast.ImportFrom)) else []
                assert not any("llm" in n.split(".") for n in names), path
