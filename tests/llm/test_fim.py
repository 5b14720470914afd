import hashlib
import re

import pytest
from pyspark.sql import functions as F

from talus.llm import fim

TEXTS = [
    None, "", "\n", "\n\n\n", "one line", "ends\n", "a\nb\nc\n", "a\n\nb", "tab\there\r\nand\rthere\n", "\x1f", "\x1b", "\x1bd\x1be\x1f\n\x1f\x1b\nx\x1f",
    "d\ne\n", "has <P> inside\nand more\n", "has <S>", "<M>\n", "nearly <S\n>P>\n<\nM>\n<", "😀\n日本\né\u0301\n\u2028x\u0085\n", "\x00\n\x00", "$0 \\0\n$1\n", "same\nsame\n", "same\nsame\n",
    "l\n" * 100_000, "x" * 1_000_000, ("y" * 300_000 + "\n") * 3,
]


def brute(i, text, seed=7, rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n, h = len(units), hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    return (n, "spm", p, m, s, f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < spm else (n, "psm", p, m, s, f"<P>{p}<S>{s}<M>{m}")


@pytest.fixture(scope="module")
def docs(spark):
    # Every text at several ids, so that cuts fall at many places; ids that are null, negative or on two rows.
    rows = [(100 * k + j, t) for k, t in enumerate(TEXTS) for j in range(1 if t and len(t) > 10_000 else 12)]
    rows += [(None, "a\nb\n"), (-5, "a\nb\n"), (0, "c\nd\n"), (0, "other\nx")]
    return spark.createDataFrame(rows, "doc_id long, text string"), rows


@pytest.mark.parametrize("rate", [100, 60, 0])
def test_like_brute_force(docs, rate):
    df, rows = docs
    got = [tuple(r) for r in fim.fill_in_middle(df, rate=rate, spm=30).collect()]
    assert sorted(got, key=repr) == sorted(((i, *brute(i, t, rate=rate, spm=30)) for i, t in rows), key=repr)


def test_texts_are_restored(docs):
    df, _ = docs
    out = fim.fill_in_middle(df, carry=()).withColumn("back", fim.restore(F.col("output"), F.col("form")))
    whole = F.when(F.col("form") == "plain", F.col("output")).otherwise(F.concat("prefix", "middle", "suffix"))
    assert out.filter((F.col("back") != whole) | F.col("back").isNull()).count() == 0
    assert {r[0] for r in out.select("form").distinct().collect()} == {"plain", "psm", "spm"}


def test_digest(docs):
    df, rows = docs
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for i, t in rows:
        n, form, p, m, _, out = brute(i, t)
        want.append((i, n, form, p if p is None else len(p), m if m is None else len(m), sha(out), sha(t or "")))
    assert sorted((tuple(r) for r in fim.digest(df).collect()), key=repr) == sorted(want, key=repr)


def test_other_units(spark):
    df = spark.createDataFrame([(k, "one two  three\nfour") for k in range(30)], "doc_id long, text string")
    for r in fim.fill_in_middle(df, unit=r"\s*\S+").collect():
        assert r.n == 4 and r.prefix + r.middle + r.suffix == "one two  three\nfour"
        assert all(part in ("", "one", "one two", "one two  three", "one two  three\nfour") for part in [r.prefix])


def test_other_columns(spark):
    df = spark.createDataFrame([(1, "a\nb\n", "x", 3, 4)], "doc_id long, text string, form string, units int, mine int")
    assert fim.fill_in_middle(df, carry=("units", "mine")).columns == ["doc_id", "units", "mine", *fim.RESULT]
    assert [tuple(r)[1:3] for r in fim.fill_in_middle(df, carry=("units", "mine")).collect()] == [(3, 4)]
    with pytest.raises(ValueError, match="form"):
        fim.fill_in_middle(df, carry=("form",))


def test_empty_table(spark):
    assert fim.digest(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_stays_in_the_engine(spark):
    plan = fim.digest(spark.createDataFrame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Exchange", "Python", "Arrow"))
