import pytest
from pyspark.sql import functions as F

from talus.operators import totals as T


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def doubles(*v):
    return F.array(*(F.lit(float(x)) for x in v)) if v else F.array().cast("array<double>")


def test_candidates(spark):
    (c,) = one(spark, T.candidates(doubles(500, 500, 300, 7), F.array(doubles(100, 250, 3))))
    assert c == [100.0, 250.0, 300.0, 350.0, 400.0, 500.0, 800.0]
    (strict,) = one(spark, T.candidates(doubles(500), strict=True))
    assert strict == [500.0]
    assert one(spark, T.candidates(doubles())) == ([],)


@pytest.mark.parametrize(("value", "want"), [(1000.0, "match"), (996.0, "match"), (994.0, "mismatch"), (500.0, "match"), (0.0, "mismatch")])
def test_check(spark, value, want):
    assert one(spark, T.total_check(T.candidates(doubles(1000)), F.lit(value))) == (want,)


def test_nothing_printed_and_ties(spark):
    assert one(spark, T.total_check(doubles(), F.lit(5.0)), T.nearest(doubles(), F.lit(5.0))) == ("no_total_printed", None)
    assert one(spark, T.nearest(doubles(4, 6), F.lit(5.0)), T.upper_median(doubles(1, 2, 3, 4))) == (4.0, 3.0)


SCORE = "doc_id string, method string, check string, error double, extracted double, rows long"
YEARS = "doc_id string, years long, hits long, median_error double, near_share double"


def chosen(spark, scores, years=()):
    rows = [("d", *s) for s in scores]
    r = T.choose_method(spark.createDataFrame(rows, SCORE), spark.createDataFrame([("d", *y) for y in years], YEARS)).first()
    return r.method, r.approximate


def test_method_choice(spark):
    base, match = ("text_regex", "mismatch", 0.3, 700.0, 9), ("text_regex", "match", 0.0, 1000.0, 9)
    assert chosen(spark, [base, ("column_position", "match", 0.0, 1000.0, 9)]) == ("column_position", False)
    assert chosen(spark, [match, ("column_position", "match", 0.0, 1000.0, 9)]) == ("text_regex", False)
    assert chosen(spark, [base, ("column_position", "mismatch", 0.2, 800.0, 9), ("paired_lines", "mismatch", 0.1, 900.0, 9)]) == ("paired_lines", False)
    assert chosen(spark, [("text_regex", "n/a", 9e9, 0.0, 0), ("column_position", "match", 0.0, 1000.0, 9)]) == ("text_regex", False)
    assert chosen(spark, [base, ("year_columns", "mismatch", 0.1, 900.0, 9)], [(2, 2, 0.0, 1.0)]) == ("year_columns", False)
    assert chosen(spark, [base, ("year_columns", "mismatch", 0.1, 900.0, 9)], [(3, 0, 0.05, 1.0)]) == ("year_columns", True)
    assert chosen(spark, [match, ("year_columns", "mismatch", 0.1, 900.0, 9)], [(3, 0, 0.05, 1.0)]) == ("text_regex", False)
    assert chosen(spark, [base, ("year_columns", "match", 0.0, 1000.0, 9)], [(1, 1, 0.0, 1.0)]) == ("text_regex", False)


@pytest.mark.parametrize("printed", [7600.0, 7500.0])
def test_extractors_with_the_same_amounts_err_alike(spark, printed):
    """In whatever order each lists them, the earlier extractor stays; as doubles the sums are 7556.289999999999 and 7556.290000000001."""
    amounts = [[1095.35, 1690.52, 3180.61, 1589.81], [1095.35, 1690.52, 1589.81, 3180.61]]
    stats = spark.createDataFrame([("d", [printed], None)], "doc_id string, totals array<double>, total_lines array<array<double>>")
    for orders in (amounts, amounts[::-1]):
        rows = [("d", m, "ALPHA", "cash", None, v) for m, own in zip(("text_regex", "column_position"), orders, strict=True) for v in own]
        rows = spark.createDataFrame(rows, "doc_id string, method string, holder_name_raw string, dividend_type string, shares double, net_amount double")
        scores = T.method_scores(rows.coalesce(1), stats)
        got = {r.method: (r.check, r.error, r.extracted, r.rows) for r in scores.collect()}
        assert got["text_regex"] == got["column_position"] == ("mismatch", abs(7556.29 - printed) / printed, 7556.29, 4)
        assert T.choose_method(scores, spark.createDataFrame([], YEARS)).first().method == "text_regex"


def test_scores_count_total_labelled_rows_in_any_order(spark):
    """Amounts of total-labelled rows are candidates, of their own extractor alone, and the half of their sum is the same in any order."""
    fields = "doc_id string, method string, holder_name_raw string, dividend_type string, shares double, net_amount double"
    own = [("d", "text_regex", "ALPHA", "cash", None, 500.25), ("d", "column_position", "BETA", "cash", None, 500.25), ("d", "paired_lines", "Total", "cash", None, 700.0)]
    extra = [("d", "text_regex", "Grand Total", "cash", None, v) for v in (500.25, 120.5, None, 500.25)]
    stats = spark.createDataFrame([("d", [9000.0], None)], "doc_id string, totals array<double>, total_lines array<array<double>>")
    for rows in (own + extra, extra[::-1] + own):
        got = {r.method: (r.check, r.extracted, r.rows) for r in T.method_scores(spark.createDataFrame(rows, fields).coalesce(1), stats).collect()}
        assert got == {"text_regex": ("match", 500.25, 1), "column_position": ("mismatch", 500.25, 1), "paired_lines": ("n/a", 0.0, 0)}


def test_guards(spark):
    rows = [("d", "ALPHA", None, 2e9, ""), ("d", "Grand Total", None, 5.0, ""), ("d", "X ROAD 5", 3.0, None, ""), ("d", "BETA", None, 2e6, "int_amount"), ("d", "C", None, 1.0, ""), ("d", "D", None, 1.0, "col_amount")]
    df = spark.createDataFrame(rows, "doc_id string, holder_name_raw string, shares double, net_amount double, issues string")
    got = {r.holder_name_raw: (r.net_amount, r.tags) for r in T.guard_rows(df).collect()}
    assert got == {"ALPHA": (None, ["unreadable_amount"]), "X ROAD 5": (None, ["name_looks_like_address"]), "C": (1.0, []), "D": (1.0, ["col_amount"])}


def test_ambiguous_shares(spark):
    rows = [("d", 100.0, [], [1.0]), ("d", None, ["stock_ambiguous_numbers"], [50.0, 20.0]), ("d", None, ["stock_ambiguous_numbers"], [60.0, 30.0]), ("e", None, ["stock_ambiguous_numbers"], [1.0])]
    df = spark.createDataFrame(rows, "doc_id string, shares double, tags array<string>, runs array<double>")
    values = spark.createDataFrame([("d", [150.0])], "doc_id string, candidates array<double>")
    got = sorted((r.doc_id, r.shares or 0, r.tags) for r in T.resolve_ambiguous(df, values).collect())
    assert got == [("d", 20.0, ["shares_last_number_verified_by_total"]), ("d", 30.0, ["shares_last_number_verified_by_total"]), ("d", 100.0, []), ("e", 0, ["stock_ambiguous_numbers"])]


def test_verdicts(spark):
    rows = [("a", "2018", "cash", None, 600.0, []), ("a", "2019", "cash", None, 400.0, []), ("b", "2018", "cash", None, 9.0, ["ocr"]), ("c", "2018", "cash", None, 300.0, []), ("c", "2019", "cash", None, 200.0, []), ("c", "2020", "cash", None, 77.0, [])]
    r = spark.createDataFrame(rows, "doc_id string, dividend_year string, dividend_type string, shares double, net_amount double, tags array<string>")
    s = spark.createDataFrame([("a", [1000.0], [], 0, 0, 0), ("b", [], [], 0, 0, 0), ("c", [300.0, 200.0], [], 0, 0, 1), ("z", [100.0], [], 0, 0, 0)], "doc_id string, totals array<double>, total_lines array<array<double>>, textless_pages int, unparsed_idlike int, unreadable_totals int")
    got = {x.doc_id: (x.total_check, x.status, x.rows_extracted) for x in T.document_verdict(r, s).collect()}
    assert got == {"a": ("match", "parsed", 2), "b": ("no_total_printed", "partial", 1), "c": ("match", "parsed", 3), "z": ("mismatch", "partial", 0)}


STATS = "doc_id string, totals array<double>, total_lines array<array<double>>, textless_pages int, unparsed_idlike int, unreadable_totals int"
ROWS = "doc_id string, holder_name_raw string, dividend_year string, dividend_type string, shares double, net_amount double, issues string"


def verdicts(spark, rows, stats):
    raw = spark.createDataFrame(rows, ROWS)
    kept = T.guard_rows(raw)
    return {r.doc_id: r for r in T.document_verdict(kept, spark.createDataFrame(stats, STATS), T.total_row_values(raw)).collect()}


def test_verdict_counts_total_labelled_rows_and_leaves_small_totals_out(spark):
    item = lambda d, v: (d, "ALPHA TESTER", "2018", "cash", None, v, "")
    rows = [
        item("row", 5000.0), ("row", "Grand Total", "2018", "cash", None, 5000.0, ""),
        item("small", 5000.0),
        item("shares", 40.0), ("shares", "Sub-total", "2018", "cash", 700.0, None, ""),
        item("unreadable", 40.0), ("unreadable", "TOTAL of all", "2018", "cash", None, 2e9, ""),
        item("label", 40.0), ("label", "TOTALLY OTHER", "2018", "cash", None, 5.0, ""),
    ]
    stats = [("row", [], [], 0, 0, 0), ("small", [7.0], [[5000.0, 7.0]], 0, 0, 0), ("shares", None, None, 0, 0, 0), ("unreadable", None, None, 0, 0, 0), ("label", [90.0], None, 0, 0, 0)]
    got = verdicts(spark, rows, stats)
    assert [(d, got[d].total_check, got[d].stated_total) for d in sorted(got)] == [("label", "no_total_printed", None), ("row", "match", 5000.0), ("shares", "mismatch", 0.0), ("small", "no_total_printed", None), ("unreadable", "no_total_printed", None)]
    assert got["row"].rows_extracted == 1 and got["label"].rows_extracted == 2 and got["row"].coverage_pct == 100.0


def test_rows_from_recognised_pages_are_partial(spark):
    rows = T.guard_rows(spark.createDataFrame([("d", "ALPHA", "2018", "cash", None, 500.0, "")], ROWS))
    stats = spark.createDataFrame([("d", [500.0], None, 0, 0, 0)], STATS)
    for n, want in ((0, "parsed"), (3, "partial")):
        (r,) = T.document_verdict(rows, stats.withColumn("ocr_rows", F.lit(n))).collect()
        assert (r.total_check, r.status) == ("match", want)


def test_nearest_as_a_relation(spark):
    """Equal to `nearest` for keys with few, many or no candidates, ties, equal values, nulls and keys that span partitions."""
    import random

    rng = random.Random(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        known = [(k, float(rng.randint(0, 4000)) / 2) for k, n in (("a", 2000), ("b", 1), ("c", 3), (None, 5)) for _ in range(n)]
        values = [(k, rng.choice([None, float(rng.randint(-10, 4100)) / 4]), i) for i, k in enumerate(rng.choices(["a", "b", "c", "none", None], k=800))]
        df = T.nearest_rows(spark.createDataFrame(values, "doc_id string, x double, i int"), spark.createDataFrame(known, "doc_id string, v double"))
        got = {r.i: r.nearest for r in df.collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = {i: None if x is None else min((v for key, v in known if key == k), key=lambda v: (abs(v - x), v), default=None) for k, x, i in values}
    assert got == want and len(got) == 800


def test_nearest_of_a_million_candidates(spark):
    known = spark.range(1_000_000).select(F.lit("k").alias("doc_id"), (F.col("id") * 2.0).alias("v"))
    values = spark.range(5000).select(F.lit("k").alias("doc_id"), (F.col("id") * 397.0 + 0.5).alias("x"))
    df = T.nearest_rows(values, known)
    assert df.filter((F.col("nearest") != F.floor(F.col("x") / 2 + 0.5) * 2) & (F.abs(F.col("nearest") - F.col("x")) > 1)).count() == 0 and df.count() == 5000


def test_ranges_of_nearest_rows_grow_in_number_not_in_length(spark, monkeypatch):
    """One key of many candidates: as many ranges as the rows need, whatever the session's partitions, and the nearest values."""
    written = []
    monkeypatch.setattr(T, "RANGE_ROWS", 100)
    monkeypatch.setattr(T, "stored", lambda df, name: written.append(df.localCheckpoint()) or written[-1])
    known = [(k * 7919) % 10007 / 4 for k in range(1000)]
    values = spark.range(500).selectExpr("id", "'k' AS k", "(id * 613) % 2600 + 0.3D AS x")
    got = T.nearest_rows(values, spark.createDataFrame([("k", v) for v in known], "k string, v double"), "k").collect()
    assert {r.id: r.nearest for r in got} == {r.id: min(known, key=lambda v: (abs(v - r.x), v)) for r in got} and len(got) == 500
    sizes = [r["count"] for r in written[0].groupBy("_part").count().collect()]
    assert len(sizes) >= 10 and max(sizes) < 400
