import random

import pytest

from talus.operators import lines as L, records as R

ID = "120100000000000"


def parsed(line, kind="cash", **kw):
    return R.parse_record(line, "", kind, **kw)


@pytest.mark.parametrize(
    ("line", "kind", "want"),
    [
        (f"1 {ID}1 ALPHA TESTER 1,000.00 150.00 850.00", "cash", dict(bo_id=ID + "1", holder_name_raw="ALPHA TESTER", gross_amount=1000, tax_amount=150, net_amount=850, issues="")),
        (f"2 BETA TESTER {ID}2 500.00 50.00 450.00", "cash", dict(bo_id=ID + "2", holder_name_raw="BETA TESTER", net_amount=450, warrant_no="")),
        ("3 F-00123 GAMMA TESTER 90.00 10.00 80.00", "cash", dict(bo_id="", folio_no="F-00123", net_amount=80)),
        (f"4 {ID}3 DELTA TESTER 500", "cash", dict(net_amount=500, issues="int_amount")),
        (f"5 {ID}4 ECHO TESTER 1000.00 100.00 50.00 850.00", "cash", dict(gross_amount=1000, tax_amount=150, net_amount=850)),
        (f"6 {ID}5 FOXTROT TESTER 100.00 20.00 70.00", "cash", dict(net_amount=70, issues="gross_tax_net_mismatch")),
        (f"7 {ID}6 GOLF TESTER (500.00)", "cash", dict(net_amount=500)),
        (f"9 {ID}8 INDIA TESTER 25", "stock", dict(shares=25, net_amount=None)),
        (f"10 {ID}9 JULIET TESTER 100 25", "stock", dict(shares=None, issues="stock_ambiguous_numbers")),
        (f"1 {ID}1 2018-19 ALPHA 5.00", "cash", dict(dividend_year="2018-19", warrant_no="", net_amount=5)),
        (f"{ID}1 7777777 ALPHA TESTER 1,000 .50 9.00", "cash", dict(warrant_no="7777777", net_amount=9)),
    ],
)
def test_layouts(line, kind, want):
    row = parsed(line, kind)
    assert {k: row[k] for k in want} == want


@pytest.mark.parametrize("line", ["GAMMA TESTER 80.00", "Grand Total 1,234.50", "a b", "1 2 3 4", f"{ID}1 X 5.00", f"{ID}1 ALPHA TESTER none"])
def test_no_row(line):
    assert parsed(line) is None


def test_triples():
    assert R.triple("100 20 80 1000 100 900".split())[1] == (1000, 100, 900)
    assert R.triple("1000 7 100 3 900".split())[1] == (1000, 100, 900)
    assert R.triple("1000 1 1 1 1 100 900".split())[1] is None
    assert R.triple(["1,000", ".50", "0.50", "1000.00"])[1] == (1000.5, 0.5, 1000.0)


def test_native_triple_agrees(spark):
    import random

    from pyspark.sql import functions as F

    from talus.functions.scalars import amount_triple

    rng = random.Random(2)
    rows = []
    for k in range(400):
        v = [float(rng.choice([0, 1, 2, 5, 10, 20, 30, 35])) for _ in range(rng.randint(0, 8))]
        rows.append((k, v))
    df = spark.createDataFrame(rows, "k long, v array<double>").select("k", amount_triple(F.col("v")).alias("t"))
    for r in df.collect():
        want = R.triple([f"{x:.0f}" for x in rows[r.k][1]])[1]
        assert (tuple(r.t) if r.t else None) == want, rows[r.k]


PAGE = "\n".join(
    [
        "Unclaimed cash dividend for the year 2018-19", "", "11 2018 123456 900.00", "KILO TESTER 10 100.00 800.00", "12 2018 1234567 LIMA TESTER", "", "900.00 100.00 800.00",
        f"1 {ID}1 ALPHA TESTER 1000.00 150.00 850.00", "Total 1000.00 150.00 850.00", "Stock Dividend for the year 2019-20", f"2 {ID}2 BETA TESTER 25", "Grand Total 25", "Total 2018 #####", f"{ID}3 9 9",
    ]
)


@pytest.fixture
def pages(spark):
    rows = [("d1", "Dividend list", 1, PAGE), ("d1", "Dividend list", 2, "short"), ("d1", "Dividend list", 3, f"9 {ID}8 NEXT PAGE 7 and words to be long enough"), ("d2", None, 1, None)]
    return spark.createDataFrame(rows, "doc_id string, title string, page int, text string")


def test_wrapped_lines(pages):
    got = [r.line for r in L.join_wrapped(L.explode_lines(pages.select("doc_id", "page", "text"))).orderBy("page", "line_no").collect()]
    assert "11 2018 123456 KILO TESTER 10 100.00 800.00" in got and "12 2018 1234567 LIMA TESTER 900.00 100.00 800.00" in got
    assert "900.00 100.00 800.00" not in got and len(got) == 12


def test_joined_lines_are_those_of_the_windows_without_a_shuffle(spark, pages):
    """Halves, names, amounts, blank and nearly blank lines in any order, at a page's ends too."""
    rng = random.Random(11)
    kinds = ["", "  ", "\t", "7 2018 123456 5.00", "7 2018 123456 LIMA", "7 2018 1234 x 3.00 4.00", "LIMA TESTER 10 100.00", "900.00 100.00", " 8 2019 222222 9 ", f"{ID}1 ALPHA 7.00", "plain words", "7 2018", "\u00a07\u20032018 123456 LIMA\u00a0"]
    rows = [(f"e{k % 7}", None, k, "\n".join(rng.choice(kinds) for _ in range(rng.randint(1, 14))) + rng.choice(["", "\n", "\n \n"])) for k in range(400)]
    df = pages.unionByName(spark.createDataFrame(rows, pages.schema)).select("doc_id", "page", "text")
    plan = L.joined_lines(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
    got, want = ([tuple(r) for r in f.orderBy("doc_id", "page", "line_no").collect()] for f in (L.joined_lines(df), L.join_wrapped(L.explode_lines(df))))
    assert got == want and len({r[:2] for r in got}) > 300


def test_document_fold(pages):
    events = R.extract_records(pages)
    rows = {r.holder_name_raw: r for r in R.record_rows(events).collect()}
    assert rows["ALPHA TESTER"].net_amount == 850 and rows["ALPHA TESTER"].dividend_year == "2018-19"
    assert (rows["BETA TESTER"].shares, rows["BETA TESTER"].dividend_year, rows["BETA TESTER"].dividend_type) == (25, "2019-20", "stock")
    assert rows["NEXT PAGE"].dividend_type == "stock" and rows["NEXT PAGE"].row_on_page == 1
    stats = {r.doc_id: r for r in R.document_stats(events, pages).collect()}
    assert (stats["d1"].pages, stats["d1"].textless_pages, stats["d1"].stated_total, stats["d1"].unreadable_totals, stats["d1"].unparsed_idlike) == (3, 1, 25, 1, 1)
    assert stats["d2"].rows == 0 and stats["d2"].textless_pages == 1


def test_column_extractor(spark):
    head = "SL   BO ID             Name            Shares      Net Dividend    Remarks"
    row = f"1    {ID}1   ALPHA TESTER    40          850.00          12"
    nameless = f"     {ID}2                   40          77.00           12"
    df = spark.createDataFrame([("d", "cash dividend list", 1, "\n".join([head, row, nameless, "Total  927.00"]))], "doc_id string, title string, page int, text string")
    got = {r.bo_id: r for r in R.extract_by_column(df).collect()}
    assert (got[ID + "1"].net_amount, got[ID + "1"].issues) == (850, "col_amount")
    assert (got[ID + "2"].net_amount, got[ID + "2"].issues) == (77, "name_missing;col_amount")


def test_paired_extractor(spark):
    ids = ["13 2019 1234567 MIKE TESTER", "14 2019 1234568 NOVEMBER TESTER    note"]
    amounts = ["00042 10 1.5 100.00 10.00 90.00", "00043 REG 10 1.5 200.00 20.00 180.00"]
    df = spark.createDataFrame([("d", 1, "\n".join([*ids, *amounts])), ("d", 2, "\n".join([*ids, amounts[0]]))], "doc_id string, page int, text string")
    got = {r.holder_name_raw: r for r in R.extract_paired(df).collect()}
    assert len(got) == 2 and got["MIKE TESTER"].folio_no == "" and got["NOVEMBER TESTER"].folio_no == "00043" and got["NOVEMBER TESTER"].net_amount == 180


def test_year_columns(spark):
    head = " " * 40 + "2017      Bonus_2018"
    row = f"1 {ID}1 ALPHA TESTER      12.50            5"
    df = spark.createDataFrame([("d", "cash dividend", 1, head + "\n" + row)], "doc_id string, title string, page int, text string")
    got = sorted((r.dividend_year, r.dividend_type, r.net_amount, r.shares) for r in R.extract_year_columns(df).collect())
    assert got == [("2017", "cash", 12.5, None), ("2018", "stock", None, 5.0)]


def test_triage(spark):
    rows = [("a", 1, "x" * 90), ("a", 2, "y" * 90), ("b", 1, "x" * 90), ("b", 2, ""), ("c", 1, None), ("d", 1, "ক" * 90)]
    got = {r.doc_id: (r.pdf_kind, r.lang) for r in R.classify_documents(spark.createDataFrame(rows, "doc_id string, page int, text string")).collect()}
    assert got == {"a": ("text", "en"), "b": ("mixed", "en"), "c": ("scanned", "en"), "d": ("text", "bn")}


def test_pages_and_sample(spark):
    df = spark.createDataFrame([("a", "1\f২\f3\f4\f5"), ("b", None)], "doc_id string, text string")
    pages = L.split_pages(df)
    assert [(r.page, r.text) for r in pages.filter("doc_id = 'a'").orderBy("page").collect()][:2] == [(1, "1"), (2, "2")]
    assert sorted(r.page for r in L.page_sample(pages).filter("doc_id = 'a'").collect()) == [1, 3, 5]


def walked(pages):
    """Events of one document by a walk from its first line to its last; wrapped lines do not occur here."""
    year, kind, fresh, out = "", None, True, []
    for page, text in sorted(pages):
        if len((text or "").strip(" ")) < 40:
            continue
        n = 0
        lines = text.split("\n")
        if fresh:
            c = R._Context()
            R._begin(c, "Dividend list", lines[:8], True)
            year, kind, fresh = c.year, c.kind, False
        for k, line in enumerate(lines, 1):
            if row := R.parse_record(line, year, kind):
                n += 1
                out.append((page, k, "row", n, row["dividend_year"], row["dividend_type"], row["folio_no"], row["shares"], row["net_amount"]))
                continue
            low = line.lower()
            before = year, kind
            year, kind = R.follow(line, before)
            if "total" in low:
                if "###" in line:
                    out.append((page, k, "unreadable_total"))
                elif any(map(R.is_amount, line.split())):
                    out.append((page, k, "total"))
            elif any(R._BO.match(t) for t in line.split()):
                out.append((page, k, "unparsed_id"))
    return out


def random_pages(rng, n):
    headings = ["Dividend for the year 2018-19", "Dividend year 2018", "Year 2017 and cash dividend", "Stock Dividend list", "Bonus 2016 of the year", "right share 2015", "Fraction money FY 2014", "refund of subscription", "AGM", "a line of plain words"]
    # Some lines are rows or headings depending on what holds: on the year as an identifier, on the type by the numbers.
    both = ["2018 year ALPHA 7", "2018 2 bonus BETA 9 9", "2016 dividend GAMMA 2018 5.00", "2017 agm DELTA", "2018-19 year 2014 EPSILON 1.00", f"1 {ID}1 bonus ZETA 4 5 6", "7 F-1 cash div ETA 3"]
    rows = [f"1 {ID}1 ALPHA TESTER 100.00 10.00 90.00", f"2 {ID}2 BETA TESTER 25", "3 F-77 GAMMA TESTER 50.00", "2018 F-78 DELTA TESTER 7 9", f"{ID}3 nothing", "Grand Total 50.00", "Total ####", "Total of the year 2013"]
    pages = []
    for k in range(n):
        lines = [rng.choice(rng.choice([rows, rows, headings, both])) for _ in range(rng.randint(0, 5))] if rng.random() < 0.8 else rows[:2]
        pages.append((k + 1, "\n".join([*lines, "words that make the page long enough to be read"]) if rng.random() < 0.9 else "short"))
    return pages


@pytest.mark.parametrize("fan", [512, 3])
def test_scan_over_pages_equals_a_walk(spark, monkeypatch, fan):
    """Documents of many lengths; with blocks of three pages there are several levels of them."""
    import random

    from talus.operators import scan

    monkeypatch.setattr(scan, "FAN", fan)
    rng = random.Random(7)
    docs = {f"d{k}": random_pages(rng, n) for k, n in enumerate([1, 2, 3, 4, 9, 10, 27, 28, 90])}
    rows = [(d, "Dividend list", p, t) for d, pages in docs.items() for p, t in pages]
    rng.shuffle(rows)
    events = R.extract_records(spark.createDataFrame(rows, "doc_id string, title string, page int, text string").repartition(5)).collect()
    for d, pages in docs.items():
        got = sorted((r.page, r.line_no, r.event, *((r.row_on_page, r.dividend_year, r.dividend_type, r.folio_no, r.shares, r.net_amount) if r.event == "row" else ())) for r in events if r.doc_id == d)
        assert got == sorted(walked(pages)), d
    assert {r.dividend_type for r in events if r.event == "row"} >= {"cash", "stock", "right"}


def test_maps_compose():
    import random

    from talus.operators import scan

    rng = random.Random(3)
    years = ["2014", "2015", "2016", "2018", "2018-19"]
    for _ in range(100):
        maps = [R.page_map(t.split("\n")) for _, t in random_pages(rng, 3)]
        whole = scan.compose(scan.compose(maps[0], maps[1]), maps[2])
        assert whole == scan.compose(maps[0], scan.compose(maps[1], maps[2]))
        for state in [(y, k) for y in ["", "1999", *years] for k in scan.KINDS]:
            assert scan.after(scan.unpacked(scan.packed(whole)), state) == scan.after(maps[2], scan.after(maps[1], scan.after(maps[0], state)))


def test_a_long_document_is_many_tasks(spark):
    """100,000 pages of one document: the pages are read by many tasks, each with the year of the heading before it."""
    from pyspark.sql import functions as F

    n = 100_000
    line = F.concat(F.lit("1 F-"), F.col("id").cast("string"), F.lit(" ALPHA TESTER OF A LONG ENOUGH PAGE 5.00"))
    text = F.when(F.col("id") % 1000 == 0, F.concat(F.lit("Dividend for the year "), (1950 + F.col("id") / 1000).cast("int").cast("string"), F.lit("\n"), line)).otherwise(line)
    pages = spark.range(n).select(F.lit("d").alias("doc_id"), F.lit("list").alias("title"), (F.col("id") + 1).cast("int").alias("page"), text.alias("text"))
    df = R.record_rows(R.extract_records(pages)).withColumn("task", F.spark_partition_id())
    want = (1950 + F.floor((F.col("page") - 1) / 1000)).cast("string")
    r = df.agg(F.count("*"), F.count_if(F.col("dividend_year") != want), F.count_distinct("task")).first()
    assert (r[0], r[1]) == (n, 0) and r[2] > 1


def test_stated_total_is_the_last_in_place(spark):
    """Several grand totals on a page: the last by line, not by its wording; totals and their lines in order."""
    text = "\n".join(["Dividend for the year 2018 and more words", "Grand Total of section Z 1.00 500.00", "Grand Total of all 700.00", "Total of section A 9,000.00"])
    df = spark.createDataFrame([("d", "t", 2, text), ("d", "t", 1, "Total of the first page in many words 3.00"), ("e", "t", 1, "Total one in a line that is long enough 5.00 7.00\nTotal two 6.00")], "doc_id string, title string, page int, text string")
    got = {r.doc_id: r for r in R.document_stats(R.extract_records(df), df).collect()}
    assert (got["d"].stated_total, got["d"].totals, got["d"].total_lines) == (700.0, [3.0, 500.0, 700.0, 9000.0], [[1.0, 500.0]])
    assert (got["e"].stated_total, got["e"].totals, got["e"].total_lines) == (7.0, [7.0, 6.0], [[5.0, 7.0]])


def by_year_columns(pages, slack=7, most=1_000_000.0):
    """Rows of one document's pages (title, page, text) as defined: every word of every line is held against every column."""
    columns = None
    for title, page, text in pages:
        base, lines, n = R.type_of(title or ""), text.split("\n"), 0
        columns = R.find_year_columns(lines) or columns
        for line in lines if columns else ():
            if R._skipped(line):
                continue
            account, row = R._LONG_ID.search(line), R.parse_record(line.strip(), "", base, need_amount=False)
            if not account and not row:
                continue
            row = row or dict(warrant_no="", folio_or_bo_raw=account.group(1), bo_id=account.group(1), folio_no="", holder_name_raw="")
            issues = "year_column" if row.get("line") else "name_missing;year_column"
            for _, end, token in R._spans(line):
                year, kind, at = min(columns, key=lambda c: abs(c[2] - end))
                if not R._NUMBER.match(token) or abs(at - end) > slack or not ("." in token or kind in ("bonus", "right", "stock") or base in R.SHARE_TYPES):
                    continue
                v, own = R.value(token), "stock" if kind == "bonus" else kind or base
                if v and v <= most:
                    n += 1
                    share = own in R.SHARE_TYPES
                    yield ("d", page, n, year, own, *(row[c] for c in ("warrant_no", "folio_or_bo_raw", "bo_id", "folio_no", "holder_name_raw")), v if share else None, None, None, None if share else v, issues, line.strip()[:300])


def test_year_columns_equal_the_definition():
    import random

    rng = random.Random(5)
    words = [ID + "1", ID + "12", "12345678901234567", "৪২", "7", "7", "42.50", "1,250.00", "(3.00)", "-8.25", ".5", "5.", "1,2,3", "2,000,000.00", "0.00", "2018-19", "2017–2018", "ALPHA", "BETA", "আলফা", "A1", "F-77", "x", "TOTAL", "(", "-", "9" * 400 + ".0", "12.5.5", "+7"]
    heads = ["2017      Bonus_2018     2019-20", "Cash 2016   Stock 2017", "Right 2015 Fraction-2016          2017 - 18", "2018", f"2017 2018 {ID}1"]
    kinds = set()
    for _ in range(400):
        pages = []
        for page in range(1, rng.randint(2, 5)):
            lines = [" " * rng.randint(0, 40) + rng.choice(heads)] * (rng.random() < 0.6)
            for _ in range(rng.randint(0, 6)):
                lines.append(rng.choice(["", " ", "1 "]) + "".join(w + rng.choice([" ", "  ", "\t", "\u00a0", " " * rng.randint(1, 12)]) for w in rng.choices(words, k=rng.randint(0, 7))))
            pages.append((rng.choice([None, "cash dividend", "right share list", "Bonus list", "fraction"]), page, "\n".join(lines)))
        slack = rng.choice([0, 7, 30])
        own = R.year_column_rows(slack)
        got = [row for t, p, x in pages for row in own({"doc_id": "d", "title": t, "page": p, "text": x})]
        assert got == list(by_year_columns(pages, slack))
        kinds |= {(r[4], r[14]) for r in got}
    assert kinds >= {(k, i) for k in ("cash", "stock", "right", "fraction") for i in ("year_column", "name_missing;year_column")}


def test_year_columns_read_a_line_once():
    """Python's calls for a line with three numbers: its own amounts are not read, and columns are not searched for each word."""
    import sys

    head = " " * 35 + "".join(str(2017 + k).rjust(20) for k in range(3))
    line = f"1 {ID}1 HOLDER ALPHA    " + "".join(f"{1000.5 * k:20.2f}" for k in (1, 2, 3))
    page = {"doc_id": "d", "title": "Dividend list", "page": 1, "text": "\n".join([head, *[line] * 200])}
    own, calls = R.year_column_rows(), 0
    list(own(page))

    def count(_, event, __):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    rows = list(own(page))
    sys.setprofile(None)
    assert len(rows) == 600 and calls < 100 * 200


def test_year_columns_of_some_fields(spark):
    head = " " * 40 + "2017      Bonus_2018"
    df = spark.createDataFrame([("d", "cash dividend", 1, head + f"\n1 {ID}1 ALPHA TESTER      12.50            5")], "doc_id string, title string, page int, text string")
    got = R.extract_year_columns(df, columns=["net_amount", "bo_id"])
    assert got.columns == ["net_amount", "bo_id"] and sorted(map(tuple, got.collect()), key=str) == [(12.5, ID + "1"), (None, ID + "1")]
