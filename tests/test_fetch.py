import pytest
from pyspark.sql import functions as F

from talus.functions.sql import register
from talus.sources import fetch as X


def test_attempts():
    said, waits = iter([503, 429, 200]), []
    r = X.attempt(lambda u: X.Response(next(said), u, {}, b""), "u", sleep=waits.append)
    assert r.status == 200 and waits == [3.0, 6.0]
    assert X.attempt(lambda u: X.Response(503, u, {}, b""), "u", tries=2, sleep=waits.append).status == 503
    with pytest.raises(ConnectionError):
        X.attempt(lambda u: (_ for _ in ()).throw(ConnectionError("x")), "u", sleep=lambda s: None)


def test_fetch(spark):
    def get(url):
        if "bad" in url:
            raise ValueError("no")
        return X.Response(404 if "gone" in url else 200, url, {"Content-Type": "application/pdf"}, b"%PDF")

    work = spark.createDataFrame([("1", "http://h/a"), ("2", "http://h/gone"), ("3", "http://i/bad"), ("4", "https://drive.google.com/file/d/abcdefghij12/view")], "id string, url string")
    got = {r.id: r for r in X.fetch(work, get, spacing=0.0).collect()}
    assert (got["1"].status, got["1"].bytes, bytes(got["1"].content)) == ("ok", 4, b"%PDF")
    assert (got["2"].error, got["3"].error) == ("HTTP 404", "ValueError: no")
    assert got["4"].final_url.endswith("id=abcdefghij12&export=download&confirm=t")


def test_sql_functions(spark):
    register(spark)
    r = spark.sql("SELECT fold_digits('১২'), number_of('(1,234.5)'), number_of('1d'), year_start('in 2019'), digits_only('a1-2'), folio_key('a -1'), code_hash(' X ')").first()
    assert tuple(r)[:6] == ("12", 1234.5, None, 2019, "12", "A1") and r[6] == spark.range(1).select(F.sha2(F.lit("x"), 256)).first()[0]


def counted(folder, respond):
    """A client that leaves a file for each request."""
    import uuid
    from pathlib import Path

    def get(url):
        (Path(folder) / uuid.uuid4().hex).write_text(url)
        return respond(url)

    return get


def test_a_hot_host_holds_up_no_other(spark, tmp_path):
    """One task with a host of 30 requests and three of one: these are fetched in the first round of turns. Kept responses are not asked for again."""
    log = tmp_path / "log"
    log.mkdir()
    get = counted(str(log), lambda url: X.Response(200, url, {}, url.encode()))
    work = spark.createDataFrame([(f"h{k:02d}", f"http://hot/{k}") for k in range(30)] + [(h, f"http://{h}/x") for h in ("a", "b", "z")], "id string, url string")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        rows = X.fetch(work, get, spacing=0.0, kept=f"file://{tmp_path}/kept").collect()
        assert {r.id for r in rows[:4]} == {"a", "b", "z", "h00"} and len(rows) == 33
        assert len(list(log.iterdir())) == 33
        again = X.fetch(work, get, spacing=0.0, kept=f"file://{tmp_path}/kept").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sorted(map(str, again)) == sorted(map(str, rows)) and len(list(log.iterdir())) == 33


def test_download(spark, tmp_path):
    """Files, pages with links, pages without, drives, children that are pages again, refusals and errors."""
    from talus.sources import download as D

    html = {"Content-Type": "text/html; charset=utf-8"}

    def respond(url):
        if "page" in url:
            return X.Response(200, url, html, b"<a href='/f/unpaid.pdf'>Unpaid dividend list</a><a href='child.csv'>dividend</a><a href='gone.pdf'>dividend</a><a href='x.html'>no</a>")
        if "empty" in url or "child" in url or "drive" in url:
            return X.Response(200, url, html, b"<p>nothing</p>")
        if "boom" in url:
            raise ValueError("no route")
        return X.Response(404, url, {}, b"") if "gone" in url else X.Response(200, url, {"Content-Type": "text/html"} if "odd" in url else {}, b"%PDF " + url.encode())

    log = tmp_path / "log"
    log.mkdir()
    rows = [("1", "C 1", "List", "http://h/a%20b.pdf", "pdf"), ("2", "C2", "Page", "http://h/page", "html"), ("3", "C2", "Empty", "http://h/empty", "html"), ("4", "C2", "Drive", "https://drive.google.com/file/d/abcdefghij12/view", "gdrive"), ("5", "C2", "Boom", "http://h/boom", "pdf"), ("6", "C2", "Gone", "http://h/gone", "pdf"), ("7", "C2", "Odd", "http://h/odd", "pdf")]
    work = spark.createDataFrame([(*r, "list") for r in rows], "id string, company string, title string, url string, kind string, role string")
    get = counted(str(log), respond)
    manifest, links = D.download(work, get, f"file://{tmp_path}/files", 0.0, f"file://{tmp_path}/kept")
    got = {r.id: r for r in manifest.collect()}
    assert {k: (r.status, r.error) for k, r in got.items()} == {
        "1": ("ok", ""), "2-01": ("ok", ""), "2-02": ("failed", D.NO_CHILD), "2-03": ("failed", "HTTP 404"), "3": ("failed", D.NO_LINKS), "4": ("failed", D.NO_DRIVE), "5": ("failed", "ValueError: no route"), "6": ("failed", "HTTP 404"), "7": ("ok", ""),
    }
    assert (got["1"].local_path, got["2-01"].local_path, got["2-01"].parent_id, got["2-01"].title) == ("C_1/1__a_b.pdf", "C2/2-01__unpaid.pdf", "2", "Unpaid dividend list")
    for k in ("1", "2-01", "7"):
        content = (tmp_path / "files" / got[k].local_path).read_bytes()
        assert content.startswith(b"%PDF http://h/") and got[k].bytes == len(content)
    assert sorted(r.child_id for r in links.collect()) == ["2-01", "2-02", "2-03"]
    assert sum(p.is_file() for p in (tmp_path / "files").rglob("*")) == 3
    # Once more: nothing that came is asked for again; only what failed without a response is.
    n = len(list(log.iterdir()))
    D.download(work, get, f"file://{tmp_path}/files", 0.0, f"file://{tmp_path}/kept")
    assert {p.read_text() for p in sorted(log.iterdir(), key=lambda p: p.stat().st_mtime)[n:]} == {"http://h/boom"}


def test_sql_scalars_are_those_of_columns(spark):
    from talus.functions import scalars as S

    register(spark)
    texts = ["IPO refund", "Rights issue", "right  share", "Fraction", "subscription", "Stock Dividend", "stock & cash dividend", "Unpaid", "list", None, "b  a C", "", '{"x-forwarded-for": "1.2.3.4, 5"}', "{}"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    df.createOrReplaceTempView("texts")
    for name, column in (("dividend_type", S.dividend_type), ("sorted_words", S.sorted_words), ("client_ip", S.client_ip)):
        got, want = spark.sql(f"SELECT s, {name}(s) AS v FROM texts"), df.select("s", column(F.col("s")).alias("v"))
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), name
    assert spark.sql("SELECT stamp(TIMESTAMP '2024-01-02 03:04:05.678')").first()[0] == "2024-01-02 03:04:05"


def test_table_functions(spark):
    """Extractors in SQL text give what they give on DataFrames; columns hold on over a document's pages and not into the next."""
    from talus.operators import records as R

    account = "120100000000000"
    head = "SL   BO ID             Name            Shares      Net Dividend    Remarks"
    row = lambda k: f"1    {account}{k}   ALPHA TESTER    40          {k}50.00          12"
    years = " " * 40 + "2017      Bonus_2018"
    of_year = lambda k: f"1 {account}{k} ALPHA TESTER      12.50            {k}"
    pairs = "13 2019 1234567 MIKE TESTER\n00042 REG 10 1.5 100.00 10.00 90.00"
    rows = [("a", "cash list", 1, f"{head}\n{row(1)}"), ("a", "cash list", 2, row(2)), ("b", "cash list", 1, row(3)), ("c", "cash", 1, f"{years}\n{of_year(4)}"), ("c", "cash", 2, of_year(5)), ("d", "cash", 1, pairs), ("e", None, 1, None)]
    df = spark.createDataFrame(rows, "doc_id string, title string, page int, text string")
    df.createOrReplaceTempView("pages")
    register(spark)
    for name, extract in (("rows_by_column", R.extract_by_column), ("rows_by_year_column", R.extract_year_columns), ("rows_of_paired_lines", R.extract_paired)):
        got = spark.sql(f"SELECT * FROM {name}(TABLE(pages) PARTITION BY doc_id ORDER BY page)").collect()
        assert sorted(map(str, got)) == sorted(map(str, extract(df).collect())) and len(got) >= 1, name
    lines = spark.sql(f"SELECT r.holder_name_raw, r.net_amount FROM VALUES ('1 {account}1 BETA TESTER 5.00'), ('no row'), (NULL) AS t(line), LATERAL listing_record(line, '2018', 'cash') AS r")
    assert [tuple(r) for r in lines.collect()] == [("BETA TESTER", 5.0)]


def test_table_function_of_year_columns_reads_a_line_once():
    """Python's calls for a line with three numbers, rows handed over among them; columns hold on over pages, and pages without text give nothing."""
    import sys

    from pyspark.sql import Row

    from talus.functions import sql

    years = " " * 35 + "".join(str(2017 + k).rjust(20) for k in range(3))
    line = "1 1201000000000001 HOLDER ALPHA    " + "".join(f"{1000.5 * k:20.2f}" for k in (1, 2, 3))
    page = lambda k, text: Row(doc_id="d", title="Dividend list", page=k, text=text)
    own, calls = sql.TABLES["rows_by_year_column"]().func(), 0
    assert [len(list(own.eval(page(k, text)))) for k, text in ((1, line), (2, years), (3, None), (4, line))] == [0, 0, 0, 3]

    def count(_, event, __):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    rows = list(own.eval(page(5, "\n".join([line] * 200))))
    sys.setprofile(None)
    assert [r[13] for r in rows[:3]] == [1000.5, 2001.0, 3001.5] and len(rows) == 600 and calls < 100 * 200
