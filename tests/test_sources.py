import json
import uuid
from pathlib import Path

from pyspark.sql import functions as F, types as T

from talus import schemas
from talus.functions import scalars as S
from talus.sources import pages, readers, sinks
from talus.streaming import ingest


def test_csv_and_json(spark, tmp_path):
    (tmp_path / "w.csv").write_text('﻿id,company,bytes\n1,"A, ""b""",5\n2,,x\n', encoding="utf-8")
    got = readers.read_csv(spark, str(tmp_path / "w.csv"), schemas.MANIFEST).select("id", "company", "bytes", "sha256").collect()
    assert [tuple(r) for r in got] == [("1", 'A, "b"', 5, None), ("2", None, None, None)]
    assert readers.read_csv_text(spark, str(tmp_path / "w.csv"), ["id", "company"]).collect()[1].company == ""
    (tmp_path / "s.json").write_text(json.dumps({"doc_id": "d", "totals": [1.5, 2], "total_lines": [[1, 2]]}, indent=1))
    r = readers.read_stats(spark, str(tmp_path / "s.json")).first()
    assert r.totals == [1.5, 2.0] and r.total_lines == [[1.0, 2.0]] and r.ocr is None
    assert [x.id for x in readers.list_ids(spark, str(tmp_path), ".csv").collect()] == ["w"]


def numbered(n):
    return "".join(f"page {k} of {n} 日本\nline\f" for k in range(1, n + 1))


def counting(folder):
    """An extractor that leaves a file for each chunk that is opened; made here, since workers don't know this module."""

    class Counting(pages.FormFeeds):
        def texts(self, file, place, first, wanted):
            (Path(folder) / f"{first}-{uuid.uuid4().hex}").write_text(",".join(map(str, wanted)))
            return pages.FormFeeds.texts(self, file, place, first, wanted)

    return Counting()


def test_pages_come_in_chunks(spark, tmp_path):
    """A file of 1,050 pages in chunks of 100, others short, empty or without a last form feed; every page once, whatever the chunk."""
    (tmp_path / "in" / "sub").mkdir(parents=True)
    for name, text in {"big.txt": numbered(1050), "one.v2.txt": "alone", "none.txt": "", "feeds.txt": "\f\fx\f", "sub/two.txt": "a\fb"}.items():
        (tmp_path / "in" / name).write_text(text, encoding="utf-8")
    (tmp_path / "in" / "bad.txt").write_bytes(b"\xff\xfe\fok")
    files = pages.list_files(spark, str(tmp_path / "in"))
    plan = pages.plan_chunks(files, pages.FormFeeds()).collect()
    assert sorted((r.first, r.last) for r in plan if r.doc_id == "big") == [(k, min(k + 99, 1050)) for k in range(1, 1051, 100)]
    got = {}
    for r in pages.read_pages(spark, str(tmp_path / "in"), pages.FormFeeds()).collect():
        assert (r.doc_id, r.page) not in got
        got[r.doc_id, r.page] = r.text
    assert [got.pop(("big", k)) for k in range(1, 1051)] == numbered(1050).split("\f")[:-1]
    assert got == {("one.v2", 1): "alone", ("feeds", 1): "", ("feeds", 2): "", ("feeds", 3): "x", ("two", 1): "a", ("two", 2): "b", ("bad", 1): "\ufffd\ufffd", ("bad", 2): "ok"}
    whole = {r.doc_id: (r.pages, r.text) for r in pages.read_documents(spark, str(tmp_path / "in"), pages.FormFeeds()).collect()}
    assert whole["big"] == (1050, numbered(1050)) and whole["two"] == (2, "a\fb\f") and "none" not in whole


def test_only_wanted_pages_are_read(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "d.txt").write_text(numbered(1000), encoding="utf-8")
    for wanted, pages_there, opened in ((F.col("page").isin(3, 450, 451, 1001), [3, 450, 451], {"1": "3", "401": "450,451"}), (pages.sampled(), [1, 501, 1000], {"1": "1", "501": "501", "901": "1000"})):
        log = tmp_path / uuid.uuid4().hex
        log.mkdir()
        got = pages.read_pages(spark, str(tmp_path / "in"), counting(str(log)), wanted).orderBy("page").collect()
        assert [(r.page, r.text) for r in got] == [(k, f"page {k} of 1000 日本\nline") for k in pages_there]
        assert {f.name.split("-")[0]: f.read_text() for f in log.iterdir()} == opened


def test_form_feeds_across_blocks(monkeypatch):
    import io
    import random

    rng = random.Random(1)
    for block in (1, 2, 3, 7, 64):
        monkeypatch.setattr(pages.FormFeeds, "BLOCK", block)
        for _ in range(40):
            texts = ["".join(rng.choice("ab日\n") for _ in range(rng.randint(0, 6))) for _ in range(rng.randint(1, 9))]
            raw = "\f".join(texts).encode() + b"\f" * rng.randint(0, 1)
            want = raw.decode().split("\f")
            want = want if want[-1] else want[:-1]
            size = rng.randint(1, 4)
            plan = list(pages.FormFeeds().chunks(io.BytesIO(raw), size))
            assert [(a, z) for a, z, _ in plan] == [(k + 1, min(k + size, len(want))) for k in range(0, len(want), size)]
            for first, last, place in plan:
                some = [k for k in range(first, last + 1) if rng.random() < 0.7]
                assert list(pages.FormFeeds().texts(io.BytesIO(raw), place, first, some)) == [want[k - 1] for k in some]


def test_unreadable_files_are_rows_with_an_error(spark, tmp_path):
    df = spark.createDataFrame([(f"file:{tmp_path}/missing.txt", "missing")], "file string, doc_id string")
    (r,) = pages.plan_chunks(df, pages.FormFeeds()).collect()
    assert r.error.startswith("FileNotFoundError") and r.first is None
    assert pages.read_chunks(pages.plan_chunks(df, pages.FormFeeds()), pages.FormFeeds()).collect() == []


def test_links(spark):
    html = """<a href="/a/unclaimed.pdf">x</a> <A class=z HREF='b.xlsx?y=1'>Dividend <b>list</b></A> <a href="c.html">dividend</a> <iframe src="https://o.net/unpaid.pdf"></iframe> <a href="/a/unclaimed.pdf">again</a> <a href="q?wpdmdl=5">n</a>"""
    df = spark.createDataFrame([(1, "https://h.com/dir/page?x=1", html), (2, "https://h.com", None)], "page_id long, url string, html string")
    links = readers.page_links(df)
    assert [(r.link, r.text) for r in links.orderBy("position").collect()] == [("https://h.com/a/unclaimed.pdf", "x"), ("https://h.com/dir/b.xlsx?y=1", "Dividend list"), ("https://h.com/dir/q?wpdmdl=5", "n"), ("https://o.net/unpaid.pdf", "embedded")]
    parents = spark.createDataFrame([(1, "c")], "id long, company string")
    assert sorted(r.child_id for r in readers.child_documents(links, parents).collect()) == ["1-01", "1-02", "1-03", "1-04"]


def test_work_and_upserts(spark):
    work = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "c")], "id string, v string")
    done = spark.createDataFrame([("1",), ("2-01",)], "id string")
    assert [r.id for r in ingest.undone(work, done).collect()] == ["3"]
    old = spark.createDataFrame([("1", "o"), ("2-01", "o"), ("4", "o")], "id string, v string")
    assert sorted((r.id, r.v) for r in sinks.upsert(old, work.filter("id = '2'"), work).collect()) == [("2", "b"), ("4", "o")]
    assert sorted(r.id for r in sinks.insert_or_ignore(old, work, "id").collect()) == ["1", "2", "2-01", "3", "4"]
    assert sinks.purge(old, F.col("id") == "4").count() == 2


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(k, f"v{k}") for k in range(10)], "id long, v string")
    written = sinks.write_marts({"a": df, "b": df.limit(0)}, str(tmp_path), skip_empty=("b",))
    assert written == ["a"] and spark.read.parquet(str(tmp_path / "a")).count() == 10
    out = str(tmp_path / "sent")
    ingest.in_batches(df.coalesce(1), lambda rows: open(out, "a").write(f"{len(rows)}\n"), size=4)
    assert open(out).read().split() == ["4", "4", "2"]
    sinks.write_csv(df, str(tmp_path / "csv"), ["v"])
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).columns == ["v"]
    numbered = sinks.batch_number(df, ["id"], 1)
    assert numbered.groupBy("batch").count().agg(F.max("count")).first()[0] == 1
    items = spark.createDataFrame([("c", 5.0)], "company string, net double")
    assert "| c | 5.00 |" in sinks.summary(items, items, spark.createDataFrame([("parsed",)], "status string"))


def test_scalars(spark):
    def value(c):
        return spark.range(1).select(c.alias("x")).first().x

    lit = F.lit
    assert value(S.fold_digits(lit("৮১২০"))) == "8120"
    assert value(S.tokens(lit(" a b  c "))) == ["a", "b", "c"] and value(S.tokens(lit(None).cast("string"))) == []
    assert [value(S.number(lit(t))) for t in ("1,234.50", "(500)", "-3", "nan", "1.0d", "")] == [1234.5, 500.0, -3.0, None, None, None]
    assert value(S.year_span(lit("for 2018 – 19 and"))) == "2018 – 19" and value(S.year_start(lit("x 1999-00"))) == 1999
    assert [value(S.dividend_type(lit(t))) for t in ("IPO refund", "Rights issue", "Fraction", "subscription", "Stock Dividend", "stock & cash dividend", "Unpaid", "list")] == ["ipo_refund", "right", "fraction", "other", "stock", "cash", "cash", None]
    assert value(S.dividend_type(lit("list"), lit("stock"))) == "stock"
    assert value(S.normal_name(lit("Mr. Md. Çhaudhury, late-Begam"))) == "MOHAMMAD CHAUDHURY BEGUM".replace("CHAUDHURY", "CHOWDHURY")
    assert value(S.is_institution(lit("Alpha Bank"))) and not value(S.is_institution(lit("Banker")))
    assert value(S.slug(lit("  Ä b/c--d!! "))) == "Ä_b_c--d" and value(S.slug(lit("!!"))) == "file"
    assert value(S.lakh(lit(1234567.8))) == "12,34,567.80" and value(S.lakh(lit(999.0), 0)) == "999" and value(S.lakh(lit(123456.0), 0)) == "1,23,456"
    assert value(S.grouped_digits(lit("1234-5678 9"))) == "1234 5678 9"
    assert value(S.drive_id(lit("https://x/file/d/abcdefghij_KL/view"))) == "abcdefghij_KL" and value(S.drive_id(lit("https://x/?id=1234567890"))) == "1234567890"
    assert value(S.client_ip(lit('{"x-forwarded-for": "1.2.3.4, 5.6.7.8"}'))) == "1.2.3.4" and value(S.client_ip(lit(None).cast("string"))) == "unknown"
    assert value(S.sniffed_suffix(lit(b"%PDF-1"), lit(""), lit(""), lit("u"))) == ".pdf" and value(S.sniffed_suffix(lit(b"x"), lit("text/html"), lit('attachment; filename="a.B.XLS"'), lit("u"))) == ".xls"
    assert value(S.sniffed_suffix(lit(b"x"), lit(None).cast("string"), lit(None).cast("string"), lit("http://h/a.DOCX?x"))) == ".docx"
    assert value(S.code_hash(lit(" AbC "))) == value(F.sha2(lit("abc"), 256))
    assert value(S.label(lit("b"), {"a": "A"})) == "b" and value(S.keyword(lit("(Net):"))) == "net"


def test_to_fetch(spark):
    work = spark.createDataFrame([("1", "list"), ("2", "list"), ("3", "reference_only"), ("4", None)], "id string, role string")
    seen = spark.createDataFrame([("1", "ok"), ("1-01", "failed"), ("2-02", "failed"), ("9", "ok")], "id string, status string")
    ids = lambda **how: sorted(r.id for r in ingest.to_fetch(work, seen, **how).collect())
    assert ids() == ["2", "4"] and ids(only=["1", "3"]) == ["1"] and ids(reference=True) == ["2", "3", "4"]
    assert ids(retry_failed=True) == ["2"] and ids(only=["1", "4"], retry_failed=True) == ["1"]


def test_tables_are_rebuilt_by_their_declarations(spark):
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.LongType()), T.StructField("missing", T.DoubleType())])
    for rows in ([(1, "a")], [(2, "b"), (3, "c")]):
        sinks.rebuild_tables({"rebuilt": spark.createDataFrame(rows, "n int, id string").withColumn("extra", F.lit(1))}, {"rebuilt": schema})
    assert sorted(tuple(r) for r in spark.table("rebuilt").collect()) == [("b", 2, None), ("c", 3, None)] and spark.table("rebuilt").schema == schema


def test_appended_links_stay(spark, tmp_path):
    df = spark.createDataFrame([("1", "1-01")], "parent_id string, child_id string").coalesce(1)
    sinks.append_csv(df, f"{tmp_path}/links")
    sinks.append_csv(df, f"{tmp_path}/links")
    assert [tuple(r) for r in readers.read_csv(spark, f"{tmp_path}/links", df.schema).collect()] == [("1", "1-01")] * 2


def test_dot_segments_and_bengali_names(spark):
    urls = ["http://h/a/../b", "http://h/../b/.", "http://h/a/b/..", "http://h/a?x=/../", "mailto:x", "http://h/a..b/c"]
    df = spark.createDataFrame([(u,) for u in urls], "u string").select(S.without_dots(F.col("u")))
    assert [r[0] for r in df.collect()] == ["http://h/b", "http://h/b/", "http://h/a/", "http://h/a?x=/../", "mailto:x", "http://h/a..b/c"]
    names = [("মোঃ করিম", "MOH KRIM"), ("md. Élan", "MOHAMMAD ELAN"), (None, ""), ("রহমান ১২", "RHMAAN 12")]
    df = spark.createDataFrame(names, "a string, b string").select(S.normal_name(F.col("a")), "b")
    assert all(r[0] == r[1] for r in df.collect())


def workbook(path, sheets, shared=()):
    import zipfile
    from xml.sax.saxutils import escape

    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}>" + "".join(f"<si>{x}</si>" for x in shared) + "</sst>")
        for k, rows in enumerate(sheets, 1):
            body = "".join(f'<row r="{r}">' + "".join(f'<c r="{at}{r}" t="{t}">' + (f"<is><t>{escape(v)}</t></is>" if t == "inlineStr" else "" if v is None else f"<v>{escape(v)}</v>") + "</c>" for at, t, v in cells) + "</row>" for r, cells in rows)
            z.writestr(f"xl/worksheets/sheet{k}.xml", f"<worksheet {ns}><sheetData>{body}</sheetData></worksheet>")


def test_spreadsheets_are_rows(spark, tmp_path):
    from talus.sources import sheets

    (tmp_path / "in").mkdir()
    shared = ["<t>Name &amp; folio</t>", "<r><t>AL</t></r><r><rPr/><t>PHA</t></r><rPh><t>x</t></rPh>"]
    first = [(1, [("A", "s", "0"), ("B", "n", "5.50"), ("AB", "inlineStr", "<far>")]), (2, []), (4, [("C", "s", "1"), ("D", "n", None), ("E", "b", "1")])]
    workbook(tmp_path / "in" / "w.xlsx", [first, [(1, [("A", "str", "two")])]], shared)
    (tmp_path / "in" / "bad.xlsx").write_bytes(b"no zip")
    got = {(r.doc_id, r.sheet, r.row): r for r in sheets.read_sheets(spark, str(tmp_path / "in")).collect()}
    assert got["w", 1, 1].cells == ["Name & folio", "5.50", *[None] * 25, "<far>"] and got["w", 1, 4].cells == [None, None, "ALPHA", None, "1"]
    assert got["w", 2, 1].cells == ["two"] and got["bad", None, None].error and len(got) == 4


def test_a_sheet_is_its_csv(spark, tmp_path):
    """5,000 rows: the cells are those of the same table as CSV, and as lines they give records."""
    from talus.operators import records as R
    from talus.sources import sheets

    (tmp_path / "x").mkdir()
    table = [(str(k), f"12010000{k:08d}", f"ALPHA TESTER {'ABCDE'[k % 5] * 3}", f"{k + 0.25:.2f}") for k in range(1, 5001)]
    workbook(tmp_path / "x" / "list.xlsx", [[(k, list(zip("ABCD", ("n", "inlineStr", "inlineStr", "n"), row, strict=True))) for k, row in enumerate(table, 1)]])
    (tmp_path / "list.csv").write_text("a,b,c,d\n" + "\n".join(map(",".join, table)) + "\n")
    csv = readers.read_csv_text(spark, str(tmp_path / "list.csv"), ["a", "b", "c", "d"])
    rows = sheets.read_sheets(spark, str(tmp_path / "x"))
    assert rows.select("cells").exceptAll(csv.select(F.array("a", "b", "c", "d").alias("cells"))).count() == 0 and rows.count() == 5000
    line = sheets.as_lines(rows).filter("line_no = 7").first().line
    assert R.parse_record(line, "", "cash")["net_amount"] == 7.25


def test_statements_are_limited(spark):
    import time

    from pyspark.errors import PySparkException

    from talus.streaming.limit import within

    slow = spark.range(0, 10**14, 1, 2).filter("id % 1000003 < 0")
    began = time.time()
    assert within(spark, lambda: [r.id for r in slow.collect()], "too slow", 1.0) == "too slow"
    assert time.time() - began < 30
    assert within(spark, lambda: spark.range(5).count(), None) == 5
    import pytest

    with pytest.raises(PySparkException):
        within(spark, lambda: spark.sql("SELECT raise_error('own')").collect(), None, 60.0)
    # Nothing of the limit stays with the thread.
    assert not list(spark.sparkContext.getJobTags())


def test_mart_follows_a_stream_of_items(spark, tmp_path):
    """Three batches in two runs give what one gives; a run without new items, or a batch run again, changes nothing."""
    from talus.operators import marts
    from talus.plans.queries import items

    own = items(spark, "/root/testdata/sf0.001").select("holder_id", "row_idx", "bo_id", "company", "folio_no", "name", "dividend_type", "net", "shares", "year_start", "tags", "settled_flag")
    parts = own.randomSplit([0.5, 0.3, 0.2], 3)
    start = lambda cp="cp": ingest.marts_in_batches(ingest.new_files(spark, f"{tmp_path}/in", own.schema, maxFilesPerTrigger=1), f"{tmp_path}/out", f"{tmp_path}/{cp}").awaitTermination()
    for part in parts[:2]:
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    start()
    parts[2].coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    start()
    want = sorted(map(str, marts.holder_mart(own).collect()))
    read = lambda: sorted(map(str, spark.read.parquet(f"{tmp_path}/out/mart").drop("bucket").collect()))
    assert read() == want
    start()
    assert read() == want
    # All batches again, from their beginning.
    start("cp2")
    assert read() == want


def test_small_readers_and_writers(spark, tmp_path):
    from talus.operators import lines, marts

    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a.txt").write_text("one\ntwo\n")
    assert [tuple(r) for r in readers.read_whole_text(spark, str(tmp_path / "t")).collect()] == [("a.txt", "one\ntwo\n")]
    df = spark.createDataFrame([("b", 2, None), ("a", 1, 1.5), ("b", 1, 2.5)], "k string, n int, v double")
    sinks.write_json(df, str(tmp_path / "json"))
    assert sorted(map(str, spark.read.schema(df.schema).json(str(tmp_path / "json")).collect())) == sorted(map(str, df.collect()))
    assert sorted((r.k, r.n, r.row_on_page) for r in lines.number_rows(df, ["k"], ["n"]).collect()) == [("a", 1, 1), ("b", 1, 1), ("b", 2, 2)]
    assert [r.k for r in marts.companies_of(df, "k").collect()] == ["a", "b"]


def test_tables_of_a_database(spark):
    """Columns of a table by JDBC, read in several partitions."""
    url = "jdbc:derby:memory:talus;create=true"
    df = spark.range(100).select(F.col("id").cast("int").alias("ID"), F.format_string("v%d", "id").alias("V"), F.lit(1).alias("OTHER"))
    df.write.mode("overwrite").jdbc(url, "items")
    options = {"partitionColumn": "ID", "lowerBound": "0", "upperBound": "100", "numPartitions": "4"}
    got = readers.read_table(spark, url, "items", ["ID", "V"], options)
    assert got.columns == ["ID", "V"] and sorted(tuple(r) for r in got.collect()) == [(k, f"v{k}") for k in range(100)]
    assert got.withColumn("p", F.spark_partition_id()).select("p").distinct().count() == 4


def test_streams_are_sent_in_batches(spark, tmp_path):
    """Every row once, in lists of the size, over two runs of the query."""
    out = str(tmp_path / "sent")

    def send(rows):
        with open(out, "a") as f:
            f.write(",".join(r["v"] for r in rows) + "\n")

    schema = "v string"
    for run in range(2):
        spark.createDataFrame([(f"{run}-{k}",) for k in range(5)], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = ingest.new_files(spark, f"{tmp_path}/in", T.StructType([T.StructField("v", T.StringType())]))
        ingest.stream_in_batches(stream, f"{tmp_path}/cp", send, size=3).awaitTermination()
    lists = [line.split(",") for line in open(out).read().splitlines()]
    assert sorted(v for x in lists for v in x) == sorted(f"{run}-{k}" for run in range(2) for k in range(5)) and max(map(len, lists)) == 3
