"""Lines to records: what the built-in functions cannot say is said in Python, a stream of pages or lines.

The generic extractor reads pages by themselves, with the year and type that hold at their top found by a scan (scan.py). For the others rows arrive
sorted by document and place (a shuffle by doc_id); a generator keeps the context of the document it is in, so a
task's memory is an Arrow batch and one context, whatever a document's length.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import islice
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions import scalars as S
from ..schemas import RAW_ROW, SHARE_TYPES, SUM_TOLERANCE
from ..sources.stored import stored
from . import scan
from .lines import has_text, joined_lines

_BO, _MONEY, _INTEGER, _NUMBER, _YEAR = (re.compile(p) for p in (S.BO, S.MONEY, S.INTEGER, S.NUMBER, S.YEAR))
_LETTER, _DIGIT = re.compile(r"[A-Za-zঀ-৿]"), re.compile(r"\d")
_SPAN = re.compile(r"(?:19|20)\d\d[-–/](?:(?:19|20)?\d\d)")
_LONG_ID = re.compile(r"\b(\d{16})\b")
#: Words of table heads, the order in which amount columns are preferred, words that widen a column.
HEAD = re.compile(r"^(sl|serial|folio|bo|boid|bo_id|name|net\w*|gross\w*|tax\w*|amount|shares?|bonus\w*|dividend|holder\w*|address\w*|warrant|payable|total|stock|cash|father\w*|year|tk|taka|no|fraction\w*)$")
CASH_FIRST = ("^net", "^payable", "^amount", "^dividend")
STOCK_FIRST = ("^bonus", "^shares?$", "^stock", "^no$")
WIDENING = ("dividend", "amount", "payable", "tk", "taka", "divident")
YEAR_HEAD = re.compile(r"(?:(Bonus|Right|Cash|Stock|Fraction)[\s_-]*)?((?:19|20)\d\d(?:\s*[-/]\s*\d{2,4})?)", re.I)
IDENTITY = re.compile(r"^\s*(\d{1,6})\s+((?:19|20)\d\d)\s+(\d{5,9})\s+(\S.*?)(?:\s{3,}.*)?$")


def value(token: str) -> float | None:
    try:
        return float(token.replace(",", "").strip("()"))
    except ValueError:
        return None


def type_of(text: str, default: str | None = "cash") -> str | None:
    """As scalars.dividend_type, on the driver or in a worker."""
    s = text.lower()
    for name, pattern in S.TYPE_PATTERNS:
        if re.search(pattern, s):
            return name
    if re.search("bonus|stock", s) and "cash div" not in s:
        return "stock"
    return default if default is not None else "cash" if re.search("cash|dividend|unclaim|unpaid", s) else None


def is_word(token: str) -> bool:
    return (token.isascii() and token.isalpha()) or (bool(_LETTER.search(token)) and not _DIGIT.search(token))


def is_amount(token: str) -> bool:
    return token[:1] in "(-0123456789" and bool(_MONEY.match(token) or _INTEGER.match(token))


def triple(numbers: list[str]) -> tuple[list[float], tuple[float, float, float] | None]:
    """Decimal values of tokens, and gross, tax, net by arithmetic (see scalars.amount_triple). A token that begins with a comma or point
    belongs to the number before it."""
    whole: list[str] = []
    for t in numbers:
        if t[0] in ",." and whole and whole[-1][0].isdigit():
            whole[-1] += t
        else:
            whole.append(t)
    v = [x for t in whole if is_amount(t) and (x := value(t)) is not None]
    fits = lambda g, n, *off: g > 0 and n > 0 and abs(g - sum(off) - n) <= SUM_TOLERANCE
    last = range(len(v) - 1, -1, -1)
    three = ((v[i], v[i + 1], v[i + 2]) for i in last if i + 2 < len(v) and v[i + 1] > 0 and fits(v[i], v[i + 2], v[i + 1]))
    four = ((v[i], v[i + 1] + v[i + 2], v[i + 3]) for i in last if i + 3 < len(v) and min(v[i + 1], v[i + 2]) >= 0 < v[i + 1] + v[i + 2] and fits(v[i], v[i + 3], v[i + 1], v[i + 2]))
    apart = ((v[g], v[t], v[n]) for n in last for t in range(n - 1, 0, -1) if v[t] > 0 for g in range(t - 1, max(-1, n - 6), -1) if fits(v[g], v[n], v[t]))
    found = next(three, None) or next(four, None) or next(apart, None)
    return [value(t) for t in whole if _MONEY.match(t)], found


def _account_first(words: list[str]) -> tuple[list[str], int | None]:
    """The words with a 16-digit account moved before a name that is printed in front of it, and the account's place."""
    at = None
    for i, t in enumerate(words):
        if len(t) == 16 and _BO.match(t):
            at = i
            break
    if at is None or at + 1 >= len(words) or not is_amount(words[at + 1]):
        return words, at
    name = next((i for i in range(at) if is_word(words[i])), None)
    if name is None:
        return words, at
    return [*words[:name], words[at], *words[name:at], *words[at + 1 :]], name


def identify(words: list[str], year: str) -> tuple[str, str, str, str, str, str, list[str]] | None:
    """Year, warrant, raw identifiers, account, folio and name of a line's words, if they are a record, and the words after its name; or None.

    A record has an account (16 digits) or other words before its name. The name runs from the first word of letters after the
    account up to the first number. A short serial is dropped. A year span among the words before and in the name overrides the year.
    """
    if len(words) < 3:
        return None
    words, at = _account_first(words)
    first = next((i for i in range(0 if at is None else at + 1, len(words)) if is_word(words[i])), None)
    if first is None or (at is None and first == 0):
        return None
    stop = next((i for i in range(first, len(words)) if is_amount(words[i])), len(words))
    name, tail = words[first:stop], words[stop:]
    account = words[at] if at is not None else ""
    lead = words[:first] if at is None else words[:at] + words[at + 1 : first]
    year = next((t for t in reversed(lead + name) if len(t) in (7, 9) and _SPAN.fullmatch(t)), year)
    ids = [t for t in lead if t != year]
    if ids and len(ids[0]) <= 6 and _INTEGER.match(ids[0]) and (account or len(ids) > 1):
        ids = ids[1:]
    whole = " ".join(name)
    if not account and not ids or len(whole) < 2:
        return None
    ids = " ".join(ids)
    return year, ids if account else "", " ".join([account] * bool(account) + lead), account, "" if account else ids, whole, tail


def parse_record(line: str, year: str, kind: str | None, need_amount: bool = True) -> dict | None:
    """A record of one line, or None. year and kind are the context's. Share types take a single whole number; others gross, tax and net by
    arithmetic, else the last decimal, else the last whole number.
    """
    found = identify(line.split(), year)
    if found is None:
        return None
    year, warrant, raw, account, folio, name, tail = found
    row = dict(dividend_year=year, dividend_type=kind, warrant_no=warrant, folio_or_bo_raw=raw, bo_id=account, folio_no=folio, holder_name_raw=name, shares=None, gross_amount=None, tax_amount=None, net_amount=None, issues="", line=line[:300])
    if kind in SHARE_TYPES:
        run = tail[: next((i for i, t in enumerate(tail) if not is_amount(t)), len(tail))]
        if len(run) == 1 and _INTEGER.match(run[0]):
            row["shares"] = value(run[0])
        elif run:
            row["issues"] = "stock_ambiguous_numbers"
        elif need_amount:
            return None
        return row
    decimals, found = triple(tail)
    if found:
        row["gross_amount"], row["tax_amount"], row["net_amount"] = found
    elif decimals:
        row["net_amount"] = decimals[-1]
        row["issues"] = "gross_tax_net_mismatch" if len(decimals) >= 3 else ""
    elif need_amount:
        whole = [t for t in tail if _INTEGER.match(t)]
        if not whole:
            return None
        row["net_amount"], row["issues"] = value(whole[-1]), "int_amount"
    return row


_in_order = itemgetter(*RAW_ROW.fieldNames())


def _fields(columns: list[str] | None) -> T.StructType:
    return T.StructType([RAW_ROW[c] for c in columns]) if columns else RAW_ROW


def raw_batches(pages: Iterator[dict], on_page: Callable[[dict], Iterator[tuple]], columns: list[str] | None = None) -> Iterator[pa.RecordBatch]:
    """What on_page makes of pages, tuples in the order of RAW_ROW, in batches of columns; columns: these alone."""
    arrow = to_arrow_schema(_fields(columns))
    at = [RAW_ROW.fieldNames().index(name) for name in arrow.names]
    rows = (row for page in pages for row in on_page(page))
    while part := list(islice(rows, 4096)):
        whole = list(zip(*part, strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(whole[k], f.type) for k, f in zip(at, arrow, strict=True)], schema=arrow)


def _stream(df: DataFrame, handle: Callable[[], Callable[[dict], Iterator[tuple]]], columns: list[str] | None = None) -> DataFrame:
    """handle() makes a function of pages for each document; pages of a document come in order, documents of a task one after the other."""

    def run(batches):
        doc, own = object(), None

        def on_page(page):
            nonlocal doc, own
            if page["doc_id"] != doc:
                doc, own = page["doc_id"], handle()
            return own(page)

        yield from raw_batches((page for b in batches for page in b.to_pylist()), on_page, columns)

    return df.repartition("doc_id").sortWithinPartitions("doc_id", "page").mapInArrow(run, _fields(columns))


@dataclass
class _Context:
    year: str = ""
    kind: str | None = None
    fresh: bool = True
    head: list[str] = field(default_factory=list)
    rows: int = 0
    page: int | None = None


def _begin(c: _Context, title: str, head: list[str], skip_money: bool) -> None:
    """The title and the heads of the first page set year and type."""
    kept = [x for x in head if not _LONG_ID.search(x) and not (skip_money and _MONEY.search(x))]
    text = title + " " + " ".join(kept)
    c.kind = type_of(text, type_of(title))
    c.year = m.group(0) if (m := _YEAR.search(text)) else c.year
    c.fresh = False


EVENT = T.StructType([*RAW_ROW.fields, T.StructField("line_no", T.IntegerType()), T.StructField("event", T.StringType()), T.StructField("grand", T.BooleanType()), T.StructField("values", T.ArrayType(T.DoubleType()))])

#: Words of lines that may set the year, and the type.
YEAR_WORDS = "year|dividend|fy|agm"
TYPE_WORDS = "stock div|bonus|fraction|right share|refund|cash div|subscription"


def follow(line: str, state: scan.State) -> scan.State:
    """The year and type after a line that is no row: short ones without an account and totals may set either."""
    year, kind = state
    low, words = line.lower(), line.split()
    if "total" in low or len(words) > 14 or any(map(_BO.match, words)):
        return state
    if re.search(YEAR_WORDS, low) and (m := _YEAR.search(line)):
        year = m.group(0)
    if re.search(TYPE_WORDS, low):
        kind = type_of(line, None) or kind
    return year, kind


def page_map(lines: list[str]) -> scan.Map:
    """What the lines of a page do to year and type. Whether a line is a row, and so sets nothing, may depend on both."""

    def through(state: scan.State) -> scan.State:
        for line in lines:
            if not parse_record(line, *state):
                state = follow(line, state)
        return state

    return scan.as_map(through, {t for line in lines for t in line.split() if _YEAR.fullmatch(t)})


def page_states(lines: DataFrame, titles: DataFrame) -> DataFrame:
    """doc_id, page, year, kind at the top of every page of lines (doc_id, page, line_no, line), given titles (doc_id, title)."""
    kind = lines.schema["doc_id"].dataType.simpleString()
    at = F.coalesce(F.col("page").cast("long"), F.lit(-1)) + 1
    head = lines.filter("line_no <= 8").groupBy("doc_id", at.alias("at")).agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("head"))
    opening = head.groupBy("doc_id").agg(F.min_by("head", "at")["line"].alias("head")).join(titles, "doc_id", "left")

    def begin(batches):
        for b in batches:
            out = []
            for r in b.to_pylist():
                c = _Context()
                _begin(c, r["title"] or "", r["head"], True)
                out.append({"doc_id": r["doc_id"], "year": c.year, "kind": c.kind})
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    def summed_up(rows: Iterator[dict]) -> Iterator[dict]:
        rows = list(rows)
        yield {"doc_id": rows[0]["doc_id"], "at": rows[0]["at"], "map": scan.packed(page_map([r["line"] for r in rows]))}

    first = T._parse_datatype_string(f"doc_id {kind}, year string, kind string")
    arrow = to_arrow_schema(first)
    # Few lines can set anything: only these are dealt.
    turns = lines.filter(F.lower("line").rlike(f"{YEAR_WORDS}|{TYPE_WORDS}")).select("doc_id", at.alias("at"), "line_no", "line")
    maps = scan.stream(turns, ["doc_id", "at"], ["line_no"], summed_up, scan.NODE.format(kind))
    nodes = lines.filter("line_no = 1").select("doc_id", at.alias("at")).join(maps, ["doc_id", "at"], "left").dropDuplicates(["doc_id", "at"])
    states = scan.states_at(stored(nodes, "pages"), stored(opening.mapInArrow(begin, first), "openings"))
    return states.select("doc_id", (F.col("at") - 1).alias("page"), "year", "kind")


def extract_records(pages: DataFrame) -> DataFrame:
    """Events of pages (doc_id, title, page, text): rows, totals, unreadable totals and lines with an account that gave no row.

    Lines are exploded and wrapped records joined by DataFrame functions. A line that is no row may change year and type for the lines after
    it, and whether a line is a row depends on both: what holds at the top of each page comes from a scan over pages, and pages
    are then read by themselves, whatever their document's length. A page without a number goes before all others.
    """
    lines = stored(joined_lines(pages.select("doc_id", "page", "text")), "lines")
    titles = pages.groupBy("doc_id").agg(F.max("title").alias("title"))
    page = F.coalesce(F.col("page").cast("long"), F.lit(-1))
    tops = page_states(lines, titles).select("doc_id", F.col("page").alias("_page"), F.lit(0).alias("line_no"), "year", "kind")
    rows = lines.withColumn("_page", page).unionByName(tops, allowMissingColumns=True)

    def read(rows: Iterator[dict]) -> Iterator[dict]:
        state, n = ("", None), 0
        for r in rows:
            line = r["line"]
            if line is None:
                state = r["year"], r["kind"]
                continue
            base = {"doc_id": r["doc_id"], "page": r["page"], "line_no": r["line_no"], "line": line[:300]}
            if row := parse_record(line, *state):
                n += 1
                yield row | base | {"row_on_page": n, "event": "row"}
                continue
            low, words = line.lower(), line.split()
            state = follow(line, state)
            if "total" in low:
                if "###" in line:
                    yield base | {"event": "unreadable_total"}
                elif numbers := [x for t in words if is_amount(t) and (x := value(t)) is not None]:
                    yield base | {"event": "total", "grand": "grand" in low, "values": numbers}
            elif any(map(_BO.match, words)):
                yield base | {"event": "unparsed_id"}

    return scan.stream(rows, ["doc_id", "_page"], ["line_no"], read, EVENT)


def extract_recognised(recognised: DataFrame) -> DataFrame:
    """Rows of recognised pages (doc_id, title, page, text). The year is the first that a page's beginning names, from that page on; the type the
    last that title and a page's beginning decide, else the title's, else cash. Lines set nothing, and none are joined."""
    pages = Window.partitionBy("doc_id").orderBy("page")
    df = recognised.withColumn("text", S.fold_digits(F.coalesce("text", F.lit("")))).withColumn("title", F.coalesce("title", F.lit("")))
    year = F.coalesce(F.first(S.year_span(F.substring("text", 1, 400)), ignorenulls=True).over(pages), F.lit(""))
    decided = S.dividend_type(F.concat("title", F.lit(" "), F.substring("text", 1, 300)), F.lit(None).cast("string"))
    kind = F.coalesce(F.last(decided, ignorenulls=True).over(pages), S.dividend_type(F.col("title"), F.lit("cash")))
    df = df.withColumns({"year": year, "kind": kind})
    lines = df.select("doc_id", "page", "year", "kind", F.posexplode(F.split("text", "\n")).alias("line_no", "line")).filter(F.trim("line") != "")

    def read(rows: Iterator[dict]) -> Iterator[dict]:
        n = 0
        for r in rows:
            if row := parse_record(r["line"].strip(), r["year"], r["kind"]):
                n += 1
                yield row | {"doc_id": r["doc_id"], "page": r["page"], "row_on_page": n}

    return scan.stream(lines, ["doc_id", "page"], ["line_no"], read, RAW_ROW)


def with_recognised(stats: DataFrame, pages: DataFrame, rows: DataFrame) -> DataFrame:
    """Statistics after recognition: for documents with recognised pages (doc_id, page) and the rows they gave, ocr, ocr_pages, ocr_rows, no page without text
    any more, and rows and extracted_total with theirs. Documents that had no text at all get a row."""
    done = pages.groupBy("doc_id").agg(F.count("*").cast("int").alias("ocr_pages"))
    found = rows.groupBy("doc_id").agg(F.count("*").cast("int").alias("ocr_rows"), F.sum("net_amount").alias("_net"))
    df = stats.join(done.join(found, "doc_id", "left"), "doc_id", "full").withColumn("ocr", F.col("ocr_pages").isNotNull())
    df = df.withColumns({
        "textless_pages": F.when(F.col("ocr"), 0).otherwise(F.col("textless_pages")), "pages": F.coalesce("pages", "ocr_pages"), "ocr_rows": F.coalesce("ocr_rows", F.lit(0)),
        "rows": F.coalesce("rows", F.lit(0)) + F.coalesce("ocr_rows", F.lit(0)), "extracted_total": F.round(F.coalesce("extracted_total", F.lit(0.0)) + F.coalesce("_net", F.lit(0.0)), 2),
    })
    return df.na.fill(0, ["unparsed_idlike", "unreadable_totals", "ocr_pages"]).na.fill(0.0, ["extracted_shares"]).drop("_net")


def record_rows(events: DataFrame) -> DataFrame:
    return events.filter("event = 'row'").select(*RAW_ROW.fieldNames())


def document_stats(events: DataFrame, pages: DataFrame) -> DataFrame:
    """Counts and printed totals of every document. The stated total is the last one labelled grand, else the largest."""
    size = pages.groupBy("doc_id").agg(F.count("*").cast("int").alias("pages"), F.count_if(~has_text(F.col("text"))).cast("int").alias("textless_pages"))
    last = F.element_at("values", -1)
    place = F.struct("page", "line_no")
    in_order = lambda keep, value: F.slice(F.transform(F.array_sort(F.collect_list(F.when(keep, F.struct(place.alias("at"), value.alias("v"))))), lambda x: x["v"]), 1, 300)
    is_ = lambda k: F.col("event") == k
    found = events.groupBy("doc_id").agg(
        F.count_if(is_("row")).cast("int").alias("rows"),
        F.count_if(is_("unparsed_id")).cast("int").alias("unparsed_idlike"),
        F.count_if(is_("unreadable_total")).cast("int").alias("unreadable_totals"),
        F.round(F.coalesce(F.sum("net_amount"), F.lit(0.0)), 2).alias("extracted_total"),
        F.round(F.coalesce(F.sum("shares"), F.lit(0.0)), 2).alias("extracted_shares"),
        F.coalesce(F.max_by(F.when(F.col("grand"), last), F.when(F.col("grand"), place)), F.max(F.when(is_("total"), last))).alias("stated_total"),
        in_order(is_("total"), last).alias("totals"),
        in_order(is_("total") & (F.size("values") >= 2), F.slice("values", 1, 12)).alias("total_lines"),
    )
    return size.join(found, "doc_id", "left").na.fill(0, ["rows", "unparsed_idlike", "unreadable_totals"]).na.fill(0.0, ["extracted_total", "extracted_shares"])


def _spans(line: str) -> list[tuple[int, int, str]]:
    return [(m.start(), m.end(), m.group()) for m in re.finditer(r"\S+", line)]


def _key(word: str) -> str:
    return word.strip("().:#,-_/*").lower()


def find_column(lines: list[str], preferred: tuple[str, ...]) -> tuple[int, int] | None:
    """Character span of the preferred amount column of the first table head (three head words, at most two numbers, no account). Heads
    may wrap over two more lines of head words; near words of WIDENING extend the span."""
    for i, line in enumerate(lines):
        words = [(a, b, _key(t)) for a, b, t in _spans(line)]
        heads = [w for w in words if HEAD.match(w[2])]
        if len(heads) < 3 or sum(bool(_NUMBER.match(w[2])) for w in words) > 2 or _LONG_ID.search(line):
            continue
        for below in lines[i + 1 : i + 3]:
            more = [(a, b, _key(t)) for a, b, t in _spans(below)]
            if more and all(not w[2] or HEAD.match(w[2]) for w in more):
                heads += [w for w in more if w[2]]
        for pattern in preferred:
            hit = next((w for w in heads if re.match(pattern, w[2])), None)
            if hit:
                begin, end = hit[:2]
                for a, b, key in sorted(heads):
                    if 0 <= a - end <= 2 and key in WIDENING:
                        end = b
                return begin, end
        return None
    return None


def number_under(line: str, span: tuple[int, int], slack: int = 6) -> str | None:
    """The number token that overlaps the span widened by slack and lies nearest to its centre; the first of equals."""
    a, b = span
    near = [(abs((s + e) - (a + b)), s, t) for s, e, t in _spans(line) if _NUMBER.match(t) and min(e, b + slack) > max(s, a - slack)]
    return min(near)[2] if near else None


def _nameless(account: str, year: str) -> tuple[str, str, str, str, str, str, list[str]]:
    """In place of what identify() gives."""
    return year, "", account, account, "", "", []


def _skipped(line: str) -> bool:
    return not line.strip() or ("total" in line.lower() and not _LONG_ID.search(line))


def column_rows():
    """Rows of one document's pages in order, by the column of its head."""
    c, span = _Context(), [None]

    def on_row(r: dict) -> Iterator[tuple]:
        lines = r["text"].split("\n")
        if c.fresh:
            _begin(c, r["title"] or "", lines[:8], False)
        span[0] = find_column(lines, STOCK_FIRST if c.kind in SHARE_TYPES else CASH_FIRST) or span[0]
        n = 0
        for line in lines:
            if _skipped(line):
                continue
            account = _LONG_ID.search(line)
            if not account and len(line.split()) <= 14 and re.search("year|dividend|fy|agm", line.lower()) and (m := _YEAR.search(line)):
                c.year = m.group(0)
            if span[0] is None:
                continue
            found = identify(line.split(), c.year)
            token = number_under(line, span[0]) if found or account else None
            if token is None:
                continue
            n += 1
            year, warrant, raw, own, folio, name, _ = found or _nameless(account.group(1), c.year)
            share, v = c.kind in SHARE_TYPES, value(token)
            yield r["doc_id"], r["page"], n, year, c.kind, warrant, raw, own, folio, name, v if share else None, None, None, None if share else v, "col_amount" if found else "name_missing;col_amount", line.strip()[:300]

    return on_row


def extract_by_column(pages: DataFrame) -> DataFrame:
    """Records whose amount stands under the head of the preferred amount column, which holds on over pages; pages as above."""
    return _stream(pages.filter(has_text(F.col("text"))), column_rows)


def find_year_columns(lines: list[str]) -> list[tuple[str, str, int]] | None:
    """(year, kind, end) of the first of 40 lines that has two year labels, no account and no number over four digits."""
    for line in lines[:40]:
        labels = list(YEAR_HEAD.finditer(line))
        if len(labels) >= 2 and not _LONG_ID.search(line) and not any(_NUMBER.match(t) and len(t.replace(",", "")) > 4 for t in line.split()):
            return [("".join(m.group(2).split()), (m.group(1) or "").lower(), m.end()) for m in labels]
    return None


def year_column_rows(slack: int = 7, most: float = 1_000_000.0):
    """Rows of one document's pages in order, by year columns."""
    columns, nearest = None, {}

    def column_at(end: int) -> tuple[str, str] | None:
        """Year and kind of the column nearest to a word's end, if within slack."""
        year, kind, at = min(columns, key=lambda col: abs(col[2] - end))
        return None if abs(at - end) > slack else (year, kind)

    def on_row(r: dict) -> Iterator[tuple]:
        nonlocal columns
        doc, page, base = r["doc_id"], r["page"], type_of(r["title"] or "")
        lines = r["text"].split("\n")
        here = find_year_columns(lines)
        if here and here != columns:
            columns = here
            nearest.clear()
        n = 0
        for line in lines if columns else ():
            if _skipped(line):
                continue
            words, hits, end = line.split(), [], 0
            for token in words:
                end = line.find(token, end) + len(token)
                if end not in nearest:
                    nearest[end] = column_at(end)
                if (column := nearest[end]) is None or not _NUMBER.match(token):
                    continue
                year, kind = column
                if ("." in token or kind in ("bonus", "right", "stock") or base in SHARE_TYPES) and (v := value(token)) and v <= most:
                    hits.append((year, "stock" if kind == "bonus" else kind or base, v))
            if not hits:
                continue
            issues = "year_column"
            if (found := identify(words, "")) is None:
                if (account := _LONG_ID.search(line)) is None:
                    continue
                found, issues = _nameless(account.group(1), ""), "name_missing;year_column"
            _, warrant, raw, account, folio, name, _ = found
            short = line.strip()[:300]
            for year, own, v in hits:
                n += 1
                share = own in SHARE_TYPES
                yield doc, page, n, year, own, warrant, raw, account, folio, name, v if share else None, None, None, None if share else v, issues, short

    return on_row


def extract_year_columns(pages: DataFrame, slack: int = 7, most: float = 1_000_000.0, columns: list[str] | None = None) -> DataFrame:
    """A record for every number that ends within slack of a year column's end; columns hold on over pages. columns: fields of the records, where
    not all are needed."""
    return _stream(pages.filter("text IS NOT NULL"), lambda: year_column_rows(slack, most), columns)


def numbers_at_end(line: str) -> tuple[str, tuple[float, float, float]] | None:
    """Identifier and gross, tax, net of a line that ends in three to eight numbers. The identifier is the first word if it has 4 to 16
    digits and is not itself in the run of numbers."""
    words = line.split()
    n = next((k for k, t in enumerate(reversed(words)) if not _NUMBER.match(t)), len(words))
    if not 3 <= n <= 8:
        return None
    _, found = triple(words[len(words) - n :])
    if not found:
        return None
    return (words[0] if n < len(words) and re.fullmatch(r"\d{4,16}", words[0]) else ""), found


def paired_rows(kind: str = "cash"):
    """Rows of a page, by paired lines."""
    def on_row(r: dict) -> Iterator[tuple]:
        ids, amounts = [], []
        for line in r["text"].split("\n"):
            if m := IDENTITY.match(line):
                ids.append(m.groups())
            elif found := numbers_at_end(line):
                amounts.append(found)
        for n, ((serial, year, warrant, name), (who, (g, t, net))) in enumerate(zip(ids, amounts, strict=True) if len(ids) == len(amounts) else (), 1):
            account = who if len(who) == 16 else ""
            yield _in_order(dict(doc_id=r["doc_id"], page=r["page"], row_on_page=n, dividend_year=year, dividend_type=kind, warrant_no=warrant, folio_or_bo_raw=who, bo_id=account, folio_no="" if account else who, holder_name_raw=name.strip(), shares=None, gross_amount=g, tax_amount=t, net_amount=net, issues="paired_lines", line=f"{serial} {year} {warrant} {name[:60]} | {who} {g} {t} {net}"))

    return on_row


def extract_paired(pages: DataFrame, kind: str = "cash") -> DataFrame:
    """Records of pages that print identities and amounts on lines of their own: the k-th of either belong together, on pages that
    have as many of both."""
    return _stream(pages.filter("text IS NOT NULL"), lambda: paired_rows(kind))


def classify_documents(sample: DataFrame) -> DataFrame:
    """pdf_kind and lang of sampled pages (doc_id, page, text): text if all hold text, scanned if none, else mixed."""
    from ..schemas import SAMPLED_TEXT_OVER

    long_ = F.length(F.trim(F.coalesce("text", F.lit("")))) > SAMPLED_TEXT_OVER
    share = F.avg(long_.cast("double"))
    kind = F.when(share == 1, "text").when(share == 0, "scanned").otherwise("mixed")
    bengali = F.bool_or(F.coalesce("text", F.lit("")).rlike("[ঀ-৿]"))
    return sample.groupBy("doc_id").agg(kind.alias("pdf_kind"), F.when(bengali, "bn").otherwise("en").alias("lang"))
