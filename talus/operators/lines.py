"""Pages to lines: explode, join wrapped records, number, carry headings down. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scalars import BO, INTEGER, MONEY, fold_digits, tokens
from ..schemas import TEXTLESS_BELOW


def split_pages(documents: DataFrame) -> DataFrame:
    """doc_id, page (from 1), text of doc_id and text, whose pages end at form feeds; digits are folded."""
    pages = documents.select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\f")).alias("page", "text"))
    return pages.select("doc_id", (F.col("page") + 1).alias("page"), fold_digits(F.col("text")).alias("text"))


def has_text(text: Column) -> Column:
    return F.length(F.trim(F.coalesce(text, F.lit("")))) >= TEXTLESS_BELOW


def page_sample(pages: DataFrame) -> DataFrame:
    """First, middle and last page of every document."""
    n = F.count("*").over(Window.partitionBy("doc_id"))
    at = F.row_number().over(Window.partitionBy("doc_id").orderBy("page"))
    return pages.withColumn("_n", n).withColumn("_at", at).filter((F.col("_at") == 1) | (F.col("_at") == F.col("_n")) | (F.col("_at") == F.floor(F.col("_n") / 2) + 1)).drop("_n", "_at")


def explode_lines(pages: DataFrame) -> DataFrame:
    """A row for each line of every page with text: the page's columns but text, line_no (from 1), line."""
    others = [c for c in pages.columns if c != "text"]
    rows = pages.filter(has_text(F.col("text"))).select(*others, F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return rows.withColumn("line_no", F.col("line_no") + 1)


def _count(words: Column, pattern: str) -> Column:
    return F.size(F.filter(words, lambda t: t.rlike(pattern)))


#: What a first half begins with.
_BEGINS = r"(?U)^\s*[0-9][0-9,]*\s+(19|20)[0-9]{2}(?!\S)"


def _how(w: Column, nw: Column) -> Column:
    """How words of a line and of the next go together: 1 if a name and amounts follow on a half, 2 if amounts do, else 0."""
    w0, w1, w2 = (F.coalesce(F.get(w, F.lit(k)), F.lit("")) for k in range(3))
    n0, n1 = (F.coalesce(F.get(nw, F.lit(k)), F.lit("")) for k in range(2))
    begins = w0.rlike(INTEGER) & w1.rlike("^(19|20)[0-9]{2}$")
    rest = F.when(F.size(w) > 3, F.slice(w, F.lit(4), F.greatest(F.size(w) - 3, F.lit(1)))).otherwise(F.array().cast("array<string>"))
    named = begins & w2.rlike("^[0-9]{4,}$") & (_count(rest, MONEY) <= 1) & n0.rlike("^[A-Za-z]") & (_count(nw, MONEY) > 0) & (_count(nw, BO) == 0)
    wrapped = begins & (F.size(w) >= 4) & w2.rlike("^[0-9]{5,9}$") & (_count(w, MONEY) == 0) & ~(n0.rlike(INTEGER) & n1.rlike("^(19|20)[0-9]{2}$")) & (_count(nw, MONEY) > 0)
    return F.when(F.coalesce(named, F.lit(False)), 1).when(F.coalesce(wrapped, F.lit(False)), 2).otherwise(0)


def _whole(how: Column, w: Column, line: Column, following: Column) -> Column:
    named = F.concat(F.array_join(F.slice(w, 1, 3), " "), F.lit(" "), F.trim(following))
    return F.when(how == 1, named).when(how == 2, F.concat(F.rtrim(line), F.lit(" "), F.trim(following))).otherwise(line)


def join_wrapped(lines: DataFrame) -> DataFrame:
    """Lines of doc_id, page, line_no, line with records that are printed over two lines brought into one.

    A record's first half begins with serial, year and number. If a name and amounts follow on the next line that isn't blank, they
    take the place of what stands after the number (an amount there is lost); if the half holds no amount, a line with
    amounts is appended. A consumed line begins neither kind of half, so looking one line ahead is enough. line_no is numbered anew.
    """
    page = Window.partitionBy("doc_id", "page")
    blank = F.trim("line") == ""
    df = lines.withColumn("_w", tokens(F.col("line")))
    # For each line, the next line of its page that isn't blank: the last one so far, from the page's end. Frames that end at a row grow with
    # it, while frames up to the page's end would be read anew for each row.
    ahead = page.orderBy(F.desc("line_no")).rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("_next", F.last(F.when(~blank, F.struct("line", "_w")), ignorenulls=True).over(ahead))
    df = df.withColumn("_how", F.when(F.col("_next").isNotNull(), _how(F.col("_w"), F.col("_next._w"))).otherwise(0))
    before = page.orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("_taken", F.coalesce(F.last(F.when(~blank, F.col("_how") > 0), ignorenulls=True).over(before), F.lit(False)))
    text = _whole(F.col("_how"), F.col("_w"), F.col("line"), F.col("_next.line"))
    kept = df.filter(~F.col("_taken")).withColumn("line", text).drop("_w", "_next", "_how", "_taken")
    return kept.withColumn("line_no", F.row_number().over(Window.partitionBy("doc_id", "page").orderBy("line_no")))


def joined_lines(pages: DataFrame) -> DataFrame:
    """join_wrapped(explode_lines(pages)), page by page as it is read: nothing is dealt or sorted, and a task holds one page at a time.

    A page is cut before every line that isn't blank; such a line and the blank ones after it are a run, and runs meet the next by zip_with,
    so the work is in proportion to the text.
    """
    others = [c for c in pages.columns if c != "text"]
    run = lambda g: F.struct(g.alias("g"), F.substring_index(g, "\n", 1).alias("line"))
    df = pages.filter(has_text(F.col("text"))).select(*others, F.transform(F.split("text", r"\n(?=[^\n]*[^ \n])"), run).alias("_runs"))

    def met(x: Column, n: Column) -> Column:
        words = F.array(F.struct(tokens(x["line"]).alias("w"), tokens(n["line"]).alias("nw")))
        how = F.transform(words, lambda t: F.transform(F.array(_how(t["w"], t["nw"])), lambda h: F.struct(h.alias("how"), _whole(h, t["w"], x["line"], n["line"]).alias("line")))[0])[0]
        none = F.struct(F.lit(0).alias("how"), x["line"].alias("line"))
        return F.struct(x["g"].alias("g"), F.when(n.isNotNull() & x["line"].rlike(_BEGINS), how).otherwise(none).alias("t"))

    df = df.withColumn("_runs", F.zip_with("_runs", F.slice("_runs", F.lit(2), F.size("_runs")), met))

    def left(x: Column, before: Column) -> Column:
        own = F.split(x["g"], "\n")
        return F.when(before["t"]["how"] > 0, F.slice(own, F.lit(2), F.size(own))).when(x["t"]["how"] > 0, F.array(x["t"]["line"])).otherwise(own)

    # The run before each: all runs moved on by one, behind one that takes nothing.
    none = F.transform(F.slice("_runs", 1, 1), lambda x: F.struct(x["g"].alias("g"), F.struct(F.lit(0).alias("how"), x["t"]["line"].alias("line")).alias("t")))
    moved = F.slice(F.concat(none, "_runs"), F.lit(1), F.size("_runs"))
    return df.select(*others, F.posexplode(F.flatten(F.zip_with("_runs", moved, left))).alias("line_no", "line")).withColumn("line_no", F.col("line_no") + 1)


def number_rows(rows: DataFrame, by: list[str], order: list[str], name: str = "row_on_page") -> DataFrame:
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))


def carry_down(rows: DataFrame, by: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """Each column takes the last value that isn't null up to the row."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})


def ends(rows: DataFrame, by: list[str], order: list[str], head: int, tail: int) -> DataFrame:
    """The first `head` and last `tail` rows of each group."""
    up = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    down = F.row_number().over(Window.partitionBy(*by).orderBy(*(F.desc(c) for c in order)))
    return rows.withColumn("_up", up).withColumn("_down", down).filter((F.col("_up") <= head) | (F.col("_down") <= tail)).drop("_up", "_down")


def every(rows: DataFrame, by: list[str], order: list[str], step: int) -> DataFrame:
    """Every step-th row of each group, from the first."""
    at = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return rows.withColumn("_at", at).filter((F.col("_at") - 1) % step == 0).drop("_at")


def seeded_sample(rows: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n rows by a hash of key and seed: the same rows on any cluster."""
    mark = F.sha2(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))), 256)
    return rows.withColumn("_mark", mark).orderBy("_mark", key).limit(n).drop("_mark")


def pair_in_order(left: DataFrame, right: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """The k-th left row of a group with its k-th right row, in groups that hold as many of either; both sides' other columns."""
    whole, at = Window.partitionBy(*by), Window.partitionBy(*by).orderBy(*order)

    def ranked(df: DataFrame, side: str) -> DataFrame:
        df = df.withColumn("k", F.row_number().over(at)).withColumn("_n", F.count("*").over(whole))
        return df.select(*by, "k", "_n", *(F.col(c).alias(f"{side}_{c}") for c in df.columns if c not in (*by, "k", "_n")))

    return ranked(left, "left").join(ranked(right, "right"), [*by, "k", "_n"]).drop("_n")
