"""Control totals: candidates, the nearest one, per-year checks, and the choice between competing extractors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scalars import TOTAL_LABEL, has_tag, tag_list
from ..schemas import APPROX_ERROR, APPROX_SHARE, APPROX_YEARS, EXTRACTOR_GUARD, FLAGGED_BELOW, INFORMATIONAL, LEAST_TOTAL, SHARE_TYPES, TOTAL_TOLERANCE, UNREADABLE_FROM
from ..sources.stored import stored

_NONE = "array<double>"
#: Rows of a range that are held against each other by one task, about.
RANGE_ROWS = 250_000


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)


def candidates(totals: Column, total_lines: Column | None = None, extra: Column | None = None, strict: bool = False) -> Column:
    """Distinct values that a document's sum may be held against.

    All printed totals of at least LEAST_TOTAL, rounded; of lines with several, every value and their sum; and of all distinct
    totals their sum, the sum without the largest, and half the sum (for documents that print every total twice). strict leaves out
    the last three, with which half of a document can pass for the whole.
    """
    big = lambda values: F.filter(F.coalesce(values, F.array().cast(_NONE)), lambda v: v >= LEAST_TOTAL)
    rounded = lambda values: F.transform(values, lambda v: F.round(v, 2))
    base = F.array_distinct(rounded(F.concat(big(totals), big(extra)) if extra is not None else big(totals)))
    lines = F.coalesce(total_lines, F.array().cast(f"array<{_NONE}>")) if total_lines is not None else F.array().cast(f"array<{_NONE}>")
    lines = F.transform(F.slice(lines, 1, 300), big)
    by_line = F.flatten(F.transform(lines, lambda v: F.concat(rounded(v), F.when(F.size(v) >= 2, F.array(F.round(_sum(v), 2))).otherwise(F.array().cast(_NONE)))))
    whole = _sum(base)
    guesses = F.array(F.round(whole, 2), F.round(whole - F.array_max(base), 2), F.round(whole / 2, 2))
    derived = F.array().cast(_NONE) if strict else F.when(F.size(base) > 0, guesses).otherwise(F.array().cast(_NONE))
    return F.array_sort(F.array_distinct(F.concat(base, by_line, derived)))


def nearest(values: Column, x: Column) -> Column:
    """The value nearest to x, the smaller of two as near; null for an empty array."""
    return F.array_min(F.transform(values, lambda v: F.struct(F.abs(v - x).alias("d"), v.alias("v"))))["v"]


def nearest_rows(values: DataFrame, known: DataFrame, by: str = "doc_id") -> DataFrame:
    """values (by, x and others) with nearest: the value v of known (by, v) with the same key that is nearest to x, the smaller of two as near; null without
    one. As `nearest`, for keys with any number of candidates: no array of them is made.

    Both sides are sorted together by ranges of key and value of about RANGE_ROWS rows, so a key may span many partitions, and what a task holds does not
    grow with the tables. In a partition the last candidate up to a value
    and the first from it on are carried by windows over its rows; what lies beyond its ends comes from the partitions' outermost
    candidates, one row a partition and key.
    """
    rows = values.withColumns({"_side": F.lit(1), "_at": F.col("x")}).unionByName(known.select(by, F.col("v").alias("_at")).distinct().withColumn("_side", F.lit(0)), allowMissingColumns=True)
    spread = F.xxhash64(F.struct(*(F.col(c) for c in values.columns)))
    # Written: a task that is run again must not deal by other ranges. Equal values may be split anywhere, candidates come before them.
    parts_of = lambda n: max(1, -(-n // RANGE_ROWS))
    n = parts_of(values.count() + known.count())
    placed = rows.withColumn("_tie", spread).repartitionByRange(n, by, F.col("_at").asc_nulls_last(), "_side", "_tie")
    placed = stored(placed.withColumn("_part", F.spark_partition_id()), "nearest")
    own = F.when(F.col("_side") == 0, F.col("_at"))
    ends = placed.groupBy("_part", by).agg(F.min(own).alias("_least"), F.max(own).alias("_most"))
    parts = Window.partitionBy(by).orderBy("_part")
    before, behind = parts.rowsBetween(Window.unboundedPreceding, -1), parts.rowsBetween(1, Window.unboundedFollowing)
    ends = ends.withColumns({"_below": F.max("_most").over(before), "_above": F.min("_least").over(behind)}).select(F.col("_part").alias("_p"), F.col(by).alias("_k"), "_below", "_above")
    # As many partitions as ranges, by their number: AQE would put small ones together, or a fixed number of them grow.
    placed = placed.repartition(n, "_part")
    here = Window.partitionBy("_part", by)
    up = here.orderBy(F.col("_at").asc_nulls_last(), "_side").rowsBetween(Window.unboundedPreceding, 0)
    down = here.orderBy(F.col("_at").desc_nulls_first(), F.desc("_side")).rowsBetween(Window.unboundedPreceding, 0)
    df = placed.withColumns({"_low": F.last(own, ignorenulls=True).over(up), "_high": F.last(own, ignorenulls=True).over(down)}).filter("_side = 1")
    df = df.join(ends, (F.col("_part") == F.col("_p")) & F.col(by).eqNullSafe(F.col("_k")), "left")
    low, high = F.coalesce("_low", "_below"), F.coalesce("_high", "_above")
    best = F.when(low.isNull() | (high - F.col("x") < F.col("x") - low), high).otherwise(low)
    return df.withColumn("nearest", F.when(F.col("x").isNotNull(), best)).select(*values.columns, "nearest")


def total_check(values: Column, x: Column, best: Column | None = None) -> Column:
    """match, mismatch or no_total_printed. A sum of 0 or null matches nothing. best: the nearest value, if it is known."""
    best = nearest(values, x) if best is None else best
    return F.when(F.size(values) == 0, "no_total_printed").when((x != 0) & (F.abs(best - x) <= TOTAL_TOLERANCE * best), "match").otherwise("mismatch")


def printed_total(totals: Column, extra: Column | None = None) -> Column:
    """Whether a total of at least LEAST_TOTAL is printed; larger values on a line whose total is smaller don't count."""
    some = lambda values: F.exists(F.coalesce(values, F.array().cast(_NONE)), lambda v: v >= LEAST_TOTAL)
    return some(totals) if extra is None else some(totals) | some(extra)


def hits_any(values: Column, x: Column) -> Column:
    return F.exists(values, lambda c: F.abs(x - c) <= TOTAL_TOLERANCE * c)


def is_total_row(name: Column) -> Column:
    return F.coalesce(name, F.lit("")).rlike(TOTAL_LABEL)


def total_row_values(rows: DataFrame) -> DataFrame:
    """doc_id, extra: the distinct amounts (net, else shares, if readable) of raw rows that are labelled as totals, in order."""
    readable = lambda c: F.when(~unreadable(), F.col(c))
    value = F.coalesce(readable("net_amount"), readable("shares"))
    return rows.filter(is_total_row(F.col("holder_name_raw"))).groupBy("doc_id").agg(F.array_sort(F.collect_set(value)).alias("extra"))


def unreadable() -> Column:
    return F.coalesce((F.abs("net_amount") >= UNREADABLE_FROM) | (F.abs("shares") >= UNREADABLE_FROM), F.lit(False))


def mostly_shares(kind: Column) -> Column:
    """An aggregate: whether over half of the rows are of a share type."""
    return F.avg(kind.isin(*SHARE_TYPES).cast("double")) > 0.5


def upper_median(values: Column) -> Column:
    """The middle of an array in order, the upper one of two."""
    return F.get(F.array_sort(values), F.floor(F.size(values) / 2).cast("int"))


def _sum_in_any_order(values: Column) -> Column:
    """An aggregate: the sum of doubles under UNREADABLE_FROM, 0.0 without any. Added as decimals, so equal values have equal sums in whatever order
    they come; as doubles the last digits would differ by it."""
    return F.coalesce(F.sum(values.cast("decimal(28,18)")).cast("double"), F.lit(0.0))


def method_scores(rows: DataFrame, stats: DataFrame) -> DataFrame:
    """doc_id, method, check, error, extracted, rows of every extractor's rows (doc_id, method and raw-row columns) against stats.

    The same whatever the order of rows: two extractors with the same amounts err alike, and the earlier one of `choose_method` stays.
    """
    total = is_total_row(F.col("holder_name_raw"))
    kept = F.when(~total, F.col("dividend_type"))
    readable = lambda c: F.when(~total & (F.abs(c) < UNREADABLE_FROM), F.col(c))
    sums = rows.groupBy("doc_id", "method").agg(
        F.count_if(~total).alias("rows"),
        F.avg(F.when(kept.isNotNull(), kept.isin(*SHARE_TYPES).cast("double"))).alias("share"),
        _sum_in_any_order(readable("shares")).alias("_shares"),
        _sum_in_any_order(readable("net_amount")).alias("_net"),
    )
    # Apart from the sums, which need no lists then; few rows are totals.
    extra = rows.filter(total).groupBy("doc_id", "method").agg(F.array_sort(F.collect_set("net_amount")).alias("extra"))
    df = sums.join(extra, ["doc_id", "method"], "left").join(stats.select("doc_id", "totals", "total_lines"), "doc_id", "left")
    df = df.withColumn("extracted", F.when(F.col("share") > 0.5, F.col("_shares")).otherwise(F.col("_net")))
    df = df.withColumn("_c", candidates(F.col("totals"), F.col("total_lines"), F.col("extra")))
    # A column of its own: the search would be repeated wherever it is named.
    df = df.withColumn("_best", nearest(F.col("_c"), F.col("extracted")))
    best, some = F.col("_best"), F.col("rows") > 0
    check = F.when(some, total_check(F.col("_c"), F.col("extracted"), best)).otherwise("n/a")
    error = F.when(~some, 9e9).when(best.isNull(), 0.0).when(best == 0, 9e9).otherwise(F.abs(F.col("extracted") - best) / best)
    return df.select("doc_id", "method", check.alias("check"), error.alias("error"), F.when(some, F.col("extracted")).otherwise(0.0).alias("extracted"), "rows")


def year_scores(sums: DataFrame, values: DataFrame) -> DataFrame:
    """doc_id, years, hits, median_error, near_share of positive sums by year (doc_id, year, v) against candidates (doc_id, candidates)."""
    df = sums.filter("v > 0").join(values, "doc_id", "left").withColumn("candidates", F.coalesce("candidates", F.array().cast(_NONE)))
    relative = F.array_min(F.transform(F.filter("candidates", lambda c: c != 0), lambda c: F.abs(F.col("v") - c) / c))
    df = df.withColumn("e", relative).withColumn("hit", hits_any(F.col("candidates"), F.col("v")))
    out = df.groupBy("doc_id").agg(F.count("*").alias("years"), F.count_if("hit").alias("hits"), F.collect_list("e").alias("_e"), F.avg(F.when(F.col("e") <= APPROX_ERROR, 1.0).otherwise(0.0)).alias("near_share"))
    return out.select("doc_id", "years", "hits", F.coalesce(upper_median(F.col("_e")), F.lit(9e9)).alias("median_error"), "near_share")


def year_report(sums: DataFrame, values: DataFrame) -> DataFrame:
    """doc_id, year, n, v, nearest, verdict (OK or BAD) of sums by year (doc_id, year, n, v) against candidates (doc_id, candidates):
    OK within TOTAL_TOLERANCE of the nearest candidate; BAD without one, or if it is 0."""
    df = sums.join(values, "doc_id", "left").withColumn("nearest", nearest(F.col("candidates"), F.col("v")))
    ok = F.coalesce((F.col("nearest") != 0) & (F.abs(F.col("nearest") - F.col("v")) <= TOTAL_TOLERANCE * F.col("nearest")), F.lit(False))
    return df.select("doc_id", "year", "n", "v", "nearest", F.when(ok, "OK").otherwise("BAD").alias("verdict"))


def choose_method(scores: DataFrame, years: DataFrame) -> DataFrame:
    """doc_id, method, check, error, extracted, rows, approximate: the extractor that each document's rows are taken from.

    Year columns win with two years or more if all hit, or only they match, or they come near enough. Otherwise columns and then paired
    lines replace what is best so far if they match and it doesn't, or it doesn't and they err less, unless they extract over
    three times as much. Scores are brought side by side, one row a document.
    """
    parts = ["check", "error", "extracted", "rows"]
    wide = scores.groupBy("doc_id").pivot("method", ["text_regex", "year_columns", "column_position", "paired_lines"]).agg(F.first(F.struct(*parts)))
    df = wide.join(years, "doc_id", "left")
    empty = F.struct(F.lit("n/a").alias("check"), F.lit(9e9).alias("error"), F.lit(0.0).alias("extracted"), F.lit(0).cast("long").alias("rows"))
    base = F.coalesce("text_regex", empty)
    y = F.col("year_columns")
    approx = (F.col("years") >= APPROX_YEARS) & (F.col("near_share") >= APPROX_SHARE) & (F.col("median_error") <= APPROX_ERROR) & (base["check"] != "match")
    by_year = (y["rows"] > 0) & (F.col("years") >= 2) & ((F.col("hits") == F.col("years")) | ((y["check"] == "match") & (base["check"] != "match")) | approx)
    by_year = F.coalesce(by_year, F.lit(False))
    df = df.withColumn("_year", by_year).withColumn("_best", F.struct(F.when(by_year, "year_columns").otherwise("text_regex").alias("method"), F.when(by_year, y).otherwise(base).alias("s")))
    for name in ("column_position", "paired_lines"):
        s, best = F.col(name), F.col("_best.s")
        better = (s["rows"] > 0) & (s["extracted"] <= EXTRACTOR_GUARD * F.greatest(best["extracted"], F.lit(1.0))) & (best["check"] != "match") & ((s["check"] == "match") | ((s["check"] != "n/a") & (s["error"] < best["error"])))
        take = ~F.col("_year") & F.coalesce(better, F.lit(False))
        df = df.withColumn("_best", F.when(take, F.struct(F.lit(name).alias("method"), s.alias("s"))).otherwise(F.col("_best")))
    return df.select("doc_id", "_best.method", *(f"_best.s.{p}" for p in parts), (F.col("_year") & F.coalesce(approx & (F.col("hits") != F.col("years")), F.lit(False))).alias("approximate"))


def guard_rows(rows: DataFrame) -> DataFrame:
    """Raw rows with a tags array: unreadable amounts made null, total rows and stray whole-number rows dropped, implausible ones tagged."""
    from ..functions.scalars import ADDRESS_WORDS, with_tag
    from ..schemas import IMPLAUSIBLE_OVER
    df = rows.withColumn("_big", unreadable()).withColumn("tags", with_tag(tag_list(F.col("issues")), "unreadable_amount", F.col("_big")))
    df = df.withColumns({c: F.when(~F.col("_big"), F.col(c)) for c in ("net_amount", "shares")}).filter(~is_total_row(F.col("holder_name_raw")))
    stray = has_tag(F.col("tags"), "int_amount")
    share = F.avg(stray.cast("double")).over(Window.partitionBy("doc_id"))
    df = df.withColumn("_share", share).filter(~(stray & (F.col("_share") < 0.5)))
    df = df.withColumn("tags", with_tag(F.col("tags"), "implausible_amount", F.coalesce(F.col("net_amount") > IMPLAUSIBLE_OVER, F.lit(False))))
    address = F.upper(F.coalesce("holder_name_raw", F.lit(""))).rlike(ADDRESS_WORDS)
    return df.withColumn("tags", with_tag(F.col("tags"), "name_looks_like_address", address)).drop("_big", "_share")


def resolve_ambiguous(rows: DataFrame, values: DataFrame) -> DataFrame:
    """Share rows with several numbers (runs: array of them; tags) take the last, else the first of each run, if the document's total then
    matches a candidate (values: doc_id, candidates); otherwise they stay as they are."""
    doubtful = has_tag(F.col("tags"), "stock_ambiguous_numbers") & F.col("shares").isNull() & (F.size("runs") > 0)
    w = Window.partitionBy("doc_id")
    df = rows.join(values, "doc_id", "left").withColumn("_d", F.coalesce(doubtful, F.lit(False)))
    picks = {"last": F.element_at("runs", -1), "first": F.get("runs", F.lit(0))}
    known = F.coalesce(F.sum("shares").over(w), F.lit(0.0))
    for name, pick in picks.items():
        sums = known + F.coalesce(F.sum(F.when(F.col("_d"), pick)).over(w), F.lit(0.0))
        ok = total_check(F.coalesce("candidates", F.array().cast(_NONE)), sums) == "match"
        df = df.withColumn(f"_{name}", ok & F.max("_d").over(w))
    use = F.when(F.col("_last"), "last").when(F.col("_first"), "first")
    new = F.when(F.col("_d") & (use == "last"), picks["last"]).when(F.col("_d") & (use == "first"), picks["first"]).otherwise(F.col("shares"))
    tag = F.concat(F.lit("shares_"), use, F.lit("_number_verified_by_total"))
    tags = F.when(F.col("_d") & use.isNotNull(), F.transform("tags", lambda t: F.when(t == "stock_ambiguous_numbers", tag).otherwise(t))).otherwise(F.col("tags"))
    return df.withColumn("shares", new).withColumn("tags", tags).drop("_d", "_last", "_first", "candidates")


def flagged(tags: Column) -> Column:
    """Whether a row has a tag that isn't informational."""
    return F.size(F.array_except(tags, F.array(*map(F.lit, INFORMATIONAL)))) > 0


def document_verdict(rows: DataFrame, stats: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    """extracted_total, stated_total, total_check, flagged share, status and coverage of every document with stats; rows have tags.

    extra: doc_id and the amounts of total-labelled rows, which guard_rows has dropped (total_row_values); they are totals like the printed ones.
    Without a total of at least LEAST_TOTAL nothing is stated, whatever else a total's line holds. Statistics may have ocr_rows: documents
    with rows from recognised pages are partial. A mismatch becomes a match if two or more years match a candidate and no more years miss than totals are unreadable.
    """
    share = rows.groupBy("doc_id").agg(
        F.count("*").alias("rows_extracted"), mostly_shares(F.col("dividend_type")).alias("_s"), F.coalesce(F.sum("shares"), F.lit(0.0)).alias("_shares"),
        F.coalesce(F.sum("net_amount"), F.lit(0.0)).alias("_net"), F.avg(flagged(F.col("tags")).cast("double")).alias("flagged"),
    )
    recognised = F.col("ocr_rows") if "ocr_rows" in stats.columns else F.lit(0)
    df = stats.select("doc_id", "totals", "total_lines", "textless_pages", "unparsed_idlike", "unreadable_totals", recognised.alias("_ocr")).join(share, "doc_id", "left")
    df = df.withColumn("extra", F.array().cast(_NONE)) if extra is None else df.join(extra.select("doc_id", "extra"), "doc_id", "left")
    df = df.withColumn("extracted_total", F.coalesce(F.when(F.col("_s"), F.col("_shares")).otherwise(F.col("_net")), F.lit(0.0)))
    held = F.when(printed_total(F.col("totals"), F.col("extra")), candidates(F.col("totals"), F.col("total_lines"), F.col("extra"))).otherwise(F.array().cast(_NONE))
    df = df.withColumn("_c", held).withColumn("stated_total", nearest(F.col("_c"), F.col("extracted_total")))
    years = rows.groupBy("doc_id", "dividend_year").agg(F.sum("shares").alias("_ys"), F.sum("net_amount").alias("_yn"))
    years = years.join(df.select("doc_id", "_c", "_s"), "doc_id").withColumn("v", F.when(F.col("_s"), F.col("_ys")).otherwise(F.col("_yn"))).filter("v <> 0")
    years = years.groupBy("doc_id").agg(F.count_if(hits_any(F.col("_c"), F.col("v"))).alias("_hit"), F.count_if(~hits_any(F.col("_c"), F.col("v"))).alias("_miss"))
    df = df.join(years, "doc_id", "left").na.fill(0, ["_hit", "_miss", "rows_extracted"])
    check = total_check(F.col("_c"), F.col("extracted_total"))
    check = F.when((check == "mismatch") & (F.col("_hit") >= 2) & (F.col("_miss") <= F.coalesce("unreadable_totals", F.lit(0))), "match").otherwise(check)
    df = df.withColumn("total_check", check).withColumn("flagged", F.coalesce("flagged", F.lit(1.0)))
    ok = (F.col("total_check") != "mismatch") & (F.col("flagged") < FLAGGED_BELOW) & (F.col("textless_pages") == 0) & (F.col("unparsed_idlike") <= F.greatest(F.lit(2.0), 0.01 * F.col("rows_extracted"))) & (F.col("rows_extracted") > 0) & (F.coalesce("_ocr", F.lit(0)) == 0)
    return df.select("doc_id", "rows_extracted", F.round("extracted_total", 2).alias("extracted_total"), "stated_total", "total_check", "flagged", F.when(ok, "parsed").otherwise("partial").alias("status"), coverage(F.col("extracted_total"), F.col("stated_total")).alias("coverage_pct"))


def coverage(extracted: Column, stated: Column) -> Column:
    """Percent of the stated total, where it is over 0."""
    return F.when(stated > 0, F.round(F.try_divide(extracted * 100, stated), 1))
