"""The operators applied to whole tables, and the same results as SQL.

Tables stand in for the engine's own records: orders for items of holders, customers for holders, order priorities for companies,
lines of orders for extracted rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions import scalars as S, sql
from ..operators import lines as L, lookup, marts, records, resolve, route, totals
from ..sources import readers, sinks
from ..streaming import access, gate, ingest

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _clerk() -> Column:
    """A text for each customer."""
    return F.concat(F.lit("Clerk#"), F.col("o_custkey").cast("string"))


def items(spark: SparkSession, d: str) -> DataFrame:
    """Orders as items: customers are holders, priorities companies; some are doubtful, settled, institutional."""
    o = _table(spark, d, "orders")
    key = F.col("o_orderkey")
    tags = F.concat(F.when(F.col("o_totalprice") > 400000, F.array(F.lit("implausible_amount"))).otherwise(F.array().cast("array<string>")), F.when(F.col("o_custkey") % 11 == 0, F.array(F.lit("institution"))).otherwise(F.array().cast("array<string>")))
    return o.select(
        F.concat(F.lit("H"), F.col("o_custkey").cast("string")).alias("holder_id"), key.alias("row_idx"),
        F.when(F.col("o_custkey") % 3 == 0, F.lpad(F.col("o_custkey").cast("string"), 16, "0")).otherwise("").alias("bo_id"),
        F.col("o_orderpriority").alias("company"), F.when(F.col("o_custkey") % 3 != 0, F.concat(F.lit("f "), (F.col("o_custkey") % 50).cast("string"))).otherwise("").alias("folio_no"),
        F.concat(F.col("o_orderstatus"), F.lit("-"), (key % 4).cast("string")).alias("name"), F.when(F.col("o_orderstatus") == "P", "stock").otherwise("cash").alias("dividend_type"),
        F.col("o_totalprice").alias("net"), (key % 100).cast("double").alias("shares"), F.year("o_orderdate").cast("long").alias("year_start"), tags.alias("tags"),
        F.when(F.col("o_custkey") % 7 == 0, 1).otherwise(0).alias("settled_flag"), F.col("o_orderdate").alias("at"),
    )


_ITEMS = """items AS (
  SELECT 'H' || o_custkey AS holder_id, o_orderkey AS row_idx, CASE WHEN o_custkey % 3 = 0 THEN lpad(CAST(o_custkey AS VARCHAR), 16, '0') ELSE '' END AS bo_id,
    o_orderpriority AS company, CASE WHEN o_custkey % 3 <> 0 THEN 'f ' || (o_custkey % 50) ELSE '' END AS folio_no, o_orderstatus || '-' || (o_orderkey % 4) AS name,
    CASE WHEN o_orderstatus = 'P' THEN 'stock' ELSE 'cash' END AS dividend_type, o_totalprice AS net, CAST(o_orderkey % 100 AS DOUBLE) AS shares,
    CAST(year(o_orderdate) AS BIGINT) AS year_start, o_totalprice > 400000 AS doubtful, o_custkey % 11 = 0 AS inst, CASE WHEN o_custkey % 7 = 0 THEN 1 ELSE 0 END AS settled
  FROM orders)"""

_MART = f"""{_ITEMS},
names AS (SELECT holder_id, name FROM (SELECT holder_id, name, row_number() OVER (PARTITION BY holder_id ORDER BY count(*) DESC, name) AS r FROM items GROUP BY holder_id, name) WHERE r = 1),
mart AS (SELECT i.holder_id, coalesce(max(bo_id) FILTER (bo_id <> ''), '') AS bo_id,
    coalesce(array_to_string(list_sort(list_distinct(list(company || ':' || folio_no) FILTER (folio_no <> ''))), '; '), '') AS folio_numbers, any_value(n.name) AS name_canonical,
    array_to_string(list_sort(list_distinct(list(i.name)))[1:8], '; ') AS name_variants, count(DISTINCT company) AS companies_count, count(*) AS items_count,
    round(coalesce(sum(net) FILTER (dividend_type <> 'stock' AND NOT doubtful), 0), 2) AS total_cash, round(coalesce(sum(net) FILTER (dividend_type <> 'stock' AND doubtful), 0), 2) AS total_cash_unverified,
    round(sum(shares), 2) AS total_shares, min(year_start) AS first_year, max(year_start) AS last_year, CAST(bool_and(settled = 1) AS INTEGER) AS settled_all, CAST(bool_or(inst) AS INTEGER) AS institution
  FROM items i JOIN names n ON i.holder_id = n.holder_id GROUP BY i.holder_id)"""


@query(f"WITH {_MART} SELECT * FROM mart")
def holder_mart(spark, d):
    return marts.holder_mart(items(spark, d))


@query(f"WITH {_MART} SELECT i.holder_id, name_canonical, companies_count, i.row_idx, i.company, i.net FROM items i JOIN mart m ON i.holder_id = m.holder_id")
def holder_items(spark, d):
    own = items(spark, d)
    return marts.holder_items(marts.holder_mart(own), own).select("holder_id", "name_canonical", "companies_count", "row_idx", "company", "net")


@query(f"WITH {_MART} SELECT holder_id, total_cash, companies_count FROM mart WHERE (total_cash >= 2000000 OR companies_count >= 5) AND settled_all = 0 AND institution = 0")
def top_holders(spark, d):
    return marts.top_holders(marts.holder_mart(items(spark, d)), 2_000_000.0, 5).select("holder_id", "total_cash", "companies_count")


@query("SELECT c_mktsegment AS company, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1 ORDER BY total DESC, company LIMIT 3")
def cash_by_company(spark, d):
    df = _table(spark, d, "orders").join(_table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return marts.largest_groups(df.withColumnRenamed("c_mktsegment", "company"), "company", "o_totalprice", 3)


@query("SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, round(sum(o_totalprice), 2) AS total, count(*) AS n FROM orders GROUP BY 1")
def cash_by_year(spark, d):
    return marts.sums_by(_table(spark, d, "orders").withColumn("yr", F.year("o_orderdate")), ["yr"], "o_totalprice")


@query("SELECT doc_id AS id, sha256(text) AS sha256, CASE WHEN doc_id <> f THEN f END AS duplicate_of FROM (SELECT *, min(doc_id) OVER (PARTITION BY sha256(text)) AS f FROM documents)")
def duplicate_files(spark, d):
    files = _table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("doc_id").alias("position"), F.sha2("text", 256).alias("sha256"))
    return resolve.mark_duplicate_files(files).select("id", "sha256", "duplicate_of")


@query("SELECT l_orderkey, l_linenumber, l_partkey > 10 AND count(*) OVER (PARTITION BY l_partkey, l_suppkey, l_quantity) > 1 AS dup_row FROM lineitem")
def repeated_rows(spark, d):
    df = _table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return resolve.mark_repeated_rows(df, [F.col("l_partkey"), F.col("l_suppkey"), F.col("l_quantity")], F.col("l_partkey") > 10).select("l_orderkey", "l_linenumber", "dup_row")


@query("SELECT l_orderkey, l_linenumber FROM lineitem QUALIFY l_orderkey = min(l_orderkey) OVER (PARTITION BY l_partkey, l_suppkey, l_quantity)")
def first_document_rows(spark, d):
    df = _table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return resolve.keep_first_document(df, ["l_partkey", "l_suppkey", "l_quantity"], "l_orderkey").select("l_orderkey", "l_linenumber")


@query(f"""WITH {_ITEMS},
s AS (SELECT bo_id, company, folio_no, CASE WHEN row_idx % 10 <> 0 THEN net END AS amount FROM items WHERE row_idx % 5 = 0),
a AS (SELECT DISTINCT bo_id, round(amount, 2) AS x FROM s WHERE bo_id <> '' AND amount IS NOT NULL),
f AS (SELECT DISTINCT company, replace(folio_no, ' ', '') AS k, round(amount, 2) AS x FROM s WHERE folio_no <> '' AND amount IS NOT NULL)
SELECT row_idx, CAST(a.x IS NOT NULL OR f.x IS NOT NULL AS INTEGER) AS settled_flag FROM items i
LEFT JOIN a ON i.bo_id = a.bo_id AND round(i.net, 2) = a.x LEFT JOIN f ON i.company = f.company AND replace(i.folio_no, ' ', '') = f.k AND round(i.net, 2) = f.x""")
def settled_flags(spark, d):
    rows = items(spark, d).withColumn("amount", F.col("net"))
    claims = rows.filter("row_idx % 5 = 0").withColumn("amount", F.when(F.col("row_idx") % 10 != 0, F.col("net")))
    return resolve.settled_flags(rows.select("row_idx", "bo_id", "company", "folio_no", "amount"), claims).select("row_idx", "settled_flag")


_ORDER_TOTALS = """o AS (SELECT l_orderkey, list(round(l_extendedprice, 2) ORDER BY l_linenumber) AS lines, sum(l_extendedprice) AS ext FROM lineitem GROUP BY 1),
b AS (SELECT o_orderkey AS doc_id, coalesce(ext, 0) AS ext, list_distinct(list_filter([floor(o_totalprice / 2) * 2], lambda v: v >= 100)) AS t, list_filter(coalesce(lines, []), lambda v: v >= 100) AS nums
  FROM orders LEFT JOIN o ON o_orderkey = l_orderkey),
c AS (SELECT doc_id, ext, list_sort(list_distinct(list_concat(t, nums, CASE WHEN len(nums) >= 2 THEN [round(list_sum(nums), 2)] ELSE [] END,
  CASE WHEN len(t) > 0 THEN [round(list_sum(t), 2), round(list_sum(t) - list_max(t), 2), round(list_sum(t) / 2, 2)] ELSE [] END))) AS cands FROM b)"""


def _printed():
    """An even whole number near the order's total, so that its half has no digits to round."""
    return (F.floor(F.col("o_totalprice") / 2) * 2).cast("double")


def _order_totals(spark: SparkSession, d: str) -> DataFrame:
    """Orders as documents: the order's total is what is printed, its lines' prices a line of totals, their sum what was extracted."""
    line = F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", F.round("l_extendedprice", 2).alias("v")))), lambda x: x["v"])
    found = _table(spark, d, "lineitem").groupBy("l_orderkey").agg(line.alias("lines"), F.sum("l_extendedprice").alias("ext"))
    df = _table(spark, d, "orders").join(found, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    lines = F.when(F.col("lines").isNotNull(), F.array("lines"))
    return df.select(F.col("o_orderkey").alias("doc_id"), F.coalesce("ext", F.lit(0.0)).alias("ext"), totals.candidates(F.array(_printed()), lines).alias("cands"))


@query(f"WITH {_ORDER_TOTALS} SELECT doc_id, CAST(len(cands) AS INTEGER) AS n, round(list_sum(cands), 0) AS total FROM c")
def total_candidates(spark, d):
    return _order_totals(spark, d).select("doc_id", F.size("cands").alias("n"), F.round(F.aggregate("cands", F.lit(0.0), lambda a, v: a + v), 0).alias("total"))


@query(f"""WITH {_ORDER_TOTALS}, p AS (SELECT doc_id, ext, o_totalprice AS t FROM c JOIN orders ON doc_id = o_orderkey)
SELECT doc_id, t AS stated, CASE WHEN ext <> 0 AND abs(t - ext) <= 0.005 * t THEN 'match' ELSE 'mismatch' END AS total_check FROM p""")
def control_total_check(spark, d):
    df = _order_totals(spark, d).select("doc_id", "ext").join(_table(spark, d, "orders").select(F.col("o_orderkey").alias("doc_id"), "o_totalprice"), "doc_id")
    printed = F.array("o_totalprice")
    return df.select("doc_id", totals.nearest(printed, F.col("ext")).alias("stated"), totals.total_check(printed, F.col("ext")).alias("total_check"))


@query(f"WITH {_ORDER_TOTALS} SELECT doc_id, list_sort(list_transform(cands, lambda v: {{'d': abs(v - (ext / 2)), 'v': v}}))[1].v AS nearest FROM c WHERE len(cands) > 0")
def nearest_total(spark, d):
    return _order_totals(spark, d).select("doc_id", totals.nearest(F.col("cands"), F.col("ext") / 2).alias("nearest")).filter("nearest IS NOT NULL")


_YEARLY = """y AS (SELECT l_suppkey AS doc_id, CAST(year(l_shipdate) AS VARCHAR) AS dividend_year, sum(l_extendedprice) AS v FROM lineitem GROUP BY 1, 2),
k AS (SELECT l_suppkey AS doc_id, list(v) AS cands FROM (SELECT l_suppkey, year(l_shipdate) AS g, round(sum(l_extendedprice * (CASE WHEN year(l_shipdate) % 2 = 0 THEN 1 ELSE 1 - l_discount END)), 2) AS v FROM lineitem GROUP BY 1, 2) GROUP BY 1),
e AS (SELECT y.doc_id, v, list_min(list_transform(cands, lambda c: abs(v - c) / c)) AS err, len(list_filter(cands, lambda c: abs(v - c) <= 0.005 * c)) > 0 AS hit FROM y JOIN k ON y.doc_id = k.doc_id WHERE v > 0)"""


@query(f"WITH {_YEARLY} SELECT doc_id, count(*) AS years, count(*) FILTER (hit) AS hits, round(list_sort(list(err))[CAST(floor(count(*) / 2) AS BIGINT) + 1], 6) AS median_error, round(avg(CASE WHEN err <= 0.06 THEN 1.0 ELSE 0.0 END), 6) AS near_share FROM e GROUP BY 1")
def year_scores(spark, d):
    li = _table(spark, d, "lineitem").select(F.col("l_suppkey").alias("doc_id"), F.year("l_shipdate").alias("yr"), "l_extendedprice", "l_discount")
    sums = li.groupBy("doc_id", "yr").agg(F.sum("l_extendedprice").alias("v"))
    printed = F.when(F.col("yr") % 2 == 0, F.col("l_extendedprice")).otherwise(F.col("l_extendedprice") * (1 - F.col("l_discount")))
    values = li.groupBy("doc_id", "yr").agg(F.round(F.sum(printed), 2).alias("c")).groupBy("doc_id").agg(F.collect_list("c").alias("candidates"))
    return totals.year_scores(sums, values).withColumns({c: F.round(c, 6) for c in ("median_error", "near_share")})


@query("""WITH r AS (SELECT l_orderkey AS doc_id, sum(l_extendedprice) AS base, sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)) AS col, sum(l_extendedprice * 0.999) FILTER (l_linenumber > 1) AS pair, count(*) FILTER (l_linenumber > 1) AS pair_rows FROM lineitem GROUP BY 1),
t AS (SELECT doc_id, base, col, pair, pair_rows, floor(o_totalprice / 2) * 2 AS c FROM r JOIN orders ON doc_id = o_orderkey),
s AS (SELECT doc_id, m, x, CASE WHEN n = 0 THEN 'n/a' WHEN x <> 0 AND abs(b - x) <= 0.005 * b THEN 'match' ELSE 'mismatch' END AS ck, CASE WHEN n = 0 THEN 9e9 WHEN b = 0 THEN 9e9 ELSE abs(x - b) / b END AS er, n FROM (
  SELECT *, list_sort(list_transform([c, 0.0::DOUBLE, round(c / 2, 2)], lambda v: {'d': abs(v - x), 'v': v}))[1].v AS b FROM (
    SELECT doc_id, c, 1 AS m, base AS x, 1 AS n FROM t UNION ALL SELECT doc_id, c, 2, col, 1 FROM t UNION ALL SELECT doc_id, c, 3, coalesce(pair, 0), pair_rows FROM t))),
w AS (SELECT doc_id, max(ck) FILTER (m = 1) AS ck1, max(er) FILTER (m = 1) AS er1, max(x) FILTER (m = 1) AS x1, max(ck) FILTER (m = 2) AS ck2, max(er) FILTER (m = 2) AS er2, max(x) FILTER (m = 2) AS x2,
  max(ck) FILTER (m = 3) AS ck3, max(er) FILTER (m = 3) AS er3, max(x) FILTER (m = 3) AS x3, max(n) FILTER (m = 3) AS n3 FROM s GROUP BY doc_id),
q AS (SELECT *, x2 <= 3 * greatest(x1, 1) AND ck1 <> 'match' AND (ck2 = 'match' OR er2 < er1) AS t2 FROM w),
z AS (SELECT *, CASE WHEN t2 THEN ck2 ELSE ck1 END AS ckb, CASE WHEN t2 THEN er2 ELSE er1 END AS erb, CASE WHEN t2 THEN x2 ELSE x1 END AS xb FROM q)
SELECT doc_id, CASE WHEN n3 > 0 AND x3 <= 3 * greatest(xb, 1) AND ckb <> 'match' AND (ck3 = 'match' OR (ck3 <> 'n/a' AND er3 < erb)) THEN 'paired_lines' WHEN t2 THEN 'column_position' ELSE 'text_regex' END AS method FROM z""")
def method_selection(spark, d):
    price = F.col("l_extendedprice").cast("double")
    amounts = {"text_regex": price, "column_position": price * (1 - F.col("l_discount")) * (1 + F.col("l_tax")), "paired_lines": F.when(F.col("l_linenumber") > 1, price * 0.999)}
    each = F.explode(F.array(*(F.struct(F.lit(k).alias("method"), v.cast("double").alias("net_amount")) for k, v in amounts.items()))).alias("r")
    rows = _table(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc_id"), each).filter("r.net_amount IS NOT NULL")
    rows = rows.select("doc_id", "r.method", F.lit("x").alias("holder_name_raw"), F.lit("cash").alias("dividend_type"), F.lit(None).cast("double").alias("shares"), "r.net_amount")
    stats = _table(spark, d, "orders").select(F.col("o_orderkey").alias("doc_id"), F.array(_printed()).alias("totals"), F.lit(None).cast("array<array<double>>").alias("total_lines"))
    scores = totals.method_scores(rows, stats).join(stats.select("doc_id"), "doc_id", "left_semi")
    none = spark.createDataFrame([], "doc_id long, years long, hits long, median_error double, near_share double")
    return totals.choose_method(scores, none).select("doc_id", "method")


@query("""SELECT l_orderkey, l_linenumber FROM (SELECT *, avg(CASE WHEN l_quantity = floor(l_quantity / 5) * 5 THEN 1.0 ELSE 0.0 END) OVER (PARTITION BY l_orderkey) AS s FROM lineitem)
WHERE NOT (l_quantity = floor(l_quantity / 5) * 5 AND s < 0.5) AND l_extendedprice < 1e9""")
def group_conditional_filter(spark, d):
    li = _table(spark, d, "lineitem")
    rows = li.select(F.col("l_orderkey").alias("doc_id"), "l_orderkey", "l_linenumber", F.lit("name").alias("holder_name_raw"), F.lit(None).cast("double").alias("shares"), F.col("l_extendedprice").alias("net_amount"), F.when(F.col("l_quantity") % 5 == 0, "int_amount").otherwise("").alias("issues"))
    return totals.guard_rows(rows).select("l_orderkey", "l_linenumber")


@query("""WITH p AS (SELECT p_partkey AS row_idx, array_to_string(list_sort(string_split(p_name, ' ')), ' ') AS block, CASE WHEN p_size % 2 = 0 THEN p_brand ELSE '' END AS bo_id, 'H' || p_brand || p_type AS holder_id, p_retailprice AS amount, p_type AS company FROM part),
f AS (SELECT block, holder_id, min(row_idx) AS row_idx FROM p GROUP BY 1, 2),
r AS (SELECT f.block, f.holder_id, f.row_idx, p.bo_id, p.amount, p.company, row_number() OVER (PARTITION BY f.block ORDER BY f.row_idx) AS rk FROM f JOIN p ON f.row_idx = p.row_idx)
SELECT a.block, a.holder_id AS holder_id_a, b.holder_id AS holder_id_b, a.row_idx AS row_idx_a, b.row_idx AS row_idx_b, a.company = b.company AS same_company, a.amount + b.amount AS weight
FROM r a JOIN r b ON a.block = b.block AND a.rk < b.rk AND a.rk <= 6 AND b.rk <= 6 AND NOT (a.bo_id <> '' AND b.bo_id <> '' AND a.bo_id <> b.bo_id) ORDER BY weight DESC, row_idx_a, row_idx_b LIMIT 5000""")
def review_pairs(spark, d):
    p = _table(spark, d, "part")
    rows = p.select(F.col("p_partkey").alias("row_idx"), S.sorted_words(F.col("p_name")).alias("block"), F.size(S.tokens(F.col("p_name"))).alias("n_tokens"), F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).otherwise("").alias("bo_id"), F.concat(F.lit("H"), "p_brand", "p_type").alias("holder_id"), F.col("p_retailprice").alias("amount"), F.col("p_type").alias("company"))
    return resolve.review_pairs(rows, least_tokens=2)


@query(f"""WITH {_ITEMS}, k AS (SELECT row_idx, bo_id, folio_no, CASE WHEN bo_id <> '' THEN 'B' || bo_id WHEN folio_no <> '' THEN 'F' || company || chr(1) || replace(folio_no, ' ', '') ELSE 'R' || row_idx END AS key FROM items),
h AS (SELECT key, min(row_idx) AS f, count(*) AS n FROM k GROUP BY key), i AS (SELECT key, n, 'H' || lpad(CAST(row_number() OVER (ORDER BY f) AS VARCHAR), 6, '0') AS holder_id FROM h)
SELECT row_idx, holder_id, CASE WHEN n < 2 THEN 'unmatched' WHEN bo_id <> '' THEN 'bo_exact' WHEN folio_no <> '' THEN 'folio_company' ELSE 'unmatched' END AS match_method FROM k JOIN i ON k.key = i.key""")
def holder_resolution(spark, d):
    rows = items(spark, d).select("row_idx", "bo_id", "folio_no", "company").withColumn("holder_key", resolve.holder_key(F.col("bo_id"), F.col("company"), F.col("folio_no"), F.col("row_idx")))
    return rows.join(resolve.number_holders(rows), "holder_key").select("row_idx", "holder_id", resolve.match_method(F.col("bo_id"), F.col("folio_no"), F.col("items")).alias("match_method"))


@query("SELECT doc_id, CAST(nullif(regexp_extract(text, '(?:19|20)[0-9]{2}'), '') AS INTEGER) AS year_start FROM documents")
def year_start(spark, d):
    return _table(spark, d, "documents").select("doc_id", S.year_start(F.col("text")).alias("year_start"))


@query(r"""SELECT doc_id, CASE WHEN regexp_matches(s, 'refund') THEN 'ipo_refund' WHEN regexp_matches(s, 'right\s*share|rights?\s*issue') THEN 'right' WHEN regexp_matches(s, 'fraction') THEN 'fraction'
  WHEN regexp_matches(s, 'subscription') THEN 'other' WHEN regexp_matches(s, 'bonus|stock') AND NOT regexp_matches(s, 'cash div') THEN 'stock' WHEN regexp_matches(s, 'cash|dividend|unclaim|unpaid') THEN 'cash' END AS kind
FROM (SELECT doc_id, lower(text) AS s FROM documents)""")
def dividend_type(spark, d):
    return _table(spark, d, "documents").select("doc_id", S.dividend_type(F.col("text")).alias("kind"))


@query(r"""WITH t AS (SELECT c_custkey, list_filter(string_split_regex(regexp_replace(upper('Md. ' || c_name || ' ' || c_mktsegment || CASE WHEN c_custkey % 5 = 0 THEN ' Ltd' ELSE ' Begam' END), '[^A-Z0-9 ]+', ' ', 'g'), ' +'), lambda x: x <> '') AS w FROM customer),
m AS (SELECT c_custkey, list_transform(w, lambda x: CASE x WHEN 'MD' THEN 'MOHAMMAD' WHEN 'BEGAM' THEN 'BEGUM' ELSE x END) AS w FROM t)
SELECT c_custkey, array_to_string(w, ' ') AS name, list_contains(w, 'LTD') AS institution FROM m""")
def name_normalisation(spark, d):
    name = F.concat(F.lit("Md. "), "c_name", F.lit(" "), "c_mktsegment", F.when(F.col("c_custkey") % 5 == 0, " Ltd").otherwise(" Begam"))
    return _table(spark, d, "customer").select("c_custkey", S.normal_name(name).alias("name"), S.is_institution(name).alias("institution"))


@query(r"""SELECT p_partkey, coalesce(nullif(substr(trim(regexp_replace(p_name || ' / ' || p_brand, '[^A-Za-z0-9_-]+', '_', 'g'), '_'), 1, 20), ''), 'file') AS slug,
  upper(regexp_replace(p_brand || ' -' || p_size, '[\s-]', '', 'g')) AS folio_key, regexp_replace(p_brand || p_type || p_size, '[^0-9]', '', 'g') AS digits, array_to_string(list_sort(string_split(p_name, ' ')), ' ') AS sorted_words FROM part""")
def keys_of_text(spark, d):
    p, size = _table(spark, d, "part"), F.col("p_size").cast("string")
    return p.select("p_partkey", S.slug(F.concat("p_name", F.lit(" / "), "p_brand"), 20).alias("slug"), S.folio_key(F.concat("p_brand", F.lit(" -"), size)).alias("folio_key"), S.digits_only(F.concat("p_brand", "p_type", size)).alias("digits"), S.sorted_words(F.col("p_name")).alias("sorted_words"))


@query("SELECT l_orderkey, l_linenumber, round(l_extendedprice, 2) AS price, l_quantity AS quantity FROM lineitem")
def digit_fold_parse(spark, d):
    """Prices are printed with Bengali digits and thousands apart, quantities in parentheses; both are read back."""
    bengali = lambda c: F.translate(c, "0123456789", "".join(chr(0x9E6 + k) for k in range(10)))
    price, quantity = bengali(F.format_number(F.round("l_extendedprice", 2), 2)), bengali(F.concat(F.lit("("), F.format_string("%.1f", "l_quantity"), F.lit(")")))
    read = lambda c: S.number(S.fold_digits(c))
    return _table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", read(price).alias("price"), read(quantity).alias("quantity"))


@query("SELECT l_orderkey, l_linenumber, round(l_extendedprice, 2) AS gross, round(l_discount * 1000 + 1, 2) AS tax, round(round(l_extendedprice, 2) - round(l_discount * 1000 + 1, 2), 2) AS net FROM lineitem")
def amount_triple(spark, d):
    gross, tax = F.round("l_extendedprice", 2), F.round(F.col("l_discount") * 1000 + 1, 2)
    values = F.array(F.col("l_quantity") + 0.5, gross, F.lit(0.25), tax, F.round(gross - tax, 2))
    df = _table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", values.alias("v")).withColumn("t", S.amount_triple(F.col("v")))
    return df.select("l_orderkey", "l_linenumber", "t.gross", "t.tax", F.round("t.net", 2).alias("net"))


@query(r"""WITH a AS (SELECT page_id, url, unnest(regexp_extract_all(html, '<a\b[^>]*?\bhref\s*=\s*["'']([^"'']*)["''][^>]*>', 1)) AS href, generate_subscripts(regexp_extract_all(html, '<a\b[^>]*?\bhref\s*=\s*["'']([^"'']*)["''][^>]*>', 1), 1) AS pos FROM pages),
j AS (SELECT page_id, pos, CASE WHEN regexp_matches(href, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN href WHEN starts_with(href, '//') THEN regexp_extract(url, '^([a-z][a-z0-9+.-]*:)', 1) || href
  WHEN starts_with(href, '/') THEN regexp_extract(url, '^([a-z][a-z0-9+.-]*://[^/?#]*)', 1) || href WHEN starts_with(href, '?') THEN regexp_extract(url, '^([^?#]*)', 1) || href WHEN starts_with(href, '#') THEN regexp_extract(url, '^([^#]*)', 1) || href
  ELSE CASE WHEN regexp_matches(regexp_extract(url, '^([^?#]*)', 1), '^[a-z][a-z0-9+.-]*://[^/]*/') THEN regexp_extract(regexp_extract(url, '^([^?#]*)', 1), '^(.*/)', 1) ELSE regexp_extract(url, '^([^?#]*)', 1) || '/' END || href END AS link FROM a)
SELECT page_id, link, CAST(min(pos) - 1 AS INTEGER) AS position FROM j GROUP BY 1, 2""")
def page_links(spark, d):
    return readers.page_links(_table(spark, d, "pages"), suffix=".", words=".").select("page_id", "link", "position")


@query("SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT doc_id, 'retry' FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 0)")
def work_list(spark, d):
    docs = _table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("id"), "doc_id", "lang")
    labels = _table(spark, d, "labels").select(F.col("doc_id").cast("string").alias("id"), "quality")
    again = docs.join(labels.filter("quality = 0"), "id", "left_semi").withColumn("lang", F.lit("retry"))
    return ingest.undone(docs, labels).unionByName(again).select("doc_id", "lang")


@query("SELECT doc_id AS id, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'new' ELSE 'old' END AS status FROM documents")
def manifest_upsert(spark, d):
    old = _table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("id"), F.lit("old").alias("status"))
    new = _table(spark, d, "labels").select(F.col("doc_id").cast("string").alias("id"), F.lit("new").alias("status"))
    return sinks.upsert(old, new, new).select(F.col("id").cast("long").alias("id"), "status")


@query("""WITH p AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, generate_subscripts(string_split(text, chr(10)), 1) AS page FROM documents),
c AS (SELECT doc_id, max(page) AS n FROM p GROUP BY 1), s AS (SELECT p.doc_id, t FROM p JOIN c ON p.doc_id = c.doc_id WHERE page = 1 OR page = n OR page = n // 2 + 1)
SELECT doc_id, CASE WHEN bool_and(length(trim(t)) > 80) THEN 'text' WHEN bool_or(length(trim(t)) > 80) THEN 'mixed' ELSE 'scanned' END AS pdf_kind, 'en' AS lang FROM s GROUP BY 1""")
def triage_kind(spark, d):
    docs = _table(spark, d, "documents").select("doc_id", F.translate("text", "\n", "\f").alias("text"))
    return records.classify_documents(L.page_sample(L.split_pages(docs)))


@query("SELECT doc_id, CAST(generate_subscripts(string_split(text, chr(10)), 1) AS INTEGER) AS line_no, length(unnest(string_split(text, chr(10)))) AS n FROM documents WHERE length(trim(text)) >= 40")
def line_explode(spark, d):
    docs = _table(spark, d, "documents").select("doc_id", F.lit(1).alias("page"), "text")
    return L.explode_lines(docs).select("doc_id", "line_no", F.length("line").cast("long").alias("n"))


@query("SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN length(text) END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn, text ROWS UNBOUNDED PRECEDING) AS carried FROM conversations")
def carry_down(spark, d):
    df = _table(spark, d, "conversations").withColumn("carried", F.when(F.col("role") == "user", F.length("text").cast("long")))
    return L.carry_down(df, ["conv_id"], ["turn", "text"], ["carried"]).select("conv_id", "turn", "carried")


_PAIRS = "SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn, text) AS k, count(*) OVER (PARTITION BY conv_id, role) AS n FROM conversations"


@query(f"WITH p AS ({_PAIRS}) SELECT a.conv_id, CAST(a.k AS INTEGER) AS k, length(a.text) AS asked, length(b.text) AS answered FROM p a JOIN p b ON a.conv_id = b.conv_id AND a.k = b.k AND a.n = b.n WHERE a.role = 'user' AND b.role = 'assistant'")
def zip_pairs(spark, d):
    c = _table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    df = L.pair_in_order(c.filter("role = 'user'"), c.filter("role = 'assistant'"), ["conv_id"], ["turn", "text"])
    return df.select("conv_id", "k", F.length("left_text").cast("long").alias("asked"), F.length("right_text").cast("long").alias("answered"))


@query("SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS yr, round(sum(o_totalprice), 2) AS v FROM orders WHERE year(o_orderdate) BETWEEN 1995 AND 1997 GROUP BY 1, 2")
def unpivot_years(spark, d):
    years = [1995, 1996, 1997]
    wide = _table(spark, d, "orders").withColumn("yr", F.year("o_orderdate")).groupBy("o_custkey").pivot("yr", years).agg(F.round(F.sum("o_totalprice"), 2))
    cells = F.explode(F.array(*(F.struct(F.lit(y).alias("yr"), F.col(str(y)).alias("v")) for y in years)))
    return wide.select("o_custkey", cells.alias("c")).select("o_custkey", "c.yr", "c.v").filter("v IS NOT NULL")


def _rendered(spark: SparkSession, d: str) -> DataFrame:
    """Orders printed as records: serial, account, name, gross, tax, net; twelve a page, under a title line."""
    gross = F.round("o_totalprice", 2)
    money = lambda c: F.format_number(F.round(c, 2), 2)
    tax = F.floor(gross * 0.1).cast("double")
    name = F.concat(F.lit("HOLDER "), F.when(F.col("o_orderstatus") == "F", "ALPHA").otherwise("BETA"))
    line = F.concat_ws(" ", ((F.col("o_orderkey") % 900) + 1).cast("string"), F.lpad(F.concat(F.lit("12"), F.lpad(F.col("o_orderkey").cast("string"), 14, "0")), 16, "0"), name, money(gross), money(tax), money(gross - tax))
    doc, page = F.floor(F.col("o_orderkey") / 240), F.floor(F.col("o_orderkey") % 240 / 12)
    lines = F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", line.alias("line")))), lambda x: x["line"])
    pages = _table(spark, d, "orders").groupBy(doc.cast("string").alias("doc_id"), (page + 1).cast("int").alias("page")).agg(lines.alias("lines"))
    text = F.array_join(F.concat(F.array(F.lit("Cash dividend for the year 2018-19"), F.lit("")), "lines"), "\n")
    return pages.select("doc_id", F.lit("Unclaimed cash dividend list").alias("title"), "page", text.alias("text"))


@query("""SELECT '12' || lpad(CAST(o_orderkey AS VARCHAR), 14, '0') AS bo_id, 'HOLDER ' || CASE WHEN o_orderstatus = 'F' THEN 'ALPHA' ELSE 'BETA' END AS name, '2018-19' AS dividend_year, round(o_totalprice, 2) AS gross,
  floor(round(o_totalprice, 2) * 0.1) AS tax, round(round(o_totalprice, 2) - floor(round(o_totalprice, 2) * 0.1), 2) AS net FROM orders""")
def line_roundtrip(spark, d):
    rows = records.record_rows(records.extract_records(_rendered(spark, d)))
    return rows.select("bo_id", F.col("holder_name_raw").alias("name"), "dividend_year", F.col("gross_amount").alias("gross"), F.col("tax_amount").alias("tax"), F.col("net_amount").alias("net"))


@query("SELECT CAST(o_orderkey // 240 AS VARCHAR) AS doc_id, CAST(count(DISTINCT o_orderkey % 240 // 12) AS INTEGER) AS pages, CAST(count(*) AS INTEGER) AS rows, round(sum(round(round(o_totalprice, 2) - floor(round(o_totalprice, 2) * 0.1), 2)), 2) AS extracted_total FROM orders GROUP BY 1")
def document_stats(spark, d):
    pages = _rendered(spark, d)
    stats = records.document_stats(records.extract_records(pages), pages)
    return stats.select("doc_id", "pages", "rows", "extracted_total")


_YEARS = """WITH w AS (SELECT *, o_orderkey // 240 AS doc FROM orders), y AS (SELECT o_orderkey, 2017 + k AS yr, round(o_totalprice * (k + 1), 2) AS v FROM w CROSS JOIN (SELECT unnest([0, 1, 2]) AS k))
SELECT '12' || lpad(CAST(o_orderkey AS VARCHAR), 14, '0') AS bo_id, CAST(yr AS VARCHAR) AS dividend_year, v AS net FROM y WHERE v > 0 AND v <= 1000000"""


def _year_pages(spark: SparkSession, d: str) -> DataFrame:
    """Orders printed in a table with a column for each year, right-aligned under the years."""
    cell = lambda k: F.lpad(F.format_string("%.2f", F.round(F.col("o_totalprice") * (k + 1), 2)), 20, " ")
    line = F.concat(F.lit("1 "), _account(), F.lit(" HOLDER ALPHA    "), cell(0), cell(1), cell(2))
    return _as_pages(spark, d, line, [" " * 35 + "".join(str(2017 + k).rjust(20) for k in range(3))], "Dividend list")


@query(_YEARS)
def year_columns(spark, d):
    return records.extract_year_columns(_year_pages(spark, d), columns=["bo_id", "dividend_year", "net_amount"]).select("bo_id", "dividend_year", F.col("net_amount").alias("net"))


@query(_YEARS)
def year_columns_in_sql(spark, d):
    """The same by a table function in SQL text."""
    sql.register(spark)
    _year_pages(spark, d).createOrReplaceTempView("printed_years")
    return spark.sql("SELECT bo_id, dividend_year, net_amount AS net FROM rows_by_year_column(TABLE(printed_years) PARTITION BY doc_id ORDER BY page)")


def _as_pages(spark: SparkSession, d: str, line: Column, head: list[str], title: str) -> DataFrame:
    """Orders as lines of pages under a head, twelve a page."""
    doc, page = F.floor(F.col("o_orderkey") / 240), F.floor(F.col("o_orderkey") % 240 / 12)
    lines = F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", line.alias("line")))), lambda x: x["line"])
    pages = _table(spark, d, "orders").groupBy(doc.cast("string").alias("doc_id"), (page + 1).cast("int").alias("page")).agg(lines.alias("lines"))
    return pages.select("doc_id", F.lit(title).alias("title"), "page", F.array_join(F.concat(F.array(*map(F.lit, head)), "lines"), "\n").alias("text"))


def _account() -> Column:
    return F.concat(F.lit("12"), F.lpad(F.col("o_orderkey").cast("string"), 14, "0"))


@query("SELECT '12' || lpad(CAST(o_orderkey AS VARCHAR), 14, '0') AS bo_id, round(o_totalprice, 2) AS net, CASE WHEN o_orderkey % 5 = 0 THEN 'name_missing;col_amount' ELSE 'col_amount' END AS issues FROM orders")
def column_position(spark, d):
    """Orders in a table whose amounts stand under one of its heads, among other numbers; some rows have no name."""
    name = F.when(F.col("o_orderkey") % 5 == 0, "").otherwise("HOLDER ALPHA")
    line = F.concat(F.lit("1    "), _account(), F.lit("  "), F.rpad(name, 16, " "), F.lpad((F.col("o_orderkey") % 97).cast("string"), 6, " "), F.lpad(F.format_string("%.2f", F.round("o_totalprice", 2)), 18, " "), F.lit("          77"))
    head = "SL   BO ID             Name            Shares      Net Dividend     Remarks"
    return records.extract_by_column(_as_pages(spark, d, line, [head], "Cash dividend list")).select("bo_id", F.col("net_amount").alias("net"), "issues")


_PAGE = "CAST(o_orderkey // 240 AS VARCHAR) AS doc_id, CAST(o_orderkey % 240 // 12 + 1 AS INTEGER) AS page"


@query(f"""WITH p AS (SELECT *, {_PAGE}, row_number() OVER (PARTITION BY o_orderkey // 12 ORDER BY o_orderkey) AS k, bool_or(o_orderkey % 96 = 1) OVER (PARTITION BY o_orderkey // 12) AS odd FROM orders)
SELECT doc_id, page, CAST(k AS INTEGER) AS row_on_page, CAST(100000 + o_orderkey AS VARCHAR) AS warrant_no, 'HOLDER ' || CASE WHEN o_orderstatus = 'F' THEN 'ALPHA' ELSE 'BETA' END AS name, CAST(o_custkey + 10000 AS VARCHAR) AS folio_no,
  round(o_totalprice, 2) + 10.5 AS gross, 10.5 AS tax, round(o_totalprice, 2) AS net FROM p WHERE NOT odd""")
def paired_lines(spark, d):
    """Orders printed on two lines each, identities before amounts; on some pages an amount is missing, and these give nothing."""
    name, net = F.when(F.col("o_orderstatus") == "F", "ALPHA").otherwise("BETA"), F.round("o_totalprice", 2)
    number = F.row_number().over(Window.partitionBy(F.floor(F.col("o_orderkey") / 12)).orderBy("o_orderkey"))
    identity = F.concat_ws(" ", F.lit("1"), F.lit("2019"), (F.col("o_orderkey") + 100000).cast("string"), F.lit("HOLDER"), name)
    amounts = F.concat_ws(" ", (F.col("o_custkey") + 10000).cast("string"), F.lit("REG"), F.format_string("%.2f 10.50 %.2f", net + 10.5, net))
    rows = _table(spark, d, "orders").select(F.floor(F.col("o_orderkey") / 240).cast("string").alias("doc_id"), (F.floor(F.col("o_orderkey") % 240 / 12) + 1).cast("int").alias("page"), number.alias("k"), identity.alias("a"), F.when(F.col("o_orderkey") % 96 != 1, amounts).alias("b"))
    column = lambda c: F.transform(F.array_sort(F.collect_list(F.when(F.col(c).isNotNull(), F.struct("k", F.col(c).alias("line"))))), lambda x: x["line"])
    pages = rows.groupBy("doc_id", "page").agg(column("a").alias("a"), column("b").alias("b")).select("doc_id", "page", F.array_join(F.concat("a", "b"), "\n").alias("text"))
    df = records.extract_paired(pages)
    return df.select("doc_id", "page", "row_on_page", "warrant_no", F.col("holder_name_raw").alias("name"), "folio_no", F.col("gross_amount").alias("gross"), F.col("tax_amount").alias("tax"), F.col("net_amount").alias("net"))


@query(f"""WITH w AS (SELECT *, {_PAGE} FROM orders)
SELECT doc_id, page, CASE o_orderkey % 3 WHEN 0 THEN '7 2018 ' || (100000 + o_orderkey) || ' HOLDER ALPHA 10 ' || printf('%.2f', o_totalprice) WHEN 1 THEN '7 2018 ' || (100000 + o_orderkey) || ' HOLDER BETA ' || printf('%.2f', o_totalprice) ELSE 'plain words ' || o_orderkey END AS line FROM w""")
def wrapped_lines(spark, d):
    """Orders as records over two lines: a name and amounts in place of an amount, amounts after a name, or plain lines; blank lines between."""
    key, price = F.col("o_orderkey"), F.format_string("%.2f", "o_totalprice")
    begin = F.concat(F.lit("7 2018 "), (key + 100000).cast("string"))
    line = F.when(key % 3 == 0, F.concat(begin, F.lit(" 5.00\n\nHOLDER ALPHA 10 "), price)).when(key % 3 == 1, F.concat(begin, F.lit(" HOLDER BETA\n \n"), price)).otherwise(F.concat(F.lit("plain words "), key.cast("string")))
    lines = L.joined_lines(_as_pages(spark, d, line, ["words enough to make a page of text long"], "x"))
    return lines.filter((F.trim("line") != "") & (F.col("line") != "words enough to make a page of text long")).select("doc_id", "page", "line")


@query("""WITH r AS (SELECT l_orderkey AS doc_id, l_linenumber = 1 AND l_orderkey % 2 = 0 AS total, CASE WHEN l_linenumber = 1 AND l_orderkey % 2 = 0 THEN floor(l_extendedprice / 2) * 2 ELSE round(l_extendedprice, 2) END AS v, year(l_shipdate) AS y FROM lineitem),
b AS (SELECT o_orderkey AS doc_id, o_orderkey % 2 AS unreadable, list_sort(list_distinct(list_filter(list_concat(CASE o_orderkey % 3 WHEN 0 THEN [floor(o_totalprice / 2) * 2] WHEN 1 THEN [7.0::DOUBLE] ELSE [] END,
  coalesce((SELECT list(v) FROM r WHERE total AND r.doc_id = o_orderkey), [])), lambda v: v >= 100))) AS t FROM orders),
c AS (SELECT doc_id, unreadable, CASE WHEN len(t) > 0 THEN list_distinct(list_concat(t, [round(list_sum(t), 2), round(list_sum(t) - list_max(t), 2), round(list_sum(t) / 2, 2)])) ELSE [] END AS c FROM b),
e AS (SELECT doc_id, sum(v) AS ext, count(*) AS n FROM r WHERE NOT total GROUP BY 1),
m AS (SELECT c.*, coalesce(ext, 0) AS ext, coalesce(n, 0) AS n, CASE WHEN len(c) > 0 THEN list_sort(list_transform(c, lambda v: {'d': abs(v - coalesce(ext, 0)), 'v': v}))[1].v END AS stated FROM c LEFT JOIN e ON c.doc_id = e.doc_id),
y AS (SELECT doc_id, count(*) FILTER (hit) AS hits, count(*) FILTER (NOT hit) AS misses FROM (SELECT g.doc_id, len(list_filter(m.c, lambda x: abs(g.v - x) <= 0.005 * x)) > 0 AS hit FROM (SELECT doc_id, y, sum(v) AS v FROM r WHERE NOT total GROUP BY 1, 2) g JOIN m ON g.doc_id = m.doc_id WHERE g.v <> 0) GROUP BY 1),
k AS (SELECT m.*, CASE WHEN stated IS NULL THEN 'no_total_printed' WHEN ext <> 0 AND abs(stated - ext) <= 0.005 * stated THEN 'match' WHEN coalesce(hits, 0) >= 2 AND coalesce(misses, 0) <= unreadable THEN 'match' ELSE 'mismatch' END AS total_check FROM m LEFT JOIN y ON m.doc_id = y.doc_id)
SELECT doc_id, n AS rows_extracted, round(ext, 2) AS extracted_total, stated AS stated_total, total_check, CASE WHEN total_check <> 'mismatch' AND n > 0 THEN 'parsed' ELSE 'partial' END AS status FROM k""")
def document_verdicts(spark, d):
    """Orders as documents that print their total, a small one or none; some of their lines are labelled as totals and count as printed ones."""
    total = (F.col("l_linenumber") == 1) & (F.col("l_orderkey") % 2 == 0)
    price = F.col("l_extendedprice")
    rows = _table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("doc_id"), F.when(total, "Grand Total").otherwise("HOLDER").alias("holder_name_raw"), F.year("l_shipdate").cast("string").alias("dividend_year"), F.lit("cash").alias("dividend_type"),
        F.lit(None).cast("double").alias("shares"), F.when(total, F.floor(price / 2) * 2).otherwise(F.round(price, 2)).cast("double").alias("net_amount"), F.lit("").alias("issues"),
    )
    key, zero = F.col("o_orderkey"), F.lit(0)
    printed = F.when(key % 3 == 0, F.array(_printed())).when(key % 3 == 1, F.array(F.lit(7.0))).otherwise(F.array().cast("array<double>"))
    stats = _table(spark, d, "orders").select(key.alias("doc_id"), printed.alias("totals"), F.lit(None).cast("array<array<double>>").alias("total_lines"), zero.alias("textless_pages"), zero.alias("unparsed_idlike"), (key % 2).cast("int").alias("unreadable_totals"))
    verdict = totals.document_verdict(totals.guard_rows(rows), stats, totals.total_row_values(rows))
    return verdict.select("doc_id", "rows_extracted", "extracted_total", "stated_total", "total_check", "status")


@query(f"""WITH w AS (SELECT *, o_orderkey // 240 AS doc, o_orderkey % 240 // 12 AS page FROM orders), g AS (SELECT doc, page, list(floor(o_totalprice) ORDER BY o_orderkey) AS v, list(o_orderkey % 4 = 0 ORDER BY o_orderkey) AS grand FROM w GROUP BY 1, 2),
a AS (SELECT doc, flatten(list(v ORDER BY page)) AS v, flatten(list(grand ORDER BY page)) AS grand FROM g GROUP BY 1)
SELECT CAST(doc AS VARCHAR) AS doc_id, coalesce(list_filter(v, lambda x, i: grand[i])[-1], list_max(v)) AS stated_total, CAST(len(v) AS INTEGER) AS n, round(list_sum(v), 0) AS total FROM a""")
def stated_totals(spark, d):
    """Orders as lines of totals, several grand ones on a page: the last grand one in place is stated, else the largest."""
    name = F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.lit("Grand total of "), F.reverse(F.col("o_orderkey").cast("string")), F.lit("th "))).otherwise("Total of section ")
    pages = _as_pages(spark, d, F.concat(name, F.format_string("%.2f", F.floor("o_totalprice").cast("double"))), ["Dividend list with words that make it long"], "x")
    stats = records.document_stats(records.extract_records(pages), pages)
    return stats.select("doc_id", "stated_total", F.size("totals").alias("n"), F.round(F.aggregate("totals", F.lit(0.0), lambda a, v: a + v), 0).alias("total"))


@query("""WITH m AS (SELECT doc_id AS id, CASE WHEN doc_id % 11 = 0 THEN 'failed' ELSE 'ok' END AS status, CASE WHEN doc_id % 11 = 0 THEN 'HTTP 404 ' || repeat('x', 300) END AS error, list_extract(['list', 'summary', 'reference_only', 'list', 'list'], CAST(doc_id % 5 + 1 AS BIGINT)) AS role,
  CASE WHEN doc_id % 3 = 0 THEN 'scanned' ELSE 'text' END AS kind, min(CASE WHEN doc_id % 11 <> 0 THEN doc_id END) OVER (PARTITION BY sha256(text)) AS first, EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = documents.doc_id) AS extracted FROM documents)
SELECT id, CASE WHEN status <> 'ok' THEN 'failed' WHEN first <> id THEN 'skipped' WHEN role IN ('reference_only', 'summary') THEN 'skipped' WHEN NOT extracted THEN 'failed' END AS route,
  CASE WHEN status <> 'ok' THEN substr(error, 1, 200) WHEN first <> id THEN 'duplicate of ' || first || ' (same sha256)' WHEN role = 'reference_only' THEN 'reference only' WHEN role = 'summary' THEN 'summary document: totals only, not parsed into dividends'
    WHEN NOT extracted THEN CASE WHEN kind = 'scanned' THEN 'not extracted; scanned, needs OCR' ELSE 'not extracted' END END AS reason FROM m""")
def routed_documents(spark, d):
    """Documents as files of a manifest: failed, of equal content, in several roles; those with labels have been extracted."""
    key = F.col("doc_id")
    failed = key % 11 == 0
    role = F.element_at(F.array(*map(F.lit, ("list", "summary", "reference_only", "list", "list"))), (key % 5 + 1).cast("int"))
    files = _table(spark, d, "documents").select(
        key.alias("id"), key.alias("position"), F.when(failed, "failed").otherwise("ok").alias("status"), F.when(failed, F.concat(F.lit("HTTP 404 "), F.repeat(F.lit("x"), F.lit(300)))).alias("error"), role.alias("role"),
        F.when(key % 3 == 0, "scanned").otherwise("text").alias("pdf_kind"), F.when(~failed, F.sha2("text", 256)).alias("sha256"),
    )
    there = _table(spark, d, "labels").select(key.alias("id")).distinct().withColumn("extracted", F.lit(True))
    return route.route(resolve.mark_duplicate_files(files).join(there, "id", "left")).select("id", "route", "reason")


@query("""WITH l AS (SELECT doc_id, trim(unnest(string_split(text, chr(10))), ' ') AS line FROM documents WHERE length(trim(text, ' ')) >= 40),
r AS (SELECT DISTINCT doc_id, line FROM l WHERE length(line) % 2 = 0) SELECT l.doc_id, line, count(*) AS n FROM l ANTI JOIN r USING (doc_id, line) WHERE regexp_matches(line, '[0-9]') GROUP BY 1, 2""")
def unparsed_lines(spark, d):
    """Lines of documents with a digit that no row was made from; lines of even length stand in for rows."""
    lines = L.explode_lines(_table(spark, d, "documents").select("doc_id", F.lit(1).alias("page"), "text"))
    rows = lines.filter(F.length(F.trim("line")) % 2 == 0).select("doc_id", "line")
    return marts.unparsed_lines(lines, rows).groupBy("doc_id", F.trim("line").alias("line")).agg(F.count("*").alias("n"))


@query("""WITH p AS (SELECT p_partkey AS row_idx, array_to_string(list_sort(string_split(p_name, ' ')), ' ') AS block, CASE WHEN p_size % 2 = 0 THEN p_brand ELSE '' END AS bo_id, 'H' || p_brand || p_type AS holder_id, p_retailprice AS amount, p_type AS company FROM part),
f AS (SELECT block, holder_id, min(row_idx) AS row_idx FROM p GROUP BY 1, 2),
r AS (SELECT f.block, f.holder_id, f.row_idx, p.bo_id, p.amount, p.company, row_number() OVER w AS rk, min(f.row_idx) OVER (PARTITION BY f.block) AS first FROM f JOIN p ON f.row_idx = p.row_idx WINDOW w AS (PARTITION BY f.block ORDER BY f.row_idx)),
q AS (SELECT a.holder_id AS holder_id_a, b.holder_id AS holder_id_b, a.company = b.company AS same, a.amount + b.amount AS weight, row_number() OVER (ORDER BY a.first, a.rk, b.rk) AS n
  FROM r a JOIN r b ON a.block = b.block AND a.rk < b.rk AND a.rk <= 6 AND b.rk <= 6 AND NOT (a.bo_id <> '' AND b.bo_id <> '' AND a.bo_id <> b.bo_id))
SELECT 'R' || lpad(CAST(n AS VARCHAR), 6, '0') AS review_id, holder_id_a, holder_id_b, 'same normalised name; no father/address in list to confirm; ' || CASE WHEN same THEN 'same company' ELSE 'different companies' END AS evidence, weight FROM q ORDER BY weight DESC, n LIMIT 50""")
def review_queue(spark, d):
    """The review queue with a cap that is reached: ids are given to all pairs before it."""
    p = _table(spark, d, "part")
    rows = p.select(F.col("p_partkey").alias("row_idx"), S.sorted_words(F.col("p_name")).alias("block"), F.size(S.tokens(F.col("p_name"))).alias("n_tokens"), F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).otherwise("").alias("bo_id"), F.concat(F.lit("H"), "p_brand", "p_type").alias("holder_id"), F.col("p_retailprice").alias("amount"), F.col("p_type").alias("company"))
    return resolve.review_queue(rows, least_tokens=2, cap=50).select("review_id", "holder_id_a", "holder_id_b", "evidence", "weight")


@query(f"""WITH {_ITEMS}, q AS (SELECT DISTINCT bo_id FROM items WHERE bo_id <> ''), h AS (SELECT q.bo_id, company, name, net, shares, dividend_type FROM q JOIN items i ON q.bo_id = i.bo_id)
SELECT bo_id, min(name) AS name, round(coalesce(sum(net) FILTER (dividend_type <> 'stock'), 0), 2) AS cash, round(sum(shares), 2) AS shares, count(DISTINCT company) AS companies, count(*) AS items FROM h GROUP BY 1""")
def lookup_nested(spark, d):
    own = items(spark, d)
    published = own.select("bo_id", "company", F.col("dividend_type").alias("dtype"), "net", "shares", F.col("year_start").cast("string").alias("year"), F.lit(True).alias("verified"), F.col("row_idx").cast("string").alias("doc_id"), F.lit(1).alias("page"), "name")
    asked = own.filter("bo_id <> ''").select("bo_id").distinct().select(F.col("bo_id").alias("request_id"), F.concat(F.substring("bo_id", 1, 8), F.lit("-"), F.substring("bo_id", 9, 8)).alias("bo"))
    found = lookup.lookup_account(asked, published)
    n = F.aggregate(F.transform("companies", lambda c: F.size(c["items"])), F.lit(0).cast("long"), lambda a, x: a + x)
    return found.select(F.col("request_id").alias("bo_id"), "name", F.round("totals.cash", 2).alias("cash"), F.round("totals.shares", 2).alias("shares"), "totals.companies", n.alias("items"))


@query("""SELECT event_id, CAST(count(*) FILTER (event_type = 'error') OVER w AS BIGINT) AS fails, CAST(count(*) OVER w AS BIGINT) AS calls FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 899999999 MICROSECONDS PRECEDING AND CURRENT ROW)""")
def gate_sliding_counts(spark, d):
    counts = {"fails": (F.col("event_type") == "error", 900), "calls": (F.lit(True), 900)}
    return gate.sliding_counts(_table(spark, d, "events"), "user_id", "ts", counts).select("event_id", F.col("fails").cast("long").alias("fails"), F.col("calls").cast("long").alias("calls"))


#: The gate's rules call by call, for calls c (n from 1 in order of time, id, ip, t in microseconds, ok, missed): accepted calls and marks of a day.
_GATE = """g(n, id, answer, hits, marks) AS (
  SELECT 0::BIGINT, NULL::BIGINT, ''::VARCHAR, []::STRUCT(ip VARCHAR, t BIGINT)[], []::STRUCT(ip VARCHAR, t BIGINT, kind VARCHAR)[]
  UNION ALL
  SELECT n, id, answer, CASE WHEN answer IN ('ok', 'code_required') THEN list_append(h, {'ip': ip, 't': t}) ELSE h END,
    CASE WHEN answer = 'code_required' THEN list_append(m, {'ip': ip, 't': t, 'kind': 'fail'}) WHEN answer = 'ok' AND missed THEN list_append(m, {'ip': ip, 't': t, 'kind': 'miss'}) ELSE m END
  FROM (SELECT *, CASE WHEN len(list_filter(m, lambda x: x.ip = s.ip AND x.kind = 'fail')) >= 3 THEN 'locked' WHEN len(list_filter(m, lambda x: x.ip = s.ip AND x.kind = 'miss')) >= 2 THEN 'locked'
      WHEN len(list_filter(h, lambda x: x.ip = s.ip AND x.t > s.t - 10800000000)) >= 2 THEN 'rate_limited' WHEN len(list_filter(h, lambda x: x.ip = s.ip)) >= 4 THEN 'daily_cap' WHEN len(h) >= 45 THEN 'daily_cap'
      WHEN ok THEN 'ok' ELSE 'code_required' END AS answer
    FROM (SELECT c.*, list_filter(g.hits, lambda x: x.t > c.t - 86400000000) AS h, list_filter(g.marks, lambda x: x.t > c.t - 86400000000) AS m FROM g JOIN c ON c.n = g.n + 1) s) z)"""
#: Lowered so that every answer occurs, the cap over all visitors from sf0.001 on.
_LIMITS = gate.Limits(fail=(3, 86400), miss=(2, 86400), minute=(2, 10800), day=(4, 86400), overall=(45, 86400))


@query(f"""WITH RECURSIVE c AS MATERIALIZED (SELECT row_number() OVER (ORDER BY ts, event_id) AS n, event_id AS id, CAST(user_id AS VARCHAR) AS ip, epoch_us(ts) AS t, event_type <> 'error' AS ok, event_type = 'click' AS missed FROM events),
{_GATE} SELECT id AS request_id, ip, ts, answer FROM g JOIN (SELECT event_id, CAST(user_id AS VARCHAR) AS ip, ts FROM events) e ON id = event_id""")
def gate_answers(spark, d):
    """Events as calls to the gate, errors as wrong codes, clicks as lookups that find nothing."""
    calls = _table(spark, d, "events").select(F.col("event_id").alias("request_id"), F.col("user_id").cast("string").alias("ip"), "ts", (F.col("event_type") != "error").alias("code_ok"), (F.col("event_type") == "click").alias("missed"))
    return gate.gate_all(calls, _LIMITS)


@query(f"""WITH RECURSIVE {_ITEMS},
q AS (SELECT event_id AS id, CAST(user_id AS VARCHAR) AS ip, ts, event_type <> 'error' AS ok, CASE WHEN event_type = 'signup' THEN ['1-URGENT', 'F' || (event_id % 60)] END AS folio,
    CASE event_type WHEN 'signup' THEN NULL WHEN 'purchase' THEN '12' ELSE lpad(CAST(event_id % 150 AS VARCHAR), 16, '0') END AS bo FROM events),
k AS (SELECT bo_id AS key, CAST(NULL AS VARCHAR) AS company, net, dividend_type FROM items WHERE bo_id <> '' UNION ALL SELECT upper(replace(folio_no, ' ', '')), company, net, dividend_type FROM items WHERE folio_no <> ''),
w AS (SELECT key, company, round(coalesce(sum(net) FILTER (dividend_type <> 'stock'), 0), 2) AS cash, count(*) AS items FROM k GROUP BY 1, 2),
f AS (SELECT q.*, cash, w.items, CASE WHEN bo = '12' THEN 'invalid_bo' END AS invalid FROM q LEFT JOIN w ON w.key = coalesce(bo, folio[2]) AND w.company IS NOT DISTINCT FROM folio[1]),
c AS MATERIALIZED (SELECT row_number() OVER (ORDER BY ts, id) AS n, id, ip, epoch_us(ts) AS t, ok, invalid IS NULL AND items IS NULL AS missed FROM f),
{_GATE}, r AS (SELECT f.id, CASE WHEN answer <> 'ok' THEN answer ELSE invalid END AS error, f.cash, f.items FROM f JOIN g ON f.id = g.id)
SELECT id AS request_id, error, CASE WHEN error IS NULL THEN items IS NOT NULL END AS found, CASE WHEN error IS NULL THEN cash END AS cash, CASE WHEN error IS NULL THEN items END AS items FROM r""")
def gated_lookups(spark, d):
    """Events as lookups of accounts or folios of orders, some invalid, some that find nothing; what they find decides what they leave at the gate."""
    event, kind = F.col("event_id"), F.col("event_type")
    account = F.when(kind == "purchase", "12").when(kind != "signup", F.lpad((event % 150).cast("string"), 16, "0"))
    folio = F.when(kind == "signup", F.concat(F.lit("f-"), (event % 60).cast("string")))
    requests = _table(spark, d, "events").select(event.alias("request_id"), F.col("user_id").cast("string").alias("ip"), "ts", F.when(kind != "error", " Open").alias("code"), account.alias("bo"), F.when(kind == "signup", "1-URGENT").alias("company_asked"), folio.alias("folio"))
    own = items(spark, d)
    published = own.select("bo_id", "company", S.folio_key(F.col("folio_no")).alias("folio_key"), F.col("dividend_type").alias("dtype"), "net", "shares", F.col("year_start").cast("string").alias("year"), F.lit(True).alias("verified"), F.col("row_idx").cast("string").alias("doc_id"), F.lit(1).alias("page"), "name")
    found = access.answer_lookups(requests, published, _LIMITS, access.Access(hashlib.sha256(b"open").hexdigest()))
    n = F.aggregate(F.transform("companies", lambda c: F.size(c["items"])), F.lit(0).cast("long"), lambda a, x: a + x)
    return found.select("request_id", "error", "found", F.round("totals.cash", 2).alias("cash"), F.when(F.col("found"), n).alias("items"))


@query("""WITH t AS (SELECT max(ts) AS last FROM events WHERE CAST('0x' || substr(sha256('purge:' || event_id), 1, 8) AS BIGINT) < CAST(floor(0.02 * 4294967296) AS BIGINT))
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, strftime(ts, '%Y-%m-%d') AS day FROM events, t WHERE last IS NULL OR ts >= last - INTERVAL 172800 SECONDS""")
def purged_log(spark, d):
    """What the calls of a log have left of it, with its times as manifests hold them."""
    events = _table(spark, d, "events")
    left = gate.purged(events, events.select(F.col("event_id").alias("request_id"), "ts"))
    return left.select("event_id", S.stamp(F.col("ts")).alias("at"), S.day(F.col("ts")).alias("day"))


@query("""WITH c AS (SELECT DISTINCT l_returnflag AS k, l_extendedprice AS v FROM lineitem WHERE l_returnflag <> 'A'),
x AS (SELECT o_orderkey, list_extract(['A', 'N', 'R', 'R'], CAST(o_orderkey % 4 + 1 AS BIGINT)) AS k, round(o_totalprice / 3, 2) AS x FROM orders),
l AS (SELECT x.*, c.v AS low FROM x ASOF LEFT JOIN c ON x.k = c.k AND x.x >= c.v), h AS (SELECT l.*, c.v AS high FROM l ASOF LEFT JOIN c ON l.k = c.k AND l.x <= c.v)
SELECT o_orderkey, x, CASE WHEN low IS NULL OR high - x < x - low THEN high ELSE low END AS nearest FROM h""")
def nearest_prices(spark, d):
    """Orders' prices and the nearest of all prices of lines with one flag, for few keys of very many candidates."""
    known = _table(spark, d, "lineitem").filter("l_returnflag <> 'A'").select(F.col("l_returnflag").alias("k"), F.col("l_extendedprice").alias("v"))
    key = F.element_at(F.array(*map(F.lit, ("A", "N", "R", "R"))), (F.col("o_orderkey") % 4 + 1).cast("int"))
    values = _table(spark, d, "orders").select("o_orderkey", key.alias("k"), F.round(F.col("o_totalprice") / 3, 2).alias("x"))
    return totals.nearest_rows(values, known, "k").select("o_orderkey", "x", "nearest")


@query("""SELECT time_bucket(INTERVAL 5 MINUTES, ts) - INTERVAL 5 MINUTES * k AS window_start, event_type, count(*) AS n FROM events CROSS JOIN (SELECT unnest([0, 1, 2]) AS k) GROUP BY 1, 2""")
def windowed_counts(spark, d):
    return gate.windowed_counts(_table(spark, d, "events"))


@query("""WITH k AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS up, row_number() OVER (PARTITION BY source ORDER BY doc_id DESC) AS down FROM documents) SELECT doc_id, source FROM k WHERE up <= 8 OR down <= 3""")
def head_and_tail(spark, d):
    return L.ends(_table(spark, d, "documents").select("doc_id", "source"), ["source"], ["doc_id"], 8, 3)


@query("SELECT doc_id, source FROM documents QUALIFY (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) % 7 = 0")
def systematic_sample(spark, d):
    return L.every(_table(spark, d, "documents").select("doc_id", "source"), ["source"], ["doc_id"], 7)


@query("SELECT doc_id FROM documents ORDER BY sha256(doc_id || ':20'), doc_id LIMIT 10")
def seeded_sample(spark, d):
    return L.seeded_sample(_table(spark, d, "documents").select("doc_id"), "doc_id", 10, 20)


@query(r"""WITH t AS (SELECT o_orderkey, printf('%.2f', round(CAST(o_totalprice AS DOUBLE) * 1000, 2)) AS s, lpad(CAST(o_orderkey AS VARCHAR), 16, '0') AS a FROM orders), u AS (SELECT *, split_part(s, '.', 1) AS i FROM t)
SELECT o_orderkey, CASE WHEN length(i) <= 3 THEN s ELSE ltrim(reverse(regexp_replace(reverse(left(i, length(i) - 3)), '(..)', '\1,', 'g')), ',') || ',' || right(i, 3) || '.' || split_part(s, '.', 2) END AS money,
  a[1:4] || ' ' || a[5:8] || ' ' || a[9:12] || ' ' || a[13:16] AS account FROM u""")
def lakh_format(spark, d):
    return _table(spark, d, "orders").select("o_orderkey", S.lakh(F.col("o_totalprice") * 1000).alias("money"), S.grouped_digits(F.lpad(F.col("o_orderkey").cast("string"), 16, "0")).alias("account"))


@query("""SELECT count(*) FILTER (coalesce(lang, '') = '') AS empty_lang, count(*) FILTER (coalesce(source, '') = '') AS empty_source, count(*) FILTER (coalesce(lang, '') = '' OR coalesce(source, '') = '') AS rows_with_any, count(*) AS rows FROM documents""")
def missing_keys(spark, d):
    return marts.missing_keys(_table(spark, d, "documents"), ["lang", "source"])


@query("SELECT lang, source, count(*) AS n FROM documents GROUP BY 1, 2")
def value_counts(spark, d):
    return marts.value_counts(_table(spark, d, "documents"), "lang", "source")


@query("""WITH a AS (SELECT l_orderkey AS k, sum(l_quantity) AS q FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1), b AS (SELECT l_orderkey AS k, sum(l_quantity) AS q FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
SELECT coalesce(a.k, b.k) AS doc_id, a.q AS rows_a, b.q AS rows_b, coalesce(a.q, 0) - coalesce(b.q, 0) AS rows_diff FROM a FULL JOIN b ON a.k = b.k""")
def compare_extractors(spark, d):
    side = lambda flag: _table(spark, d, "lineitem").filter(F.col("l_returnflag") == flag).groupBy(F.col("l_orderkey").alias("doc_id")).agg(F.sum("l_quantity").alias("rows"))
    return marts.side_by_side(side("A"), side("R"), "doc_id", ["rows"])


@query(f"""WITH {_ITEMS} SELECT row_idx, NOT doubtful AS verified, CASE WHEN inst THEN 'institution' ELSE '' END AS flags FROM items WHERE bo_id <> '' OR folio_no <> ''""")
def published_items(spark, d):
    return marts.publishable(items(spark, d)).select("row_idx", "verified", "flags")


@query("SELECT o_orderkey, round(l / o_totalprice * 100, 1) AS coverage_pct FROM orders JOIN (SELECT l_orderkey, sum(l_extendedprice) AS l FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey WHERE o_totalprice > 0")
def coverage_report(spark, d):
    sums = _table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sum("l_extendedprice").alias("l"))
    df = _table(spark, d, "orders").join(sums, F.col("o_orderkey") == F.col("l_orderkey"))
    return df.select("o_orderkey", totals.coverage(F.col("l"), F.col("o_totalprice")).alias("coverage_pct"))


@query("SELECT count(DISTINCT c_nationkey) AS nations, max(c_acctbal) AS most FROM customer")
def service_info(spark, d):
    return marts.service_info(_table(spark, d, "customer"), "c_nationkey", "c_acctbal").toDF("nations", "most")


@query("SELECT l_suppkey AS doc_id, count(*) AS n, round(sum(l_quantity), 2) AS total FROM lineitem GROUP BY 1")
def group_sum_count(spark, d):
    return marts.sums_by(_table(spark, d, "lineitem").withColumnRenamed("l_suppkey", "doc_id"), ["doc_id"], "l_quantity")


@query(f"""WITH {_ITEMS} SELECT bo_id, company, CASE WHEN bo_id = '' THEN upper(replace(folio_no, ' ', '')) ELSE '' END AS folio_key, CASE WHEN bo_id = '' THEN folio_no ELSE '' END AS folio_no,
  CAST(year_start AS VARCHAR) AS year, CAST(year_start AS INTEGER) AS year_start, dividend_type AS dtype, net, shares, name, CAST(row_idx AS VARCHAR) AS doc_id, CAST(1 AS INTEGER) AS page, NOT doubtful AS verified,
  array_to_string(list_concat(CASE WHEN doubtful THEN ['implausible_amount'] ELSE [] END, CASE WHEN inst THEN ['institution'] ELSE [] END), ';') AS flags FROM items WHERE bo_id <> '' OR folio_no <> ''""")
def lookup_items(spark, d):
    return marts.lookup_items(items(spark, d).withColumns({"doc_id": F.col("row_idx").cast("string"), "page": F.lit(1), "dividend_year": F.col("year_start").cast("string")}))


@query(f"""WITH {_ITEMS}, f AS (SELECT company, upper(replace(folio_no, ' ', '')) AS k, * FROM items WHERE folio_no <> ''), q AS (SELECT DISTINCT company AS c, k AS fk FROM f)
SELECT c || '/' || fk AS request_id, min(name) AS name, round(coalesce(sum(net) FILTER (dividend_type <> 'stock'), 0), 2) AS cash, count(*) AS items FROM q JOIN f ON c = company AND fk = k GROUP BY 1""")
def lookup_folios(spark, d):
    """Folios asked for in lower case and with hyphens."""
    published = lookup_items(spark, d)
    asked = published.filter("folio_key <> ''").select("company", "folio_key").distinct()
    asked = asked.select(F.concat_ws("/", "company", "folio_key").alias("request_id"), F.col("company").alias("company_asked"), F.lower(F.regexp_replace("folio_key", "^(.)", "$1-")).alias("folio"))
    n = F.aggregate(F.transform("companies", lambda c: F.size(c["items"])), F.lit(0).cast("long"), lambda a, x: a + x)
    return lookup.lookup_folio(asked, published).select("request_id", "name", F.col("totals.cash").alias("cash"), n.alias("items"))


@query("SELECT l_orderkey AS doc_id, l_linenumber, 'Clerk#' || o_custkey AS url FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderkey % 2 = 0) ON l_orderkey = o_orderkey")
def document_urls(spark, d):
    documents = _table(spark, d, "orders").filter("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("id"), _clerk().alias("url"))
    return marts.with_document_url(_table(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc_id"), "l_linenumber"), documents)


_FETCH = "w AS (SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN doc_id % 5 = 0 THEN 'reference_only' ELSE 'list' END AS role FROM documents), m AS (SELECT CAST(doc_id AS VARCHAR) AS id, quality = 0 AS bad FROM labels)"


def _work(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    key = F.col("doc_id").cast("string")
    work = _table(spark, d, "documents").select(key.alias("id"), F.when(F.col("doc_id") % 5 == 0, "reference_only").otherwise("list").alias("role"))
    return work, _table(spark, d, "labels").select(F.concat(key, F.lit("-01")).alias("id"), F.when(F.col("quality") == 0, "failed").otherwise("ok").alias("status"))


@query(f"WITH {_FETCH} SELECT id, role FROM w WHERE role <> 'reference_only' AND id NOT IN (SELECT id FROM m WHERE NOT bad)")
def to_fetch(spark, d):
    return ingest.to_fetch(*_work(spark, d))


@query(f"WITH {_FETCH} SELECT id, role FROM w WHERE id NOT IN (SELECT id FROM m WHERE NOT bad) AND id IN (SELECT id FROM m WHERE bad)")
def to_fetch_again(spark, d):
    return ingest.to_fetch(*_work(spark, d), reference=True, retry_failed=True)


@query("""WITH s AS (SELECT l_suppkey AS doc_id, year(l_shipdate) AS yr, count(*) AS n, sum(l_quantity) AS v FROM lineitem GROUP BY ALL),
c AS (SELECT DISTINCT l_suppkey AS doc_id, c FROM (SELECT doc_id AS l_suppkey, v - CASE WHEN yr % 2 = 0 THEN 0 ELSE 3 END AS c FROM s WHERE doc_id % 7 <> 0)),
b AS (SELECT s.*, c.c, row_number() OVER (PARTITION BY s.doc_id, yr ORDER BY abs(c.c - v), c.c) AS r FROM s LEFT JOIN c ON s.doc_id = c.doc_id)
SELECT doc_id, yr AS year, n, v, c AS nearest, CASE WHEN c <> 0 AND abs(c - v) <= 0.005 * c THEN 'OK' ELSE 'BAD' END AS verdict FROM b WHERE r = 1""")
def year_report(spark, d):
    df = _table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("doc_id"), F.year("l_shipdate").alias("year")).agg(F.count("*").alias("n"), F.sum("l_quantity").alias("v"))
    printed = df.filter("doc_id % 7 <> 0").groupBy("doc_id").agg(F.collect_set(F.when(F.col("year") % 2 == 0, F.col("v")).otherwise(F.col("v") - 3)).alias("candidates"))
    return totals.year_report(df, printed)


@query(r"""WITH r AS (SELECT doc_id, regexp_extract(text, '^\s*(\S+)', 1) AS a, regexp_extract(text, '^\s*\S+\s+(\S+)', 1) AS b, length(text) AS n, text FROM documents),
p AS (SELECT *, regexp_replace(CASE WHEN doc_id % 3 = 0 THEN '' ELSE text || ' ' || CASE WHEN doc_id % 3 = 1 THEN printf('%.2f', CAST(n AS DOUBLE)) ELSE '' END END, '\s+', ' ', 'g') AS page FROM r)
SELECT doc_id, contains(lower(page), trim(lower(a) || ' ' || lower(b))) AS name_ok, contains(page, CAST(n AS VARCHAR)) AS amount_ok, contains(replace(page, ' ', ''), CAST(doc_id AS VARCHAR)) AS id_ok FROM p WHERE doc_id % 3 <> 0 AND a <> ''""")
def spot_check(spark, d):
    """Names are the first words of texts, amounts their lengths, which half of the pages print. Pages are in upper case from a to z alone: other letters
    may become more than one, as a sharp s does, and not come back."""
    docs = _table(spark, d, "documents").filter("doc_id % 3 <> 0").withColumn("n", F.length("text").cast("double"))
    pages = docs.select("doc_id", F.lit(1).alias("page"), F.concat(F.translate("text", ascii_lowercase, ascii_uppercase), F.lit(" "), F.when(F.col("doc_id") % 3 == 1, F.format_string("%.2f", "n")).otherwise("")).alias("text"))
    rows = docs.select("doc_id", F.lit(1).alias("page"), F.col("text").alias("holder_name_raw"), F.col("n").alias("net_amount"), F.col("doc_id").cast("string").alias("bo_id"), F.lit("").alias("folio_no"))
    return marts.spot_check(rows.filter(F.col("holder_name_raw").rlike(r"[^ \t\n\f\r]")), pages).select("doc_id", "name_ok", "amount_ok", "id_ok")


@query("""WITH r AS (SELECT o_orderkey, o_custkey % 50 AS doc, CASE WHEN o_orderkey % 17 = 0 THEN ' Grand  Total' WHEN o_orderkey % 13 = 0 THEN '12 Lake Road' ELSE 'Clerk#' || o_custkey END AS name,
  o_totalprice * CASE WHEN o_orderkey % 19 = 0 THEN 1e6 ELSE 10 END AS net, CAST(o_orderkey AS DOUBLE) AS shares, o_custkey % 50 < 3 OR o_orderkey % 5 = 0 AS stray FROM orders),
t AS (SELECT *, net >= 1e9 AS big FROM r WHERE o_orderkey % 17 <> 0), s AS (SELECT *, avg(CAST(stray AS INTEGER)) OVER (PARTITION BY doc) AS share FROM t)
SELECT o_orderkey, CASE WHEN NOT big THEN net END AS net, CASE WHEN NOT big THEN shares END AS shares,
  array_to_string(list_concat(list_concat(list_concat(CASE WHEN stray THEN ['int_amount'] ELSE [] END, CASE WHEN big THEN ['unreadable_amount'] ELSE [] END), CASE WHEN NOT big AND net > 1000000 THEN ['implausible_amount'] ELSE [] END),
    CASE WHEN name = '12 Lake Road' THEN ['name_looks_like_address'] ELSE [] END), ';') AS tags FROM s WHERE NOT (stray AND share < 0.5)""")
def guarded_rows(spark, d):
    key = F.col("o_orderkey")
    name = F.when(key % 17 == 0, " Grand  Total").when(key % 13 == 0, "12 Lake Road").otherwise(_clerk())
    stray = (F.col("o_custkey") % 50 < 3) | (key % 5 == 0)
    rows = _table(spark, d, "orders").select("o_orderkey", (F.col("o_custkey") % 50).alias("doc_id"), name.alias("holder_name_raw"), (F.col("o_totalprice") * F.when(key % 19 == 0, 1e6).otherwise(10.0)).alias("net_amount"), key.cast("double").alias("shares"), F.when(stray, "int_amount").otherwise("").alias("issues"))
    return totals.guard_rows(rows).select("o_orderkey", F.col("net_amount").alias("net"), "shares", F.array_join("tags", ";").alias("tags"))


@query("""SELECT l_orderkey AS doc_id, l_linenumber AS page, l_partkey AS row_on_page, l_returnflag AS issues FROM lineitem WHERE l_linenumber % 2 = 0 UNION ALL
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = 'N' THEN 'ocr' ELSE l_returnflag || ';ocr' END FROM lineitem WHERE l_linenumber % 2 = 1""")
def back_filled(spark, d):
    rows = _table(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("page"), F.col("l_partkey").alias("row_on_page"), F.col("l_returnflag").alias("issues"))
    return route.back_fill(rows.filter("page % 2 = 0"), rows.withColumn("issues", F.when(F.col("issues") != "N", F.col("issues")).otherwise("")))


@query("""SELECT doc_id FROM documents WHERE doc_id % 4 = 0 AND doc_id % 3 <> 0 UNION SELECT doc_id FROM labels WHERE doc_id % 2 = 0 AND doc_id % 5 <> 0""")
def recognition_jobs(spark, d):
    role = lambda k, name: F.when(F.col("doc_id") % k == 0, name).otherwise("list").alias("role")
    stats = _table(spark, d, "documents").select("doc_id", F.when(F.col("doc_id") % 4 == 0, 2).otherwise(0).alias("textless_pages"), role(3, "summary"))
    triage = _table(spark, d, "labels").select(F.col("doc_id").alias("id"), F.when(F.col("doc_id") % 2 == 0, "scanned").otherwise("text").alias("pdf_kind"), role(5, "summary"))
    return route.recognition_jobs(stats, triage)


@query("SELECT doc_id FROM labels WHERE doc_id % 3 <> 0 AND doc_id % 5 <> 0")
def text_jobs(spark, d):
    kind = F.when(F.col("doc_id") % 3 == 0, "scanned").when(F.col("doc_id") % 3 == 1, "text").otherwise("mixed")
    triage = _table(spark, d, "labels").select(F.col("doc_id").alias("id"), kind.alias("pdf_kind"), F.when(F.col("doc_id") % 5 == 0, "summary").otherwise("list").alias("role"))
    return route.text_jobs(triage).select(F.col("id").alias("doc_id"))


@query("""SELECT o_orderkey, 'C_' || replace(o_orderpriority, ' ', '') || '/' || o_orderkey || '__' || CASE WHEN o_orderkey % 2 = 0 THEN 'list_of_' || o_custkey ELSE 'Clerk_' || o_custkey END || '.pdf' AS path FROM orders""")
def file_paths(spark, d):
    url = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("https://a.example/x/list%20of%20"), F.col("o_custkey").cast("string"), F.lit(".old?p=1"))).otherwise("https://a.example/")
    company = F.concat(F.lit("C "), F.replace("o_orderpriority", F.lit(" "), F.lit("")))
    return _table(spark, d, "orders").select("o_orderkey", sinks.file_path(company, F.col("o_orderkey").cast("string"), url, _clerk(), F.lit(".pdf")).alias("path"))


@query("""SELECT o_orderkey, '{"line":"' || 'Clerk#' || o_custkey || '","note":null}' AS raw_row_json, 'BDT' AS currency FROM orders WHERE o_orderstatus <> 'O' AND o_totalprice IS NOT NULL""")
def row_json(spark, d):
    rows = _table(spark, d, "orders").select("o_orderkey", _clerk().alias("line"), F.lit(None).cast("string").alias("note"), F.when(F.col("o_orderstatus") == "O", "ocr").otherwise("").alias("issues"), F.col("o_totalprice").alias("net_amount"), _clerk().alias("holder_name_raw"))
    return marts.with_constants(marts.with_row_json(marts.clean_rows(rows), ("line", "note")), "BDT").select("o_orderkey", "raw_row_json", "currency")


@query("""SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'h' || page_id ELSE 'unknown' END AS ip, 'total' AS word, CASE WHEN page_id % 2 = 0 THEN '2019-20' END AS span,
  CASE page_id % 3 WHEN 0 THEN 'zero' WHEN 1 THEN 'one' ELSE '2' END AS name, 'https://a.example/b/' || page_id || '.pdf?x=../y' AS link FROM pages""")
def header_and_link_scalars(spark, d):
    key = F.col("page_id").cast("string")
    ip = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit('{"x-forwarded-for":"h'), key, F.lit(',proxy"}'))).when(F.col("page_id") % 3 == 1, "{}")
    link = S.joined_url(F.lit("https://a.example/a/c/page.html"), F.concat(F.lit("../../b/./"), key, F.lit(".pdf?x=../y")))
    names = S.label((F.col("page_id") % 3).cast("string"), {"0": "zero", "1": "one"})
    span = S.year_span(F.when(F.col("page_id") % 2 == 0, "Dividend for 2019-20, paid"))
    return _table(spark, d, "pages").select("page_id", S.client_ip(ip).alias("ip"), S.keyword(F.lit("(Total):")).alias("word"), span.alias("span"), names.alias("name"), link.alias("link"))


def holder_report(spark: SparkSession, d: str) -> DataFrame:
    """The flagship: holders with number, cash and rank within their largest company."""
    own = items(spark, d)
    mart = marts.holder_mart(own)
    w = Window.partitionBy("companies_count").orderBy(F.desc("total_cash"), "holder_id")
    return mart.withColumn("rank", F.row_number().over(w))
