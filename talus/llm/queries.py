"""The queries of this subpackage, over whole tables with production parameters, and their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bpe, fim, knn, langid, media, merkle, neardup, packing, pieces, pii, repeats, simhash, urls


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeated(_table(spark, sf_dir, "documents"), digest=True)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"))


def op4_telephony_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.telephony(_table(spark, sf_dir, "documents"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(_table(spark, sf_dir, "pages")).drop("score")


def op6_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_pieces(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), with_ids=False)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(_table(spark, sf_dir, "documents"))


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.top_k(_table(spark, sf_dir, "embeddings"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")).drop("source")


def op11_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(_table(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digest(_table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tampered(_table(spark, sf_dir, "documents"))


OP1_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 12, 0) + 1)) AS i FROM d)),
f AS (SELECT g, min(doc_id) AS f FROM g GROUP BY g),
x AS (SELECT DISTINCT g.doc_id, g.i + j AS i FROM g JOIN f ON g.g = f.g AND f.f < g.doc_id, (SELECT unnest(range(0, 13)) AS j)),
w AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
k AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS kept FROM w ANTI JOIN x USING (doc_id, i) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k ON k.doc_id = d.doc_id
"""

OP3_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS MATERIALIZED (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)),
e AS MATERIALIZED (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
m AS (SELECT a, min(b) AS least FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(least, d.doc_id)) AS component_id, d.doc_id <= coalesce(least, d.doc_id) AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN m ON m.a = d.doc_id
"""

OP9_SQL = """
WITH ok AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[]) AS BIGINT) AS score
  FROM ok q JOIN ok c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

OP12_SQL = r"""
WITH u AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
    sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
r AS (SELECT *, CAST(len(u) AS BIGINT) AS n, list_transform([1, 9, 17, 25], lambda k: CAST('0x' || substr(h, k, 8) AS BIGINT)) AS r FROM u),
c AS (SELECT *, least(r[1] % (n + 1), r[2] % (n + 1)) AS a, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r[3] % 100 >= 100 THEN 'plain'
      WHEN r[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM r),
p AS (SELECT *, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid, array_to_string(u[b + 1:n], '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid ELSE t END) AS output_sha256,
  sha256(CASE WHEN form = 'plain' THEN t ELSE pre || mid || suf END) AS restored_sha256
FROM p
"""

_LEAF_SQL = " || ".join(f"coalesce(CAST(octet_length(encode(CAST({c} AS VARCHAR))) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')" for c in ("doc_id", "source", "lang", "n_chars", "{text}"))
#: Nodes of a level by group, from the leaves (g, i, d) of {0}: while a group has several, every 16 become one.
_TREE_SQL = """
  SELECT 0 AS level, g, i, d, count(*) OVER (PARTITION BY g) AS n FROM {0}
  UNION ALL
  SELECT level + 1, g, i // 16, sha256(string_agg(d, '' ORDER BY i)), (n + 15) // 16 FROM {1} WHERE n > 1 GROUP BY level, g, i // 16, n
"""
#: What each leaf of {0} meets on its way up through {1}: the siblings before and behind it on each level.
_WAY_SQL = """
  SELECT l.g, l.i, t.level, coalesce(string_agg(t.d, '' ORDER BY t.i) FILTER (t.i < l.i // CAST(pow(16, t.level) AS BIGINT)), '') AS before,
    coalesce(string_agg(t.d, '' ORDER BY t.i) FILTER (t.i > l.i // CAST(pow(16, t.level) AS BIGINT)), '') AS behind
  FROM {0} l JOIN {1} t ON t.g = l.g AND t.n > 1 AND t.i // 16 = l.i // CAST(pow(16, t.level + 1) AS BIGINT) GROUP BY l.g, l.i, t.level
"""
OP13_SQL = f"""
WITH RECURSIVE h AS (
  SELECT doc_id, coalesce('=' || source, '') AS g, sha256({_LEAF_SQL.format(text="text")}) AS d,
    sha256({_LEAF_SQL.format(text="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}) AS other,
    list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
      lambda c, x: list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))) AS crc FROM documents),
a AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, d) - 1 AS i FROM h),
t(level, g, i, d, n) AS ({_TREE_SQL.format("a", "t")}),
b AS (SELECT g AS of, '' AS g, row_number() OVER (ORDER BY g) - 1 AS i, d FROM t WHERE n = 1),
v(level, g, i, d, n) AS ({_TREE_SQL.format("b", "v")}),
way AS (SELECT a.g, a.i, w.level, w.before, w.behind FROM a JOIN ({_WAY_SQL.format("a", "t")}) w ON w.g = a.g AND w.i = a.i
  UNION ALL SELECT a.g, a.i, 100 + w.level, w.before, w.behind FROM a JOIN b ON b.of = a.g JOIN ({_WAY_SQL.format("b", "v")}) w ON w.i = b.i),
p AS (SELECT g, i, list({{'before': before, 'behind': behind}} ORDER BY level) AS steps, string_agg(before || behind, '' ORDER BY level) AS others FROM way GROUP BY g, i),
f AS (SELECT a.doc_id, a.d AS leaf, b.d AS subroot, (SELECT d FROM v WHERE n = 1) AS root, sha256(coalesce(p.others, '')) AS proof_sha256,
  list_reduce(list_prepend(CASE WHEN xor(a.crc, 4294967295) % 5 = 0 THEN a.other ELSE a.d END, coalesce(list_transform(p.steps, lambda s: s.before || '|' || s.behind), [])),
    lambda x, s: sha256(split_part(s, '|', 1) || x || split_part(s, '|', 2))) AS folded_root
  FROM a JOIN b ON b.of = a.g LEFT JOIN p ON p.g = a.g AND p.i = a.i)
SELECT *, folded_root = root AS verified FROM f
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [op1_substring_dedup, op2_token_counts, op3_near_dedup, op4_telephony_audio, op5_url_filter, op6_merge_dropout, op7_language_id, op8_personal_data, op9_exact_top_k, op10_packing, op11_simhash_groups, op12_fill_in_middle, op13_merkle_manifest]
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {"op1_substring_dedup": OP1_SQL, "op3_near_dedup": OP3_SQL, "op9_exact_top_k": OP9_SQL, "op12_fill_in_middle": OP12_SQL, "op13_merkle_manifest": OP13_SQL}
