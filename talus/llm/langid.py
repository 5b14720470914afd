"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .words import U, mix, slices

#: Buckets of the hashed n-grams.
BUCKETS = 1 << 16
#: n-gram lengths in characters.
ORDERS = (1, 2, 3)
#: Documents of one language that the fit takes at most, chosen by the hash of their ids.
TRAIN_DOCS = 4000
#: Labels at most: the counts that reach the driver and the matrix that is broadcast are labels * BUCKETS numbers, so 134 MB and 67 MB.
MOST_LABELS = 256
#: Characters in one numpy pass; a longer text takes several.
PASS_CHARS = 1 << 19
UNKNOWN = "und"


def held_out(doc_id) -> F.Column:
    """Whether crc32 of the id's text has remainder 1 by 3; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def gram_buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of the lower-cased texts, order by order, and for each the place of its text.
    Digits count as one character, and every text is set between spaces, so that no n-gram spans two texts."""
    codes = np.frombuffer(" ".join(["", *texts, ""]).encode("utf-32-le"), np.uint32).astype(U)
    codes[(codes >= 48) & (codes <= 57)] = 48
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    owner = np.repeat(np.arange(len(texts)), lengths)
    buckets, owners = [], []
    h = np.zeros(len(codes), U)
    for n in range(1, max(ORDERS) + 1):
        h = h[: len(codes) - n + 1] * U(0x100000001B3) + (codes[n - 1 :] + U(1))
        if n in ORDERS:
            # an n-gram belongs to the text of its second character; the space before a text belongs to it
            here = h[: len(owner) - n + 1]
            inside = owner[: len(here)] == owner[n - 1 : n - 1 + len(here)]
            buckets.append((mix(here[inside] + U(n)) >> U(64 - 16)).astype(np.int64))
            owners.append(owner[: len(here)][inside])
    return np.concatenate(buckets), np.concatenate(owners)


def _passes(texts: list[str]):
    """(first, end, buckets, owner) of runs of texts of about PASS_CHARS; owner counts from the first. A longer text comes alone and in
    several passes, which share a few characters so that every n-gram is in one."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        if len(t) >= PASS_CHARS:
            if at < i:
                yield at, i, *gram_buckets(texts[at:i])
            for buckets in _long(t):
                yield i, i + 1, buckets, np.zeros(len(buckets), np.int64)
            at, size = i + 1, 0
            continue
        size += len(t)
        if size >= PASS_CHARS:
            yield at, i + 1, *gram_buckets(texts[at : i + 1])
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts), *gram_buckets(texts[at:])


def _long(text: str):
    """Buckets of a long text's n-grams, pass by pass: those that begin in each stretch of the text and the space before it."""
    whole, more = len(text) + 1, max(ORDERS) - 1
    for lo in range(0, whole, PASS_CHARS):
        # Place k of the text with its space is character k - 1.
        part = text[max(lo - 1, 0) : lo + PASS_CHARS + more - 1]
        codes = np.frombuffer(("" if lo else " ").encode("utf-32-le") + part.encode("utf-32-le"), np.uint32).astype(U)
        codes[(codes >= 48) & (codes <= 57)] = 48
        out, h = [], np.zeros(len(codes), U)
        for n in range(1, max(ORDERS) + 1):
            h = h[: max(len(codes) - n + 1, 0)] * U(0x100000001B3) + (codes[n - 1 :] + U(1))
            if n in ORDERS:
                out.append((mix(h[:PASS_CHARS] + U(n)) >> U(64 - 16)).astype(np.int64))
        yield np.concatenate(out)


def fit(docs: DataFrame, bound: int = TRAIN_DOCS) -> tuple[list[str], np.ndarray]:
    """Labels in order and log probabilities (label, bucket), the prior in a last column.

    Learns from rows with text and lang that are not held out; of each language at most about `bound`, chosen by the hash of doc_id.
    What reaches the driver is a count for each of 16 tasks, language and bucket: bounded by the number of languages, of which there
    may be MOST_LABELS; more are an error.
    """
    known = docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).limit(MOST_LABELS + 1).collect()}
    if len(sizes) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} labels")
    if not sizes:
        return [], np.zeros((0, BUCKETS + 1))
    rate = F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(int(min(1.0, bound / n) * (1 << 30))))])
    sample = known.filter((F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("langid")) % (1 << 30) + (1 << 30)) % (1 << 30) < rate[F.col("lang")])

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for b in slices(batches):
            texts, langs = [t.lower() for t in b.column(0).to_pylist()], b.column(1).to_pylist()
            for lo, hi, buckets, owner in _passes(texts):
                for lang in set(langs[lo:hi]):
                    mine = np.array([x == lang for x in langs[lo:hi]])[owner]
                    c = np.bincount(buckets[mine], minlength=BUCKETS)
                    total[lang] = total.get(lang, 0) + c
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array([c.astype("<i8").tobytes() for c in total.values()], pa.binary())], ["lang", "counts"])

    counts = {k: np.ones(BUCKETS) * 0.1 for k in sorted(sizes)}
    for r in sample.select("text", "lang").repartition(16).mapInArrow(count, "lang string, counts binary").toLocalIterator():
        counts[r["lang"]] += np.frombuffer(r["counts"], "<i8")
    labels = sorted(counts)
    table = np.stack([np.log(counts[k] / counts[k].sum()) for k in labels])
    prior = np.log(np.array([sizes[k] for k in labels]) / sum(sizes.values()))
    return labels, np.hstack([table, prior[:, None]])


def label(docs: DataFrame, model: tuple[list[str], np.ndarray]) -> DataFrame:
    """docs with lang_pred and score, for every row; columns of these names that docs had are replaced.

    lang_pred is the label with the highest posterior (the smaller name among equals), `und` with score 0 if the
    text is null or has no letter, or nothing was learnt; score is the posterior. Only the text is an input. Whole
    texts are scored, in sparse batches: log probabilities are gathered by bucket and summed by text. No shuffle.
    """
    labels, table = model
    docs = docs.drop("lang_pred", "score")
    shared = docs.sparkSession.sparkContext.broadcast(np.ascontiguousarray(table[:, :-1], np.float32))
    prior, at = table[:, -1], docs.columns.index("text")

    def run(batches):
        weights = shared.value
        for b in slices(batches):
            texts = [(t or "").lower() for t in b.column(at).to_pylist()]
            lang, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
            sums = np.zeros((len(texts), len(labels)))
            for lo, hi, buckets, owner in _passes(texts) if labels else ():
                for k in range(len(labels)):
                    sums[lo:hi, k] += np.bincount(owner, weights[k][buckets], hi - lo)
            if labels:
                sums += prior
                p = np.exp(sums - sums.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                for i, k in enumerate(p.argmax(1)):
                    if any(map(str.isalpha, texts[i])):
                        lang[i], score[i] = labels[k], float(p[i, k])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())], [*b.schema.names, "lang_pred", "score"])

    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.mapInArrow(run, schema)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray]) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of docs."""
    return label(docs.select("doc_id", "text"), model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
