"""URL filter: rules by host and path prefix, and a classifier over segmented words for the rest."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .scratch import materialize


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


RULES = (Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"), Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"))
#: Pages that the classifier is fitted on at most, chosen by the hash of their ids.
TRAIN_PAGES = 50_000
#: Keys of pieces of names that a task gathers before it sends them.
MOST_KEYS = 1 << 20
#: Pages of a block at most: each block is sent the costs and counts of its own words and tokens.
BLOCK = 8192


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case (A-Z only) and path; both empty for a null url or one without `://`."""
    rest = F.when(F.locate("://", url) > 0, F.regexp_replace(url, r"(?s)^.*?://", "")).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def matched(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null where none fits."""
    ordered = sorted(rules, key=lambda r: -len(r.host + r.path))
    fits = lambda r: ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
    rule = verdict = F.lit(None).cast("string")
    for r in reversed(ordered):
        rule, verdict = F.when(fits(r), F.lit(r.host + r.path)).otherwise(rule), F.when(fits(r), F.lit(r.verdict)).otherwise(verdict)
    return rule, verdict


def word_counts(pages: DataFrame) -> DataFrame:
    """word, n: all words of two letters or more of all pages' visible text."""
    plain = F.lower(F.regexp_replace("html", r"(?s)<(script|style)\b.*?</\1>|<[^>]*>|&\w+;", " "))
    words = F.regexp_extract_all(plain, F.lit(r"(?<![\p{L}\p{N}])(\p{L}{2,})(?![\p{L}\p{N}])"), 1)
    return pages.filter(F.col("html").isNotNull()).select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def segment(name: str, costs: dict[str, float], lengths: Sequence[int]) -> list[str]:
    """The cheapest split of a name into words: Viterbi over unigram costs. lengths: those that words have, in order. A piece that is no
    known word may have any length and costs 12 and 3 a character; among equal costs a known word wins, then the longer one."""
    n = len(name)
    best, end = [0.0] * (n + 1), [n] * (n + 1)
    inside = [math.inf] * (n + 1)  # the least cost from here on, within an unknown piece
    stop = [n] * (n + 1)
    for i in range(n - 1, -1, -1):
        inside[i], stop[i] = (3.0 + best[i + 1], i + 1) if best[i + 1] <= inside[i + 1] else (3.0 + inside[i + 1], stop[i + 1])
        cost, to = 12.0 + inside[i], stop[i]
        for k in lengths:
            if i + k > n:
                break
            known = costs.get(name[i : i + k])
            if known is not None and known + best[i + k] <= cost:
                cost, to = known + best[i + k], i + k
        best[i], end[i] = cost, to
    words, i = [], 0
    while i < n:
        words.append(name[i : end[i]])
        i = end[i]
    return words


_PART = re.compile(r"[0-9]+|[^\W\d_]+")


def names(host: str, path: str) -> Iterator[tuple[str, str]]:
    """(kind, name or digits) of the host's labels but the last (h:) and of the path (p:), whole however long they are."""
    for kind, text in (("h:", ".".join(host.split(".")[:-1]).lower()), ("p:", path.lower())):
        for part in _PART.findall(text):
            yield kind, part


_STEP = np.uint64(0x9E3779B97F4A7C15)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)


def word_key(word: str) -> int:
    """A word's key: its characters as digits of a number to an odd base, modulo 2^64."""
    key = 0
    for c in word:
        key = (key * int(_STEP) + ord(c) + 1) & (1 << 64) - 1
    return key - (key >> 63 << 64)


def candidates(name: str, lengths: Sequence[int]) -> np.ndarray:
    """Keys of all that may be a word of the unigram model within a name, 8 bytes each whatever their lengths. Another word may have one of these
    keys by chance: it is then sent too, and found nowhere in the name."""
    codes = _codes(name)
    n, out = len(codes), [np.zeros(0, np.uint64)]
    key, k = np.zeros(n + 1, np.uint64), 0
    wanted = set(lengths)
    for k in range(1, min(n, max(wanted, default=0)) + 1):
        # The key of each piece of k characters from that of the piece one shorter.
        key = key[: n - k + 1] * _STEP + codes[k - 1 :]
        if k in wanted:
            out.append(key)
    return np.unique(np.concatenate(out))


class Segmenter:
    def __init__(self, costs: dict[str, float]):
        self.costs, self.seen, self.lengths = costs, {}, sorted({len(w) for w in costs})

    def tokens(self, host: str, path: str) -> list[str]:
        """h:word for the words of the host's labels but the last (t:label), p:word for the path's; digits are one token by their number."""
        label = host.split(".")[-1]
        out = ["t:" + label] if label else []
        for kind, name in names(host, path):
            if name[0].isdigit():
                out.append(f"{kind}#{len(name)}")
                continue
            if name not in self.seen:
                if len(self.seen) > 200_000:
                    self.seen.clear()
                self.seen[name] = segment(name, self.costs, self.lengths)
            out += [kind + w for w in self.seen[name]]
        return out


def tokenized(parsed: DataFrame, counts: DataFrame) -> DataFrame:
    """parsed (host, path, block and others) with tokens. The words that occur anywhere in a block's names are joined with the counts, so every
    word has its cost and no task holds the model."""
    total, lengths = counts.agg(F.sum("n"), F.array_sort(F.collect_set(F.length("word")))).first()
    total = total or 1

    def keys_of(block: int, held: list[np.ndarray]) -> pa.RecordBatch:
        keys = np.unique(np.concatenate(held))
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), block)), pa.array(keys.view(np.int64))], ["block", "key"])

    def cut(batches):
        for b in batches:
            found: dict[int, set[str]] = {}
            for block, host, path in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                found.setdefault(block, set()).update(name for _, name in names(host, path) if not name[0].isdigit())
            for block, own in found.items():
                held, size = [], 0
                for name in own:
                    held.append(candidates(name, lengths))
                    size += len(held[-1])
                    if size >= MOST_KEYS:
                        yield keys_of(block, held)
                        held, size = [], 0
                if held:
                    yield keys_of(block, held)

    def split(left: pa.Table, right: pa.Table) -> pa.Table:
        segmenter = Segmenter({w: -math.log(n / total) for w, n in zip(right.column("word").to_pylist(), right.column("n").to_pylist(), strict=True)})
        tokens = [segmenter.tokens(h, p) for h, p in zip(left.column("host").to_pylist(), left.column("path").to_pylist(), strict=True)]
        return left.append_column("tokens", pa.array(tokens, pa.list_(pa.string())))

    def keyed(batches):
        for b in batches:
            yield b.append_column("key", pa.array(list(map(word_key, b.column(0).to_pylist())), pa.int64()))

    keys = parsed.select("block", "host", "path").mapInArrow(cut, "block long, key long").distinct()
    words = counts.select("word", "n").mapInArrow(keyed, "word string, n long, key long")
    known = keys.join(words, "key").select(F.col("block").alias("of"), "word", "n")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in parsed.schema) + ", tokens array<string>"
    return parsed.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(split, schema)


class Model:
    """Log odds of block for each token, smoothed by one, from the counts of tokens (token, allow, block; under "" the pages)."""

    def __init__(self, sums: DataFrame):
        pages = sums.filter("token = ''").select("allow", "block").first() or (0, 0)
        allow, block, size = sums.filter("token <> ''").agg(F.coalesce(F.sum("allow"), F.lit(0)), F.coalesce(F.sum("block"), F.lit(0)), F.count("*")).first()
        self.totals = (allow + size + 1, block + size + 1)
        self.prior = math.log((pages[1] + 1) / (pages[0] + 1))

    def odds(self, allow: int, block: int) -> float:
        return math.log((block + 1) / self.totals[1]) - math.log((allow + 1) / self.totals[0])


def fit(labelled: DataFrame) -> DataFrame:
    """Counts (token, allow, block) of all tokens of the pages that a rule decides, under "" those of the pages; labelled: tokens, ruled."""
    rows = labelled.select("ruled", F.explode(F.concat(F.array(F.lit("")), "tokens")).alias("token"))
    return rows.groupBy("token").agg(F.count_if(F.col("ruled") == "allow").alias("allow"), F.count_if(F.col("ruled") == "block").alias("block"))


def filter_urls(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Host, path, rule and verdict of every page's url.

    The longest rule that fits decides; else multinomial naive Bayes over the words into which Viterbi splits host and path,
    with block only where it is the likelier. A page without host and path is allowed. The classifier is fitted on pages that
    rules decide, whose verdicts are its labels (at most TRAIN_PAGES of them, by hash); the unigram model counts the words of all pages.
    Returns page_id, host, path, rule, verdict, score (log odds of block; null where a rule decides). Null urls, repeated rows
    and null ids are kept. Hosts and paths are shuffled by blocks of pages and meet the whole counts of their words and tokens there;
    nothing is broadcast by this module and no count is left out.
    """
    host, path = host_and_path(F.col("url"))
    rule, verdict = matched(F.col("host"), F.col("path"), rules)
    parsed = pages.select("page_id", host.alias("host"), path.alias("path")).select("*", rule.alias("rule"), verdict.alias("ruled"))
    # Written, so that a row keeps its block.
    parsed = materialize(parsed.withColumn("block", F.floor(F.monotonically_increasing_id() / BLOCK)), "urls")
    rate = min(1.0, TRAIN_PAGES / max(1, parsed.filter(F.col("ruled").isNotNull()).count()))
    sampled = F.pmod(F.xxhash64(F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit("urls")), F.lit(1 << 30)) < int(rate * (1 << 30))
    open_ = F.col("ruled").isNull() & ((F.col("host") != "") | (F.col("path") != ""))
    counts = materialize(word_counts(pages), "words")
    tokens = materialize(tokenized(parsed.filter(open_ | F.col("ruled").isNotNull() & sampled), counts), "tokens")
    sums = materialize(fit(tokens.filter(F.col("ruled").isNotNull())), "sums")
    model = Model(sums)
    unruled = tokens.filter(F.col("ruled").isNull())

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        known = dict(zip(right.column("token").to_pylist(), zip(right.column("allow").to_pylist(), right.column("block").to_pylist(), strict=True), strict=True))
        odds: dict[str, float] = {}
        out = []
        for own in left.column("tokens").to_pylist():
            for t in own:
                if t not in odds:
                    odds[t] = model.odds(*known.get(t, (0, 0)))
            out.append(sum(map(odds.__getitem__, own), model.prior))
        return left.select(columns).append_column("score", pa.array(out, pa.float64()))

    columns = ["page_id", "host", "path", "rule", "ruled"]
    used = unruled.select(F.col("block").alias("of"), F.explode("tokens").alias("token")).distinct().join(sums, "token")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in parsed.select(columns).schema) + ", score double"
    scored = unruled.groupBy("block").cogroup(used.groupBy("of")).applyInArrow(score, schema)
    scored = scored.unionByName(parsed.filter(~open_).select(*columns, F.lit(None).cast("double").alias("score")))
    return scored.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.when(F.col("score") > 0, "block").otherwise("allow")).alias("verdict"), "score")
