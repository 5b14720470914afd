"""Personal data in texts: exact base patterns, and weakly supervised spans beside them. DataFrame functions only.

Base kinds are patterns with checks. The method adds spans: labelers (patterns, a gazetteer of nearby words, context) vote on
candidate tokens; expectation-maximisation over the counts of vote patterns estimates each labeler's reliability and each
pattern's probability; a naive Bayes span classifier is trained on the candidates' features with these probabilities and decides.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

KINDS = ("email", "ip", "card", "phone", "secret", "number")

#: Fixed patterns of the base kinds. Quantifiers are possessive, an email starts only where no character of its local part stands
#: before (or where the last match ended) and an address only where no digit does, which matches the same spans without retries inside a run.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a kind's pattern to be tried.
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}

#: Candidates: tokens of 12 or more characters with a digit, and numbers in the groups of national ids and telephones. A token starts
#: where its run does, or one character behind the last match, which may have ended within the run; so no run is tried again from each of its hyphens.
CANDIDATE = r"(?<![A-Za-z0-9])(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}|(?:(?<![A-Za-z0-9_-])|(?<=\G[_-]))(?=[A-Za-z_-]*+[0-9])[A-Za-z0-9_-]{12,}+)(?![A-Za-z0-9])"
GAZETTEER = r"(?i)(?:pass(?:word|wd|port)?|pwd|token|secret|key|api|auth|bearer|ssn|social|tax|iban|account|phone|tel|call|mobile|fax)[^A-Za-z]{0,4}$"
LABELERS = ("hex", "mixed", "grouped", "nearby_word", "assigned", "plain_number", "wordlike")


class Model(NamedTuple):
    """weights: log odds of (feature, value); prior: log odds of a span; reliability: P(vote | span) and P(vote | none) by labeler."""

    prior: float
    weights: dict[tuple[str, str], float]
    reliability: dict[str, tuple[dict[int, float], dict[int, float]]]


def _pieces(text: Column, pattern: str, needs: str) -> tuple[Column, Column]:
    some = F.instr(text, needs) > 0 if needs else text.rlike("[0-9]")
    return some, F.when(some, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))


#: Items that a fold gathers in one array, and code points of a text's pieces: both keep work in proportion to a text's length.
BLOCK, PIECE = 256, 4096


def _running(df: DataFrame, items: str, value, both, name: str) -> DataFrame:
    """df with an array of ints more: for each of the items (an array column), `both` (sum or largest) of the values before it, 0 for the first.

    Folds over blocks of BLOCK items, then over the blocks, so that no array grows with every item of a long text."""

    def step(acc, x):
        return F.struct(both(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
    last = F.ceil(F.size(items) / BLOCK).cast("int") - 1
    numbers = F.when(F.size(items) > 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    part = F.transform(numbers, lambda k: F.aggregate(F.transform(F.slice(items, k * BLOCK + 1, F.lit(BLOCK)), value), start, step))
    df = df.withColumn("__parts", part)
    heads = F.aggregate(F.transform("__parts", lambda p: p["at"]), start, step, lambda acc: acc["out"])
    return df.withColumn(name, F.flatten(F.zip_with("__parts", heads, lambda p, h: F.transform(p["out"], lambda v: both(h, v))))).drop("__parts")


def _placed(df: DataFrame, patterns: list[tuple[str, str]]) -> DataFrame:
    """df with __placed, array<struct<kind, before, match, start, end>> in code points of what each of the patterns matches in __text; they come
    as (column of matches, pattern), kind is the pattern's place. What lies between matches gives their places: the pieces of every kind
    make up the whole text, whose length is taken off before the next kind's."""
    kind = "array<struct<kind:int,before:string,gap:int,match:string>>"

    def items(k: int, matches: str, pattern: str) -> Column:
        one = lambda g, m: F.struct(F.lit(k).alias("kind"), F.right(g, F.lit(24)).alias("before"), F.length(g).alias("gap"), m.alias("match"))
        back = F.struct(F.lit(k).alias("kind"), F.lit("").alias("before"), (-F.length("__text")).alias("gap"), F.lit(None).cast("string").alias("match"))
        return F.when(F.size(matches) > 0, F.concat(F.zip_with(F.split("__text", pattern, -1), matches, one), F.array(back))).otherwise(F.array().cast(kind))

    df = df.withColumn("__items", F.concat(*(items(k, m, p) for k, (m, p) in enumerate(patterns))))
    df = _running(df, "__items", lambda x: x["gap"] + F.coalesce(F.length(x["match"]), F.lit(0)), lambda a, b: a + b, "__before")

    def place(x, before):
        start = before + x["gap"]
        return F.struct(x["kind"].alias("kind"), x["before"].alias("before"), x["match"].alias("match"), start.alias("start"), (start + F.length(x["match"])).alias("end"))

    placed = F.filter(F.zip_with("__items", "__before", place), lambda x: x["match"].isNotNull())
    return df.withColumn("__placed", placed).drop("__items", "__before")


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total, i):
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        short = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
        return F.forall(F.split(m, r"\."), lambda p: (F.length(short(p)) <= 3) & (F.substring(short(p), 1, 3).cast("int") <= 255))
    d = _digits(m)
    if kind == "card":
        return F.length(d).between(12, 19) & _luhn(F.substring(d, 1, 19))
    return F.length(d).between(9, 15)


def _reached(c: Column, spans: str) -> Column:
    """Whether c overlaps one of the spans, which are sorted by start; each has the largest end up to it. The last that starts before c's end
    is found by halving."""
    at = lambda k: F.get(spans, k)

    def halve(acc, _):
        middle = F.floor((acc["low"] + acc["high"]) / 2).cast("int")
        below = at(middle)["start"] < c["end"]
        open_ = acc["low"] < acc["high"]
        return F.struct(F.when(open_ & below, middle + 1).otherwise(acc["low"]).alias("low"), F.when(open_ & ~below, middle).otherwise(acc["high"]).alias("high"))

    steps = F.sequence(F.lit(0), F.ceil(F.log2((F.size(spans) + 1).cast("double"))).cast("int"))
    found = F.aggregate(steps, F.struct(F.lit(0).alias("low"), F.size(spans).alias("high")), halve, lambda acc: acc["low"] - 1)
    return F.coalesce(at(found)["end"] > c["start"], F.lit(False))


def _located(docs: DataFrame) -> DataFrame:
    """docs with base (sorted structs start, kind number, end) and candidates (structs with votes and features)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    df = docs.select("*", text.alias("__text"))
    t = F.col("__text")
    found = {k: _pieces(t, BASE[k], NEEDS[k])[1] for k in BASE}
    df = df.select("*", *(found[k].alias(f"__m_{k}") for k in BASE), F.when(t.rlike("[0-9]"), F.regexp_extract_all(t, F.lit(CANDIDATE), F.lit(0))).alias("__m_more"))
    df = _placed(df, [*((f"__m_{k}", BASE[k]) for k in BASE), ("__m_more", CANDIDATE)])

    def good(s):
        valid = F.lit(False)
        for k, name in reversed(list(enumerate(BASE))):
            valid = F.when(s["kind"] == k, _valid(name, s["match"])).otherwise(valid)
        return valid

    base = F.transform(F.filter("__placed", good), lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    df = df.select("*", F.array_sort(base).alias("__base"), F.filter("__placed", lambda s: s["kind"] == len(BASE)).alias("__more"))
    df = df.drop("__text", "__placed", *(f"__m_{k}" for k in [*BASE, "more"]))
    df = _running(df, "__base", lambda s: s["end"], F.greatest, "__reach")
    df = df.withColumn("__ends", F.zip_with("__base", "__reach", lambda s, r: F.struct(s["start"].alias("start"), F.greatest(s["end"], r).alias("end"))))
    apart = F.when(F.size("__ends") > 0, F.filter("__more", lambda c: ~_reached(c, "__ends"))).otherwise(F.col("__more"))
    return df.withColumn("__more", F.transform(apart, _described)).drop("__reach", "__ends")


def _described(c: Column) -> Column:
    """start, end, kind number, votes (one character a labeler: + - or 0) and features (one string each)."""
    m, before = c["match"], c["before"]
    vote = lambda yes, no: F.when(yes, "+").when(no, "-").otherwise("0")
    n, digits = F.length(m), F.length(_digits(m))
    letters = F.length(F.regexp_replace(m, "[^A-Za-z]", ""))
    never = F.lit(False)
    grouped = m.rlike(r"^\(?[0-9]{3}\)?[ .-][0-9]{2,3}[ .-][0-9]{4}$")
    turns = F.size(F.regexp_extract_all(m, F.lit("[A-Za-z][0-9]|[0-9][A-Za-z]"), F.lit(0)))
    votes = F.concat(
        vote(m.rlike("^(?:[0-9a-f]{16,}|[0-9A-F]{16,})$") & (letters > 0), never),
        vote((turns >= 3) & (n >= 12), (turns <= 1) & ~grouped),
        vote(grouped, never),
        vote(before.rlike(GAZETTEER), never),
        vote(before.rlike("[=:]\\s?[\"']?$"), before.rlike(r"[A-Za-z.,]\s$")),
        vote(never, (letters == 0) & ~grouped),
        vote(never, (digits <= 2) & ~grouped),
    )
    features = F.array(
        F.when(n < 14, "short").when(n < 20, "middle").when(n < 34, "long").otherwise("longer"),
        F.when(letters == 0, "none").when(letters * 4 < n, "few").when(letters * 4 < n * 3, "half").otherwise("most"),
        F.when(turns == 0, "0").when(turns < 3, "1").when(turns < 6, "3").otherwise("6"),
        F.when(before == "", "begin").when(before.rlike("[=:]\\s?[\"']?$"), "assigned").when(before.rlike(r"\s$"), "space").otherwise("other"),
        F.when(before.rlike(GAZETTEER), "word").otherwise("no"),
        F.when(grouped, "grouped").when(m.rlike("^[0-9a-fA-F]+$"), "hex").otherwise("other"),
    )
    kind = F.when(grouped, KINDS.index("number")).otherwise(KINDS.index("secret"))
    return F.struct(c["start"].alias("start"), kind.alias("kind"), c["end"].alias("end"), votes.alias("votes"), features.alias("features"))


FEATURES = ("length", "letters", "turns", "before", "nearby", "form")


def estimate(patterns: dict[str, int], rounds: int = 50) -> tuple[dict[str, float], dict]:
    """Probability of a span for each vote pattern, by expectation-maximisation over their counts, and the labelers' vote probabilities.

    Starts from the balance of votes; smoothing by one count keeps every vote possible.
    """
    p = {v: 1 / (1 + math.exp(-1.5 * (v.count("+") - v.count("-")))) for v in patterns}
    table: dict = {}
    for _ in range(rounds):
        yes = sum(n * p[v] for v, n in patterns.items())
        no = sum(patterns.values()) - yes
        prior = math.log((yes + 1) / (no + 1))
        table = {}
        for k, name in enumerate(LABELERS):
            both = []
            for total, weight in ((yes, lambda v: p[v]), (no, lambda v: 1 - p[v])):
                both.append({c: (sum(n * weight(v) for v, n in patterns.items() if v[k] == c) + 1) / (total + 3) for c in "+-0"})
            table[name] = tuple(both)
        p = {v: 1 / (1 + math.exp(-max(-50, min(50, prior + sum(math.log(table[name][0][v[k]] / table[name][1][v[k]]) for k, name in enumerate(LABELERS)))))) for v in patterns}
    return p, table


def train(docs: DataFrame) -> Model:
    """Fit on the candidates of all docs. What reaches the driver are counts of (votes, features), whose number is bounded by their
    domains, whatever the input; no row has text."""
    # The outer kind: else Spark filters by the size of the candidates first and works them out twice.
    counted = _located(docs.select("text")).select(F.explode_outer("__more").alias("c")).groupBy("c.votes", "c.features").agg(F.count("*").alias("n")).collect()
    counted = [r for r in counted if r["votes"] is not None]
    patterns: dict[str, int] = {}
    for r in counted:
        patterns[r["votes"]] = patterns.get(r["votes"], 0) + r["n"]
    p, table = estimate(patterns)
    yes = sum(r["n"] * p[r["votes"]] for r in counted)
    no = sum(r["n"] for r in counted) - yes
    sums: dict[tuple[str, str], list[float]] = {}
    for r in counted:
        for name, value in zip(FEATURES, r["features"], strict=True):
            c = sums.setdefault((name, value), [1.0, 1.0])
            c[0] += r["n"] * p[r["votes"]]
            c[1] += r["n"] * (1 - p[r["votes"]])
    weights = {k: math.log(a / (yes + 4)) - math.log(b / (no + 4)) for k, (a, b) in sums.items()}
    return Model(math.log((yes + 1) / (no + 1)), weights, table)


def _spanned(docs: DataFrame, model: Model | None) -> DataFrame:
    """docs with __base and __spans."""
    model = model or train(docs)
    df = _located(docs)
    score = lambda c: F.lit(model.prior) + sum((_weight(model, name, c["features"][i]) for i, name in enumerate(FEATURES)), F.lit(0.0))
    more = F.transform(F.filter("__more", lambda c: score(c) > 0), lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end")))
    return df.select("*", F.array_sort(F.concat("__base", more)).alias("__spans")).drop("__more")


def find(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """docs with two columns more (in place of their own of these names): base and spans, arrays of struct<start, kind, end> by start, then
    kind (a place in KINDS).

    spans holds base and the candidates that the classifier takes; a candidate that overlaps a base span is none. Places are code
    points, end exclusive. Null and empty texts have no spans. Without a model one is trained on docs. No shuffle of texts; no Python.
    """
    df = _spanned(docs.drop("base", "spans"), model)
    return df.withColumnsRenamed({"__base": "base", "__spans": "spans"})


def _weight(model: Model, name: str, value: Column) -> Column:
    out = None
    for (n, v), w in sorted(model.weights.items()):
        if n == name:
            out = F.when(value == v, w) if out is None else out.when(value == v, w)
    return F.lit(0.0) if out is None else out.otherwise(0.0)


def joined(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256 and spans, a row for each row of docs."""
    df = find(docs.select("doc_id", "text"), model)
    count = lambda i: F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long")
    counts = [count(i).alias(f"n_{k}") for i, k in enumerate(BASE)]
    return df.select("doc_id", *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """docs with every span of text replaced by its kind in brackets, such as [EMAIL]; overlapping spans become one, named after the
    first. A null text stays null; texts without spans stay as they are."""
    df = _spanned(docs, model).withColumn("__text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    # Pieces of the text, so that taking a part does not walk the text from its beginning.
    last = F.floor(F.length("__text") / PIECE).cast("int")
    df = df.withColumn("__pieces", F.transform(F.when(F.size("__spans") > 0, F.sequence(F.lit(0), last)), lambda k: F.substring("__text", k * PIECE + 1, F.lit(PIECE))))
    df = df.withColumn("__length", F.length("__text"))
    df = _running(df, "__spans", lambda s: s["end"], F.greatest, "__done")
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))

    def part(start, end):
        a, b = (F.floor(x / PIECE).cast("int") for x in (start, end))
        piece = lambda k: F.get("__pieces", k)
        one = F.substring(piece(a), start % PIECE + 1, end - start)
        more = F.concat(F.substring(piece(a), start % PIECE + 1, F.lit(PIECE)), F.array_join(F.slice("__pieces", a + 2, b - a - 1), ""), F.substring(piece(b), F.lit(1), end % PIECE))
        return F.when(a == b, one).otherwise(more)

    # Each span that begins beyond all before it, and an empty one at the end, brings the text before it.
    cut = F.zip_with("__spans", "__done", lambda s, done: F.when(s["start"] >= done, F.concat(part(done, s["start"]), names[s["kind"]])).otherwise(""))
    end = F.array_max(F.transform("__spans", lambda s: s["end"]))
    df = df.withColumn("__cut", F.array_join(cut, "")).withColumn("__rest", F.when(F.size("__spans") > 0, part(end, F.col("__length"))))
    text = F.when(F.size("__spans") > 0, F.concat("__cut", "__rest")).otherwise(F.col("text").cast("string"))
    return df.withColumn("text", text).select(*docs.columns)
