import math
import random
import re
from collections import Counter, defaultdict

import numpy as np

from talus.llm import urls

RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, path = rest[:end], rest[end:]
    cut = min([path.find(c) for c in "?#" if c in path], default=len(path))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path[:cut]


def rule(host, path):
    fit = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1:] if fit else (None, None)


HARD = [
    None, "", "no scheme", "http://", "http:///x", "HTTP://Ex.ORG/Es/1?x#y", "https://a.example.org/es/5", "https://a.example.org/en/15", "https://a.example.org/en/25", "http://xexample.org/es/1", "http://example.org",
    "http://example.org?x=/es/", "ftp://u:p@Host.COM:80/fr/a", "http://x.com/de/9#q", "http://x.com/DE/9", "http://a.b/://c", "x://y://z/fr/", "http://É.com/fr/", "http://a.com\n/fr/x", "http://org/", "http://" + "a" * 5000 + ".net/" + "b" * 5000,
]


def test_hosts_paths_and_rules(spark):
    df = spark.createDataFrame([(i, u, "<p>the of and</p>", "r") for i, u in enumerate(HARD)], "page_id long, url string, html string, rule string")
    got = {r.page_id: r for r in urls.filter_urls(df).collect()}
    assert len(got) == len(HARD)
    for i, u in enumerate(HARD):
        host, path = parse(u)
        name, verdict = rule(host, path)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, name), u
        assert got[i].verdict == verdict if verdict else got[i].verdict in ("allow", "block")


def test_query(spark, data):
    from talus.llm.queries import queries

    pages = {r.page_id: r.url for r in spark.read.parquet(f"{data}/pages.parquet").collect()}
    rows = queries()["op5_url_filter"](spark, data).collect()
    assert len(rows) == len(pages)
    for r in rows:
        host, path = parse(pages[r.page_id])
        name, verdict = rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, name)
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")


def test_segmentation():
    costs = {"the": 2.0, "cheap": 5.0, "pills": 5.0, "he": 3.0, "ap": 9.0, "a" * 60: 1.0}
    split = lambda name: urls.segment(name, costs, sorted({len(w) for w in costs}))
    assert split("cheappills") == ["cheap", "pills"]
    assert split("thecheap") == ["the", "cheap"]
    assert split("") == []
    assert split("zzqthe") == ["zzq", "the"] and split("q" * 400 + "the") == ["q" * 400, "the"]
    assert split("a" * 60 + "the") == ["a" * 60, "the"]


def test_segmentation_is_the_cheapest():
    rng = random.Random(1)
    costs = {"".join(rng.choice("ab") for _ in range(rng.randint(1, 5))): rng.choice([1.0, 4.0, 9.5, 20.0]) for _ in range(12)}
    price = lambda w: costs.get(w, math.inf)

    def cheapest(name):
        if not name:
            return 0.0
        return min(min(price(name[:k]), 12.0 + 3.0 * k) + cheapest(name[k:]) for k in range(1, len(name) + 1))

    for _ in range(150):
        name = "".join(rng.choice("abc") for _ in range(rng.randint(0, 9)))
        words = urls.segment(name, costs, sorted({len(w) for w in costs}))
        assert "".join(words) == name
        assert math.isclose(sum(min(price(w), 12.0 + 3.0 * len(w)) for w in words), cheapest(name))


def test_empty(spark):
    assert urls.filter_urls(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_every_word_and_token_counts(spark, monkeypatch):
    """Words and tokens far behind the most frequent keep their true counts, in blocks of any size."""
    monkeypatch.setattr(urls, "VOCABULARY", 3, raising=False)
    monkeypatch.setattr(urls, "TOKENS", 3, raising=False)
    monkeypatch.setattr(urls, "BLOCK", 2, raising=False)
    html = "<p>" + "the and of for with " * 50 + "quaint marmot</p>"
    rows = [(k, f"http://quaintmarmot.org/{w}", html) for k, w in enumerate(["the", "and", "of"] * 4)] + [(k, f"http://x.com/de/{w}", html) for k, w in enumerate(["for", "with"] * 4, 50)]
    rows += [(90, "http://quaintmarmot.net/the", html), (91, "http://zzz.net/the", html)]
    got = {r.page_id: r for r in urls.filter_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    counts = {w: 50 * len(rows) for w in ("the", "and", "of", "for", "with")} | {"quaint": len(rows), "marmot": len(rows)}
    costs = {w: -math.log(n / sum(counts.values())) for w, n in counts.items()}
    segmenter, sums, documents = urls.Segmenter(costs), defaultdict(lambda: [0.0, 0.0]), [1.0, 1.0]
    assert segmenter.tokens("quaintmarmot.net", "/the") == ["t:net", "h:quaint", "h:marmot", "p:the"]
    for _, u, _ in rows[:-2]:
        host, path = parse(u)
        k = rule(host, path)[1] == "block"
        documents[k] += 1
        for t in segmenter.tokens(host, path):
            sums[t][k] += 1
    totals = [sum(c[k] for c in sums.values()) + len(sums) + 1 for k in (0, 1)]
    for i in (90, 91):
        odds = [math.log((sums.get(t, [0, 0])[1] + 1) / totals[1]) - math.log((sums.get(t, [0, 0])[0] + 1) / totals[0]) for t in segmenter.tokens(got[i].host, got[i].path)]
        assert math.isclose(got[i].score, math.log(documents[1] / documents[0]) + sum(odds), rel_tol=1e-9)
        assert got[i].verdict == ("block" if got[i].score > 0 else "allow")


def test_verdicts_like_brute_force(spark, data):
    """Words counted, names split, tokens counted and verdicts given by plain loops over the whole pages."""
    pages = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{data}/pages.parquet").collect()]
    counts = Counter()
    for _, _, html in pages:
        plain = re.sub(r"(?s)<(script|style)\b.*?</\1>|<[^>]*>|&\w+;", " ", html or "").lower()
        counts.update(re.findall(r"(?<![^\W_])([^\W\d_]{2,})(?![^\W_])", plain))
    segmenter = urls.Segmenter({w: -math.log(n / sum(counts.values())) for w, n in counts.items()})
    sums, labels = (Counter(), Counter()), Counter()
    parsed = {i: (*parse(u), *rule(*parse(u))) for i, u, _ in pages}
    for host, path, name, verdict in parsed.values():
        if verdict:
            labels[verdict] += 1
            sums[verdict == "block"].update(segmenter.tokens(host, path))
    tokens = sums[0].keys() | sums[1].keys()
    total = [sum(c.values()) + len(tokens) + 1 for c in sums]
    for r in urls.filter_urls(spark.createDataFrame(pages, "page_id long, url string, html string")).collect():
        host, path, _, verdict = parsed[r.page_id]
        if verdict is None and (host or path):
            odds = math.log((labels["block"] + 1) / (labels["allow"] + 1)) + sum(math.log((sums[1][t] + 1) / total[1]) - math.log((sums[0][t] + 1) / total[0]) for t in segmenter.tokens(host, path))
            assert math.isclose(r.score, odds, rel_tol=1e-9, abs_tol=1e-9)
            verdict = "block" if odds > 0 else "allow"
        assert r.verdict == (verdict or "allow")


def test_candidates_are_the_keys_of_all_pieces():
    rng = random.Random(4)
    for _ in range(50):
        name = "".join(rng.choice("abcdé日") for _ in range(rng.randint(0, 30)))
        lengths = sorted(rng.sample(range(1, 40), rng.randint(0, 6)))
        want = {urls.word_key(name[i : i + k]) for k in lengths for i in range(len(name) - k + 1)}
        assert set(urls.candidates(name, lengths).view(np.int64).tolist()) == want
    long_ = "".join(rng.choice("abcdefghij") for _ in range(2000))
    keys = urls.candidates(long_, range(1, 601))
    assert keys.nbytes < 12_000_000 and len(set(keys.tolist())) == len(keys)
