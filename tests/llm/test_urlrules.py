"""op13: given rules and mined rules against plain Python versions."""

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from contract_lake.llm import urlrules
from contract_lake.llm.queries import URL_RULES

MINING = {"min_support": 0.05, "min_rows": 5, "min_confidence": 0.6, "min_lift": 1.1}


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:end], rest[end:]
    cut = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
    return "".join(c.lower() if c.isascii() else c for c in host), rest[:cut]


def given(host, path, rules=URL_RULES):
    best = None
    for verdict, name in rules:
        own, slash, start = name.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith(slash + start):
            best = max(best or (0, False, "", ""), (len(name), verdict == "block", name, verdict))
    return best[2:] if best else (None, None)


URLS = [None, "", "no scheme", "://", "http://", "HTTP://A.Org", "http://a.org/", "http://a.org?x=/", "https://org/x", "http://xorg/", "http://m.example.org/es/1",
        "http://example.org/en/1", "http://example.org/en/12?q", "http://example.org/en/2", "http://EXAMPLE.org/ES/1", "http://x.com/fr/", "http://x.com/de/9#f",
        "http://x.com/den", "http://x.com:80/fr/", "a://b://c.org/", "http://Ä.org/", "http://u@h.org/x\ny/z", "\nhttp://a.org/", "http://" + "a." * 3000 + "org/" + "d/" * 3000]


def test_host_path_and_given_rules(spark):
    df = spark.createDataFrame([(i, u, "h", "p") for i, u in enumerate(URLS + URLS[-3:])], "page_id long, url string, host string, token string")
    found = urlrules.judged(df, spark.createDataFrame([], "url string, blocked boolean"), URL_RULES)
    assert found.columns[:5] == ["page_id", "host", "path", "rule", "verdict"]
    got = sorted(tuple(r)[:5] for r in found.collect())
    expected = []
    for i, u in enumerate(URLS + URLS[-3:]):
        rule, verdict = given(*parts(u))
        expected.append((i, *parts(u), rule, verdict or "allow"))
    assert [tuple(x or "" for x in r) for r in got] == [tuple(x or "" for x in r) for r in sorted(expected, key=lambda r: r[0])]


def labelled(seed, n=600):
    chance = random.Random(seed)
    rows = []
    for _ in range(n):
        host = chance.choice(["shop.a.net", "blog.b.net", "free-bets.c.com", "casino-win.d.net"])
        lang, query = chance.choice(["en", "de"]), chance.choice(["", "?ref=x", "?utm=1"])
        bad = 0.9 if "bets" in host or ("casino" in host and query == "?ref=x") else 0.1
        rows.append((f"http://{host}/{lang}/{chance.randint(1, 9999)}{query}", chance.random() < bad))
    return rows


def test_mined_rules_against_enumeration(spark):
    rows = [*labelled(4), ("http://shop.a.net/en/5", None), (None, True), (None, False)]
    df = spark.createDataFrame(rows, "url string, blocked boolean")
    found = {(tuple(r["items"]), r["verdict"]): (r["confidence"], r["support"]) for r in urlrules.mined_rules(df, **MINING).collect()}
    tokens = [(frozenset(r.t), r.blocked) for r in df.where("blocked IS NOT NULL").select(urlrules.tokens_of(F.col("url")).alias("t"), "blocked").collect()]
    n = len(tokens)
    holding = {}
    for t in set().union(*(t for t, _ in tokens)):
        rows_of = frozenset(i for i, (s, _) in enumerate(tokens) if t in s)
        if max(0.05 * n, 5) <= len(rows_of) < n:
            holding[rows_of] = min(holding.get(rows_of, t), t)
    kept = set(holding.values())
    assert max(len(t & kept) for t, _ in tokens) <= 10  # so that no basket is cut
    rules = {}
    for size in range(1, 8):
        for items in combinations(sorted(kept), size):
            own = [b for t, b in tokens if t.issuperset(items)]
            for verdict, blocked in (("block", True), ("allow", False)):
                hits, share = sum(b == blocked for b in own), sum(b == blocked for _, b in tokens) / n
                if hits >= max(0.05 * n, 5) and hits / len(own) >= 0.6 and hits / len(own) / share >= 1.1:
                    rules[items, verdict] = (hits / len(own), hits / n)
    best = {k: v for k, v in rules.items() if not any(v2 == k[1] and set(i) < set(k[0]) and c[0] >= v[0] for (i, v2), c in rules.items())}
    assert best and found.keys() == best.keys()
    assert all(found[k] == pytest.approx(best[k]) for k in best)

    # the surest rule that fits decides
    pages = spark.createDataFrame(list(enumerate([u for u, _ in labelled(9, 80)] + ["http://other.org.uk/x"])), "page_id long, url string")
    token_of = {r.page_id: set(r.t) for r in pages.select("page_id", urlrules.tokens_of(F.col("url")).alias("t")).collect()}
    for r in urlrules.judged(pages, df, [], **MINING).collect():
        fits = [(found[k], k[1] == "block", k) for k in found if token_of[r.page_id].issuperset(k[0])]
        if not fits:
            assert (r.verdict, r.mined) == ("allow", None)
        else:
            top = max(f[:2] for f in fits)
            assert (r.verdict == "block", r.confidence, r.support) == (top[1], *top[0])


def test_a_large_index_is_joined_by_shuffle(spark, monkeypatch):
    df = spark.createDataFrame(labelled(4), "url string, blocked boolean")
    pages = spark.createDataFrame(list(enumerate([u for u, _ in labelled(9, 80)])), "page_id long, url string")
    expected = sorted(map(tuple, urlrules.judged(pages, df, URL_RULES, **MINING).select("page_id", "verdict", "confidence").collect()))
    monkeypatch.setattr(urlrules, "BROADCAST_BYTES", 0)
    assert sorted(map(tuple, urlrules.judged(pages, df, URL_RULES, **MINING).select("page_id", "verdict", "confidence").collect())) == expected


def test_labels_of_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.net/en/7"), (2, "http://a.net/en/8.html?x"), (3, "http://a.net/9/"), (4, "http://a.net/x7"), (5, None), (6, "http://a.net/en/10")],
                                  "page_id long, url string")
    labels = spark.createDataFrame([(7, 0, 0), (8, 1, 0), (8, 1, 1), (9, 1, None), (10, None, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    found = {(r.url, r.blocked) for r in urlrules.labelled_urls(pages, labels).collect()}
    assert found == {("http://a.net/en/7", True), ("http://a.net/en/8.html?x", True), ("http://a.net/9/", False)}


def test_no_pages(spark):
    nothing = spark.createDataFrame([], "page_id long, url string")
    assert urlrules.judged(nothing, spark.createDataFrame(labelled(1), "url string, blocked boolean"), URL_RULES, **MINING).count() == 0


def test_no_token_of_a_basket_is_cut(spark):
    """A thirteenth frequent token that tells little alone still makes its rule."""
    rows = []
    for i in range(1 << 10):
        keys = [f"k{j}=1" for j in range(13) if chance(i, j)]
        rows.append(("http://a.net/x?" + "&".join(keys), chance(i, 0) if chance(i, 12) else chance(i, 40)))
    found, _ = urlrules.baskets(spark.createDataFrame(rows, "url string, blocked boolean"), 0.05, 5)
    got = sorted((sorted(t for t in r["items"] if not t.startswith("label=")) for r in found.collect()))
    assert got == sorted(sorted(f"key:{k.split('=')[0]}" for k in u.split("?", 1)[1].split("&") if k) for u, _ in rows)
    assert max(map(len, got)) > 10


def chance(i, j):
    return (i * 2654435761 + j * 40503 * (i + 7)) // 64 % 8 > 1
