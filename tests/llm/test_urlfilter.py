from itertools import combinations

from stormgrid.llm import urlfilter as U
from stormgrid.llm.queries import GIVEN_RULES


def tokens(spark, urls):
    frame = spark.createDataFrame([(u,) for u in urls], "url string")
    return {r.url: set(r.t) for r in frame.select("url", U.tokens_of(frame.url).alias("t")).collect()}


def test_given_rules(spark):
    urls = {
        "http://a.example.com/en/1": ("block", "example.com/en/"), "http://WWW.example.com/en/1": ("allow", "www.example.com/en/"),
        "http://m.www.example.com/en/": ("allow", "www.example.com/en/"), "https://x.com/en/1?q": ("allow", "com/"), "https://x.com": ("allow", None),
        "http://b.net/es/2": ("block", "net/es/"), "http://b.net/fr": ("allow", None), "http://net/fr/": ("block", "net/fr/"),
        "http://notexample.com/en/": ("allow", "com/"), "ftp://c.org/x": ("allow", None), "no scheme": ("allow", None), None: ("allow", None), "": ("allow", None),
        "x://y.net?://z.net/es/": ("allow", None),
    }
    pages = spark.createDataFrame([(i, u, "q") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    got = U.judge(pages, GIVEN_RULES, spark.createDataFrame([], "url string, bad boolean"))
    assert got.columns.count("rule") == 1
    assert {r.url: (r.verdict, r.rule) for r in got.collect()} == urls
    hosts = {r.url: (r.host, r.path) for r in got.collect()}
    assert hosts["http://WWW.example.com/en/1"] == ("www.example.com", "/en/1") and hosts[None] == ("", "") and hosts["x://y.net?://z.net/es/"] == ("y.net", "")


def brute(has, labelled, mining):
    """All token sets that pass support, confidence and lift, less those with an as confident part."""
    rows = [(has[u], b) for u, b in labelled if b is not None]
    base, least = sum(b for _, b in rows) / len(rows), mining.support * len(rows)
    sure = {}
    for every in {frozenset(t) for t, _ in rows}:
        for n in range(1, len(every) + 1):
            for part in combinations(sorted(every), n):
                fits = [b for t, b in rows if set(part) <= t]
                if sum(fits) >= least and sum(fits) / len(fits) >= mining.confidence and sum(fits) / len(fits) / base >= mining.lift:
                    sure[part] = sum(fits) / len(fits)
    return {p for p, c in sure.items() if not any(set(q) < set(p) and d >= c for q, d in sure.items())}


def test_mined_rules_equal_brute_force(spark):
    hosts = ["spam.shop.org", "good.org", "shop.org", "news.net"]
    labelled = [(f"http://{h}/{p}/{i}", (h, p) in (("spam.shop.org", "a"), ("spam.shop.org", "b"), ("news.net", "b")) or i == 3) for h in hosts for p in "abc" for i in range(6)]
    labelled += [("http://good.org/a/1", None), (None, True), ("", False)]
    mining = U.Mining(support=0.02, confidence=0.6, lift=1.2)
    has = tokens(spark, {u for u, _ in labelled})
    rules = U.mine(spark.createDataFrame(labelled, "url string, bad boolean"), mining)
    want = brute(has, labelled, mining)
    assert {tuple(r.tokens) for r in rules.collect()} == want and want
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(labelled)], "page_id long, url string")
    got = U.judge(pages, [], spark.createDataFrame(labelled, "url string, bad boolean"), mining)
    assert {r.page_id: r.verdict for r in got.collect()} == {i: "block" if any(set(p) <= has[u] for p in want) else "allow" for i, (u, _) in enumerate(labelled)}


def test_empty_pages(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert U.judge(none, GIVEN_RULES, spark.createDataFrame([], "url string, bad boolean")).collect() == []
