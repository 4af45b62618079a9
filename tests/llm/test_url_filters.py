import pytest

from flatgate.llm.queries import URL_RULES
from flatgate.llm.url_filters import build_trie, longest_match, rule_keys, url_verdicts, url_verdicts_joined
from tests.llm.helpers import SF, canon

ROWS = [(1, "http://Example.NET/en/x?y#z"), (2, "https://sub.example.net/fr/"), (3, "https://notexample.net"), (4, None), (None, "no scheme/x"),
        (5, ""), (5, "http://a.b.org/fr/x"), (5, "http://a.b.org/fr/x"), (6, "http://example.com/de"), (7, "http://example.com/de/"),
        (8, "http://x.net?q=/en/"), (9, "ftp://u:p@example.net:80/en/"), (10, "a://b://example.net/en/"), (11, "http:///en/"),
        (12, "http://net/" + "p/" * 3000), (13, "http://ÄB.net/a#b")]


def brute(url, rules=URL_RULES):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    path = tail[:min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, "allow"))
    return host, path, best[1], best[2]


def test_rows(spark):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in ROWS], "page_id long, url string, host string, rule string")
    want = canon((i, *brute(u)) for i, u in ROWS)
    assert canon(url_verdicts(pages, URL_RULES).collect()) == want
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    assert canon(url_verdicts_joined(pages, rules).collect()) == want
    assert url_verdicts(pages.limit(0), URL_RULES).collect() == []


def test_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    want = canon((r.page_id, *brute(r.url)) for r in pages.collect())
    assert canon(url_verdicts(pages, URL_RULES).collect()) == want


def test_longest_rule_wins():
    rules = [("com", "", "block"), ("a.com", "/x", "allow"), ("a.com", "/x/y", "block"), ("b.a.com", "/x", "block"), ("a.com", "/x/y/", "allow"),
             ("c.com", "/", "allow"), ("c.com", "/", "block")]
    trie = build_trie(rules)
    assert longest_match(trie, "a.com", "/xyz") == ("a.com/x", "allow")
    assert longest_match(trie, "a.com", "/x/y") == ("a.com/x/y", "block")
    assert longest_match(trie, "q.a.com", "/x/y/z") == ("a.com/x/y/", "allow")
    assert longest_match(trie, "b.a.com", "/x") == ("b.a.com/x", "block")
    assert longest_match(trie, "z.com", "") == ("com", "block")
    assert longest_match(trie, "c.com", "/q") == ("c.com/", "block")  # both verdicts: block
    assert longest_match(trie, "org", "/x") is None


def test_bad_rules(spark, monkeypatch):
    with pytest.raises(ValueError, match="verdict"):
        build_trie([("a", "/", "maybe")])
    monkeypatch.setattr("flatgate.llm.url_filters.MAX_RULE_BYTES", 3)
    with pytest.raises(ValueError, match="too many"):
        url_verdicts(spark.createDataFrame([(1, "x")], "page_id long, url string"), URL_RULES)


def test_joined_rules_cost_a_long_url_its_fitting_lengths_only(spark):
    rules = [("net", "/", "block"), ("a.net", "/p", "allow"), ("a.net", "/q", "block"), ("a.net", "/p/p", "block"), ("b.net", "/p", "block"),
             ("net", "", "allow"), ("a.net", "/p/é", "allow"), (None, "/", "block"), ("net", None, "block")]
    urls = ["http://a.net/" + "p/" * 50000, "http://x.a.net/p", "http://a.net", "http://b.net/p/é", "http://a.net/p/é/x", None, "http://org/"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    whole = [r for r in rules if None not in r]
    assert canon(url_verdicts_joined(pages, table).collect()) == canon((i, *brute(u, whole)) for i, u in enumerate(urls))
    parts = spark.createDataFrame([("a.net", "/" + "p/" * 50000)], "host string, path string")
    wanted = table.selectExpr("host AS k_host", "path AS k_path", "verdict")
    keys = sorted((r.k_host, r.k_path) for r in rule_keys(parts, wanted).collect())
    assert keys == [("a.net", "/p"), ("a.net", "/p/p"), ("net", ""), ("net", "/")]
    empty = spark.createDataFrame([], "host string, path string, verdict string")
    assert {r.verdict for r in url_verdicts_joined(pages, empty, default="block").collect()} == {"block"}
