import random

import pytest

from daycast.llm.url_filter import build_cascade, filter_urls

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def plain(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best[2] if best else None, best[3] if best else "allow"


def check(spark, urls, rules, **kw):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr("*", "'x' AS rule", "1 AS Key", "2 AS `h.p`")
    told = spark.createDataFrame(rules, "host string, path string, verdict string")
    rows = filter_urls(pages, told, **kw).collect()
    assert len(rows) == len(urls)
    for r in rows:
        assert (r.host, r.path, r.rule, r.verdict) == plain(urls[r.page_id], rules), urls[r.page_id]
        assert r["h.p"] == 2 and r.Key == 1


EDGES = [None, "", "no scheme", "http://", "http://Net/", "http://NET", "https://a.EXAMPLE.net/en/x?y#z", "http://example.net/EN/", "http://xexample.net/en/",
         "x://example.com/de/", "x://example.com/de", "x://sub.sub.example.com/de/?q", "x://org/fr/", "x://É.org/fr/a", "x://a.b.org?/fr/", "a://b://net/",
         "x://.net/", "x://net./", "x://user@host.net:80/en/", "x://" + "a." * 5000 + "net/" + "p/" * 20000, "http://a.net/", "http://a.net/"]


def test_edges(spark):
    check(spark, EDGES, RULES)


def test_many_rules_are_exact(spark):
    rng = random.Random(1)
    hosts = [f"{a}.{b}" for a in "abcdefgh" for b in ("com", "net", "co.uk")] + ["com", "uk"]
    paths = ["", "/", "/x", "/x/", "/x/y"]
    rules = list({(rng.choice(hosts), rng.choice(paths)): rng.choice(["allow", "block"]) for _ in range(60)}.items())
    rules = [(h, p, v) for (h, p), v in rules]
    urls = [f"http://{rng.choice(['', 'www.', 'a.b.'])}{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', '/z', 'q', '?k'])}" for _ in range(500)]
    check(spark, urls, rules)


def test_no_rules_and_conflicts(spark):
    check(spark, ["http://a.net/x", None], [])
    check(spark, ["http://a.net/x", "http://b.net/"], [("net", "/", "allow"), ("net", "/", "block"), (None, "/", "block"), ("a.net", None, "allow")][:2])


def test_empty_table(spark):
    check(spark, [], RULES)


def test_cascade_has_no_error_in_its_universe(spark):
    from pyspark.sql import functions as F
    keys = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") % 7 == 0).alias("listed"))
    cascade = build_cascade(keys, "listed")
    assert len(cascade.levels) > 1
    assert keys.where(cascade.holds(F.col("key")) != F.col("listed")).count() == 0
    with pytest.raises(ValueError):
        build_cascade(keys, "listed", max_filter_bytes=64)
