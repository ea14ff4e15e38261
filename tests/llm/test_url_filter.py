import random

import pytest

from tillwise.llm import url_filter, workload

RULES = [*workload.URL_RULES, ("a.b.example.com", "/x/y/", "allow"), ("example.com", "/x/y/z/", "block"), ("host", "", "block")]


def brute(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [
        (len(h + p), len(h), h + p, a) for h, p, a in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=None)
    return host, path, best[2] if best else None, best[3] if best else "allow"


URLS = [
    None, "", "no scheme", "http://", "http:///en/", "HTTP://WWW.Example.NET/en/1?x#y", "http://example.net", "http://example.net?/en/",
    "ftp://a.b.example.com/x/y/z/1", "http://c.a.b.example.com/x/y/1", "http://notexample.net/en/", "http://net/", "x://host", "x://sub.host/any",
    "http://org/fr/", "http://Ä.org/fr/1", "http://a..net/", "http://example.com//de/", "http://u@example.com:80/de/", "a://b://c.net/",
]


def test_as_brute_force(spark):
    rng = random.Random(3)
    parts = ["example", "com", "net", "org", "a", "b", "host"]
    urls = URLS + [
        "http://" + ".".join(rng.choices(parts, k=rng.randrange(1, 5))) + "/" + "/".join(rng.choices(["en", "de", "fr", "x", "y", "z"], k=rng.randrange(0, 5))) + rng.choice(["", "/", "?q", "#f"])
        for _ in range(300)
    ]
    rows = [(i % 250, u, "old", "old") for i, u in enumerate(urls)]
    pages = spark.createDataFrame([*rows, rows[0], (None, None, None, None)], "page_id long, url string, rule string, host string")
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    got = url_filter.judge(pages, rules).select("page_id", "url", "host", "path", "rule", "verdict").collect()
    want = [(r.page_id, r.url, *brute(r.url, RULES)) for r in pages.collect()]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_no_rules_no_pages(spark):
    none = spark.createDataFrame([], "host string, path string, action string")
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    assert [r.verdict for r in url_filter.judge(pages, none).collect()] == ["allow"]
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    assert url_filter.judge(pages.where("page_id > 1"), rules).collect() == []


def test_equal_rules_and_bad_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    twice = spark.createDataFrame([("net", "/", "allow"), ("net", "/", "block"), (None, "/", "allow")], "host string, path string, action string")
    assert [r.verdict for r in url_filter.judge(pages, twice).collect()] == ["block"]
    with pytest.raises(Exception, match="does not end in a slash"):
        url_filter.judge(pages, spark.createDataFrame([("net", "/de", "block")], "host string, path string, action string")).collect()


def test_columns_with_any_name_stay(spark):
    df = spark.createDataFrame([("http://www.example.net/en/1",), (None,)], "url string")
    for name in ("best", "found_host", "Found_path", "digest", "short", "expression", "rule_action"):
        df = df.selectExpr("*", f"'{name}' AS {name}")
    rules = spark.createDataFrame(list(workload.URL_RULES), "host string, path string, action string")
    for row in url_filter.judge(df, rules).collect():
        assert row.best == "best" and row.found_host == "found_host" and row.Found_path == "Found_path"
        assert row.rule == ("example.net/en/" if row.url else None)
