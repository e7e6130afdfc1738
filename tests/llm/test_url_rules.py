"""Operator 6 against direct rule matching."""

from ledgerline.llm import url_rules
from ledgerline.llm.queries import URL_RULES

URLS = [
    None, "", "no scheme", "http://example.net/en/1", "http://a.example.net/en", "http://a.example.net/en/", "HTTP://A.EXAMPLE.NET/en/x?y#z",
    "http://net/", "http://net", "http://x.net?q=/en/", "http://notexample.net/en/1", "http://example.com/de/", "http://b.example.com/de/x://y",
    "http://example.com/DE/", "http://xorg/fr/", "http://y.org/fr/a/b", "http://net:80/", "http://a..net/en/", "ftp://é.org/fr/ü", "x://y://net/", "http:///path",
    "http://exämple.net/en/\n1", "http://a.b.c.d.e.f.g.net/en/", "http://a.net/" + "p" * 3000,
]


def brute(url, rules, default="allow"):
    if url is None or "://" not in url:
        return "", "", None, default
    rest = url.split("://", 1)[1]
    cut = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([i for i in map(path.find, "?#") if i >= 0], default=len(path))]
    hits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(hits, default=None)
    return host, path, best and best[3], best[4] if best else default


def test_verdicts(spark):
    rules = [*URL_RULES, ("f.g.net", "/e", "block"), ("a.b.c.d.e.f.g.net", "/en/", "allow"), ("c.d.e.f.g.net", "/en/abcdef", "block")]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(URLS * 2)], "page_id long, url string, rule string").repartition(3)
    for some in (rules, URL_RULES):
        out = url_rules.judge(pages, spark.createDataFrame(some, "host string, path string, verdict string"))
        got = sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in out.select("page_id", "host", "path", "rule", "verdict").collect())
        assert got == [(i, *brute(u, some)) for i, u in enumerate(URLS * 2)]


def test_short_key_collisions_are_confirmed(spark, monkeypatch):
    monkeypatch.setattr(url_rules, "KEY_DIGITS", 1)
    pages = spark.createDataFrame([(i, f"http://h{i}.net/en/{i}") for i in range(300)], "page_id long, url string")
    rules = [(f"h{i}.net", "/en/", "block") for i in range(0, 300, 3)]
    out = url_rules.judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string"))
    assert {r.page_id for r in out.where("verdict = 'block'").collect()} == set(range(0, 300, 3))
    assert out.count() == 300


def test_no_rules_no_rows(spark):
    pages = spark.createDataFrame([(1, "http://a.net/"), (1, "http://a.net/"), (None, None)], "page_id long, url string")
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert [r.verdict for r in url_rules.judge(pages, none, "block").collect()] == ["block"] * 3
    assert url_rules.judge(pages.limit(0), spark.createDataFrame(URL_RULES, none.schema)).count() == 0


def test_native_plan(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    plan = url_rules.judge(pages, spark.createDataFrame(URL_RULES, "host string, path string, verdict string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
