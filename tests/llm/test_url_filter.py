import random

from pyspark.sql import functions as F

from kickwx.llm.url_filter import url_filter

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"),
         ("com", "/de/", "block"), ("EXAMPLE.com", "", "block"), ("example.com", "", "allow"), ("a.b.example.net", "/x", "block"), (None, "/", "block")]
SCHEMA = "host string, path string, verdict string"


def brute(url):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, rest = rest[:end], rest[end:]
    path = rest[: min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = []
    for h, p, v in RULES:
        h = h and h.lower()
        if h and (host == h or host.endswith("." + h)) and path.startswith(p):
            fits.append((len(h + p), v, h + p))
    best = max(fits, default=(0, "allow", None))
    return host, path, best[2], best[1]


def test_matches_brute_force(spark):
    rnd = random.Random(4)
    hosts = ["example.org", "www.Example.ORG", "org", "x.org", "borg", "example.com", "a.example.com", "fr.com", "a.b.example.net", "c.a.b.example.net",
             "b.example.net", "", "localhost:8080", "ÉCOLE.org", "..org", "user@x.com:1"]
    paths = ["", "/", "/es/", "/es", "/en/1", "/en/12", "/en/2", "/fr/1", "/de/1?x=/fr/", "/x#y", "/xy", "?q", "#f", "//", "/es/é"]
    urls = [f"{rnd.choice(['http', 'https', 'ftp'])}://{rnd.choice(hosts)}{rnd.choice(paths)}" for _ in range(400)]
    urls += [None, "", "nothing", "://", "http://", "a://b://c.org/", "http://x.org/\n/z"] + ["http://www.example.org/es/9"] * 50
    rows = [(i if i % 7 else None, u, "h", "p") for i, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, rule string")
    got = url_filter(pages, spark.createDataFrame(RULES, SCHEMA)).collect()
    key = lambda r: tuple((x is not None, x or "") for x in map(str, r))
    assert sorted(map(tuple, got), key=key) == sorted([(i, *brute(u)) for i, u, _, _ in rows], key=key)


def test_no_rules_and_no_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    none = spark.createDataFrame([], SCHEMA)
    assert [tuple(r) for r in url_filter(pages, none, default_verdict="block").collect()] == [(1, "a.org", "/", None, "block")]
    assert url_filter(pages.filter("false"), spark.createDataFrame(RULES, SCHEMA)).collect() == []


def test_the_default_plan_has_no_cross_join(spark):
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string").withColumn("extra", F.lit(1))
    plan = url_filter(pages, spark.createDataFrame(RULES, SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
