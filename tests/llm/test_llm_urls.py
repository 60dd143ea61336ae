"""URL filters: exact membership by cascades, and verdicts against a plain scan of the rules."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.llm import urls


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
    host, path = rest[:end], rest[end:]
    cut = min([i for i in (path.find(c) for c in "?#") if i >= 0], default=len(path))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path[:cut]


def brute(rows, rules):
    out = []
    for page, url in rows:
        host, path = parts(url)
        fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, None, "allow"), key=lambda x: (x[0], x[1], x[2] == "allow"))
        out.append((page, host, path, best[1], best[2]))
    return sorted(out, key=repr)


URLS = [
    None, "", "no scheme", "://", "http://", "http://net", "http://net/", "http://NET/x", "http://a.net/?q#f", "http://planet/",
    "https://m.Example.NET/en/25#top", "http://example.net/en", "http://example.net/en/", "http://x.example.com/de/a?b=/fr/",
    "http://example.com/DE/", "http://a.org/fr/x", "http://org/fr/", "ftp://u@net:80/", "http://É.net/é", "http://a..net/",
    "http://net?x=/", "x://y://net/", "http://" + "a." * 3000 + "net/" + "p" * 20_000, "http://net/\nx",
]


def judged(spark, rows, rules, **options):
    df = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "1 as host", "'r' as rule", "2 as key")
    listed = spark.createDataFrame(rules, "host string, path string, verdict string")
    out = urls.judge(df, listed, **options).select("page_id", "host", "path", "rule", "verdict")
    return sorted((tuple(r) for r in out.collect()), key=repr)


@pytest.mark.parametrize("options", [{}, {"max_bits": 0}])
def test_same_as_a_scan_of_the_rules(spark, options):
    pick = random.Random(4)
    hosts = [f"{pick.choice('abcdef')}.{pick.choice(['x', 'y', 'z'])}.{pick.choice(['net', 'org', 'com'])}" for _ in range(60)]
    rows = list(enumerate(URLS + URLS[:6] + [f"http://{pick.choice(hosts)}/{pick.choice(['en/', 'de/', '', 'q'])}{i}" for i in range(300)]))
    rules = list(urls.RULES) + [(h, p, pick.choice(["allow", "block"])) for h in sorted(set(hosts))[:25] for p in ("/en/", "/")]
    assert judged(spark, rows, rules, **options) == brute(rows, rules)


def test_rules_in_both_lists_and_odd_rules(spark):
    rules = [("net", "/", "block"), ("NET", "/", "allow"), (None, "/", "block"), ("org", None, "block"), ("com", "/", "other"), ("com", "/", None)]
    rows = [(1, "http://a.net/"), (2, "http://org/"), (3, "http://com/")]
    assert [r[3:] for r in judged(spark, rows, rules)] == [("net/", "allow"), (None, "allow"), (None, "allow")]


def test_empty_tables(spark):
    assert judged(spark, [], urls.RULES) == []
    assert judged(spark, [(1, "http://a.net/")], []) == [(1, "a.net", "/", None, "allow")]


def test_cascade_is_exact_for_the_universe(spark):
    universe = spark.range(20_000).select(F.concat(F.lit("key"), "id").alias("key"))
    listed = spark.range(0, 24_000, 8).select(F.concat(F.lit("key"), "id").alias("key"))
    levels = urls.build_cascade(universe, listed)
    assert len(levels) > 1
    told = universe.where(urls.is_listed(levels, F.col("key"))).collect()
    assert sorted(r["key"] for r in told) == sorted(f"key{i}" for i in range(0, 20_000, 8))


def test_plan_has_no_join(spark):
    df = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    rules = spark.createDataFrame(list(urls.RULES), "host string, path string, verdict string")
    plan = urls.judge(df, rules)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan and "Python" not in plan
