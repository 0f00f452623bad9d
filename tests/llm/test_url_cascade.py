import random
import re

import pytest
from pyspark.sql import functions as F

from parcelsight.llm import url_cascade as uc


def brute(url, rules):
    host, path = "", ""
    if url is not None and "://" in url:
        after = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", after)[0]
        path = re.match(r"[^?#]*", after[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for verdict, h, p in rules:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            rank = (len(h) + len(p), len(h), verdict == "allow", h + p, verdict)
            best = max(best, rank) if best else rank
    return host, path, best and best[3], best[4] if best else "allow"


URLS = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/1?x#y", "http://example.com/en", "http://example.com/en/",
    "http://notexample.com/en/", "https://a.b.net/fr/x/y", "https://net/es/", "https://x.net", "https://x.org/en/", "ftp://com/",
    "http://com?x/", "http://a.com#/en/", "http://www.example.com/en/../x", "http://É.com/en/", "a://b://c.com/x", "http://.com/", "http://example.com./en/",
]


def judged(spark, urls, rules):
    pages = spark.createDataFrame([(i, u, "p") for i, u in enumerate(urls)], "page_id long, url string, Rule string")
    table = spark.createDataFrame(rules, "verdict string, host string, path string")
    out = uc.judge(pages.repartition(3), table)
    return [tuple(r)[1:] for r in sorted(out.select("page_id", "host", "path", "rule", "verdict").collect(), key=lambda r: r[0])]


def test_rules_of_the_query(spark):
    assert judged(spark, URLS, uc.RULES) == [brute(u, uc.RULES) for u in URLS]


def test_many_rules(spark):
    drawn = random.Random(4)
    name = lambda: "".join(drawn.choice("abc") for _ in range(drawn.randint(1, 3)))
    rules = {(drawn.choice(("allow", "block")), ".".join(name() for _ in range(drawn.randint(1, 3))), "/" + "/".join(name() for _ in range(drawn.randint(0, 2)))) for _ in range(600)}
    rules = [*rules, ("block", None, "/"), (None, "a", "/"), ("other", "a", "/"), ("block", "zz", "")]
    urls = [f"http://{'.'.join(name() for _ in range(drawn.randint(1, 5)))}/{'/'.join(name() for _ in range(drawn.randint(0, 4)))}" for _ in range(3000)]
    good = [r for r in rules if r[0] in ("allow", "block") and r[1] is not None]
    got = judged(spark, urls, rules)
    expected = [brute(u, good) for u in urls]
    assert [g[:2] for g in got] == [e[:2] for e in expected]
    assert [(g[2], g[3]) for g in got] == [(e[2], e[3]) for e in expected]


@pytest.mark.parametrize("bits", [2, 10])
def test_membership_is_exact_for_the_universe(spark, bits):
    listed = spark.range(0, 3000, 3).select(F.col("id").cast("string").alias("key"))
    universe = spark.range(20000).select(F.col("id").cast("string").alias("key")).union(listed)
    keys = listed.union(listed).union(spark.sql("SELECT CAST(NULL AS STRING)"))
    cascade = uc.build(keys, universe, per_key=bits, size=1 << 10)
    assert len(cascade.segments) > (2 if bits == 2 else 1) and cascade.segments[0] > 1
    rows = universe.distinct().select("key", uc._hashes(F.col("key")).alias("x")).select("key", "x.*").toPandas()
    got = uc.listed(cascade, rows["h"].to_numpy(), rows["g"].to_numpy())
    assert [int(k) % 3 == 0 and int(k) < 3000 for k in rows["key"]] == got.tolist()


def test_no_rules_and_no_pages(spark):
    none = spark.createDataFrame([], "verdict string, host string, path string")
    pages = spark.createDataFrame([(1, "http://a.com/x", "p")], "page_id long, url string, verdict string")
    assert [(r.rule, r.verdict) for r in uc.judge(pages, none).collect()] == [(None, "allow")]
    assert uc.judge(pages.limit(0), uc.fixed_rules(spark)).collect() == []


def test_very_long_hosts(spark):
    rules = [*uc.RULES, ("block", "a.b.c.d.e", "/")]
    urls = [f"http://{'x.' * n}{end}/fr/y" for n in (1, 100, 12_000) for end in ("net", "com", "a.b.c.d.e", "org")]
    urls += ["http://b.c.d.e/", "http://a.b.c.d.e/", f"http://{'.' * 9_000}/", f"http://net/{'/' * 50_000}"]
    assert judged(spark, urls, rules) == [brute(u, rules) for u in urls]
