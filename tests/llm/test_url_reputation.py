import random

import pytest
from pyspark.sql import functions as F

from tidegate.llm import url_reputation as U
from tidegate.llm.queries import QUERIES

RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def by_hand(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url[url.index("://") + 3 :]
    end = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    path = path[: min([i for i in map(path.find, "?#") if i >= 0], default=len(path))]
    fits = [(len(h + p), v, h + p) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[1:] if fits else (None, None))


URLS = [
    None, "", "no scheme/at/all", "http://A.Example.NET/en/x?y#z", "https://example.net/EN/", "http://notexample.net/en/", "http://x.net", "http://x.net?a=/en/",
    "http://example.com/de/", "http://sub.example.com/de", "http://sub.example.com/de/a://b/fr/", "ftp://a.org/fr/#q", "http://org/fr/", "http://ÄB.org/fr/x",
    "://host/path", "http://", "http://h#f/en/", "http://user@h.net:80/x", "a://b://c/", "http://x.example.com/de/\nnew?x", "http://www.co.uk/", "http://a.b.co.uk/",
]


def test_parts_and_rules(spark):
    df = spark.createDataFrame([(u,) for u in URLS], "url string")
    host, path = U.host_of(F.col("url")), U.path_of(F.col("url"))
    rule = U.rule_of(host, path)
    rows = df.select("url", host.alias("h"), path.alias("p"), rule["verdict"].alias("v"), rule["rule"].alias("r")).collect()
    assert [(r.h, r.p, r.v, r.r) for r in rows] == [by_hand(u) for u in URLS]


def test_domains(spark):
    hosts = ["a.b.example.com", "example.com", "com", "", "a.b.co.uk", "b.co.uk", "co.uk", "x.example.org:8080"]
    df = spark.createDataFrame([(h,) for h in hosts], "h string").select(U.domain_of(F.col("h")), U.suffix_of(F.col("h")))
    assert [tuple(r) for r in df.collect()] == [
        ("example.com", "com"), ("example.com", "com"), ("com", "com"), ("", ""), ("b.co.uk", "co.uk"), ("b.co.uk", "co.uk"), ("co.uk", "co.uk"), ("example.org", "org"),
    ]


def test_query_applies_rules(spark, folder):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    for r in QUERIES["op10_url_reputation"](spark, folder).collect():
        host, path, verdict, rule = by_hand(pages[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("allow" if r.bound >= 0.5 else "block"))


def test_shrinkage(spark):
    """Bad hosts fall below the bound, small ones stay near their domain, unlabelled ones have its prior."""
    rng = random.Random(4)
    rows = []
    for d in range(30):
        share = rng.choice([0.1, 0.9])
        for h in range(4):
            own = min(1, max(0, share + rng.uniform(-0.05, 0.05)))
            rows += [(f"h{h}.d{d}.com", int(rng.random() < own)) for _ in range(60)]
        rows += [(f"small.d{d}.com", int(share < 0.5)), (f"none.d{d}.com", None)]
    got = {r.host: r for r in U.host_reputation(spark.createDataFrame(rows, "host string, outcome int")).collect()}
    for d in range(30):
        bulk = [got[f"h{h}.d{d}.com"] for h in range(4)]
        good = sum(r.good for r in bulk) / sum(r.n for r in bulk) > 0.5
        for name in ("small", "none", "h0"):
            assert (got[f"{name}.d{d}.com"].share > 0.5) == good
    assert all(r.a > 0 and r.b > 0 for r in got.values())


@pytest.mark.parametrize("outcomes", [[], [("a.com", None)], [("", 1)], [("a.com", 1), ("b.com", 1)], [("a.com", 0)]])
def test_few_outcomes(spark, outcomes):
    rows = U.host_reputation(spark.createDataFrame(outcomes, "host string, outcome int")).collect()
    assert len(rows) == len({h for h, _ in outcomes}) and all(0 < r.share < 1 for r in rows)


def test_odd_pages(spark):
    pages = spark.createDataFrame([(1, None, None, "x"), (2, "http://a.org/", "<p>good text here</p>", "y"), (2, "http://a.org/", "<p>good text here</p>", "y")], "page_id bigint, url string, html string, host string")
    docs = spark.createDataFrame([(7, "good  text\nhere"), (8, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(7, 1, 0), (8, 0, None)], "doc_id bigint, quality int, toxic int")
    outcomes = U.page_outcomes(pages, docs, labels)
    assert sorted((r.host, r.outcome) for r in outcomes.collect() if r.outcome is not None) == [("a.org", 1), ("a.org", 1)]
    judged = U.judge_urls(pages, U.host_reputation(outcomes))
    assert judged.columns == [*pages.columns, "judged"] and judged.count() == 3
    assert U.page_outcomes(pages.limit(0), docs, labels).count() == 0
