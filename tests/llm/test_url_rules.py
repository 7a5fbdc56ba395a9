"""Hosts, paths and rules of operator 9 against a plain reading of the contract."""

import random

from pyspark.sql import functions as F

from varzea.llm import url_filter


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3:]
    stop = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
    after = rest[stop:]
    end = min((after.index(c) for c in "?#" if c in after), default=len(after))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:stop]), after[:end]


def rule(host, path):
    fits = [r for r in url_filter.RULES
            if path.startswith(r.path) and (host == r.host or host[-len(r.host) - 1:] == "." + r.host)]
    best = max(fits, key=lambda r: len(r.host + r.path), default=None)
    return (best.host + best.path, best.verdict) if best else (None, None)


def random_urls(n):
    rng = random.Random(9)
    pick = lambda some: "".join(rng.choice(some) for _ in range(rng.randrange(4)))
    hosts = ["org", "example.org", "EXAMPLE.org", "com", "b.com", "xcom", ".com", "com.", "org.com", "É.org", "", "u@org", "org:80"]
    paths = ["", "/", "/es/", "/es", "/en/1", "/en/12", "/en/", "/fr/", "/FR/", "/de/", "/de/x", "//org/", "\n/de/", "/a://com/de/"]
    out = []
    for _ in range(n):
        url = (rng.choice(["https", "", "x", "a/b?c#"]) + rng.choice(["://", "://", "://", ":/", ""]) + pick(["a.", "-", "b.c.", "É"])
               + rng.choice(hosts) + rng.choice(paths) + pick(["?", "#", "/", "a", "1", "&b=", "\r\n", "://"]))
        out.append(url)
    return out


def test_hosts_paths_and_rules_against_brute_force(spark):
    urls = sorted(set(random_urls(6000))) + [None, ""]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    url = F.coalesce("url", F.lit(""))
    found = pages.select("url", url_filter.host_of(url).alias("host"), url_filter.path_of(url).alias("path"))
    got = found.withColumn("rule", url_filter.rule_of(F.col("host"), F.col("path"), url_filter.RULES)).collect()
    assert len(got) == len(urls)
    for r in got:
        host, path = parts(r["url"])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule(host, path)[0]), r["url"]
    assert {r["rule"] for r in got} == {None, *(x.name for x in url_filter.RULES)}


def test_long_urls_and_repeated_page_ids(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "TREES", 1)
    long = "https://b.com/de/" + "x1-" * 300_000
    urls = [long, long.replace("b.com", "b.net"), "https://b.com/fr/1", "https://b.com/fr/1", None]
    pages = spark.createDataFrame([(7, u) for u in urls], "page_id long, url string")
    got = url_filter.judge(pages).collect()
    assert [r["page_id"] for r in got] == [7] * len(urls)
    want = sorted((*parts(u), rule(*parts(u))[0] or "") for u in urls)
    assert sorted((r["host"], r["path"], r["rule"] or "") for r in got) == want
    assert all(r["verdict"] == rule(r["host"], r["path"])[1] for r in got if r["rule"])
    assert {r["verdict"] for r in got} <= {"allow", "block"}
