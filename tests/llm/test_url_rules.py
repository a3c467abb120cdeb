"""Url filters against a plain test of every rule."""

import random

import pytest

from driftwise.llm import url_rules


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([i for c in "/?#" if (i := rest.find(c)) >= 0], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    tail = rest[end:]
    return host, tail[: min([i for c in "?#" if (i := tail.find(c)) >= 0], default=len(tail))]


def brute(urls, rules, default="allow"):
    out = []
    for page, url in urls:
        host, path = split(url)
        fits = [
            (len(h) + len(p), len(h), v, h + p)
            for h, p, v in rules
            if None not in (h, p, v) and (h in ("", host) or host.endswith("." + h)) and path.startswith(p)
        ]
        rule, verdict = (max(fits)[3], max(fits)[2]) if fits else (None, default)
        out.append((page, host, path, rule, verdict))
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((v is None, v) for v in r))


def found(spark, urls, rules, **options):
    pages = spark.createDataFrame(urls, "page_id long, url string")
    return in_order(
        tuple(r) for r in url_rules.judged(pages, spark.createDataFrame(rules, "host string, path string, verdict string"), **options).collect()
    )


ODD = [
    None, "", "no scheme", "http://", "http:///x", "HTTP://Example.NET/en/a?b", "http://net", "http://net?/", "http://net#/",
    "a://b://c/d", "http://.net/", "http://x..net/", "http://example.net./en/", "http://ÉX.net/Ä", "x\n\n://y.org/fr/\n1", "http://e.net:80/en/",
    "http://u@e.net/", "http://net.example/", "http://exanet/", "://org/fr/", "http://org/fr", "http://a.org/fr//", "http://" + "a." * 3000 + "net/",
    "http://a.org/" + "p/" * 50_000,
]
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def test_odd_urls(spark):
    urls = list(enumerate(ODD))
    assert found(spark, urls, RULES) == in_order(brute(urls, RULES))


@pytest.mark.parametrize("partitions", [1, 8, 40])
def test_nested_rules_over_many_ranges(spark, partitions):
    rng = random.Random(partitions)
    labels, parts = ["a", "b", "ab", "a-b", "B"], ["", "x", "xy", "y", "é"]

    def host(n):
        return ".".join(rng.choice(labels) for _ in range(n))

    def path(n):
        return "".join("/" + rng.choice(parts) for _ in range(n))

    urls = [(i, f"http://{host(rng.randint(1, 5))}{path(rng.randint(0, 4))}") for i in range(1500)]
    urls += [(5000 + i, "http://a.b.a/x/y") for i in range(700)] + [(9, "http://a.b/x")] * 300 + [(None, "http://b/")] * 3
    rules = [(host(rng.randint(1, 4)).lower(), path(rng.randint(0, 3)), rng.choice(["allow", "block"])) for _ in range(150)]
    rules += [("", "/y", "block"), (None, "/", "block"), ("a", None, "block"), ("a", "/", None)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert found(spark, urls, rules) == in_order(brute(urls, rules))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_one_url_is_cut_into_several_ranges(spark):
    pages = spark.createDataFrame([(7, "http://hot.net/x")] * 4000, "page_id long, url string")
    cuts = url_rules._cuts(url_rules._keyed(pages, "page_id", "url"))
    assert len(cuts) >= 7 and len({c[:2] for c in cuts}) == 1


def test_empty_tables_and_other_columns(spark):
    assert found(spark, [], RULES) == []
    assert found(spark, [(1, "http://net/")], [], default="block") == [(1, "net", "/", None, "block")]
    pages = spark.createDataFrame([("p", "http://net/", 1, 2, 3)], "`page.id` string, url string, host int, key int, range int")
    rules = spark.createDataFrame([(1, "net", "/", "block")], "id int, host string, path string, verdict string")
    rows = url_rules.judged(pages.withColumnRenamed("page.id", "name"), rules, key="name").collect()
    assert [tuple(r) for r in rows] == [("p", "net", "/", "net/", "block")]
