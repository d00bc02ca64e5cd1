import random

import pytest

from tickloom.llm import urls
from tickloom.llm.bloom import MOST_BITS, Filter, hashed
from pyspark.sql import functions as F

RULES = "host string, path string, verdict string"
PAGES = "page_id long, url string, html string, host int, rule int, keys int"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    path = rest[end:]
    stop = min([path.find(c) for c in "?#" if c in path], default=len(path))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end]), path[:stop]


def brute(url, rules, otherwise="allow"):
    host, path = parts(url)
    fit = []
    for h, p, v in rules:
        if None in (h, p, v) or v not in ("block", "allow"):
            continue
        h = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in h)
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            fit.append((len(h + p), len(h), h + p, v))
    if not fit:
        return host, path, None, otherwise
    return host, path, max(fit)[2], max(fit)[3]


def judged(spark, found, rules, **more):
    pages = spark.createDataFrame([(i, u, "<p>", 1, 2, 3) for i, u in found], PAGES)
    return urls.judge(pages, spark.createDataFrame(rules, RULES), **more)


def check(spark, found, rules, **more):
    got = judged(spark, found, rules, **more)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    want = [(i, *brute(u, rules, **more)) for i, u in found]
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


EDGES = [
    None, "", "no scheme", "http://", "http://net", "http://net/", "http://NET/", "http://a.net?x=/", "http://a.net#/", "x://b.a.net/en",
    "http://example.net/en", "http://example.net/en/", "http://www.Example.net/en/x?y#z", "http://notexample.net/en/", "http://example.net/EN/",
    "http://net.org/fr/", "http://u:p@a.net:80/", "http://a.net:80/", "a://b://c.net/x", "http://a.net/\nx", "http://é.net/", "http://.net/",
    "http://a..net/", "http://net./", "http://" + "a." * 5000 + "net/" + "x" * 100_000,
]


def test_edge_cases_ties_and_repeated_rows(spark):
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("NET", "/", "block"), ("org", "/fr/", "allow"), ("net", "", "allow"),
             ("b.a.net", "/", "block"), ("a.net", "/en", "allow"), (None, "/", "block"), ("com", None, "block"), ("com", "/", "perhaps"),
             ("com", "x", "block"), ("a/b", "/", "block"), ("", "", "block"), ("é.net", "/", "allow")]
    found = [(i, u) for i, u in enumerate(EDGES)]
    check(spark, [*found, (None, "http://a.net/"), (3, "http://a.net/"), (3, "http://a.net/")], rules)


def test_a_rule_both_blocked_and_allowed_is_blocked(spark):
    rules = [("net", "/", "allow"), ("net", "/", "block"), ("org", "/", "block"), ("org", "/", "allow")]
    got = judged(spark, [(1, "http://net/"), (2, "http://a.org/")], rules)
    assert {r.verdict for r in got.collect()} == {"block"}


def test_without_rules_or_pages(spark):
    check(spark, [(1, "http://a.net/"), (2, None)], [], otherwise="block")
    check(spark, [], [("net", "/", "block")])
    check(spark, [(1, None)], [("net", "/", "block")])


@pytest.mark.parametrize("seed", [1, 2])
def test_many_rules_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    name = lambda n: ".".join(rng.choice("abc") for _ in range(rng.randint(1, n)))
    path = lambda: rng.choice(["", "/", "/" + "/".join(rng.choice("xy") for _ in range(rng.randint(1, 3)))])
    rules = [(name(3), path(), rng.choice(["block", "allow"])) for _ in range(150)]
    rules = list({(h, p): (h, p, v) for h, p, v in rules}.values())
    check(spark, [(i, f"http://{name(5)}{path()}{rng.choice(['', '?q', '#f'])}") for i in range(1500)], rules)


def test_a_cascade_is_exact_where_every_filter_errs(spark):
    """A tiny share of a large universe, so that level 0 lets many keys through, and levels alternate."""
    keys = spark.range(60_000).select(F.concat(F.lit("k"), "id").alias("key"), "id")
    universe = keys.select("key", *hashed(F.col("key")))
    listed = keys.filter("id % 3 = 0 OR id > 59000").select("key", *hashed(F.col("key")))
    cascade = urls.Cascade.over(listed, universe)
    assert len(cascade.levels) > 3
    rows = keys.select("id", *hashed(F.col("key"))).toPandas()
    assert (cascade.has(rows.a.to_numpy(), rows.b.to_numpy()) == ((rows.id % 3 == 0) | (rows.id > 59000)).to_numpy()).all()


def test_filters_are_bounded():
    with pytest.raises(ValueError, match="over the bound"):
        Filter(MOST_BITS + 1, 1, 0)
