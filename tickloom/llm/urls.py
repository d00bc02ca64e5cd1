"""URL rules by Bloom filter cascades: exact membership of every URL's keys without a join.

A rule (host, path, verdict) fits a URL whose host is the rule's or a subdomain of it and whose path starts with the rule's.
The longest fitting rule wins, by the characters of host and path together, then by those of the host; a rule both
blocked and allowed is blocked. So a URL has one key, `host suffix || path prefix`, for each *shape* (labels of the host,
characters of the path) that some rule has, and its rule is its longest key that is listed.

Level 0 of a cascade encodes the listed keys. Level 1 encodes those keys of the corpus that level 0 lets through wrongly,
level 2 the listed keys that level 1 holds too, and so on, until a level lets nothing through wrongly. Over all
keys of the corpus and the list a cascade is therefore exact. Level 0 gets the rate at which its false positives are about as
many as the list, so every level but the first is of the list's size whatever the corpus' size, and only the different keys
of the corpus are read, once for each list.

Defined cases: a null URL or one without `://` has an empty host and path. Hosts are lower-cased (A-Z) in URLs and rules;
port and user belong to the host. An empty path fits only rules with an empty path. Rules with a null, with another verdict
than block or allow, or that no URL can fit (a path that starts otherwise than with `/`, a host with `/`, `?` or `#`) are
left out. Every row of pages is judged, repeated ids too; other columns of pages and rules are not read. Without rules, or
without pages, verdicts are `otherwise`, or none. Texts of any length are taken whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.bloom import Filter, hashed
from tickloom.session import stored

BLOCK, ALLOW = "block", "allow"
#: The list, not the corpus, sets the size of the filters; more rules raise an error.
MOST_RULES = 1 << 24
MOST_LEVELS = 64
LABELS = "length(host) - length(replace(host, '.', '')) + 1"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


class Cascade:
    """Levels of filters; `has` is exact for the listed keys and those of the universe it was built over."""

    def __init__(self, levels: list[Filter]):
        self.levels = levels

    @classmethod
    def over(cls, listed: DataFrame, universe: DataFrame) -> Cascade:
        """From tables of different keys `key`, `a`, `b`. Keys of the universe that are listed count as listed."""
        listed = stored(listed, "cascade-listed")
        count = listed.count()
        if not count:
            return cls([])
        others = max(1, universe.count() - count)
        levels = [Filter.for_rate(count, min(0.5, count * 0.5 ** 0.5 / others)).filled(listed)]
        through = universe.filter(_among(levels)("a", "b")).join(listed, "key", "left_anti")
        sides = [listed, stored(through, "cascade-through")]
        while count := (alive := sides[len(levels) % 2].filter(_among(levels[1 - len(levels) % 2::2])("a", "b"))).count():
            if len(levels) == MOST_LEVELS:
                raise ValueError("two keys cannot be told apart by 128 bits")
            levels.append(Filter.for_rate(count, 0.5, salt=len(levels)).filled(alive))
        return cls(levels)

    def has(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        left, found = np.arange(len(a)), np.zeros(len(a), bool)
        for depth, level in enumerate(self.levels):
            left = left[level.has(a[left], b[left])]
            found[left] = depth % 2 == 0  # what ends at a level belongs to the side that the level before encodes
        return found


def judge(pages: DataFrame, rules: DataFrame, otherwise: str = ALLOW) -> DataFrame:
    """page_id, host, path, rule, verdict for each row of `pages(page_id, url)`; see the module."""
    host, path = parts(F.col("url").cast("string"))
    pages = pages.select(F.col("page_id"), host.alias("host"), path.alias("path"))
    rules = stored(_rules(rules), "url-rules")
    count, shapes = rules.count(), rules.select("labels", "chars").distinct().collect()
    if count > MOST_RULES:
        raise ValueError(f"{count} rules; the filters are bounded for {MOST_RULES}")
    if not count:
        return pages.select("*", F.lit(None).cast("string").alias("rule"), F.lit(otherwise).alias("verdict"))

    pages = pages.withColumn("keys", _keys(shapes))
    universe = stored(pages.select(F.explode("keys.key").alias("key")).distinct().select("key", *hashed(F.col("key"))), "url-keys")
    listed = rules.select("key", *hashed(F.col("key")), "blocked")
    blocked, allowed = [Cascade.over(listed.filter(F.col("blocked") == b).drop("blocked"), universe) for b in (True, False)]

    @F.arrow_udf("array<string>")
    def verdicts(first: pa.Array, second: pa.Array) -> pa.Array:
        a, b = first.flatten().to_numpy(), second.flatten().to_numpy()
        said = np.where(blocked.has(a, b), BLOCK, np.where(allowed.has(a, b), ALLOW, ""))
        ends = first.offsets.to_numpy()
        return pa.ListArray.from_arrays(pa.array(ends - ends[0]), pa.array(said.tolist(), pa.string()))

    one, two = F.transform("keys", lambda k: hashed(k["key"])[0]), F.transform("keys", lambda k: hashed(k["key"])[1])
    said = F.zip_with("keys", verdicts(one, two), lambda k, v: F.struct(k["key"].alias("rule"), v.alias("verdict")))
    won = F.get(F.filter(said, lambda x: x["verdict"] != ""), F.lit(0))
    return pages.withColumn("won", won).select(
        "page_id", "host", "path", "won.rule", F.coalesce("won.verdict", F.lit(otherwise)).alias("verdict"))


def _among(levels: list[Filter]):
    """Whether all of the filters hold a key."""
    @F.arrow_udf("boolean")
    def among(a: pa.Array, b: pa.Array) -> pa.Array:
        a, b = a.to_numpy(), b.to_numpy()
        return pa.array(np.logical_and.reduce([level.has(a, b) for level in levels]))
    return among


def _rules(rules: DataFrame) -> DataFrame:
    """The different rules that some URL can fit: key, labels, chars, blocked."""
    host, path = F.translate(F.col("host").cast("string"), _UPPER, _LOWER), F.col("path").cast("string")
    rules = rules.select(host.alias("host"), path.alias("path"), F.col("verdict").cast("string").alias("verdict"))
    fit = F.col("verdict").isin(BLOCK, ALLOW) & F.col("path").rlike("^(/|$)") & ~F.col("host").rlike("[/?#]")
    return rules.filter(fit).groupBy(
        F.concat("host", "path").alias("key"), F.expr(LABELS).alias("labels"), F.length("path").alias("chars"),
    ).agg(F.max(F.col("verdict") == BLOCK).alias("blocked"))


def _keys(shapes: list) -> Column:
    """The keys of a URL, the longest first."""
    known = ", ".join(f"struct({s.labels} AS labels, {s.chars} AS chars)" for s in shapes)
    found = f"""transform(filter(array({known}), s -> s.labels <= {LABELS} AND s.chars <= length(path)),
        s -> struct(substring_index(host, '.', -s.labels) AS host, substring(path, 1, s.chars) AS path))"""
    ranked = f"transform({found}, k -> struct(length(k.host) + length(k.path) AS chars, length(k.host) AS most, k.host || k.path AS key))"
    return F.expr(f"sort_array({ranked}, false)")
