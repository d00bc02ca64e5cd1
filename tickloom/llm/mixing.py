"""Mixing sources to target weights by temperature.

A source's weight is its token share to the power of an exponent, normalised. The exponent is
bisected: the entropy of the weights falls as it grows, and so does the largest number of times a
source must be repeated. The result meets the target entropy if the repetition limit allows it, and
otherwise comes as near as the limit allows. Every four bisection steps are one small aggregation over
the stored table of sources.

The weights become rows by budgeted block permutations: a source with a quota of q tokens and T
tokens gives floor(q / T) whole passes and then the start of one more, each pass in an order of its
own (a keyed hash). Where the last pass ends is found by descending through blocks of hash values,
4,096 at a time, with one aggregation per level, so no source is ever sorted or gathered. `slot`
spreads every source evenly over the mix: any stretch of slots holds the weights.

`budget` is the number of tokens of the mix. By default it is the least with which no source gives
less than one whole pass, so nothing is lost. Tokens are runs of characters other than x20 and
x09-x0D. A null source is a source of its own. A source without tokens has weight zero, cannot be
measured against a budget and gives one pass. Repeated rows and ids are rows of their own: rows of
one id and text share their place in a pass, and where a pass ends at such a place, as many of them
are taken as reach the quota. So a source's part of the mix is over its quota by less than one row.
Columns pass through, but those that mixing adds replace any of their name.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators.repeat import repeat_rows
from tickloom.session import stored

ENTROPY = 0.9
MOST_PASSES = 4.0
STEPS = 40
LEVEL_BITS, LEVELS = 12, 5  # 60 bits of hash
BROADCAST_ROWS = 100_000
SALTS = 64


def tokens(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def weights(sources: DataFrame, entropy: float = ENTROPY, most_passes: float = MOST_PASSES,
            budget: int | None = None) -> tuple[float, float]:
    """The exponent and the budget for `sources(source, tokens)`.

    `entropy` is the target as a part of the greatest possible, the logarithm of the number of
    sources. Each step asks for the entropy and the repetitions at one exponent.
    """
    known = sources.filter("tokens > 0")
    total, count = known.agg(F.sum("tokens"), F.count("*")).first()
    if not count:
        return 1.0, 0.0
    share = F.col("tokens") / F.lit(float(total))

    def at(exponents: list[float]) -> list[tuple[float, float, float]]:
        """For each exponent the entropy, the most passes of a source, and the budget."""
        sums = []
        for e in exponents:
            power = F.exp(F.log(share) * e)
            sums += [F.sum(power), F.sum(power * F.log(share) * e), F.max(power / F.col("tokens")), F.max(F.col("tokens") / power)]
        row, out = known.agg(*sums).first(), []
        for norm, weighted, largest, dearest in zip(*[iter(row)] * 4, strict=True):
            need = float(budget) if budget is not None else dearest * norm
            out.append((math.log(norm) - weighted / norm, need * largest / norm, need))
        return out

    def bisect(low: float, high: float, below) -> tuple[float, float]:
        """Narrow to where `below` turns false, four halvings with each aggregation."""
        for _ in range(STEPS // 4):
            points = [low + (high - low) * k / 16 for k in range(1, 16)]
            held = sum(1 for _ in itertools.takewhile(below, at(points)))
            points = [low, *points, high]
            low, high = points[held], points[held + 1]
        return low, high

    goal = entropy * math.log(count)
    even, asis = at([0.0, 1.0])
    if asis[0] >= goal:
        exponent, now = 1.0, asis
    elif even[0] < goal:
        exponent, now = 0.0, even
    else:
        exponent = bisect(0.0, 1.0, lambda x: x[0] >= goal)[0]
        now, = at([exponent])
    if now[1] > most_passes:  # repeats grow as the exponent falls, so stop earlier
        exponent = bisect(exponent, 1.0, lambda x: x[1] > most_passes)[1]
        now, = at([exponent])
    return exponent, now[2]


def quotas(sources: DataFrame, exponent: float, budget: float) -> DataFrame:
    """source, tokens, weight, passes (whole ones), rest (tokens of the last), span (all, in passes)."""
    share = F.col("tokens") / (sources.agg(F.sum("tokens")).first()[0] or 1)
    power = F.when(F.col("tokens") > 0, F.exp(F.log(share) * exponent)).otherwise(0.0)
    norm = sources.agg(F.sum(power)).first()[0] or 1.0
    out = sources.withColumn("weight", power / norm)
    # A quota that is whole but for rounding is whole.
    quota = F.col("weight") * F.lit(budget) / F.when(F.col("tokens") > 0, F.col("tokens"))
    near = F.abs(quota - F.round(quota)) < 1e-9
    span = F.when(F.col("tokens") > 0, F.when(near, F.round(quota)).otherwise(quota)).otherwise(1.0)
    out = out.withColumn("span", span).withColumn("passes", F.floor("span").cast("long"))
    return out.withColumn("rest", F.floor((F.col("span") - F.col("passes")) * F.col("tokens")).cast("long"))


def place(passes: Column, *identity: str) -> Column:
    """60 bits that order the rows of a pass."""
    return F.shiftrightunsigned(F.xxhash64(passes, *identity), 4)


def ends(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """source, end, more: the place at which a source's rows reach `rest` tokens, and how many the rows before it lack.

    `rows(source, place, n)`: one level narrows the place by LEVEL_BITS bits. Sums combine before
    each shuffle, and a window sees at most 4,096 sums of a source.
    """
    open_ = targets.filter("rest > 0").select("source", "rest", F.lit(0).cast("long").alias("start"))
    open_ = stored(open_, "mixing-ends")
    for level in range(LEVELS):
        shift = 60 - LEVEL_BITS * (level + 1)
        inside = by_source(rows, open_).filter(
            F.shiftright(F.col("place"), shift + LEVEL_BITS) == F.shiftright(F.col("start"), shift + LEVEL_BITS))
        block = F.shiftleft(F.shiftright(F.col("place"), shift), shift)
        sums = inside.groupBy("source", block.alias("block")).agg(
            F.sum("n").alias("n"), F.first("rest").alias("rest"))
        order = Window.partitionBy("source").orderBy("block")
        sums = sums.withColumn("before", F.sum("n").over(order) - F.col("n"))
        hit = sums.filter("before < rest").groupBy("source").agg(
            F.max_by(F.struct(F.col("block").alias("start"), (F.col("rest") - F.col("before")).alias("rest")), "block").alias("x"))
        open_ = stored(hit.select("source", "x.rest", "x.start"), "mixing-ends")
    return open_.select("source", F.col("start").alias("end"), F.col("rest").alias("more"))


def _tied(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Of the rows that share the place where a source's last pass ends, as many as reach its quota.

    `rows` hold whole rows as `d`. Equal ones are counted, not gathered, and written again as often as they are taken;
    those that differ in other columns are taken in the order of a hash of all of them.
    """
    alike = by_source(rows, plan).filter("place = end").groupBy(
        "source", "mix_pass", "place", "end", "more", "passes", "span", "n", F.sha2(F.to_json("d"), 256).alias("whole"),
    ).agg(F.first("d").alias("d"), F.count("*").alias("m"))
    before = Window.partitionBy("source").orderBy("whole").rowsBetween(Window.unboundedPreceding, -1)
    alike = alike.withColumn("lack", F.col("more") - F.coalesce(F.sum(F.col("m") * F.col("n")).over(before), F.lit(0)))
    take = F.when(F.col("lack") > 0, F.least("m", F.ceil(F.col("lack") / F.greatest("n", F.lit(1))))).otherwise(0)
    return repeat_rows(stored(alike.withColumn("take", take.cast("long")).drop("whole", "m", "lack"), "mixing-ties"), "take").drop("take")


def by_source(rows: DataFrame, small: DataFrame) -> DataFrame:
    """Rows with the columns of their source: broadcast where few sources are, else salted."""
    small = small.withColumnRenamed("source", "its_source")
    same = F.col("source").eqNullSafe(F.col("its_source"))
    if small.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(small), same).drop("its_source")
    salted = small.withColumn("its_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = rows.withColumn("salt", F.pmod(F.col("place"), F.lit(SALTS)).cast("int"))
    return rows.join(salted, same & (F.col("salt") == F.col("its_salt"))).drop("its_source", "its_salt", "salt")


def _with(one: DataFrame, other: DataFrame) -> DataFrame:
    """Tables of sources joined to the left; a null source is one too."""
    other = other.withColumnRenamed("source", "its_source")
    return one.join(other, F.col("source").eqNullSafe(F.col("its_source")), "left").drop("its_source")


def mix(docs: DataFrame, entropy: float = ENTROPY, most_passes: float = MOST_PASSES,
        budget: int | None = None) -> DataFrame:
    """The rows of `docs` as often as the mix takes them, with mix_tokens, mix_pass and mix_slot."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d"))
    rows = packed.select(
        "d", F.col("d.source").cast("string").alias("source"), F.xxhash64("d.doc_id", "d.text").alias("identity"),
        tokens(F.col("d.text")).alias("n"))
    slim = stored(rows.select("source", "identity", "n"), "mixing-rows")
    sources = stored(slim.groupBy("source").agg(F.sum("n").alias("tokens")), "mixing-sources")
    exponent, budget = weights(sources, entropy, most_passes, budget)
    wanted = stored(quotas(sources, exponent, budget), "mixing-quotas")
    last = by_source(slim.withColumn("place", F.col("identity")), wanted.select("source", F.col("passes").alias("turn")))
    last = last.withColumn("place", place(F.col("turn"), "identity")).drop("turn")
    cut = stored(ends(last, wanted), "mixing-cut")
    # Where one row reaches the quota it is taken; rows that do so together are looked at below.
    there = by_source(last, cut).filter("place = end").groupBy("source").agg(F.count("*").alias("rows"))
    cut = _with(cut, there).select("source", F.when(F.col("rows") == 1, F.col("end") + 1).otherwise(F.col("end")).alias("end"),
                                   F.when(F.col("rows") > 1, F.col("more")).alias("more"))
    plan = _with(wanted, cut).select("source", "span", "passes", F.coalesce("end", F.lit(0)).alias("end"), "more")
    plan = stored(plan, "mixing-plan")
    rows = rows.withColumn("place", F.col("identity"))
    ties = plan.filter("more > 0")
    tied = None if ties.isEmpty() else _tied(
        by_source(rows, ties.select("source", F.col("passes").alias("mix_pass"))).withColumn("place", place(F.col("mix_pass"), "identity")), ties)
    rows = by_source(rows, plan)
    turns = F.explode(F.sequence(F.lit(0).cast("long"), F.col("passes")))
    rows = rows.withColumn("mix_pass", turns).withColumn("place", place(F.col("mix_pass"), "identity"))
    rows = rows.filter((F.col("mix_pass") < F.col("passes")) | (F.col("place") < F.col("end")))
    if tied is not None:
        rows = rows.drop("identity").unionByName(tied)
    # A whole pass spreads over its part of the mix; the last one fills what is left of it.
    within = F.col("place") / F.lit(float(1 << 60))
    part = F.when(F.col("mix_pass") < F.col("passes"), within).otherwise(
        F.col("place") / F.greatest(F.col("end"), F.lit(1)) * (F.col("span") - F.col("passes")))
    slot = (F.col("mix_pass") + part) / F.col("span")
    others = [F.col(f"d.`{c}`") for c in docs.columns if c not in ("mix_tokens", "mix_pass", "mix_slot")]
    return rows.select(*others, F.col("n").alias("mix_tokens"), "mix_pass", slot.alias("mix_slot"))
