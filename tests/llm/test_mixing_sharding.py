import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tickloom.llm import mixing, sharding
from tickloom.session import stored


def corpus():
    rng = random.Random(4)
    rows = [(i, "w " * rng.randint(0, 30), "hot") for i in range(300)]
    rows += [(1000 + i, "w " * rng.randint(1, 30), f"s{i % 5}") for i in range(100)]
    return rows + [(2000, None, None), (2001, "a\tb\n c", None), (None, "x y z", "s0"), (2002, "", "empty"), (2003, "w " * 5000, "s1"),
                   (1, "w w w", "hot"), (1, "w w w", "hot")]


def shares(counts, exponent):
    total = sum(counts.values())
    power = {s: (c / total) ** exponent for s, c in counts.items() if c}
    norm = sum(power.values())
    return {s: p / norm for s, p in power.items()}


def counts_of(rows):
    out = Counter()
    for _, t, s in rows:
        out[s] += len((t or "").split())
    return out


def entropy(w):
    return -sum(p * math.log(p) for p in w.values())


def fitted(spark, rows, **more):
    counts = counts_of(rows)
    table = spark.createDataFrame(list(counts.items()), "source string, tokens long")
    return mixing.weights(table, **more), {s: c for s, c in counts.items() if c}


def test_exponent_meets_the_entropy(spark):
    rows = corpus()
    (exponent, budget), counts = fitted(spark, rows, entropy=0.8, most_passes=1e9)
    assert entropy(shares(counts, exponent)) == pytest.approx(0.8 * math.log(len(counts)), abs=1e-6)
    w = shares(counts, exponent)
    assert budget == pytest.approx(max(counts[s] / w[s] for s in w), rel=1e-9)
    (exponent, _), _ = fitted(spark, rows, entropy=0.01)
    assert exponent == 1


def test_repetition_limit_wins(spark):
    (exponent, budget), counts = fitted(spark, corpus(), entropy=1.0, most_passes=2.0)
    w = shares(counts, exponent)
    assert max(budget * w[s] / counts[s] for s in w) == pytest.approx(2, abs=1e-6)


@pytest.mark.parametrize("limit", [100_000, 0])
def test_rows_meet_quotas(spark, make, monkeypatch, limit):
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", limit)
    rows = corpus()
    out = mixing.mix(make(rows, clash=True), entropy=0.95, most_passes=40.0).select(
        "doc_id", "source", "mix_tokens", "mix_pass", "mix_slot").collect()
    (exponent, budget), counts = fitted(spark, rows, entropy=0.95, most_passes=40.0)
    w, got, seen = shares(counts, exponent), Counter(), Counter()
    for r in out:
        got[r.source] += r.mix_tokens
        seen[r.doc_id] += 1
        assert 0 <= r.mix_slot <= 1
    assert set(seen) == {i for i, _, _ in rows}  # nothing is lost
    largest = defaultdict(int)
    for _, t, s in rows:
        largest[s] = max(largest[s], len((t or "").split()))
    for s, share in w.items():
        assert -1 <= got[s] - budget * share <= largest[s]
    assert sum(r.source == "empty" for r in out) == 1


def test_budget_below_a_pass(spark, make):
    rows = [(i, "w " * 10, "a" if i % 4 else "b") for i in range(400)]
    out = mixing.mix(make(rows), entropy=0.0, most_passes=4.0, budget=1000).collect()
    got = Counter(r.source for r in out)
    assert got["a"] == pytest.approx(75, abs=1) and got["b"] == pytest.approx(25, abs=1)
    assert max(Counter(r.doc_id for r in out).values()) == 1


def test_equal_rows_do_not_cross_the_end_together(make):
    rows = [(7, "w " * 10, "same")] * 1000 + [(i, "w " * 10, "own") for i in range(1000)]
    got = Counter(r.source for r in mixing.mix(make(rows, clash=True), budget=10_000).collect())
    assert got == {"same": 500, "own": 500}
    rows = [(7, "w " * 10, "same")] * 1000 + [(8, "w " * 10, "same")] + [(i, "w " * 10, None) for i in range(1001)]
    got = Counter(r.source for r in mixing.mix(make(rows), entropy=0.0, most_passes=9.0, budget=50_050).collect())
    assert got["same"] == pytest.approx(2503, abs=1) and got[None] == pytest.approx(2503, abs=1)


def test_rows_of_one_id_and_text_that_differ_otherwise(spark, make):
    docs = make([(7, "a b c", "s")] * 60 + [(8, "a b c", "s")]).withColumn("lang", F.when(F.rand(1) < 0.5, "x").otherwise("y"))
    docs = stored(docs, "test")
    assert docs.filter("lang = 'x'").count() > 9
    out = mixing.mix(docs, budget=90)
    assert out.count() == 30 and sorted(out.columns) == sorted([*docs.columns, "mix_tokens", "mix_pass", "mix_slot"])
    have, took = ({tuple(r): r["count"] for r in d.groupBy(*docs.columns).count().collect()} for d in (docs, out.select(*docs.columns)))
    assert {k[:-1] for k in took} <= {k[:-1] for k in have}


@pytest.mark.parametrize("budget", [37, 400, 1234, 5000])
def test_exact_rows_equal_brute_force(spark, make, budget):
    """The rows of every pass in the order of their hash, until the quota is reached."""
    rows = corpus()[:150] + [(3, "x y z", "a")] * 9 + [(4, "", "a"), (4, None, "b")]
    docs = make(rows)
    out = Counter((r.source, r.doc_id, r.mix_pass, r.mix_tokens) for r in mixing.mix(docs, budget=budget).collect())
    exponent = fitted(spark, rows, budget=budget)[0][0]
    sources = spark.createDataFrame(list(counts_of(rows).items()), "source string, tokens long")
    want = Counter()
    for q in mixing.quotas(sources, exponent, float(budget)).collect():
        own = docs.filter(F.col("source").eqNullSafe(q.source)).select(
            "doc_id", mixing.tokens(F.col("text")).alias("n"), F.xxhash64("doc_id", "text").alias("identity"), F.lit(q.passes).cast("long").alias("turn"))
        own = own.select("doc_id", "n", mixing.place(F.col("turn"), "identity").alias("place"))
        lack = q.rest
        for r in sorted(own.collect(), key=lambda r: r.place):
            for turn in range(q.passes):
                want[q.source, r.doc_id, turn, r.n] += 1
            if lack > 0:
                want[q.source, r.doc_id, q.passes, r.n] += 1
                lack -= r.n
    assert out == want


def test_empty_tables(make):
    assert mixing.mix(make([])).collect() == []
    assert len(mixing.mix(make([(1, None, "a"), (2, "", "b")])).collect()) == 2
    assert sharding.place(make([]), ["a", "b"]).collect() == []


def test_table_is_filled_by_turns():
    names = [f"n{i}" for i in range(7)]
    size = sharding.table_size(7)
    assert all(size % k for k in range(2, size)) and size >= 700
    table = sharding.fill(names, size)
    counts = Counter(table)
    assert set(table) == set(range(7)) and max(counts.values()) - min(counts.values()) <= 1
    fewer = sharding.fill(names[:-1], size)
    moved = sum(a != b for a, b in zip(table, fewer) if a != 6)
    assert moved < 0.25 * size
    with pytest.raises(ValueError):
        sharding.fill(["a", "a"], 7)
    with pytest.raises(ValueError):
        sharding.table_size(20_000)


def test_place_follows_the_table(spark, make):
    import hashlib
    names = ["a", "b", "c"]
    size = sharding.table_size(3)
    table = sharding.fill(names, size)
    docs = make(corpus(), clash=True)
    out = sharding.place(docs, names)
    assert out.columns == [c for c in docs.columns if c not in ("slot", "shard")] + ["slot", "shard"]
    for r in out.collect():
        slot = int(hashlib.md5(str("null" if r.doc_id is None else r.doc_id).encode()).hexdigest()[:15], 16) % size
        assert (r.slot, r.shard) == (slot, names[table[slot]])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_tokens(spark):
    frame = spark.createDataFrame([(None,), ("",), (" \t\r\n\x0b\x0c",), ("a",), (" a b  c\x1c ",)], "text string")
    assert [r[0] for r in frame.select(mixing.tokens(F.col("text"))).collect()] == [0, 0, 0, 1, 2]
