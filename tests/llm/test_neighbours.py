import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import neighbours

DDL = "vec_id long, embedding array<float>, label int"


def brute(rows):
    vectors = []
    for _, v in rows:
        a = np.array([np.nan if x is None else x for x in v or ()], np.float32).astype(float)
        vectors.append(a / np.linalg.norm(a) if len(a) and np.isfinite(a).all() and a.any() else None)
    n = len(rows)
    close = np.zeros((n, n), bool)
    for i, a in enumerate(vectors):
        for j, b in enumerate(vectors):
            close[i, j] = i != j and a is not None and b is not None and len(a) == len(b) and a @ b >= 0.95
    part = list(range(n))
    for i, j in zip(*np.nonzero(close)):
        a, b = part[i], part[j]
        part = [b if p == a else p for p in part]
    out = []
    for i, (vec_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(n) if part[j] == part[i] and rows[j][0] is not None]
        least = (min(ids) if ids else None) if vectors[i] is not None else vec_id
        out.append((vec_id, int(close[i].sum()), least, vec_id == least))
    return sorted(out, key=str)


def run(spark, rows):
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], DDL)
    return sorted([(r.vec_id, r.n_links, r.component_id, r.kept) for r in neighbours.near_duplicates(frame).collect()], key=str)


def clusters(seed, sizes, spread=0.25):
    rng = np.random.default_rng(seed)
    out = []
    for size in sizes:
        center = rng.standard_normal(24)
        for _ in range(size):
            out.append((center + spread * rng.standard_normal(24)).astype(np.float32).tolist())
    order = rng.permutation(len(out))
    return [(int(i) + 1, out[i]) for i in order]


EDGES = [(901, None), (902, []), (903, [0.0] * 24), (904, [1.0] * 23 + [None]), (905, [float("nan")] * 24),
         (906, [float("inf")] + [1.0] * 23), (907, [1.0] * 24), (908, [2.0] * 24), (908, [1.0] * 24), (909, [1.0] * 23),
         (None, [1.0] * 24), (910, [1e-30] * 24), (911, [1e30] * 24)]


def test_equals_brute_force(spark):
    rows = clusters(1, [1] * 60 + [2] * 20 + [5, 9, 40, 90]) + EDGES
    assert run(spark, rows) == brute(rows)


def test_small_blocks_and_lists(spark, monkeypatch):
    for name, value in {"BLOCK": 16, "COUNT_BLOCK": 8, "LIST": 3, "MOST": 6}.items():
        monkeypatch.setattr(neighbours, name, value)
    rows = clusters(2, [1] * 20 + [2] * 10 + [30, 50], spread=0.2)
    assert run(spark, rows) == brute(rows)


def test_columns_of_any_name_may_be_there(spark):
    rows = clusters(3, [1] * 5 + [2] * 4 + [9]) + EDGES
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], DDL)
    for name in ("node", "vector", "weight", "component", "component_id", "n_links", "kept", "length", "block", "n", "root"):
        frame = frame.withColumn(name, F.lit("other"))
    out = neighbours.near_duplicates(frame)
    assert sorted([(r.vec_id, r.n_links, r.component_id, r.kept) for r in out.collect()], key=str) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_audit_sees_missing_links(spark):
    rows = clusters(3, [40])
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], DDL)
    nodes = frame.select("vec_id", "embedding").selectExpr("vec_id", "cast(embedding as array<double>) embedding")
    from pyspark.sql import functions as F
    from tickloom.llm import text
    nodes = nodes.mapInArrow(text.by_batch(neighbours._keyed), "vec_id long, node binary, vector binary").select(
        "node", "vector", F.lit(1).cast("long").alias("weight"))
    none = nodes.select("node", F.lit(0).cast("long").alias("n_links"))
    assert neighbours._audit(nodes, none, 0.95) == pytest.approx(0)


def test_finds_pairs_that_share_no_table(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "TABLES", 1)
    monkeypatch.setattr(neighbours, "BUCKET", 1)
    monkeypatch.setattr(neighbours, "SEARCH_BLOCK", 50, raising=False)
    rows = clusters(4, [2] * 150 + [3] * 10) + EDGES
    assert run(spark, rows) == brute(rows)


def test_audit_weighs_pairs_like_large_groups(spark):
    from pyspark.sql import functions as F
    rows = clusters(5, [60] + [2] * 20)
    group = {r[0] for r in brute(rows) if r[1] > 1}
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], DDL).selectExpr(
        "vec_id", "cast(embedding as array<double>) embedding")
    from tickloom.llm import text
    nodes = frame.mapInArrow(text.by_batch(neighbours._keyed), "vec_id long, node binary, vector binary").withColumn(
        "weight", F.lit(1).cast("long"))
    truth = spark.createDataFrame([(r[0], r[1] if r[0] in group else 0) for r in brute(rows)], "vec_id long, n_links long")
    found = nodes.join(truth, "vec_id").select("node", "n_links")
    linked = sum(r[1] > 0 for r in brute(rows))
    assert neighbours._audit(nodes.drop("vec_id"), found, 0.95) == pytest.approx(len(group) / linked)


def test_descent_that_fails_its_audit_is_finished(spark, monkeypatch):
    for name, value in {"TABLES": 1, "BUCKET": 1, "ROUNDS": 1}.items():
        monkeypatch.setattr(neighbours, name, value)
    rows = clusters(4, [2] * 100 + [40])
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], DDL)
    out = neighbours.near_duplicates(frame, sure=False).collect()
    assert sorted([(r.vec_id, r.n_links, r.component_id, r.kept) for r in out], key=str) == brute(rows)
    assert {r.audited_recall for r in out} == {1.0}


def test_dense_groups_that_touch_by_one_link(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "LIST", 2)
    monkeypatch.setattr(neighbours, "MOST", 3)
    rng = np.random.default_rng(6)
    at = [*[0.0] * 30, 4.0, 20.0, *[24.0] * 30]  # degrees along an arc: only 4 and 20 link across
    rows = []
    for i, degrees in enumerate(at):
        v = 0.002 * rng.standard_normal(24)
        v[0] += np.cos(np.radians(degrees))
        v[1] += np.sin(np.radians(degrees))
        rows.append((i + 1, v.astype(np.float32).tolist()))
    want = brute(rows)
    assert {r[2] for r in want} == {1}
    assert run(spark, rows) == want
