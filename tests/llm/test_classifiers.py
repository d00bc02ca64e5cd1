import random
import zlib

import numpy as np
import pytest

from tickloom.llm import cotraining, toxicity

EDGES = [(9000, None), (9001, ""), (None, "nice"), (9002, "word " * 30_000), (9003, "fine"), (9003, "fine")]


def toxic_corpus(n=600):
    rng = random.Random(1)
    plain = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randint(5, 60))]
        bad = i % 5 == 0
        if bad:
            words[rng.randrange(len(words))] = "nasty" + rng.choice(["a", "en", "ig"])
        if rng.random() < 0.3:  # one group is mentioned in toxic texts more often than others
            words.append("muslims" if bad or rng.random() < 0.2 else "christians")
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_toxicity_finds_and_does_not_blame_groups(spark, make):
    rows, labels = toxic_corpus()
    labels += [(0, 1, 0), (None, 1, 1), (77_777, None, None)]
    labelled = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = make(rows + EDGES, clash=True)
    out = toxicity.toxicity(docs, labelled).collect()
    assert len(out) == len(rows) + len(EDGES)
    truth = {i: t for i, _, t in labels if i is not None}
    truth[0] = 1
    for r in out:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        if r.doc_id in truth and truth[r.doc_id] is not None and r.doc_id < 9000:
            assert r.predicted == truth[r.doc_id]
        elif r.doc_id is None or r.doc_id >= 9000:
            assert r.predicted == 0
    model = toxicity.fit(docs, labelled)
    from pyspark.sql import functions as F
    asked = make([(1, "the muslims are here"), (2, "the christians are here")])
    a, b = (r[0] for r in asked.select(model.score(F.col("text"))).collect())
    assert abs(a - b) < 0.05


def test_swapping_is_what_evens_the_groups(spark, make, monkeypatch):
    rows, labels = toxic_corpus()
    labelled = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    gap = lambda m: abs(sum(m.weights.get(f, 0) for f in toxicity.features("muslims"))
                        - sum(m.weights.get(f, 0) for f in toxicity.features("christians")))
    even = gap(toxicity.fit(make(rows), labelled))
    monkeypatch.setattr(toxicity, "SWAP_PENALTY", 0.0)
    assert even < 0.5 * gap(toxicity.fit(make(rows), labelled))


def test_toxicity_without_labels(spark, make):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = toxicity.toxicity(make(EDGES), none).collect()
    assert {r.score for r in out} == {0.5} and len(out) == len(EDGES)
    assert toxicity.toxicity(make([]), none).collect() == []
    clean = spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    out = toxicity.toxicity(make([(i, "a b") for i in range(40)]), clean).collect()
    assert all(r.score < 0.1 for r in out)


def quality_corpus(n=900):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(n):
        good = i % 4 != 0
        words = [rng.choice(["the", "of", "house", "river", "and", "green"]) for _ in range(rng.randint(5, 50))]
        rows.append((i, " ".join(words) if good else "!! ".join(w.upper() for w in words), f"s{i % 7}"))
        if i % 2:
            labels.append((i, int(good), 0))
        elif i % 8 == 0:
            labels.append((i, 0, 0))
    return rows, labels


def test_quality_separates(spark, make):
    rows, labels = quality_corpus()
    out = cotraining.quality(make([*rows, *EDGES], clash=False), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    out = out.collect()
    assert len(out) == len(rows) + len(EDGES)
    wrong = sum(r.kept != (r.doc_id % 4 != 0) for r in out if r.doc_id is not None and r.doc_id < 9000)
    assert wrong <= 0.02 * len(rows)
    assert all(0 <= r.score <= 1 and 0 <= r.text_score <= 1 and 0 <= r.page_score <= 1 for r in out)


def test_views_teach_each_other():
    """Few labels, a pool, and two views that each know half: exchange must not lose accuracy."""
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 2000).astype(float)
    a = (y[:, None] * 2 - 1) * 0.8 + rng.standard_normal((2000, 3))
    b = (y[:, None] * 2 - 1) * 0.8 + rng.standard_normal((2000, 3))
    alone = cotraining.View().fit(a[:30], y[:30])
    taught, _ = cotraining.co_train([a[:30], b[:30]], y[:30], [a[30:1500], b[30:1500]])
    right = lambda m: ((m.logit(a[1500:]) > 0) == (y[1500:] > 0)).mean()
    assert right(taught) >= right(alone) - 0.02 and right(taught) > 0.8


def test_quality_edges(spark, make):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = cotraining.quality(make(EDGES), none).collect()
    assert {r.score for r in out} == {0.5}
    assert cotraining.quality(make([]), none).collect() == []
    nulls = spark.createDataFrame([(1, None, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame(quality_corpus()[1], "doc_id long, quality int, toxic int")
    assert len(cotraining.quality(nulls.unionByName(make(quality_corpus()[0])), labels).collect()) == 901
    assert pytest.approx(cotraining.content(None)) == cotraining.content("")


def test_all_unlabelled_rows_teach(spark, make, monkeypatch):
    """A source without labels is known to the page view only from what the text view teaches it."""
    monkeypatch.setattr(cotraining, "POOL_ROWS", 5, raising=False)
    rows, labels = quality_corpus(1600)
    rows = [(i, t + " !!!!" * 9, "rare") if i % 160 == 4 else (i, t, s) for i, t, s in rows]  # never labelled
    out = cotraining.quality(make(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    rare = [r.page_score for r in out if r.doc_id % 160 == 4]
    other = [r.page_score for r in out if r.doc_id % 160 == 84]  # as bad, in sources that are good as well
    assert np.mean(rare) < np.mean(other) - 0.2


def test_corpus_sums_equal_local_ones(spark, make):
    docs = make(quality_corpus()[0])
    pool = docs.select(cotraining._features("text", "lang", "source", "n_chars").alias("f"), cotraining.F.lit(0.5).alias("chance"))
    stat = lambda xs, chance: np.array([len(chance), xs[0].sum(), xs[1].sum()])
    local = cotraining._views(cotraining._matrix([r.f for r in pool.collect()]))
    assert cotraining._corpus(pool.repartition(40))(stat) == pytest.approx(stat(local, np.zeros(900)))
    assert cotraining._corpus(pool.filter("false"))(stat) == pytest.approx([0, 0, 0])


def test_bounds_take_the_quota_among_ties():
    counts = np.array([0, 3, 10, 2])
    assert cotraining._bound(counts, 3) == 2.0
    assert cotraining._bound(counts, 8) == 2.5


def test_swaps_follow_the_sentences(spark):
    """A swap changes nothing that the sentence holds already, and terms that nobody mentions are not swapped."""
    place = {f: i for i, f in enumerate(sorted(set().union(*(toxicity.features(t) for g in toxicity.IDENTITY_TERMS for t in g))))}
    texts = ["women and men are here", "nothing named", "the blind"]
    rows = spark.createDataFrame([(sorted(toxicity.features(t)),) for t in texts], "found array<string>")
    got = [r[0] for r in rows.select(toxicity._swapped(place)("found")).collect()]
    assert list(map(len, got)) == [8, 0, 4]  # two terms with four others each; none; one with four
    assert sorted(-1 - place[f] for f in ("women", "wome~")) in [list(c) for c in got[0]]  # men is there already
    moved = np.diag(toxicity._swaps(got, len(texts), len(place)))
    assert moved[place["femmes"]] == 0 and moved[place["deaf"]] == pytest.approx(1 / 3)


def test_repeated_ids_are_learned_from_once_and_alike_however_rows_lie(spark, make, monkeypatch):
    """Every id has eight rows of different texts; what reaches the driver is bounded by ids, and the order tells nothing."""
    rows, labels = toxic_corpus(200)
    labelled = spark.createDataFrame([(i, i % 3 // 2, t) for i, _, t in labels], "doc_id long, quality int, toxic int")
    docs = make([(i, f"{text} extra{k} {'x' * k}", f"s{k}") for i, text in rows for k in range(8)])
    monkeypatch.setattr(toxicity, "FIT_ROWS", 60)
    monkeypatch.setattr(cotraining, "FIT_ROWS", 60)
    sizes, plain, matrix = [], toxicity._descend, cotraining._matrix
    monkeypatch.setattr(toxicity, "_descend", lambda x, *a: sizes.append(len(x)) or plain(x, *a))
    monkeypatch.setattr(cotraining, "_matrix", lambda f: sizes.append(len(f)) or matrix(f))
    first = toxicity.fit(docs.repartition(5), labelled)
    again = toxicity.fit(docs.repartition(2).orderBy("source"), labelled)
    assert (first.weights, first.bias) == (again.weights, again.bias) and sizes == [60, 60]
    key = lambda df: sorted(tuple(r) for r in df.collect())
    one = key(cotraining.quality(docs.repartition(5), labelled).select("doc_id", "kept"))
    sizes.clear()
    assert key(cotraining.quality(docs.repartition(2).orderBy("source"), labelled).select("doc_id", "kept")) == one
    assert max(sizes) <= 60


def test_terms_can_be_given(spark, make):
    rows, labels = toxic_corpus()
    rows = [(i, t.replace("muslims", "zorks").replace("christians", "glims")) for i, t in rows]
    labelled = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    gap = lambda m: abs(sum(m.weights.get(f, 0) for f in toxicity.features("zorks"))
                        - sum(m.weights.get(f, 0) for f in toxicity.features("glims")))
    assert gap(toxicity.fit(make(rows), labelled, (("zorks", "glims"),))) < 0.5 * gap(toxicity.fit(make(rows), labelled))


def test_documents_without_rows_but_labels(spark, make):
    labelled = spark.createDataFrame([(1, 1, 1), (2, 0, 0)], "doc_id long, quality int, toxic int")
    assert toxicity.toxicity(make([]), labelled).collect() == []
    assert cotraining.quality(make([]), labelled).collect() == []
