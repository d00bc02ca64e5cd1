import random

import numpy as np
import pytest

from tickloom.llm import minhash
from tickloom.llm.text import words


def sets(text):
    w = words((text or "").encode())
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    found = [sets(t) for _, t in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(found[i] & found[j])
            if both and 100 * both >= 85 * (len(found[i]) + len(found[j]) - both):
                a, b = root[i], root[j]
                root = [b if r == a else r for r in root]
    least = {}
    for (doc_id, _), r in zip(rows, root):
        least.setdefault(r, []).append(doc_id)
    out = []
    for (doc_id, _), f, r in zip(rows, found, root):
        known = [x for x in least[r] if x is not None]
        component = (min(known) if known else None) if f else doc_id
        out.append((doc_id, len(f), component, doc_id == component))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(5)
    vocab = [f"v{i}" for i in range(400)]
    rows = []
    for base in range(12):
        text = [rng.choice(vocab) for _ in range(rng.randint(40, 160))]
        for _ in range(rng.randint(1, 12)):  # a chain of edits, so that many pairs lie near the threshold
            rows.append(" ".join(text))
            text = list(text)
            for _ in range(rng.randint(0, 2)):
                text[rng.randrange(len(text))] = rng.choice(vocab)
    rng.shuffle(rows)
    return list(enumerate(rows, 1))


EDGES = [(900, None), (901, ""), (902, " \t\n"), (903, "One two"), (904, "one\ttwo"), (905, "one two three"),
         (None, "one two"), (None, "alone here"), (906, "w " * 30_000), (907, "w " * 30_000), (903, "One two"), (903, "other text of id")]


def rows_of(frame):
    return sorted([(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in frame.collect()], key=str)


def test_equals_brute_force(make):
    rows = corpus() + EDGES
    assert rows_of(minhash.near_duplicates(make(rows, clash=True))) == brute(rows)


def test_blocks_equal_brute_force(make, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 3)
    monkeypatch.setattr(minhash, "COLUMNS", 7)
    monkeypatch.setattr(minhash, "BROADCAST_BYTES", 0)
    rows = corpus()
    assert rows_of(minhash.near_duplicates(make(rows))) == brute(rows)


def test_empty_table(make):
    assert minhash.near_duplicates(make([])).collect() == []
    assert minhash.deduplicate(make([])).collect() == []


def test_deduplicate_keeps_one_of_each_group(make):
    rows = corpus() + EDGES
    docs = make(rows, clash=True)
    kept = minhash.deduplicate(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    groups = {c for _, n, c, _ in brute(rows) if n and c is not None}
    for doc_id in groups - {903}:
        assert ids.count(doc_id) == 1
    assert ids.count(903) == 2  # two texts of that id, in groups of their own; the equal row is gone
    assert {900, 901, 902} <= set(ids) and ids.count(None) == 1


@pytest.mark.parametrize("n", [1, 7, 100, 3000])
def test_sketch_fills_and_estimates(n):
    rng = np.random.default_rng(n)
    items = np.unique(rng.integers(0, 1 << 63, 2 * n, dtype=np.uint64))[:n]
    assert len(minhash.sketch(items)) == minhash.SIZE
    assert (minhash.sketch(items) < np.uint64((1 << 64) - 1)).all()
    if n >= 100:
        other = np.unique(np.r_[items[:n // 2], rng.integers(0, 1 << 63, n // 2, dtype=np.uint64)])
        alike = (minhash.sketch(items) == minhash.sketch(other)).mean()
        assert abs(alike - 1 / 3) < 0.15
