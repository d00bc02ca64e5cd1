import math
import zlib
from collections import Counter

import numpy as np
import pytest

from tickloom.llm import katz
from tickloom.llm.text import words


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def good_turing(n):
    """Discounts from a {count: number of items} written out count by count."""
    n = {r: n.get(r, 0) for r in range(1, 7)}
    seen = [r for r in n if n[r]]
    half = [1.0] + [(r - 0.5) / r for r in range(1, 6)] + [1.0]
    if len(seen) < 2:
        return half
    points = []
    for i, r in enumerate(seen):
        below = seen[i - 1] if i else 0
        above = seen[i + 1] if i + 1 < len(seen) else 2 * r - seen[i - 1]
        points.append((math.log(r), math.log(n[r] / (0.5 * (above - below)))))
    mx, my = (sum(p[i] for p in points) / len(points) for i in (0, 1))
    slope = sum((x - mx) * (y - my) for x, y in points) / sum((x - mx) ** 2 for x, _ in points)
    if slope >= -1:
        return half
    common, out, raw = 6 ** (slope + 1), [1.0], True
    for r in range(1, 6):
        line = r * ((r + 1) / r) ** (slope + 1)
        star = line
        if raw and n[r] and n[r + 1]:
            turing = (r + 1) * n[r + 1] / n[r]
            error = math.sqrt((r + 1) ** 2 * n[r + 1] / n[r] ** 2 * (1 + n[r + 1] / n[r]))
            raw = abs(turing - line) > 1.65 * error and 0 < (turing / r - common) / (1 - common) < 1
            star = turing if raw else line
        else:
            raw = False
        out.append((star / r - common) / (1 - common))
    return [*out, 1.0]


class Brute:
    def __init__(self, docs):
        self.single, self.pairs, self.firsts = Counter(), Counter(), Counter()
        for doc_id, text in docs:
            if not held(doc_id):
                ws = ["<s>", *words((text or "").encode()), "</s>"]
                self.single.update(ws[1:])
                self.pairs.update(zip(ws, ws[1:]))
                self.firsts.update(ws[:-1])
        self.n, self.v = sum(self.single.values()), len(self.single)

        def d(counter):
            return good_turing(Counter(counter.values()))

        self.d1, self.d2 = d(self.single), d(self.pairs)
        kept = sum(self.d1[min(c, katz.LARGE + 1)] * c for c in self.single.values())
        self.whole = self.n if kept < self.n - 1e-9 else self.n + 1
        self.unseen = 1 - kept / self.whole
        self.after = {}
        for (a, b), c in self.pairs.items():
            self.after.setdefault(a, {})[b] = c

    def p1(self, w):
        c = self.single[w]
        return self.d1[min(c, katz.LARGE + 1)] * c / self.whole if c else self.unseen

    def p2(self, w, h):
        seen = self.after.get(h)
        if not seen:
            return self.p1(w)
        kept = sum(self.d2[min(c, katz.LARGE + 1)] * c for c in seen.values())
        span = self.firsts[h] if kept < self.firsts[h] - 1e-9 else self.firsts[h] + 1
        if w in seen:
            return self.d2[min(seen[w], katz.LARGE + 1)] * seen[w] / span
        return (1 - kept / span) / (1 - sum(map(self.p1, seen))) * self.p1(w)

    def score(self, text):
        ws = ["<s>", *words((text or "").encode()), "</s>"]
        return sum(math.log10(self.p2(w, h)) for h, w in zip(ws, ws[1:]))


def compare(spark, rows):
    got = katz.scores(spark.createDataFrame(rows, "doc_id long, text string, chunk string"))
    got = sorted(got.collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, r.n_tokens))
    want = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, len(words((r[1] or "").encode()))))
    brute = Brute([r[:2] for r in rows])
    assert len(got) == len(want)
    for g, (doc_id, text, _) in zip(got, want):
        ws = [*words((text or "").encode()), "</s>"]
        assert (g.doc_id, g.held_out, g.n_tokens, g.train_tokens) == (doc_id, held(doc_id), len(ws), brute.n)
        assert g.n_known == sum(brute.single[w] > 0 for w in ws)
        base = sum(math.log10((brute.single[w] + 1) / (brute.n + brute.v + 1)) for w in ws)
        assert g.base_score == pytest.approx(base, rel=1e-9, abs=1e-12)
        assert g.score == pytest.approx(brute.score(text), rel=1e-9, abs=1e-12)
    return brute


def corpus(n):
    rng = np.random.default_rng(3)
    vocab = [f"w{i}" for i in range(300)]
    rank = 1 / np.arange(1, 301)
    return [(i, " ".join(rng.choice(vocab, rng.integers(0, 60), p=rank / rank.sum())), None) for i in range(n)]


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(katz, "CHUNK_BYTES", 2000)
    monkeypatch.setattr(katz, "BUCKET_BYTES", 3000)
    rows = corpus(120) + [(500, None, "x"), (501, "", "x"), (None, "w1 w1 W2", "x"), (502, "a b " * 3000, None),
                          (3, "w1 w2", "x"), (3, "w1 w2", "x")]
    brute = compare(spark, rows)
    vocabulary = [*brute.single, "never seen"]
    for h in ["w0", "w299", "<s>", "a", "unknown", *list(brute.after)[:20]]:
        assert sum(brute.p2(w, h) for w in vocabulary) == pytest.approx(1, abs=1e-9)


def test_hot_first_words_are_spread(spark, monkeypatch):
    monkeypatch.setattr(katz, "HOT", 10)
    monkeypatch.setattr(katz, "CHUNK_BYTES", 1000)
    monkeypatch.setattr(katz, "BUCKET_BYTES", 1000)
    compare(spark, corpus(80))


def test_tiny(spark):
    compare(spark, [(1, "one", None)])
    only_held = next(i for i in range(99) if held(i))
    compare_none = katz.scores(spark.createDataFrame([(only_held, "a b")], "doc_id long, text string")).first()
    assert (compare_none.score, compare_none.base_score, compare_none.train_tokens) == (0, 0, 0)
    assert katz.scores(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("n", [
    [207_344, 59_772, 25_017, 14_274, 13_493, 7_080], [1_579_638, 246_704, 51_653, 21_705, 18_939, 7_580], [5, 0, 1, 0, 0, 0],
    [100, 40, 20, 12, 8, 6], [10, 3, 0, 1, 0, 0], [3, 1, 0, 0, 0, 0]])
def test_discounts_are_good_turing(n):
    """The first two are the words and pairs of the test data, whose fourth class is larger than its share."""
    d = katz.discounts(np.array(n))
    assert d.tolist() == pytest.approx(good_turing({r + 1: m for r, m in enumerate(n)}))
    assert ((d[1:-1] > 0) & (d[1:-1] < 1)).all() and d[1:-1].tolist() != [(r - 0.5) / r for r in range(1, 6)]


@pytest.mark.parametrize("n", [[0] * 6, [7, 0, 0, 0, 0, 0], [0, 0, 3, 0, 0, 0], [1, 1, 1, 1, 1, 1], [1, 5, 9, 20, 30, 50]])
def test_half_a_count_where_nothing_falls(n):
    assert katz.discounts(np.array(n)).tolist() == [1.0] + [(r - 0.5) / r for r in range(1, 6)] + [1.0]


def test_columns_of_any_name_may_be_there(make):
    rows = [(i, f"one two three {i % 3} two one") for i in range(30)] + [(40, None), (41, ""), (None, "one two"), (42, "one " * 20_000), (1, "one two")]
    key = lambda docs: sorted(map(str, katz.scores(docs).collect()))
    plain = key(make(rows))
    assert len(plain) == len(rows) and key(make(rows, clash=True)) == plain
