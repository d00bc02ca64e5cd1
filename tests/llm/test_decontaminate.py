import hashlib
import random
import re

import pytest

from tickloom.llm import decontaminate

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {i: i + 32 for i in range(65, 91)}


def terms(text):
    return _WORD.findall((text or "").translate(_LOWER))


def brute(rows, items, size=10):
    known = []
    for item, text in items:
        w = terms(text)
        n = min(size, len(w))
        known += [(item, tuple(w[i:i + n])) for i in range(len(w) - n + 1) if n]
    out = []
    for doc_id, text in rows:
        w, hit, names = terms(text), set(), set()
        for item, window in known:
            for i in range(len(w) - len(window) + 1):
                if tuple(w[i:i + len(window)]) == window:
                    hit |= set(range(i, i + len(window)))
                    names |= {str(item)} if item is not None else set()
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(names), digest, bool(hit)))
    return sorted(out, key=str)


ITEMS = [(1, "one two three four five six seven eight nine ten eleven twelve"), (10, "Short Item here"), (2, "short item HERE"),
         (3, None), (4, " -- "), (5, "größe ÄRGER"), (None, "no id at all"), (6, "single"), (7, "a b c d e f g h i"), (8, "a a a a a a a a a a a a")]


def corpus():
    rng = random.Random(2)
    words = "one two three four five six seven eight nine ten eleven twelve short item here a b c".split()
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))) for i in range(40)]
    rows += [(100 + k, "Before. " * k + "One, two; THREE four five\nsix seven-eight nine ten 11" + " after" * k) for k in range(12)]
    rows += [(200, None), (201, ""), (202, "größe ärger"), (203, "GRößE ÄRGER!"), (204, "x single y"), (None, "no id at all"),
             (205, "a " * 20_000), (206, "short item here"), (206, "short item here"), (207, "z a b c d e f g h i z"), (208, "words é no id at all é")]
    return rows


def rows_of(frame):
    return sorted([(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in frame.collect()], key=str)


@pytest.mark.parametrize("small", [True, False])
def test_equals_brute_force(spark, make, monkeypatch, small):
    if not small:
        monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 0)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert rows_of(decontaminate.contamination(make(corpus(), clash=True), items)) == brute(corpus(), ITEMS)


def test_empty_tables(spark, make):
    none = spark.createDataFrame([], "item_id long, text string")
    assert rows_of(decontaminate.contamination(make(corpus()), none)) == brute(corpus(), [])
    assert decontaminate.contamination(make([]), none).collect() == []
    assert decontaminate.decontaminate(make(corpus()), none).count() == len(corpus())


def test_documents_or_spans_go(spark, make):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = make(corpus(), clash=True)
    whole = decontaminate.decontaminate(docs, items)
    assert whole.columns == docs.columns
    clean = sorted([r[0] for r in brute(corpus(), ITEMS) if not r[-1]], key=str)
    assert sorted([r.doc_id for r in whole.collect()], key=str) == clean
    cut = {r.doc_id: r.text for r in decontaminate.decontaminate(docs, items, whole=False).collect()}
    assert len(cut) == len({r[0] for r in corpus()})
    assert cut[102] == "Before. Before 11 after after" and cut[207] == "z z" and cut[200] is None and cut[203] == "!"
