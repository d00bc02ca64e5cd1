import hashlib
import random

from tickloom.llm import repeats


def brute(rows):
    order = lambda i: (i is None, i or 0)
    first = {}
    for doc_id, text in sorted(rows, key=lambda r: order(r[0])):
        raw = (text or "").encode()
        for i in range(len(raw) - 49):
            first.setdefault(raw[i:i + 50], order(doc_id))
    out = []
    for doc_id, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - 49):
            if first[raw[i:i + 50]] < order(doc_id):
                gone[i:i + 50] = b"\1" * 50
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((doc_id, len(raw), len(raw) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(make, rows, **more):
    got = repeats.remove_repeats(make(rows, **more)).collect()
    return sorted([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got], key=str)


def corpus(seed, n):
    rng = random.Random(seed)
    alphabet = "abcdé \n"
    pieces = ["".join(rng.choice(alphabet) for _ in range(rng.randint(10, 120))) for _ in range(30)]
    return [(i, "".join(rng.choice([rng.choice(pieces), "".join(rng.choice(alphabet) for _ in range(30))])
                        for _ in range(rng.randint(0, 8)))) for i in range(n)]


EDGES = [(800, None), (801, ""), (802, "x" * 49), (803, "x" * 50), (804, "x" * 5000), (805, "xy" * 300), (806, "yx" * 300),
         (None, "x" * 60), (None, "null id only " * 10), (None, "null id only " * 10), (803, "x" * 70), (807, "ä" * 40), (808, "ä" * 40),
         (809, "long text " * 20_000), (810, "long text " * 20_000)]


def test_equals_brute_force(make, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK_BYTES", 3000)
    monkeypatch.setattr(repeats, "BUCKET_BYTES", 4000)
    monkeypatch.setattr(repeats, "BATCH", 300)
    rows = corpus(1, 150)
    assert run(make, rows) == brute(rows)


def test_edges(make):
    rows = EDGES + corpus(2, 20)
    assert run(make, rows, clash=True) == brute(rows)


def test_empty_table(make):
    assert run(make, []) == []


def test_kept_bytes(make):
    a, b = "a" * 30 + "shared passage of more than fifty bytes, word for word" + "b", "shared passage of more than fifty bytes, word for word!"
    rows = {r.doc_id: bytes(r.kept) for r in repeats.remove_repeats(make([(1, a), (2, b)]), with_text=True).collect()}
    assert rows == {1: a.encode(), 2: b"!"}
