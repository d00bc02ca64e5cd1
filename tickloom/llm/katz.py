"""Language-model scores by Katz backoff over word pairs.

P(w) is the Good-Turing discounted share of w among the training tokens; what the discounts leave
is the probability of a word never seen. P(w | h) is the discounted share of the pair hw among the
pairs that begin with h, or backoff(h) * P(w) where the pair was never seen; backoff(h) makes the
probabilities after h sum to one. Counts above LARGE are not discounted; Good-Turing takes
n(1) .. n(LARGE + 1), smoothed where they are uneven (see `discounts`). Where no count is
discounted, one more count stands in for what is left.

Texts are dealt into chunks. A chunk sends its different words, sorted and packed, to tables
partitioned by word hash, which return counts; then its different pairs to tables partitioned by
the pair's first word, which return the pair's count and, for each first word, sums by class of
count: with the discounts these give the backoff weight exactly. So a chunk, not a token, costs a
lookup, counts combine before each shuffle, and no table is gathered anywhere. First words with
over 1/HOT of all tokens are spread over all partitions, and their sums (at most HOT rows) are
handed to every chunk.

Words are known by 64-bit hashes, the second word of a pair by 40 bits within its first
word, or 32 where that has under FEW tokens.
A null text is empty: its only token is the end. A row without id is trained on. Repeated rows
count as often as they come. Without training rows every token is unseen and scores 0.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import text

CHUNK_BYTES = 6 << 20
BUCKET_BYTES = 4 << 20
LARGE = 5
FEW = 4096
HOT = 2000
BEGIN, END = np.uint64(1), np.uint64(2)
_LOW = np.uint64((1 << 40) - 1)

_RETURNED = "chunk long, bucket int, kind string, a binary, b binary, key long, sums array<long>"
_SCORED = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
           "base_score double, score double")


def scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    dealt, chunks, buckets = text.dealt(docs, CHUNK_BYTES, BUCKET_BYTES, held_out=held)
    by_chunk = dealt.groupBy("chunk")

    words = by_chunk.applyInArrow(lambda t: _send_words(t, buckets), "chunk long, bucket int, a binary, b binary")
    counted = words.groupBy("bucket").applyInArrow(_count_words, _RETURNED)
    totals = _sums(counted, "total")
    # One row for each chunk holds what all chunks share.
    each = docs.sparkSession.range(chunks).select(F.col("id").alias("chunk"), F.lit("shared").alias("kind"), totals.alias("totals"))
    counted = counted.filter("kind = 'chunk'").withColumn("kind", F.lit("words"))
    told = counted.unionByName(each, allowMissingColumns=True)
    pairs = by_chunk.cogroup(told.groupBy("chunk")).applyInArrow(
        lambda t, r: _send_pairs(t, r, buckets), "chunk long, bucket int, a binary, b binary, c binary, d binary, e binary")
    paired = pairs.groupBy("bucket").applyInArrow(_count_pairs, _RETURNED)
    each = each.withColumn("shared", _sums(paired, "total"))
    returned = counted.unionByName(paired.filter("kind = 'chunk'")).unionByName(each, allowMissingColumns=True)
    return by_chunk.cogroup(returned.groupBy("chunk")).applyInArrow(lambda t, r: _score(t, r, buckets), _SCORED)


def _sums(rows: DataFrame, kind: str):
    """A map from key to summed sums, of the few rows of this kind, as a scalar."""
    flat = rows.filter(F.col("kind") == kind).select("key", F.posexplode("sums").alias("i", "n"))
    flat = flat.groupBy("key", "i").agg(F.sum("n").alias("n"))
    return flat.agg(F.collect_list(F.struct("key", "i", "n")).alias("x")).scalar()


class _Tokens:
    """The tokens of a chunk: word, the word before, document, and whether it is trained on."""

    def __init__(self, table: pa.Table):
        self.table = table
        found = [text.hashes(text.words(t)) for t in text.texts(table.column("text"))]
        self.length = np.array([len(f) + 1 for f in found], np.int64)
        self.word = np.concatenate([x for f in found for x in (f, [END])]).astype(np.uint64)
        # Different words in order, BEGIN among them; the place there of each token and the one before.
        self.words, at = np.unique(np.append(self.word, BEGIN), return_inverse=True)
        self.at = at[:-1]
        self.before = np.empty_like(self.at)
        self.before[1:] = self.at[:-1]
        self.before[np.cumsum(self.length) - self.length] = at[-1]
        self.doc = np.repeat(np.arange(len(found)), self.length)
        self.trained = ~table.column("held_out").to_numpy(zero_copy_only=False).astype(bool)[self.doc]


def _rows(schema: list[str], **columns) -> pa.Table:
    return pa.table({k: pa.array(columns[k]) if not isinstance(columns[k], pa.Array) else columns[k] for k in schema})


def _send_words(table: pa.Table, buckets: int) -> pa.Table:
    t = _Tokens(table)
    words = t.words
    counts = np.bincount(t.at, weights=t.trained, minlength=len(words)).astype(np.uint64)
    # BEGIN is counted as a first word: as often as there are trained texts.
    docs = (~table.column("held_out").to_numpy(zero_copy_only=False).astype(bool)).sum()
    counts[np.searchsorted(words, BEGIN)] = docs
    cuts, places = text.cut(text.bucket(words, buckets))
    return pa.table({
        "chunk": pa.array([table.column("chunk")[0].as_py()] * len(places), pa.int64()),
        "bucket": pa.array(places, pa.int32()),
        "a": pa.array([text.pack_sorted(words[i:j]) for i, j in cuts], pa.binary()),
        "b": pa.array([text.pack(counts[i:j], 5) for i, j in cuts], pa.binary()),
    })


def _classes(counts: np.ndarray) -> list[int]:
    return np.bincount(np.minimum(counts, LARGE + 2).astype(np.int64), minlength=LARGE + 3)[1:LARGE + 2].tolist()


def _returned(bucket: int, chunks: list[int], a: list[bytes], b: list[bytes | None],
              keys: list[int], sums: list[list[int]]) -> pa.Table:
    n, m = len(chunks), len(keys)
    return pa.table({
        "chunk": pa.array(chunks + [None] * m, pa.int64()),
        "bucket": pa.array([bucket] * (n + m), pa.int32()),
        "kind": pa.array(["chunk"] * n + ["total"] * m),
        "a": pa.array(a + [None] * m, pa.binary()), "b": pa.array(b + [None] * m, pa.binary()),
        "key": pa.array([None] * n + keys, pa.int64()),
        "sums": pa.array([None] * n + sums, pa.list_(pa.int64())),
    })


def _count_words(table: pa.Table) -> pa.Table:
    words = [text.unpack_sorted(x) for x in table.column("a").to_pylist()]
    counts = np.concatenate([text.unpack(x, 5) for x in table.column("b").to_pylist()])
    known, at = np.unique(np.concatenate(words), return_inverse=True)
    total = np.bincount(at, weights=counts.astype(float)).astype(np.uint64)
    back = np.split(total[at], np.cumsum([len(w) for w in words])[:-1])
    real = total[known != BEGIN]
    sums = [int(real.sum()), int((real > 0).sum()), *_classes(real)]
    return _returned(table.column("bucket")[0].as_py(), table.column("chunk").to_pylist(),
                     [text.pack(x, 5) for x in back], [None] * len(back), [0], [sums])


def _totals(cell) -> dict[int, np.ndarray]:
    out: dict[int, np.ndarray] = {}
    for x in cell or ():
        out.setdefault(x["key"], np.zeros(16, np.int64))[x["i"]] = x["n"]
    return out


def _word_counts(returned: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Counts in the order of the chunk's sorted words (BEGIN among them), and the totals."""
    cells = dict(_in_order(returned, "words", "a"))
    return np.concatenate([text.unpack(c, 5) for c in cells.values()]), _shared(returned, "totals")[0]


def _in_order(returned: pa.Table, kind: str, column: str) -> list[tuple[int, bytes]]:
    """bucket and payload of the rows of a kind, by bucket."""
    rows = zip(returned.column("kind").to_pylist(), returned.column("bucket").to_pylist(),
               returned.column(column).to_pylist(), strict=True)
    return sorted((place, cell) for k, place, cell in rows if k == kind)


def _shared(returned: pa.Table, column: str) -> dict[int, np.ndarray]:
    at = returned.column("kind").to_pylist().index("shared")
    return _totals(returned.column(column)[at].as_py())


class _Pairs:
    """The different pairs of a chunk in the order in which they are sent, by bucket, first word and second."""

    def __init__(self, t: _Tokens, counts: np.ndarray, tokens: int, buckets: int):
        self.c_word, self.c_before = counts[t.at], counts[t.before]
        # By word: as a second word its low bits, as a first word a hash that names its bucket.
        mixed = text.mix(t.words)
        low, few = mixed & _LOW, mixed & np.uint64((1 << 32) - 1)
        hot = counts * np.uint64(HOT) >= np.uint64(max(tokens, 1))
        second = np.where(self.c_before < FEW, few[t.at], low[t.at])
        place = text.bucket(mixed, buckets)[t.before]
        spread = np.flatnonzero(hot[t.before])
        key = text.mix(mixed[t.before[spread]] * np.uint64(0x9E3779B97F4A7C15) + second[spread])
        place[spread] = text.bucket(key, buckets)
        rank = np.empty(len(mixed), np.uint64)
        rank[np.argsort(mixed, kind="stable")] = np.arange(len(mixed), dtype=np.uint64)
        by_place = place * np.uint64(len(mixed)) + rank[t.before]
        if buckets * len(mixed) < 1 << 23:  # one number holds all, else two sorts
            order = np.argsort((by_place << np.uint64(40)) | second)
        else:
            order = np.lexsort((second, by_place))
        p, f, s = place[order], by_place[order], second[order]
        new_first = np.r_[True, f[1:] != f[:-1]]
        new_pair = new_first.copy()
        new_pair[1:] |= s[1:] != s[:-1]
        self.pair_of = np.empty(len(order), np.int64)
        self.pair_of[order] = np.cumsum(new_pair) - 1
        self.first_of = np.empty(len(order), np.int64)
        self.first_of[order] = np.cumsum(new_first) - 1
        at = order[new_pair]
        self.low, self.place, self.c_second = second[at], place[at], self.c_word[at]
        self.first_of_pair = self.first_of[at]
        at = order[new_first]
        self.first, self.first_place, self.c_first = mixed[t.before[at]], place[at], self.c_before[at]
        self.hot_first = hot[t.before[at]]
        self.count = np.bincount(self.pair_of, weights=t.trained, minlength=len(self.low)).astype(np.uint64)


_SENT = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), *[(c, pa.binary()) for c in "abcde"]])
_OUT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), *[(c, pa.int64()) for c in ("n_tokens", "n_known", "train_tokens")],
                  ("base_score", pa.float64()), ("score", pa.float64())])


def _steps(low: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sorted groups as differences, which have fewer high bytes."""
    out = low.copy()
    out[1:] -= low[:-1]
    out[starts] = low[starts]
    return out


def _from_steps(steps: np.ndarray, starts: np.ndarray) -> np.ndarray:
    total = np.cumsum(steps, dtype=np.uint64)
    return total - np.repeat(total[starts] - steps[starts], np.diff(np.append(starts, len(steps))))


def _send_pairs(table: pa.Table, returned: pa.Table, buckets: int) -> pa.Table:
    if not table.num_rows:
        return _SENT.empty_table()
    counts, totals = _word_counts(returned)
    t = _Tokens(table)
    p = _Pairs(t, counts, int(totals[0]), buckets)
    size = np.bincount(p.first_of_pair, minlength=len(p.first))
    firsts, places = text.cut(p.first_place)
    pairs, _ = text.cut(p.place)
    steps = _steps(p.low, np.cumsum(size) - size)
    hot = p.hot_first.astype(np.uint64)
    return pa.table({
        "chunk": pa.array([table.column("chunk")[0].as_py()] * len(places), pa.int64()),
        "bucket": pa.array(places, pa.int32()),
        "a": pa.array([text.pack_sorted(p.first[i:j]) for i, j in firsts], pa.binary()),
        "b": pa.array([text.pack(size[i:j] * 2 + hot[i:j].astype(np.int64), 5) for i, j in firsts], pa.binary()),
        "c": pa.array([text.pack(steps[i:j], 5) for i, j in pairs], pa.binary()),
        "d": pa.array([text.pack(p.count[i:j], 4) for i, j in pairs], pa.binary()),
        "e": pa.array([text.pack(np.where(p.count[i:j] > 0, p.c_second[i:j], 0), 5) for i, j in pairs], pa.binary()),
    })


def _count_pairs(table: pa.Table) -> pa.Table:
    firsts = [text.unpack_sorted(x) for x in table.column("a").to_pylist()]
    sizes = np.concatenate([text.unpack(x, 5) for x in table.column("b").to_pylist()])
    lows = [text.unpack(x, 5) for x in table.column("c").to_pylist()]
    counts = np.concatenate([text.unpack(x, 4) for x in table.column("d").to_pylist()]).astype(float)
    seconds = np.concatenate([text.unpack(x, 5) for x in table.column("e").to_pylist()])
    known, at = np.unique(np.concatenate(firsts), return_inverse=True)
    hot = np.zeros(len(known), bool)
    hot[at] = (sizes & np.uint64(1)).astype(bool)
    spread = (sizes >> np.uint64(1)).astype(np.int64)
    low = _from_steps(np.concatenate(lows), np.cumsum(spread) - spread)
    first = np.repeat(at, spread)
    if len(known) < 1 << 23:  # one number holds both
        both = (first.astype(np.uint64) << np.uint64(40)) | low
        order = np.argsort(both)
        both = both[order]
        new = np.r_[True, both[1:] != both[:-1]]
    else:
        order = np.lexsort((low, first))
        new = np.r_[True, (first[order][1:] != first[order][:-1]) | (low[order][1:] != low[order][:-1])]
    pair = np.empty(len(order), np.int64)
    pair[order] = np.cumsum(new) - 1
    total = np.bincount(pair, weights=counts).astype(np.int64)
    second = np.zeros(len(total), np.int64)
    np.maximum.at(second, pair, seconds.astype(np.int64))
    owner = first[order][new]
    # By first word: trained counts by class of pair count, and second words' counts by class.
    sums = np.zeros((len(known), 2 * LARGE + 1), np.int64)
    seen = total > 0
    for r in range(1, LARGE + 1):
        sums[:, r - 1] = np.bincount(owner[seen & (total == r)], minlength=len(known)) * r
        sums[:, LARGE + r - 1] = np.bincount(owner[seen & (second == r)], minlength=len(known)) * r
    big = seen & (second > LARGE)
    sums[:, 2 * LARGE] = np.bincount(owner[big], weights=second[big], minlength=len(known)).astype(np.int64)
    back = np.split(total[pair], np.cumsum([len(x) for x in lows])[:-1])
    about = np.split(sums[at], np.cumsum([len(x) for x in firsts])[:-1])
    keys = [0, *known[hot].view(np.int64).tolist()]
    shared = [[0, 0, *_classes(total[seen])], *sums[hot].tolist()]
    return _returned(
        table.column("bucket")[0].as_py(), table.column("chunk").to_pylist(),
        [text.pack(x, 5) for x in back], [text.pack(np.ascontiguousarray(x.T).ravel(), 6) for x in about], keys, shared)


def discounts(n: np.ndarray) -> np.ndarray:
    """d(0) .. d(LARGE + 1) from the numbers of items seen once, twice, ..., LARGE + 1 times.

    Good-Turing with smoothed numbers: a line through the logarithms of counts and of their numbers, each number spread
    over the gap between the counts next to it. Counts are discounted by the raw numbers from 1 on as long as these differ
    from the line by more than chance does (1.65 standard errors) and give a discount between 0 and 1, and by the line
    from there on, whose discounts always do if it falls faster than 1/r. Only where it can't be drawn
    so (fewer than two different counts, or as good as none seen once) half a count is taken from each.
    """
    d, r = np.ones(LARGE + 2), np.arange(1, LARGE + 1, dtype=float)
    n = np.asarray(n, float)
    seen = np.flatnonzero(n) + 1.0
    if len(seen) > 1:
        before, after = np.append(0, seen[:-1]), np.append(seen[1:], 2 * seen[-1] - seen[-2])
        x, y = np.log(seen), np.log(2 * n[n > 0] / (after - before))
        slope = ((x - x.mean()) * (y - y.mean())).sum() / ((x - x.mean()) ** 2).sum()
    if len(seen) < 2 or not slope < -1:
        d[1:-1] = (r - 0.5) / r
        return d
    cut = (LARGE + 1) ** (slope + 1)
    d[1:-1] = ((1 + 1 / r) ** (slope + 1) - cut) / (1 - cut)
    for k in range(1, LARGE + 1):
        here, above = n[k - 1], n[k]
        if not (here and above):
            break
        turing = (k + 1) * above / here
        error = (k + 1) / here * math.sqrt(above * (1 + above / here))
        raw = (turing / k - cut) / (1 - cut)
        if abs(turing - k * (1 + 1 / k) ** (slope + 1)) <= 1.65 * error or not 0 < raw < 1:
            break
        d[k] = raw
    return d


def _score(table: pa.Table, returned: pa.Table, buckets: int) -> pa.Table:
    if not table.num_rows:
        return _OUT.empty_table()
    counts, totals = _word_counts(returned)
    shared = _shared(returned, "shared")
    tokens, types = int(totals[0]), int(totals[1])
    t = _Tokens(table)
    p = _Pairs(t, counts, tokens, buckets)
    c_pair = np.concatenate([text.unpack(c, 5) for _, c in _in_order(returned, "chunk", "a")]).astype(float)[p.pair_of]
    width = 2 * LARGE + 1
    sums = np.concatenate([
        text.unpack(c, 6).reshape(width, -1).T for _, c in _in_order(returned, "chunk", "b")]).astype(float)
    for i in np.flatnonzero(p.hot_first):
        sums[i] = shared[int(p.first[i:i + 1].view(np.int64)[0])][:width]

    c = p.c_word.astype(float)
    base = np.log10((c + 1) / (tokens + types + 1))
    d_word, d_pair = discounts(totals[2:LARGE + 3]), discounts(shared[0][2:LARGE + 3])
    classed = totals[2:LARGE + 2] * np.arange(1, LARGE + 1)
    kept = tokens - (classed * (1 - d_word[1:LARGE + 1])).sum()
    whole = tokens if kept < tokens else tokens + 1
    unseen = 1 - kept / whole
    single = np.where(c > 0, d_word[np.minimum(c, LARGE + 1).astype(int)] * c / whole, unseen)

    c_first = p.c_first.astype(float)
    lost = (sums[:, :LARGE] * (1 - d_pair[1:LARGE + 1])).sum(axis=1)
    span = np.where(lost > 0, c_first, c_first + 1)
    left = 1 - (c_first - lost) / span
    covered = ((sums[:, LARGE:2 * LARGE] * d_word[1:LARGE + 1]).sum(axis=1) + sums[:, 2 * LARGE]) / whole
    backoff = np.where(c_first > 0, left / np.maximum(1 - covered, unseen), 1.0)
    f = p.first_of
    after = d_pair[np.minimum(c_pair, LARGE + 1).astype(int)] * c_pair / span[f]
    model = np.log10(np.where(c_pair > 0, after, backoff[f] * single))

    def by_doc(x):
        return np.bincount(t.doc, weights=x, minlength=len(t.length))

    return pa.table({
        "doc_id": t.table.column("doc_id"), "held_out": t.table.column("held_out"),
        "n_tokens": pa.array(t.length), "n_known": pa.array(by_doc(c > 0).astype(np.int64)),
        "train_tokens": pa.array([tokens] * len(t.length), pa.int64()),
        "base_score": pa.array(by_doc(base)), "score": pa.array(by_doc(model)),
    })
