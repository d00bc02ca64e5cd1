"""Exact removal of repeated substrings by refining suffix intervals shard by shard.

Removed is each byte covered by a string of SPAN bytes that also starts in a document of smaller id.

Every string of SPAN bytes has an anchor, the least hash of its GRAM-byte substrings; equal strings
have equal anchors. A shard is a chunk of documents. It sends its anchors, sorted and packed, to be
merged, and learns which of them other documents hold too. Then it sends the stretches of text under
those anchors, once for each different stretch. Where shards meet, all suffixes under an anchor form
one interval. Equal stretches are one; what is left is refined by eight bytes a round: an interval is
split by the next bytes of its suffixes, and goes on only while it holds several documents. Suffixes
are never sorted as a whole: each round orders the members of open intervals only. After SPAN bytes,
an interval is a repeated string, and its smallest document keeps it. Marks go back to the shards.

This replaces byte-wise interleaving of the shards' Burrows-Wheeler transforms; see README.

Texts are UTF-8 bytes, and a null text has none. Matches lie within a document. Rows of one id are
one document as far as sizes of ids go: neither is smaller. A null id counts as larger than any.
Texts under SPAN bytes keep everything. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from tickloom.llm import text

SPAN, GRAM = 50, 16
CHUNK_BYTES = 1 << 20
BUCKET_BYTES = 2 << 20
BATCH = 500_000
NO_ID = (1 << 63) - 1

_REMOVED = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
_ODD = np.uint64(0x9E3779B97F4A7C15)


def remove_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row; `with_text` adds kept (binary)."""
    dealt, _, buckets = text.dealt(docs, CHUNK_BYTES, BUCKET_BYTES)
    by_chunk = dealt.groupBy("chunk")
    back = "chunk long, bucket int, kind string, a binary"
    anchors = by_chunk.applyInArrow(lambda t: _send_anchors(t, buckets), "chunk long, bucket int, a binary, b binary")
    shared = anchors.groupBy("bucket").applyInArrow(_merge_anchors, back)
    stretches = by_chunk.cogroup(shared.groupBy("chunk")).applyInArrow(
        lambda t, r: _send_stretches(t, r, buckets), "chunk long, bucket int, a binary, b binary, c binary, d binary")
    marks = stretches.groupBy("bucket").applyInArrow(_merge_stretches, back)
    returned = shared.unionByName(marks)
    return by_chunk.cogroup(returned.groupBy("chunk")).applyInArrow(
        lambda t, r: _remove(t, r, buckets, with_text), _REMOVED + (", kept binary" if with_text else ""))


class _Shard:
    """A chunk's bytes and the runs of neighbouring suffixes that share an anchor."""

    def __init__(self, table: pa.Table):
        ids = table.column("doc_id").to_pylist()
        self.raw = text.texts(table.column("text"))
        self.table = table
        length = np.array([len(r) for r in self.raw], np.int64)
        self.end = np.cumsum(length)
        self.data = np.frombuffer(b"".join(self.raw), np.uint8)
        self.id = np.array([NO_ID if i is None else i for i in ids], np.int64)
        n = len(self.data) - SPAN + 1
        if n <= 0:
            self.anchor = np.zeros(0, np.uint64)
            self.start = self.stop = self.doc = np.zeros(0, np.int64)
            return
        least = _anchors(self.data)
        doc = np.repeat(np.arange(len(length)), length)
        inside = doc[:n] == doc[SPAN - 1:]
        new = np.r_[True, (least[1:] != least[:-1]) | (doc[1:n] != doc[:n - 1]) | ~inside[:-1]]
        at = np.flatnonzero(new & inside)
        stop = np.flatnonzero(inside & np.r_[new[1:] | ~inside[1:], True]) + 1
        self.anchor, self.start, self.stop, self.doc = least[at], at, stop, doc[at]


def _anchors(data: np.ndarray) -> np.ndarray:
    """For each string of SPAN bytes the least hash of its substrings of GRAM bytes."""
    h = text.mix(data.astype(np.uint64) + _ODD)
    for step in (1, 2, 4, 8):
        h = h[:-step] * _ODD + h[step:]
        h ^= h >> np.uint64(29)
    h = text.mix(h)
    width = SPAN - GRAM + 1
    for step in (1, 2, 4, 8, 16):
        h = np.minimum(h[:-step], h[step:])
    rest = width - 32
    return np.minimum(h[:-rest], h[rest:])


def _send_anchors(table: pa.Table, buckets: int) -> pa.Table:
    s = _Shard(table)
    order = np.lexsort((s.id[s.doc], s.anchor))
    known, first = np.unique(s.anchor[order], return_index=True)
    ids = s.id[s.doc][order]
    several = np.zeros(len(known), np.uint8)
    if len(known):
        several = (ids[np.r_[first[1:], len(ids)] - 1] != ids[first]).astype(np.uint8)
    cuts, places = text.cut(text.bucket(known, buckets))
    return pa.table({
        "chunk": pa.array([table.column("chunk")[0].as_py()] * len(places), pa.int64()),
        "bucket": pa.array(places, pa.int32()),
        "a": pa.array([text.pack_sorted(known[i:j]) for i, j in cuts], pa.binary()),
        "b": pa.array([np.packbits(several[i:j]).tobytes() for i, j in cuts], pa.binary()),
    })


def _back(table: pa.Table, kind: str, cells: list[bytes]) -> pa.Table:
    return pa.table({
        "chunk": table.column("chunk"), "bucket": table.column("bucket"),
        "kind": pa.array([kind] * len(cells)), "a": pa.array(cells, pa.binary())})


def _merge_anchors(table: pa.Table) -> pa.Table:
    """Which anchors are held by several documents: of one shard, or of several shards."""
    lists = [text.unpack_sorted(x) for x in table.column("a").to_pylist()]
    several = np.concatenate([
        np.unpackbits(np.frombuffer(b, np.uint8))[:len(x)] for x, b in zip(lists, table.column("b").to_pylist(), strict=True)])
    _, at, count = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    shared = count > 1
    shared |= np.bincount(at, weights=several, minlength=len(count)) > 0
    cells = np.split(shared[at], np.cumsum([len(x) for x in lists])[:-1])
    return _back(table, "anchors", [np.packbits(c).tobytes() for c in cells])


def _cells(returned: pa.Table, kind: str) -> dict[int, bytes]:
    rows = zip(returned.column("kind").to_pylist(), returned.column("bucket").to_pylist(),
               returned.column("a").to_pylist(), strict=True)
    return {bucket: cell for k, bucket, cell in rows if k == kind}


class _Stretches:
    """The different stretches of text under shared anchors, in the order in which they are sent."""

    def __init__(self, s: _Shard, returned: pa.Table, buckets: int):
        known, at = np.unique(s.anchor, return_inverse=True)
        flags = np.zeros(len(known), bool)
        cells = _cells(returned, "anchors")
        if len(known):
            for (i, j), place in zip(*text.cut(text.bucket(known, buckets)), strict=True):
                flags[i:j] = np.unpackbits(np.frombuffer(cells[place], np.uint8))[:j - i]
        runs = np.flatnonzero(flags[at])
        runs = runs[np.argsort(s.anchor[runs], kind="stable")]
        whole = s.data.tobytes()
        seen: dict[bytes, int] = {}
        self.of_run = np.empty(len(runs), np.int64)
        self.runs, picked = runs, []
        for k, run in enumerate(runs.tolist()):
            piece = whole[s.start[run]:s.stop[run] + SPAN - 1]
            number = seen.setdefault(piece, len(picked))
            if number == len(picked):
                picked.append((run, piece))
            self.of_run[k] = number
        # Within an anchor by bytes, so that the order does not hang on that of the rows.
        anchor = [int(s.anchor[r]) for r, _ in picked]
        order = sorted(range(len(picked)), key=lambda i: (anchor[i], picked[i][1]))
        rank = np.empty(len(picked), np.int64)
        rank[order] = np.arange(len(picked))
        self.of_run = rank[self.of_run] if len(picked) else self.of_run
        self.piece = [picked[i][1] for i in order]
        self.anchor = np.array([anchor[i] for i in order], np.uint64)
        self.id = np.full(len(picked), NO_ID, np.int64)
        np.minimum.at(self.id, self.of_run, s.id[s.doc[runs]])


def _send_stretches(table: pa.Table, returned: pa.Table, buckets: int) -> pa.Table:
    x = _Stretches(_Shard(table), returned, buckets)
    cuts, places = text.cut(text.bucket(x.anchor, buckets))
    size = np.array([len(p) for p in x.piece], np.int64)
    return pa.table({
        "chunk": pa.array([table.column("chunk")[0].as_py()] * len(places), pa.int64()),
        "bucket": pa.array(places, pa.int32()),
        "a": pa.array([text.pack(x.anchor[i:j], 8) for i, j in cuts], pa.binary()),
        "b": pa.array([text.pack(size[i:j], 5) for i, j in cuts], pa.binary()),
        "c": pa.array([text.pack(x.id[i:j], 8) for i, j in cuts], pa.binary()),
        "d": pa.array([zstandard.compress(b"".join(x.piece[i:j]), 3) for i, j in cuts], pa.binary()),
    })


def _merge_stretches(table: pa.Table) -> pa.Table:
    """For each shard, a bit for each suffix of its stretches: whether a smaller document has it."""
    sizes = [text.unpack(b, 5).astype(np.int64) for b in table.column("b").to_pylist()]
    anchor = np.concatenate([text.unpack(a, 8) for a in table.column("a").to_pylist()])
    owner = np.concatenate([text.unpack(c, 8) for c in table.column("c").to_pylist()]).astype(np.int64)
    size = np.concatenate(sizes)
    data = b"".join(map(zstandard.decompress, table.column("d").to_pylist()))
    start = np.cumsum(size) - size
    # Equal stretches are one, of the smallest document; their bytes name their anchor too.
    pieces = zip(start.tolist(), (start + size).tolist(), strict=True)
    digest = np.fromiter((xxh3_64_intdigest(data[i:j]) for i, j in pieces), np.uint64, len(size))
    _, one, same = np.unique(digest, return_index=True, return_inverse=True)
    least = np.full(len(one), NO_ID, np.int64)
    np.minimum.at(least, same, owner)
    count = size[one] - SPAN + 1
    offset = np.cumsum(count) - count
    repeated = np.zeros(int(count.sum()), bool)
    # Stretches that are alone under their anchor repeat nothing; the others go anchor by anchor.
    order = np.argsort(anchor[one], kind="stable")
    name = anchor[one][order]
    group = np.cumsum(np.r_[False, name[1:] != name[:-1]])
    shared = np.bincount(group)[group] > 1
    order, group = order[shared], group[shared]
    if len(order):
        # A batch takes the anchors whose first suffix falls in the same BATCH of suffixes.
        before = np.cumsum(count[order]) - count[order]
        begins = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        turn = np.repeat(before[begins] // BATCH, np.diff(np.append(begins, len(order))))
        for i, j in text.cut(turn)[0]:
            _refine_batch(data, anchor[one], start[one], count, offset, least, order[i:j], repeated)
    cells, first = [], 0
    for block in sizes:
        k = same[first:first + len(block)]
        length = count[k]
        run = np.repeat(np.arange(len(k)), length)
        at = offset[k][run] + np.arange(len(run)) - (np.cumsum(length) - length)[run]
        later = owner[first:first + len(block)] > least[k]
        cells.append(np.packbits(repeated[at] | later[run]).tobytes())
        first += len(block)
    return _back(table, "marks", cells)


def _refine_batch(data: bytes, anchor, start, count, offset, least, chosen: np.ndarray, out: np.ndarray) -> None:
    """Refine the suffixes of the chosen stretches, in parts by their first bytes where they are many."""
    length = count[chosen]
    piece = np.repeat(np.arange(len(chosen), dtype=np.int32), length)
    within = np.arange(len(piece)) - (np.cumsum(length) - length)[piece]
    where, at = start[chosen][piece] + within, offset[chosen][piece] + within
    interval = np.unique(anchor[chosen], return_inverse=True)[1]
    parts = 1 + len(where) // BATCH
    part = (text.mix(_eight(data)[where]) % np.uint64(parts)).astype(np.int32)
    for k in range(parts):
        i = np.flatnonzero(part == k)
        out[at[i]] = _refined(data, where[i], interval[piece[i]], least[chosen][piece[i]])


def _eight(data: bytes) -> np.ndarray:
    """The eight bytes at each place."""
    return np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))


def _refined(data: bytes, where: np.ndarray, interval: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Whether the SPAN bytes at `where` are also those of a member of a smaller owner."""
    out = np.zeros(len(where), bool)
    eight = _eight(data) if len(where) else None
    left, group = np.arange(len(where)), interval
    for offset in (*range(0, SPAN - 8, 8), SPAN - 8):
        if not len(left):
            return out
        symbol = eight[where[left] + offset]
        order = np.lexsort((symbol, group))
        left, group, symbol = left[order], group[order], symbol[order]
        new = np.r_[True, (group[1:] != group[:-1]) | (symbol[1:] != symbol[:-1])]
        first = np.flatnonzero(new)
        least, most = np.minimum.reduceat(owner[left], first), np.maximum.reduceat(owner[left], first)
        group = np.cumsum(new) - 1
        open_ = (least < most)[group]
        left, group = left[open_], group[open_]
    if len(left):
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        least = np.minimum.reduceat(owner[left], first)
        out[left] = owner[left] > np.repeat(least, np.diff(np.append(first, len(left))))
    return out


def _remove(table: pa.Table, returned: pa.Table, buckets: int, with_text: bool) -> pa.Table:
    s = _Shard(table)
    x = _Stretches(s, returned, buckets)
    covered = np.zeros(len(s.data) + 1, np.int32)
    if len(x.anchor):
        cells = _cells(returned, "marks")
        count = np.array([len(p) for p in x.piece], np.int64) - SPAN + 1
        offset = np.cumsum(count) - count
        marks = np.zeros(int(count.sum()), bool)
        for (i, j), place in zip(*text.cut(text.bucket(x.anchor, buckets)), strict=True):
            a, b = offset[i], offset[j - 1] + count[j - 1]
            marks[a:b] = np.unpackbits(np.frombuffer(cells[place], np.uint8))[:b - a]
        # A shard sends a stretch for its smallest document; what others hold is repeated.
        length = count[x.of_run]
        run = np.repeat(np.arange(len(x.runs)), length)
        within = np.arange(len(run)) - (np.cumsum(length) - length)[run]
        later = s.id[s.doc[x.runs]] > x.id[x.of_run]
        hit = later[run] | marks[offset[x.of_run][run] + within]
        at = s.start[x.runs][run[hit]] + within[hit]
        np.add.at(covered, at, 1)
        np.add.at(covered, at + SPAN, -1)
    gone = np.cumsum(covered[:-1]) > 0
    rows = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "kept": []}
    for raw, end in zip(s.raw, s.end.tolist(), strict=True):
        g = gone[end - len(raw):end]
        kept = s.data[end - len(raw):end][~g].tobytes()
        rows["n_bytes"].append(len(raw))
        rows["n_removed"].append(len(raw) - len(kept))
        rows["n_spans"].append(int(g[:1].sum() + (g[1:] & ~g[:-1]).sum()))
        rows["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
        rows["kept"].append(kept)
    if not with_text:
        del rows["kept"]
    return pa.table({"doc_id": s.table.column("doc_id"), **rows})
