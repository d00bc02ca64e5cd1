"""Words, hashes and Arrow batches for the operators that run numpy inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def words(text: bytes | None) -> list[bytes]:
    """A-Z lower-cased, split at x20 and x09-x0D, which is what bytes.split() does."""
    return text.translate(_LOWER).split() if text else []


def hashes(items: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh3_64_intdigest, items), np.uint64, len(items))


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: every bit of the input moves every bit of the output."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def windows(h: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of `size` entries, in order."""
    n = len(h) - size + 1
    out = h[:n].copy()
    for k in range(1, size):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h[k:n + k])
    return out


def as_bytes(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def pack(a: np.ndarray, width: int) -> bytes:
    """Whole numbers below 256**width, byte by byte, so that alike high bytes stand together, compressed."""
    planes = np.ascontiguousarray(a.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    return zstandard.compress(planes.tobytes(), 3)


def unpack(data: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").ravel()


def pack_sorted(a: np.ndarray) -> bytes:
    """Rising hashes, as differences, whose high bytes are few."""
    return pack(np.diff(a, prepend=np.uint64(0)), 8)


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, 8), dtype=np.uint64)


def bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    """Rises with the hash, so sorted hashes are in the order of their buckets."""
    return ((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def cut(sorted_keys: np.ndarray) -> tuple[list[tuple[int, int]], list[int]]:
    """Where each run of equal keys begins and ends, and the keys."""
    if not len(sorted_keys):
        return [], []
    starts = np.flatnonzero(np.r_[True, sorted_keys[1:] != sorted_keys[:-1]])
    ends = np.r_[starts[1:], len(sorted_keys)]
    return list(zip(starts.tolist(), ends.tolist(), strict=True)), sorted_keys[starts].astype(int).tolist()


def dealt(docs: DataFrame, chunk_bytes: int, bucket_bytes: int, **more) -> tuple[DataFrame, int, int]:
    """Documents with compressed texts and the chunk that each falls in, and the numbers of chunks and buckets.

    Chunks come from a hash of id and text, and their number from the size of all texts, so a chunk
    is the same however the input is split. `more` names further columns.
    """
    body = F.coalesce(F.col("text").cast("string"), F.lit(""))
    size = docs.agg(F.coalesce(F.sum(F.octet_length(body)), F.lit(0))).first()[0]
    chunks = int(1 + size // chunk_bytes)
    rows = docs.select(
        F.col("doc_id").cast("long"), body.alias("text"), *[c.alias(n) for n, c in more.items()],
        F.pmod(F.xxhash64("doc_id", body), F.lit(chunks).cast("long")).alias("chunk"))
    schema = ", ".join(f"{n} {'binary' if n == 'text' else t}" for n, t in rows.dtypes)
    return rows.mapInArrow(by_batch(_compressed), schema), chunks, int(1 + size // bucket_bytes)


def _compressed(batch: pa.RecordBatch) -> pa.RecordBatch:
    small = pa.array([zstandard.compress(t, 6) for t in as_bytes(batch.column("text"))], pa.binary())
    return batch.set_column(batch.schema.names.index("text"), "text", small)


def texts(column: pa.ChunkedArray) -> list[bytes]:
    """The texts of `dealt` documents."""
    return [zstandard.decompress(t) for t in column.to_pylist()]


def by_batch(each: Callable[[pa.RecordBatch], pa.RecordBatch | Iterable[pa.RecordBatch]]):
    """For mapInArrow: `each` gets slices of at most 1,000 rows, so that memory follows the rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                out = each(batch.slice(start, 1000))
                yield from [out] if isinstance(out, pa.RecordBatch) else out
    return run


def by_group(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The groups of rows that are sorted by whole-number `keys`, one after the other."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([rest, table]) if rest is not None else table
        key = np.stack([table.column(k).to_numpy() for k in keys])
        cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
        bounds = [0, *cuts.tolist()]
        for start, end in zip(bounds, bounds[1:], strict=False):
            yield table.slice(start, end - start)
        rest = table.slice(bounds[-1])
    if rest is not None and rest.num_rows:
        yield rest
