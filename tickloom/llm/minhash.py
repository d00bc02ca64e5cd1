"""Near-duplicate documents by fast similarity sketches, banding and exact verification.

A sketch has SIZE coordinates. In round i every shingle of a document is hashed into one bin; a
bin keeps the least (round, value). Rounds go on until no bin is empty; after SIZE rounds, round
SIZE + i puts all shingles into bin i, so every coordinate fills. A long text needs one to three
rounds, not one hash per coordinate, and equal coordinates estimate the Jaccard similarity with
the concentration of independent draws.

BANDS bands of ROWS coordinates make candidates. At similarity 0.85 a pair shares no band with
probability (1 - 0.85^5)^32 < 1e-8. Links are confirmed on full shingle sets:

* Texts with equal sets are one node, so copies cost a row, not pairs.
* Every node of a bucket is compared with the bucket's leader, and connected components follow.
* In buckets that still hold several components, all full sets are compared in blocks of BLOCK
  nodes, and a block returns a link only where it joins two components. So nothing is capped, and a
  group costs a row per member, whether or not its members lie near its leader.

Nulls and texts without words have an empty set and link with nothing. Rows repeat as they came;
rows with equal sets share a component whatever their ids. A null id never names a component.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_128_digest, xxh3_64_intdigest

from tickloom.llm import graph, text
from tickloom.session import stored

SHINGLE = 5
BANDS, ROWS = 32, 5
SIZE = BANDS * ROWS
BLOCK, COLUMNS = 512, 4096
BROADCAST_BYTES = 32 << 20

_SEEDS = text.mix(np.arange(1, 2 * SIZE + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_SIGNED = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("row_key", T.LongType()), T.StructField("n_shingles", T.LongType()),
    T.StructField("node", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType())),
])


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for `docs(doc_id, text)`; see the module."""
    found = _classes(docs, percent)
    least = stored(found.groupBy("component").agg(F.min("doc_id").alias("component_id")), "minhash-named")
    return found.join(least, "component", "left").select(
        "doc_id", "n_shingles", F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicate(docs: DataFrame, percent: int = 85) -> DataFrame:
    """`docs` with one row of each group, that of the smallest id, and all rows without words.

    Rows are found again by a hash of id and text, so only hashes are shuffled; equal rows are one.
    """
    found = stored(_classes(docs, percent).filter("component IS NOT NULL"), "minhash-classes")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row_key"))
    first = stored(found.groupBy("component").agg(F.min(order)["row_key"].alias("first")), "minhash-first")
    gone = found.join(first, "component").filter("row_key <> first").select("row_key").distinct()
    twice = found.groupBy("row_key").count().filter("count > 1").select("row_key")
    twice = stored(twice.join(gone, "row_key", "left_anti"), "minhash-twice")
    gone = stored(gone, "minhash-gone")
    kept = docs.join(_small(gone), _row_key() == gone["row_key"], "left_anti")
    if twice.isEmpty():
        return kept
    repeated = kept.join(_small(twice), _row_key() == twice["row_key"], "left_semi")
    repeated = repeated.withColumn("_llm_row_key", _row_key()).dropDuplicates(["_llm_row_key"]).drop("_llm_row_key")
    return kept.join(_small(twice), _row_key() == twice["row_key"], "left_anti").unionByName(repeated)


def _row_key():
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def _small(keys: DataFrame) -> DataFrame:
    """Broadcast where its measured size allows."""
    return F.broadcast(keys) if keys.count() * 16 <= BROADCAST_BYTES else keys


def _classes(docs: DataFrame, percent: int) -> DataFrame:
    """doc_id, row_key, n_shingles, component (null without words) for each row."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), _row_key().alias("row_key"))
    signed = stored(docs.mapInArrow(text.by_batch(_sign), _SIGNED), "minhash-signed")
    nodes = signed.filter("node IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("first_id"), F.first("bands").alias("bands"))
    nodes = stored(nodes, "minhash-nodes")

    buckets = nodes.select("node", F.explode("bands").alias("bucket"))
    # The leader is the same for all members and differs between bands.
    leaders = buckets.groupBy("bucket").agg(
        F.count("*").alias("size"), F.min_by("node", F.xxhash64("bucket", "node")).alias("leader"))
    members = stored(buckets.join(leaders.filter("size > 1"), "bucket"), "minhash-members")
    stars = members.filter("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    links = stored(_verified(docs, nodes, stars, percent), "minhash-links")

    parts = stored(graph.components(links, "a", "b"), "minhash-parts")
    placed = members.select("bucket", "size", "node").join(parts, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    mixed = placed.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    left = placed.join(mixed.filter("lo <> hi").select("bucket"), "bucket")
    rest = _block_links(docs, stored(left, "minhash-mixed"), nodes, percent)
    links = stored(links.unionByName(rest), "minhash-links")

    parts = graph.components(links, "a", "b")
    named = nodes.select("node", "first_id").join(parts, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    named = stored(named.select("node", "component"), "minhash-components")
    return signed.select("doc_id", "row_key", "n_shingles", "node").join(named, "node", "left").drop("node")


def shingles(raw: bytes | None) -> np.ndarray:
    """The distinct hashes of a text's 5-word shingles, sorted."""
    h = text.hashes(text.words(raw))
    if len(h) == 0:
        return h
    if len(h) < SHINGLE:  # the whole sequence; its length keeps it apart from longer ones
        return np.array([xxh3_64_intdigest(h.tobytes(), seed=len(h))], np.uint64)
    return np.unique(text.windows(h, SHINGLE))


def sketch(items: np.ndarray) -> np.ndarray:
    """SIZE coordinates of a non-empty set."""
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    out, done = np.full(SIZE, empty), 0
    while (out == empty).any():
        rounds = np.arange(done, min(2 * SIZE, done + max(1, 4096 // len(items))))
        h = text.mix(items[None, :] ^ _SEEDS[rounds][:, None])
        bins = (h % np.uint64(SIZE)).astype(np.int64)
        late = rounds >= SIZE
        bins[late] = (rounds[late] - SIZE)[:, None]
        value = (rounds.astype(np.uint64) << np.uint64(48))[:, None] | (h >> np.uint64(16))
        np.minimum.at(out, bins.ravel(), value.ravel())
        done += len(rounds)
    return out


def _sign(batch: pa.RecordBatch) -> pa.RecordBatch:
    counts, nodes, bands = [], [], []
    for raw in text.as_bytes(batch.column("text")):
        items = shingles(raw)
        counts.append(len(items))
        if not len(items):
            nodes.append(None), bands.append(None)
            continue
        coordinates = sketch(items)
        rows = text.mix(coordinates).reshape(BANDS, ROWS)
        key = np.arange(BANDS, dtype=np.uint64)
        for k in range(ROWS):
            key = text.mix(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, k])
        nodes.append(xxh3_128_digest(items.tobytes()))
        bands.append(key.view(np.int64))
    return pa.RecordBatch.from_arrays([
        batch.column("doc_id"), batch.column("row_key"), pa.array(counts, pa.int64()), pa.array(nodes, pa.binary()),
        pa.array(bands, pa.list_(pa.int64())),
    ], names=_SIGNED.names)


def _verified(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are alike."""
    pairs = stored(pairs, "minhash-pairs")
    needed = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    needed = stored(nodes.select("node", "first_id").join(needed, "node"), "minhash-needed")
    sets = stored(_sets_of(docs, needed), "minhash-sets")
    both = pairs.join(sets.toDF("a", "items_a"), "a").join(sets.toDF("b", "items_b"), "b")
    return both.mapInArrow(text.by_batch(lambda batch: _alike(batch, percent)), "a binary, b binary")


def _sets_of(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """node, items (its sorted shingles) for the nodes of `needed(node, first_id)`."""
    ids = needed.select(F.col("first_id").alias("id")).distinct()
    if needed.count() * 16 <= BROADCAST_BYTES:  # else texts are shuffled by id
        ids = F.broadcast(ids)
    texts = docs.join(ids, docs["doc_id"].eqNullSafe(ids["id"]), "left_semi").select("text")
    return texts.mapInArrow(text.by_batch(_sets), "node binary, items binary").dropDuplicates(["node"])


def _sets(batch: pa.RecordBatch) -> pa.RecordBatch:
    found = [s for s in map(shingles, text.as_bytes(batch.column("text"))) if len(s)]
    return pa.RecordBatch.from_arrays([
        pa.array([xxh3_128_digest(s.tobytes()) for s in found], pa.binary()),
        pa.array([s.tobytes() for s in found], pa.binary()),
    ], names=["node", "items"])


def _alike(batch: pa.RecordBatch, percent: int) -> pa.RecordBatch:
    keep = []
    for a, b in zip(batch.column("items_a").to_pylist(), batch.column("items_b").to_pylist(), strict=True):
        small, large = sorted((len(a), len(b)))
        if 100 * small < percent * large:
            keep.append(False)
            continue
        x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
        inter = len(np.intersect1d(x, y, assume_unique=True))
        keep.append(100 * inter >= percent * (len(x) + len(y) - inter))
    return batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _block_links(docs: DataFrame, members: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Links between the components of a bucket, enough of them to join what is linked."""
    needed = stored(nodes.select("node", "first_id").join(members.select("node").distinct(), "node"), "minhash-needed")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    rows = members.withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    group = ["bucket", "lo", "hi"]
    rows = rows.join(_sets_of(docs, needed), "node").select(
        "bucket", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own",
        "node", "component", "items")
    count = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(count, *group).sortWithinPartitions(*group)
    return rows.mapInArrow(lambda batches: _each_group(batches, percent), "a binary, b binary").distinct()


def _each_group(batches, percent: int):
    for group in text.by_group(batches, ["bucket", "lo", "hi"]):
        yield from _group_links(group, percent)


def _group_links(group: pa.Table, percent: int):
    """All sets of the group against each other, as products of a 0/1 matrix by shared shingle."""
    parts = np.unique(np.array(group.column("component").to_pylist(), object), return_inverse=True)[1]
    if parts.max() == 0:
        return
    sets = [np.frombuffer(x, np.uint64) for x in group.column("items").to_pylist()]
    sizes = np.array([len(s) for s in sets])
    row = np.repeat(np.arange(len(sets)), sizes)
    _, column, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    place = np.cumsum(seen > 1) - 1
    shared = (seen > 1)[column]
    row, column = row[shared], place[column[shared]]
    common = np.zeros((len(sets), len(sets)), np.float32)
    for start in range(0, int(place[-1]) + 1, COLUMNS):
        inside = (column >= start) & (column < start + COLUMNS)
        dense = np.zeros((len(sets), COLUMNS), np.float32)
        dense[row[inside], column[inside] - start] = 1
        common += dense @ dense.T
    linked = 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)
    linked &= parts[:, None] != parts[None, :]
    lo, hi = group.column("lo")[0].as_py(), group.column("hi")[0].as_py()
    if lo != hi:
        own = group.column("own").to_numpy()
        linked &= own[:, None] != own[None, :]
    root = list(range(int(parts.max()) + 1))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    nodes, found = group.column("node").to_pylist(), []
    for i, j in zip(*np.nonzero(np.triu(linked)), strict=True):
        x, y = find(int(parts[i])), find(int(parts[j]))
        if x != y:
            root[x] = y
            found.append(sorted((nodes[i], nodes[j])))
    if found:
        yield pa.RecordBatch.from_arrays([
            pa.array([x for x, _ in found], pa.binary()), pa.array([y for _, y in found], pa.binary()),
        ], names=["a", "b"])
