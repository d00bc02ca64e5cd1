"""Near-duplicate vectors by an exact blocked search, or by NN-descent over a neighbour graph.

The search is exact: the different vectors are dealt into blocks of SEARCH_BLOCK by a hash, every two
blocks of vectors of one length meet once, and each vector's links are counted there. Nothing is
listed: two blocks give a row for each vector that has a link, with its count and the vector that
stands for what it hangs together with in these two, so components follow from those rows. Blocks are
compared in single precision first, and what comes within SLACK of the link is compared again in
double. No row is shuffled for a comparison, which grow with the square of the different vectors.

With `sure=False` NN-descent goes first. Every different vector keeps a list of its LIST nearest known
vectors with cosine of at least FLOOR: two vectors that are both linked to a third lie above it, so
lower ones lead nowhere. Lists begin with vectors on the same side of random planes, TABLES times. Then
neighbours of neighbours are compared: each vector's list, and the vectors that list it, meet as one
group, and every member takes the nearest it finds there, until few lists change. A list that is full
of links is saturated and is doubled, up to MOST. Components of these links are compared in blocks and
counted. This can miss links: of small groups, which are found only in a shared table, and between
dense groups, whose vectors list only their own. So it is audited: one vector in ASKED, or AUDIT if that
is more, is compared with all others, and recall is the share of its different neighbours that were
found, averaged over the asked vectors that have any; copies and large groups weigh no more than
pairs. While it is under RECALL, more tables and rounds are added, ROUNDS times at most. Where it does
not hold then, or no asked vector has a neighbour, the search does the whole job.

Equal vectors are one node with a weight, so copies cost a row. Groups over BLOCK members are dealt
into blocks by a hash. Cosines are taken in double precision. Null, empty and zero vectors and those
with null or non-finite components are in no list. Vectors of different length never link. A repeated
vec_id is a row of its own, and a null id never names a component.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from tickloom.llm import graph, text
from tickloom.session import stored

LINK, FLOOR = 0.95, 0.8
TABLES, LIST, MOST = 8, 16, 64
BLOCK, COUNT_BLOCK = 256, 512
AUDIT, ASKED, RECALL, ROUNDS = 512, 50, 0.999, 4
BUCKET = 32
SEARCH_BLOCK, SLACK = 1024, 1e-3


def near_duplicates(vectors: DataFrame, link: float = LINK, sure: bool = True) -> DataFrame:
    """vec_id, n_links, component_id, kept for `vectors(vec_id, embedding)`, and `audited_recall`.

    All links are found; `sure=False` is content with NN-descent where its audit holds.
    """
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    rows = stored(rows.mapInArrow(text.by_batch(_keyed), "vec_id long, node binary, vector binary"), "nn-rows")
    nodes = rows.filter("node IS NOT NULL").groupBy("node").agg(
        F.first("vector").alias("vector"), F.count("*").alias("weight"))
    nodes = stored(nodes, "nn-nodes")
    counted, recall = (_searched(nodes, link), 1.0) if sure else _descended(nodes, link)
    named = rows.select("vec_id", "node").join(counted, "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    least = stored(named.filter("component IS NOT NULL").groupBy("component").agg(F.min("vec_id").alias("component_id")), "nn-named")
    named = named.join(least, "component", "left")
    own = F.when(F.col("component").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return named.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"),
        F.col("vec_id").eqNullSafe(own).alias("kept"), F.lit(recall).alias("audited_recall"))


def _searched(nodes: DataFrame, link: float) -> DataFrame:
    """node, component, n_links by comparing every two blocks of vectors."""
    packed = _packed(nodes)
    found = _crossed(packed, packed, F.col("block_lo") <= F.col("block_hi")).mapInArrow(
        lambda batches: (_met(*pair, link) for batch in batches for pair in zip(*batch.columns, strict=True)),
        "node binary, root binary, n long")
    found = stored(found, "nn-found")
    return stored(_named(nodes, found.groupBy("node").agg(F.sum("n").alias("n")),
                         graph.components(found.select("node", "root").distinct(), "node", "root")), "nn-counted")


def _packed(nodes: DataFrame) -> DataFrame:
    """length, block, held: about SEARCH_BLOCK vectors of one length a row."""
    rows = nodes.withColumn("length", F.octet_length("vector"))
    sizes = rows.groupBy("length").agg(F.ceil(F.count("*") / SEARCH_BLOCK).alias("blocks"))
    rows = rows.join(F.broadcast(sizes), "length")  # a row for each length of vectors
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node", "length"), "blocks"))
    count = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = rows.repartition(count, "length", "block").groupBy("length", "block").agg(
        F.collect_list(F.struct("node", "vector", "weight")).alias("held"))
    return stored(packed, "nn-packed")


def _crossed(lo: DataFrame, hi: DataFrame, where: Column) -> DataFrame:
    """own, held_lo, held_hi for every two blocks of one length."""
    lo, hi = (d.select(*[F.col(c).alias(f"{c}_{side}") for c in d.columns]) for d, side in ((lo, "lo"), (hi, "hi")))
    return lo.join(hi.hint("shuffle_replicate_nl"), (F.col("length_lo") - F.col("length_hi") == 0) & where).select(
        (F.col("block_lo") == F.col("block_hi")).alias("own"), "held_lo", "held_hi")


def _met(own: pa.Scalar, lo: pa.Scalar, hi: pa.Scalar, link: float) -> pa.RecordBatch:
    """The linked vectors of two blocks, or of one with itself, with their links and a root of what hangs together."""
    (u, x, wu), (v, y, wv) = (_opened(held.values) for held in (lo, hi))
    near = x.astype(np.float32) @ y.astype(np.float32).T >= link - SLACK
    i, j = near.any(axis=1).nonzero()[0], near.any(axis=0).nonzero()[0]
    if own.as_py():
        i = j = np.union1d(i, j)
    close = x[i] @ y[j].T >= link
    if own.as_py():
        np.fill_diagonal(close, False)
        some = close.any(axis=1).nonzero()[0]
        close = close[np.ix_(some, some)]
        nodes, n, around = u[i[some]], close @ wu[i[some]], close
    else:
        some, more = close.any(axis=1).nonzero()[0], close.any(axis=0).nonzero()[0]
        close = close[np.ix_(some, more)]
        nodes = np.r_[u[i[some]], v[j[more]]]
        n = np.r_[close @ wv[j[more]], wu[i[some]] @ close]
        around = np.block([[np.zeros((len(some),) * 2, bool), close], [close.T, np.zeros((len(more),) * 2, bool)]])
    roots = nodes[_roots(around)]
    return pa.RecordBatch.from_arrays(
        [pa.array(nodes, pa.binary()), pa.array(roots, pa.binary()), pa.array(n.astype(np.int64))], names=["node", "root", "n"])


def _opened(held: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    nodes = np.empty(len(held), object)
    nodes[:] = held.field("node").to_pylist()
    return nodes, np.array([np.frombuffer(x, float) for x in held.field("vector").to_pylist()]), held.field("weight").to_numpy()


def _roots(around: np.ndarray) -> np.ndarray:
    """The least place that each place reaches."""
    root = np.arange(len(around))
    while len(root):
        after = np.minimum(root, np.where(around, root, len(root)).min(axis=1))
        after = after[after]
        if (after == root).all():
            break
        root = after
    return root


def _named(nodes: DataFrame, sums: DataFrame, parts: DataFrame) -> DataFrame:
    out = nodes.select("node", "weight").join(parts, "node", "left").join(sums, "node", "left")
    return out.select(
        "node", F.coalesce("component", "node").alias("component"),
        (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in sums.columns if c not in ("node", "n")])


def _descended(nodes: DataFrame, link: float) -> tuple[DataFrame, float]:
    """What `_searched` gives as far as NN-descent finds it, and the audited recall."""
    lists, recall, counted = None, 0.0, None
    for attempt in range(ROUNDS):
        found = _start(nodes, attempt)
        lists = _descend(nodes, found if lists is None else _best(lists.unionByName(found)), link)
        counted = stored(_count(nodes, lists.filter(F.col("cosine") >= link), link), "nn-counted")
        recall = _audit(nodes, counted.select("node", F.col("partners").alias("n_links")), link)
        if not recall < RECALL:
            break
    return (counted, recall) if recall >= RECALL else (_searched(nodes, link), 1.0)


def _keyed(batch: pa.RecordBatch) -> pa.RecordBatch:
    nodes, kept = [], []
    for values in batch.column("embedding").to_pylist():
        v = np.array([np.nan if x is None else x for x in values or ()], float)
        good = len(v) and np.isfinite(v).all() and v.any()
        if good:
            v = v / np.abs(v).max()  # keeps the direction; squares neither vanish nor overflow
            v = v / np.sqrt((v * v).sum())
        nodes.append(xxh3_128_digest(v.tobytes()) if good else None)
        kept.append(v.tobytes() if good else None)
    return pa.RecordBatch.from_arrays(
        [batch.column("vec_id"), pa.array(nodes, pa.binary()), pa.array(kept, pa.binary())],
        names=["vec_id", "node", "vector"])


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """One vector a row; shorter ones are padded, and a last column keeps lengths apart."""
    raw = [np.frombuffer(x, float) for x in column.to_pylist()]
    width = max(map(len, raw))
    if all(len(v) == width for v in raw):
        return np.array(raw)
    out = np.zeros((len(raw), width))
    for i, v in enumerate(raw):
        out[i, :len(v)] = v
    return out


def _cosines(a: pa.ChunkedArray, b: pa.ChunkedArray | None = None) -> np.ndarray:
    x = _matrix(a)
    if b is None:
        y, la = x, np.array([len(v) for v in a.to_pylist()])
        lb = la
    else:
        y = _matrix(b)
        la, lb = (np.array([len(v) for v in c.to_pylist()]) for c in (a, b))
    width = max(x.shape[1], y.shape[1])
    x, y = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (x, y))
    out = x @ y.T
    if len({*la.tolist(), *lb.tolist()}) > 1:
        out[la[:, None] != lb[None, :]] = -1
    return out


def _grouped(members: DataFrame, nodes: DataFrame, block: int, link: float | None) -> DataFrame:
    """Compare the members of each group(place, slot): `members(place, slot, node)`.

    Groups are dealt into blocks by a hash of the member. Without `link`, each member gets its
    nearest MOST of the block; with it, blocks meet each other and linked weights are summed.
    """
    sizes = members.groupBy("place", "slot").agg(F.count("*").alias("size")).filter("size > 1")
    sizes = stored(sizes, "nn-sizes")
    rows = members.join(sizes, ["place", "slot"])
    blocks = F.ceil(F.col("size") / block).cast("int")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node", "place"), blocks).cast("int"))
    keys = ["place", "slot", "lo", "hi"]
    if link is None:
        rows = rows.withColumn("lo", F.col("own")).withColumn("hi", F.col("own"))
    else:
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1))).withColumn(
            "lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other"))
    rows = rows.select(*keys, "own", "node").join(nodes, "node")
    count = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(count, *keys).sortWithinPartitions(*keys)
    if link is None:
        return rows.mapInArrow(lambda b: map(_nearest, text.by_group(b, keys)), "u binary, v binary, cosine double")
    return rows.mapInArrow(lambda b: (_linked(g, link) for g in text.by_group(b, keys)), "node binary, n long, partners long")


def _nearest(group: pa.Table) -> pa.RecordBatch:
    cosines = _cosines(group.column("vector"))
    np.fill_diagonal(cosines, -1)
    if len(cosines) > MOST:
        cut = np.partition(cosines, -MOST, axis=1)[:, -MOST]
        cosines[cosines < cut[:, None]] = -1
    i, j = np.nonzero(cosines >= FLOOR)
    nodes = group.column("node").combine_chunks()
    return pa.RecordBatch.from_arrays(
        [nodes.take(pa.array(i)), nodes.take(pa.array(j)), pa.array(cosines[i, j])], names=["u", "v", "cosine"])


def _linked(group: pa.Table, link: float) -> pa.RecordBatch:
    lo, hi = group.column("lo")[0].as_py(), group.column("hi")[0].as_py()
    weight, own = group.column("weight").to_numpy(), group.column("own").to_numpy()
    close = _cosines(group.column("vector")) >= link
    if lo != hi:
        close &= own[:, None] != own[None, :]
    np.fill_diagonal(close, False)
    return pa.RecordBatch.from_arrays(
        [group.column("node").combine_chunks(), pa.array((close @ weight).astype(np.int64)), pa.array(close.sum(axis=1))],
        names=["node", "n", "partners"])


def _start(nodes: DataFrame, attempt: int) -> DataFrame:
    """Lists from the vectors that fall on the same side of random planes."""
    planes = max(1, int(np.ceil(np.log2(max(2, nodes.count()) / BUCKET))))

    def placed(batch: pa.RecordBatch) -> pa.RecordBatch:
        place, slot, node = [], [], []
        ids, raw = batch.column("node").to_pylist(), batch.column("vector").to_pylist()
        for width in {len(v) for v in raw}:
            at = [i for i, v in enumerate(raw) if len(v) == width]
            x = np.array([np.frombuffer(raw[i], float) for i in at])
            for table in range(TABLES):
                rng = np.random.default_rng([attempt, table, width])
                sides = x @ rng.standard_normal((x.shape[1], planes)) > 0
                slot += (sides @ (1 << np.arange(planes))).tolist()
                place += [table * (1 << 32) + width] * len(at)
                node += [ids[i] for i in at]
        return pa.RecordBatch.from_arrays(
            [pa.array(place, pa.int64()), pa.array(slot, pa.int64()), pa.array(node, pa.binary())],
            names=["place", "slot", "node"])

    members = nodes.mapInArrow(text.by_batch(placed), "place long, slot long, node binary")
    return _best(_grouped(stored(members, "nn-members"), nodes, BLOCK, None))


def _best(found: DataFrame) -> DataFrame:
    """The nearest of each node: LIST of them, doubled while they are all links, MOST at most."""
    found = found.groupBy("u", "v").agg(F.max("cosine").alias("cosine"))
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("u").orderBy(F.desc("cosine"), "v")))
    ranked = ranked.filter(F.col("rank") <= MOST)
    links = F.count(F.when(F.col("cosine") >= LINK, 1)).over(Window.partitionBy("u"))
    room = F.when(links < LIST, LIST).when(links < 2 * LIST, 2 * LIST).otherwise(MOST)
    return stored(ranked.withColumn("room", room).filter("rank <= room").select("u", "v", "cosine"), "nn-lists")


def _descend(nodes: DataFrame, lists: DataFrame, link: float) -> DataFrame:
    for _ in range(ROUNDS):
        around = lists.select(F.col("u").alias("center"), F.col("v").alias("node")).unionByName(
            lists.select(F.col("v").alias("center"), F.col("u").alias("node"))).distinct()
        members = around.select(
            F.xxhash64("center").alias("place"), F.xxhash64("center", F.lit(1)).alias("slot"), "node")
        after = _best(lists.unionByName(_grouped(stored(members, "nn-members"), nodes, BLOCK, None)))
        total, fresh = after.count(), after.join(lists, ["u", "v"], "left_anti").count()
        lists = after
        if fresh <= 0.001 * total:
            break
    return lists


def _count(nodes: DataFrame, links: DataFrame, link: float) -> DataFrame:
    """node, component, n_links: what every member of a component is linked with, in its own component."""
    parts = stored(graph.components(links, "u", "v"), "nn-parts")
    members = parts.select(
        F.xxhash64("component").alias("place"), F.xxhash64("component", F.lit(1)).alias("slot"), "node")
    sums = _grouped(members, nodes, COUNT_BLOCK, link).groupBy("node").agg(
        F.sum("n").alias("n"), F.sum("partners").alias("partners"))
    return _named(nodes, sums, parts)


def _audit(nodes: DataFrame, counted: DataFrame, link: float) -> float:
    """The found share of a node's different neighbours, averaged over the asked nodes that have any; NaN if none has.

    `counted` has the number of different neighbours found as n_links.
    """
    every = max(1, min(ASKED, nodes.count() // AUDIT))
    asked = nodes.filter(F.pmod(F.xxhash64("node", F.lit("audit")), F.lit(every)) == 0)

    def compared(batches):
        for batch in batches:
            for _, lo, hi in zip(*batch.columns, strict=True):
                (u, x, _), (_, y, _) = _opened(lo.values), _opened(hi.values)
                n = (x @ y.T >= link).sum(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.binary()), pa.array(n)], names=["node", "n"])

    true = _crossed(_packed(asked), _packed(nodes), F.lit(True)).mapInArrow(compared, "node binary, n long")
    true = true.groupBy("node").agg((F.sum("n") - 1).alias("n")).filter("n > 0")
    share = F.least(F.coalesce("n_links", F.lit(0)) / F.col("n"), F.lit(1.0))
    recall = true.join(counted, "node", "left").agg(F.avg(share)).first()[0]
    return float("nan") if recall is None else recall
