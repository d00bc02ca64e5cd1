"""Collocations of two and three words by stripes: each prefix keys a counter of the words that follow it.

The stripe of the empty prefix counts the words of a language, that of a word the words after it, and that of two words the
third ones. A task merges the stripes of all its texts elementwise before it sends them, as one row of words and counts for
each prefix; after the shuffle they are merged again. The entries of one level are the prefix totals of the next, so f of
a phrase, of its first part and of its rest are all entries of these stripes, and the greatest entries of the last level
are what pairs are subsumed by.

Words are 64-bit hashes, seeded by language, inside the stripes; the words themselves come from the first level, where two
words with one hash raise an error, so results are exact.

Scale:
* Only the languages' names, the hot prefixes (at most HOT a level) and a Bloom filter of at most FILTER_BITS reach every task.
  The filter holds the pairs that reach `least`: a phrase whose pair is rarer can't reach it either, so its stripes are not
  sent. A pair let through wrongly costs a row and changes nothing, and a full filter lets all through.
* A prefix with more than 1/HOT of all occurrences is dealt over several partitions by its next words.
* Tasks hold stripes of at most HELD words of text at a time. Ranks are cut to `top` in the tasks, then in SALTS parts a
  language, before a language's rows meet.

Defined cases: a null text is empty, a null language is `und`. Repeated rows count each. Only lang and text are read. Texts are
taken whole, and windows never cross pieces. Ties go by score, a, then the phrase's bytes. An empty table has no phrases.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from tickloom.llm import text
from tickloom.llm.bloom import Filter
from tickloom.session import stored

LEAST, PERCENT, TOP = 10, 50, 2000
SCALE = 1_000_000
HELD = 1 << 22
HOT = 4096
FILTER_BITS = 1 << 27
SALTS = 64
ROWS = 1 << 16

# Pieces end at .,;:!? and x0A-x0D; words are parted by x20 and x09. The mark is no byte of UTF-8.
_END = b"\xff"
_SPLIT = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz" + _END * 10)


def collocations(docs: DataFrame, least: int = LEAST, percent: int = PERCENT, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score for `docs(lang, text)`; see the module."""
    docs = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    words = stored(_words(docs), "phrase-words")
    if words.filter("low <> high OR lang <> other").limit(1).count():
        raise ValueError("two words have one hash")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    whole = words.agg(F.sum("f")).first()[0] or 0
    words = words.filter(F.col("f") >= least).select("w", "f", "lang", F.col("low").alias("word"))

    hot = _hot(words.select(F.lit(0).cast("long").alias("p"), F.col("w").alias("q"), "f"), whole)
    pairs = _merged(docs, 2, hot).filter(F.col("f") >= least).select(F.col("q").alias("p"), F.col("w").alias("q"), "f")
    pairs = stored(pairs, "phrase-pairs")
    known = Filter.for_rate(min(pairs.count() + 1, FILTER_BITS // 10), 0.01)
    known = known.filled(pairs.select(F.col("p").alias("a"), F.col("q").alias("b")))
    triples = stored(_merged(docs, 3, _hot(pairs, whole), known).filter(F.col("f") >= least), "phrase-triples")

    pairs, triples = _scored(pairs, triples, words, percent)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rows = pairs.unionByName(triples).withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return rows.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _scored(pairs: DataFrame, triples: DataFrame, words: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Candidates with phrase, a, l, r and score. All parts of one are in the tables, being at least as frequent."""
    def named(side: str) -> DataFrame:
        return words.select(F.col("w").alias(side), F.col("f").alias(f"f_{side}"), F.col("word").alias(f"word_{side}"), F.col("lang").alias(f"lang_{side}"))

    pairs = pairs.select("p", "q", F.col("f").alias("a")).join(named("p"), "p").join(named("q"), "q")
    pairs = stored(pairs.select("p", "q", "a", F.col("f_p").alias("l"), F.col("f_q").alias("r"), F.col("lang_p").alias("lang"),
                                "word_p", "word_q"), "phrase-scored")
    first = pairs.select("p", "q", F.col("a").alias("f_12"), F.col("l").alias("f_1"), "lang", "word_p", "word_q")
    rest = pairs.select(F.col("p").alias("q"), F.col("q").alias("w"), F.col("a").alias("f_23"), F.col("r").alias("f_3"), F.col("word_q").alias("word_w"))
    found = triples.select("p", "q", "w", F.col("f").alias("a")).join(first, ["p", "q"]).join(rest, ["q", "w"])
    early, late = _score("f_1", "f_23"), _score("f_12", "f_3")
    cut = F.when(early <= late, F.struct(F.col("f_1").alias("l"), F.col("f_23").alias("r"), early.alias("score"))).otherwise(
        F.struct(F.col("f_12").alias("l"), F.col("f_3").alias("r"), late.alias("score")))
    longer = found.select("lang", F.concat_ws(" ", "word_p", "word_q", "word_w").alias("phrase"), "a", cut.alias("cut"))

    most = triples.select(F.explode(F.array(F.struct("p", "q"), F.struct(F.col("q").alias("p"), F.col("w").alias("q")))).alias("part"), "f")
    most = most.groupBy("part.p", "part.q").agg(F.max("f").alias("most"))
    free = pairs.join(most, ["p", "q"], "left").filter((F.col("most") * 100 < F.col("a") * percent) | F.col("most").isNull())
    return (free.select("lang", F.concat_ws(" ", "word_p", "word_q").alias("phrase"), "a", "l", "r", _score("l", "r").alias("score")),
            longer.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))


def _score(left: str, right: str):
    """floor(SCALE * a * a / (left * right)) in whole numbers of up to 38 digits: counts below 10^15 are exact."""
    return F.expr(f"(cast({SCALE} AS decimal(7,0)) * cast(a AS decimal(15,0)) * cast(a AS decimal(15,0))) "
                  f"div (cast({left} AS decimal(15,0)) * cast({right} AS decimal(15,0)))")


def _hot(prefixes: DataFrame, whole: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the prefixes p, q with more than 1/HOT of all occurrences, and the parts that each is dealt into."""
    rows = prefixes.filter(F.col("f") > whole // HOT).toArrow()  # under HOT of them, as they sum up to `whole`
    key = _key(rows.column("p").to_numpy(), rows.column("q").to_numpy())
    order = np.argsort(key)
    return key[order], rows.column("f").to_numpy()[order] * HOT // max(whole, 1) + 1


def _key(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return text.mix(p.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + q.view(np.uint64))


def _words(docs: DataFrame) -> DataFrame:
    """The stripes of the empty prefix: w, f, low and high (equal unless two words share a hash), lang and other."""
    def send(lang: str, ids: np.ndarray, words: list[bytes], hashes: np.ndarray) -> Iterator[pa.RecordBatch]:
        counts = np.bincount(ids, minlength=len(words))[1:]
        found = pa.array(words[1:], pa.binary()).cast(pa.string())
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(found), pa.string()), pa.array(hashes[1:]), found, pa.array(counts)], ["lang", "w", "word", "f"])

    rows = docs.mapInArrow(_by_language(send), "lang string, w long, word string, f long")
    return rows.groupBy("w").agg(F.sum("f").alias("f"), F.min("word").alias("low"), F.max("word").alias("high"),
                                 F.min("lang").alias("lang"), F.max("lang").alias("other"))


def _merged(docs: DataFrame, size: int, hot: tuple[np.ndarray, np.ndarray], known: Filter | None = None) -> DataFrame:
    """p, q, w, f: the entries of the merged stripes of prefixes of one word (q, with p = 0) or two."""
    def send(lang: str, ids: np.ndarray, words: list[bytes], hashes: np.ndarray) -> Iterator[pa.RecordBatch]:
        at = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
        if size == 2:
            code, counts = np.unique(ids[at] << 32 | ids[at + 1], return_counts=True)
            prefix = code >> 32
            p, q = np.zeros(len(hashes), np.int64), hashes
        else:
            pair, place = np.unique(ids[at] << 32 | ids[at + 1], return_inverse=True)
            p, q = hashes[pair >> 32], hashes[pair & 0xFFFFFFFF]
            begins = np.full(len(ids), -1)
            begins[at] = np.where(known.has(p, q)[place], place, -1)
            at = np.flatnonzero((begins[:-1] >= 0) & (begins[1:] >= 0))
            code, counts = np.unique(begins[at] << 32 | ids[at + 2], return_counts=True)
            prefix = code >> 32
        return _stripes(p, q, prefix, hashes[code & 0xFFFFFFFF], counts, hot)

    stripes = docs.mapInArrow(_by_language(send), "p long, q long, part long, w array<long>, f array<long>")
    entries = stripes.repartition("p", "q", "part").select("p", "q", "part", F.explode(F.arrays_zip("w", "f")).alias("e"))
    merged = entries.select("p", "q", "part", "e.w", "e.f").groupBy("p", "q", "part", "w").agg(F.sum("f").alias("f"))
    return merged.select("p", "q", "w", "f")


def _stripes(p: np.ndarray, q: np.ndarray, prefix: np.ndarray, after: np.ndarray, counts: np.ndarray, hot) -> Iterator[pa.RecordBatch]:
    """One row for each prefix (a place in p and q, rising) and part of it, with the words after it and their counts."""
    keys, parts = hot
    part = np.zeros(len(prefix), np.int64)
    if len(keys):
        own = _key(p, q)
        at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
        dealt = np.where(keys[at] == own, parts[at], 1)[prefix]
        part = (after.view(np.uint64) % dealt.astype(np.uint64)).astype(np.int64)
    group = prefix * (HOT + 2) + part
    order = np.argsort(group, kind="stable")
    cuts, _ = text.cut(group[order])
    starts = np.array([s for s, _ in cuts], np.int64)
    first = order[starts]
    ends = np.append(starts, len(order)).astype(np.int32)
    lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(values[order])) for values in (after, counts)]
    columns = [pa.array(p[prefix[first]]), pa.array(q[prefix[first]]), pa.array(part[first]), *lists]
    batch = pa.RecordBatch.from_arrays(columns, ["p", "q", "part", "w", "f"])
    for start in range(0, batch.num_rows, ROWS):
        yield batch.slice(start, ROWS)


def _by_language(send: Callable) -> Callable:
    """For mapInArrow: a language's texts as places in its words, sent whenever HELD words are held. Place 0 ends a piece."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, held, size = _numbers(), defaultdict(list), 0
        for batch in batches:
            for lang, body in zip(batch.column(0).to_pylist(), text.as_bytes(batch.column(1)), strict=True):
                if not body:
                    continue
                tokens = body.translate(_SPLIT).replace(_END, b" " + _END + b" ").split()
                held[lang] += [np.fromiter(map(numbers.__getitem__, tokens), np.int64, len(tokens)), np.zeros(1, np.int64)]
                size += len(tokens)
                if size >= HELD:
                    yield from sent(numbers, held)
                    numbers, held, size = _numbers(), defaultdict(list), 0
        yield from sent(numbers, held)

    def sent(numbers: dict[bytes, int], held: dict[str, list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        every = list(numbers)
        for lang, parts in held.items():
            ids = np.concatenate(parts)
            seen = np.flatnonzero(np.bincount(ids, minlength=len(every)))
            place = np.zeros(len(every), np.int64)
            place[seen] = np.arange(len(seen))
            words, seed = [every[i] for i in seen.tolist()], xxh3_64_intdigest(lang.encode())
            hashes = np.fromiter((xxh3_64_intdigest(w, seed) for w in words), np.uint64, len(words)).view(np.int64)
            yield from send(lang, place[ids], words, hashes)
    return run


def _numbers() -> dict[bytes, int]:
    numbers = defaultdict(count().__next__)
    numbers[_END]
    return numbers
