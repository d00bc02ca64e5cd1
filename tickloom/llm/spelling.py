"""Spelling variants among the words of a corpus: each word's most frequent neighbour at edit distance one.

Candidates come from pivotal grams. A word's bigrams are ordered by how few words hold them; its *prefix* is its GRAMS
rarest (and all that are as rare as the last), and its two *pivots* are the cheapest pair of bigrams of the prefix that do not
overlap, by dynamic programming over positions with the number of words that hold a bigram as its cost. One edit touches
at most one pivot, so of two words at distance one, that whose prefix ends first in the order has a pivot which the other's
prefix holds. Position limits: lengths differ by at most one, the pivot moves by that or not at all, and the edit lies in one
half of the shorter word, so that the other halves are equal. Words therefore meet under (bigram, position, length, equal
half), never under a bare bigram; pairs that meet are verified by their edit distance.

The words come from runs of the letters A-Z, a-z and U+00C0 to U+00FF, lower-cased in A-Z only. `typo`, as the contract
has it, deletes one code point of every run whose hash it picks.

Scale: tasks count words before they are shuffled, and hold at most HELD at a time. Of a corpus' size is nothing but the table
of different words; the bigrams of the alphabet are at most 90 x 90, which is all that is sent to tasks. Joins are equality
joins that Spark can split; a word's variants are bounded by its edits, and its root is found by pointer doubling in steps
that grow with the logarithm of a logarithm, since a form is at least twice as frequent.

Defined cases: null and empty texts hold no word; a null doc_id counts as empty text in the hash; repeated rows count each.
Ties go to the smallest word in code-point order. Only doc_id and text are read, whatever other columns are named. Texts are
taken whole. An empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_64_intdigest

from tickloom.llm import text
from tickloom.session import stored

LEAST_CHARS, LEAST_COUNT, TIMES = 5, 3, 2
TYPO_EVERY = 97
#: q * distance + 1 bigrams: one edit touches two of them at most.
GRAMS = 3
HELD = 1 << 19

# A-Z, a-z and U+00C0 to U+00FF, in UTF-8.
_RUN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\xbf])+")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_SIGNS = T.StructType([
    T.StructField("word", T.StringType()), T.StructField("n", T.LongType()), T.StructField("last", T.IntegerType()),
    T.StructField("looks", T.ArrayType(T.LongType())), T.StructField("found", T.ArrayType(T.LongType())),
])


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n for `docs(doc_id, text)`; see the module."""
    return forms(stored(words(docs), "spelling-words"))


def words(docs: DataFrame, every: int = TYPO_EVERY) -> DataFrame:
    """The different words of at least LEAST_CHARS code points and LEAST_COUNT occurrences, with `n`."""
    docs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), F.col("text").cast("string").alias("text"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        for batch in batches:
            for doc_id, body in zip(text.as_bytes(batch.column(0)), text.as_bytes(batch.column(1)), strict=True):
                if body:
                    _count(doc_id, body.translate(_LOWER), every, held)
                if len(held) >= HELD:
                    yield _rows(held)
                    held.clear()
        yield _rows(held)

    rows = docs.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return rows.filter((F.col("n") >= LEAST_COUNT) & (F.length("word") >= LEAST_CHARS))


def _count(doc_id: bytes, body: bytes, every: int, held: Counter[bytes]) -> None:
    begun = zlib.crc32(doc_id + b":")
    for run, n in Counter(_RUN.findall(body)).items():
        h = zlib.crc32(run, begun)
        if h % every == 0:
            chars = run.decode()
            run = (chars[:h % len(chars)] + chars[h % len(chars) + 1:]).encode()
        if len(run) >= LEAST_CHARS:  # bytes, so never too many left out; code points are counted at the end
            held[run] += n


def _rows(held: Counter[bytes]) -> pa.RecordBatch:
    found = pa.array(list(held), pa.binary()).cast(pa.string())
    return pa.RecordBatch.from_arrays([found, pa.array(list(held.values()), pa.int64())], ["word", "n"])


def forms(words: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n for different `words(word, n)`."""
    links = stored(near(words), "spelling-links")
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word")))
    found = links.groupBy("word", "n").agg(F.count("*").alias("n_near"), best.alias("best"))
    form = F.when(-F.col("best.n") >= TIMES * F.col("n"), F.col("best.word"))
    found = stored(found.select("word", "n_near", form.alias("form"), F.when(form.isNotNull(), -F.col("best.n")).alias("form_n")), "spelling-forms")
    roots = _roots(found.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), words)
    return words.select("word", "n").join(found, "word", "left").join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")


def near(words: DataFrame) -> DataFrame:
    """word, n, near, near_n: every pair of different `words(word, n)` at edit distance one, both ways round."""
    grams = words.select(F.explode(F.array_distinct(F.expr(
        "transform(sequence(1, length(word) - 1), i -> substring(word, i, 2))"))).alias("gram")).groupBy("gram").count()
    costs = {r["gram"]: r["count"] for r in grams.filter("gram IS NOT NULL").collect()}  # at most 90 x 90
    ranks = {g: i for i, g in enumerate(sorted(costs, key=lambda g: (costs[g], g)))}

    def signed(batch: pa.RecordBatch) -> pa.RecordBatch:
        signs = [_signs(word, ranks, costs) for word in batch.column(0).to_pylist()]
        lists = [pa.array([s[i] for s in signs], pa.list_(pa.int64())) for i in (1, 2)]
        last = pa.array([s[0] for s in signs], pa.int32())
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), last, *lists], [f.name for f in _SIGNS])

    signs = stored(words.select("word", "n").mapInArrow(text.by_batch(signed), _SIGNS), "spelling-signs")
    look, found = [signs.select(F.explode(keys).alias("key"), *[F.col(c).alias(f"{w}_{c}") for c in ("word", "n", "last")])
                   for keys, w in (("looks", "u"), ("found", "v"))]
    met = look.join(found, "key").filter("u_last <= v_last AND u_word <> v_word AND levenshtein(u_word, v_word, 1) = 1")
    turned = F.col("u_word") < F.col("v_word")
    pair = [F.when(turned, F.col(a)).otherwise(F.col(b)).alias(c) for a, b, c in (
        ("u_word", "v_word", "word"), ("u_n", "v_n", "n"), ("v_word", "u_word", "near"), ("v_n", "u_n", "near_n"))]
    pairs = met.select(*pair).distinct()
    both = F.explode(F.array(F.struct("word", "n", "near", "near_n"), F.struct(
        F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))))
    return pairs.select(both.alias("p")).select("p.*")


def _signs(word: str, ranks: dict[str, int], costs: dict[str, int]) -> tuple[int, list[int], list[int]]:
    """Where the prefix ends, the keys under which the word looks for others by its pivots, and those under which it is found.

    A key names a bigram, its place and the length in the word that is found, and the half of the shorter word that is equal.
    With `shared` the shorter length, an edit from place `half` on leaves the `half` first characters, another the rest.
    """
    size, grams = len(word), [word[i:i + 2] for i in range(len(word) - 1)]
    last = sorted(ranks[g] for g in grams)[min(GRAMS, len(grams)) - 1]
    prefix = [i for i, g in enumerate(grams) if ranks[g] <= last]

    def key(at: int, moved: int, chars: int, early: bool, shared: int | None = None) -> int:
        shared = shared or min(size, chars)
        part = word[:shared // 2] if early else word[size - shared + shared // 2:]
        return xxh3_64_intdigest(f"{grams[at]}{at + moved} {chars} {shared} {early} {part}") - (1 << 63)

    found = [key(i, 0, size, early, shared) for i in prefix for early in (True, False) for shared in (size, size - 1)]
    looks = []
    for at in pivots([(i, costs[grams[i]]) for i in prefix]):
        half, less = size // 2, (size - 1) // 2
        looks += [key(at, 0, size, True), key(at, 0, size, False)]
        # Another word with one character more, put in after the pivot or before it, and in the late or the early half.
        looks += [key(at, 0, size + 1, True), key(at, 1, size + 1, False)]
        looks += [key(at, 0, size + 1, False)] * (at + 2 < half) + [key(at, 1, size + 1, True)] * (at >= half)
        # One with a character less, taken from there.
        looks += [key(at, 0, size - 1, True)] * (at + 2 < size) + [key(at, -1, size - 1, False)] * (at > 0)
        looks += [key(at, 0, size - 1, False)] * (at + 2 < less) + [key(at, -1, size - 1, True)] * (at > less)
    return last, looks, found


def pivots(prefix: list[tuple[int, int]], count: int = 2, width: int = 2) -> list[int]:
    """The positions of the `count` grams of least total cost that do not overlap, from rising (position, cost).

    best[k] is the cheapest choice of k grams among those so far, by total cost and then by positions; a gram joins a
    choice of those that end before it. Two of three different positions are always two apart, so a pair exists.
    """
    table: list[list[tuple[int, list[int]] | None]] = [[(0, [])] + [None] * count]
    for j, (at, cost) in enumerate(prefix):
        before = max((i for i in range(j) if prefix[i][0] + width <= at), default=-1) + 1
        row = list(table[-1])
        for k in range(1, count + 1):
            if (base := table[before][k - 1]) is not None:
                taken = (base[0] + cost, [*base[1], at])
                row[k] = taken if row[k] is None else min(row[k], taken)
        table.append(row)
    return next(c[1] for c in reversed(table[-1]) if c is not None)


def _roots(links: DataFrame, words: DataFrame) -> DataFrame:
    """word, root: the last word on the way along `links(word, root)`, whose every step at least doubles n."""
    span = words.agg(F.max("n"), F.min("n")).first()
    steps = (span[0] // span[1]).bit_length() if span[0] else 0  # no way is longer
    while steps > 1:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        links = stored(links.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "spelling-roots")
        steps = (steps + 1) // 2
    return links
