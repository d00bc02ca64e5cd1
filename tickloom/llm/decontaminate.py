"""Benchmark decontamination with a broadcast set of word windows.

A window is `size` consecutive words of an item, or all words of a shorter item. Blocks of half a
window, of which every window holds a whole one, are hashed and looked up, and around those that are
known, the windows; a hit counts only where the words themselves are equal.
Plain DataFrame expressions throughout: one pass over the texts, one shuffle of a row per document
and one per hit.

The set of windows is broadcast below BROADCAST_BYTES, which its rows are measured against. A
larger benchmark is joined by a shuffle on two independent hashes, without texts.

Null and empty texts have no words: no hit, and as an item no window. Items that share a window
are all listed; an item without id is matched but not listed. Every row of the documents gets a
row, repeated rows and null ids included. Other columns of either table are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.session import stored

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BROADCAST_BYTES = 32 << 20


def words(text: Column) -> Column:
    """A-Z lower-cased only; `lower` does just that where every character is one byte."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    lowered = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _UPPER.lower()))
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def item_windows(benchmark: DataFrame, size: int) -> DataFrame:
    """length, h, g (two hashes), text, words, items: one row for each different window."""
    split = benchmark.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("w"))
    rows = split.withColumn("length", F.least(F.size("w"), F.lit(size))).filter("length > 0")
    rows = rows.select("item", "length", F.explode(F.expr(
        "transform(sequence(0, size(w) - length), i -> slice(w, i + 1, length))")).alias("words"))
    rows = rows.groupBy("length", "words").agg(F.collect_set("item").alias("items"))
    return rows.select(
        "length", F.xxhash64("words").alias("h"), F.hash("words").alias("g"),
        F.array_join("words", " ").alias("text"), "words", "items")


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and `hit_words` (positions)."""
    split = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", words(F.col("text")).alias("w"))
    return _hits(split, benchmark, size, ["row", "doc_id", "n_words"], every_row=True).select(
        "doc_id", "n_words", F.size("hit_words").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hit_words") > 0).alias("contaminated"), "hit_words",
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = 10, whole: bool = True) -> DataFrame:
    """The documents with all their columns, without those that hold a window (`whole`), or with
    the words of windows, and what separates each from the word before it, cut out of their text."""
    key = F.xxhash64("doc_id", "text")
    split = docs.select(key.alias("hit_key"), words(F.col("text")).alias("w"))
    found = stored(_hits(split, benchmark, size, ["hit_key"]).select(F.col("hit_key").alias("_llm_key"), F.col("hit_words").alias("_llm_hits")), "contaminated")
    held = found.agg(F.sum(32 + 4 * F.size("_llm_hits"))).first()[0] or 0
    if held <= BROADCAST_BYTES:  # else the documents are shuffled by key
        found = F.broadcast(found)
    if whole:
        return docs.join(found, key == found["_llm_key"], "left_anti")
    pieces = F.regexp_extract_all("text", F.lit(NOT_WORD + ANY_CASE_WORD), F.lit(0))
    kept = F.filter(pieces, lambda x, i: ~F.array_contains("_llm_hits", i))
    cut = F.concat(F.array_join(kept, ""), F.regexp_extract("text", f"({NOT_WORD})$", 1))
    text = F.when(F.col("_llm_hits").isNotNull(), cut).otherwise(F.col("text"))
    return docs.join(found, key == found["_llm_key"], "left").withColumn("text", text).select(docs.columns)


def _hits(split: DataFrame, benchmark: DataFrame, size: int, by: list[str], every_row: bool = False) -> DataFrame:
    """For rows with words `w`: `by`, hit_words (sorted positions), items (sorted)."""
    known = item_windows(benchmark, size)
    width = F.octet_length("text") + 16 * F.size("items") + 64
    found = {r["length"]: r["width"] for r in known.groupBy("length").agg(F.sum(width).alias("width")).collect()}
    lengths = sorted(found)  # at most `size`
    small = sum(found.values()) <= BROADCAST_BYTES
    hits = (_by_blocks if small else _by_shuffle)(split.withColumn("n_words", F.size("w").cast("long")), known, lengths, by, every_row)
    hit = F.when(F.col("pos") >= 0, F.expr("sequence(pos, pos + l - 1)"))
    grouped = hits.groupBy(*by).agg(F.collect_list(hit).alias("spans"), F.collect_set("items").alias("items"))
    return grouped.select(
        *by, F.array_sort(F.array_distinct(F.flatten("spans"))).alias("hit_words"),
        F.array_sort(F.array_distinct(F.flatten("items"))).alias("items"))


def _each(parts: list[str], fields: str, every_row: bool) -> Column:
    """The rows of all parts; with `every_row` also one at -1, which stands for the document itself."""
    none = f"CAST(array() AS array<struct<{fields}>>)"
    first = f"CAST(array(struct(-1, 0{', NULL' * (fields.count(':') - 2)})) AS array<struct<{fields}>>)"
    return F.inline(F.expr(f"concat({', '.join([none, *([first] if every_row else []), *parts])})"))


def _by_blocks(split: DataFrame, known: DataFrame, lengths: list[int], by: list[str], every_row: bool) -> DataFrame:
    """Hits of a broadcast set. A window of n words holds a whole block of b = (n + 1) / 2 words that
    begins at a multiple of b, so only those are hashed; where one is known, the windows around it are."""
    fields, how = "pos: int, l: int, hx: bigint", "left" if every_row else "inner"
    blocks = []
    for n in lengths:
        b = (n + 1) // 2
        blocks.append(
            f"transform(CASE WHEN size(w) >= {n} THEN sequence(0, size(w) - {b}, {b}) ELSE CAST(array() AS array<int>) END, "
            f"i -> struct(i AS pos, {n} AS l, xxhash64(slice(w, i + 1, {b})) AS hx))")
    half = F.floor((F.col("length") + 1) / 2).cast("int")
    starts = known.select("length", half.alias("b"), F.explode(F.sequence(F.lit(0), F.col("length") - half)).alias("at"), "words")
    starts = starts.select("length", F.expr("xxhash64(slice(words, at + 1, b))").alias("block")).distinct()
    rows = split.select(*by, "w", _each(blocks, fields, every_row))
    rows = rows.join(F.broadcast(starts), (F.col("hx") == F.col("block")) & (F.col("l") == F.col("length")), how)
    rows = rows.filter("pos < 0 OR block IS NOT NULL").drop("length", "block", "hx")
    around = ("CASE WHEN pos < 0 THEN array(pos) ELSE sequence("
              "greatest(0, pos + div_half - l), least(size(w) - l, pos)) END").replace("div_half", "CAST(floor((l + 1) / 2) AS int)")
    rows = rows.select(*by, "w", "l", F.explode(F.expr(around)).alias("pos"))
    rows = rows.withColumn("hx", F.expr("CASE WHEN pos >= 0 THEN xxhash64(slice(w, pos + 1, l)) END"))
    same = (F.col("hx") == F.col("h")) & (F.col("l") == F.col("length"))
    rows = rows.join(F.broadcast(known.select("length", "h", "text", "items")), same, how)
    return rows.filter((F.col("pos") < 0) | (F.array_join(F.expr("slice(w, pos + 1, l)"), " ") == F.col("text")))


def _by_shuffle(split: DataFrame, known: DataFrame, lengths: list[int], by: list[str], every_row: bool) -> DataFrame:
    """Hits of a set too large to broadcast: every window by two hashes, without words."""
    parts = [
        f"transform(CASE WHEN size(w) >= {n} THEN sequence(0, size(w) - {n}) ELSE CAST(array() AS array<int>) END, "
        f"i -> struct(i AS pos, {n} AS l, xxhash64(slice(w, i + 1, {n})) AS hx, hash(slice(w, i + 1, {n})) AS gx))"
        for n in lengths]
    rows = split.select(*by, _each(parts, "pos: int, l: int, hx: bigint, gx: int", every_row))
    same = (F.col("hx") == F.col("h")) & (F.col("gx") == F.col("g")) & (F.col("l") == F.col("length"))
    rows = rows.join(known.drop("text", "words"), same, "left" if every_row else "inner")
    return rows.filter((F.col("pos") < 0) | F.col("h").isNotNull())
