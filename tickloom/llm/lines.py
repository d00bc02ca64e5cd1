"""Repeated runs of lines by winnowing.

A run is RUN consecutive lines that are not blank, or fewer that hold `words` words or more (WORDS if
not told; none with None). A line is deleted if it lies in a run that also begins at an earlier place,
by document id and then by line. So a repeated passage of RUN lines or of `words` words goes whatever
its lines, and what is shorter than both may stay.

Every GRAM lines are hashed; of the grams of each run the least is selected, so equal runs select
the same gram, and long texts keep about two of every W + 1 grams, W = RUN - GRAM + 1. Each selected
gram carries the hashes of the lines around it that a run could reach. It is matched with the first
place where its gram was selected, and the match is extended both ways; RUN lines or more are a
repeat. Runs that differ from the first place's are grouped by their own hash, which finds those
whose first place is another. So the result is exact and no pairs are listed. First places are
minima, which combine before the shuffle. Runs of fewer lines are grouped by their own hash.

Plain DataFrame expressions throughout. A line is what stands between line feeds, compared as it is;
blank lines (empty or spaces) are no part of runs and stay. Null and empty texts have no lines. A
null id counts as larger than any. Equal rows are one document: none repeats the other. Columns
beside the text pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.session import stored

RUN, GRAM = 3, 2
WORDS = 50
BROADCAST_BYTES = 32 << 20
NO_ID = (1 << 63) - 1


def deduplicate_lines(docs: DataFrame, words: int | None = WORDS) -> DataFrame:
    """`docs` with repeated runs cut out of the text, and line_count, lines_removed."""
    key = F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    gone = stored(repeated_lines(docs, words).toDF("_llm_key", "_llm_gone"), "lines-gone")
    held = gone.agg(F.sum(32 + 4 * F.size("_llm_gone"))).first()[0] or 0
    if held <= BROADCAST_BYTES:  # else the documents are shuffled by key
        gone = F.broadcast(gone)
    lines = F.split(F.col("text").cast("string"), "\n")
    kept = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains("_llm_gone", i)), "\n")
    count = F.coalesce(F.size(F.filter(lines, lambda x: F.trim(x) != "")), F.lit(0)).cast("long")
    count = F.when(F.col("text").isNull(), F.lit(0).cast("long")).otherwise(count)
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("text", "line_count", "lines_removed")]
    return docs.join(gone, key == gone["_llm_key"], "left").select(
        *others, F.when(F.col("_llm_gone").isNull(), F.col("text")).otherwise(kept).alias("text"),
        count.alias("line_count"), F.coalesce(F.size("_llm_gone"), F.lit(0)).cast("long").alias("lines_removed"))


def repeated_lines(docs: DataFrame, words: int | None = WORDS) -> DataFrame:
    """gone_key, gone: for each document with repeats, their places among all its lines."""
    marks = selected(docs)
    first = marks.groupBy("gram").agg(F.min(F.struct("id", "p", "context", "before")).alias("f"))
    first = stored(first.select("gram", F.col("f.id").alias("f_id"), F.col("f.p").alias("f_p"),
                                F.col("f.context").alias("f_context"), F.col("f.before").alias("f_before")), "lines-first")
    met = marks.join(first, "gram").withColumn("own", (F.col("id") == F.col("f_id")) & (F.col("p") == F.col("f_p")))
    # Equal lines to the left and right of the gram, from the gram outwards.
    left = F.expr(
        "size(filter(sequence(1, greatest(before, 1)), n -> n <= least(before, f_before) AND "
        "slice(context, before - n + 1, n) = slice(f_context, f_before - n + 1, n)))")
    right = F.expr(
        f"size(filter(sequence(1, greatest(size(context) - before - {GRAM}, 1)), n -> "
        f"n <= least(size(context) - before, size(f_context) - f_before) - {GRAM} AND "
        f"slice(context, before + {GRAM + 1}, n) = slice(f_context, f_before + {GRAM + 1}, n)))")
    met = met.withColumn("left", left).withColumn("right", right)
    long_ = ~F.col("own") & (F.col("left") + F.col("right") + GRAM >= RUN)
    spans = met.filter(long_).select("key", F.expr(f"sequence(p - left, p + {GRAM - 1} + right)").alias("at"))
    # The runs around the gram that the first place does not have, by their own hash.
    runs = met.filter(~F.col("own")).select("key", "id", F.explode(F.expr(
        f"transform(filter(sequence(0, size(context) - {RUN}), i -> i <= before AND i + {RUN} >= before + {GRAM} "
        f"AND NOT (i >= before - left AND i + {RUN} <= before + {GRAM} + right)), "
        f"i -> struct(p - before + i AS begin, xxhash64(slice(context, i + 1, {RUN})) AS run))")).alias("r")).select("key", "id", "r.*")
    runs = stored(runs, "lines-runs")
    lead = stored(runs.groupBy("run").agg(F.min(F.struct("id", "begin")).alias("lead")), "lines-lead")
    later = runs.join(lead, "run").filter(F.struct("id", "begin") > F.col("lead"))
    spans = spans.unionByName(later.select("key", F.expr(f"sequence(begin, begin + {RUN - 1})").alias("at")))
    if words is not None:
        spans = spans.unionByName(_short_repeats(docs, words))
    places = spans.groupBy("key").agg(F.array_distinct(F.flatten(F.collect_set("at"))).alias("at"))
    # From places among lines that are not blank to places among all lines.
    found = docs.select(_key(), _lines()).dropDuplicates(["key"]).join(places, "key")
    return found.select(F.col("key").alias("gone_key"), F.expr("transform(at, x -> lines[x].i)").alias("gone"))


def _short_repeats(docs: DataFrame, words: int) -> DataFrame:
    """key, at: later runs of under RUN lines that hold `words` words."""
    rows = docs.select(_key(), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.expr(
        "filter(transform(split(coalesce(CAST(text AS STRING), ''), '\\n'), x -> struct(xxhash64(x) AS h, "
        "size(filter(split(x, '\\\\s+'), y -> y <> '')) AS w, trim(x) = '' AS blank)), x -> NOT x.blank)").alias("lines"))
    rows = rows.dropDuplicates(["key"])
    each = [F.expr(
        f"CASE WHEN size(lines) >= {n} THEN filter(transform(sequence(0, size(lines) - {n}), i -> struct(i AS begin, {n} AS n, "
        f"xxhash64(slice(lines.h, i + 1, {n})) AS run, aggregate(slice(lines.w, i + 1, {n}), 0L, (a, w) -> a + w) AS w)), "
        f"r -> r.w >= {int(words)}) ELSE array() END") for n in range(1, RUN)]
    runs = rows.select("key", "id", F.explode(F.concat(*each)).alias("r")).select("key", "id", "r.begin", "r.n", "r.run")
    runs = stored(runs, "lines-short")
    lead = stored(runs.groupBy("n", "run").agg(F.min(F.struct("id", "begin")).alias("lead")), "lines-short-lead")
    later = runs.join(lead, ["n", "run"]).filter(F.struct("id", "begin") > F.col("lead"))
    return later.select("key", F.expr("sequence(begin, begin + n - 1)").alias("at"))


def _key():
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")).alias("key")


def _lines():
    return F.expr("filter(transform(split(coalesce(CAST(text AS STRING), ''), '\\n'), (x, i) -> "
                  "struct(i AS i, xxhash64(x) AS h, trim(x) = '' AS blank)), x -> NOT x.blank)").alias("lines")


def selected(docs: DataFrame) -> DataFrame:
    """key, id, gram, p (its first line), context (line hashes a run could reach), before (of p)."""
    reach = RUN - GRAM
    rows = docs.select(_key(), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), _lines())
    rows = rows.filter(F.size("lines") >= RUN).dropDuplicates(["key"])
    rows = rows.select("key", "id", F.col("lines.h").alias("h"))
    rows = rows.withColumn("g", F.expr(
        f"transform(sequence(0, size(h) - {GRAM}), i -> xxhash64(slice(h, i + 1, {GRAM})))"))
    picks = F.array_distinct(F.expr(
        f"transform(sequence(0, size(h) - {RUN}), j -> CAST(j + array_position(slice(g, j + 1, {reach + 1}), "
        f"array_min(slice(g, j + 1, {reach + 1}))) - 1 AS int))"))
    rows = rows.select("key", "id", "h", "g", F.explode(picks).alias("p"))
    before = F.least(F.col("p"), F.lit(reach))
    return stored(rows.select(
        "key", "id", F.expr("g[p]").alias("gram"), "p", before.alias("before"),
        F.expr(f"slice(h, p - least(p, {reach}) + 1, least(p, {reach}) + {RUN})").alias("context")), "lines-selected")
