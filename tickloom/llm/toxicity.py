"""A toxicity classifier that swapping identity terms does not move.

A logistic model over the words of a text and their first 4 to 6 letters, as present or absent.
Features are chosen by chi-square. Every labelled text that mentions an identity term is copied with
that term swapped for each other one of its group, and the change that the swap makes to the score is
penalised; so a neutral mention of a group scores as if it named any other group.

Labels of at most FIT_ROWS rows (the first in the order of a hash of their id) are learned from;
their features are counted and cut to FEATURES in tasks, and only that matrix and what the swaps change
in it reach the driver.
Every text is scored whole, in one pass without a shuffle. Nothing but the text enters a score.

A null or empty text scores as one without any feature. A row whose id is null has no label and is
not held out. Repeated labels of an id count once, as toxic if any of them is, and of repeated ids the
text of the least hash is learned from, so the result does not hang on how rows lie. Without labels of
both kinds nothing is learned: the model has no weights, and the score is the smoothed share of toxic
labels for all. Texts of any length are taken whole.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FIT_ROWS = 10_000
FEATURES = 512
THRESHOLD = 0.3
PREFIXES = (4, 5, 6)
SWAP_PENALTY, RIDGE, STEPS = 1.0, 1e-5, 600

#: Fixed groups of terms that name people, to be swapped for each other.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "transgender"),
    ("woman", "man", "girl", "boy"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist", "catholic"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists", "catholics"),
    ("black", "white", "asian", "latino", "african", "european", "american"),
    ("gay", "straight", "lesbian", "bisexual", "heterosexual", "homosexual"),
    ("disabled", "blind", "deaf", "old", "young"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("christen", "muslime", "juden", "hindus"),
    ("femmes", "hommes", "filles", "garçons"),
    ("chrétiens", "musulmans", "juifs", "hindous"),
    ("mujeres", "hombres", "niñas", "niños"),
    ("cristianos", "musulmanes", "judíos", "hindúes"),
)

_WORD = re.compile(r"[^\W\d_]+")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def features(text: str | None) -> set[str]:
    return _of_words(set(_WORD.findall(text.lower())) if text else set())


def _of_words(found: set[str]) -> set[str]:
    return found | {f"{w[:k]}~" for w in found for k in PREFIXES if len(w) > k}


class Model:
    """Weights by feature and a bias."""

    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias = weights, bias

    def score(self, text: Column) -> Column:
        bias = self.bias
        whole = {f: w for f, w in self.weights.items() if f[-1:] != "~"}
        starts = [(k, cut) for k in PREFIXES if (cut := {f[:k]: w for f, w in self.weights.items() if f[k:] == "~"})]

        def logit(text: str | None) -> float:
            """bias plus the weights of features(text)"""
            found = set(_WORD.findall(text.lower())) if text else set()
            total = bias + sum(map(whole.__getitem__, found & whole.keys()))
            for k, cut in starts:
                total += sum(map(cut.__getitem__, {w[:k] for w in found if len(w) > k} & cut.keys()))
            return total

        @F.pandas_udf("double")
        def scored(texts: pd.Series) -> pd.Series:
            logits = np.array([logit(t) for t in texts], float)
            return pd.Series(1 / (1 + np.exp(-np.clip(logits, -500, 500))))

        return scored(text.cast("string"))


def fit(docs: DataFrame, labels: DataFrame, terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS) -> Model:
    """Learn from the labels of rows that are not held out. `terms` are the groups of words that are swapped, in lower case."""
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").alias("id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = known.orderBy(F.xxhash64("id"), "id").limit(FIT_ROWS)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(
        F.broadcast(known), F.col("doc_id") == F.col("id"))  # at most FIT_ROWS rows
    # One text for each id, so that no more than FIT_ROWS rows are learned from, whatever repeats.
    rows = rows.groupBy("id", "toxic").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    listed = rows.select("id", "toxic", _features_of("text").alias("found")).cache()
    try:
        total, toxic = listed.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
        if toxic in (0, total):
            return Model({}, math.log((toxic + 1) / (total - toxic + 1)))
        chosen = _chosen(listed, total, toxic, terms)
        place = {f: i for i, f in enumerate(chosen)}
        kept = listed.select("id", "toxic", _cut(place)("found").alias("at"), _swapped(place, terms)("found").alias("swaps")).toPandas()
    finally:
        listed.unpersist()
    kept = kept.sort_values("id", ignore_index=True)
    x = np.zeros((len(kept), len(chosen)), np.float32)
    for row, at in enumerate(kept["at"]):
        x[row, at] = 1
    y = kept["toxic"].to_numpy(np.float32)
    weights, bias = _descend(x, y, _swaps(kept["swaps"], len(kept), len(place)))
    return Model({f: float(w) for f, w in zip(chosen, weights, strict=True)}, float(bias))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _features_of(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: sorted(features(t)))


def _cut(place: dict[str, int]):
    @F.pandas_udf("array<int>")
    def cut(found: pd.Series) -> pd.Series:
        return found.map(lambda fs: [place[f] for f in fs if f in place])
    return cut


def _chosen(listed: DataFrame, total: int, toxic: int, terms: tuple[tuple[str, ...], ...]) -> list[str]:
    """The features that tell most about the label, and those of the identity terms."""
    counts = listed.select("toxic", F.explode("found").alias("f")).groupBy("f").agg(
        F.sum("toxic").alias("a"), F.count("*").alias("n")).filter("n >= 5")
    gap = F.col("a") * total - F.col("n") * toxic
    chi = gap * gap / (F.col("n") * (total - F.col("n") + 1))
    best = [r["f"] for r in counts.orderBy(chi.desc(), "f").limit(FEATURES).collect()]
    return sorted({*best, *(f for group in terms for term in group for f in features(term))})


def _swapped(place: dict[str, int], terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS):
    """For each swapped copy of a text the features that it lacks, as -1 - place, and those that it has in addition."""
    @F.pandas_udf("array<array<int>>")
    def swapped(found: pd.Series) -> pd.Series:
        def copies(fs: list[str]) -> list[list[int]]:
            words, out = {f for f in fs if f[-1] != "~"}, []
            for group in terms:
                for a in words & set(group):
                    for b in group:
                        if b != a:
                            new = _of_words(words - {a} | {b})
                            out.append(sorted([-1 - place[f] for f in set(fs) - new if f in place]
                                              + [place[f] for f in new - set(fs) if f in place]))
            return sorted(out)
        return found.map(copies)
    return swapped


def _swaps(swaps: pd.Series, texts: int, size: int) -> np.ndarray:
    """The products of what the swaps change in every two features, summed over the copies, for each text."""
    out = np.zeros((size, size))
    for copy in (c for copies in swaps for c in copies):
        at = np.array(copy, int)
        sign = np.where(at < 0, -1.0, 1.0)
        at = np.where(at < 0, -1 - at, at)
        out[np.ix_(at, at)] += np.outer(sign, sign)
    return (out / texts).astype(np.float32)


def _descend(x: np.ndarray, y: np.ndarray, swaps: np.ndarray) -> tuple[np.ndarray, float]:
    """Adam on the log loss, the ridge and the squared score change of the swaps."""
    rate = y.mean()
    w, bias = np.zeros(x.shape[1], np.float32), float(np.log(rate / (1 - rate)))
    first, second = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, STEPS + 1):
        error = 1 / (1 + np.exp(-(x @ w + bias))) - y
        slope = x.T @ error / len(y) + RIDGE * w + 2 * SWAP_PENALTY * (swaps @ w)
        slope = np.append(slope, error.mean())
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope ** 2
        move = 0.1 * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
        w, bias = (w - move[:-1]).astype(np.float32), bias - move[-1]
    return w, bias


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of `docs`."""
    model = fit(docs, labels)
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), model.score(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
