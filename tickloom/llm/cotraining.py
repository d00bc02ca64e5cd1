"""A quality classifier of two views that teach each other.

One view sees the content of a text (its words, hashed to WORDS slots, and shares of kinds of characters,
words and lines), the other what is known about the page (language, source, size). Both are logistic models. Each starts from
the labelled rows; in every round each names the rows without label that it is surest of, in the
proportion of the labels, and these join the other's training rows. In the end each view is
calibrated on labelled rows that it never saw, and the calibrated views are combined there too.

Learned from are at most FIT_ROWS labelled rows, of which a quarter calibrates, the first by a hash
of their id, and all rows without label. Features are taken once, in one pass without a shuffle, and
stored; every round counts the scores of the whole corpus in BINS steps, which gives the scores that
bound the surest, and fits each view by Newton's method from sums of its statistics taken in tasks.
Of rows with a score in the step that bounds, a part by a hash of the id is named. Which rows are
taught follows from the models and bounds of the rounds before, so nothing is marked or collected.
Rows whose crc32(doc_id as text) mod 4 is 2 are held out of both. Every row is then scored.

Nulls in any column are a value of their own; an empty or null text has content features of zero, and
texts of any length are taken whole. Extra columns, whatever their names, are left out.
Repeated labels of an id count once, as good only if all are. Rows without id are scored and not
learned from. Without labels of both kinds the score is the smoothed share of good labels.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.session import stored

FIT_ROWS = 8_000
ROUNDS, SURE = 5, 0.05
BINS, PER_LOGIT, STEP = 6_000, 100, 1e-3
FAN_IN = 16
SLOTS, WORDS = 64, 128
RIDGE = 0.02  # for each row learned from
KEEP = 0.5
_WORD = re.compile(r"[^\W\d_]+")
#: Fixed list of frequent words of the four languages.
_COMMON = frozenset("the of and to in a is that it for on as with be was de la que el en y los se del las un por con una "
                    "le les et des du une est dans qui der die und das den von zu mit sich des auf für ist im dem nicht ein".split())
_SIGNS = "!?*$%&#|.,;:-_/@<>()[]{}\"'="


def content(text: str | None) -> list[float]:
    text = text or ""
    n = len(text) or 1
    words = text.split()
    m = len(words) or 1
    plain = _WORD.findall(text)
    lines = [x for x in text.split("\n") if x.strip()]
    count, known = Counter(words), Counter(map(str.lower, plain))
    slots = [zlib.crc32(w.encode("utf-8", "replace")) % WORDS for w in known]
    hashed = np.bincount(np.array(slots, int), list(known.values()), WORDS)
    return [
        *(text.count(c) / m for c in _SIGNS),
        sum(map(str.isupper, words)) / m, sum(c.isdigit() for c in text) / n,
        sum(map(len, plain)) / (10 * (len(plain) or 1)), len(plain) / m,
        len(count) / m, max(count.values(), default=0) / m,
        sum(n for w, n in known.items() if w in _COMMON) / (len(plain) or 1),
        1 - len(set(lines)) / (len(lines) or 1), len(lines) / m,
        max(map(len, words), default=0) / 100, math.log1p(len(words)) / 10,
        *np.sqrt(hashed / (len(plain) or 1)).tolist(),
    ]


#: Features of the content.
WIDTH = len(content(None))


def _short(lang: str | None, source: str | None, size: int | None) -> list[float]:
    """What is known about the page: slots of language and source, size, whether it has none."""
    return [zlib.crc32(repr(lang).encode()) % SLOTS, SLOTS + zlib.crc32(repr(source).encode()) % SLOTS,
            math.log1p(max(size, 0)) / 10 if size is not None else 0.0, float(size is None)]


class View:
    """A logistic model on scaled features, with a calibration on top."""

    def fit(self, x: np.ndarray, y: np.ndarray) -> View:
        self.middle, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        self.w = _logistic(self._scaled(x), y, RIDGE * len(x))
        self.slope, self.shift = 1.0, 0.0
        return self

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.middle) / self.scale, -8, 8)
        return np.hstack([z, np.ones((len(z), 1))])

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self._scaled(x) @ self.w

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        self.slope, self.shift = _logistic(np.stack([self.logit(x), np.ones(len(x))], 1), y)

    def calibrated(self, x: np.ndarray) -> np.ndarray:
        return self.slope * self.logit(x) + self.shift


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + ridge * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        move = np.linalg.solve(curve, slope)
        w -= move
        if np.abs(move).max() < 1e-6:
            break
    return w


def co_train(views: list[np.ndarray], y: np.ndarray, pools: list[np.ndarray]) -> list[View]:
    """The two views after ROUNDS exchanges; `views` and `pools` hold a matrix for each."""
    chance = np.arange(len(pools[0])) * 0.6180339887 % 1
    return _exchange(views, y, lambda stat: stat(pools, chance))


def _exchange(views: list[np.ndarray], y: np.ndarray, summed: Callable) -> list[View]:
    """The two views after ROUNDS exchanges; `summed(stat)` adds up stat(xs, chance) of the unlabelled rows."""
    models, steps = [View().fit(x, y) for x in views], []
    for _ in range(ROUNDS):
        quota = None
        for side, model in enumerate(models):
            def counted(xs, chance, side=side, model=model):
                free = _taught(steps, xs, chance)[1]
                return np.bincount(_place(model.logit(xs[side][free])), minlength=BINS)

            counts = summed(counted)
            free = int(counts.sum())
            quota = quota or [max(1, int(SURE * free * share)) for share in (1 - y.mean(), y.mean())]
            if free < sum(quota):
                break
            steps.append((side, model, _bound(counts, quota[0]), BINS - _bound(counts[::-1], quota[1])))
        models = _refit(views, y, steps, summed)
    return models


def _place(logit: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(logit * PER_LOGIT) + BINS // 2, 0, BINS - 1).astype(np.int64)


def _bound(counts: np.ndarray, quota: int) -> float:
    """The place under which `quota` rows lie; its fraction is the part of the last step that is taken."""
    below = np.cumsum(counts)
    at = int(np.searchsorted(below, quota))
    return at + (quota - (below[at] - counts[at])) / counts[at]


def _taught(steps: list, xs: list[np.ndarray], chance: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """For each view the labels that the other one gave, NaN without, and which rows have none yet."""
    free = np.ones(len(chance), bool)
    labels = [np.full(len(chance), np.nan) for _ in xs]
    for side, model, low, high in steps:
        place = _place(model.logit(xs[side])) + chance
        bad, good = free & (place < low), free & (place >= high)
        labels[1 - side][bad], labels[1 - side][good] = 0.0, 1.0
        free &= ~(bad | good)
    return labels, free


def _refit(views: list[np.ndarray], y: np.ndarray, steps: list, summed: Callable) -> list[View]:
    """The views on the labelled rows and all taught ones."""
    around = [x.mean(axis=0) for x in views]

    def moments(xs, chance):
        out = []
        for x, label, middle in zip(xs, _taught(steps, xs, chance)[0], around, strict=True):
            d = x[~np.isnan(label)] - middle
            out += [[len(d)], d.sum(axis=0), (d * d).sum(axis=0)]
        return np.concatenate(out)

    total, out = summed(moments), []
    for x, middle in zip(views, around, strict=True):
        width = x.shape[1]
        (n,), first, second, total = np.split(total, [1, 1 + width, 1 + 2 * width])
        n += len(x)
        new = View()
        new.middle = middle + first / n
        spread = (((x - middle) ** 2).sum(axis=0) + second) / n - (first / n) ** 2
        new.scale, new.slope, new.shift = np.sqrt(np.maximum(spread, 0)) + 1e-6, 1.0, 0.0
        new.w, new.ridge = np.zeros(width + 1), RIDGE * n
        out.append(new)
    live = [True] * len(out)
    for _ in range(25):
        def slopes(xs, chance):
            labels = _taught(steps, xs, chance)[0]
            parts = [_slope(m, x[~np.isnan(t)], t[~np.isnan(t)]) for m, x, t, on in zip(out, xs, labels, live, strict=True) if on]
            return np.concatenate(parts)

        total = summed(slopes)
        for i in [i for i, on in enumerate(live) if on]:
            m, size = out[i], len(out[i].w)
            part, total = np.split(total, [size * (size + 1)])
            part = (part + _slope(m, views[i], y)).reshape(size + 1, size)
            move = np.linalg.solve(part[1:] + m.ridge * np.eye(size), part[0] + m.ridge * m.w)
            m.w = m.w - move
            live[i] = bool(np.abs(move).max() >= STEP)
        if not any(live):
            break
    return out


def _slope(model: View, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Slope and curve of the logistic loss, one after the other."""
    z = model._scaled(x)
    p = 1 / (1 + np.exp(-np.clip(z @ model.w, -30, 30)))
    return np.concatenate([z.T @ (p - y), ((z * (p * (1 - p))[:, None]).T @ z).ravel()])


def _corpus(pool: DataFrame) -> Callable:
    """`summed` of `_exchange` over `pool(f, chance)`, a Spark pass each."""
    tasks = pool.rdd.getNumPartitions()

    def summed(stat: Callable) -> np.ndarray:
        none = stat(_views(np.zeros((0, WIDTH + 4))), np.zeros(0)).astype(float)

        def taken(batches):
            total = none
            for batch in batches:
                total = total + stat(_views(_matrix(batch.column("f").to_pylist())), batch.column("chance").to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["s"])

        def added(batches):
            total = none
            for batch in batches:
                total = sum((np.frombuffer(s) for s in batch.column("s").to_pylist()), total)
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["s"])

        out, parts = pool.mapInArrow(taken, "s binary"), tasks
        while parts > FAN_IN:
            parts = math.ceil(parts / FAN_IN)
            out = out.repartition(parts).mapInArrow(added, "s binary")
        return sum((np.frombuffer(r["s"]) for r in out.collect()), none)  # at most FAN_IN rows

    return summed


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, text_score, page_score, score, kept for every row of `docs`."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    rows = docs.select(
        F.col("doc_id"), held.alias("held_out"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"), F.col("n_chars").cast("long").alias("n_chars"))
    rows = stored(rows.select("doc_id", "held_out", _features("text", "lang", "source", "n_chars").alias("f")), "quality-features")
    score = _scorer(*_learned(rows, labels))
    out = rows.withColumn("s", score("f"))
    return out.select("doc_id", "held_out", "s.*", (F.col("s.score") >= KEEP).alias("kept"))


def _learned(rows: DataFrame, labels: DataFrame) -> tuple[list[View] | None, np.ndarray]:
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").alias("id")).agg(
        F.min(F.col("quality").cast("int")).alias("quality"))
    fit = known.filter(F.crc32(F.col("id").cast("string")) % 4 != 2).orderBy(F.xxhash64("id"), "id").limit(FIT_ROWS)
    # One row for each id, that of the least features, so at most FIT_ROWS, whatever repeats.
    table = rows.join(F.broadcast(fit), rows["doc_id"] == fit["id"]).groupBy("id", "quality").agg(F.min("f").alias("f"))
    table = table.toPandas().sort_values("id", ignore_index=True)
    y = table["quality"].to_numpy(float)
    views = _views(_matrix(table["f"].tolist()))
    check = np.array([zlib.crc32(f"calibrate {i}".encode()) % 4 == 0 for i in table["id"]], bool)
    if not len(y) or min(len(set(y[check].tolist())), len(set(y[~check].tolist()))) < 2:
        good = (y.sum() + 1) / (len(y) + 2)
        return None, np.array([math.log(good / (1 - good))])
    pool = rows.filter("doc_id IS NOT NULL AND NOT held_out").withColumnRenamed("doc_id", "id").join(known, "id", "left_anti")
    pool = pool.select("f", (F.pmod(F.xxhash64("id", F.lit("chance")), F.lit(1 << 30)) / (1 << 30)).alias("chance"))
    models = _exchange([v[~check] for v in views], y[~check], _corpus(stored(pool, "quality-pool")))
    for model, view in zip(models, views, strict=True):
        model.calibrate(view[check], y[check])
    sides = np.stack([*(m.calibrated(v[check]) for m, v in zip(models, views, strict=True)), np.ones(check.sum())], 1)
    return models, _logistic(sides, y[check])


@F.pandas_udf(T.BinaryType())
def _features(text: pd.Series, lang: pd.Series, source: pd.Series, size: pd.Series) -> pd.Series:
    sizes = [None if pd.isna(n) else int(n) for n in size]
    return pd.Series([np.array(content(t) + _short(*p)).tobytes() for t, *p in zip(text, lang, source, sizes, strict=True)])


def _matrix(rows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(rows)).reshape(-1, WIDTH + 4)


def _views(short: np.ndarray) -> list[np.ndarray]:
    """Content and page features of `_features` rows."""
    pages = np.zeros((len(short), 2 * SLOTS + 2))
    at = short[:, WIDTH:WIDTH + 2].astype(int)
    np.put_along_axis(pages, at, 1.0, axis=1)
    pages[:, -2:] = short[:, WIDTH + 2:]
    return [short[:, :WIDTH], pages]


def _scorer(models: list[View] | None, mixed: np.ndarray):
    kind = T.StructType([T.StructField(c, T.DoubleType()) for c in ("text_score", "page_score", "score")])

    @F.pandas_udf(kind)
    def scored(f: pd.Series) -> pd.DataFrame:
        if models is None or not len(f):
            logits = np.full((3, len(f)), mixed[0])
        else:
            a, b = (m.calibrated(x) for m, x in zip(models, _views(_matrix(f.tolist())), strict=True))
            logits = np.stack([a, b, mixed[0] * a + mixed[1] * b + mixed[2]])
        p = 1 / (1 + np.exp(-np.clip(logits, -500, 500)))
        return pd.DataFrame({"text_score": p[0], "page_score": p[1], "score": p[2]})

    return scored
