"""The whole quality query against the same rules written out row by row."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_classifiers import EDGES, quality_corpus
from tickloom.llm import cotraining

SIGNS = "!?*$%&#|.,;:-_/@<>()[]{}\"'="


def text_features(text):
    text = text or ""
    words, plain = text.split(), re.findall(r"[^\W\d_]+", text)
    lines = [x for x in text.split("\n") if x.strip()]
    n, m, k = max(len(text), 1), max(len(words), 1), max(len(plain), 1)
    times = Counter(words)
    out = [text.count(sign) / m for sign in SIGNS]
    out += [sum(w.isupper() for w in words) / m, sum(c.isdigit() for c in text) / n]
    out += [sum(len(w) for w in plain) / (10 * k), len(plain) / m, len(times) / m]
    out += [max(times.values(), default=0) / m, sum(w.lower() in cotraining._COMMON for w in plain) / k]
    out += [1 - len(set(lines)) / max(len(lines), 1), len(lines) / m, max([len(w) for w in words], default=0) / 100]
    out.append(math.log(1 + len(words)) / 10)
    hashed = [0] * cotraining.WORDS
    for w in plain:
        hashed[zlib.crc32(w.lower().encode()) % cotraining.WORDS] += 1
    return out + [math.sqrt(h / k) for h in hashed]


def page_features(lang, source, n_chars):
    out = [0.0] * 128
    out[zlib.crc32(repr(lang).encode()) % 64] = 1.0
    out[64 + zlib.crc32(repr(source).encode()) % 64] = 1.0
    return out + [math.log1p(n_chars) / 10 if n_chars is not None else 0.0, float(n_chars is None)]


def newton(x, y, ridge, enough):
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-x @ w))
        move = np.linalg.solve(x.T @ np.diag(p * (1 - p)) @ x + ridge * np.eye(len(w)), x.T @ (p - y) + ridge * w)
        w = w - move
        if abs(move).max() < enough:
            return w
    return w


class Model:
    def __init__(self, x, y, enough):
        self.middle, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        self.w = newton(self.wide(x), y, 0.02 * len(x), enough)

    def wide(self, x):
        return np.c_[np.clip((x - self.middle) / self.scale, -8, 8), np.ones(len(x))]

    def logit(self, x):
        return self.wide(x) @ self.w


def lowest(place, chance, quota):
    """The rows in the lowest places, of the last place a part by chance."""
    for at in sorted(set(place)):
        under, here = sum(place < at), sum(place == at)
        if under + here >= quota:
            return (place < at) | ((place == at) & (chance < (quota - under) / here))
    raise AssertionError


def brute(rows, labels, chances):
    """rows: (id, text, lang, source, n_chars); labels by id; chances by id. Scores by row: text, page, score."""
    views = [np.array([text_features(r[1]) for r in rows]), np.array([page_features(*r[2:]) for r in rows])]
    held = np.array([r[0] is not None and zlib.crc32(str(r[0]).encode()) % 4 == 2 for r in rows])
    known = np.array([r[0] in labels for r in rows])
    y = np.array([float(labels.get(r[0], 0)) for r in rows])
    checks = np.array([zlib.crc32(f"calibrate {r[0]}".encode()) % 4 == 0 for r in rows])
    learn, check = known & ~held & ~checks, known & ~held & checks
    pool = np.array([r[0] is not None for r in rows]) & ~known & ~held
    chance = np.array([chances.get(r[0], 0.0) for r in rows])
    given = [np.full(len(rows), np.nan) for _ in views]
    models = [Model(v[learn], y[learn], 1e-6) for v in views]
    for _ in range(5):
        quota = None
        for side, model in enumerate(models):
            free = np.flatnonzero(pool & np.isnan(given[0]) & np.isnan(given[1]))
            good = y[learn].mean()
            quota = quota or [max(1, int(0.05 * len(free) * share)) for share in (1 - good, good)]
            if len(free) < sum(quota):
                break
            place = np.clip(np.floor(model.logit(views[side][free]) * 100) + 3000, 0, 5999)
            bad = lowest(place, chance[free], quota[0])
            # From above the part of the bounding place goes to the highest chances.
            best = lowest(-place, 1 - chance[free], quota[1]) & ~bad
            given[1 - side][free[bad]], given[1 - side][free[best]] = 0.0, 1.0
        taught = [learn | ~np.isnan(g) for g in given]
        models = [Model(v[t], np.where(np.isnan(g), y, g)[t], 1e-3) for v, t, g in zip(views, taught, given, strict=True)]
    logits = []
    for model, v in zip(models, views, strict=True):
        slope, shift = newton(np.c_[model.logit(v[check]), np.ones(check.sum())], y[check], 0.01, 1e-6)
        logits.append(slope * model.logit(v) + shift)
    both = np.c_[logits[0], logits[1], np.ones(len(rows))]
    logits.append(both @ newton(both[check], y[check], 0.01, 1e-6))
    return [1 / (1 + np.exp(-z)) for z in logits], sum(~np.isnan(g) for g in given).sum()


def test_quality_equals_brute_force(spark, make):
    plain, labels = quality_corpus(700)
    # Some labels are wrong, so that the views end with weights and not with certainty.
    labels = [(i, q if i % 11 else 1 - q, t) for i, q, t in labels]
    docs = make([*plain, *EDGES], clash=True).cache()
    out = cotraining.quality(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert out.columns == ["doc_id", "held_out", "text_score", "page_score", "score", "kept"]
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    chance = docs.select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit("chance")), F.lit(1 << 30)) / (1 << 30))
    expected, taught = brute(rows, {i: q for i, q, _ in labels}, {i: c for i, c in chance.collect() if i is not None})
    assert taught > 50
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    got = sorted(((r.doc_id, r.text_score, r.page_score, r.score) for r in out.collect()), key=key)
    want = sorted(zip([r[0] for r in rows], *expected, strict=True), key=key)
    assert [g[0] for g in got] == [w[0] for w in want]
    assert np.array([g[1:] for g in got]) == pytest.approx(np.array([w[1:] for w in want]), abs=1e-6)
