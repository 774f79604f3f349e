"""Toxicity: a linear classifier on character n-grams scaled by log-count ratios.

Features are the distinct character n-grams of a lower-cased text, hashed, and
those that occur ``REPEATED`` times or more once again.  Each is scaled by the naive Bayes log ratio of its smoothed document counts among
toxic and clean texts, and a logistic regression is fitted on the scaled
features.  Features whose shares differ no more than by chance are left out.

The fit uses a bounded sample of labelled rows: at most ``per_class`` distinct
texts of each label of at most ``FIT_CHARS`` characters, chosen by text hash.
Scoring is one narrow pass over whole texts.  Null and empty texts are scored by
the intercept.  Without labelled rows of both kinds every score is the share of
toxic rows (0 without any).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.llm.common import hash_limit, map_text

PER_CLASS = 3000
FIT_CHARS = 32768
SIZES = (3, 4, 5, 6, 8)
HASH_BITS = 20
MIN_DOCS = 4
REPEATED = 2
MIN_Z = 4.0
RIDGE = 1e-5
MAX_FEATURES = 20_000
THRESHOLD = 0.7
PIECE = 1 << 18


def ngram_hashes(
    codes: np.ndarray, sizes: tuple[int, ...] = SIZES, bits: int = HASH_BITS, starts: int | None = None
) -> np.ndarray:
    """Hash of every n-gram of a code point array, as feature numbers; of those at the first ``starts`` places."""
    out = []
    total = np.zeros(len(codes), np.uint32)
    factor = 1
    for n in range(1, max(sizes) + 1):
        if len(codes) < n:
            break
        factor = factor * 0x9E3779B1 & 0xFFFFFFFF
        total = total[: len(codes) - n + 1] + codes[n - 1 :] * np.uint32(factor)
        if n in sizes:
            part = total[:starts]
            h = (part ^ (part >> np.uint32(15))) * np.uint32(0x85EBCA6B + 2 * n)
            out.append((h ^ (h >> np.uint32(13))) >> np.uint32(32 - bits))
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def code_points(text: str | None) -> np.ndarray:
    return np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le", "surrogatepass"), "<u4")


def _repeated(features: np.ndarray) -> np.ndarray:
    """Feature numbers that say that an n-gram occurs ``REPEATED`` times or more."""
    return (features * np.uint32(0x9E3779B1) + np.uint32(0x7F4A7C15)) >> np.uint32(32 - HASH_BITS)


def _features(text: str | None, look: np.ndarray | None) -> np.ndarray:
    """Feature numbers of a whole text, taken in pieces of bounded size.

    ``look`` marks the n-grams that matter; None takes all.
    """
    codes = code_points(text)
    found, counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)
    for at in range(0, max(1, len(codes)), PIECE):
        h = ngram_hashes(codes[at : at + PIECE + max(SIZES) - 1], starts=PIECE)
        one, n = np.unique(h if look is None else h[look[h]], return_counts=True)
        if len(found):
            found, where = np.unique(np.concatenate([found, one]), return_inverse=True)
            counts = np.bincount(where, weights=np.concatenate([counts, n])).astype(np.int64)
        else:
            found, counts = one, n
    return np.unique(np.concatenate([found, _repeated(found[counts >= REPEATED])]))


@dataclass
class NgramClassifier:
    look: np.ndarray  # n-grams that matter, alone or repeated
    weight: np.ndarray  # zero for features without a part in the score
    bias: float

    def score(self, text: str | None) -> float:
        z = self.bias + float(self.weight[_features(text, self.look)].sum())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit_texts(texts: list[str], toxic: list[int], rounds: int = 200) -> NgramClassifier:
    """The classifier of labelled texts."""
    size = 1 << HASH_BITS
    y = np.array(toxic, np.float32)
    counts = np.zeros((2, size), np.float32)
    for text, label in zip(texts, toxic, strict=True):
        counts[label][_features(text, None)] += 1
    share = y.mean() if len(y) else 0.0
    if not 0 < share < 1:
        bias = 30.0 if share else -30.0
        return NgramClassifier(np.zeros(size, bool), np.zeros(size, np.float32), bias)
    n = np.array([(y == 0).sum(), (y == 1).sum()], np.float32)
    ratio = np.log((counts[1] + 1) / (n[1] + 2)) - np.log((counts[0] + 1) / (n[0] + 2))
    # Only features whose shares differ by more than chance are worth a weight.
    both = counts.sum(axis=0)
    pooled = np.sqrt(np.maximum(both, 1) / n.sum() * (1 / n).sum())
    z = np.abs(counts[1] / n[1] - counts[0] / n[0]) / pooled
    useful = (both >= MIN_DOCS) & (z >= MIN_Z)
    best = np.flatnonzero(useful)
    best = best[np.argsort(-z[best], kind="stable")[:MAX_FEATURES]]
    keep = np.zeros(size, bool)
    keep[best] = True
    every = np.arange(size, dtype=np.uint32)
    look = keep | keep[_repeated(every)]
    rows = [r[keep[r]] for r in (_features(t, look) for t in texts)]
    flat = np.concatenate(rows) if rows else np.zeros(0, np.uint32)
    of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    value = ratio[flat]
    # Each class counts half, whatever its share; Adam on the whole sample.
    cost = np.where(y == 1, 0.5 / n[1], 0.5 / n[0])
    w, b = np.zeros(size, np.float32), 0.0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, rounds + 1):
        z = np.bincount(of, weights=value * w[flat], minlength=len(rows)) + b
        wrong = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * cost
        g = np.bincount(flat, weights=value * wrong[of], minlength=size).astype(np.float32) + RIDGE * w
        gb = wrong.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        fix = np.sqrt(1 - 0.999**t) / (1 - 0.9**t)
        w -= 0.02 * fix * m / (np.sqrt(v) + 1e-9)
        b -= 0.02 * fix * mb / (np.sqrt(vb) + 1e-9)
    return NgramClassifier(look, w * ratio * keep, float(b))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    per_class: int = PER_CLASS,
    fit_chars: int = FIT_CHARS,
) -> NgramClassifier:
    """Fit on a bounded sample of ``docs`` with a label; rows without text or label are left out.

    Only hashes are joined with the labels; the texts of the chosen ones follow
    by broadcast of at most ``2 * per_class`` hashes.
    """
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(text).alias("text")).where(
        F.col("text").isNotNull() & (F.length("text") <= fit_chars)
    )
    rows = rows.withColumn("h", F.xxhash64("text"))
    known = labels.select(F.col(f"`{key}`").alias("key"), F.col(label).alias("label")).where(F.col("label").isin(0, 1))
    marked = rows.select("key", "h").join(known, "key").select("label", "h").distinct()
    # Copies of a text must not fill the sample: choose among distinct hashes.
    chosen = []
    for r in marked.groupBy("label").count().orderBy("label").collect():
        one = marked.where((F.col("label") == r["label"]) & (F.col("h") <= hash_limit(per_class, r["count"])))
        chosen += one.orderBy("h").limit(per_class).collect()
    if not chosen:
        return fit_texts([], [])
    wanted = docs.sparkSession.createDataFrame([(int(r["label"]), r["h"]) for r in chosen], "label int, h long")
    found = rows.join(F.broadcast(wanted), "h").groupBy("label", "h").agg(F.min("text").alias("text"))
    got = found.orderBy("label", "h").collect()
    return fit_texts([r["text"] for r in got], [r["label"] for r in got])


def score(docs: DataFrame, model: NgramClassifier, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``."""
    shared = docs.sparkSession.sparkContext.broadcast((model.look, model.weight, model.bias))

    def start() -> Callable:
        m = NgramClassifier(*shared.value)

        def run(texts: list) -> list:
            scores = [m.score(t) for t in texts]
            return [scores, [int(s >= threshold) for s in scores]]

        return run

    return map_text(docs, text, start, [("score", T.DoubleType()), ("predicted", T.IntegerType())])


def drop_toxic(docs: DataFrame, model: NgramClassifier, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score under the threshold, with their own columns."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(text).alias("text"))
    return score(packed, model, "text", threshold).where("predicted = 0").select("doc.*")
