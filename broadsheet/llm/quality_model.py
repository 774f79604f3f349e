"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of each document are counts and shares over the whole text
(letters, digits, symbols, lines, words), computed on its code points with numpy
inside the tasks.  A bounded sample of
labelled rows, ``per_class`` distinct texts of each label chosen by text hash,
is binned at its quantiles, and trees of depth ``MAX_DEPTH`` are grown on
gradient and hessian histograms of the logistic loss.  The trees are flattened
into arrays (feature, threshold, left, right, value per node); scoring walks
all trees for a whole Arrow batch at once with numpy, one step per level.

Null and empty texts have all statistics zero and are scored like any other
row.  Without labelled rows of both kinds every score is the share of label 1
(0 without any).  Repeated rows get equal scores; extra columns are kept, and a
column named like a statistic, ``score`` or ``predicted`` is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.llm.common import hash_limit, map_text

PER_CLASS = 20_000
BINS = 64
ROUNDS = 150
MAX_DEPTH = 4
LEARNING_RATE = 0.1
MIN_LEAF = 20
L2 = 1.0
THRESHOLD = 0.7


_BULLET = re.compile(r"\s*([-*•‣·]|\d+[.)])\s")
_ENDS = frozenset(".!?\"'”)")
# Classes of the ASCII code points; all others count as letters and as non-ASCII.
_LETTER, _UPPER, _DIGIT, _PUNCT, _SYMBOL, _SPACE = (np.zeros(128, bool) for _ in range(6))
for _c in range(128):
    _ch = chr(_c)
    _LETTER[_c], _UPPER[_c], _DIGIT[_c] = _ch.isalpha(), _ch.isupper(), _ch.isdigit()
    _PUNCT[_c] = _ch in "!\"'(),-.:;?[]{}"
    _SYMBOL[_c] = _ch in "#*$%&|<>@~^_=+\\/"
    _SPACE[_c] = _ch.isspace()


def statistics(text: str | None) -> list[float]:
    """Statistics of a whole text, in the order of ``FEATURES``; zero for null and empty texts."""
    t = text or ""
    codes = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), "<u4")
    low = np.minimum(codes, 127)
    wide = codes > 127
    chars = len(codes)
    letters = int(_LETTER[low].sum() + wide.sum())
    words = t.split()
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    lines = [x for x in t.split("\n") if x.strip()]
    starts = np.flatnonzero(~_SPACE[low] & np.concatenate([[True], _SPACE[low[:-1]]])) if chars else np.zeros(0, np.int64)

    def share(part: float, whole: float) -> float:
        return float(part) / whole if whole else 0.0

    n_words, n_lines = len(words), len(lines)
    return [
        float(chars),
        float(n_words),
        float(n_lines),
        share(lengths.sum(), n_words),
        float(lengths.max()) if n_words else 0.0,
        share(chars, n_lines),
        share(letters, chars),
        share(_UPPER[low].sum(), letters),
        share(_DIGIT[low].sum(), chars),
        share(_PUNCT[low].sum(), chars),
        share(_SYMBOL[low].sum(), chars),
        share(_SPACE[low].sum(), chars),
        share(wide.sum(), chars),
        share(len(set(t.lower().split())), n_words),
        share((lengths <= 3).sum(), n_words),
        share(_UPPER[low[starts]].sum(), n_words),
        share(sum(x.rstrip()[-1:] in _ENDS for x in lines), n_lines),
        share(sum(bool(_BULLET.match(x)) for x in lines), n_lines),
        share(sum(len(x.split()) < 4 for x in lines), n_lines),
        share(len(set(lines)), n_lines),
        share(t.count("http://") + t.count("https://") + t.count("www."), n_words),
    ]


FEATURES = [
    "q_chars", "q_words", "q_lines", "q_mean_word", "q_longest_word", "q_mean_line", "q_letters", "q_upper",
    "q_digits", "q_punct", "q_symbols", "q_space", "q_non_ascii", "q_unique_words", "q_short_words",
    "q_capital_words", "q_end_stop", "q_bullets", "q_short_lines", "q_distinct_lines", "q_urls",
]


@dataclass
class Forest:
    """Trees flattened into arrays; node ``i`` of all trees is row ``i``.

    A leaf has ``feature`` -1 and points to itself.  ``roots`` are the first
    node of each tree.
    """

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        """The summed tree values of every row of ``x`` (rows by features)."""
        if not len(self.roots):
            return np.full(len(x), self.base)
        node = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            f = self.feature[node]
            go_left = x[rows, np.maximum(f, 0)] <= self.threshold[node]
            node = np.where(f < 0, node, np.where(go_left, self.left[node], self.right[node]))
        return self.base + self.value[node].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def _edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Per feature, the distinct quantiles that bound its bins."""
    out = []
    for f in range(x.shape[1]):
        q = np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1]) if len(x) else np.zeros(0)
        out.append(np.unique(q))
    return out


def fit_arrays(
    x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, depth: int = MAX_DEPTH, bins: int = BINS
) -> Forest:
    """Boosted trees of a feature matrix and labels 0 or 1."""
    x = np.asarray(x, float)
    x = x if x.ndim == 2 else x.reshape(len(y), -1)
    y = np.asarray(y, float)
    share = y.mean() if len(y) else 0.0
    if not 0 < share < 1:
        empty = np.zeros(0, np.int64)
        return Forest(empty, np.zeros(0), empty, empty, np.zeros(0), empty, 30.0 if share else -30.0, 0)
    edges = _edges(x, bins)
    nf, width = x.shape[1], bins
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    flat = binned + np.arange(nf) * width
    base = float(np.log(share / (1 - share)))
    margin = np.full(len(y), base)
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def leaf(g: float, h: float) -> int:
        feature.append(-1)
        threshold.append(0.0)
        left.append(len(feature) - 1)
        right.append(len(feature) - 1)
        value.append(-LEARNING_RATE * g / (h + L2))
        return len(feature) - 1

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, np.maximum(p * (1 - p), 1e-12)
        leaves = np.zeros(len(y), np.int64)

        def grow(idx: np.ndarray, level: int) -> int:
            g, h = grad[idx].sum(), hess[idx].sum()
            if level == depth or len(idx) < 2 * MIN_LEAF:
                node = leaf(g, h)
                leaves[idx] = node
                return node
            hg = np.bincount(flat[idx].ravel(), grad[idx].repeat(nf), nf * width).reshape(nf, width)
            hh = np.bincount(flat[idx].ravel(), hess[idx].repeat(nf), nf * width).reshape(nf, width)
            hn = np.bincount(flat[idx].ravel(), None, nf * width).reshape(nf, width)
            gl, hl, nl = hg.cumsum(1), hh.cumsum(1), hn.cumsum(1)
            gain = gl**2 / (hl + L2) + (g - gl) ** 2 / (h - hl + L2) - g**2 / (h + L2)
            valid = (nl >= MIN_LEAF) & (len(idx) - nl >= MIN_LEAF)
            valid &= np.arange(width)[None, :] < np.array([len(e) for e in edges])[:, None]
            gain = np.where(valid, gain, -np.inf)
            best = int(np.argmax(gain))
            if not np.isfinite(gain.flat[best]) or gain.flat[best] <= 1e-9:
                node = leaf(g, h)
                leaves[idx] = node
                return node
            f, b = divmod(best, width)
            node = len(feature)
            feature.append(f)
            threshold.append(float(edges[f][b]))
            left.append(-1)
            right.append(-1)
            value.append(0.0)
            goes = binned[idx, f] <= b
            left[node] = grow(idx[goes], level + 1)
            right[node] = grow(idx[~goes], level + 1)
            return node

        roots.append(grow(np.arange(len(y)), 0))
        margin += np.array(value)[leaves]
    i64 = lambda v: np.array(v, np.int64)
    return Forest(i64(feature), np.array(threshold), i64(left), i64(right), np.array(value), i64(roots), base, depth)


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the statistics of its texts as columns of their own; one narrow pass."""

    def start():
        def run(texts: list) -> list:
            table = np.array([statistics(t) for t in texts], float).reshape(len(texts), len(FEATURES))
            return [pa.array(table[:, i]) for i in range(len(FEATURES))]

        return run

    return map_text(docs, text, start, [(f, T.DoubleType()) for f in FEATURES])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    per_class: int = PER_CLASS,
) -> Forest:
    """Fit on at most ``per_class`` distinct texts of each label, chosen by text hash.

    Only hashes are joined with the labels; the chosen texts follow by broadcast
    of at most ``2 * per_class`` hashes, and only their statistics reach the driver.
    """
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")).withColumn("h", F.xxhash64("text"))
    known = labels.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").alias("label")).where(
        F.col("label").isin(0, 1)
    )
    marked = rows.select("key", "h").join(known, "key").select("label", "h").distinct()
    chosen = []
    for r in marked.groupBy("label").count().orderBy("label").collect():
        one = marked.where((F.col("label") == r["label"]) & (F.col("h") <= hash_limit(per_class, r["count"])))
        chosen += one.orderBy("h").limit(per_class).collect()
    if not chosen:
        return fit_arrays(np.zeros((0, len(FEATURES))), np.zeros(0))
    wanted = docs.sparkSession.createDataFrame([(int(r["label"]), r["h"]) for r in chosen], "label int, h long")
    texts = rows.join(F.broadcast(wanted), "h").groupBy("label", "h").agg(F.min("text").alias("text"))
    got = with_statistics(texts, "text").drop("text").orderBy("label", "h").collect()
    x = np.array([[r[f] for f in FEATURES] for r in got], float).reshape(len(got), len(FEATURES))
    return fit_arrays(x, np.array([r["label"] for r in got], float))


def score(docs: DataFrame, model: Forest, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with its statistics, ``score`` and ``predicted``; one narrow pass."""
    # Plain arrays travel; the class comes with the function that uses them.
    shared = docs.sparkSession.sparkContext.broadcast(tuple(vars(model).values()))

    def start():
        forest = Forest(*shared.value)

        def run(texts: list) -> list:
            table = np.array([statistics(t) for t in texts], float).reshape(len(texts), len(FEATURES))
            s = forest.score(table)
            return [*(pa.array(table[:, i]) for i in range(len(FEATURES))), pa.array(s), pa.array((s >= threshold).astype(np.int32))]

        return run

    fields = [(f, T.DoubleType()) for f in FEATURES] + [("score", T.DoubleType()), ("predicted", T.IntegerType())]
    return map_text(docs, text, start, fields)
