"""Language identification with error-correcting output codes.

Every language gets a codeword of +1 and -1 bits.  For each bit a binary
character n-gram classifier tells the languages with +1 from those with -1: a
naive Bayes log ratio averaged over the n-grams of a text, with a scale and an
offset fitted by logistic regression.  A text gets the language whose codeword
has the least loss, bits weighted by their accuracy on the sample; a text whose
two best codewords are close is flagged ambiguous.

The fit uses a bounded sample of distinct texts chosen by text hash: ``SAMPLE``
shared equally by all languages, but at least ``PER_LANGUAGE`` of each, so the
sample grows with the number of languages and every language is learned.  Prediction is one narrow pass over whole
texts.  Null texts and texts without a letter are ``und`` with score 0; so is
everything if no language was learned.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.llm.common import hash_limit, map_text, worker_cache
from broadsheet.llm.toxicity import ngram_hashes

SAMPLE = 4000
PER_LANGUAGE = 25
FIT_CHARS = 32768
SIZES = (1, 2, 3)
HASH_BITS = 15
EXHAUSTIVE = 6
AMBIGUOUS = 0.1
PIECE = 1 << 16
UNKNOWN = "und"


def codewords(k: int) -> np.ndarray:
    """A ``k`` by bits matrix of +1 and -1: all splits of few languages, else random ones."""
    if k <= 1:
        return np.ones((k, 0), np.float32)
    if k <= EXHAUSTIVE:
        splits = [[1 if c == 0 or not s >> (c - 1) & 1 else -1 for c in range(k)] for s in range(1, 1 << (k - 1))]
        return np.array(splits, np.float32).T
    rng, wanted = np.random.default_rng(k), max(31, 10 * int(np.ceil(np.log2(k))))
    columns: list[np.ndarray] = []
    while len(columns) < wanted or len({tuple(r) for r in np.array(columns).T}) < k:
        column = rng.permutation(np.where(np.arange(k) % 2, 1, -1)).astype(np.float32)
        columns.append(column)
    return np.array(columns).T


def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def features(text: str | None) -> np.ndarray:
    """n-gram numbers of a text whose non-letters are spaces; none without letters."""
    letters = worker_cache("letters", _letters)
    codes = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le", "surrogatepass"), "<u4")
    is_letter = letters[codes]
    if not is_letter.any():
        return np.zeros(0, np.uint32)
    # One space between words is enough: drop non-letters that follow another.
    kept = is_letter | np.concatenate([[True], is_letter[:-1]])
    return ngram_hashes(np.where(is_letter, codes, 32)[kept].astype(np.uint32), SIZES, HASH_BITS)


@dataclass
class LanguageModel:
    languages: list[str]
    code: np.ndarray
    weight: np.ndarray  # n-gram number by bit
    scale: np.ndarray
    offset: np.ndarray
    trust: np.ndarray

    def margins(self, text: str | None) -> np.ndarray | None:
        h = features(text)
        if not len(h):
            return None
        total = np.zeros(self.weight.shape[1], np.float64)
        for at in range(0, len(h), PIECE):
            total += self.weight[h[at : at + PIECE]].sum(axis=0, dtype=np.float64)
        return total / len(h) * self.scale + self.offset

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        margins = self.margins(text) if self.languages else None
        if margins is None:
            return UNKNOWN, 0.0, False
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        losses = (self.trust * np.logaddexp(0, -self.code * margins)).sum(axis=1)
        order = np.argsort(losses, kind="stable")
        near = np.exp(-(losses - losses[order[0]]))
        close = bool(losses[order[1]] - losses[order[0]] < AMBIGUOUS)
        return self.languages[order[0]], float(near[order[0]] / near.sum()), close


def fit_texts(texts: list[str], langs: list[str]) -> LanguageModel:
    languages = sorted(set(langs))
    code, size = codewords(len(languages)), 1 << HASH_BITS
    place = {name: i for i, name in enumerate(languages)}
    y = np.array([place[x] for x in langs], np.int64)
    counts = np.ones((len(languages), size), np.float64) * 0.1
    rows = []
    for text, i in zip(texts, y, strict=True):
        h = features(text)
        rows.append(h)
        if len(h):
            counts[i] += np.bincount(h, minlength=size) / len(h) * 1000
    share = counts / counts.sum(axis=1, keepdims=True)
    bits = code.shape[1]
    weight = np.zeros((size, bits), np.float32)
    for b in range(bits):
        weight[:, b] = np.log(share[code[:, b] > 0].mean(axis=0)) - np.log(share[code[:, b] < 0].mean(axis=0))
    scale, offset, trust = np.ones(bits), np.zeros(bits), np.ones(bits)
    used = [i for i, h in enumerate(rows) if len(h)]
    if used and bits:
        raw = np.array([weight[rows[i]].mean(axis=0) for i in used])
        wanted = code[y[used]]
        for b in range(bits):
            scale[b], offset[b] = _logistic(raw[:, b], wanted[:, b])
            right = np.mean((raw[:, b] * scale[b] + offset[b]) * wanted[:, b] > 0)
            trust[b] = np.log((right + 0.01) / (1 - right + 0.01))
        trust = np.maximum(trust, 0.01) / max(0.01, trust.mean())
    return LanguageModel(languages, code, weight, scale, offset, trust)


def _logistic(x: np.ndarray, sign: np.ndarray, rounds: int = 300) -> tuple[float, float]:
    """Scale and offset that separate ``x`` by ``sign``, mildly regularised."""
    spread = x.std() or 1.0
    u, a, c = (x - x.mean()) / spread, 1.0, 0.0
    for _ in range(rounds):
        g = -sign / (1 + np.exp(np.clip(sign * (a * u + c), -30, 30)))
        a -= 0.5 * ((g * u).mean() + 0.005 * a)
        c -= 0.5 * g.mean()
    return a / spread, c - a * x.mean() / spread


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", sample: int = SAMPLE, fit_chars: int = FIT_CHARS) -> LanguageModel:
    """Fit on a bounded sample of the rows with a text and a language."""
    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where(
        "text IS NOT NULL AND lang IS NOT NULL"
    )
    rows = rows.where(F.length("text") <= fit_chars).withColumn("h", F.xxhash64("text"))
    distinct = rows.groupBy("lang", "h").agg(F.lit(1).alias("one"))
    # One row per language: a list as long as the number of languages.
    known = distinct.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy("lang").collect()
    each = max(PER_LANGUAGE, sample // max(1, len(known)))
    limits = rows.sparkSession.createDataFrame([(r["lang"], hash_limit(each, r["n"])) for r in known], "lang string, most long")
    order = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    chosen = distinct.join(F.broadcast(limits), "lang").where(F.col("h") <= F.col("most"))
    chosen = chosen.withColumn("at", order).where(F.col("at") <= each).select("lang", "h")
    found = rows.join(F.broadcast(chosen), ["lang", "h"]).groupBy("lang", "h").agg(F.min("text").alias("text"))
    got = found.orderBy("lang", "h").collect()
    return fit_texts([r["text"] for r in got], [r["lang"] for r in got])


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1) and ``ambiguous``."""
    fields = (model.languages, model.code, model.weight, model.scale, model.offset, model.trust)
    shared = docs.sparkSession.sparkContext.broadcast(fields)

    def start() -> Callable:
        m = LanguageModel(*shared.value)
        return lambda texts: [list(x) for x in zip(*(m.predict(t) for t in texts), strict=True)] or [[], [], []]

    return map_text(
        docs, text, start, [("lang_pred", T.StringType()), ("score", T.DoubleType()), ("ambiguous", T.BooleanType())]
    )
