"""Quality trees, importance resampling and whitening: against plain Python and numpy."""

import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from broadsheet.llm import quality_model, resample, whitening
from broadsheet.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def rows(name, sf=SF):
    return pq.read_table(f"{sf}/{name}.parquet").to_pylist()


# Importance resampling ---------------------------------------------------------


def plain_words(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", low) if w]


def plain_resample(docs, bench, buckets=10_000):
    def bucket(w):
        return zlib.crc32(w.encode("utf-8")) % buckets

    s, t = [0] * buckets, [0] * buckets
    for _, text in docs:
        for w in plain_words(text):
            s[bucket(w)] += 1
    for text in bench:
        for w in plain_words(text):
            t[bucket(w)] += 1
    S, T = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in range(buckets)]
    out = {}
    for doc_id, text in docs:
        w = plain_words(text)
        weight = sum(gain[bucket(x)] for x in w)
        h = int(hashlib.sha256(f"2024:{doc_id}".encode()).hexdigest()[:8], 16)
        score = int(weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))))
        out[doc_id] = [len(w), weight, score, None, len(w)]
    eligible = sorted((d for d in out if out[d][4] >= 20), key=lambda d: (-out[d][2], d))
    for i, d in enumerate(eligible[: len(eligible) * 10 // 100]):
        out[d][3] = i + 1
    return {d: tuple(v[:4]) for d, v in out.items()}


def test_resampling_query_equals_plain_python(spark):
    docs = [(r["doc_id"], r["text"]) for r in rows("documents")]
    want = plain_resample(docs, [r["text"] for r in rows("benchmark")])
    got = {r["doc_id"]: (r["n_features"], r["weight"], r["score"], r["rank"]) for r in QUERIES["op12_importance_resampling"](spark, SF).collect()}
    assert got == want
    assert sum(v[3] is not None for v in got.values()) == sum(v[0] >= 20 for v in got.values()) // 10


def test_resampling_edges(spark):
    long = "alpha beta " * 200_000
    texts = [None, "", "ABC abc ÄBC", "x" * 30, long, long, "one two three " * 10]
    docs = spark.createDataFrame([(i % 6, t, "extra") for i, t in enumerate(texts)], "doc_id long, text string, rank string")
    target = spark.createDataFrame([("alpha gamma",), (None,)], "text string")
    got = resample.resample(docs, target).collect()
    assert len(got) == 7 and all(r["rank"] is None or isinstance(r["rank"], int) for r in got)
    by = {(r["doc_id"], r["n_features"]): r for r in got}
    assert by[(0, 0)]["weight"] == 0 and by[(1, 0)]["weight"] == 0
    assert by[(2, 3)]["n_features"] == 3  # abc, abc, Äbc: only A to Z are lowered
    assert by[(4, 400_000)]["weight"] == by[(5, 400_000)]["weight"]
    drawn = sorted(r["rank"] for r in got if r["rank"] is not None)
    assert drawn == list(range(1, 1 + drawn.__len__())) and len(drawn) == 0  # 3 eligible: floor(0.3) drawn
    assert resample.resample(docs.limit(0), target).count() == 0


def test_ranks_are_gapless_over_many_partitions(spark):
    scored = spark.range(5000).selectExpr("id AS doc_id", "CAST(id % 7 AS long) AS score").repartition(13)
    ranked = resample.ranks(scored, scored["score"] >= 0, 1234).where("rank IS NOT NULL").collect()
    order = sorted(((-r["score"], r["doc_id"]) for r in ranked))
    assert [r["rank"] for r in sorted(ranked, key=lambda r: (-r["score"], r["doc_id"]))] == list(range(1, 1235))
    assert len(order) == 1234


# Whitening -----------------------------------------------------------------------


def plain_whitening(vectors, k=8):
    kept = [(i, v) for i, v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(1024 * float(c)) + 100000 for c in v] for _, v in kept], np.int64)
    n, s = len(x), x.sum(axis=0)
    xc = x - s / n
    cov = xc.T @ xc / n
    values, vectors_ = np.linalg.eigh(cov)
    order = np.argsort(-values)[:k]
    e, q = values[order], vectors_[:, order]
    q *= np.sign(q[np.abs(q).argmax(axis=0), np.arange(q.shape[1])])
    w = xc @ q / np.sqrt(e)
    deviation = [int(sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s))) for row in x]
    return kept, n, deviation, w, e / np.trace(cov)


def test_whitening_query_equals_eigh(spark):
    vectors = [(r["vec_id"], r["embedding"]) for r in rows("embeddings", "/root/testdata/sf0.01")]
    kept, n, deviation, w, explained = plain_whitening(vectors)
    got = QUERIES["op13_embedding_whitening"](spark, "/root/testdata/sf0.01").collect()
    assert len(got) == 8 * len(kept)
    at = {v: i for i, (v, _) in enumerate(kept)}
    for r in got:
        i, c = at[r["vec_id"]], r["component"] - 1
        assert r["n"] == n and r["deviation"] == deviation[i]
        assert r["whitened"] == pytest.approx(w[i, c], abs=1e-6)
        assert r["explained"] == pytest.approx(explained[c], rel=1e-6)
        assert r["identity_error"] <= 1e-4


def test_whitening_edges(spark):
    rnd = np.random.default_rng(3)
    base = rnd.standard_normal((60, 12)) * np.linspace(1, 0.2, 12)
    good = [(i, [float(c) for c in v]) for i, v in enumerate(base)]
    bad = [(100, None), (101, [1.0, None] + [0.0] * 10), (102, [float("nan")] * 12), (103, [float("inf")] + [0.0] * 11)]
    repeated = [(0, good[0][1])]
    df = spark.createDataFrame(good + bad + repeated, "vec_id long, embedding array<double>")
    got = whitening.whiten(df).collect()
    kept, n, deviation, w, explained = plain_whitening(good + bad + repeated)
    assert n == 61 and len(got) == 8 * 61 and {r["vec_id"] for r in got} == set(range(60))
    mine = sorted((r["vec_id"], r["component"], r["whitened"]) for r in got)
    plain = sorted((v, c + 1, w[i, c]) for i, (v, _) in enumerate(kept) for c in range(8))
    assert all(a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-6 for a, b in zip(mine, plain))
    assert whitening.whiten(df.limit(0)).count() == 0
    one = whitening.whiten(spark.createDataFrame([(1, [0.5, 0.25])], "vec_id long, embedding array<double>"))
    assert one.count() == 0  # a single row has no variance: no components
    small = whitening.whiten(spark.createDataFrame(good[:10], "vec_id long, embedding array<double>"))
    assert small.select("component").distinct().count() == 8


# Quality trees ---------------------------------------------------------------------


def walk(forest, x):
    total = forest.base
    for root in forest.roots:
        node = root
        while forest.feature[node] >= 0:
            node = forest.left[node] if x[forest.feature[node]] <= forest.threshold[node] else forest.right[node]
        total += forest.value[node]
    return 1 / (1 + math.exp(-max(-30, min(30, total))))


def test_trees_learn_and_traverse_like_plain_python():
    rnd = np.random.default_rng(5)
    x = rnd.standard_normal((3000, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] * x[:, 2] > 0.5)).astype(float)
    forest = quality_model.fit_arrays(x[:2000], y[:2000])
    s = forest.score(x[2000:])
    assert ((s >= 0.5) == y[2000:]).mean() > 0.9
    assert np.allclose(s[:200], [walk(forest, v) for v in x[2000:2200]])
    assert quality_model.fit_arrays(np.zeros((0, 3)), np.zeros(0)).score(np.zeros((2, 3))).max() < 1e-6
    assert quality_model.fit_arrays(np.zeros((3, 3)), np.ones(3)).score(np.zeros((2, 3))).min() > 0.999


def test_quality_query_holds_out_and_separates(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op11_quality_classifier"](spark, sf).collect()
    labels = {r["doc_id"]: r["quality"] for r in rows("labels", sf)}
    assert len(got) == len(rows("documents", sf)) and all(0 <= r["score"] <= 1 for r in got)
    held = [(r["score"], labels[r["doc_id"]]) for r in got if r["held_out"] and labels.get(r["doc_id"]) is not None]
    good = [s for s, y in held if y == 1]
    bad = [s for s, y in held if y == 0]
    auc = np.mean([[(g > b) + 0.5 * (g == b) for b in bad] for g in good])
    assert auc > 0.9
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in got)


def test_quality_edges(spark):
    texts = [None, "", "Short.", "word " * 200_000, "Ein Satz.\nNoch einer.\n- punkt"]
    docs = spark.createDataFrame([(i % 4, t, 1.0) for i, t in enumerate(texts)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, None)], "doc_id long, quality int")
    model = quality_model.fit(docs, labels)
    got = quality_model.score(docs, model).collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 1 for r in got)
    assert got[0]["q_chars"] == 0 and got[0]["score"] == got[1]["score"]
    assert quality_model.score(docs.limit(0), model).count() == 0


def test_runs_of_two_words_stay_inside_documents():
    import pyarrow as pa

    texts = ["Aa bb, aa", None, "", "bb aa bb cc", "x"]
    found, parents = resample.tokens(pa.array(texts))
    got = resample.feature_buckets(found, parents, (1, 2), 97)
    for n, (bucket, of) in zip((1, 2), got):
        want = []
        for i, t in enumerate(texts):
            w = plain_words(t)
            want += [(i, zlib.crc32(" ".join(w[j : j + n]).encode()) % 97) for j in range(len(w) - n + 1)]
        assert sorted(zip(of.tolist(), bucket.tolist())) == sorted(want)
