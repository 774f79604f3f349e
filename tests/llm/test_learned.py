"""Toxicity and language models: accuracy on texts they have not seen, and edge cases."""

import random

import numpy as np
import pytest

from broadsheet.llm import language, toxicity
from broadsheet.llm.common import held_out
from broadsheet.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_toxic_texts_are_found_by_parts_of_words():
    rnd = random.Random(2)
    plain = ["river", "window", "garden", "silver", "morning", "letter", "number", "travel"]

    def text(bad):
        w = [rnd.choice(plain) for _ in range(60)]
        if bad:
            w[rnd.randrange(60)] = rnd.choice(["grobnix", "grobnixer", "blitzdoof"])
        return " ".join(w)

    labels = [i % 3 == 0 for i in range(300)]
    model = toxicity.fit_texts([text(x) for x in labels], [int(x) for x in labels])
    assert all(model.score(text(True)) >= 0.7 for _ in range(50))
    assert all(model.score(text(False)) < 0.3 for _ in range(50))
    assert 0 <= model.score("") < 0.7 and model.score(None) == model.score("")


def test_one_class_or_none():
    assert toxicity.fit_texts([], []).score("x") < 0.01
    assert toxicity.fit_texts(["x"], [1]).score("y") > 0.99


def test_toxicity_table(spark):
    rows = [(i, t, "x") for i, t in enumerate(["bad bad", "good", None, "", "bad " * 100_000])]
    model = toxicity.fit_texts(["bad words here"] * 30 + ["good words there"] * 30, [1] * 30 + [0] * 30)
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    assert len(got) == 5 and all(0 <= r["score"] <= 1 for r in got.values())
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns
    assert {r[0] for r in kept.collect()} == {i for i, r in got.items() if r["score"] < 0.7}
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_fit_takes_a_bounded_distinct_sample(spark, monkeypatch):
    texts = ["copy"] * 50 + [f"text {i}" for i in range(9)] + [f"bad {i}" for i in range(9)] + [None, "x", "long" * 100]
    labels = [0] * 59 + [1] * 9 + [1, None, 1]
    docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, label int")
    known = spark.createDataFrame(list(enumerate(labels)), "doc_id long, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "fit_texts", lambda t, y: seen.append((t, y)))
    toxicity.fit(docs, known, per_class=5, fit_chars=50)
    toxicity.fit(docs, known, per_class=100, fit_chars=50)
    toxicity.fit(docs.limit(0), known)
    (few, marks), (every, _), (none, _) = seen
    assert len(few) == 10 and sum(marks) == 5 and len(set(few)) == 10 and set(few) <= set(every)
    assert sorted(every) == sorted(["copy"] + texts[50:68]) and none == []


@pytest.mark.parametrize("k", [2, 3, 4, 6, 7, 20, 90])
def test_codewords_differ(k):
    code = language.codewords(k)
    assert len({tuple(r) for r in code}) == k
    assert all(len(set(column)) == 2 for column in code.T)
    if k > 3:
        apart = min((code[a] != code[b]).sum() for a in range(k) for b in range(a))
        assert apart >= 3


def test_random_languages_are_told_apart():
    rnd = random.Random(7)
    parts = {f"l{k}": ["".join(rnd.choice("abcdefghijklmnopqrst"[k : k + 9]) for _ in range(3)) for _ in range(25)] for k in range(9)}

    def text(name, n):
        return " ".join(rnd.choice(parts[name]) for _ in range(n))

    langs = [name for name in parts for _ in range(20)]
    model = language.fit_texts([text(x, 60) for x in langs], langs)
    hits = [model.predict(text(name, 40))[0] == name for name in parts for _ in range(10)]
    assert np.mean(hits) > 0.95


def test_language_edge_cases(spark):
    model = language.fit_texts(["der hund und die katze", "the dog and the cat"] * 5, ["de", "en"] * 5)
    rows = [(1, "the cat and the dog", "x"), (2, None, "x"), (3, "12 !? --", "x"), (4, "", "x"), (5, "und die " * 50_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang_pred string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(docs, model).collect()}
    assert {i: x[0] for i, x in got.items()} == {1: "en", 2: "und", 3: "und", 4: "und", 5: "de"}
    assert all(0 <= x[1] <= 1 for x in got.values())
    assert language.identify(docs.limit(0), model).count() == 0
    assert language.fit_texts([], []).predict("text")[0] == "und"
    assert language.fit_texts(["abc"], ["xx"]).predict("text") == ("xx", 1.0, False)


def test_language_sample_is_bounded_and_shared(spark, monkeypatch):
    rows = [(f"text {i}", "aa") for i in range(50)] + [("copy", "aa")] * 50 + [(f"word {i}", "bb") for i in range(3)]
    rows += [("rare", "cc"), (None, "aa"), ("x", None)]
    monkeypatch.setattr(language, "fit_texts", lambda texts, langs: (texts, langs))
    monkeypatch.setattr(language, "PER_LANGUAGE", 2)
    texts, langs = language.fit(spark.createDataFrame(rows, "text string, lang string"), sample=20)
    assert len(texts) == len(set(texts)) == 10 and langs.count("aa") == 6 and langs.count("bb") == 3 and langs.count("cc") == 1
    monkeypatch.setattr(language, "PER_LANGUAGE", 25)
    texts, langs = language.fit(spark.createDataFrame(rows, "text string, lang string"), sample=20)
    assert len(texts) == len(set(texts)) == 29 and langs.count("aa") == 25
    assert language.fit(spark.createDataFrame([], "text string, lang string")) == ([], [])


def test_held_out_shares(spark):
    import zlib

    rows = spark.range(300)
    got = {r[0] for r in rows.where(held_out(rows["id"], 3, 1)).collect()}
    assert got == {i for i in range(300) if zlib.crc32(str(i).encode()) % 3 == 1}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    right = QUERIES["op8_language_id"](spark, SF).join(docs, "doc_id").where("held_out AND lang_pred <> 'und'")
    assert right.selectExpr("avg(CAST(lang = lang_pred AS int))").first()[0] > 0.97
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = QUERIES["op3_toxicity"](spark, SF).join(labels, "doc_id").where("held_out")
    clean, toxic = (scored.where(f"toxic = {v}").selectExpr("avg(score)").first()[0] for v in (0, 1))
    assert toxic > clean + 0.3


def plain_ngram_hashes(codes, sizes, bits):
    """The n-gram numbers of ``toxicity.ngram_hashes``, one n-gram at a time in Python integers."""
    out = []
    for n in sizes:
        factors = [pow(0x9E3779B1, j + 1, 1 << 32) for j in range(n)]
        for i in range(len(codes) - n + 1):
            total = sum(codes[i + j] * factors[j] for j in range(n)) & 0xFFFFFFFF
            h = ((total ^ (total >> 15)) * (0x85EBCA6B + 2 * n)) & 0xFFFFFFFF
            out.append((h ^ (h >> 13)) >> (32 - bits))
    return out


def test_toxicity_query_equals_a_plain_dictionary_of_ngrams(spark):
    from collections import Counter

    from broadsheet.llm.queries import toxicity_model

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = toxicity_model(spark, docs, sf)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = {r["doc_id"]: r["score"] for r in QUERIES["op3_toxicity"](spark, sf).collect()}
    for doc_id in sorted(texts)[:300]:
        codes = [ord(c) for c in f" {(texts[doc_id] or '').lower()} "]
        counts = Counter(h for h in plain_ngram_hashes(codes, toxicity.SIZES, toxicity.HASH_BITS) if model.look[h])
        repeated = {int(toxicity._repeated(np.array([h], np.uint32))[0]) for h, c in counts.items() if c >= toxicity.REPEATED}
        z = model.bias + sum(float(model.weight[f]) for f in set(counts) | repeated)
        assert got[doc_id] == pytest.approx(1 / (1 + np.exp(-np.clip(z, -30, 30))), abs=1e-6)


def test_language_query_equals_plain_ngram_counts(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = language.fit(docs.where(~held_out(docs["doc_id"], 5, 0)))
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in QUERIES["op8_language_id"](spark, sf).collect()}
    for r in sorted(docs.collect(), key=lambda r: r["doc_id"])[:300]:
        spaced, last = [], True
        for c in f" {(r['text'] or '').lower()} ":
            letter = c.isalpha()
            if letter or last:
                spaced.append(ord(c) if letter else 32)
            last = letter
        if not any(c != 32 for c in spaced):
            assert got[r["doc_id"]] == ("und", 0.0)
            continue
        h = plain_ngram_hashes(spaced, language.SIZES, language.HASH_BITS)
        margins = model.weight[h].astype(np.float64).sum(axis=0) / len(h) * model.scale + model.offset
        losses = (model.trust * np.logaddexp(0, -model.code * margins)).sum(axis=1)
        best = int(np.argmin(losses))
        near = np.exp(-(losses - losses[best]))
        assert got[r["doc_id"]][0] == model.languages[best]
        assert got[r["doc_id"]][1] == pytest.approx(near[best] / near.sum(), abs=1e-6)


def test_every_language_is_learned(spark):
    rows = [(i, f"{'abcdefghijklmnopqrstuvwxyz'[i % 26] * 5} text number {i}", f"l{i % 450}") for i in range(450 * 3)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample=400)
    assert len(model.languages) == 450
