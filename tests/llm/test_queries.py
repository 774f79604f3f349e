"""Registered queries without SQL, against plain Python over the whole smallest tables."""

import html
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from broadsheet.llm import tokens
from broadsheet.llm.line_templates import MIN_CONSTANT, MIN_LEFT
from broadsheet.llm.queries import QUERIES, toxicity_model
from tests.llm.test_native import plain_hits
from tests.llm.test_packing import best_fit
from tests.llm.test_simhash import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.001"


def rows(name):
    return pq.read_table(f"{SF}/{name}.parquet").to_pylist()


@pytest.fixture(scope="module")
def docs():
    return [(r["doc_id"], r["text"]) for r in rows("documents")]


@pytest.fixture(scope="module")
def encode():
    tokenizer = Tokenizer.from_file(tokens.tokenizer_path())
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_near_duplicates(spark, docs):
    prints = {i: plain_fingerprint(t) for i, t in docs}
    groups = plain_components(prints)
    got = QUERIES["op2_simhash_dedup"](spark, SF).collect()
    assert sorted(map(tuple, got)) == sorted((i, f"{prints[i]:016x}", groups[i]) for i in prints)


def test_pages(spark):
    """The generated pages have one article of flat blocks, which a few substitutions find."""
    got = {r["page_id"]: r for r in QUERIES["op5_html_extraction"](spark, SF).collect()}
    pages = rows("pages")
    assert len(got) == len(pages)
    for r in pages:
        article = re.sub(r"</article>.*", "", re.sub(r".*<article>", "", r["html"] or "", flags=re.S), flags=re.S)
        article = re.sub(r"<[^>]*$", "", article)
        blocks = [" ".join(html.unescape(re.sub(r"</?b>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)>", article)]
        text = "\n".join(x for x in blocks if x)
        assert (got[r["page_id"]]["text"], got[r["page_id"]]["n_chars"]) == (text, len(text))


def check_packing(packed, wanted):
    """``packed`` holds the pieces of ``wanted`` {id: token ids} in as few sequences as best fit needs."""
    pieces = {}
    for r in packed:
        pieces.setdefault(r["doc_id"], []).append(r)
    assert set(pieces) == set(wanted)
    for i, ids in wanted.items():
        mine = sorted(pieces[i], key=lambda r: r["piece"])
        assert [(r["start"], r["length"], r["ids_crc32"]) for r in mine] == [
            (a, len(ids[a : a + 2048]), crc(ids[a : a + 2048])) for a in range(0, len(ids), 2048)
        ]
    held = {}
    for r in packed:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in held.values():
        end = 0
        for offset, n in sorted(spans):
            assert offset == end
            end += n
        assert end <= 2048
    assert len(held) == len(best_fit([r["length"] for r in packed], 2048))


def test_packing(spark, docs, encode):
    check_packing(QUERIES["op6_best_fit_packing"](spark, SF).collect(), {i: [*encode(t), 0] for i, t in docs})


def test_token_files(spark, docs, encode):
    start, wanted = 0, []
    for i, text in sorted(docs):
        ids = [*encode(text), 2]
        wanted.append((i, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted(map(tuple, QUERIES["op10_token_files"](spark, SF).collect())) == wanted


def plain_line_dedup(docs):
    """{id: text}: lines of shared templates only in the first document; documents with nothing left go.

    A copy (under a fifth of its words left) goes only if no line of three tokens is left.
    """
    shapes, firsts = {}, {}
    for i, text in docs:
        for at, line in enumerate(text.split("\n")):
            raw = [w for w in re.split("[\x20\x09-\x0d]+", line) if w]
            t = ["<*>" if re.search("[0-9]", w) else w for w in raw]
            n = len(t)
            if n >= 3 and n - t.count("<*>") < MIN_CONSTANT * n:
                found = [(n, "=", *raw)]
            elif n >= 8:
                cuts = [3 + j * (n - 3) // 4 for j in range(5)]
                found = [(n, j, *t[: cuts[j]], None, *t[cuts[j + 1] :]) for j in range(4)]
            else:
                found = [(n, *t)] if n >= 3 else []
            shapes[i, at] = found
            for shape in found:
                firsts.setdefault(shape, set()).add(i)
    out = {}
    for i, text in docs:
        lines = text.split("\n")
        kept = [x for at, x in enumerate(lines) if not any(min(firsts[s]) < i for s in shapes[i, at])]
        words = [sum(len(re.findall("[^\x20\x09-\x0d]+", x)) for x in part) for part in (kept, lines)]
        longest = max((len(re.findall("[^\x20\x09-\x0d]+", x)) for x in kept), default=0)
        if len(kept) == len(lines) or words[0] >= MIN_LEFT * words[1] or longest >= 3:
            out[i] = "\n".join(kept)
    return out


def test_pipeline(spark, docs, encode):
    model = toxicity_model(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF)
    clean = [(i, t) for i, t in docs if model.score(t) < 0.7]
    lines = plain_line_dedup(clean)
    groups = plain_components({i: plain_fingerprint(t) for i, t in lines.items()})
    unique = [(i, t) for i, t in lines.items() if groups[i] == i]
    hits = plain_hits(unique, [(r["item_id"], r["text"]) for r in rows("benchmark")])
    kept = {i: t for (i, t), hit in zip(unique, hits, strict=True) if not hit[2]}
    assert 0 < len(kept) < len(unique) < len(lines) < len(clean) < len(docs)
    check_packing(corpus_pipeline.run(spark, SF).collect(), {i: [*encode(t), 0] for i, t in kept.items()})


def test_stages_keep_the_columns_of_documents(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, documents, SF).columns == documents.columns, name
        assert stage(spark, documents.limit(0), SF).count() == 0, name


def test_columns_are_those_asked_for(spark):
    wanted = {
        "op1_chat_format": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
        "op2_simhash_dedup": "doc_id fingerprint component_id",
        "op3_toxicity": "doc_id held_out score predicted",
        "op4_decontamination": "doc_id n_words n_hit n_items items_sha256 contaminated",
        "op5_html_extraction": "page_id url text n_chars",
        "op6_best_fit_packing": "doc_id piece start length ids_crc32 sequence_id offset",
        "op8_language_id": "doc_id held_out lang_pred score",
        "op9_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
        "op10_token_files": "doc_id start n_tokens ids_crc32",
    }
    for name, columns in wanted.items():
        frame = QUERIES[name](spark, SF)
        kinds = dict(frame.dtypes)
        assert set(columns.split()) <= set(kinds), name
        longs = {"n_turns", "loss_chars", "formatted_chars", "n_words", "n_hit", "n_items", "n_chars", "start", "length"}
        longs |= {"ids_crc32", "sequence_id", "offset", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens"}
        assert all(kinds[c] == "bigint" for c in longs & set(kinds)), name
