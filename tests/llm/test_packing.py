"""Plans against piece-by-piece best fit; packed tables against their contract."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from broadsheet.llm import packing, tokens


def best_fit(lengths, capacity):
    """Remaining capacities of plain best-fit decreasing."""
    bins = []
    for n in sorted(lengths, reverse=True):
        fits = [(room, i) for i, room in enumerate(bins) if room >= n]
        if fits:
            bins[min(fits)[1]] -= n
        else:
            bins.append(capacity - n)
    return sorted(bins)


@pytest.mark.parametrize("seed", range(60))
def test_plan_equals_piece_by_piece(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([5, 10, 20, 64])
    lengths = [rnd.randint(1, capacity) for _ in range(rnd.randint(0, 80))]
    bins, ranks = {}, Counter()
    for n, rank, count, first, offset in packing.plan(Counter(lengths), capacity):
        assert rank == ranks[n]
        ranks[n] += count
        for k in range(count):
            bins.setdefault(first + k, []).append((offset, n))
    assert ranks == Counter(lengths)
    for held in bins.values():
        end = 0
        for offset, n in sorted(held):
            assert offset == end
            end += n
        assert end <= capacity
    assert sorted(capacity - sum(n for _, n in held) for held in bins.values()) == best_fit(lengths, capacity)


def test_plan_size_does_not_follow_the_number_of_pieces():
    rnd = random.Random(3)
    few = {n: rnd.randint(1, 50) for n in range(1, 513)}
    many = {n: 10**6 * c for n, c in few.items()}
    assert len(packing.plan(many, 512)) < 20 * 512


TEXTS = [
    (1, "Hello there, hello World. naïve L'été!"),
    (2, ""),
    (3, None),
    (4, "word and more words " * 3000),
    (5, "<|endoftext|> don't a\x1cb ½ ﬁ ǅ İx é 12 3,4 #tag --"),
    (5, "<|endoftext|> don't a\x1cb ½ ﬁ ǅ İx é 12 3,4 #tag --"),
    (None, "no id"),
]


def plain_ids(text):
    return Tokenizer.from_file(tokens.tokenizer_path()).encode(text or "", add_special_tokens=False).ids


def test_pieces_are_whole_and_fit(spark):
    rows = spark.createDataFrame([(*t, 9) for t in TEXTS], "doc_id long, text string, length int")
    got = packing.pack(rows, with_ids=True).collect()
    by_doc = Counter(t[0] for t in TEXTS)
    for key, text in TEXTS:
        ids = plain_ids(text) + [0]
        mine = sorted((r for r in got if r["doc_id"] == key), key=lambda r: r["piece"])
        assert len(mine) == by_doc[key] * -(-len(ids) // 2048)
        for r in mine:
            part = ids[r["start"] : r["start"] + r["length"]]
            assert r["start"] == 2048 * r["piece"]
            data = np.array(part, "<u4").tobytes()
            assert (zlib.crc32(data), data) == (r["ids_crc32"], bytes(r["ids"]))
    held = {}
    for r in got:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in held.values():
        end = 0
        for offset, n in sorted(spans):
            assert offset == end
            end += n
        assert end <= 2048
    assert len(held) == len(best_fit([r["length"] for r in got], 2048))
    whole = packing.sequences(packing.pack(rows, with_ids=True)).collect()
    assert sum(len(r["ids"]) for r in whole) == 4 * sum(r["length"] for r in got)


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_word_tokens_equal_the_tokenizer(spark):
    words = tokens.WordTokens(tokens.tokenizer_path())
    texts = [t for _, t in TEXTS] + ["Straße ÉCOLE école 'S it's. ... a.b, x,,y (z) _u_  v", "日本語 текст ΑΣ", "\x85 x"]
    for text in texts:
        assert np.frombuffer(words.ids(text), "<u4").tolist() == plain_ids(text)
