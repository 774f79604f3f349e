"""Directly addressable codes: exact round trips and random access."""

import random

import numpy as np
import pytest

from broadsheet.llm import dac
from broadsheet.session import new_folder
from tests.llm.test_packing import TEXTS, plain_ids


@pytest.mark.parametrize("top", [1, 200, 256, 49408, 70000, 1 << 31, (1 << 32) - 1])
@pytest.mark.parametrize("n", [1, 7, 512, 513, 5000])
def test_round_trip_and_access(top, n):
    rnd = random.Random(top + n)
    ids = np.array([min(top, int(rnd.paretovariate(0.3)) - 1) for _ in range(n)], np.uint32)
    segment = dac.Segment(dac.encode(ids))
    assert segment.range(0, n).tolist() == ids.tolist()
    for i in {0, n - 1, *(rnd.randrange(n) for _ in range(50))}:
        assert segment[i] == ids[i]
        end = rnd.randint(i, n)
        assert segment.range(i, end).tolist() == ids[i:end].tolist()
    with pytest.raises(IndexError):
        segment[n]


def test_frequent_low_ids_take_less_than_plain():
    ids = np.array([int(random.Random(1).paretovariate(0.8)) % 49408 for _ in range(20000)], np.uint32)
    assert len(dac.encode(ids)) < 3 * len(ids)


@pytest.mark.parametrize("segment", [10, 1 << 18])
def test_files_hold_all_documents_in_order(spark, segment):
    rows = spark.createDataFrame([(*t, "x") for t in TEXTS], "doc_id long, text string, part string")
    folder = new_folder(spark, "dac-test")
    dac.write_tokens(rows, folder, segment=segment)
    got = sorted(dac.read_documents(spark, folder).collect(), key=lambda r: r["start"])
    order = sorted(TEXTS, key=lambda t: (t[0] is not None, t[0] or 0, t[1] or ""))
    assert [r["doc_id"] for r in got] == [k for k, _ in order]
    whole = []
    for r, (_, text) in zip(got, order, strict=True):
        assert r["start"] == len(whole)
        ids = [*plain_ids(text), 2]
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids
        whole += ids
    places = [0, 5, len(whole) // 2, len(whole) - 1]
    assert dac.token_at(spark, folder, places) == {p: whole[p] for p in places}


def test_empty_table(spark):
    folder = new_folder(spark, "dac-empty")
    dac.write_tokens(spark.createDataFrame([], "doc_id long, text string"), folder)
    assert dac.read_documents(spark, folder).count() == 0
