"""Decontamination and quality rules against plain Python and their SQL."""

import hashlib
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from broadsheet.llm import decontaminate, quality
from broadsheet.llm.expected import EXPECTED

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def plain_hits(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add("" if item is None else str(item))
    out = []
    for key, text in docs:
        w, hit, ids = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    ids |= windows[tuple(w[i : i + n])]
        out.append((key, len(w), len(hit), sorted(ids)))
    return out


def cases():
    rnd = random.Random(4)
    vocabulary = ["a", "b", "c", "É", "d1", "x"]
    text = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    items = [(1, text(14)), (2, text(11)), (2, text(3)), (3, "A, b!"), (4, ""), (5, None), (None, text(12))]
    docs = [(i, text(rnd.randint(0, 60))) for i in range(40)]
    docs += [(100, f"start {items[0][1]} middle {items[1][1]} end"), (100, items[0][1]), (101, None), (102, ""), (None, items[1][1])]
    return docs, items


@pytest.mark.parametrize("table_bytes", [decontaminate.TABLE_BYTES, 0])
def test_scan_matches_plain_search(spark, table_bytes):
    docs, items = cases()
    d = spark.createDataFrame([(*x, 0) for x in docs], "doc_id long, text string, words int")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(d, b, table_bytes=table_bytes)
    got = [(r["_doc"]["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in got.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, plain_hits(docs, items)))
    kept = decontaminate.drop_contaminated(d, b, table_bytes=table_bytes)
    assert kept.columns == d.columns
    assert kept.count() == sum(1 for x in plain_hits(docs, items) if not x[2])


def test_spans_are_cut_out(spark):
    item = "one two three four five six seven eight nine ten eleven"
    docs = [(1, f"Keep this. {item.upper()}! And that."), (2, "Nothing here,  at all.\n"), (3, None), (4, item), (5, f"a {item} b {item} c")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r[0]: r[1] for r in decontaminate.remove_spans(d, b).collect()}
    assert got == {1: "Keep this! And that.", 2: docs[1][1], 3: None, 4: "", 5: "a b c"}


def test_no_items_and_no_documents(spark):
    d = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.drop_contaminated(d, none).count() == 1
    assert decontaminate.contamination(d.limit(0), none).count() == 0


def test_main_path_is_native(spark):
    d = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    for frame in (decontaminate.contamination(d, b), quality.quality(d)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Arrow|Pandas|Exchange|Join", plan)


def run_sql(name, **tables):
    con = duckdb.connect()
    for table, frame in tables.items():
        con.register(table, frame.toPandas())
    return con.sql(EXPECTED[name]).fetchall()


def test_quality_matches_sql_on_edge_cases(spark):
    clean = "The man and the dog were in the house of the old woman. " * 1
    texts = [None, "", " \n\t", "a b c a b c", "x " * 500, clean * 6, "line one here\nline one here\n\nline two\n \n" * 9]
    texts += [" ".join(f"w{i} & the" for i in range(90)), "é" * 300_000, " ".join(f"the word{i} of" for i in range(4000))]
    texts += ["#*$%&|<> " * 60, "\x1c \x0b\x0c\r", texts[4]]
    d = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, n_words int")
    columns = ["doc_id", *quality.MEASURES, "base_failed", "kept"]
    got = quality.quality(d).select("_doc.doc_id", *columns[1:]).collect()
    wanted = run_sql("op9_quality_rules", documents=d.drop("n_words"))
    assert sorted(map(tuple, got)) == sorted((r[0], r[1], r[2], r[3], r[4], r[5], r[6], r[7]) for r in wanted)
    assert quality.keep_good(d).columns == d.columns
    assert quality.quality(d.limit(0)).count() == 0


def test_leaks_sql_agrees_with_plain_search(spark):
    docs, items = cases()
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    wanted = {(k if k is not None else -1, n, h, hashlib.sha256(",".join(ids).encode()).hexdigest()) for k, n, h, ids in plain_hits(docs, items)}
    d = d.withColumn("doc_id", F.coalesce("doc_id", F.lit(-1)))
    b = b.withColumn("item_id", F.col("item_id").cast("string"))
    got = run_sql("op4_decontamination", documents=d, benchmark=b)
    assert {(r[0], r[1], r[2], r[4]) for r in got} == wanted
