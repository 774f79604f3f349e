"""Readers, writers and whole jobs on small files."""

import csv
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from broadsheet.operators.embedding import DIMENSIONS, HashedWords, LoadedModel, embed, text_to_embed
from broadsheet.operators.relevance import (
    DEFAULT_SETS,
    RelevanceSets,
    export_condition,
    keep_matching,
    keep_relevant,
)
from broadsheet.plans.enrichment import enrich, run_enrichment
from broadsheet.plans.search import SearchSession, duplicate_ids
from broadsheet.plans.similarity_export import run_similarity_export, similarity_export
from broadsheet.schema import EXPORT_COLUMNS, OUTPUT_COLUMNS, RAW_COLUMNS
from broadsheet.session import shared_dir
from broadsheet.sources.articles import read_articles_csv, read_enriched
from broadsheet.sources.companies import COMPANIES, default_companies
from broadsheet.sources.exports import write_enriched
from tests.test_validation import ENRICHED, RAW

FIELDS = ("founded_year", "headquarters", "employee_count", "industry", "is_public", "stock_ticker")


def read_back(folder):
    """Rows of a written CSV folder, by the standard reader."""
    rows = []
    for part in sorted(folder.glob("part-*.csv")):
        with open(part, newline="", encoding="utf-8") as f:
            rows += list(csv.DictReader(f))
    return rows


@pytest.fixture
def companies_json(tmp_path):
    path = tmp_path / "companies.json"
    path.write_text(json.dumps({row[0]: dict(zip(FIELDS, row[1:])) for row in COMPANIES}), encoding="utf-8")
    return str(path)


def write_raw(path, rows, columns=RAW_COLUMNS):
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.DictWriter(f, fieldnames=columns)
        out.writeheader()
        out.writerows(rows)


def test_csv_agrees_with_the_standard_reader(spark, tmp_path):
    path = tmp_path / "odd.csv"
    path.write_text(
        'b,a,c,a\n'
        '1,"x\ny",3,"quo""ted"\n'
        ' padded ,"",,last\n'
        "\n"
        "short,2\n"
        "1,2,3,4,surplus\n"
        'é,"a,b",–,€\n',
        encoding="utf-8",
    )
    with open(path, newline="", encoding="utf-8") as f:
        want = [(r["a"], r["b"], r["c"], None in r) for r in csv.DictReader(f)]
    got = [(r.a, r.b, r.c, r._surplus_cells) for r in read_articles_csv(spark, str(path)).collect()]
    assert got == want


def test_columns_bind_by_name(spark, tmp_path):
    write_raw(tmp_path / "r.csv", [RAW], list(reversed(RAW_COLUMNS)))
    assert read_articles_csv(spark, str(tmp_path / "r.csv")).select(*RAW_COLUMNS).first().asDict() == RAW


def test_files_with_another_header_are_refused(spark, tmp_path):
    write_raw(tmp_path / "a.csv", [RAW])
    write_raw(tmp_path / "b.csv", [RAW], list(reversed(RAW_COLUMNS)))
    with pytest.raises(Exception):
        read_articles_csv(spark, str(tmp_path)).collect()


def test_enrichment_job(spark, tmp_path, companies_json):
    rows = [
        RAW | {"article_id": "A1", "revenue": "$5.2B", "published_date": "21 Feb 2022"},
        RAW | {"article_id": "A2", "company_name": "kestrel insight", "category": " big data ", "author": ""},
        RAW | {"article_id": "A3", "company_name": "Vela, Inc", "category": "SaaS"},
        RAW | {"article_id": "A4", "company_name": "Nobody", "category": "gardening"},
        RAW | {"article_id": "A 5"},
        RAW | {"article_id": "A6", "url": "nowhere", "title": " "},
        RAW | {"article_id": "A7", "published_date": "N/A"},
        RAW | {"article_id": "A8", "revenue": "9" * 400},
    ]
    write_raw(tmp_path / "raw.csv", rows)
    counts = run_enrichment(
        spark, str(tmp_path / "raw.csv"), companies_json, str(tmp_path / "out"), rejects_path=str(tmp_path / "bad")
    )
    out = {r["article_id"]: r for r in read_back(tmp_path / "out")}
    assert list(out) and set(out) == {"A1", "A2", "A3", "A4", "A8"}
    assert list(out["A1"]) == OUTPUT_COLUMNS
    a1, a2, a4 = out["A1"], out["A2"], out["A4"]
    assert (a1["revenue_usd"], a1["published_date"], a1["category"], a1["company_age"]) == ("5200000000", "2022-02-21", "Cloud_Computing", "31")
    assert (a2["category"], a2["meta_industry"], a2["author"], a2["company_age"]) == ("Data_Analytics", "Data Analytics", "", "10")
    assert (a4["metadata_matched"], a4["meta_industry"], a4["company_size_category"], a4["category"]) == ("false", "", "Unknown", "Unknown")
    assert counts == {
        "rows_read": 8, "failed_raw": 2, "rows_after_raw": 6, "failed_clean": 1, "revenue_errors": 1,
        "matched": 3, "unmatched": 2, "retained": 5,
        "failed_enriched": 0, "exported": 5,
    }
    # every row is either exported or refused at one stage
    assert counts["rows_read"] == counts["failed_raw"] + counts["failed_clean"] + counts["failed_enriched"] + counts["exported"]
    bad = {(r.article_id, r.stage, r.field) for r in spark.read.parquet(str(tmp_path / "bad")).collect()}
    assert bad == {
        ("A 5", "raw", "article_id"), ("A6", "raw", "url"), ("A6", "raw", "title"), ("A7", "clean", "published_date")
    }


def test_enrichment_job_with_filter(spark, tmp_path, companies_json):
    rows = [RAW | {"article_id": "A1"}, RAW | {"article_id": "A2", "company_name": "Vela Payments"}, RAW | {"article_id": "A3", "company_name": "x", "category": "AI/ML"}]
    write_raw(tmp_path / "raw.csv", rows)
    args = (spark, str(tmp_path / "raw.csv"), companies_json, str(tmp_path / "out"))
    counts = run_enrichment(*args, apply_filter=True)
    assert {r["article_id"] for r in read_back(tmp_path / "out")} == {"A1", "A3"}
    assert (counts["matched"], counts["retained"], counts["exported"]) == (2, 2, 2)
    only = RelevanceSets(frozenset(), frozenset(["FinTech"]))
    run_enrichment(*args, sets=only, apply_filter=True)
    assert {r["article_id"] for r in read_back(tmp_path / "out")} == {"A2"}


def test_no_rows_still_give_a_header(spark, tmp_path, companies_json):
    write_raw(tmp_path / "raw.csv", [])
    counts = run_enrichment(spark, str(tmp_path / "raw.csv"), companies_json, str(tmp_path / "out"))
    assert counts["rows_read"] == counts["exported"] == 0
    parts = list((tmp_path / "out").glob("part-*.csv"))
    assert [p.read_text().strip() for p in parts] == [",".join(OUTPUT_COLUMNS)]


def test_enrichment_plan_is_one_pass(spark):
    raw = spark.createDataFrame([tuple(RAW.values())], list(RAW))
    plan = enrich(raw, default_companies(spark), DEFAULT_SETS)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "EvalPython" not in plan
    assert plan.count("BroadcastHashJoin") == 1


def test_typed_table_survives_other_spellings(spark, tmp_path):
    row = ENRICHED | {"pub_year": "2020.0", "metadata_matched": "True", "meta_is_public": "False", "company_age": "17.0", "meta_stock_ticker": ""}
    write_raw(tmp_path / "e.csv", [{c: row[c] for c in OUTPUT_COLUMNS}], OUTPUT_COLUMNS)
    r = read_enriched(spark, str(tmp_path / "e.csv")).first()
    assert (r.pub_year, r.metadata_matched, r.meta_is_public, r.company_age, r.meta_stock_ticker) == (2020, True, False, 17, None)
    with pytest.raises(ValueError, match="missing"):
        write_raw(tmp_path / "f.csv", [RAW])
        read_enriched(spark, str(tmp_path / "f.csv"))


def test_parquet_round_trip(spark, tmp_path):
    write_raw(tmp_path / "e.csv", [{c: ENRICHED[c] for c in OUTPUT_COLUMNS}], OUTPUT_COLUMNS)
    first = read_enriched(spark, str(tmp_path / "e.csv"))
    write_enriched(first, str(tmp_path / "p"), "parquet")
    again = read_enriched(spark, str(tmp_path / "p"), "parquet")
    assert again.schema == first.schema and again.collect() == first.collect()


# ---- filters ----


def test_relevance_filter(spark):
    rows = [("1", "AI_ML", "Finance"), ("2", "SaaS_Software", "AI/ML"), ("3", "Data_Analytics", "Data Analytics"), ("4", "FinTech", "Cloud Computing"), ("5", None, None), ("6", "ai_ml", "ai/ml")]
    df = spark.createDataFrame(rows, "article_id string, category string, meta_industry string")
    assert [r.article_id for r in keep_relevant(df).collect()] == ["1", "2", "3"]
    assert keep_relevant(df, RelevanceSets()).count() == 0
    assert [r.article_id for r in keep_relevant(df, RelevanceSets(categories=frozenset(["FinTech"]))).collect()] == ["4"]


def test_relevance_configuration():
    good = {"ai_relevant_categories": ["AI_ML"], "ai_relevant_industries": [], "more": 1}
    assert RelevanceSets.from_mapping(good) == RelevanceSets(frozenset(["AI_ML"]), frozenset())
    for bad, word in [
        (["AI_ML"], "mapping"),
        (None, "mapping"),
        ({"ai_relevant_industries": []}, "ai_relevant_categories"),
        ({"ai_relevant_categories": []}, "ai_relevant_industries"),
        (good | {"ai_relevant_categories": "AI_ML"}, "list"),
        (good | {"ai_relevant_industries": {"a": 1}}, "list"),
        (good | {"ai_relevant_industries": [1]}, "strings"),
    ]:
        with pytest.raises(ValueError, match=word):
            RelevanceSets.from_mapping(bad)


# ---- search ----

SEARCH = [
    ("ART0001", "Crane pilots sign a pact", "Cameras label the boxes.", "Lumen Harbor", 2020, "FinTech", 0, "AI/ML"),
    ("ART0002", "Orchard software on large vine maps", "Large vine maps for all.", "Cobalt Orchard", 2023, "SaaS_Software", 91_000_000, "Cloud Computing"),
    ("ART0003", "Kestrel yearly numbers", "Record yearly numbers for Kestrel.", "Kestrel Insight", 2022, "AI_ML", 7_200_000_000, "AI/ML"),
]


@pytest.fixture
def search_table(spark):
    df = spark.createDataFrame(SEARCH, "article_id string, title string, summary string, company_name string, pub_year int, category string, revenue_usd bigint, meta_industry string")
    rest = {c: F.lit(None).cast("string") for _, (c, _) in enumerate(EXPORT_COLUMNS) if c not in df.columns and c not in ("embedding", "top_similar_articles")}
    return df.withColumns(rest)


@pytest.fixture
def session(spark, search_table):
    session = SearchSession(spark, HashedWords())
    session.load(search_table)
    return session


def test_search(session):
    assert session.sql("SELECT count(*) AS count FROM articles").first()["count"] == 3
    assert len(session.articles.first().embedding) == DIMENSIONS
    hits = session.find_similar("ART0001", 2).collect()
    assert len(hits) == 2 and hits[0].article_id == "ART0001" and abs(hits[0].score - 1) < 1e-9
    assert session.find_similar("Kestrel yearly numbers", 1).first().article_id == "ART0003"
    assert [r.article_id for r in session.hybrid_search("ART0002", "category = 'AI_ML'", 1).collect()] == ["ART0003"]
    ranked = session.hybrid_search("large vine maps", "pub_year BETWEEN 2022 AND 2024 AND revenue_usd >= 50000000", 2)
    assert [r.article_id for r in ranked.collect()] == ["ART0002", "ART0003"]
    assert session.hybrid_search("ART0001", "pub_year > 3000").count() == 0
    assert session.find_similar("ART0001", 0).count() == 0
    assert session.sql("SELECT title FROM articles WHERE article_id = :id", {"id": "ART0003"}).count() == 1


def test_hydrated_hits_keep_their_order(session):
    hits = session.find_similar("ART0003", 3)
    shown = session.hydrate(hits, "title").collect()
    assert [r.article_id for r in shown] == [r.article_id for r in hits.collect()]
    assert shown[0].title == "Kestrel yearly numbers"


def test_repeated_ids_lose_no_hit(spark, search_table):
    """Each row of a repeated id is a hit of its own and keeps its own columns."""
    session = SearchSession(spark, HashedWords(), view="repeated")
    session.load(search_table.union(search_table.withColumn("title", F.concat(F.lit("Again: "), "title"))))
    shown = session.hydrate(session.find_similar("Kestrel yearly numbers", 6), "title").collect()
    assert len(shown) == 6 and len({(r.article_id, r.title) for r in shown}) == 6
    out = similarity_export(session.articles).collect()
    assert [r.article_id for r in out] == ["ART0003", "ART0003"]
    assert all(len(r.top_similar_articles) == 3 and r.top_similar_articles[0] == "ART0003" for r in out)


def test_search_plan_reads_only_what_it_needs(session):
    plan = session.hybrid_search("ART0001", "pub_year = 2022")._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line)
    assert "EqualTo(pub_year,2022)" in scan and "summary" not in scan.split("ReadSchema")[1]


def test_load_replaces(session, search_table):
    session.load(search_table.where("article_id = 'ART0002'"))
    assert session.sql("SELECT article_id FROM articles").collect()[0].article_id == "ART0002"
    assert session.articles.count() == 1


def test_search_errors(spark, session):
    empty = SearchSession(spark)
    assert not empty.is_loaded
    for call in (lambda: empty.find_similar("x"), lambda: empty.hybrid_search("x", "true"), lambda: empty.query_vector("x")):
        with pytest.raises(ValueError, match="load"):
            call()
    with pytest.raises(ValueError, match="negative"):
        session.find_similar("ART0001", -1)
    with pytest.raises(Exception):
        session.hybrid_search("ART0001", "true; drop table articles")
    bare = SearchSession(spark, view="bare")
    bare.load(session.articles)
    assert bare.hybrid_search("some text", "pub_year > 3000").count() == 0
    with pytest.raises(ValueError, match="embedder"):
        bare.hybrid_search("some text", "pub_year > 2000")
    with pytest.raises(ValueError, match="embedder"):
        empty.load(spark.createDataFrame([("a",)], "article_id string"))


def test_duplicate_ids_are_reported(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",)], "article_id string")
    assert [tuple(r) for r in duplicate_ids(df).collect()] == [("a", 2)]


def test_user_predicate(spark):
    df = spark.range(5)
    assert keep_matching(df, "id >= 2 AND id <> 3").count() == 2


# ---- embedding ----


def test_text_to_embed(spark):
    df = spark.createDataFrame([("a", "b"), (None, "b"), ("a", None), (None, None)], "title string, summary string")
    assert [r[0] for r in df.select(text_to_embed()).collect()] == ["a. b", ". b", "a. ", ". "]


def test_hashed_words(spark):
    df = spark.createDataFrame([(i, f"word{i} shared", "é ü") for i in range(20)] + [(99, None, None)], "i int, title string, summary string")
    fitted = HashedWords().fit(df.withColumn("t", text_to_embed()), "t")
    got = {r.i: np.array(r.embedding) for r in embed(df, fitted).collect()}
    assert all(len(v) == DIMENSIONS for v in got.values())
    assert np.allclose([np.linalg.norm(got[i]) for i in range(20)], 1) and not got[99].any()
    with pytest.raises(ValueError, match="fit"):
        HashedWords().transform(df, "title")


def test_loaded_model(spark):
    def load():
        return lambda texts: np.array([[len(t), t.count("a")] for t in texts], dtype=np.float32)

    df = spark.createDataFrame([(1, "aba"), (2, None), (3, "xyz")], "i int, t string").repartition(1)
    out = LoadedModel(load, rows=2).fit(df, "t").transform(df, "t").collect()
    assert {r.i: list(r.embedding) for r in out} == {1: [3, 2], 2: [0, 0], 3: [3, 0]}


# ---- similarity job ----


def test_similarity_job(spark, tmp_path):
    base = {c: ENRICHED[c] for c in OUTPUT_COLUMNS}
    rows = [
        base | {"article_id": f"A{i}", "title": f"t{i % 4} word{i}", "category": "AI_ML" if i % 2 else "FinTech", "meta_industry": "SaaS", "pub_year": 2020 + i % 5, "revenue_usd": 10**8}
        for i in range(20)
    ]
    write_raw(tmp_path / "e.csv", rows, OUTPUT_COLUMNS)
    run_similarity_export(spark, str(tmp_path / "e.csv"), str(tmp_path / "out"))
    out = read_back(tmp_path / "out")
    want = {r["article_id"] for r in rows if r["category"] == "AI_ML" and 2022 <= r["pub_year"] <= 2024}
    assert {r["article_id"] for r in out} == want and len(out) == len(want)
    assert list(out[0]) == [name for _, name in EXPORT_COLUMNS]
    for r in out:
        near = json.loads(r["top_similar_articles"])
        assert len(near) == 3 and r["article_id"] not in near and len(json.loads(r["embedding"])) == DIMENSIONS


def test_stored_vectors_are_counts(spark):
    """The table keeps word counts, split once, and gives the vectors of the fitted embedder."""
    from broadsheet.plans.search import store_embedded

    rows = [(f"A{i}", f"word{i % 7} word{i % 7} shared", None if i % 5 == 0 else f"x{i % 3} y") for i in range(40)] + [(None, None, None)]
    df = spark.createDataFrame(rows, "article_id string, title string, summary string").repartition(3)
    fitted = HashedWords().fit(df.withColumn("t", text_to_embed()), "t")
    want = sorted((str(r.article_id), r.text_to_embed, list(r.embedding)) for r in embed(df, fitted).collect())
    stored = store_embedded(df, HashedWords(), "counted")
    assert stored.columns == ["article_id", "title", "summary", "text_to_embed", "embedding", "row_id"]
    assert sorted((str(r.article_id), r.text_to_embed, list(r.embedding)) for r in spark.table("counted").collect()) == want
    kept = spark.read.parquet(stored.inputFiles()[0].rsplit("/", 1)[0])
    assert "embedding" not in kept.columns and max(len(r.word_counts.indices) for r in kept.collect()) <= 6


def test_neighbours_come_from_the_whole_table(spark, search_table):
    vectors = {"ART0001": [1.0, 0.0], "ART0002": [0.0, 1.0], "ART0003": [1.0, 0.1]}
    df = search_table.withColumn("embedding", F.when(F.col("article_id") == "ART0001", F.lit(vectors["ART0001"])).when(F.col("article_id") == "ART0002", F.lit(vectors["ART0002"])).otherwise(F.lit(vectors["ART0003"])))
    out = similarity_export(df).collect()
    assert [(r.article_id, r.industry, r.top_similar_articles) for r in out] == [("ART0003", "AI/ML", ["ART0001", "ART0002"])]
    assert similarity_export(df, export_condition(2020, 2020, 0)).first().article_id == "ART0001"


# ---- session ----


def test_shared_folder_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir", shared_dir(spark))


def test_split_reader_equals_the_whole_file_reader(spark, tmp_path):
    from broadsheet.sources.articles import read_articles_csv, read_articles_csv_split
    from broadsheet.sources.exports import write_articles_csv

    texts = ["plain", 'with "quotes"', "two\nlines", "a\n\n\nblank run", '"\n"\n', "x\r\ny", "", None, "é ünï\ncode"]
    rows = [(f"A{i}", texts[i % len(texts)] if i % 7 else "long " * 300 + "\nend", str(i)) for i in range(600)]
    df = spark.createDataFrame(rows, "article_id string, summary string, title string").coalesce(1)
    path = str(tmp_path / "csv")
    write_articles_csv(df, path)
    whole = sorted(map(tuple, read_articles_csv(spark, path).collect()))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        assert spark.read.text(path).rdd.getNumPartitions() > 10  # ranges that cut records apart
        got = sorted(map(tuple, read_articles_csv_split(spark, path).collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == whole and len(got) == 600
