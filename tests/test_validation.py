import pytest
from pyspark.sql import types as T

from broadsheet.operators.validation import check_columns, column_faults, split_stage
from broadsheet.schema import CATEGORY_LABELS, ENRICHED_TYPES

TEXT = T.StringType()
RAW_TYPES = {
    n: TEXT
    for n in ("article_id", "title", "company_name", "published_date", "category", "summary", "url", "author", "revenue", "word_count")
}
RAW = {
    "article_id": "BRD-7301",
    "title": "Harbour cranes get smarter eyes",
    "company_name": "Lumen Harbor",
    "published_date": "3 Jun 2017",
    "category": "cloud services",
    "summary": "Cameras count the boxes now.",
    "url": "https://daily.example.net/cranes",
    "author": "R. Okafor",
    "revenue": "",
    "word_count": "812",
}
CLEAN = RAW | {
    "published_date": "2017-06-03",
    "category": "Cloud_Computing",
    "revenue_usd": 4200,
    "pub_year": 2017,
    "pub_quarter": 2,
    "pub_month": 6,
}
ENRICHED = CLEAN | {
    "metadata_matched": True,
    "meta_founded_year": 1991,
    "meta_headquarters": "Oslo, Norway",
    "meta_employee_count": 31250,
    "meta_industry": "AI/ML",
    "meta_is_public": True,
    "meta_stock_ticker": "LUHA",
    "company_age": 26,
    "company_size_category": "Large",
}
BASE = {"raw": RAW, "clean": CLEAN, "enriched": ENRICHED}

REJECTED = {
    "raw": [
        ({"title": None}, {("title", "missing")}),
        ({"article_id": ""}, {("article_id", "empty")}),
        ({"company_name": ""}, {("company_name", "empty")}),
        ({"summary": "   "}, {("summary", "empty")}),
        ({"url": "daily.example.net/cranes"}, {("url", "no http scheme")}),
        ({"url": "gopher://daily.example.net"}, {("url", "no http scheme")}),
        ({"article_id": "BRD#7301"}, {("article_id", "unexpected characters")}),
        ({"author": None}, {("author", "missing")}),
        ({"author": None, "summary": "", "url": None}, {("author", "missing"), ("summary", "empty"), ("url", "missing")}),
    ],
    "clean": [
        ({"revenue_usd": -350}, {("revenue_usd", "below 0")}),
        ({"revenue_usd": None}, {("revenue_usd", "not a whole number")}),
        ({"category": "Gardening"}, {("category", "not an allowed label")}),
        ({"category": " AI_ML "}, {("category", "not an allowed label")}),
        ({"category": None}, {("category", "not an allowed label")}),
        ({"published_date": "3 Jun 2017"}, {("published_date", "not an ISO date")}),
        ({"published_date": "06/03/2017"}, {("published_date", "not an ISO date")}),
        ({"pub_year": 1899}, {("pub_year", "below 1900")}),
        ({"pub_year": 2101}, {("pub_year", "above 2100")}),
        ({"pub_quarter": 0}, {("pub_quarter", "below 1")}),
        ({"pub_quarter": 5}, {("pub_quarter", "above 4")}),
        ({"pub_month": 0}, {("pub_month", "below 1")}),
        ({"pub_month": 13}, {("pub_month", "above 12")}),
        ({"pub_month": None}, {("<row>", "date parts partly missing")}),
        ({"pub_year": None, "pub_month": None}, {("<row>", "date parts partly missing")}),
        # a row rule stays silent while a field fails
        ({"pub_year": None, "revenue_usd": -350}, {("revenue_usd", "below 0")}),
    ],
    "enriched": [
        ({"meta_founded_year": None}, {("<row>", "matched without founding year")}),
        ({"meta_employee_count": -7}, {("meta_employee_count", "below 0")}),
        ({"meta_founded_year": 1799}, {("meta_founded_year", "below 1800")}),
        ({"meta_founded_year": 2101}, {("meta_founded_year", "above 2100")}),
        ({"company_age": 301}, {("company_age", "above 300")}),
        ({"company_age": -44}, {("company_age", "below -10")}),
        ({"company_size_category": "Huge"}, {("company_size_category", "not an allowed label")}),
        ({"metadata_matched": None}, {("metadata_matched", "missing")}),
        ({"meta_founded_year": None, "pub_month": None}, {("<row>", "date parts partly missing")}),
    ],
}
ACCEPTED = {
    "raw": [{}, {"author": ""}, {"url": "http://x.example"}, {"revenue": None}, {"word_count": None}, {"company_name": " Lumen Harbor "}, {"article_id": "a_b-9"}],
    "clean": [
        {},
        {"revenue_usd": 10**10},
        {"published_date": "", "pub_year": None, "pub_quarter": None, "pub_month": None},
        {"pub_year": 1900},
        {"pub_year": 2100},
        *[{"category": c} for c in CATEGORY_LABELS],
        *[{"pub_quarter": q} for q in range(1, 5)],
        *[{"pub_month": m} for m in range(1, 13)],
    ],
    "enriched": [
        {},
        {"metadata_matched": False, "meta_founded_year": None},
        {"meta_employee_count": 0},
        {"meta_founded_year": 1800},
        {"company_age": None},
        {"company_age": -5},
        *[{"company_size_category": s} for s in ("Small", "Medium", "Large", "Unknown")],
    ],
}


def table(spark, stage, changes):
    kinds = RAW_TYPES | ENRICHED_TYPES
    names = [*BASE[stage], "extra"]
    schema = T.StructType([T.StructField(n, kinds.get(n, TEXT)) for n in [*names, "case"]])
    rows = []
    for i, change in enumerate(changes):
        row = BASE[stage] | {"extra": "kept"} | change
        rows.append(tuple(row[n] for n in names) + (str(i),))
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("stage", ["raw", "clean", "enriched"])
def test_stage(spark, stage):
    bad = [c for c, _ in REJECTED[stage]]
    good = ACCEPTED[stage]
    df = table(spark, stage, bad + good)
    result = split_stage(df, stage)
    kept = result.valid.collect()
    assert result.valid.columns == df.columns
    assert sorted(int(r.case) for r in kept) == list(range(len(bad), len(bad) + len(good)))
    # several faults in a row count once
    assert result.counts.get == {"rows": len(bad) + len(good), "failed": len(bad)}


@pytest.mark.parametrize("stage", ["raw", "clean", "enriched"])
def test_faults(spark, stage):
    for i, (change, want) in enumerate(REJECTED[stage]):
        change = change if "article_id" in change else change | {"article_id": f"X{i}"}
        REJECTED[stage][i] = (change, want)
    df = table(spark, stage, [c for c, _ in REJECTED[stage]])
    got: dict[str, set] = {}
    for r in split_stage(df, stage).rejects.collect():
        assert r.stage == stage
        got.setdefault(r.article_id, set()).add((r.field, r.rule))
    for change, want in REJECTED[stage]:
        assert got[change["article_id"]] == want


def test_survivors_stay_unstripped(spark):
    kept = split_stage(table(spark, "raw", [{"company_name": " Lumen Harbor "}]), "raw").valid.first()
    assert kept.company_name == " Lumen Harbor "


@pytest.mark.parametrize("stage,column", [("raw", "url"), ("raw", "author"), ("clean", "revenue_usd"), ("enriched", "company_age")])
def test_missing_column(spark, stage, column):
    df = table(spark, stage, [{}]).drop(column)
    with pytest.raises(ValueError, match=column):
        check_columns(df, stage)
    with pytest.raises(ValueError, match=column):
        split_stage(df, stage)
    check_columns(df.limit(0), stage)


def test_optional_columns_may_be_absent(spark):
    df = table(spark, "raw", [{}]).drop("revenue", "word_count")
    assert split_stage(df, "raw").valid.count() == 1


def test_unknown_stage_passes(spark):
    df = table(spark, "raw", [{}, {"title": None}])
    assert split_stage(df, "nowhere").valid.count() == 2
    check_columns(df, "nowhere")


def test_numbers_and_flags_as_text_or_doubles(spark):
    kinds = {"company_age": "double", "meta_employee_count": "string", "metadata_matched": "string", "pub_year": "string"}
    cases = [
        ({"company_age": 5.0, "meta_employee_count": "12.0", "pub_year": "2017"}, set()),
        ({"company_age": 5.5}, {("company_age", "not a whole number")}),
        ({"meta_employee_count": "many"}, {("meta_employee_count", "not a whole number")}),
        ({"pub_year": "2017.25"}, {("pub_year", "not a whole number")}),
        ({"metadata_matched": "banana"}, {("metadata_matched", "not a flag")}),
        ({"metadata_matched": "false", "meta_founded_year": None}, set()),
        ({"company_age": float("nan")}, {("company_age", "not a whole number")}),
    ]
    names = list(ENRICHED)
    types = {n: kinds.get(n) or (RAW_TYPES | ENRICHED_TYPES)[n].simpleString() for n in names}
    base = ENRICHED | {"company_age": 26.0, "meta_employee_count": "31250", "metadata_matched": "true", "pub_year": "2017"}
    rows = [tuple((base | change | {"article_id": f"N{i}"})[n] for n in names) for i, (change, _) in enumerate(cases)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} {t}" for n, t in types.items()))
    found = {i: set() for i in range(len(cases))}
    for r in split_stage(df, "enriched").rejects.collect():
        found[int(r.article_id[1:])].add((r.field, r.rule))
    assert found == {i: want for i, (_, want) in enumerate(cases)}


def _faults(spark, kinds, base, cases):
    names = list(ENRICHED)
    types = {n: kinds.get(n) or (RAW_TYPES | ENRICHED_TYPES)[n].simpleString() for n in names}
    rows = [tuple((base | change | {"article_id": f"N{i}"})[n] for n in names) for i, (change, _) in enumerate(cases)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} {t}" for n, t in types.items()))
    found = {i: set() for i in range(len(cases))}
    for r in split_stage(df, "enriched").rejects.collect():
        found[int(r.article_id[1:])].add((r.field, r.rule))
    return found


def test_typed_rules_follow_the_reference_fields(spark):
    """Text numbers by a strict grammar, flags by their spellings, integers as integers."""
    kinds = {"meta_employee_count": "string", "metadata_matched": "string", "company_age": "bigint"}
    base = ENRICHED | {"meta_employee_count": "31250", "metadata_matched": "true", "company_age": 26}
    cases = [
        ({"meta_employee_count": "5d"}, {("meta_employee_count", "not a whole number")}),
        ({"meta_employee_count": "1e3"}, {("meta_employee_count", "not a whole number")}),
        ({"meta_employee_count": "1_000"}, set()),
        ({"meta_employee_count": " +12 "}, set()),
        ({"meta_employee_count": "-3"}, {("meta_employee_count", "below 0")}),
        ({"metadata_matched": "on"}, set()),
        ({"metadata_matched": "OFF", "meta_founded_year": None}, set()),
        ({"metadata_matched": "1.0"}, {("metadata_matched", "not a flag")}),
        ({"company_age": 301}, {("company_age", "above 300")}),
        ({"company_age": 2**62 + 1}, {("company_age", "above 300")}),
    ]
    assert _faults(spark, kinds, base, cases) == {i: want for i, (_, want) in enumerate(cases)}
    numbers = {"metadata_matched": "double"}
    flags = [({"metadata_matched": 1.0}, set()), ({"metadata_matched": 0.0, "meta_founded_year": None}, set()), ({"metadata_matched": 0.5}, {("metadata_matched", "not a flag")})]
    assert _faults(spark, numbers, ENRICHED | {"metadata_matched": 1.0}, flags) == {i: want for i, (_, want) in enumerate(flags)}


def test_absent_columns_as_rows(spark):
    df = table(spark, "raw", [{}, {}]).drop("url")
    assert [tuple(r) for r in column_faults(df, "raw").collect()] == [("raw", "url", 2)]
    assert column_faults(df.limit(0), "raw").count() == column_faults(df, "nowhere").count() == 0
