"""Article tables derived from the order and embedding tables.

No article table is given, so one is spelled out from the numbers and dates of
``orders``: every amount, date, category and company name is written in one of
several messy ways that the order key selects.  What cleaning must recover is
therefore known without parsing any text.  A third of the articles are about
one company.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.functions.categories import CATEGORY_MAP
from broadsheet.session import spread
from broadsheet.sources.companies import COMPANIES

COMPANY_NAMES = [row[0] for row in COMPANIES]
RAW_CATEGORIES = [*CATEGORY_MAP, "hardware", "AgTech"]
NAME_FORMS = 5
YEARS_AHEAD = 22


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k() -> Column:
    return F.col("o_orderkey")


def _choice(number: Column, texts: list[Column]) -> Column:
    chosen = F
    for i, text in enumerate(texts):
        chosen = chosen.when(number == i, text)
    return chosen


def _div(number: Column, by: int) -> Column:
    return F.floor(number / by).cast("bigint")


def article_key(key: Column) -> Column:
    return F.concat(F.lit("ART"), key.cast("string"))


def spelled_name(index: int, form: int) -> str:
    """The company name as the articles of this index and form spell it."""
    name = COMPANY_NAMES[index]
    return [name, name.upper(), f" {name} ", name[:1] + name[2:], f"Quux Holdings {index}"][form]


def _company(k: Column) -> Column:
    index = F.when(k % 3 == 0, F.lit(0)).otherwise(_div(k, 3) % len(COMPANY_NAMES)).cast("int")
    form = (_div(k, 63) % NAME_FORMS).cast("int")
    names = F.lit([spelled_name(i, f) for i in range(len(COMPANY_NAMES)) for f in range(NAME_FORMS)])
    return F.get(names, index * NAME_FORMS + form)


def _category(k: Column) -> Column:
    raw = F.get(F.lit(RAW_CATEGORIES), (_div(k, 5) % len(RAW_CATEGORIES)).cast("int"))
    return _choice(k % 3, [raw, F.upper(raw), F.concat(F.lit("\t"), raw, F.lit("  "))])


def _revenue(k: Column) -> Column:
    n = F.floor("o_totalprice").cast("bigint")

    def text(*parts) -> Column:
        return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])

    nothing = _choice(_div(k, 10) % 4, [F.lit("Not disclosed"), F.lit("N/A"), F.lit("--"), F.lit("")])
    return _choice(
        k % 10,
        [
            text("$", F.format_number(n, 0)),
            text("£", n),
            text("€", n, "K"),
            text(n, "K usd"),
            text("¥", F.format_number(n * 100, 0)),
            text("$", n, "K - $", n + 10, "K"),
            text(n, ".5 million EUR"),
            nothing,
            text("GBP ", n, " to ", n + 3),
            text(n, "M GBP"),
        ],
    )


def _date(k: Column) -> Column:
    day = F.add_months(F.col("o_orderdate").cast("date"), 12 * YEARS_AHEAD)
    patterns = [
        "yyyy-MM-dd",
        "yyyy-MM-dd'T'00:00:00'Z'",
        "MM/dd/yyyy",
        "dd/MM/yyyy",
        "dd-MM-yyyy",
        "d MMM yyyy",
        "MMMM d, yyyy",
    ]
    spelled = [F.date_format(day, p) for p in patterns]
    spelled.append(F.when(k % 4 == 0, F.lit("N/A")).otherwise(F.date_format(day, "dd MMMM yyyy")))
    spelled.append(F.date_format(day, "MMM d, yyyy"))
    return _choice(_div(k, 10) % 9, spelled)


def raw_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw article per order, some of them faulty."""
    k = _k()
    orders = spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"))
    return orders.select(
        F.when(k % 97 == 0, F.concat(F.lit("ART "), k.cast("string"), F.lit("!!"))).otherwise(article_key(k)).alias("article_id"),
        F.when(k % 89 == 0, F.lit("   ")).otherwise(F.concat(F.lit('Market "brief" '), k.cast("string"))).alias("title"),
        _company(k).alias("company_name"),
        _date(k).alias("published_date"),
        _category(k).alias("category"),
        F.when(k % 71 == 0, F.lit("")).otherwise(F.concat(F.lit("Deal, priority\n"), "o_orderpriority")).alias("summary"),
        F.concat(F.when(k % 83 == 0, F.lit("ftp")).otherwise(F.lit("https")), F.lit("://news.example.com/a/"), k.cast("string")).alias("url"),
        F.when(k % 79 == 0, F.lit(None)).when(k % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("Writer "), (F.col("o_custkey") % 100).cast("string"))).alias("author"),
        _revenue(k).alias("revenue"),
        (k % 900 + 100).cast("string").alias("word_count"),
    )


def article_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One vector per row of ``embeddings``, keyed like the article of that order."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(article_key(F.col("vec_id")).alias("article_id"), "embedding", "label")
