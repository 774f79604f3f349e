"""The registered queries: every operator over whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.functions.revenue import with_revenue
from broadsheet.operators.cleaning import with_category, with_dates
from broadsheet.operators.companies import BROADCAST_BYTES, attach_companies, resolve_names
from broadsheet.operators.embedding import HashedWords, embed, text_to_embed
from broadsheet.operators.relevance import DEFAULT_SETS, export_condition, keep_relevant
from broadsheet.operators.reporting import outcome_counters, profile, row_count
from broadsheet.operators.similarity import neighbour_ids, neighbours
from broadsheet.operators.validation import column_faults, reject_table, split_stage
from broadsheet.plans.enrichment import enrich, enrich_tagged, run_enrichment
from broadsheet.plans.order_articles import article_vectors, raw_articles, table
from broadsheet.plans.search import SearchSession, attach_vectors, store_articles, store_embedded
from broadsheet.plans.similarity_export import export_projection, run_similarity_export, similarity_export
from broadsheet.schema import COMPANY_FIELDS, EXPORT_COLUMNS, OUTPUT_COLUMNS, RAW_COLUMNS
from broadsheet.session import configure, new_folder, spread
from broadsheet.sources.articles import read_articles_csv, read_articles_csv_split, read_enriched
from broadsheet.sources.companies import default_companies, parse_companies, write_companies_json
from broadsheet.sources.exports import write_articles_csv, write_enriched, write_export

QUERY_ID = "ART42"
QUERY_TEXT = "the heon and thing of that in the on une les der schen"
FLAT_EXPORT = [name for _, name in EXPORT_COLUMNS if name not in ("embedding", "top_similar_articles")]


def clean_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_revenue(raw_articles(spark, sf_dir)).select("article_id", "revenue_usd")


def clean_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_dates(raw_articles(spark, sf_dir)).select(
        "article_id", "published_date", "pub_year", "pub_quarter", "pub_month"
    )


def clean_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_category(raw_articles(spark, sf_dir)).select("article_id", "category")


def _tagged(spark: SparkSession, sf_dir: str, sets=None) -> DataFrame:
    return enrich_tagged(raw_articles(spark, sf_dir), default_companies(spark), sets)


def validate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tagged(spark, sf_dir, DEFAULT_SETS).agg(*outcome_counters())


def validate_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reject_table(_tagged(spark, sf_dir))


def validate_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of enriched rows whose fields come back as text, some of them spoiled."""
    k = F.regexp_extract("article_id", "([0-9]+)", 1).cast("bigint")
    rows = enrich_articles(spark, sf_dir).withColumns(
        {
            "company_age": F.when(k % 13 == 0, F.lit("301")).otherwise(F.concat(F.col("company_age").cast("string"), F.lit(".0"))),
            "metadata_matched": F.when(k % 17 == 0, F.lit("banana")).otherwise(F.col("metadata_matched").cast("string")),
            "meta_employee_count": F.when(k % 19 == 0, F.lit("5.5")).otherwise(F.col("meta_employee_count").cast("double").cast("string")),
            "meta_founded_year": F.when(k % 23 != 0, F.col("meta_founded_year").cast("string")),
        }
    )
    return split_stage(rows, "enriched").rejects


def missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Required columns that a table lacks at each stage, and how many rows that refuses."""
    raw = raw_articles(spark, sf_dir).drop("url", "author")
    clean = enrich_articles(spark, sf_dir).drop("pub_year")
    return column_faults(raw, "raw").union(column_faults(clean, "clean")).union(column_faults(clean, "enriched"))


def resolve_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = raw_articles(spark, sf_dir).select(F.col("company_name").alias("name"))
    return resolve_names(names, default_companies(spark))


def enrich_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(raw_articles(spark, sf_dir), default_companies(spark))


def relevance_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = keep_relevant(enrich_articles(spark, sf_dir))
    return kept.select("article_id", "category", "meta_industry")


def profile_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile(enrich(raw_articles(spark, sf_dir), default_companies(spark), DEFAULT_SETS), "category")


def profile_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = enrich(raw_articles(spark, sf_dir), default_companies(spark), DEFAULT_SETS)
    return profile(kept, "company_size_category")


def export_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = enrich_articles(spark, sf_dir).where(export_condition())
    none = F.lit(None).cast("array<float>")
    return export_projection(rows.withColumns({"embedding": none, "top_similar_articles": none})).select(*FLAT_EXPORT)


def _loaded(spark: SparkSession, sf_dir: str, view: str) -> SearchSession:
    session = SearchSession(spark, view=view)
    vectors = article_vectors(spark, sf_dir)
    session.load(vectors.select("article_id", F.concat(F.lit("Note "), "article_id").alias("title"), "label", "embedding"))
    return session


def _rounded(hits: DataFrame, *more: str) -> DataFrame:
    return hits.select("article_id", F.round("score", 6).alias("score"), *more)


def knn_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_loaded(spark, sf_dir, "articles_knn").find_similar(QUERY_ID, 5))


def knn_hydrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    session = _loaded(spark, sf_dir, "articles_hydrated")
    return _rounded(session.hydrate(session.find_similar(QUERY_ID, 10), "title", "label"), "title", "label")


def hybrid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    session = _loaded(spark, sf_dir, "articles_hybrid")
    return _rounded(session.hybrid_search(QUERY_ID, "label >= 3 AND label BETWEEN 0 AND 6", 5))


def top3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neighbours(article_vectors(spark, sf_dir), k=3)
    return found.select("article_id", F.posexplode("neighbours").alias("pos", "hit")).select(
        "article_id",
        (F.col("pos") + 1).alias("rank"),
        F.col("hit.id").alias("neighbour"),
        F.round("hit.score", 6).alias("score"),
    )


def top3_neighbours_blocked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The form for tables too large to broadcast, forced on the same table."""
    vectors = article_vectors(spark, sf_dir)
    return neighbour_ids(neighbours(vectors, k=3, small_bytes=0, block_bytes=256 << 10)).select(
        "article_id", F.array_join("top_similar_articles", ",").alias("top_similar_articles")
    )


def top3_repeated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbours of rows when ids and vectors repeat, by both forms.

    Every vector occurs under two ids, one of which it shares with the next vector.
    """
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    shared = F.floor(F.col("vec_id") / 2).cast("string")
    rows = e.select((F.col("vec_id") * 2).alias("row_id"), F.concat(F.lit("S"), shared).alias("article_id"), "embedding").union(
        e.select((F.col("vec_id") * 2 + 1).alias("row_id"), F.concat(F.lit("T"), shared).alias("article_id"), "embedding")
    )
    small = neighbours(rows, k=3).select("row_id", "article_id", F.lit("small").alias("form"), "neighbours")
    blocked = neighbours(rows, k=3, small_bytes=0, block_bytes=256 << 10)
    both = small.union(blocked.select("row_id", "article_id", F.lit("blocked"), "neighbours"))
    listed = F.transform("neighbours", lambda h: F.concat(h["id"], F.lit(":"), h["row"].cast("string")))
    return both.select("row_id", "article_id", "form", F.array_join(listed, ",").alias("neighbours"))


def sql_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    session = SearchSession(spark, view="articles_report")
    session.load(attach_vectors(enrich_articles(spark, sf_dir), article_vectors(spark, sf_dir)))
    return session.sql(
        """
        SELECT category, company_size_category, count(*) AS articles,
               sum(revenue_usd) AS revenue_usd, count(embedding) AS with_vector,
               rank() OVER (PARTITION BY category ORDER BY count(*) DESC, company_size_category) AS size_rank
        FROM articles_report
        WHERE pub_year >= :since
        GROUP BY category, company_size_category
        """,
        {"since": 2019},
    )


def embed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _document_texts(spark, sf_dir)
    fitted = HashedWords().fit(docs.withColumn("text_to_embed", text_to_embed()), "text_to_embed")
    vectors = embed(docs, fitted)
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x))
    return vectors.select(
        "doc_id",
        F.md5("text_to_embed").alias("text_hash"),
        F.size("embedding").alias("dimensions"),
        F.round(norm, 6).alias("norm"),
        _fold(F.col("embedding")).alias("vector"),
    )


def _document_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.concat(F.lit("DOC"), F.col("doc_id").cast("string")).alias("article_id"),
        F.col("source").alias("title"),
        F.col("text").alias("summary"),
    )


def document_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = store_embedded(_document_texts(spark, sf_dir), HashedWords(), "document_vectors", texts=False)
    return neighbour_ids(neighbours(stored, k=3)).select(
        "article_id", F.array_join("top_similar_articles", ",").alias("top_similar_articles")
    )


def search_by_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents most like a text that is not among them."""
    docs = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("DOC"), F.col("doc_id").cast("string")).alias("article_id"),
        F.col("source").alias("title"),
        F.col("text").alias("summary"),
    )
    session = SearchSession(spark, HashedWords(), view="articles_by_text")
    session.load(docs)
    return _rounded(session.find_similar(QUERY_TEXT, 10))


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "raw-csv")
    write_articles_csv(raw_articles(spark, sf_dir), path)
    return read_articles_csv(spark, path).select(*RAW_COLUMNS)


def csv_split_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written articles read back by ranges of the file, records with quoted line breaks included."""
    path = new_folder(spark, "raw-csv-split")
    write_articles_csv(raw_articles(spark, sf_dir), path)
    return read_articles_csv_split(spark, path).select(*RAW_COLUMNS)


def export_json_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "export-csv")
    vectors = article_vectors(spark, sf_dir)
    rows = vectors.join(neighbour_ids(neighbours(vectors, k=3)), "article_id").drop("label")
    write_export(rows, path)
    back = read_articles_csv(spark, path)
    numbers = F.from_json("embedding", "array<float>")
    total = F.aggregate(numbers, F.lit(0.0), lambda s, x: s + x.cast("double"))
    return back.select(
        "article_id", F.size(numbers).alias("dimensions"), F.round(total, 6).alias("total"), "top_similar_articles"
    )


def company_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document per supplier, read as company rows; every tenth supplier is given again with other values."""
    key = F.col("s_suppkey")

    def documents(suppliers: DataFrame, since: int, order: Column) -> DataFrame:
        fields = F.struct(
            (F.lit(since) + key % 70).alias("founded_year"),
            F.concat(F.lit("City, "), F.col("s_nationkey").cast("string")).alias("headquarters"),
            F.floor(F.abs("s_acctbal") * 10).alias("employee_count"),
            F.concat(F.lit("Industry "), (key % 5).cast("string")).alias("industry"),
            (key % 2 == 0).alias("is_public"),
            F.when(key % 3 != 0, F.concat(F.lit("T"), key.cast("string"))).alias("stock_ticker"),
        )
        return suppliers.select(order.alias("doc"), F.to_json(F.create_map("s_name", fields)).alias("text"))

    suppliers = table(spark, sf_dir, "supplier")
    again = documents(suppliers.where(key % 10 == 0), 1900, key + 1_000_000)
    return parse_companies(documents(suppliers, 1950, key).union(again), "text", F.col("doc")).drop("pos")


def load_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched CSV back into a typed table, loaded twice under one name."""
    path = new_folder(spark, "enriched-csv")
    write_enriched(enrich_articles(spark, sf_dir), path)
    session = SearchSession(spark, view="articles_replace")
    enriched = read_enriched(spark, path)
    session.load(enriched.limit(0).withColumn("embedding", F.lit(None).cast("array<float>")))
    session.load(enriched, article_vectors(spark, sf_dir))
    return session.sql(
        """
        SELECT pub_year, metadata_matched, count(*) AS articles, sum(revenue_usd) AS revenue_usd,
               sum(company_age) AS ages, count(embedding) AS with_vector
        FROM articles_replace GROUP BY pub_year, metadata_matched
        """
    )


def table_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count(enrich_articles(spark, sf_dir))


def full_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole enrichment job from CSV and a JSON file to CSV, with the relevance filter."""
    raw, companies, out = (new_folder(spark, p) for p in ("job-raw", "companies", "job-out"))
    write_articles_csv(raw_articles(spark, sf_dir), raw)
    write_companies_json(default_companies(spark), companies)
    run_enrichment(spark, raw, companies, out, apply_filter=True)
    return read_enriched(spark, out).select(*OUTPUT_COLUMNS)


def enrichment_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enrichment job from Parquet with its table of refused rows."""
    raw, companies, out, rejects = (new_folder(spark, p) for p in ("job-raw", "companies", "job-out", "job-rejects"))
    raw_articles(spark, sf_dir).write.parquet(raw)
    write_companies_json(default_companies(spark), companies)
    run_enrichment(spark, raw, companies, out, rejects_path=rejects, output_format="parquet", input_format="parquet")
    kept = spark.read.parquet(out).select("article_id", F.lit("kept").alias("stage"), F.lit("").alias("rule"))
    return kept.union(spark.read.parquet(rejects).select("article_id", "stage", "rule"))


def _named_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A company name of two invented words for each customer."""
    digest = F.md5(F.col("c_custkey").cast("string"))
    letters = F.translate(digest, "0123456789abcdef", "aeioubdfgklmnrst")
    name = F.concat(F.initcap(F.substring(letters, 1, 7)), F.lit(" "), F.initcap(F.substring(letters, 8, 8)))
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), name.alias("name"))


def resolve_company_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelled names against a dimension with a key for each customer."""
    named = _named_customers(spark, sf_dir)
    empty = [F.lit(None).cast(kind).alias(n) for n, kind in COMPANY_FIELDS.items()]
    dimension = named.select(F.col("name").alias("company_key"), F.col("k").alias("pos"), *empty)
    n = F.col("name")
    spelled = (
        F.when(F.col("k") % 4 == 0, n)
        .when(F.col("k") % 4 == 1, F.upper(n))
        .when(F.col("k") % 4 == 2, F.concat(F.substring(n, 1, 3), F.substring(n, 5, 20)))
        .otherwise(F.concat(F.lit("Zzxq"), F.col("k").cast("string"), F.lit("wvyjh")))
    )
    return resolve_names(named.select(spelled.alias("name")), dimension)


def attach_both_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company fields joined by broadcast and by shuffle, over all articles."""
    articles = raw_articles(spark, sf_dir).select("article_id", "company_name")
    out = None
    for form, most in (("broadcast", BROADCAST_BYTES), ("shuffle", 0)):
        found = attach_companies(articles, default_companies(spark), broadcast_bytes=most)
        found = found.groupBy("company_name", "metadata_matched", "meta_founded_year", "meta_stock_ticker").agg(F.count(F.lit(1)).alias("articles"))
        found = found.withColumn("form", F.lit(form))
        out = found if out is None else out.union(found)
    return out


def similarity_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The similarity export of all enriched articles, of which some have a vector."""
    articles = attach_vectors(enrich_articles(spark, sf_dir), article_vectors(spark, sf_dir))
    out = similarity_export(store_articles(articles, "articles_export"))
    return out.select(
        *FLAT_EXPORT,
        F.coalesce(F.size("embedding"), F.lit(0)).alias("dimensions"),
        F.array_join("top_similar_articles", ",").alias("top_similar_articles"),
    )


def similarity_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole similarity job from Parquet to CSV over all enriched articles, vectors made from text."""
    enriched, out = (new_folder(spark, p) for p in ("job-enriched", "job-export"))
    write_enriched(enrich_articles(spark, sf_dir), enriched, "parquet")
    run_similarity_export(spark, enriched, out, input_format="parquet")
    back = read_articles_csv(spark, out)
    numbers = F.from_json("embedding", "array<double>")
    return back.select(
        "article_id",
        "industry",
        F.col("revenue_usd").cast("bigint").alias("revenue_usd"),
        F.size(numbers).alias("dimensions"),
        _fold(numbers).alias("vector"),
        F.array_join(F.from_json("top_similar_articles", "array<string>"), ",").alias("top_similar_articles"),
    )


def _fold(vector: Column) -> Column:
    """A number that depends on every entry of a vector and its place."""
    weighted = F.transform(vector, lambda x, i: x * (i + 1))
    return F.round(F.aggregate(weighted, F.lit(0.0), lambda s, x: s + x), 4)


def search_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load, search among filtered rows, and show the hits."""
    session = SearchSession(spark, view="articles_session")
    session.load(enrich_articles(spark, sf_dir), article_vectors(spark, sf_dir))
    hits = session.hybrid_search(QUERY_ID, "pub_year BETWEEN 2018 AND 2022 AND revenue_usd >= 100000", 5)
    shown = session.hydrate(hits, "company_name", "category", "pub_year", "revenue_usd")
    return _rounded(shown, "company_name", "category", "pub_year", "revenue_usd")


_ALL = [
    clean_revenue,
    clean_dates,
    clean_category,
    validate_counts,
    validate_rejects,
    validate_enriched,
    missing_columns,
    resolve_company,
    resolve_company_large,
    attach_both_forms,
    enrich_articles,
    relevance_filter,
    profile_category,
    profile_size,
    table_count,
    export_filtered,
    knn_by_id,
    knn_hydrated,
    hybrid_search,
    top3_neighbours,
    top3_neighbours_blocked,
    top3_repeated_ids,
    sql_report,
    embed_documents,
    document_neighbours,
    search_by_text,
    csv_roundtrip,
    csv_split_roundtrip,
    export_json_arrays,
    company_dimension,
    load_replace,
    full_enrichment,
    enrichment_rejects,
    similarity_rows,
    similarity_job,
    search_session,
]


def _configured(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(configure(spark), sf_dir)

    run.__name__ = query.__name__
    run.__doc__ = query.__doc__
    return run


QUERIES = {query.__name__: _configured(query) for query in _ALL}
