"""Column sets and types of the article table at each stage."""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values: column names, their order and the allowed labels ----
RAW_COLUMNS = [
    "article_id",
    "title",
    "company_name",
    "published_date",
    "category",
    "summary",
    "url",
    "author",
    "revenue",
    "word_count",
]

CATEGORY_LABELS = [
    "AI_ML",
    "Data_Analytics",
    "Cloud_Computing",
    "Cybersecurity",
    "FinTech",
    "SaaS_Software",
    "Unknown",
]

SIZE_LABELS = ["Small", "Medium", "Large", "Unknown"]

COMPANY_FIELDS = {
    "founded_year": T.IntegerType(),
    "headquarters": T.StringType(),
    "employee_count": T.IntegerType(),
    "industry": T.StringType(),
    "is_public": T.BooleanType(),
    "stock_ticker": T.StringType(),
}

ENRICHED_TYPES = {
    "article_id": T.StringType(),
    "title": T.StringType(),
    "company_name": T.StringType(),
    "published_date": T.StringType(),
    "pub_year": T.IntegerType(),
    "pub_quarter": T.IntegerType(),
    "pub_month": T.IntegerType(),
    "category": T.StringType(),
    "revenue_usd": T.LongType(),
    "summary": T.StringType(),
    "url": T.StringType(),
    "author": T.StringType(),
    "word_count": T.StringType(),
    "metadata_matched": T.BooleanType(),
    "meta_founded_year": T.IntegerType(),
    "meta_headquarters": T.StringType(),
    "meta_employee_count": T.IntegerType(),
    "meta_industry": T.StringType(),
    "meta_is_public": T.BooleanType(),
    "meta_stock_ticker": T.StringType(),
    "company_age": T.IntegerType(),
    "company_size_category": T.StringType(),
}

REQUIRED_COLUMNS = {
    "raw": [
        "article_id",
        "title",
        "company_name",
        "published_date",
        "category",
        "summary",
        "url",
        "author",
    ],
    "clean": [
        "article_id",
        "company_name",
        "published_date",
        "category",
        "revenue_usd",
        "pub_year",
        "pub_quarter",
        "pub_month",
    ],
    "enriched": [
        "article_id",
        "company_name",
        "category",
        "revenue_usd",
        "metadata_matched",
        "company_age",
        "company_size_category",
    ],
}

# Similarity export: (source column, exported name) in output order.
EXPORT_COLUMNS = [
    ("article_id", "article_id"),
    ("title", "title"),
    ("company_name", "company_name"),
    ("published_date", "published_date"),
    ("category", "category"),
    ("revenue_usd", "revenue_usd"),
    ("summary", "summary"),
    ("url", "url"),
    ("meta_industry", "industry"),
    ("meta_founded_year", "founded_year"),
    ("meta_headquarters", "headquarters"),
    ("meta_employee_count", "employee_count"),
    ("meta_is_public", "is_public"),
    ("meta_stock_ticker", "stock_ticker"),
    ("company_age", "company_age"),
    ("company_size_category", "company_size_category"),
    ("embedding", "embedding"),
    ("top_similar_articles", "top_similar_articles"),
]
# ---- end of fixed values ----

OUTPUT_COLUMNS = list(ENRICHED_TYPES)
ENRICHED_SCHEMA = T.StructType([T.StructField(n, t) for n, t in ENRICHED_TYPES.items()])

# Set by the CSV reader on rows that carry more cells than the header.
SURPLUS_FLAG = "_surplus_cells"
