"""Similarity job: read enriched articles, embed, find neighbours, filter, write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.operators.embedding import Embedder, HashedWords
from broadsheet.operators.relevance import export_condition
from broadsheet.operators.similarity import ROW, neighbour_ids, neighbours, with_rows
from broadsheet.plans.search import store_embedded
from broadsheet.schema import EXPORT_COLUMNS
from broadsheet.sources.articles import read_enriched
from broadsheet.sources.exports import write_export


def export_projection(df: DataFrame) -> DataFrame:
    """The export columns under their exported names."""
    return df.select(*[F.col(source).alias(name) for source, name in EXPORT_COLUMNS])


def similarity_export(articles: DataFrame, condition: Column | None = None, k: int = 3) -> DataFrame:
    """Export rows of a table that has vectors.

    Neighbours come from the whole table, so a listed id may not be exported
    itself; they are looked for only for the rows that are.
    """
    articles = with_rows(articles)
    wanted = export_condition() if condition is None else condition
    near = neighbour_ids(neighbours(articles, wanted, k)).select(ROW, "top_similar_articles")
    return export_projection(articles.where(wanted).join(near, ROW, "left"))


def run_similarity_export(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    embedder: Embedder | None = None,
    condition: Column | None = None,
    input_format: str = "csv",
    output_format: str = "csv",
    multi_line: bool = True,
    k: int = 3,
) -> DataFrame:
    """Run the whole job; returns the stored article table with its vectors."""
    enriched = read_enriched(spark, input_path, input_format, multi_line)
    articles = store_embedded(enriched, embedder or HashedWords())
    write_export(similarity_export(articles, condition, k), output_path, output_format)
    return articles
