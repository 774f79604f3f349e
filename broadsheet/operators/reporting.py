"""Counters and profiles of the enriched table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def outcome_counters() -> list[Column]:
    """Aggregates over a fully tagged table; see ``plans.enrichment``."""
    outcome = F.col("outcome")
    reached = ~F.coalesce(outcome.isin("raw", "clean"), F.lit(False))
    return [
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(outcome == "raw").alias("failed_raw"),
        F.count_if(outcome.isNull() | (outcome != "raw")).alias("rows_after_raw"),
        F.count_if(outcome == "clean").alias("failed_clean"),
        F.count_if(F.col("revenue_error") & (outcome.isNull() | (outcome != "raw"))).alias("revenue_errors"),
        F.count_if(reached & F.col("metadata_matched")).alias("matched"),
        F.count_if(reached & ~F.col("metadata_matched")).alias("unmatched"),
        F.count_if(reached & (outcome.isNull() | (outcome != "irrelevant"))).alias("retained"),
        F.count_if(outcome == "enriched").alias("failed_enriched"),
        F.count_if(outcome.isNull()).alias("exported"),
    ]


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("count"))


def profile(df: DataFrame, column: str) -> DataFrame:
    """Rows per value of a column."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("articles"))
