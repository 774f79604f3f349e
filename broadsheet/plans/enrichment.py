"""Enrichment job: read, clean, match companies, derive, validate, write."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from broadsheet.operators.cleaning import clean
from broadsheet.operators.companies import CUTOFF, attach_companies, with_derived_fields
from broadsheet.operators.relevance import DEFAULT_SETS, RelevanceSets, relevant
from broadsheet.operators.reporting import outcome_counters
from broadsheet.operators.validation import reject_table, tag_stage
from broadsheet.session import new_folder, settled
from broadsheet.sources.articles import read_articles_csv
from broadsheet.sources.companies import read_companies
from broadsheet.sources.exports import output_projection, write_enriched


def enrich_tagged(
    raw: DataFrame,
    dimension: DataFrame,
    sets: RelevanceSets | None = None,
    cutoff: float = CUTOFF,
    names: DataFrame | None = None,
) -> DataFrame:
    """Every input row with its enriched columns and its ``outcome``.

    ``outcome`` is null for rows to export, else the stage that refused the row
    or ``irrelevant``.  Carrying the mark instead of filtering keeps the job a
    single pass without shuffle in which each text is parsed once.
    """
    if names is None:
        names = raw.select(F.col("company_name").cast("string").alias("name"))
    cleaned = tag_stage(clean(settled(tag_stage(raw, "raw"))), "clean")
    enriched = with_derived_fields(attach_companies(cleaned, dimension, cutoff, names))
    if sets is not None:
        enriched = enriched.withColumn(
            "outcome", F.coalesce("outcome", F.when(~relevant(sets), F.lit("irrelevant")))
        )
    return tag_stage(enriched, "enriched")


def enrich(
    raw: DataFrame,
    dimension: DataFrame,
    sets: RelevanceSets | None = None,
    cutoff: float = CUTOFF,
    counters: Observation | None = None,
) -> DataFrame:
    """Exportable enriched articles.  ``counters`` fills when an action runs."""
    tagged = enrich_tagged(raw, dimension, sets, cutoff)
    # The observation also keeps the filter from sinking below the cleaning
    # steps, where its condition would repeat all of them.
    watched = tagged.observe(counters or Observation(), *outcome_counters())
    return output_projection(watched.where(F.col("outcome").isNull()))


def run_enrichment(
    spark: SparkSession,
    input_path: str,
    companies_path: str,
    output_path: str,
    sets: RelevanceSets | None = None,
    apply_filter: bool = False,
    rejects_path: str | None = None,
    output_format: str = "csv",
    multi_line: bool = True,
    input_format: str = "csv",
) -> dict[str, int]:
    """Run the whole job and return its counters.

    Parquet input is read by column, so the pass over the names is cheap.
    ``rejects_path`` also stores one row per fault of each refused row; export
    and rejects then come from one stored table of tagged rows.
    """
    if input_format not in ("csv", "parquet"):
        raise ValueError(f"unknown format {input_format!r}")
    raw = spark.read.parquet(input_path) if input_format == "parquet" else read_articles_csv(spark, input_path, multi_line)
    dimension = read_companies(spark, companies_path)
    chosen = (sets or DEFAULT_SETS) if apply_filter else None
    tagged = enrich_tagged(raw, dimension, chosen)
    counters = Observation()
    watched = tagged.observe(counters, *outcome_counters())
    if rejects_path is not None:
        folder = new_folder(spark, "tagged")
        watched.write.parquet(folder)
        tagged = watched = spark.read.parquet(folder)
    write_enriched(watched.where(F.col("outcome").isNull()), output_path, output_format)
    if rejects_path is not None:
        reject_table(tagged).write.mode("overwrite").parquet(rejects_path)
    return {name: int(value or 0) for name, value in counters.get.items()}
