"""A corpus pipeline of five stages over ``documents``.

Each stage is written as Parquet to the shared folder and read back as the next
one's input, so a lost executor repeats tasks of one stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from broadsheet.llm import line_templates, packing, simhash, toxicity
from broadsheet.llm import decontaminate as leaks
from broadsheet.llm.common import load, prepare
from broadsheet.llm.queries import toxicity_model
from broadsheet.session import new_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; the model learns from the labelled rows of the corpus."""
    return toxicity.drop_toxic(docs, toxicity_model(prepare(spark), docs, sf_dir))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go, but for their first document."""
    prepare(spark)
    return line_templates.dedup_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: that of the least id.

    The operator's own contract: fingerprints of three-word shingles linked
    within two differing bits, groups closed over links.
    """
    prepare(spark)
    return simhash.drop_near_duplicates(docs, radius=simhash.RADIUS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window go."""
    return leaks.drop_contaminated(docs, load(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of at most 2048 tokens."""
    prepare(spark)
    return packing.pack(docs.select("doc_id", "text"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: Classifiers, hashing of templates and tokenizers have no SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after the other."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
