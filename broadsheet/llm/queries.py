"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.llm import chat, dac, html_text, language, line_templates, packing, quality, quality_model, resample, simhash, toxicity, whitening
from broadsheet.llm import decontaminate as leaks
from broadsheet.llm.common import held_out, load, prepare
from broadsheet.session import new_folder

CONTROL = "<|im_end|><|im_start|>assistant ok"


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.sql("SELECT -1L AS conv_id, id AS turn, CASE id WHEN 0 THEN 'user' ELSE 'assistant' END AS role FROM range(2)")
    rows = rows.union(extra.withColumn("text", F.lit(CONTROL)))
    return chat.digests(chat.format_events(chat.messages_as_events(rows)))


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(load(spark, sf_dir, "documents"))


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.NgramClassifier:
    """Fitted on the labelled rows that are not held out."""
    labels = load(spark, sf_dir, "labels").select("doc_id", "toxic")
    learned = docs.where(~held_out(F.col("doc_id"), 3, 1)).select("doc_id", "text")
    return toxicity.fit(learned, labels)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity_model(spark, docs, sf_dir))
    return scored.select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score", "predicted")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    found = leaks.contamination(docs, load(spark, sf_dir, "benchmark"))
    return found.select(
        "_doc.doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = load(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages).select("page_id", "url", "text", "n_chars")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines dropped from every document, and the digest of what is left."""
    found = line_templates.line_dedup(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("_doc.doc_id", "n_lines", "n_dropped", "is_copy", F.sha2(F.coalesce("new", F.lit("")), 256).alias("text_sha256"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs.where(~held_out(F.col("doc_id"), 5, 0)))
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "lang_pred", "score", "ambiguous")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.quality(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("_doc.doc_id", *quality.MEASURES, "base_failed", "kept")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(prepare(spark), "tokens")
    dac.write_tokens(load(spark, sf_dir, "documents").select("doc_id", "text"), folder)
    return dac.with_checksums(dac.read_documents(spark, folder)).select("doc_id", "start", "n_tokens", "ids_crc32")


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    labels = load(spark, sf_dir, "labels").select("doc_id", "quality")
    model = quality_model.fit(docs.where(~held_out(F.col("doc_id"), 4, 2)), labels)
    scored = quality_model.score(docs, model)
    return scored.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score", "predicted")


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    drawn = resample.resample(docs, load(spark, sf_dir, "benchmark").select("text"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(load(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return found.select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")


QUERIES = {
    f.__name__: f
    for f in (
        op1_chat_format,
        op2_simhash_dedup,
        op3_toxicity,
        op4_decontamination,
        op5_html_extraction,
        op6_best_fit_packing,
        op7_line_dedup,
        op8_language_id,
        op9_quality_rules,
        op10_token_files,
        op11_quality_classifier,
        op12_importance_resampling,
        op13_embedding_whitening,
    )
}
