"""One query per operator over its whole table; ``SQL`` has those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vendora.llm import (
    chat_perspectives,
    decontamination,
    html_content,
    lattice_lm,
    licenses,
    line_templates,
    packing,
    quality_classifier,
    quality_rules,
    simhash,
    spelling,
    token_alignment,
    toxicity,
)
from vendora.llm.sql import SQL  # noqa: F401


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = quality_classifier.remainder("doc_id", 7) == 2
    return lattice_lm.score(_table(spark, sf_dir, "documents"), held_out)


def op2_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_templates.drop_recurring(docs, out="n_dropped")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.judge(docs).select("doc_id", "quality.*")


def op4_toxicity_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = quality_classifier.remainder("doc_id", 5) == 0
    scored = toxicity.tag(docs, labels, learn=~held_out)
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("spans").alias("n_spans"),
    )


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = quality_classifier.remainder("doc_id", 4) == 2
    scored = quality_classifier.classify(docs, labels, learn=~held_out)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op8_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_perspectives.rotate(_table(spark, sf_dir, "conversations"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontamination.report(docs, items).drop("n_near_items")


def op9_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of ``op9_decontamination``, whose SQL has no proximity, and ``n_near_items``."""
    docs, items = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontamination.report(docs, items)


def op10_html_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_content.extract(_table(spark, sf_dir, "pages"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.vocabulary(_table(spark, sf_dir, "documents"))
    return spelling.variants(words).select("word", "form", "root", "n", "n_near", "form_n")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.report(_table(spark, sf_dir, "documents"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.report(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_lattice_lm": op1_lattice_lm,
    "op2_line_templates": op2_line_templates,
    "op3_quality_rules": op3_quality_rules,
    "op4_toxicity_crf": op4_toxicity_crf,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_simhash": op6_simhash,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_chat_perspectives": op8_chat_perspectives,
    "op9_decontamination": op9_decontamination,
    "op9_proximity": op9_proximity,
    "op10_html_content": op10_html_content,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_token_alignment": op12_token_alignment,
    "op13_license_scan": op13_license_scan,
}
