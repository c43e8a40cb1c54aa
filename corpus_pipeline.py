"""From raw documents to packed token sequences, one operator after the other.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and read
again as the next one's documents.  All stages but the last return the columns of
``documents``, and none drops a document but for the reason of its operator:

1. quality rules: documents that a rule rejects go;
2. line dedup: lines of recurring templates go, documents stay, even if empty;
3. SimHash near-dedup: one document of each group of linked fingerprints stays;
4. benchmark decontamination: documents with a benchmark phrase go;
5. best-fit packing: the pieces of all documents with their places in sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vendora.llm import decontamination, line_templates, packing, quality_rules, simhash
from vendora.session import remove, scratch, work_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    left = line_templates.drop_recurring(docs)
    if "n_chars" in left.columns:
        left = left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return left


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("best_fit_packing", pack),
]

# SQL has no tokenizer and no fixed point; the whole run is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, every earlier one stored in the shared folder and
    removed, with all that it set down on the way, once the next one is stored."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = work_path(spark, name)
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove(spark, before)
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
