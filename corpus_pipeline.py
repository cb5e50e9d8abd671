"""A corpus pipeline of five stages over ``documents``.

Quality rules drop the documents they reject; of every group of near duplicates one document stays;
documents that hold a passage of a benchmark item go; secrets are replaced by a mark; and documents
are sampled towards target weights of source, language and topic. Each stage reads what the stage
before it has written. All but the last return the columns of ``documents``; the last adds the topic,
tokens, weight and probability of each sampled document.

Empty tables pass through as empty tables. What each stage does with nulls, empty or very long texts,
ties, repeated rows and further columns is stated in its operator's module.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm import decontaminate, jaccard, mixing, rules, secrets
from marketlens.llm.common import table
from marketlens.session import discard, staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secrets.redact_secrets(docs)
    if "n_chars" not in docs.columns:
        return clean
    length = F.coalesce(F.length("text"), F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return clean.withColumn("n_chars", length)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs).filter("sampled").drop("sampled")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("source_mix", source_mix),
]

# Components of links and word alignments are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, replaced = staged(stage(spark, docs, sf_dir), name), docs
        discard(replaced)
    return STAGES[-1][1](spark, docs, sf_dir)
