"""The registered queries of the text operators, with SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm import decontaminate, divergence, embeddings, html, jaccard, langid, mixing, mixing_sql, oracles, quality, resampling, rules, rules_sql, secrets, substrings, warc
from marketlens.llm.common import crc_part, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


@query
def op1_source_mix(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf, "documents").select("doc_id", "text", "source", "lang"))
    rounded = [F.round(c, 6).alias(c) for c in ("weight", "probability")]
    return mixed.select("doc_id", "source", "lang", "topic", "tokens", *rounded, "sampled")


@query
def op2_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    held_out = crc_part(F.col("doc_id"), 5) == 0
    prototypes = langid.fit_prototypes(docs, ~held_out)
    return langid.predict_language(docs, prototypes, {"held_out": held_out})


@query
def op3_warc_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    return warc.round_trip(table(spark, sf, "pages"))


@query
def op4_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op5_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf, "documents"))


@query
def op6_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    held_out = crc_part(F.col("doc_id"), 3) == 1
    model = quality.fit_model(docs, table(spark, sf, "labels"), ~held_out)
    return quality.score_quality(docs, model, {"held_out": held_out})


@query
def op7_ngram_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf, "documents"))


@query
def op8_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return substrings.dedup_substrings(table(spark, sf, "documents"))


@query
def op9_main_text(spark: SparkSession, sf: str) -> DataFrame:
    return html.extract_text(table(spark, sf, "pages"))


@query
def op10_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return rules.quality_rules(table(spark, sf, "documents")).withColumn("p_good", F.round("p_good", 6))


@query
def op11_embedding_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf, "embeddings"))


@query
def op12_source_audit(spark: SparkSession, sf: str) -> DataFrame:
    return divergence.audit(table(spark, sf, "documents")).drop("p", "q")


@query
def op13_target_resampling(spark: SparkSession, sf: str) -> DataFrame:
    drawn = resampling.resample(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


ORACLES: dict[str, str] = {
    "op1_source_mix": mixing_sql.sql(),
    "op3_warc_round_trip": oracles.WARC,
    "op5_secret_scan": oracles.SECRETS,
    "op7_ngram_jaccard": oracles.JACCARD,
    "op8_substring_dedup": oracles.SUBSTRINGS,
    "op9_main_text": oracles.MAIN_TEXT,
    "op10_quality_rules": rules_sql.sql(),
    "op11_embedding_dedup": oracles.EMBEDDINGS,
    "op12_source_audit": oracles.DIVERGENCE,
    "op13_target_resampling": oracles.RESAMPLING,
}
