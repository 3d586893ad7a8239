"""The registered queries: each operator over its whole table with production parameters, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folia.llm import byte_bpe, language_id, minhash, ngram_model, ordinal_quality, packing, quality_rules, spot_signatures, token_count, toxicity
from folia.llm.common import remainder, table


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode(table(spark, sf_dir, "documents"))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    index = toxicity.fit(docs, labels.where(remainder("doc_id", 3) != 1))
    return toxicity.score(docs, index).withColumn("held_out", remainder("doc_id", 3) == 1).select("doc_id", "held_out", "score", "predicted", "neighbours", "cosines")


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder, facts = ngram_model.fit(docs.where(remainder("doc_id", 5) != 1))
    scored = ngram_model.score(docs, folder, facts)
    return scored.select("doc_id", (remainder("doc_id", 5) == 1).alias("held_out"), "n_tokens", "n_known", F.lit(facts["tokens"]).cast("long").alias("train_tokens"), "base_score", "score", "perplexity")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents (by text and source) and pages (by text, markup, address and host)."""
    docs, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    model = language_id.fit(docs)
    answers = "language", "posterior", "n_features", "kept"
    nothing = F.lit(None).cast("long")
    of_docs = language_id.identify(language_id.document_evidence(docs), model).select(F.col("key").alias("doc_id"), nothing.alias("page_id"), *answers)
    of_pages = language_id.identify(language_id.page_evidence(pages, model.languages), model).select(nothing.alias("doc_id"), F.col("key").alias("page_id"), *answers)
    return of_docs.unionByName(of_pages)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.score(table(spark, sf_dir, "documents")).drop("failed_rules")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(table(spark, sf_dir, "documents"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Graded by labels.quality; learnt from rows whose crc32 of the id mod 3 isn't 1."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = ordinal_quality.fit(docs, labels.where(remainder("doc_id", 3) != 1))
    return ordinal_quality.score(docs, model).withColumn("held_out", remainder("doc_id", 3) == 1)


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spot_signatures.fingerprints(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_byte_bpe, op2_minhash_near_dedup, op3_toxicity, op4_lm_scoring, op5_language_id, op6_quality_rules, op7_token_counts, op8_quality_classifier, op9_best_fit_packing, op10_fingerprints)}

ORACLES: dict[str, str] = {"op6_quality_rules": quality_rules.oracle_sql()}
