"""The registered queries of this subpackage, each over its whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.llm import (bpe, filter_audit, language, mixing, near_dedup, pseudonyms, quality, scoring, secrets, sketch,
                         token_counts, topk, turn_repair)


# A deployment passes a key of its own that it keeps secret.
PSEUDONYM_KEY = "pseudonyms of the test tables"
MIXING_SEED = 17
QUALITY_LIMIT = 0.3


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _fold(modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`."""
    return F.crc32(F.col("doc_id").cast("string")) % modulus


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, fold = _table(spark, sf_dir, "documents"), _fold(5)
    network = quality.learn(docs, _table(spark, sf_dir, "labels"), fold != 0)
    predicted = F.when(F.col("score") >= QUALITY_LIMIT, 1).otherwise(0)
    return quality.rate(docs, network).select(
        "doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "score", predicted.alias("predicted"))


def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.fingerprints(_table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from folds 0, 1 and 3 of four; fold 3 also sets the limits of rejection."""
    docs, fold = _table(spark, sf_dir, "documents"), _fold(4)
    identifier = language.learn(docs, F.when(fold.isin(0, 1), 0).when(fold == 3, 1))
    held_out = F.coalesce(fold == 2, F.lit(False))
    return language.identify(docs, identifier).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = _fold(7)
    return scoring.score(_table(spark, sf_dir, "documents"), fold != 2).select(
        "doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"),
        "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bpe.read_vocabulary(spark, public_tokenizers.path("word_bpe_49k.json"))
    return bpe.round_trip(_table(spark, sf_dir, "documents"), vocabulary, with_ids=False)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymize(_table(spark, sf_dir, "documents"), PSEUDONYM_KEY)


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.scan(_table(spark, sf_dir, "documents")))


def op9_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0")


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.replicate(_table(spark, sf_dir, "documents"), seed=MIXING_SEED)


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _table(spark, sf_dir, "conversations")
    repair = turn_repair.Repair(turn_repair.damaged(conversations))
    digests = turn_repair.text_digests(repair.rows())
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    found = conversations.select("conv_id").distinct()
    for more in (repair.summaries(), digests):
        more = more.withColumnRenamed("conv_id", "_conv_id")
        found = found.join(more, F.col("conv_id").eqNullSafe(F.col("_conv_id")), "left").drop("_conv_id")
    return found.select("conv_id", *[F.coalesce(name, F.lit(0).cast("bigint")).alias(name) for name in counts],
                        F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = token_counts.read_tokenizer(spark, public_tokenizers.path("byte_bpe_50k.json"))
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), tokenizer)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = filter_audit.document_flags(_table(spark, sf_dir, "documents"))
    return filter_audit.interactions(flags, _table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_document_fingerprints": op2_document_fingerprints,
    "op3_language_id": op3_language_id,
    "op4_near_dedup": op4_near_dedup,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_bpe": op6_bpe,
    "op7_pii": op7_pii,
    "op8_secret_scan": op8_secret_scan,
    "op9_topk_search": op9_topk_search,
    "op10_source_mixing": op10_source_mixing,
    "op11_turn_repair": op11_turn_repair,
    "op12_token_counts": op12_token_counts,
    "op13_filter_audit": op13_filter_audit,
}
