"""A corpus from raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's documents. All but the last return
the columns of the documents.

1. language_id: documents without letters, or in none of the learned languages, go.
2. near_dedup: of each group of near duplicates the document with the smallest id stays.
3. pii: personal data in texts become pseudonyms of the same format.
4. source_mixing: documents are repeated or left out by their source's target weight.
5. bpe: texts become token ids, and what the ids decode to is digested.

Rows may repeat and columns may be null or additional; the operators say what
they do in such cases. An empty table passes through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.llm import bpe, language, mixing, near_dedup, pseudonyms
from waybill.llm.columns import quoted
from waybill.llm.scratch import Scratch

# A deployment passes a key of its own that it keeps secret.
PSEUDONYM_KEY = "pseudonyms of the test tables"
MIXING_SEED = 17
VOCABULARY = "word_bpe_49k.json"


def _like(docs: DataFrame, made: DataFrame) -> DataFrame:
    """The columns of `docs`, with the number of characters counted again."""
    kept = made.select(*[quoted(name) for name in docs.columns])
    if "n_chars" not in docs.columns:
        return kept
    counted = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text"))
    return kept.withColumn("n_chars", counted.cast(docs.schema["n_chars"].dataType))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from all documents with a language; a quarter of them sets the limits of rejection."""
    fold = F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 3, 1).otherwise(0)
    return language.accepted(docs, language.learn(docs, fold))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.survivors(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _like(docs, pseudonyms.pseudonymize(docs, PSEUDONYM_KEY))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources weigh as the square root of their number of documents; copies keep the id."""
    return mixing.replicate(docs, seed=MIXING_SEED).select(*[quoted(name) for name in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    vocabulary = bpe.read_vocabulary(spark, public_tokenizers.path(VOCABULARY))
    return bpe.round_trip(docs, vocabulary, keep=("doc_id", "lang", "source"))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_duplicates),
    ("pii", pii),
    ("source_mixing", source_mixing),
    ("bpe", encode),
]

# Language models and byte-pair encoding are not SQL; the tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        done = scratch.store(stage(spark, docs, sf_dir), name)
        if name != STAGES[0][0]:
            scratch.drop(docs)
        docs = done
    return STAGES[-1][1](spark, docs, sf_dir)
