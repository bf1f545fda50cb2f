"""From raw documents to token ids: grade, drop repeated lines, drop near-duplicates, mix sources, encode.

Every stage takes (spark, docs, sf_dir), works on all its predecessor kept, and returns the
columns of ``docs``, but for the last. ``n_chars`` follows the text where a stage changes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from newslens.llm import bpe, line_dedup, minhash, mixing, quality
from newslens.llm.queries import VOCABULARY
from newslens.session import materialize


def _with_length(docs: DataFrame, columns: list[str]) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("bigint")).select(*columns) if "n_chars" in columns else docs.select(*columns)


def select_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents likely to have the highest grade; all, if nothing is rated. Null texts are graded as empty."""
    ratings = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", quality.grade(F.col("quality"), F.col("toxic")).alias("grade"))
    graded = quality.grade_documents(docs, quality.train(docs, ratings))
    return graded.where(F.coalesce(F.col("tail") >= quality.SELECT, F.lit(True))).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines that repeat an earlier line, and documents that lose all their text by it."""
    return _with_length(line_dedup.without_repeats(docs), docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, the smallest id, of each group of near-duplicates; rows that share an id stay or go together."""
    gone = minhash.near_duplicates(docs).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each document's share of the mix: its text repeated or cut to the chosen blocks; those that get nothing go."""
    mixed = mixing.mix_sources(docs).where("taken > 0").dropDuplicates(["doc_id", "size"]).withColumnRenamed("doc_id", "_doc")
    own = docs.select(F.struct(*docs.columns).alias("_row"), F.col("doc_id").alias("_id"), F.col("text").alias("_text"),
                      mixing.word_count(F.col("text")).alias("_words_own"))
    joined = own.join(mixed, F.col("_id").eqNullSafe(F.col("_doc")) & (F.col("_words_own") == F.col("size")))
    joined = joined.withColumn("_new", mixing.mixed_text(F.col("_text")))
    texts = joined.select(*(F.col("_new" if c == "text" else f"_row.`{c}`").alias(c) for c in docs.columns))
    return _with_length(texts, docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with digests of the ids and of what they decode to."""
    import public_tokenizers

    encoded = bpe.encode_digests(docs.select("doc_id", "source", "text"), public_tokenizers.path(VOCABULARY), pattern=public_tokenizers.PATTERN)
    return encoded.select("doc_id", "source", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality", select_quality), ("line_dedup", drop_repeated_lines), ("near_dedup", drop_near_duplicates), ("mixing", mix), ("encoding", encode),
]

#: The fitted model, edit distances and byte-pair merges are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored before the next stage reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
