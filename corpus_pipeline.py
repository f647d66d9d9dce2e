"""From raw documents to packed batches: each stage works on what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.llm import compression, mixing, near_dup, packing, suffix_dedup
from hourloom.llm.workers import BYTES, ROWS, records_per_batch, share_package
from hourloom.sources.workspace import fresh_folder

BATCH_ROWS, BATCH_BYTES = 512, 1 << 20  # of texts that a Python worker gets at once, and its executor holds for it


def small_batches(spark: SparkSession) -> None:
    """From now on texts go to Python in small batches: a stage returns rows that are only computed when they are written."""
    spark.conf.set(ROWS, BATCH_ROWS)
    spark.conf.set(BYTES, BATCH_BYTES)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the compression bands."""
    share_package(spark)
    small_batches(spark)
    return compression.quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    small_batches(spark)
    return near_dup.drop_near_duplicates(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that a document with a smaller id has."""
    small_batches(spark)
    return suffix_dedup.remove_repeats(docs).withColumn("n_chars", F.length("text").cast("long"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources brought to their target weights; a row per copy, texts cut to the words that the mix takes."""
    small_batches(spark)
    return mixing.mix(docs).withColumn("n_chars", F.length("text").cast("long"))


def batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of texts in length buckets and batches under a token budget."""
    small_batches(spark)
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("repeated passages", passages),
    ("source mix", mixture),
    ("packing", batches),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's rows are written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with records_per_batch(spark, BATCH_ROWS, BATCH_BYTES):
        for name, stage in STAGES:
            path = fresh_folder(spark, name.replace(" ", "-"))
            stage(spark, docs, sf_dir).write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
