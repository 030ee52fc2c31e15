"""A corpus from raw documents to packed sequences. Each stage's result is written as Parquet and read again by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fieldglass.llm import crf_lines, ngram_join, packing, secret_scan, site_quality
from fieldglass.llm.common import share_package
from fieldglass.sources.scratch import materialize

#: SQL cannot express the stages' methods; tests/llm compares them with brute force.
ORACLE_SQL = None


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    share_package(spark)
    return site_quality.keep_good(docs, _labels(spark, sf_dir))


def keep_content(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose lines are mostly content and that pass the base rules.

    The field is that of ``op2_line_rules``: stage 1 takes most documents of one label away, so it is fitted on the whole table.
    """
    share_package(spark)
    whole = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return crf_lines.keep_content(docs, crf_lines.fit_on(whole, _labels(spark, sf_dir)))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five words, similarity 0.8 or more."""
    share_package(spark)
    return ngram_join.keep_one(docs, window=5, share=(80, 100))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets masked."""
    share_package(spark)
    return secret_scan.mask(docs, "text", "n_chars")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document with its place in a sequence of 2048 tokens."""
    share_package(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")).drop("ids")


STAGES = [
    ("quality classifier", keep_good_quality),
    ("quality rules", keep_content),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("secret scans", mask_secrets),
    ("best-fit packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
