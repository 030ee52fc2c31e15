"""The thin queries over whole tables; each gets its rows through its operator."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe, cap_filters, crf_lines, digest_runs, html_wrapper, ngram_join, oracles, packing, secret_scan, sharding, site_quality, subvector_clusters, warc, whitening,
)
from .common import read_table

Query = Callable[[SparkSession, str], DataFrame]

BPE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PACKING_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
SHARDS = [f"shard-{i:03d}" for i in range(256)]


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read_table(spark, sf_dir, "pages"))


def op2_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return crf_lines.label_documents(docs, crf_lines.fit_on(docs, read_table(spark, sf_dir, "labels")))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(read_table(spark, sf_dir, "documents"), BPE_RANKS)


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.duplicate_groups(read_table(spark, sf_dir, "documents"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrapper.extract(read_table(spark, sf_dir, "pages"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(read_table(spark, sf_dir, "documents").select("doc_id"), "doc_id", SHARDS)


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(read_table(spark, sf_dir, "documents"))


def op8_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_quality.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op9_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cap_filters.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), PACKING_TOKENIZER).drop("ids")


def op11_digest_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that repeat the one that stays, id and text, carry its id and stay as well; the operator itself leaves one of them."""
    found = digest_runs.deduplicate(read_table(spark, sf_dir, "documents"), keep="largest")
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("kept")))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


def op13_subvector_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subvector_clusters.cluster(read_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_warc, op2_line_rules, op3_byte_bpe, op4_ngram_join, op5_html_text, op6_sharding, op7_secrets, op8_site_quality, op9_cap_filters, op10_packing,
        op11_digest_runs, op12_whitening, op13_subvector_clusters,
    )
}
#: The others' methods are beyond SQL; tests/llm compares them with brute force or a library.
ORACLES: dict[str, str] = oracles.ORACLES
