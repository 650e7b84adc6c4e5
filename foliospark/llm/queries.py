"""The queries of this subpackage, each over whole tables with production parameters, and SQL for those that have it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import bpe, exact_dedup, jaccard_join, licenses, line_dedup, packing, quality_rules, sharding, sql, substring_dedup, warc


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def op1_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = packing.pack_documents(_docs(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return p.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(_docs(spark, sf_dir))


def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(_docs(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op4_substring_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = F.sha2("kept_text", 256).alias("kept_sha256")
    return substring_dedup.substring_dedup(_docs(spark, sf_dir)).select("doc_id", "n_words", "n_removed", kept)


def op5_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = F.col("response")
    return warc.round_trip(_pages(spark, sf_dir)).select(
        "page_id", r.payload_bytes.alias("payload_bytes"), r.payload_digest.alias("payload_digest"), r.record_type.alias("record_type"), F.col("refers_to_page").alias("refers_to")
    )


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_docs(spark, sf_dir))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_docs(spark, sf_dir))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = F.sha2(F.array_join("lines", "\n"), 256).alias("kept_sha256")
    return line_dedup.line_dedup(_pages(spark, sf_dir)).select("page_id", "host", "n_lines", "n_dropped", kept)


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_classes(_docs(spark, sf_dir), n=4, num=17, den=20)


def op10_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_docs(spark, sf_dir)).drop("region", "rack")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_retrieval_packing, op2_quality_rules, op3_bpe_round_trip, op4_substring_doubling, op5_warc_transactions, op6_exact_dedup, op7_license_scan, op8_line_dedup, op9_jaccard_join, op10_hash_tree_shards)
}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_quality_rules": sql.quality_rules(),
        "op4_substring_doubling": sql.substring_doubling(),
        "op5_warc_transactions": sql.warc_transactions(),
        "op6_exact_dedup": sql.exact_dedup(),
        "op7_license_scan": sql.license_scan(),
        "op8_line_dedup": sql.line_dedup(),
        "op10_hash_tree_shards": sql.hash_tree_shards(),
    }
