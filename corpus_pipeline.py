"""Corpus pipeline: documents that pass the quality rules, once each, without near copies or repeated passages, packed."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from foliospark.llm import exact_dedup, jaccard_join, packing, quality_rules, substring_dedup
from foliospark.llm.common import Staged, narrow

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def own(docs: DataFrame) -> DataFrame:
    """The columns of documents, by their exact names, whatever others there are."""
    return narrow(docs, **{c: c for c in COLUMNS})


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail no rule. Null and empty texts fail."""
    return quality_rules.keep_good(own(docs))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the one with the most characters, then the smallest doc_id. Null text is
    empty; of repeated rows one stays."""
    return exact_dedup.keep_first(own(docs))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest doc_id, of each component of documents linked by their five-word shingles at
    a Jaccard index of 0.8 or more. Texts without words, and rows without an identifier, stay."""
    return jaccard_join.keep_one(own(docs), n=5, num=4, den=5)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of 35-word windows that occur more than once; untouched texts keep their white space. No row goes;
    null texts become empty."""
    out = substring_dedup.substring_dedup(own(docs), window=35, carry=("lang", "source"), verbatim=True)
    return out.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", F.char_length("kept_text").cast("long").alias("n_chars"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 4096 tokens, with their ids. A text without words is the end token alone."""
    return packing.pack_documents(own(docs), public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality_rules", quality), ("exact_dedup", exact), ("jaccard_join", near), ("substring_dedup", passages), ("retrieval_packing", pack)]

#: Packing has no form in SQL; the stages are tested one by one against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written to the shared folder and read again by the next."""
    st = Staged(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = st.write(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
