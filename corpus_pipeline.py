"""Raw documents to a clean, tokenised corpus: each stage works on all that its predecessor kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from basketry.llm import byte_pairs, decontamination, line_dedup, quality_rules, simhash
from basketry.sources.staging import shared_dir


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_rules.filter_quality(docs, quality_rules.trusted_documents(labels), bad_ids=quality_rules.bad_documents(labels))


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that their source repeats; n_chars follows the text."""
    return line_dedup.drop_boilerplate(docs, "source", "text", length_col="n_chars")


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near duplicates (4-word shingles, 4 bits)."""
    return simhash.one_of_each(docs, "doc_id", "text")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark passage occurs."""
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded bytes of what is left."""
    return byte_pairs.encode_documents(docs)


STAGES = [
    ("quality rules", keep_quality),
    ("line dedup", drop_boilerplate_lines),
    ("SimHash near-dedup", keep_one_of_each),
    ("benchmark decontamination", drop_contaminated),
    ("byte-level BPE encoding and decoding", encode),
]

ORACLE_SQL = None  # hashes, fingerprints and byte pairs are beyond SQL; tests hold run() against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
