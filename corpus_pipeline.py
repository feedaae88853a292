"""From raw documents to packed training sequences, in five stages.

Each stage is (spark, docs, sf_dir) -> DataFrame and works on all that the stage
before it kept; all but the last return the columns of documents:

1. quality_rules: documents that the base rules or the trained classifier reject go;
2. minhash_near_dup: of each component of documents that share 80 % of their
   five-word shingles the one with the smallest doc_id stays;
3. benchmark_decontamination: runs of words from test items are cut out, documents
   that consist of nothing else go;
4. personal_data: spans of personal data become <EMAIL>, <IP>, <CARD> or <PHONE>;
5. best_fit_packing: token pieces with their sequences and offsets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seriesforge.llm import decontaminate, near_dup, packing, pii, quality
from seriesforge.llm.common import importable, read_table, shared_folder

NEAR_PERCENT = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs, quality.train(docs, read_table(spark, sf_dir, "labels")))


def minhash_near_dup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.without_near_duplicates(docs, percent=NEAR_PERCENT)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_benchmark(docs, read_table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.masked(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.token_pieces(docs, packing.public_tokenizer()))


STAGES = [
    ("quality_rules", quality_rules),
    ("minhash_near_dup", minhash_near_dup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("personal_data", personal_data),
    ("best_fit_packing", best_fit_packing),
]

#: A trained classifier, sketches and a tokenizer are beyond SQL; tests/llm holds
#: every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's result is written and read again."""
    docs = read_table(importable(spark), sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
