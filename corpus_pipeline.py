"""From raw documents to a training mix: filter, deduplicate, decontaminate, interleave.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read back as the next one's
documents. All stages but the last return the columns of ``documents``; the last adds the place of every row in the mix.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from bazar.llm import decontaminate, mixing, quality_rules, simhash, suffix_dedup
from bazar.llm.tables import prepared
from bazar.session import scratch_root

# words per shingle and differing bits in near-duplicate detection
SHINGLE = 4
RADIUS = 4


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy does not reject."""
    prepared(spark)
    return quality_rules.kept_documents(docs, quality_rules.POLICIES[quality_rules.CURRENT])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group linked by fingerprints at most ``RADIUS`` bits apart, the one with the smallest id."""
    prepared(spark)
    return simhash.one_of_each(docs, shingle=SHINGLE, radius=RADIUS)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 50 bytes and more that a document with a smaller id has too."""
    prepared(spark)
    return suffix_dedup.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    prepared(spark)
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), unnamed=True)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their place in a mix that weighs sources by the square root of their size."""
    prepared(spark)
    return mixing.mix_sources(docs)


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_dedup),
    ("suffix_array_dedup", passage_dedup),
    ("benchmark_decontamination", decontamination),
    ("source_mixing", mix),
]

# SQL has no XXH64 with a seed, so the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents below ``sf_dir``."""
    folder = f"{scratch_root(spark)}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}-{name}")
        docs = spark.read.parquet(f"{folder}/{number}-{name}")
    return docs


QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
