"""From raw documents to packed training batches, stage by stage.

Each stage reads what its predecessor kept and wrote as Parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tributary.llm import decontamination, near_dup, packing, quality, secrets
from tributary.session import scratch


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, as they are."""
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates (five words, 80 percent)."""
    return near_dup.dedup(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.clean(docs, items)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; secrets but for widely copied examples are masked in their texts."""
    return secrets.redact(docs)


def batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts cut into pieces and dealt out to batches of alike length."""
    return packing.pack(docs, with_text=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("secret_scan", secret_scan),
    ("batches", batches),
]

#: Components of near duplicates and packing by dynamic programming are tested against
#: plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what lies between them is in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = scratch(spark, "pipeline")  # goes with all that is staged, when the result is written
    for number, (name, stage) in enumerate(STAGES):
        result = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            path = f"{root}/{number}-{name}"
            result.write.parquet(path)
            docs = spark.read.parquet(path)
    return result
