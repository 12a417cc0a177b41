"""Corpus pipeline: quality rules, near-dedup, repeated strings, source mix, packing.

Every stage works on what its predecessor kept; run() writes each stage's result as Parquet under
the shared folder and reads it again, so a lost executor costs one stage's tasks at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from nestgate.llm.best_fit_pack import pack
from nestgate.llm.budget_mix import mixed_documents
from nestgate.llm.common import table
from nestgate.llm.line_quality import clean_documents
from nestgate.llm.minhash_dedup import first_of_each_class
from nestgate.llm.suffix_dedup import without_repeats
from nestgate.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: failing lines and rejected documents go."""
    return clean_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: one document of each component stays."""
    return first_of_each_class(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: bytes covered by 200-byte strings that occur elsewhere go."""
    return without_repeats(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents as often as the source budgets hold them."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: token pieces with their places in sequences."""
    return pack(docs)


STAGES = [("quality rules", quality), ("near-dedup", near_dedup), ("suffix-array dedup", repeats),
          ("source mix", mix), ("best-fit packing", packing)]

# Fixed components, byte-level repeats and the packing are not expressible in SQL; tests hold run()
# against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        out = scratch_path(spark, f"pipeline-{i}")
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
