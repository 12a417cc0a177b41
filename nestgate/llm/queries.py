"""Registered queries of the training-data operators (production parameters, whole tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from nestgate.llm.best_fit_pack import pack
from nestgate.llm.budget_mix import MIX_SQL, document_mix
from nestgate.llm.common import table
from nestgate.llm.embedding_graph import embedding_components
from nestgate.llm.feistel_shards import document_shards
from nestgate.llm.license_scan import document_licenses
from nestgate.llm.line_quality import QUALITY_SQL, document_quality
from nestgate.llm.minhash_dedup import document_components
from nestgate.llm.suffix_dedup import document_repeats
from nestgate.llm.syncmer_prints import document_prints
from nestgate.llm.token_alignment import document_alignment
from nestgate.llm.turn_repair import conversation_repairs
from nestgate.llm.warc_write import WARC_SQL, page_records
from nestgate.llm.zstd_quality import document_scores

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)


@query("op5_feistel_shards")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_shards(table(spark, sf_dir, "documents"))


@query("op1_minhash_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_components(table(spark, sf_dir, "documents"))


@query("op4_line_quality", QUALITY_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_quality(table(spark, sf_dir, "documents"))


@query("op6_budget_mix", MIX_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_mix(table(spark, sf_dir, "documents"))


@query("op8_license_scan")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_licenses(table(spark, sf_dir, "documents"))


@query("op9_best_fit_pack")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


@query("op2_syncmer_prints")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_prints(table(spark, sf_dir, "documents"))


@query("op3_suffix_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_repeats(table(spark, sf_dir, "documents"))


@query("op10_zstd_quality")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_warc_write", WARC_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_records(table(spark, sf_dir, "pages"))


@query("op11_token_alignment")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_alignment(table(spark, sf_dir, "documents"))


@query("op12_turn_repair")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repairs(table(spark, sf_dir, "conversations"))


@query("op13_embedding_graph")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_components(table(spark, sf_dir, "embeddings"))
