"""All core queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusmill.plans import blocks, classify, incremental, pipeline, quality, stats, text

MODULES = [text, stats, classify, blocks, quality, pipeline, incremental]


def flagship(spark: SparkSession, d: str) -> DataFrame:
    return stats.bm25_topk(spark, d)


def queries() -> dict:
    return {k: v for m in MODULES for k, v in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in MODULES for k, v in m.SQL.items()}
