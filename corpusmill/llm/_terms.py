"""(file, term) counts of a keyword table, shared by the term operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusmill.functions.normal import plain_keyword


def keyword_rows(keywords: DataFrame) -> DataFrame:
    """file_path, term, f of each row: exact duplicate rows once, terms in plain form, null frequency as 1, null paths and blank terms left out."""
    rows = keywords.select("file_path", "keyword", "tfidf_score", "frequency").distinct()
    rows = rows.select("file_path", plain_keyword(F.col("keyword")).alias("term"), F.coalesce("frequency", F.lit(1)).cast("bigint").alias("f"))
    return rows.where("file_path is not null and term is not null")


def file_terms(keywords: DataFrame) -> DataFrame:
    """file_path, term, f: the rows of one file and term together."""
    return keyword_rows(keywords).groupBy("file_path", "term").agg(F.sum("f").alias("f"))


def file_count(keywords: DataFrame) -> int:
    """Number of distinct non-null file_path."""
    return keywords.agg(F.count_distinct("file_path")).first()[0]
