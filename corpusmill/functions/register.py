"""SQL names for the functions: scalar functions, and a table function that turns Markdown into blocks."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from corpusmill.functions import markdown as M
from corpusmill.functions.stem import stem


class _Blocks:
    def eval(self, text: str):
        for i, b in enumerate(M.segment(text) if text else []):
            yield i, b.kind, b.line, b.end, b.level, b.heading, b.text


def register(spark: SparkSession) -> None:
    """After this, SQL knows stem(term) and, in a lateral join, md_blocks(text), and the session's temporary SQL functions below."""
    spark.udf.register("stem", stem)
    spark.udtf.register("md_blocks", udtf(_Blocks, returnType="place int, type string, line int, end_line int, level int, heading string, text string"))
    for name, args, body in (
        ("word_tokens", "t STRING", "filter(split(lower(t), '[^a-z0-9_]+'), w -> length(w) > 2)"),
        ("content_hash", "t STRING", "sha2(t, 256)"),
        ("inline_tags", "t STRING", r"array_distinct(filter(transform(regexp_extract_all(t, '#([a-zA-Z][a-zA-Z0-9_/-]*)', 1), x -> lower(x)), x -> NOT x RLIKE '^h[1-6]$'))"),
    ):
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURN {body}")
