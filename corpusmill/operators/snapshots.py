"""Snapshots of keyed tables: difference, upsert, deletion, statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def difference(old: DataFrame, new: DataFrame, key: str, version: Sequence[str]) -> DataFrame:
    """key, change: added, modified, deleted or unchanged, by a null-safe comparison of the version columns; one row per key of either side."""
    o = old.select(F.col(key).alias("_k"), *(F.col(v).alias(f"_{v}") for v in version), F.lit(True).alias("_old"))
    n = new.select(key, *version, F.lit(True).alias("_new"))
    j = o.join(n, F.col("_k") == F.col(key), "full_outer")
    same = F.lit(True)
    for v in version:
        same = same & F.col(v).eqNullSafe(F.col(f"_{v}"))
    change = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "deleted").when(same, "unchanged").otherwise("modified")
    return j.select(F.coalesce(key, "_k").alias(key), change.alias("change"))


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of `new` and those of `old` whose key `new` lacks."""
    return old.join(new.select(key), key, "left_anti").unionByName(new)


def delete(table: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return table.join(keys.select(key), key, "left_anti")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Rows of the child table whose key no parent has: what a cascading delete removes."""
    return child.join(parent.select(F.col(parent_key).alias("_p")).distinct(), F.col(child_key) == F.col("_p"), "left_anti")


def ranked_keywords(k: DataFrame) -> DataFrame:
    """path, keyword, score, rank of keyword arrays: score = 1 - position / length."""
    x = k.select("path", F.size("keywords").alias("n"), F.posexplode("keywords").alias("i", "keyword"))
    return x.select("path", "keyword", (1 - F.col("i") / F.col("n")).alias("score"), (F.col("i") + 1).alias("rank"))


def hit_rate(diff: DataFrame) -> DataFrame:
    """cached, processed, rate: the share of present keys that need no work."""
    return diff.agg(F.count_if(F.col("change") == "unchanged").alias("cached"), F.count_if(F.col("change").isin("added", "modified")).alias("processed")).withColumn("rate", F.when(F.col("cached") + F.col("processed") > 0, F.col("cached") / (F.col("cached") + F.col("processed"))).otherwise(0.0))
