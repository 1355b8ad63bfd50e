"""Look-ups by keys of which one may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: A key in more than this share of the rows is hot; there are at most 1/SHARE such keys.
SHARE = 0.001


def lookup(rows: DataFrame, table: DataFrame, key: str, count: str, total: int, spread: Column, share: float = SHARE) -> DataFrame:
    """Left join of rows with `table` (one row per key; `count` says how many rows of `rows` have it) on `key`.

    Hot keys are joined by broadcast, and `share` bounds their number whatever the corpus size; all others by shuffle.
    Rows already served get keys that match nothing, spread by `spread`, so no task gets them all.
    """
    values = [c for c in table.columns if c != key]
    hot = table.where(F.col(count) > share * total).select(F.col(key), F.struct(*values).alias("_hot"))
    cold = table.where(F.col(count) <= share * total).select(F.col(key).cast("string").alias("_key"), F.struct(*values).alias("_cold"))
    r = rows.join(F.broadcast(hot), key, "left")
    free = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(spread), F.lit(512)).cast("string"))
    r = r.withColumn("_key", F.when(F.col("_hot").isNull() & F.col(key).isNotNull(), F.col(key).cast("string")).otherwise(free))
    r = r.join(cold, "_key", "left").withColumn("_x", F.coalesce("_hot", "_cold"))
    return r.select(*rows.columns, *(F.col(f"_x.{v}").alias(v) for v in values))
