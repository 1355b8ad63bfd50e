"""Problem 5: pairs of tags held together by more strands than chance would give."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from corpusmill.functions.normal import plain_tag
from corpusmill.session import bounded

#: Entries of one task's associative arrays; beyond it they are sent on and begun anew.
STRIPE_ENTRIES = 500_000
#: Frequent items up to which their table is broadcast.
BROADCAST_ITEMS = 100_000


def _stripes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    stripes: dict[str, dict[str, int]] = defaultdict(lambda: defaultdict(int))
    entries = 0

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(stripes), pa.string()), pa.array([list(s.items()) for s in stripes.values()], pa.map_(pa.string(), pa.int64()))], names=["a", "stripe"])

    for batch in batches:
        for items in batch.column(0).to_pylist():
            for i, a in enumerate(items):
                stripe = stripes[a]
                before = len(stripe)
                for b in items[i + 1 :]:
                    stripe[b] += 1
                entries += len(stripe) - before
                if entries > STRIPE_ENTRIES:
                    yield out()
                    stripes.clear()
                    entries = 0
    if stripes:
        yield out()


def _xlogx(x: Column) -> Column:
    return F.when(x > 0, x * F.log(x)).otherwise(F.lit(0.0))


def llr(ab: Column, a: Column, b: Column, n: Column) -> Column:
    """Log-likelihood ratio of a 2x2 table of joint count, marginal counts and total."""
    k = [ab, a - ab, b - ab, n - a - b + ab]
    h = lambda *xs: sum((_xlogx(x.cast("double")) for x in xs[1:]), _xlogx(xs[0].cast("double")))
    return F.greatest(F.lit(0.0), 2 * (h(*k) + _xlogx(n.cast("double")) - h(a, n - a) - h(b, n - b)))


def cooccurrence(strands: DataFrame, min_both: int = 5, min_support: float = 0.002, min_lift: float = 4.0, min_llr: float = 3.841) -> DataFrame:
    """tag_a, tag_b, n_ab, n_a, n_b, n, lift, llr of tag pairs (plain form, tag_a < tag_b).

    n(.) counts distinct non-null paths. Kept are pairs with n_ab >= min_both, n_ab/n >= min_support, lift >=
    min_lift and a log-likelihood ratio >= min_llr (3.841: one degree of freedom, 5 %; the default counts and lift
    imply it). Null and blank tags are left out; a path given twice counts once. An empty table gives no rows.

    A tag below the pair's own count bound can be in no kept pair, so such tags go first; that leaves at most (mean
    tags of a path)/min_support tags, whatever the corpus size, and it is what bounds the stripes and the broadcast.
    """
    tags = strands.select("path", F.explode("tags").alias("tag")).where("path is not null and tag is not null")
    tags = tags.select("path", plain_tag(F.col("tag")).alias("tag")).where("tag is not null").distinct()
    n = strands.agg(F.count_distinct("path")).first()[0]
    least = max(min_both, math.ceil(min_support * n - 1e-9))
    counts = tags.groupBy("tag").agg(F.count("*").alias("n_tag")).where(F.col("n_tag") >= least)
    small = bounded(counts, BROADCAST_ITEMS)
    side = F.broadcast if small else (lambda df: df)
    baskets = tags.join(side(counts.select("tag")), "tag", "left_semi").groupBy("path").agg(F.array_sort(F.collect_set("tag")).alias("items")).where("size(items) > 1")
    stripes = baskets.select("items").mapInArrow(_stripes, "a string, stripe map<string,bigint>")
    both = stripes.select("a", F.explode("stripe").alias("b", "m")).groupBy("a", "b").agg(F.sum("m").alias("n_ab")).where(F.col("n_ab") >= least)
    both = both.join(side(counts.select(F.col("tag").alias("a"), F.col("n_tag").alias("n_a"))), "a").join(side(counts.select(F.col("tag").alias("b"), F.col("n_tag").alias("n_b"))), "b")
    both = both.withColumn("n", F.lit(n).cast("bigint")).withColumn("lift", F.col("n_ab") * F.col("n") / (F.col("n_a") * F.col("n_b"))).withColumn("llr", llr(F.col("n_ab"), F.col("n_a"), F.col("n_b"), F.col("n")))
    kept = both.where((F.col("n_ab") * F.col("n") >= min_lift * F.col("n_a") * F.col("n_b")) & (F.col("llr") >= min_llr))
    return kept.select(F.col("a").alias("tag_a"), F.col("b").alias("tag_b"), "n_ab", "n_a", "n_b", "n", "lift", "llr")
