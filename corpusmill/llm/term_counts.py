"""Problem 3: how often each distinct term occurs and in how many files, with rare and common ones marked."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from corpusmill.llm._terms import file_count, keyword_rows
from corpusmill.operators import skew
from corpusmill.session import bounded, materialise

#: Identifiers of a range; a count array has so many places.
BLOCK = 4096
#: Terms up to which the dictionary is broadcast to the rows; beyond it they meet by shuffle, hot terms apart.
BROADCAST_TERMS = 200_000
#: Ranges whose arrays a task holds at once; beyond it they are sent on and begun anew.
HELD = 2_000


def dictionary(terms: DataFrame, blocks: int) -> DataFrame:
    """term, id of each distinct term. Ids are dense and the same in every run over the same terms.

    A term's bucket comes from its hash, its place from its order there; ids number the places bucket after bucket. No
    task sees more than one bucket, and no global sort is needed.
    """
    w = Window.partitionBy("bucket").orderBy("term")
    t = terms.select("term").distinct().withColumn("bucket", F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int"))
    t = t.withColumn("place", F.row_number().over(w) - 1)
    size = t.groupBy("bucket").count()  # as many rows as buckets: small
    start = size.select("bucket", (F.sum("count").over(Window.orderBy("bucket")) - F.col("count")).alias("start"))
    return t.join(start, "bucket").select("term", (F.col("start") + F.col("place")).cast("bigint").alias("id"))


_ARRAYS = "range bigint, places array<int>, occurrences array<bigint>, files array<bigint>"


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (id, f) rows, or of arrays made before, added into one pair of arrays per identifier range."""
    held: dict[int, np.ndarray] = {}

    def out() -> pa.RecordBatch:
        used = {r: np.flatnonzero(a[1]) for r, a in held.items()}
        lists = [pa.array([used[r] for r in held], pa.list_(pa.int32())), *(pa.array([held[r][k][used[r]] for r in held], pa.list_(pa.int64())) for k in (0, 1))]
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), *lists], names=["range", "places", "occurrences", "files"])

    for b in batches:
        if b.num_columns == 2:
            ids, f, files = b.column(0).to_numpy(), b.column(1).to_numpy(), np.ones(b.num_rows, np.int64)
        else:
            places = b.column(1)
            ids = np.repeat(b.column(0).to_numpy(), places.value_lengths().to_numpy()) * BLOCK + places.flatten().to_numpy()
            f, files = b.column(2).flatten().to_numpy(), b.column(3).flatten().to_numpy()
        order = np.argsort(ids // BLOCK, kind="stable")
        ids, f, files = ids[order], f[order], files[order]
        which, first = np.unique(ids // BLOCK, return_index=True)
        for r, a, e in zip(which.tolist(), first, np.r_[first[1:], len(ids)]):
            if r not in held:
                if len(held) >= HELD:
                    yield out()
                    held.clear()
                held[r] = np.zeros((2, BLOCK), np.int64)
            np.add.at(held[r][0], ids[a:e] % BLOCK, f[a:e])
            np.add.at(held[r][1], ids[a:e] % BLOCK, files[a:e])
    if held:
        yield out()


def term_counts(keywords: DataFrame, rare_below: int = 3, common_above: float = 1 / 20) -> DataFrame:
    """id, keyword, occurrences, files, mark of each distinct keyword in plain form.

    mark is `rare` if fewer than `rare_below` distinct files hold the keyword, `common` if more than the share
    `common_above` of all distinct files do, else null; rare wins where both hold. Null and blank keywords and rows
    without file_path are left out; a null frequency counts as 1; exact duplicate rows count once. An empty table
    gives no rows.

    Terms are numbered first and rows encoded; from there on a term is its identifier. The rows of one term in one
    file become one, each task adds its rows into a pair of arrays (occurrences, files that hold the term) per range of
    BLOCK identifiers, and the arrays of one range are added up. A term that a third of all rows hold is one place of
    one array per task by then.
    """
    n = file_count(keywords)
    rows = materialise(keyword_rows(keywords), "keyword-rows")
    many = rows.groupBy("term").agg(F.count("*").alias("many"))
    distinct = many.agg(F.approx_count_distinct("term")).first()[0]
    ids = materialise(dictionary(many, max(1, -(-distinct // (BLOCK // 2)))), "dictionary")
    if bounded(ids, BROADCAST_TERMS):
        encoded = rows.join(F.broadcast(ids), "term")
    else:
        encoded = skew.lookup(rows, ids.join(many, "term"), "term", "many", rows.count(), F.col("file_path"))
    one = encoded.groupBy("file_path", "id").agg(F.sum("f").alias("f")).select("id", "f")
    arrays = one.mapInArrow(_add, _ARRAYS)
    total = arrays.repartition("range").mapInArrow(_add, _ARRAYS)
    x = F.explode(F.arrays_zip("places", "occurrences", "files")).alias("x")
    counts = total.select("range", x).groupBy((F.col("range") * BLOCK + F.col("x.places")).alias("id")).agg(F.sum("x.occurrences").alias("occurrences"), F.sum("x.files").alias("files"))
    mark = F.when(F.col("files") < rare_below, "rare").when(F.col("files") > F.lit(common_above * n), "common")
    return counts.join(ids, "id").select("id", F.col("term").alias("keyword"), "occurrences", "files", mark.alias("mark"))
