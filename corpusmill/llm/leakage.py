"""Problem 9: evaluation passages that stand, whole or in part, in corpus documents."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusmill.functions.normal import nfkc
from corpusmill.session import bounded, materialise

#: Rare words of each window whose lists are intersected first.
ANCHORS = 2
#: Rows of the items' words, of their anchors and of the passages up to which these tables are broadcast; beyond it they meet the index by shuffle.
BROADCAST_ROWS = 500_000
#: Words of all passages up to which the passages are broadcast.
BROADCAST_WORDS = 2_000_000


def words(text: Column) -> Column:
    """Words of a text: runs of letters or digits of its NFKC form without case; joiners and soft hyphens vanish."""
    t = F.regexp_replace(nfkc(text), "[­‌‍⁠﻿]", "")
    return F.filter(F.split(F.lower(F.upper(t)), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def postings(documents: DataFrame, terms: DataFrame, small: bool) -> DataFrame:
    """tid, doc_id, pos: positional postings of `terms`(word, tid) in the whole corpus."""
    tokens = documents.select("doc_id", F.posexplode(words(F.col("text"))).alias("pos", "word"))
    return tokens.join(F.broadcast(terms) if small else terms, "word").select("tid", "doc_id", "pos")


def _anchors(placed: DataFrame, counts: DataFrame, run: int, anchors: int) -> DataFrame:
    """tid, pid, off: the `anchors` rarest words of every window of `run` words of each passage."""

    def run_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, int]] = []
            for pid, ws in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tids = [w["tid"] for w in ws]  # in order of off
                order = sorted(range(len(ws)), key=lambda o: (ws[o]["n"], tids[o], o))
                place = {o: k for k, o in enumerate(order)}
                chosen = {o for s in range(len(ws) - run + 1) for o in sorted(range(s, s + run), key=place.__getitem__)[:anchors]}
                out += [(tids[o], pid, o) for o in sorted(chosen)]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int32()))], names=["tid", "pid", "off"])

    w = placed.join(counts, "tid", "left").select("pid", F.struct("off", "tid", F.coalesce("n", F.lit(0)).alias("n")).alias("w"))
    return w.groupBy("pid").agg(F.array_sort(F.collect_list("w")).alias("ws")).mapInArrow(run_of, "tid bigint, pid bigint, off int")  # the words of one passage


def _islands(there: DataFrame, keys: list[str], off: str, gap: int, name: str) -> DataFrame:
    """Of each key the most distinct offsets in a row, where neighbours are at most `gap` offsets apart."""
    w = Window.partitionBy(*keys).orderBy(off)
    x = there.select(*keys, off).distinct().withColumn("new", F.when(F.col(off) - F.lag(off).over(w) <= gap, 0).otherwise(1))
    x = x.withColumn("island", F.sum("new").over(w)).groupBy(*keys, "island").agg(F.count("*").cast("int").alias("n"))
    return x.groupBy(*keys).agg(F.max("n").alias(name), F.sum("n").cast("int").alias("matched"))


def leaks(documents: DataFrame, items: DataFrame, run: int = 12, slop: int = 0) -> DataFrame:
    """doc_id, item_id, longest, near, matched, words of each document that holds a part of an item's passage.

    longest: words of the longest run of consecutive words of the passage that stand in the document one after another.
    With slop 0 a document is found if longest >= run, and near = longest. With slop > 0 a word of the passage counts
    where it stands within `slop` words of its place, and up to `slop` words in a row may be missing; near is the number
    of words of the longest such stretch, and a document is found if near >= run. matched: all words that count so;
    words: those of the passage. Null texts, passages and ids match nothing; passages under `run` words cannot be
    found; repeated rows count once; empty tables give no rows.

    The positional postings of the passages' words over the whole corpus are written once, whatever the number of
    items. The lists of the rarest words of every window are intersected after subtracting offsets: a match lies on one
    diagonal, so ANCHORS of them meet there. With slop, ANCHORS + slop words of a window are looked up and all but one of
    them have to meet on a diagonal or within `slop` of it, so a near match of which no window has that is not found;
    exact runs always are. The surviving diagonals are filled in from the full lists. Work follows the postings of
    rare words, not documents times items.
    """
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("doc_id is not null and text is not null")
    p = items.select("item_id", words(F.col("passage")).alias("w")).where("item_id is not null and w is not null").distinct()
    p = materialise(p.where(F.size("w") >= run).select(F.monotonically_increasing_id().alias("pid"), "item_id", "w"), "passages")
    terms = materialise(p.select(F.explode("w").alias("word")).distinct().select("word", F.monotonically_increasing_id().alias("tid")), "terms")
    few = bounded(terms, BROADCAST_ROWS)
    index = materialise(postings(docs, terms, few), "postings")
    placed = materialise(p.select("pid", F.posexplode("w").alias("off", "word")).join(F.broadcast(terms) if few else terms, "word").select("pid", "off", "tid"), "placed")
    counts = index.groupBy("tid").agg(F.count("*").alias("n"))
    anchors = materialise(_anchors(placed, counts, run, ANCHORS + slop), "anchors")
    side = (lambda df: F.broadcast(df)) if bounded(anchors, BROADCAST_ROWS) else (lambda df: df)
    hits = index.join(side(anchors), "tid").select("doc_id", "pid", (F.col("pos") - F.col("off")).alias("diagonal"), "off")
    shifts = F.sequence(F.lit(-slop), F.lit(slop))
    diagonals = hits.groupBy("doc_id", "pid", "diagonal").agg(F.count_distinct("off").alias("n"))
    if slop:  # anchors of the diagonals around each
        near = Window.partitionBy("doc_id", "pid").orderBy("diagonal").rangeBetween(-slop, slop)
        diagonals = diagonals.withColumn("n", F.sum("n").over(near))
    diagonals = diagonals.where(F.col("n") >= ANCHORS + max(0, slop - 1)).drop("n")
    full = placed.groupBy("pid").agg(F.array_sort(F.collect_list(F.struct("off", "tid"))).alias("ws"))  # the words of one passage
    side = (lambda df: F.broadcast(df)) if bounded(placed, BROADCAST_WORDS) else (lambda df: df)
    want = diagonals.join(side(full), "pid").select("doc_id", "pid", "diagonal", F.explode("ws").alias("w")).select("doc_id", "pid", "diagonal", "w.off", "w.tid")
    want = want.select("*", F.explode(shifts).alias("shift")).withColumn("pos", F.col("diagonal") + F.col("off") + F.col("shift"))
    there = want.join(index, ["doc_id", "tid", "pos"]).select("doc_id", "pid", "diagonal", "off", "shift")
    keys = ["doc_id", "pid", "diagonal"]
    if slop:
        there = materialise(there, "near")
        found = _islands(there, keys, "off", slop + 1, "near").where(F.col("near") >= run)
        exact = _islands(there.where("shift = 0"), keys, "off", 1, "longest").select(*keys, "longest")
        found = found.join(exact, keys, "left").withColumn("longest", F.coalesce("longest", F.lit(0)))
    else:
        found = _islands(there, keys, "off", 1, "longest").where(F.col("longest") >= run).withColumn("near", F.col("longest"))
    side = F.broadcast if bounded(p, BROADCAST_ROWS) else (lambda df: df)
    found = found.join(side(p.select("pid", "item_id", F.size("w").alias("words"))), "pid")
    best = F.struct(F.max("longest").alias("longest"), F.max("near").alias("near"), F.max(F.struct("near", "longest", "matched", "words")).alias("best")).alias("x")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "x.longest", "x.near", "x.best.matched", "x.best.words")
