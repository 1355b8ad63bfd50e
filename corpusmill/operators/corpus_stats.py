"""Term statistics of a corpus: frequencies, keywords, phrases, postings, ranking."""

from __future__ import annotations

import base64
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StringType

from corpusmill.functions import text as T

#: Documents of one chunk of a postings list; a list is split into chunks, so no group grows with the corpus.
CHUNK = 100_000


def join_counts(rows: DataFrame, counts: DataFrame, key: str, value: str, hot: int, spread: Column) -> DataFrame:
    """rows with the `value` of their `key`; counts has one row per key and value > 0.

    Keys with a value above `hot` are joined by broadcast - the caller picks `hot` as a share of the total, which bounds
    their number - and all others by shuffle; rows already served get keys that match nothing, spread by `spread`.
    """
    h = counts.where(F.col(value) > hot).select(key, F.col(value).alias("_hot"))
    c = counts.where(F.col(value) <= hot).select(F.col(key).alias("_key"), value)
    r = rows.join(F.broadcast(h), key, "left")
    r = r.withColumn("_key", F.when(F.col("_hot").isNull(), F.col(key)).otherwise(F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(spread), F.lit(512)).cast("string"))))
    return r.join(c, "_key", "left").withColumn(value, F.coalesce("_hot", value)).drop("_hot", "_key")


def term_frequencies(docs: DataFrame, words: Column, key: str = "doc_id") -> DataFrame:
    """key, term, n, length (tokens of the document)."""
    t = T.exploded(docs.select(key, words.alias("w")).withColumn("length", F.size("w")), [key, "length"], F.col("w"), "term")
    return t.groupBy(key, "term").agg(F.count("*").alias("n"), F.first("length").alias("length"))


def keywords_tfidf(docs: DataFrame, words: Column, k: int = 15, key: str = "doc_id") -> DataFrame:
    """key, term, score, rank: the k terms of a document with the greatest tf idf over the whole corpus; ties by term.

    tf = n/length, idf = ln(N/df). Every document counts for N, an empty one too.
    """
    n_docs = docs.count()
    tf = term_frequencies(docs, words, key)
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    j = join_counts(tf, df, "term", "df", max(1, n_docs // 100), F.col(key))
    j = j.withColumn("score", F.round(F.col("n") / F.col("length") * F.log(F.lit(float(n_docs)) / F.col("df")), 9))
    w = Window.partitionBy(key).orderBy(F.desc("score"), "term")
    return j.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(key, "term", "score", "rank")


def max_normalised(docs: DataFrame, words: Column, key: str = "doc_id") -> DataFrame:
    """key, term, weight = n over the greatest n of the document."""
    tf = term_frequencies(docs, words, key)
    return tf.withColumn("weight", F.col("n") / F.max("n").over(Window.partitionBy(key))).select(key, "term", "weight")


def repeated_phrases(docs: DataFrame, words: Column, n: int, k: int = 10, key: str = "doc_id") -> DataFrame:
    """key, phrase, n, rank: phrases of n words that occur more than once in a document, the k most frequent, ties by phrase."""
    g = T.exploded(docs.select(key, words.alias("w")), [key], T.ngrams(F.col("w"), n), "phrase").groupBy(key, "phrase").agg(F.count("*").alias("n")).where("n > 1")
    w = Window.partitionBy(key).orderBy(F.desc("n"), "phrase")
    return g.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def postings(docs: DataFrame, words: Column, chunk: int = CHUNK) -> DataFrame:
    """term, chunk, df, list of (doc_id, tf) in order of doc_id; a chunk holds doc_ids of one range of `chunk` ids."""
    tf = term_frequencies(docs, words)
    g = tf.groupBy("term", F.floor(F.col("doc_id") / chunk).alias("chunk")).agg(F.count("*").alias("df"), F.array_sort(F.collect_list(F.struct("doc_id", F.col("n").alias("tf")))).alias("list"))
    return g


def corpus_summary(docs: DataFrame, words: Column) -> DataFrame:
    """documents, average_length, vocabulary: one row. An empty document has length 1, as in the length the ranking uses."""
    t = docs.select(words.alias("w"))
    a = t.agg(F.count("*").alias("documents"), F.avg(F.greatest(F.size("w"), F.lit(1)).cast("double")).alias("average_length"))
    v = T.exploded(t, [], F.col("w"), "term").agg(F.count_distinct("term").alias("vocabulary"))
    return a.join(F.broadcast(v))


def _equals(term: str):
    return lambda x: x == term


def bm25(docs: DataFrame, words: Column, terms: Sequence[str], k: int = 20, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """doc_id, score, rank of the k best documents for the query terms; ties by doc_id.

    Nothing is exploded or shuffled: each row yields its length and its counts of the query terms, one aggregate gives
    N, the mean length and the document frequencies, and the top k are merged from the partitions.
    """
    d = docs.select("doc_id", words.alias("w")).select("doc_id", F.greatest(F.size("w"), F.lit(1)).cast("double").alias("length"), *(F.size(F.filter("w", _equals(t))).cast("double").alias(f"f{i}") for i, t in enumerate(terms)))
    s = d.agg(F.count("*").cast("double").alias("n"), F.avg("length").alias("mean"), *(F.count_if(F.col(f"f{i}") > 0).cast("double").alias(f"d{i}") for i in range(len(terms)))).first()
    score = F.lit(0.0)
    for i in range(len(terms)):
        f, df, n = F.col(f"f{i}"), F.lit(s[f"d{i}"]), F.lit(s["n"])
        idf = F.log(1 + (n - df + 0.5) / (df + 0.5))
        score = score + F.when(f > 0, idf * f * (k1 + 1) / (f + k1 * (1 - b + b * F.col("length") / F.lit(s["mean"] or 1.0)))).otherwise(0.0)
    # The filter comes after the limit: before it, it would be pushed below the projections and compute the tokens again.
    top = d.select("doc_id", F.round(score, 6).alias("score")).orderBy(F.desc("score"), "doc_id").limit(k).where("score > 0")
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("score"), "doc_id")))  # k rows


def new_terms(docs: DataFrame, words: Column, known: DataFrame, least: int = 3, k: int = 20) -> DataFrame:
    """term, df of the k terms in most documents that the vocabulary `known`(term) lacks and at least `least` documents hold."""
    df = T.exploded(docs, ["doc_id"], F.array_distinct(words), "term").groupBy("term").agg(F.count("*").alias("df")).where(F.col("df") >= least)
    return df.join(F.broadcast(known), "term", "left_anti").orderBy(F.desc("df"), "term").limit(k)


def cosine(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    """on, cosine of sparse vectors (on, term, weight); 0 where either has no weight. Vectors in both sides only."""
    dot = a.withColumnRenamed("weight", "x").join(b.withColumnRenamed("weight", "y"), [*on, "term"]).groupBy(*on).agg(F.sum(F.col("x") * F.col("y")).alias("dot"))
    norm = lambda v, n: v.groupBy(*on).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias(n))
    j = norm(a, "na").join(norm(b, "nb"), [*on]).join(dot, [*on], "left")
    return j.select(*on, F.when((F.col("na") > 0) & (F.col("nb") > 0), F.coalesce("dot", F.lit(0.0)) / (F.col("na") * F.col("nb"))).otherwise(0.0).alias("cosine"))


def normalised(vector: Column) -> Column:
    """Vector of length 1; a zero vector stays."""
    n = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return F.when(n > 0, F.transform(vector, lambda x: x.cast("double") / n)).otherwise(F.transform(vector, lambda x: x.cast("double")))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


@F.pandas_udf(StringType())
def packed(vectors: pd.Series) -> pd.Series:
    """Base64 of a vector's little-endian 32-bit floats."""
    return vectors.map(lambda x: base64.b64encode(np.asarray(x, "<f4").tobytes()).decode(), na_action="ignore")


def related(tags: DataFrame, least: int = 2) -> DataFrame:
    """loom, other, shared: pairs of looms (loom < other) of tags(loom, tag) that share `least` tags at least."""
    t = tags.where("loom is not null and tag is not null").distinct()
    p = t.join(t.withColumnRenamed("loom", "other"), "tag").where("loom < other").groupBy("loom", "other").agg(F.count("*").alias("shared"))
    return p.where(F.col("shared") >= least)


#: Query vectors that are compared with all rows in one pass.
QUERIES = 5_000


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """query_id, vec_id, cosine, rank: the k nearest other vectors of each query vector; queries are a stated set, taken in blocks of QUERIES that are broadcast.

    Per partition only the k best of each query survive (the window's group limit), so the shuffle is queries x k rows a task.
    """
    blocks, out = max(1, -(-queries.count() // QUERIES)), None
    v = vectors.select("vec_id", normalised(F.col("embedding")).alias("v"))
    w = Window.partitionBy("query_id").orderBy(F.desc("cosine"), "vec_id")
    for b in range(blocks):
        own = queries if blocks == 1 else queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b)
        q = own.select(F.col("vec_id").alias("query_id"), normalised(F.col("embedding")).alias("q"))
        s = v.join(F.broadcast(q), F.col("vec_id") != F.col("query_id")).select("query_id", "vec_id", F.round(dot(F.col("q"), F.col("v")), 6).alias("cosine"))
        s = s.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
        out = s if out is None else out.unionByName(s)
    return out
