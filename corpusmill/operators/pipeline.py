"""Whole passes over a corpus: index entries, block-level comparison of the taggers, placement of strands in looms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusmill.functions import text as T
from corpusmill.functions.vocabulary import Vocabulary
from corpusmill.operators import blocks as B, classify as C, corpus_stats as S, quality as Q, skew
from corpusmill.session import materialise

# From these similarities on a placement is sure, or at least likely.
SURE, LIKELY = 0.8, 0.6


def index_entries(docs: DataFrame, vocabulary: Vocabulary | None = None) -> DataFrame:
    """One wide row per document (doc_id, path, title, summary, text): keywords, phrases, subjects, topics, difficulty, skills,
    a summary where none is given, reading level, entities, errors, warnings, search text, the first 5,000 characters.

    Keywords and phrases need counts over the corpus or the document and come by a join on doc_id; the rest is one narrow map.
    """
    v = vocabulary or Vocabulary()
    d = docs.select("doc_id", "path", "title", "summary", F.coalesce("text", F.lit("")).alias("text"))
    words = T.tokens(F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("summary", F.lit("")), F.col("text")), stop=v.stop_words)
    as_list = lambda x, c, n: x.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("rank", c))).alias("l")).select("doc_id", F.transform("l", lambda s: s[c]).alias(n))
    keywords = as_list(S.keywords_tfidf(d, words), "term", "keywords")
    phrases = as_list(S.repeated_phrases(d, words, 2), "phrase", "phrases")
    e = T.with_readability(T.with_summary(d, out="extract", stop=v.stop_words)).withColumn("content", F.col("text"))
    e = Q.content_rules(e).withColumn("entities", T.entities(F.col("text")))
    none = F.array().cast("array<string>")
    e = C.with_categories(e, v).join(keywords, "doc_id", "left").join(phrases, "doc_id", "left")
    e = e.withColumn("keywords", F.coalesce("keywords", none)).withColumn("phrases", F.coalesce("phrases", none))
    given = F.coalesce(F.nullif("summary", F.lit("")), "extract")
    return e.select(
        "doc_id", "path", "title", given.alias("summary"), "keywords", "phrases", "subjects", "topics", "difficulty", "skills", "grade", "ease", "sentences", "words", "entities", "errors", "warnings",
        F.lower(F.concat_ws(" ", F.coalesce("title", F.lit("")), given, F.array_join("keywords", " "), F.array_join("phrases", " "))).alias("search_text"), F.substring("content", 1, 5000).alias("content"),
    )


def embedding_input(title: Column, summary: Column, text: Column) -> Column:
    """`title. summary` where there is a summary, else the text."""
    has = F.coalesce(summary, F.lit("")) != ""
    return F.when(has, F.concat(F.coalesce(title, F.lit("")), F.lit(". "), summary)).otherwise(F.coalesce(text, F.lit("")))


def tagger_change(docs: DataFrame) -> DataFrame:
    """measure, before, after, change of the totals of the rich and the unified tagger."""
    rows = None
    for name in ("rich", "unified"):
        t = B.block_tags(B.blocks(docs, tagger=name)).agg(F.count("*").alias("suggestions"), F.count_if("confirmed").alias("confirmed"), F.count_distinct("tag").alias("tags"))
        t = t.unpivot([], ["suggestions", "confirmed", "tags"], "measure", name)
        rows = t if rows is None else rows.join(t, "measure")
    return rows.select("measure", F.col("rich").alias("before"), F.col("unified").alias("after"), (F.col("unified") - F.col("rich")).alias("change"))


def placement(strands: DataFrame, words: Column) -> DataFrame:
    """path, loom, similarity, decision: the loom whose words are most like the strand's, as a cosine of counts; ties by name.

    All words of a loom count, looked up by shuffle with hot words apart (skew.lookup(); one row per word holds the looms
    that have it). Strands that share no word with a loom have no loom, similarity 0 and are `new`; those without words
    have no row.
    """
    t = T.exploded(strands, ["path", "loom"], words, "term").groupBy("path", "loom", "term").agg(F.count("*").alias("n"))
    t = materialise(t, "loom-words")
    top = t.where("loom is not null").groupBy("loom", "term").agg(F.sum("n").alias("w"))
    length = top.groupBy("loom").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("len"))
    weights = top.join(length, "loom").select(F.col("loom").alias("to"), "term", (F.col("w") / F.col("len")).alias("p"))
    per = weights.groupBy("term").agg(F.collect_list(F.struct("to", "p")).alias("looms")).join(t.groupBy("term").agg(F.count("*").alias("many")), "term")
    m = skew.lookup(t, per, "term", "many", t.count(), F.col("path")).select("path", "n", F.explode("looms").alias("x")).select("path", "n", "x.to", "x.p")
    size = t.groupBy("path").agg(F.sqrt(F.sum(F.col("n") * F.col("n"))).alias("len"))
    s = m.groupBy("path", "to").agg(F.sum(F.col("n") * F.col("p")).alias("dot")).join(size, "path", "right")
    s = s.select("path", F.col("to").alias("loom"), F.round(F.coalesce("dot", F.lit(0.0)) / F.col("len"), 6).alias("similarity"))
    best = s.groupBy("path").agg(F.min(F.struct((-F.col("similarity")).alias("s"), "loom")).alias("x")).select("path", "x.loom", F.abs("x.s").alias("similarity"))
    return best.withColumn("decision", F.when(F.col("similarity") >= SURE, "place").when(F.col("similarity") >= LIKELY, "review").otherwise("new"))
