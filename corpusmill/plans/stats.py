"""Queries of term statistics, ranking and vectors, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.functions import stem as S, text as T
from corpusmill.functions.vocabulary import FALLBACK
from corpusmill.operators import corpus_stats as C
from corpusmill.plans.text import DOCS, STOP_WORDS, docs, tok
from corpusmill.session import table

TERMS = ("guide", "table", "notes")
_W = lambda: T.tokens(F.col("text"), stop=STOP_WORDS)
_ALL = lambda: T.tokens(F.col("text"))


def bm25_topk(spark, d):
    return C.bm25(docs(spark, d), _W(), TERMS)


def tf_relative_topk(spark, d):
    from pyspark.sql import Window

    tf = C.term_frequencies(docs(spark, d), _W()).withColumn("tf", F.round(F.col("n") / F.col("length"), 9))
    return tf.withColumn("rank", F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("tf"), "term"))).where("rank <= 15").select("doc_id", "term", "tf", "rank")


def tfidf_keywords_top15(spark, d):
    return C.keywords_tfidf(docs(spark, d), _W())


def tf_maxnorm(spark, d):
    return C.max_normalised(docs(spark, d), _ALL()).select("doc_id", "term", F.round("weight", 6).alias("weight"))


def repeated_bigrams(spark, d):
    return C.repeated_phrases(docs(spark, d), _W(), 2)


def repeated_trigrams(spark, d):
    return C.repeated_phrases(docs(spark, d), _W(), 3)


def postings_list(spark, d):
    p = C.postings(docs(spark, d), _W())
    return p.select("term", "chunk", "df", F.array_join(F.transform("list", lambda x: F.concat_ws(":", x["doc_id"], x["tf"])), " ").alias("list"))


def corpus_stats(spark, d):
    c = C.corpus_summary(docs(spark, d), _W())
    return c.select("documents", F.round("average_length", 6).alias("average_length"), "vocabulary")


def new_terms_df3(spark, d):
    known = spark.createDataFrame([(t,) for names in FALLBACK.values() for terms in names.values() for t in terms], "term string")
    return C.new_terms(docs(spark, d), _W(), known)


def porter_stems(spark, d):
    t = T.exploded(docs(spark, d), [], _ALL(), "term")
    return S.stemmed(t, "term")


def stemmed_label_counts(spark, d):
    """Score of each stem: count ln(length of its commonest term + 1)."""
    n = T.exploded(docs(spark, d), [], _W(), "term").groupBy("term").agg(F.count("*").alias("n"))
    j = n.join(S.stemmed(n, "term"), "term").groupBy("stem").agg(F.sum("n").alias("n"), F.max_by("term", F.struct("n", "term")).alias("label"))
    return j.select("stem", "label", "n", F.round(F.col("n") * F.log(F.length("label") + 1.0), 6).alias("score"))


def vector_topk(spark, d):
    e = table(spark, d, "embeddings")
    return C.nearest(e, e.where("vec_id % 100 = 0"))


def hybrid_score(spark, d):
    """Nearest vectors re-ranked: 0.7 cosine + 0.3 for the query's label."""
    e = table(spark, d, "embeddings")
    n = C.nearest(e, e.where("vec_id % 100 = 0"), 20)
    lab = e.select("vec_id", "label")
    j = n.join(lab, "vec_id").join(lab.select(F.col("vec_id").alias("query_id"), F.col("label").alias("query_label")), "query_id")
    return j.select("query_id", "vec_id", F.round(0.7 * F.col("cosine") + F.when(F.col("label") == F.col("query_label"), 0.3).otherwise(0.0), 7).alias("score"))


def packed_vectors(spark, d):
    """Base64 of the little-endian 32-bit floats of each vector, and the dimension."""
    e = table(spark, d, "embeddings")
    return e.select("vec_id", F.size("embedding").cast("bigint").alias("dims"), C.packed("embedding").alias("packed"))


def related_looms(spark, d):
    """Pairs of looms that share a tag; two at least are the operator's default, but no looms of the test data share two."""
    return C.related(table(spark, d, "looms").select(F.concat_ws("/", "weave", "slug").alias("loom"), F.explode("tags").alias("tag")), least=1)


QUERIES = {
    f.__name__: f
    for f in (
        bm25_topk, tf_relative_topk, tfidf_keywords_top15, tf_maxnorm, repeated_bigrams, repeated_trigrams, postings_list, corpus_stats, new_terms_df3, porter_stems, stemmed_label_counts, vector_topk,
        hybrid_score, packed_vectors, related_looms,
    )
}

_TF = f"{DOCS}, ws as (select doc_id, {tok('text', stop=True)} as w from docs), x as (select doc_id, len(w) as length, unnest(w) as term from ws), tf as (select doc_id, term, count(*)::bigint as n, any_value(length) as length from x group by all)"
_F = lambda t: f"len(list_filter(w, lambda x: x = '{t}'))::double"
_BM = " + ".join(f"(case when f{i} > 0 then ln(1 + (n - d{i} + 0.5::double) / (d{i} + 0.5::double)) * f{i} * 2.2::double / (f{i} + 1.2::double * (0.25::double + 0.75::double * length / mean)) else 0 end)" for i in range(len(TERMS)))


def _phrases(n: int) -> str:
    return f"""with {DOCS}, ws as (select doc_id, {tok("text", stop=True)} as w from docs), g as (select doc_id, unnest(list_transform(range(1, len(w) - {n - 2}), lambda i: array_to_string(w[i:i + {n - 1}], ' '))) as phrase from ws where len(w) >= {n}),
c as (select doc_id, phrase, count(*)::bigint as n from g group by all having count(*) > 1) select doc_id, phrase, n, row_number() over (partition by doc_id order by n desc, phrase)::int as rank from c qualify rank <= 10"""


_COS = "q as (select vec_id as query_id, embedding as e, label as query_label from embeddings where vec_id % 100 = 0), p as (select query_id, query_label, vec_id, label, round(list_cosine_similarity(q.e::double[], v.embedding::double[]), 6) as cosine from embeddings v join q on vec_id <> query_id)"
_KNOWN = ", ".join(f"'{t}'" for names in FALLBACK.values() for terms in names.values() for t in terms)

SQL = {
    "bm25_topk": f"""with {DOCS}, ws as (select doc_id, {tok("text", stop=True)} as w from docs), t as (select doc_id, greatest(len(w), 1)::double as length, {", ".join(f"{_F(t)} as f{i}" for i, t in enumerate(TERMS))} from ws),
s as (select count(*)::double as n, avg(length) as mean, {", ".join(f"count(*) filter (f{i} > 0)::double as d{i}" for i in range(len(TERMS)))} from t), r as (select doc_id, round({_BM}, 6) as score from t, s)
select doc_id, score, row_number() over (order by score desc, doc_id)::int as rank from r where score > 0 order by score desc, doc_id limit 20""",
    "tf_relative_topk": f"with {_TF} select doc_id, term, round(n / length, 9) as tf, row_number() over (partition by doc_id order by round(n / length, 9) desc, term)::int as rank from tf qualify rank <= 15",
    "tfidf_keywords_top15": f"""with {_TF}, df as (select term, count(*) as df from tf group by 1), s as (select doc_id, term, round(n / length * ln((select count(*) from docs)::double / df), 9) as score from tf join df using (term))
select doc_id, term, score, row_number() over (partition by doc_id order by score desc, term)::int as rank from s qualify rank <= 15""",
    "tf_maxnorm": f"with {DOCS}, x as (select doc_id, unnest({tok('text')}) as term from docs), c as (select doc_id, term, count(*) as n from x group by all) select doc_id, term, round(n / max(n) over (partition by doc_id), 6) as weight from c",
    "repeated_bigrams": _phrases(2),
    "repeated_trigrams": _phrases(3),
    "postings_list": f"with {_TF} select term, floor(doc_id / {C.CHUNK})::bigint as chunk, count(*)::bigint as df, string_agg(doc_id || ':' || n, ' ' order by doc_id) as list from tf group by 1, 2",
    "corpus_stats": f"with {_TF} select (select count(*) from docs)::bigint as documents, round((select avg(greatest(len(w), 1)::double) from ws), 6) as average_length, (select count(distinct term) from tf)::bigint as vocabulary",
    "new_terms_df3": f"with {_TF} select term, count(*)::bigint as df from tf where term not in ({_KNOWN}) group by term having count(*) >= 3 order by df desc, term limit 20",
    "vector_topk": f"with {_COS} select query_id, vec_id, cosine, row_number() over (partition by query_id order by cosine desc, vec_id)::int as rank from p qualify rank <= 5",
    "hybrid_score": f"with {_COS}, r as (select *, row_number() over (partition by query_id order by cosine desc, vec_id) as rank from p) select query_id, vec_id, round(0.7::double * cosine + case when label = query_label then 0.3::double else 0 end, 7) as score from r where rank <= 20",
    "related_looms": "with t as (select distinct weave || '/' || slug as loom, unnest(tags) as tag from looms) select a.loom as loom, b.loom as other, count(*)::bigint as shared from t a join t b on a.tag = b.tag and a.loom < b.loom group by 1, 2",
}
