"""Queries of whole passes and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.functions import skills as K, text as T
from corpusmill.functions.markdown import LANGUAGES
from corpusmill.functions.register import register
from corpusmill.functions.vocabulary import Vocabulary
from corpusmill.operators import corpus_stats as S, pipeline as P
from corpusmill.plans.blocks import _HEADS, _docs
from corpusmill.plans.text import DOCS, docs, tok
from corpusmill.session import spread, table
from corpusmill.sources import corpus as R


def _full(spark, d):
    s = table(spark, d, "strands").where("path is not null").groupBy("path").agg(F.max("summary").alias("summary"))
    return spread(table(spark, d, "documents").select("doc_id", "path", "title", "text").join(s, "path", "left"), "doc_id")


def _strand_words(spark, d):
    s = table(spark, d, "strands").where("path is not null").groupBy("path").agg(F.min(F.concat_ws("/", "weave", "loom")).alias("loom"), F.max("summary").alias("summary"))
    return s.where("summary is not null")


def index_entries(spark, d):
    return P.index_entries(_full(spark, d), Vocabulary.shipped())


def front_matter_split(spark, d):
    t = docs(spark, d)
    return t.select("doc_id", R.front_matter(F.col("text")).alias("header"), F.sha2(R.body(F.col("text")), 256).alias("body"))


def front_matter_json(spark, d):
    t = docs(spark, d).select("doc_id", R.front_matter(F.col("text")).alias("header")).where("header is not null")
    return t.select("doc_id", R.yaml_json("header").alias("metadata"))


def embedding_input(spark, d):
    return _full(spark, d).select("doc_id", F.sha2(P.embedding_input(F.col("title"), F.col("summary"), F.col("text")), 256).alias("input"))


def code_languages(spark, d):
    """Languages of the fenced code by what is in it."""
    c = T.exploded(docs(spark, d), ["doc_id"], F.regexp_extract_all("text", F.lit(r"(?s)```\w*\n(.*?)```"), F.lit(1)), "code")
    return c.select("doc_id", K.code_language(F.col("code")).alias("language")).groupBy("doc_id", "language").agg(F.count("*").alias("n"))


def sql_blocks(spark, d):
    """Blocks through SQL: the registered table function in a lateral join, with the source lines of each block."""
    register(spark)
    docs(spark, d).createOrReplaceTempView("corpus_documents")
    return spark.sql("""SELECT doc_id, CAST(place AS BIGINT) AS place, type, sha2(array_join(slice(split(d.text, '\\n'), line, greatest(end_line - line + 1, 0)), '\\n'), 256) AS source
FROM corpus_documents d, LATERAL md_blocks(d.text)""")


def summary_cosine(spark, d):
    """How like a document's words are to its summary's."""
    x = _full(spark, d).where("summary is not null and text is not null")
    w = lambda c: S.max_normalised(x.select("doc_id", F.col(c).alias("t")), T.tokens(F.col("t")))
    c = S.cosine(w("text"), w("summary"), ["doc_id"])
    return c.select("doc_id", F.round("cosine", 6).alias("cosine"))


def tagger_change(spark, d):
    return P.tagger_change(_docs(spark, d))


def loom_placement(spark, d):
    return P.placement(_strand_words(spark, d), T.tokens(F.col("summary")))


QUERIES = {f.__name__: f for f in (index_entries, front_matter_split, front_matter_json, embedding_input, code_languages, sql_blocks, summary_cosine, tagger_change, loom_placement)}

_S = "s as (select path, max(summary) as summary from strands where path is not null group by path), x as (select doc_id, d.path, title, text, summary from documents d left join s on s.path = d.path)"
_FM = r"regexp_extract(text, '(?s)\A\x{FEFF}?---[ \t]*\r?\n(.*?)\r?\n---[ \t]*(?:\r?\n|\z)', 1)"
_V = lambda n, c: f"{n}w as (select doc_id, unnest({tok(c)}) as term from x where summary is not null and text is not null), {n}c as (select doc_id, term, count(*) as n from {n}w group by all), {n}v as (select doc_id, term, n / max(n) over (partition by doc_id) as w from {n}c), {n}n as (select doc_id, sqrt(sum(w * w)) as norm from {n}v group by 1)"
_LANG = "case " + " ".join(f"when regexp_matches(code, '{p}') then '{n}'" for n, p in LANGUAGES) + " end"

SQL = {
    "front_matter_split": rf"with {DOCS} select doc_id, nullif({_FM}, '') as header, sha256(regexp_replace(text, '(?s)\A\x{{FEFF}}?---[ \t]*\r?\n.*?\r?\n---[ \t]*(?:\r?\n|\z)', '')) as body from docs",
    "embedding_input": f"with {_S} select doc_id, sha256(case when coalesce(summary, '') <> '' then concat(coalesce(title, ''), '. ', summary) else coalesce(text, '') end) as input from x",
    "code_languages": rf"with {DOCS}, c as (select doc_id, unnest(regexp_extract_all(text, '(?s)```\w*\n(.*?)```', 1)) as code from docs) select doc_id, {_LANG} as language, count(*)::bigint as n from c group by all",
    "sql_blocks": f"{_HEADS} select hh.doc_id, place::bigint as place, type, sha256(array_to_string(string_split(text, chr(10))[line:end_line], chr(10))) as source from hh join docs on docs.doc_id = hh.doc_id",
    "summary_cosine": f"with {_S}, {_V('a', 'text')}, {_V('b', 'summary')}, d as (select av.doc_id, sum(av.w * bv.w) as dot from av join bv using (doc_id, term) group by 1) select an.doc_id, round(coalesce(dot, 0) / (an.norm * bn.norm), 6) as cosine from an join bn using (doc_id) left join d using (doc_id)",
    "loom_placement": f"""with s as (select path, min(weave || '/' || loom) as loom, max(summary) as summary from strands where path is not null group by path), w as (select path, loom, unnest({tok("summary")}) as term from s where summary is not null), t as (select path, loom, term, count(*) as n from w group by all),
l as (select loom, term, sum(n) as w from t group by all), p as (select loom as dest, term, w / sqrt(sum(w * w) over (partition by loom)) as p from l where loom is not null), z as (select path, sqrt(sum(n * n)) as len from t group by 1),
c as (select path, dest, round(sum(n * p) / any_value(len), 6) as similarity from t join p using (term) join z using (path) group by all), b as (select * from (select z.path, dest, coalesce(similarity, 0) as similarity from z left join c on c.path = z.path) qualify row_number() over (partition by path order by similarity desc, dest) = 1)
select path, dest as loom, similarity, case when similarity >= {P.SURE} then 'place' when similarity >= {P.LIKELY} then 'review' else 'new' end as decision from b""",
}
