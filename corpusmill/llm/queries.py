"""Queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.llm import bpe, canonical, cooccurrence, distinctiveness, leakage, reading_level, shared_spans, subjects, term_counts
from corpusmill.session import table


def p1_found(spark, d):
    return canonical.map_tags(table(spark, d, "strands"), table(spark, d, "canonical_tags"))


def p1_unmatched(spark, d):
    """Values that mean no entry, with the number of strands that hold them."""
    return p1_found(spark, d).where("tag = 'none'").groupBy("raw_tag").agg(F.count("*").alias("strands"))


def p2_found(spark, d):
    return reading_level.reading_levels(table(spark, d, "strands"), table(spark, d, "strand_labels")).select("path", "difficulty")


def p2_profile(spark, d):
    """How demanding each weave's texts are: number and mean calibrated grade (0 beginner .. 3 expert) by level."""
    s = table(spark, d, "strands")
    weave = s.select("path", "weave").where("path is not null").groupBy("path").agg(F.min("weave").alias("weave"))
    r = reading_level.reading_levels(s, table(spark, d, "strand_labels"))
    return r.join(weave, "path").groupBy("weave", "difficulty").agg(F.count("*").alias("strands"), F.round(F.avg("grade"), 4).alias("grade"))


def p3_found(spark, d):
    return term_counts.term_counts(table(spark, d, "keywords")).where("mark is not null").select("keyword", "mark")


def p3_counts(spark, d):
    return term_counts.term_counts(table(spark, d, "keywords")).select("keyword", "occurrences", "files", "mark")


def _subjects(spark, d):
    return subjects.subject_areas(*(table(spark, d, t) for t in ("strands", "strand_labels", "subjects", "stats")))


def p4_found(spark, d):
    return _subjects(spark, d).select("path", "subject")


def p4_composition(spark, d):
    """Strands and mean posterior of each subject."""
    return _subjects(spark, d).groupBy("subject").agg(F.count("*").alias("strands"), F.round(F.avg("posterior"), 4).alias("posterior"))


def p5_found(spark, d):
    return cooccurrence.cooccurrence(table(spark, d, "strands")).select("tag_a", "tag_b")


def p5_llr(spark, d):
    return cooccurrence.cooccurrence(table(spark, d, "strands")).select("tag_a", "tag_b", "n_ab", "n_a", "n_b", F.round("lift", 6).alias("lift"), F.round("llr", 4).alias("llr"))


def p6_found(spark, d):
    """Information of a file's holding a keyword, all files weighing the same (f ln(N/n) in all), by the PPMI operator."""
    return distinctiveness.top_keyword(distinctiveness.term_scores(table(spark, d, "keywords"), alpha=0, presence=True))


def p6_ppmi(spark, d):
    """Information of a keyword's occurrences with contexts smoothed by 0.75."""
    return distinctiveness.term_scores(table(spark, d, "keywords")).select("file_path", "keyword", "f", "n", F.round("ppmi", 5).alias("ppmi"), F.round("weight", 5).alias("weight"))


def p6_top_ppmi(spark, d):
    """The keyword of greatest smoothed PPMI of each file; values are compared to eight places, then in binary order."""
    x = distinctiveness.term_scores(table(spark, d, "keywords")).withColumn("ppmi", F.round("ppmi", 8))
    return distinctiveness.top_keyword(x, "ppmi")


def p8_ids(spark, d):
    return bpe.token_ids(table(spark, d, "documents"))


def p9_found(spark, d):
    return leakage.leaks(table(spark, d, "documents"), table(spark, d, "eval_items")).select("doc_id", "item_id")


def p9_items(spark, d):
    """Per item that leaked: documents that hold a part verbatim, documents with a near match (words moved or missing by 2 at most) too, the longest part, the greatest share."""
    x = leakage.leaks(table(spark, d, "documents"), table(spark, d, "eval_items"), slop=2)
    verbatim = F.count_if(F.col("longest") >= 12).alias("documents")
    return x.groupBy("item_id").agg(verbatim, F.count("*").alias("near_documents"), F.max("longest").alias("longest"), F.max(F.round(F.col("matched") / F.col("words"), 4)).alias("share"))


def p10_found(spark, d):
    return shared_spans.recurring(table(spark, d, "documents"))


def p10_coverage(spark, d):
    return shared_spans.coverage(table(spark, d, "documents")).select("doc_id", "n_chars", "shared", F.round("share", 6).alias("share"))


def p10_passages(spark, d):
    return shared_spans.passages(table(spark, d, "documents")).select("a", "b", "a_start", "a_end", "b_start", "b_end", "longest", F.round("score", 3).alias("score"), F.round("identity", 4).alias("identity"))


def p10_classes(spark, d):
    """Which documents are copies of one another: the members of the classes that p10_passages names."""
    return shared_spans.classes(table(spark, d, "documents"))


QUERIES = {f.__name__: f for f in (p1_found, p1_unmatched, p2_found, p2_profile, p3_found, p3_counts, p4_found, p4_composition, p5_found, p5_llr, p6_found, p6_ppmi, p6_top_ppmi, p8_ids, p9_found, p9_items, p10_found, p10_coverage, p10_passages, p10_classes)}

_PLAIN = r"nullif(regexp_replace(regexp_replace(lower(nfc_normalize({0})), '[\s_\-]+', '-', 'g'), '^-+|-+$', '', 'g'), '')"
_KEYWORD = _PLAIN.format("keyword")
_TAG = r"nullif(regexp_replace(" + _PLAIN.format(r"regexp_replace(t, '^[\s#]+', '')") + r", '^[#\-]+', ''), '')"

_TERMS = f"""
k as (select distinct file_path, keyword, tfidf_score, frequency from keywords),
p as (select file_path, {_KEYWORD} as term, coalesce(frequency, 1)::bigint as f from k where file_path is not null),
ft as (select file_path, term, sum(f)::bigint as f from p where term is not null group by all),
nn as (select count(distinct file_path)::bigint as big_n from keywords),
tt as (select term, sum(f)::bigint as f_term, count(*)::bigint as n from ft group by term)"""
_PPMI = f"""with {_TERMS}, dd as (select file_path, sum(f)::bigint as f_doc from ft group by 1), s as (select sum(f_doc)::double as total, sum(f_doc ** 0.75) as smooth from dd),
z as (select file_path, term as keyword, ft.f as f, n, greatest(0, ln(ft.f / total) - ln(f_term / total) - ln(f_doc ** 0.75 / smooth)) as ppmi from ft join tt using (term) join dd using (file_path), s)"""
_COUNTS = f"with {_TERMS}, c as (select term as keyword, f_term as occurrences, n as files, case when n < 3 then 'rare' when n > big_n / 20.0 then 'common' end as mark from tt, nn)"
_PAIRS = f"""
with x as (select path, unnest(tags) as t from strands where path is not null),
y as (select distinct path, {_TAG} as tag from x where t is not null),
n as (select count(distinct path)::bigint as n from strands),
c as (select tag, count(*)::bigint as c from y where tag is not null group by tag),
ab as (select a.tag as tag_a, b.tag as tag_b, count(*)::bigint as n_ab from y a join y b on a.path = b.path and a.tag < b.tag group by all),
z as (select tag_a, tag_b, n_ab, ca.c as n_a, cb.c as n_b, n.n as n, n_ab * n.n / (ca.c * cb.c)::double as lift from ab, c ca, c cb, n
  where ca.tag = tag_a and cb.tag = tag_b and n_ab >= 5 and n_ab >= 0.002 * n.n and n_ab * n.n >= 4 * ca.c * cb.c)"""
_X = "(case when {0} > 0 then ({0}) * ln({0}) else 0 end)".format

_LETTERS = "[" + ", ".join(f"'{c}'" for c in canonical._LETTERS) + "]"
_N = "(length({0}) - length(replace({0}, c, '')))".format
_OVER = lambda a, b: f"list_sum([greatest(0, {_N(a)} - {_N(b)}) for c in {_LETTERS}])"
_FOLD = lambda t: f"translate(lower(strip_accents({t})), '{canonical._LOOKALIKE[0]}', '{canonical._LOOKALIKE[1]}')"
_TOK = lambda t: f"list_filter(regexp_split_to_array({t}, '[^a-z0-9]+'), lambda x: x <> '')"
_IN = lambda words: ", ".join(f"'{w}'" for w in words)
_SLIPS = "(case " + " ".join(f"when length(rk.key) >= {n} then {s}" for n, s in canonical.SLIPS) + " else 0 end)"
#: Every value against every reference, without segments.
_CANON = f"""
with t as (select path, unnest(tags) as raw_tag from strands where path is not null),
u as (select distinct path, raw_tag from t where trim(raw_tag) <> '' and raw_tag not in (select tag from canonical_tags)),
v as (select raw_tag, {_FOLD("raw_tag")} as f from (select distinct raw_tag from u)),
w as (select raw_tag, {_TOK("f")} as w0, {_TOK("regexp_replace(f, '^.*[:/]([^a-z0-9]*[a-z0-9].*)$', '" + chr(92) + "1')")} as w1 from v),
g as (select *, len(w1) > 1 and w1[1] in ({_IN(canonical.LEADING)}) as a, len(w1) > 1 and w1[-1] in ({_IN(canonical.TRAILING)}) as b from w),
forms as (select raw_tag, 0 as form, w0 as w from g union all select raw_tag, 1, w1 from g union all select raw_tag, 2, w1[2:] from g where a union all select raw_tag, 3, w1[:-2] from g where b
  union all select raw_tag, 4, w1[2:-2] from g where a and b and len(w1) > 2),
k as (select raw_tag, form, array_to_string(w, '') as key, array_to_string(list_sort(w), '') as skey from forms),
r as (select tag, 0 as alias, tag as name from canonical_tags union all select tag, 1, unnest(aliases) from canonical_tags),
rk as (select tag, alias, array_to_string({_TOK(_FOLD("name"))}, '') as key, array_to_string(list_sort({_TOK(_FOLD("name"))}), '') as skey from r),
near as (select raw_tag, alias, tag, {_SLIPS} as slips, levenshtein(k.key, rk.key) as d, greatest({_OVER("k.key", "rk.key")}, {_OVER("rk.key", "k.key")}) as bag from k join rk
  on length(k.key) > 2 and length(rk.key) >= 5 and abs(length(k.key) - length(rk.key)) <= {_SLIPS} and levenshtein(k.key, rk.key) <= 2 * {_SLIPS}),
c as (select raw_tag, 0 as kind, form as s, 0 as d, alias, tag from k join rk using (key) union all select raw_tag, 1, form, 0, alias, tag from k join rk using (skey)
  union all select raw_tag, 2, d + bag, d, alias, tag from near where d + bag <= 2 * slips),
best as (select * from c qualify row_number() over (partition by raw_tag order by kind, s, d, alias, tag) = 1),
found as (select path, raw_tag, coalesce(tag, 'none') as tag from u left join best using (raw_tag))"""

_WINDOWS = """with d as (select doc_id, text, length(text) as n from documents where text is not null and length(text) >= 300),
s as (select doc_id, text, unnest(range(1, n - 299 + 1)) as i from d),
w as (select doc_id, i, md5(substring(text, i, 300)) as h from s),
t as (select h from w group by h having min(doc_id) <> max(doc_id)),
m as (select doc_id, i from w semi join t using (h))"""

SQL = {
    "p1_found": f"{_CANON} select path, raw_tag, tag from found",
    "p1_unmatched": f"{_CANON} select raw_tag, count(*)::bigint as strands from found where tag = 'none' group by raw_tag",
    "p10_found": f"{_WINDOWS} select distinct doc_id from m",
    "p10_coverage": f"""{_WINDOWS}, g as (select doc_id, least(300, coalesce(lead(i) over (partition by doc_id order by i) - i, 300)) as new from m),
c as (select doc_id, sum(new)::bigint as part from g group by 1)
select doc_id, coalesce(length(text), 0)::bigint as n_chars, coalesce(part, 0)::bigint as shared, case when coalesce(length(text), 0) > 0 then round(coalesce(part, 0) / length(text), 6) else 0 end as share
from documents left join c using (doc_id)""",
    "p10_classes": "select doc_id, min(doc_id) over (partition by text) as class_id from documents where length(text) >= 300",
    "p3_found": f"{_COUNTS} select keyword, mark from c where mark is not null",
    "p3_counts": f"{_COUNTS} select keyword, occurrences, files, mark from c",
    "p5_found": f"{_PAIRS} select tag_a, tag_b from z",
    "p5_llr": f"""{_PAIRS} select tag_a, tag_b, n_ab, n_a, n_b, round(lift, 6) as lift, round(greatest(0, 2 * ({_X("n_ab")} + {_X("n_a - n_ab")} + {_X("n_b - n_ab")} + {_X("n - n_a - n_b + n_ab")}
  + {_X("n")} - {_X("n_a")} - {_X("n - n_a")} - {_X("n_b")} - {_X("n - n_b")})), 4) as llr from z""",
    "p6_found": f"with {_TERMS} select file_path, term as keyword from ft join tt using (term), nn qualify row_number() over (partition by file_path order by ft.f * ln(big_n / n::double) desc, term) = 1",
    "p6_ppmi": f"""{_PPMI} select file_path, keyword, f, n, round(ppmi, 5) as ppmi, round(f * ppmi, 5) as weight from z""",
    "p6_top_ppmi": f"{_PPMI} select file_path, keyword from z qualify row_number() over (partition by file_path order by round(ppmi, 8) desc, keyword) = 1",
}
