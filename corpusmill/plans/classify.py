"""Queries of classification and skills, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.functions import skills as K, text as T
from corpusmill.functions.vocabulary import FALLBACK, NEGATIVE, POSITIVE, TAGS, Vocabulary
from corpusmill.operators import classify as C
from corpusmill.plans.text import DOCS, docs, tok
from corpusmill.session import table


def _tags(spark, d):
    s = table(spark, d, "strands").where("path is not null").select("path", F.explode("tags").alias("tag")).where("trim(tag) <> ''").distinct()
    return table(spark, d, "documents").select("doc_id", "path").join(s, "path").select("doc_id", "tag")


def substring_vocab_match(spark, d):
    return C.matches(docs(spark, d), Vocabulary.shipped(), "subjects", "topics").select("doc_id", "name", "matches", F.round("confidence", 6).alias("confidence"))


def difficulty_argmax(spark, d):
    return C.difficulty(docs(spark, d), Vocabulary.shipped())


def difficulty_report(spark, d):
    """Documents by difficulty and weave, with subtotals."""
    x = C.difficulty(docs(spark, d), Vocabulary.shipped()).join(docs(spark, d).select("doc_id", T.weave(F.col("path")).alias("weave")), "doc_id")
    return x.rollup("weave", "difficulty").agg(F.count("*").alias("documents"), F.grouping_id().cast("bigint").alias("level"))


def context_factor(spark, d):
    return docs(spark, d).select("doc_id", *(F.round(C.context_factor(F.col("text"), t), 6).alias(t) for t in ("model", "library", "tree", "root", "platform")))


#: Looms whose words are held as a literal table; more are refused.
LOOMS = 1000


def _folders(spark, d) -> dict[str, list[str]]:
    """Words of each loom: its tags, in lower case."""
    x = table(spark, d, "looms").select(F.concat_ws("/", "weave", "slug").alias("folder"), F.explode("tags").alias("tag")).where("trim(tag) <> ''")
    rows = x.groupBy("folder").agg(F.sort_array(F.collect_set(F.lower("tag"))).alias("words")).orderBy("folder").limit(LOOMS + 1).collect()
    if len(rows) > LOOMS:
        raise ValueError(f"more than {LOOMS} looms")
    return {r["folder"]: list(r["words"]) for r in rows}


def category_signals(spark, d):
    """The four looms whose tags speak most for a document, `unsorted` where none does."""
    s = table(spark, d, "strands").where("path is not null").groupBy("path").agg(F.max("tags").alias("tags"))
    x = C.folder_scores(docs(spark, d).join(s, "path", "left"), _folders(spark, d), "unsorted", "tags")
    return x.where("rank <= 4").select("doc_id", "folder", F.round("score", 6).alias("score"), F.col("rank").cast("bigint").alias("rank"), F.round("confidence", 6).alias("confidence"))


def skills_fences(spark, d):
    return T.exploded(docs(spark, d), ["doc_id"], K.fence_skills(F.col("text")), "skill")


def imports_to_skills(spark, d):
    p = T.exploded(docs(spark, d), ["doc_id"], K.imported(F.col("text")), "package")
    return p.select("doc_id", K.package_skill(F.col("package")).alias("skill")).where("skill is not null").distinct()


def skills_patterns(spark, d):
    return T.exploded(docs(spark, d), ["doc_id"], K.pattern_skills(F.col("text")), "skill")


def skills_soft(spark, d):
    return T.exploded(docs(spark, d), ["doc_id"], K.soft_skills(F.col("text")), "skill")


def skills_all(spark, d):
    return T.exploded(C.skills(docs(spark, d)), ["doc_id"], F.col("skills"), "skill", "pos")


def auto_categorise(spark, d):
    """Names in their order, joined by |."""
    x = C.categorise(docs(spark, d), Vocabulary.shipped())
    return x.select("doc_id", "difficulty", *(F.array_join(c, "|").alias(c) for c in ("subjects", "topics", "skills")))


def stem_classify(spark, d):
    """Subjects, topics, skills and level by the whole vocabulary, with its stop words."""
    return C.stem_classify(docs(spark, d), Vocabulary.shipped()).select("doc_id", "category", "name", F.round("score", 6).alias("score"), F.round("confidence", 6).alias("confidence"))


def fuzzy_tag_match(spark, d):
    return C.fuzzy_tags(docs(spark, d), _tags(spark, d)).select("doc_id", "tag", "tokens", F.round("confidence", 6).alias("confidence"))


def vocab_ngram_match(spark, d):
    terms = spark.createDataFrame([(t,) for ts in TAGS.values() for t in ts] + [(t,) for n in FALLBACK.values() for ts in n.values() for t in ts], "term string")
    return C.vocabulary_ngrams(docs(spark, d), terms)


def label_join_report(spark, d):
    """Declared difficulty against judges' levels."""
    s = table(spark, d, "strands").where("path is not null").select("path", F.lower(F.trim("difficulty")).alias("declared")).distinct()
    l = table(spark, d, "strand_labels").where("kind = 'level'").select("path", "judge", "label").distinct()
    return l.join(s, "path").groupBy("declared", "label").agg(F.count("*").alias("n"))


QUERIES = {
    f.__name__: f
    for f in (
        substring_vocab_match, difficulty_argmax, difficulty_report, context_factor, category_signals, skills_fences, imports_to_skills, skills_patterns, skills_soft, skills_all, auto_categorise,
        stem_classify, fuzzy_tag_match, vocab_ngram_match, label_join_report,
    )
}

_Q = lambda xs: ", ".join(f"'{x}'" for x in xs)
_N = lambda ts, t="lower(text)": f"len(list_filter([{_Q(ts)}], lambda x: contains({t}, x)))"
_VOCABULARY = {c: {n: tuple(dict.fromkeys(ts)) for n, ts in names.items()} for c, names in Vocabulary.shipped().categories.items()}
_LEVELS = list(_VOCABULARY["difficulty"].items())
_MOST = f"greatest({', '.join(f'n{i}' for i in range(len(_LEVELS)))})"
_DIFF = f"df as (select doc_id, {', '.join(f'{_N(t)} as n{i}' for i, (_, t) in enumerate(_LEVELS))} from docs), dd as (select doc_id, case when {_MOST} = 0 then 'intermediate' {' '.join(f'when n{i} = {_MOST} then {chr(39)}{n}{chr(39)}' for i, (n, _) in enumerate(_LEVELS))} end as difficulty from df)"


def _context(t: str) -> str:
    near = f"substring(lower(text), greatest(instr(lower(text), '{t}') - 100, 1), instr(lower(text), '{t}') + {len(t) + 100} - greatest(instr(lower(text), '{t}') - 100, 1))"
    f = " * ".join(["1.0::double", *(f"(case when contains({near}, '{w}') then {by}::double else 1 end)" for tab, by in ((NEGATIVE, 0.3), (POSITIVE, 1.5)) for w in tab.get(t, ()))])
    return f"case when instr(lower(text), '{t}') = 0 then 1 else round(least(2, {f}), 6) end as {t}"


_E = lambda p: p.replace("'", "''").replace("\\\"", '"')
_BY: dict[str, list[str]] = {}
for _p, _s in K.PATTERNS:
    _BY.setdefault(_s, []).append(_p)
_IMP = " union all ".join(f"select doc_id, lower(unnest(regexp_extract_all(text, '{_E(p)}', 1))) as package from docs" for p in K.IMPORTS)
_PKG = "case " + " ".join(f"when starts_with(package, '{k}') then '{s}'" for k, s in K.PACKAGES.items()) + " end"
_FOLDER_SQL = f"""with {DOCS}, st as (select path, max(tags) as tags from strands where path is not null group by path),
l as (select doc_id, lower(text) as low, lower(coalesce(title, '')) as ttl, list_transform(list_filter(coalesce(st.tags, []), lambda x: x is not null), lambda x: lower(x)) as own, {tok("text", least=1)} as w from docs left join st on st.path = docs.path),
fw as (select distinct weave || '/' || slug as folder, lower(tag) as word from (select weave, slug, unnest(tags) as tag from looms) where trim(tag) <> ''),
h as (select doc_id, folder, (length(low) - length(replace(low, word, ''))) / length(word)::double * len(list_filter(w, lambda t: list_contains(string_split(word, ' '), t))) * (1 + ln(0.5::double))
  + case when contains(ttl, word) then 5 else 0 end + case when len(list_filter(own, lambda t: contains(t, word))) > 0 then 3 else 0 end as score from l join fw on contains(low, word)),
z as (select doc_id, folder, sum(score) as score from h group by all having sum(score) > 0),
y as (select doc_id, folder, round(score, 6) as score, row_number() over (partition by doc_id order by round(score, 9) desc, folder)::bigint as rank, round(least(0.75::double, score / max(score) over (partition by doc_id) * 0.75::double), 6) as confidence from z)
select * from y where rank <= 4 union all select doc_id, 'unsorted', 0.0::double, 1, 0.3::double from docs where doc_id not in (select doc_id from z)"""
_TAGS = "tg as (select distinct path, unnest(tags) as tag from strands where path is not null), dt as (select distinct d.doc_id, tag from documents d join tg on tg.path = d.path where trim(tag) <> '')"
_NG = lambda n: f"list_transform(range(1, greatest(len(w) - {n - 2}, 1)), lambda i: array_to_string(w[i:i + {n - 1}], ' '))"

SQL = {
    "substring_vocab_match": f"with {DOCS}, m as (" + " union all ".join(f"select doc_id, '{n}' as name, {_N(t)}::bigint as matches, {len(t)} as k from docs" for c in ("subjects", "topics") for n, t in _VOCABULARY[c].items()) + ") select doc_id, name, matches, round(matches / k, 6) as confidence from m where matches > 0",
    "difficulty_argmax": f"with {DOCS}, {_DIFF} select doc_id, difficulty from dd",
    "difficulty_report": f"with {DOCS}, {_DIFF}, x as (select difficulty, string_split(path, '/')[2] as weave from dd join docs using (doc_id)) select weave, difficulty, count(*)::bigint as documents, grouping(weave, difficulty)::bigint as level from x group by rollup (weave, difficulty)",
    "context_factor": f"with {DOCS} select doc_id, {', '.join(map(_context, ('model', 'library', 'tree', 'root', 'platform')))} from docs",
    "category_signals": _FOLDER_SQL,
    "skills_fences": f"with {DOCS}, m(k, skill) as (values {', '.join(f'({chr(39)}{k}{chr(39)}, {chr(39)}{s}{chr(39)})' for k, s in K.FENCES.items())}), f as (select doc_id, lower(unnest(regexp_extract_all(text, '```(\\w+)', 1))) as k from docs) select distinct doc_id, skill from f join m using (k)",
    "imports_to_skills": f"with {DOCS}, i as ({_IMP}), p as (select doc_id, {_PKG} as skill from i) select distinct doc_id, skill from p where skill is not null",
    "skills_patterns": f"with {DOCS} " + " union all ".join(f"select doc_id, '{s}' as skill from docs where regexp_matches(text, '(?i){'|'.join(f'(?:{_E(p)})' for p in ps)}')" for s, ps in _BY.items()),
    "skills_soft": f"with {DOCS} " + " union all ".join(f"select doc_id, '{s}' as skill from docs where len(regexp_extract_all(lower(text), '\\b({'|'.join(ws)})\\b')) >= 2" for s, ws in K.SOFT.items()),
    "fuzzy_tag_match": f"with {DOCS}, {_TAGS}, w as (select doc_id, {tok('text', keep='_' + chr(92) + '-')} as w from docs), x as (select doc_id, tag, len(list_filter(w, lambda y: contains(y, lower(tag)) or contains(lower(tag), y) or levenshtein(y, lower(tag)) <= 2))::bigint as tokens from w join dt using (doc_id)) select doc_id, tag, tokens, round(least(0.75::double, 0.4::double + tokens * 0.1::double), 6) as confidence from x where tokens > 0",
    "vocab_ngram_match": f"with {DOCS}, w as (select doc_id, {tok('text', keep='_' + chr(92) + '-')} as w from docs), g as (select doc_id, unnest(list_concat(w, list_concat({_NG(2)}, {_NG(3)}))) as term from w) select doc_id, term, count(*)::bigint as n from g where term in ({_Q([t for ts in TAGS.values() for t in ts] + [t for n in FALLBACK.values() for ts in n.values() for t in ts])}) group by all",
    "label_join_report": "with s as (select distinct path, lower(trim(difficulty)) as declared from strands where path is not null), l as (select distinct path, judge, label from strand_labels where kind = 'level') select declared, label, count(*)::bigint as n from l join s using (path) group by all",
}

_ORDERED = " union all ".join(f"select doc_id, {i} as part, 0 as place, skill from ({SQL[q]})" for i, q in enumerate(("skills_fences", "imports_to_skills", "skills_patterns", "skills_soft"), 1))
_FIRST = "(select doc_id, skill, min(part * 1000000 + place) as o from {} group by all)"
SQL["skills_all"] = f"""with a as ({_ORDERED}), b as (select * from {_FIRST.format("a")})
select doc_id, row_number() over (partition by doc_id order by o, skill) - 1 as pos, skill from b qualify pos < 15"""
_NAMES = lambda c: "array_to_string(list_filter([" + ", ".join(f"case when {_N(t)} > 0 then '{n}' end" for n, t in _VOCABULARY[c].items()) + "], lambda x: x is not null), '|')"
_TERMS = list(dict.fromkeys(t for ts in _VOCABULARY["skills"].values() for t in ts))
SQL["auto_categorise"] = f"""with {DOCS}, {_DIFF}, m as (select doc_id, list_filter([{_Q(_TERMS)}], lambda x: contains(lower(text), x))[1:10] as ts from docs),
a as (select doc_id, 0 as part, unnest(range(len(ts))) as place, unnest(ts) as skill from m union all {_ORDERED}),
b as (select doc_id, skill, row_number() over (partition by doc_id order by o, skill) as r from {_FIRST.format("(select doc_id, part, place, skill from a where part = 0 union all select doc_id, 1, r, skill from (select doc_id, skill, row_number() over (partition by doc_id order by o, skill) as r from " + _FIRST.format("(select * from a where part > 0)") + ") where r <= 15)")}),
s as (select doc_id, string_agg(skill, '|' order by r) as skills from b where r <= 15 group by 1)
select docs.doc_id, difficulty, {_NAMES("subjects")} as subjects, {_NAMES("topics")} as topics, coalesce(skills, '') as skills from docs join dd using (doc_id) left join s using (doc_id)"""
