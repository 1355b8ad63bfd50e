"""Queries of the text functions and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.functions import text as T
from corpusmill.functions.vocabulary import Vocabulary
from corpusmill.session import spread, table

#: Stop words of the vocabulary, with their stems.
STOP_WORDS = Vocabulary.shipped().stop_words
STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)


def docs(spark, d):
    """doc_id, text ('' for null), path, title."""
    return spread(table(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "path", "title"), "doc_id")


def _counts(spark, d, words):
    return T.exploded(docs(spark, d), ["doc_id"], words, "term").groupBy("doc_id", "term").agg(F.count("*").alias("n"))


def token_counts(spark, d):
    return _counts(spark, d, T.tokens(F.col("text"), stop=STOP_WORDS))


def token_counts_all(spark, d):
    return _counts(spark, d, T.tokens(F.col("text")))


def token_counts_hyphen(spark, d):
    return _counts(spark, d, T.tokens(F.col("text"), keep=r"_\-"))


def token_counts_terms(spark, d):
    return _counts(spark, d, T.tokens(F.col("text"), keep=r"\-", least=2, stop=STOP_WORDS))


def stopword_share(spark, d):
    """How many tokens of a language are stop words."""
    t = T.exploded(table(spark, d, "documents").select(F.lower(F.coalesce("lang", F.lit("?"))).alias("lang"), "text"), ["lang"], T.tokens(F.coalesce("text", F.lit("")), least=1), "w")
    return t.where("w <> ''").groupBy("lang").agg(F.count("*").alias("tokens"), F.count_if(F.col("w").isin(*STOP_WORDS)).alias("stops"))


def normal_terms(spark, d):
    k = table(spark, d, "keywords").where("keyword is not null").select("keyword").distinct()
    return k.select("keyword", T.normal_term(F.trim("keyword")).alias("term"))


def slugify(spark, d):
    return docs(spark, d).where("title is not null").select("doc_id", T.slug(F.col("title")).alias("slug"), T.template_slug(F.col("title")).alias("template_slug"))


def name_titles(spark, d):
    f = table(spark, d, "files").where("path is not null").select("path").distinct()
    return f.select("path", T.name_title(F.col("path")).alias("title"))


def path_parts(spark, d):
    f = table(spark, d, "files").where("path is not null").select("path").distinct()
    return f.select("path", T.weave(F.col("path")).alias("weave"), T.loom(F.col("path")).alias("loom"), T.segment_title(T.loom(F.col("path"))).alias("title"))


def inline_tags(spark, d):
    return T.exploded(docs(spark, d), ["doc_id"], T.hashtags(F.col("text")), "tag", "pos").select("doc_id", F.col("pos").cast("bigint").alias("pos"), "tag")


def inline_tag_lines(spark, d):
    """First line of each inline tag."""
    lines = T.exploded(docs(spark, d), ["doc_id"], F.split("text", "\n"), "line", "i")
    t = T.exploded(lines, ["doc_id", "i"], T.hashtags(F.col("line")), "tag")
    return t.groupBy("doc_id", "tag").agg((F.min("i") + 1).cast("bigint").alias("line"))


def summary_sentence(spark, d):
    return T.with_summary(docs(spark, d), stop=STOP_WORDS).select("doc_id", "summary")


def readability(spark, d):
    return T.with_readability(docs(spark, d)).select("doc_id", "grade", "ease", "sentences", "words", "syllables")


def entity_density(spark, d):
    return docs(spark, d).select("doc_id", T.round3(T.entity_density(F.col("text"))).alias("density"))


def entity_runs(spark, d):
    return T.exploded(docs(spark, d), ["doc_id"], T.entities(F.col("text")), "entity", "pos").select("doc_id", F.col("pos").cast("bigint").alias("pos"), "entity")


def content_hashes(spark, d):
    return docs(spark, d).select("doc_id", T.content_hash(F.col("text")).alias("sha"))


def content_clips(spark, d):
    t = F.col("text")
    return docs(spark, d).select("doc_id", *(F.length(F.substring(t, 1, n)).cast("bigint").alias(f"clip_{n}") for n in (2000, 3000, 5000, 8000)), F.substring(t, 1, 300).alias("head"))


def search_text(spark, d):
    s = table(spark, d, "strands").where("path is not null").select("path", "title", "summary", "tags").distinct()
    return s.select("path", F.lower(F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("summary", F.lit("")), F.array_join(F.coalesce("tags", F.array().cast("array<string>")), " "))).alias("search_text"))


def commit_parse(spark, d):
    """Commit messages made of events: `type(user): value`, every fifth without scope, every seventh without form."""
    e = table(spark, d, "events")
    user, value = F.col("user_id").cast("string"), F.col("value").cast("int").cast("string")
    m = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("Merge "), F.col("event_type"))).when(F.col("event_id") % 5 == 0, F.concat("event_type", F.lit(": "), value))
    m = m.otherwise(F.concat("event_type", F.lit("("), user, F.lit("): "), value))
    return e.select("event_id", T.commit(m).alias("c")).select("event_id", "c.type", "c.scope", "c.description")


def json_fields(spark, d):
    """JSON taken out of fenced and bare answers made of event properties."""
    e = table(spark, d, "events")
    text = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("Here:\n```json\n"), F.col("props"), F.lit("\n```\nDone."))).when(F.col("event_id") % 3 == 1, F.concat(F.lit("Sure "), F.col("props"))).otherwise(F.lit("no data"))
    return e.select("event_id", F.get_json_object(T.first_json(text), "$.k").cast("bigint").alias("k"))


def badges(spark, d):
    t = docs(spark, d).agg(F.count("*").alias("n"), F.count_if(F.col("text") != "").alias("full"), F.sum(F.length("text")).alias("chars"))
    pct = F.floor(F.col("full") * 100.0 / F.col("n") * 100 + 0.5) / 100
    return t.select(pct.alias("percent"), T.coverage_colour(pct).alias("colour"), T.short_number(F.col("chars")).alias("chars"))


def loc_count(spark, d):
    return docs(spark, d).select("doc_id", T.code_lines(F.col("text")).cast("bigint").alias("loc"))


def field_checks(spark, d):
    s = table(spark, d, "strands").where("path is not null").select("path", "id", "slug").distinct()
    return s.select("path", "id", "slug", F.coalesce(T.uuid_ok(F.col("id")), F.lit(False)).alias("uuid"), F.coalesce(T.slug_ok(F.col("slug")), F.lit(False)).alias("slug_ok"))


def frequent_length_buckets(spark, d):
    """Documents by length bucket and month of change."""
    b = table(spark, d, "documents").select(F.floor(F.coalesce(F.length("text"), F.lit(0)) / 500).alias("bucket"), F.date_format("updated_at", "yyyy-MM").alias("month"))
    return b.groupBy("bucket", "month").agg(F.count("*").alias("n"))


QUERIES = {
    f.__name__: f
    for f in (
        token_counts, token_counts_all, token_counts_hyphen, token_counts_terms, stopword_share, normal_terms, slugify, name_titles, path_parts, inline_tags, inline_tag_lines, summary_sentence, readability,
        entity_density, entity_runs, content_hashes, content_clips, search_text, commit_parse, json_fields, badges, loc_count, field_checks, frequent_length_buckets,
    )
}

DOCS = "docs as (select doc_id, coalesce(text, '') as text, path, title from documents)"
_B = T.BLANK


def tok(text: str, keep: str = "_", least: int = 3, stop: bool = False) -> str:
    """DuckDB expression of the tokens of a text."""
    return f"list_filter(regexp_split_to_array(lower({text}), '[^a-z0-9{keep}]+'), lambda w: length(w) >= {least}{f' and w not in ({STOP})' if stop else ''})"


def _count_sql(expr: str) -> str:
    return f"with {DOCS}, t as (select doc_id, unnest({expr}) as term from docs) select doc_id, term, count(*)::bigint as n from t group by all"


CLEAN = f"regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '(?s)```.*?```', '', 'g'), '`[^`]+`', '', 'g'), '#{{1,6}}{_B}', '', 'g'), '^{_B}+|{_B}+$', '', 'g')"
_CAP = "lambda x: concat(upper(x[1:1]), x[2:])"
_TAGS = r"list_filter(list_transform(regexp_extract_all({0}, '#([a-zA-Z][a-zA-Z0-9_/-]*)', 1), lambda x: lower(x)), lambda x: x not in ('h1', 'h2', 'h3', 'h4', 'h5', 'h6'))"
_WORDS = lambda t: f"list_filter(regexp_split_to_array({t}, '{_B}+'), lambda x: x <> '')"
_BARE = r"regexp_replace(x, '[^a-zA-Z0-9_]', '', 'g')"
_SYL = f"case when {_BARE} = '' then 0 else greatest(1, len(regexp_extract_all(lower({_BARE}), '[aeiouy]+')) - (case when regexp_matches(lower({_BARE}), '[^aeiouy]e$') then 1 else 0 end)) end"
_CLIPS = ", ".join(f"length(substring(text, 1, {n}))::bigint as clip_{n}" for n in (2000, 3000, 5000, 8000))

SQL = {
    "token_counts": _count_sql(tok("text", stop=True)),
    "token_counts_all": _count_sql(tok("text")),
    "token_counts_hyphen": _count_sql(tok("text", keep=r"_\-")),
    "token_counts_terms": _count_sql(tok("text", keep=r"\-", least=2, stop=True)),
    "stopword_share": f"with t as (select lower(coalesce(lang, '?')) as lang, unnest({tok(chr(99) + 'oalesce(text, ' + chr(39) * 2 + ')', least=1)}) as w from documents) select lang, count(*)::bigint as tokens, count(*) filter (w in ({STOP}))::bigint as stops from t where w <> '' group by lang",
    "normal_terms": "select distinct keyword, regexp_replace(regexp_replace(regexp_replace(lower(trim(keyword)), '[^a-z0-9-]', '', 'g'), '-+', '-', 'g'), '^-|-$', '', 'g') as term from keywords where keyword is not null",
    "slugify": rf"""select doc_id, substring(regexp_replace(regexp_replace(regexp_replace(lower(title), '[^a-z0-9_\-{_B[1:-1]}]', '', 'g'), '(?:{_B}|_)+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 50) as slug,
  regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g') as template_slug from documents where title is not null""",
    "name_titles": rf"select distinct path, array_to_string(list_transform(string_split(regexp_replace(regexp_replace(string_split(path, '/')[-1], '\.[^.]*$', ''), '[-_]', ' ', 'g'), ' '), {_CAP}), ' ') as title from files where path is not null",
    "path_parts": f"""with p as (select distinct path, string_split(path, '/') as s from files where path is not null), q as (select path, s[2] as weave, case when len(s) > 3 then array_to_string(s[3:-2], '/') else '' end as loom from p)
select path, weave, loom, case when loom = '' then 'Overview' else array_to_string(list_transform(string_split(loom, '/'), lambda y: array_to_string(list_transform(regexp_split_to_array(y, '[-_]+'), {_CAP}), ' ')), ' / ') end as title from q""",
    "inline_tags": f"""with {DOCS}, t as (select doc_id, {_TAGS.format("text")} as a from docs), u as (select doc_id, unnest(a) as tag, unnest(range(len(a))) as i from t),
v as (select doc_id, tag, min(i) as i from u group by all) select doc_id, (row_number() over (partition by doc_id order by i) - 1)::bigint as pos, tag from v""",
    "inline_tag_lines": f"""with {DOCS}, l as (select doc_id, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as i from docs),
t as (select doc_id, i, unnest({_TAGS.format("line")}) as tag from l) select doc_id, tag, (min(i) + 1)::bigint as line from t group by doc_id, tag""",
    "summary_sentence": f"""with {DOCS}, c as (select doc_id, {CLEAN} as clean from docs),
s as (select doc_id, clean, {tok("clean", stop=True)}[1:20] as key, list_filter(regexp_split_to_array(clean, '[.!?]+{_B}+'), lambda x: length(x) > 20) as ss from c),
u as (select doc_id, key, unnest(ss) as x, unnest(range(len(ss))) as i from s), z as (select doc_id, x, i, len(list_filter({tok("x", stop=True)}, lambda y: list_contains(key, y))) as n from u),
b as (select doc_id, x from z qualify row_number() over (partition by doc_id order by n desc, i) = 1)
select s.doc_id, case when x is null then concat(substring(clean, 1, 200), '...') when length(x) > 300 then concat(substring(x, 1, 297), '...') else x end as summary from s left join b using (doc_id)""",
    "readability": f"""with {DOCS}, c as (select doc_id, {CLEAN} as clean from docs), n as (select doc_id, len(list_filter(regexp_split_to_array(clean, '[.!?]+{_B}+'), lambda x: length(x) > 10)) as s, {_WORDS("clean")} as ws from c),
m as (select doc_id, s, len(ws) as w, coalesce(list_sum(list_transform(ws, lambda x: {_SYL})), 0) as y from n)
select doc_id, case when s > 0 and w > 0 then floor(greatest(0, 0.39::double * (w / s) + 11.8::double * (y / w) - 15.59::double) * 10 + 0.5::double) / 10 else 0 end as grade,
case when s > 0 and w > 0 then floor(greatest(0, least(100, 206.835::double - 1.015::double * (w / s) - 84.6::double * (y / w))) + 0.5::double) else 0 end as ease,
(case when s > 0 and w > 0 then s else 0 end)::bigint as sentences, (case when s > 0 and w > 0 then w else 0 end)::bigint as words, (case when s > 0 and w > 0 then y else 0 end)::bigint as syllables from m""",
    "entity_density": rf"""with {DOCS}, w as (select doc_id, {_WORDS("text")} as ws from docs), n as (select doc_id, len(ws) as n, len(list_filter(ws, lambda x: regexp_matches(x, '^[A-Z][a-z]'))) + len(list_filter(ws, lambda x: regexp_matches(x, '[a-z][A-Z]|_|^[A-Z]{{2,}}$')))
  + 0.5::double * len(list_filter(ws, lambda x: regexp_matches(x, '[.:\[\]()<>{{}}]'))) as k from w) select doc_id, case when n = 0 then 0 else floor(least(1, k / n) * 1000 + 0.5::double) / 1000 end as density from n""",
    "entity_runs": rf"""with {DOCS}, t as (select doc_id, regexp_extract_all(text, '\b([A-Z][a-z]+(?: [A-Z][a-z]+)+)\b', 1) as a from docs), u as (select doc_id, unnest(a) as entity, unnest(range(len(a))) as i from t),
v as (select doc_id, entity, min(i) as i from u group by all), r as (select doc_id, (row_number() over (partition by doc_id order by i) - 1)::bigint as pos, entity from v) select * from r where pos < 10""",
    "content_hashes": f"with {DOCS} select doc_id, sha256(text) as sha from docs",
    "content_clips": f"with {DOCS} select doc_id, {_CLIPS}, substring(text, 1, 300) as head from docs",
    "search_text": "select distinct path, lower(concat_ws(' ', coalesce(title, ''), coalesce(summary, ''), coalesce(array_to_string(tags, ' '), ''))) as search_text from strands where path is not null",
    "commit_parse": r"""with m as (select event_id, case when event_id % 7 = 0 then 'Merge ' || event_type when event_id % 5 = 0 then event_type || ': ' || trunc(value)::int else event_type || '(' || user_id || '): ' || trunc(value)::int end as m from events),
p as (select event_id, m, regexp_matches(m, '^(\w+)(?:\(([^)]+)\))?:\s*(.+)$') as ok, regexp_extract(m, '^(\w+)(?:\(([^)]+)\))?:\s*(.+)$', ['t', 's', 'd']) as g from m)
select event_id, case when ok then lower(g.t) else 'other' end as type, case when ok and g.s <> '' then g.s end as scope, case when ok then g.d else m end as description from p""",
    "json_fields": "select event_id, case when event_id % 3 < 2 then json_extract_string(props, '$.k')::bigint end as k from events",
    "badges": f"""with {DOCS}, t as (select count(*) as n, count(*) filter (text <> '') as f, sum(length(text)) as c from docs), p as (select floor(f * 100.0::double / n * 100 + 0.5::double) / 100 as percent, c from t)
select percent, case when percent >= 80 then 'brightgreen' when percent >= 60 then 'green' when percent >= 40 then 'yellow' when percent >= 20 then 'orange' else 'red' end as colour,
case when c >= 1000000 then printf('%.1fM', floor(c / 1000000 * 10 + 0.5::double) / 10) when c >= 1000 then printf('%.1fK', floor(c / 1000 * 10 + 0.5::double) / 10) else c::varchar end as chars from p""",
    "loc_count": rf"""with {DOCS}, l as (select doc_id, unnest(string_split(text, chr(10))) as s from docs), t as (select doc_id, regexp_replace(s, '^{_B}+|{_B}+$', '', 'g') as s from l)
select doc_id, count(*) filter (s <> '' and not regexp_matches(s, '^(//|#|\*|/\*)'))::bigint as loc from t group by doc_id""",
    "field_checks": "select distinct path, id, slug, coalesce(regexp_matches(lower(id), '^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$'), false) as uuid, coalesce(regexp_matches(slug, '^[a-z0-9-]+$'), false) as slug_ok from strands where path is not null",
    "frequent_length_buckets": "select floor(coalesce(length(text), 0) / 500)::bigint as bucket, strftime(updated_at, '%Y-%m') as month, count(*)::bigint as n from documents group by all",
}
