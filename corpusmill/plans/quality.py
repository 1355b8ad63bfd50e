"""Queries of quality rules, duplicates, snapshots, activity and folder trees, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.functions import text as T
from corpusmill.operators import activity as A, quality as Q, snapshots as S
from corpusmill.plans.text import docs
from corpusmill.session import table
from corpusmill.streaming.daily import daily_stream


def _strands(spark, d):
    return table(spark, d, "strands").where("path is not null").select("path", "weave", "loom", "id", "slug", "title", "summary", "content_type", "difficulty", "relationships", "tags").distinct().withColumn("version", F.lit(None).cast("string"))


def _content(spark, d):
    x = table(spark, d, "documents").where("path is not null").groupBy("path").agg(F.max("text").alias("content"))
    return Q.content_rules(_strands(spark, d).join(x, "path", "left"))


def _messages(df, column):
    return T.exploded(df, ["path"], F.col(column), "message")


def quality_rules(spark, d):
    q = _content(spark, d)
    return _messages(q, "errors").withColumn("kind", F.lit("error")).unionByName(_messages(q, "warnings").withColumn("kind", F.lit("warning"))).distinct()


def quality_report(spark, d):
    return Q.report(_content(spark, d))


def common_errors(spark, d):
    return Q.common_messages(_content(spark, d), "errors")


def improvement_hints(spark, d):
    return _messages(Q.improvements(_strands(spark, d)), "suggestions").groupBy("message").agg(F.count("*").alias("n"))


def strand_rules(spark, d):
    return _messages(Q.strand_rules(_strands(spark, d)), "errors").distinct()


def strand_rules_schema(spark, d):
    return _messages(Q.strand_rules(_strands(spark, d), "schema"), "errors").distinct()


def loom_rules(spark, d):
    x = Q.folder_rules(table(spark, d, "looms"), ("slug", "title", "summary"))
    return T.exploded(x, ["weave", "slug"], F.col("errors"), "message")


def duplicate_ids(spark, d):
    return Q.repeats(_strands(spark, d), F.col("id"))


def duplicate_slugs(spark, d):
    return Q.repeats(_strands(spark, d), F.concat_ws(":", F.regexp_replace("path", "/[^/]*$", ""), F.col("slug")))


def duplicate_titles(spark, d):
    return Q.repeats(_strands(spark, d), Q.title_key())


def exact_duplicates(spark, d):
    """Texts that several documents have: the first document and how many."""
    x = docs(spark, d).where("text <> ''").select("doc_id", F.sha2("text", 256).alias("sha"))
    return x.groupBy("sha").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1")


def json_schema_check(spark, d):
    """Difficulty objects and relationship edges against a small schema."""
    schema = {"type": "object", "required": ["overall", "cognitive"], "properties": {"overall": {"type": "string", "enum": list(Q.LEVELS)}, "cognitive": {"type": "number", "minimum": 1, "maximum": 8}}}
    s = _strands(spark, d).where("difficulty is not null").select("path", "difficulty").distinct()
    return T.exploded(s, ["path"], Q.schema_errors(F.col("difficulty"), schema), "message")


def _orders(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    new = o.where("o_orderkey % 13 <> 0").withColumn("o_totalprice", F.when(F.col("o_orderkey") % 7 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return o.where("o_orderkey % 10 <> 0"), new


def _diff(spark, d):
    return S.difference(*_orders(spark, d), "o_orderkey", ["o_orderstatus", "o_totalprice"])


def snapshot_diff(spark, d):
    return _diff(spark, d)


def snapshot_upsert(spark, d):
    old, new = _orders(spark, d)
    return S.upsert(old, new, "o_orderkey").groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("price"))


def snapshot_deletes(spark, d):
    old, new = _orders(spark, d)
    gone = _diff(spark, d).where("change = 'deleted'")
    return S.delete(old, gone, "o_orderkey").groupBy("o_orderstatus").agg(F.count("*").alias("n"))


def cache_hit_rate(spark, d):
    return S.hit_rate(_diff(spark, d)).select("cached", "processed", F.round("rate", 6).alias("rate"))


def cache_stats(spark, d):
    """Counts and times of the cached files."""
    f = table(spark, d, "files").agg(F.count("*").alias("rows"), F.count_distinct("path").alias("files"), F.min("indexed_at").alias("oldest"), F.max("indexed_at").alias("newest"), F.sum("size").alias("bytes"))
    return f.join(F.broadcast(table(spark, d, "keywords").agg(F.count("*").alias("keywords"))))


def orphan_keywords(spark, d):
    k = S.orphans(table(spark, d, "keywords"), table(spark, d, "files"), "file_path", "path")
    return k.groupBy("file_path").agg(F.count("*").alias("n"))


def ranked_tags(spark, d):
    s = table(spark, d, "strands").where("path is not null and size(tags) > 0").select("path", F.col("tags").alias("keywords")).distinct()
    return S.ranked_keywords(s).select("path", "keyword", F.round("score", 6).alias("score"), F.col("rank").cast("bigint").alias("rank"))


def loom_stats(spark, d):
    """Strands, distinct tags and difficulty of each loom, computed anew."""
    s = _strands(spark, d).select("path", "weave", "loom", "tags", F.lower(F.trim(F.coalesce(F.get_json_object("difficulty", "$.overall"), "difficulty"))).alias("level"))
    g = s.groupBy("weave", "loom").agg(F.count_distinct("path").alias("files"), *(F.count_if(F.col("level") == x).alias(x) for x in Q.LEVELS))
    t = s.select("weave", "loom", F.explode("tags").alias("tag")).groupBy("weave", "loom").agg(F.count_distinct("tag").alias("tags"))
    return g.join(t, ["weave", "loom"], "left").select("weave", "loom", "files", F.coalesce("tags", F.lit(0)).alias("tags"), *Q.LEVELS)


def daily_rollup(spark, d):
    return A.daily(table(spark, d, "events"))


def monthly_rollup(spark, d):
    m = A.monthly(table(spark, d, "events"))
    return m.select("month", "days", "n", *(F.coalesce(F.try_element_at("by_type", F.lit(t)), F.lit(0)).alias(t) for t in ("click", "error", "purchase", "signup", "view")))


def rollup_by_type(spark, d):
    return table(spark, d, "events").groupBy("event_type", F.window("ts", "1 day").alias("w")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("value")).select("event_type", F.to_date("w.start").alias("date"), "n", "value")


def append_dedup(spark, d):
    days = A.daily(table(spark, d, "events")).select("date", "type", "n")
    log = days.where("dayofmonth(date) < 15 and type <> 'error'")
    return A.unseen(days, log)


def activity_summary(spark, d):
    k = F.col("event_type")
    return A.summary(table(spark, d, "events"), {"created": k == "signup", "closed": k == "purchase", "merged": k == "click"})


def stream_daily_rollup(spark, d):
    return daily_stream(spark, d)


def tree_rollup(spark, d):
    s = _strands(spark, d).select("weave", "loom", "path").distinct()
    return s.rollup("weave", "loom").agg(F.count("*").alias("strands"), F.grouping_id().cast("bigint").alias("level"))


def loom_dim_join(spark, d):
    """Looms with their titles, the folder's name where none is given, and their strands."""
    l = table(spark, d, "looms").select("weave", F.col("slug").alias("loom"), "title", "summary")
    s = _strands(spark, d).groupBy("weave", "loom").agg(F.count_distinct("path").alias("strands"))
    return s.join(F.broadcast(l), ["weave", "loom"], "left").select("weave", "loom", F.coalesce(F.nullif("title", F.lit("")), "loom").alias("title"), F.coalesce("summary", F.lit("")).alias("summary"), "strands")


def strand_tree(spark, d):
    """Place of each strand in its loom by title."""
    from pyspark.sql import Window

    s = _strands(spark, d).select("weave", "loom", "path", F.coalesce("title", F.lit("")).alias("title")).groupBy("weave", "loom", "path").agg(F.min("title").alias("title"))
    return s.withColumn("place", F.row_number().over(Window.partitionBy("weave", "loom").orderBy("title", "path")).cast("bigint"))


def relationship_edges(spark, d):
    """Edges of both dialects: arrays of edges, and objects of lists."""
    s = _strands(spark, d).where("relationships is not null").select("path", "relationships").distinct()
    a = s.select("path", F.explode(F.from_json("relationships", "array<struct<targetSlug: string, type: string, strength: double, bidirectional: boolean>>")).alias("e")).select("path", F.col("e.targetSlug").alias("target"), F.col("e.type").alias("type"), F.col("e.strength").alias("strength"))
    b = None
    for k in ("requires", "references"):
        x = s.select("path", F.explode(F.from_json(F.get_json_object("relationships", f"$.{k}"), "array<string>")).alias("target"), F.lit(k).alias("type"), F.lit(None).cast("double").alias("strength"))
        b = x if b is None else b.unionByName(x)
    return a.where("target is not null").unionByName(b)


QUERIES = {
    f.__name__: f
    for f in (
        quality_rules, quality_report, common_errors, improvement_hints, strand_rules, strand_rules_schema, loom_rules, duplicate_ids, duplicate_slugs, duplicate_titles, exact_duplicates, json_schema_check,
        snapshot_diff, snapshot_upsert, snapshot_deletes, cache_hit_rate, cache_stats, orphan_keywords, ranked_tags, loom_stats, daily_rollup, monthly_rollup, rollup_by_type, append_dedup, activity_summary,
        stream_daily_rollup, tree_rollup, loom_dim_join, strand_tree, relationship_edges,
    )
}

_S = "s as (select distinct path, weave, loom, id, slug, title, summary, content_type, difficulty, relationships, tags from strands where path is not null)"
_M = lambda c: f"coalesce({c}, '') = ''"
_GUIDE = "regexp_matches(path, '/docs/|/wiki/|README|GUIDE|CONTRIBUTING')"
_ERR = [(_M("title"), "Missing required field: title"), (_M("summary"), "Missing required field: summary"), ("length(nullif(title, '')) < 3", "Title too short (< 3 chars)"), ("length(title) > 100", "Title too long (> 100 chars)")] + [(f"not {_GUIDE} and regexp_matches(content, '(?i){p}')", m) for p, m in Q.FORBIDDEN]
_WARN = [("length(nullif(summary, '')) < 20", "Summary too short (< 20 chars)"), ("length(summary) > 300", "Summary too long (> 300 chars)"), ("length(content) < 100", "Content very short (< 100 chars)")]
_LIST = lambda rules: "list_filter([" + ", ".join(f"case when {c} then '{m.replace(chr(39), chr(39) * 2)}' end" for c, m in rules) + "], lambda x: x is not null)"
_CONTENT = f"with {_S}, c as (select path, max(text) as content from documents where path is not null group by path), x as (select s.*, coalesce(content, '') as content from s left join c using (path)), q as (select path, {_LIST(_ERR)} as errors, {_LIST(_WARN)} as warnings from x)"
_UUID = "regexp_matches(lower(id), '^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$')"
_RQ = lambda k: f"json_valid(relationships) and json_extract(relationships, '$.{k}') is not null and json_type(relationships, '$.{k}') not in ('ARRAY', 'NULL')"
_IN = lambda xs: ", ".join(f"'{x}'" for x in xs)
_BASE = [(_M(c), f"Missing required field '{c}'") for c in ("id", "slug", "title")] + [(f"not {_M('id')} and not {_UUID}", "ID must be a valid UUID")]
_CODE = _BASE + [(f"not {_M('content_type')} and content_type not in ({_IN(Q.CONTENT_TYPES['code'])})", "Invalid content type"), (f"not {_M('difficulty')} and lower(trim(difficulty)) not in ({_IN(Q.LEVELS)})", "Invalid difficulty level"), (_RQ("requires"), "Relationships.requires must be an array"), (_RQ("references"), "Relationships.references must be an array")]
_OVER = "lower(coalesce(case when json_valid(difficulty) then json_extract_string(difficulty, '$.overall') end, trim(difficulty)))"
_SCHEMA = _BASE + [(f"not {_M('content_type')} and content_type not in ({_IN(Q.CONTENT_TYPES['schema'])})", "Invalid content type"), (f"not {_M('difficulty')} and {_OVER} not in ({_IN(Q.LEVELS)})", "Invalid difficulty level"), (f"not {_M('relationships')} and not starts_with(relationships, '[')", "Relationships must be an array")]
_DUP = lambda key: f"with {_S}, k as (select distinct path, {key} as key from s), f as (select key, min(path) as first from k where coalesce(key, '') <> '' group by key) select path, key, first from k join f using (key) where path > first"
_ORD = "o as (select o_orderkey, o_orderstatus, o_totalprice from orders where o_orderkey % 10 <> 0), n as (select o_orderkey, o_orderstatus, case when o_orderkey % 7 = 0 then o_totalprice + 1 else o_totalprice end as o_totalprice from orders where o_orderkey % 13 <> 0)"
_CH = f"{_ORD}, df as (select coalesce(n.o_orderkey, o.o_orderkey) as o_orderkey, case when o.o_orderkey is null then 'added' when n.o_orderkey is null then 'deleted' when o.o_orderstatus is not distinct from n.o_orderstatus and o.o_totalprice is not distinct from n.o_totalprice then 'unchanged' else 'modified' end as change from o full join n on o.o_orderkey = n.o_orderkey)"
_DAY = "e as (select ts::date as date, event_type as type from events where ts is not null), b as (select date, type, count(*)::bigint as n from e group by all)"

SQL = {
    "quality_rules": f"{_CONTENT} select distinct path, unnest(errors) as message, 'error' as kind from q union select distinct path, unnest(warnings), 'warning' from q",
    "quality_report": f"{_CONTENT} select count(*)::bigint as rows, count(*) filter (len(errors) = 0)::bigint as valid, sum(len(errors))::bigint as errors, sum(len(warnings))::bigint as warnings from q",
    "common_errors": f"{_CONTENT}, m as (select unnest(errors) as message from q) select message, count(*)::bigint as n from m group by 1 order by n desc, message limit 10",
    "improvement_hints": f"with {_S}, m as (select unnest({_LIST([(_M('id'), 'Add unique ID'), ('true', 'Add version number'), ('coalesce(len(tags), 0) = 0', 'Consider adding tags'), (_M('relationships'), 'Consider adding relationships'), (_M('difficulty'), 'Suggest difficulty')])}) as message from s) select message, count(*)::bigint as n from m group by 1",
    "strand_rules": f"with {_S} select distinct path, unnest({_LIST(_CODE)}) as message from s",
    "strand_rules_schema": f"with {_S} select distinct path, unnest({_LIST(_SCHEMA)}) as message from s",
    "loom_rules": f"""select weave, slug, unnest({_LIST([(_M(c), f"Missing required field '{c}'") for c in ("slug", "title", "summary")] + [("not (coalesce(slug, '') = '') and not regexp_matches(slug, '^[a-z0-9-]+$')", "Slug must be lowercase alphanumeric with hyphens")])}) as message from looms""",
    "duplicate_ids": _DUP("id"),
    "duplicate_slugs": _DUP("concat_ws(':', regexp_replace(path, '/[^/]*$', ''), slug)"),
    "duplicate_titles": _DUP("regexp_replace(lower(title), '[^a-z0-9]', '', 'g')"),
    "exact_duplicates": "select sha256(text) as sha, min(doc_id) as first, count(*)::bigint as n from documents where text <> '' group by 1 having count(*) > 1",
    "json_schema_check": f"""with {_S}, d as (select distinct path, difficulty as x, case when json_valid(difficulty) then difficulty::json end as j from s where difficulty is not null)
select path, unnest({_LIST([("j is null", "not JSON"), ("j is not null and json_type(j) <> 'OBJECT'", "expected object"), ("j is not null and json_extract(j, '$.overall') is null", "missing overall"), ("j is not null and json_extract(j, '$.cognitive') is null", "missing cognitive"),
("json_type(j, '$.overall') <> 'VARCHAR'", "overall: expected string"), (f"json_extract_string(j, '$.overall') not in ({_IN(Q.LEVELS)})", "overall: not allowed"), ("json_extract(j, '$.cognitive')::double < 1", "cognitive: below 1"), ("json_extract(j, '$.cognitive')::double > 8", "cognitive: above 8")])}) as message from d""",
    "snapshot_diff": f"with {_CH} select o_orderkey, change from df",
    "snapshot_upsert": f"with {_ORD}, u as (select * from n union all select * from o where o_orderkey not in (select o_orderkey from n)) select o_orderstatus, count(*)::bigint as n, round(sum(o_totalprice), 2) as price from u group by 1",
    "snapshot_deletes": f"with {_CH} select o_orderstatus, count(*)::bigint as n from o where o_orderkey not in (select o_orderkey from df where change = 'deleted') group by 1",
    "cache_hit_rate": f"with {_CH} select count(*) filter (change = 'unchanged')::bigint as cached, count(*) filter (change in ('added', 'modified'))::bigint as processed, round(count(*) filter (change = 'unchanged') / count(*) filter (change <> 'deleted'), 6) as rate from df",
    "cache_stats": "select count(*)::bigint as rows, count(distinct path)::bigint as files, min(indexed_at)::bigint as oldest, max(indexed_at)::bigint as newest, sum(size)::bigint as bytes, (select count(*) from keywords)::bigint as keywords from files",
    "orphan_keywords": "select file_path, count(*)::bigint as n from keywords k where not exists (select 1 from files f where f.path = k.file_path) group by 1",
    "ranked_tags": "with s as (select distinct path, tags from strands where path is not null and len(tags) > 0), x as (select path, len(tags) as n, unnest(tags) as keyword, unnest(range(len(tags))) as i from s) select path, keyword, round(1 - i / n, 6) as score, (i + 1)::bigint as rank from x",
    "loom_stats": f"with {_S}, x as (select path, weave, loom, tags, lower(trim(coalesce(case when json_valid(difficulty) then json_extract_string(difficulty, '$.overall') end, difficulty))) as level from s), t as (select weave, loom, unnest(tags) as tag from s), u as (select weave, loom, count(distinct tag)::bigint as tags from t group by all), g as (select weave, loom, count(distinct path)::bigint as files, "
    + ", ".join(f"count(*) filter (level = '{x}')::bigint as {x}" for x in Q.LEVELS)
    + " from x group by all) select weave, loom, files, coalesce(tags, 0) as tags, beginner, intermediate, advanced, expert from g left join u using (weave, loom)",
    "daily_rollup": f"with {_DAY} select strftime(date, '%Y-%m') as month, date, type, n, (sum(n) over (partition by date))::bigint as total from b",
    "monthly_rollup": f"with {_DAY} select strftime(date, '%Y-%m') as month, count(distinct date)::bigint as days, sum(n)::bigint as n, {', '.join(f'coalesce(sum(n) filter (type = {chr(39)}{t}{chr(39)}), 0)::bigint as {chr(34)}{t}{chr(34)}' for t in ('click', 'error', 'purchase', 'signup', 'view'))} from b group by 1",
    "rollup_by_type": "select event_type, ts::date as date, count(*)::bigint as n, round(sum(value), 4) as value from events where ts is not null group by 1, 2",
    "append_dedup": f"with {_DAY} select date, type, n from b where not (day(date) < 15 and type <> 'error')",
    "activity_summary": "with x as (select ts::date as date, count(*) filter (event_type = 'signup')::bigint as created, count(*) filter (event_type = 'purchase')::bigint as closed, count(*) filter (event_type = 'click')::bigint as merged from events where ts is not null group by 1) select *, (created + closed + merged)::bigint as total from x where created + closed + merged > 0",
    "stream_daily_rollup": "select ts::date as date, event_type as type, count(*)::bigint as n from events where ts is not null group by 1, 2",
    "tree_rollup": f"with {_S}, x as (select distinct weave, loom, path from s) select weave, loom, count(*)::bigint as strands, grouping(weave, loom)::bigint as level from x group by rollup (weave, loom)",
    "loom_dim_join": f"with {_S}, g as (select weave, loom, count(distinct path)::bigint as strands from s group by all) select g.weave, g.loom, coalesce(nullif(l.title, ''), g.loom) as title, coalesce(l.summary, '') as summary, strands from g left join looms l on l.weave = g.weave and l.slug = g.loom",
    "strand_tree": f"with {_S}, x as (select weave, loom, path, min(coalesce(title, '')) as title from s group by all) select weave, loom, path, title, (row_number() over (partition by weave, loom order by title, path))::bigint as place from x",
    "relationship_edges": f"""with {_S}, r as (select distinct path, relationships::json as j from s where json_valid(relationships)), a as (select path, unnest(json_extract(j, '$[*]')) as e from r where json_type(j) = 'ARRAY'),
b as (select path, unnest(json_extract_string(j, '$.requires[*]')) as target, 'requires' as type from r where json_type(j) = 'OBJECT' union all select path, unnest(json_extract_string(j, '$.references[*]')), 'references' from r where json_type(j) = 'OBJECT')
select path, json_extract_string(e, '$.targetSlug') as target, json_extract_string(e, '$.type') as type, json_extract(e, '$.strength')::double as strength from a union all select path, target, type, null from b""",
}
