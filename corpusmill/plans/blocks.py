"""Queries of Markdown blocks and tags and their DuckDB SQL (segmentation as a recursive fold over lines)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.functions import text as T
from corpusmill.functions.vocabulary import tag_terms
from corpusmill.operators import blocks as B
from corpusmill.plans.text import DOCS, tok
from corpusmill.session import spread, table

_BIG = lambda *cols: [F.col(c).cast("bigint").alias(c) for c in cols]


def _docs(spark, d):
    """doc_id, text, tags of the strand with the document's path."""
    s = table(spark, d, "strands").where("path is not null").groupBy("path").agg(F.max("tags").alias("tags"))
    x = spread(table(spark, d, "documents").select("doc_id", "text", "path"))
    return x.join(s, "path", "left").select("doc_id", "text", "tags")


def _blocks(spark, d, **more):
    return B.blocks(spread(table(spark, d, "documents").select("doc_id", "text")).withColumn("tags", F.lit(None).cast("array<string>")), **({"tagger": "none"} | more))


def md_blocks(spark, d):
    return _blocks(spark, d).select("doc_id", *_BIG("place", "line", "end_line", "level"), "type", "heading")


def block_ids(spark, d):
    return _blocks(spark, d).select("doc_id", *_BIG("place"), "id")


def block_type_counts(spark, d):
    return _blocks(spark, d).groupBy("type").agg(F.count("*").alias("blocks"), F.count_distinct("doc_id").alias("documents"))


def block_worthiness(spark, d):
    return _blocks(spark, d).select("doc_id", *_BIG("place"), "topic_shift", "entity_density", "novelty", "structural", "score")


def block_summaries(spark, d):
    return _blocks(spark, d).where("summary is not null").select("doc_id", *_BIG("place"), "summary")


def tag_suggestions_unified(spark, d):
    b = B.blocks(_docs(spark, d))
    return b.select("doc_id", "place", F.posexplode("tags").alias("pos", "t")).select("doc_id", *_BIG("place", "pos"), "t.tag", "t.confidence", "t.source", F.col("t.line").cast("bigint").alias("line"))


def tag_suggestions_rich(spark, d):
    b = B.blocks(_docs(spark, d), tagger="rich")
    return b.select("doc_id", "place", F.posexplode("tags").alias("pos", "t")).select("doc_id", *_BIG("place", "pos"), "t.tag", F.round("t.confidence", 6).alias("confidence"), "t.source")


def auto_confirm(spark, d):
    return B.block_tags(B.blocks(_docs(spark, d), tagger="rich")).groupBy("source", "confirmed").agg(F.count("*").alias("n"))


def tag_index(spark, d):
    i = B.tag_index(B.block_tags(B.blocks(_docs(spark, d))))
    return i.select("tag", "chunk", F.array_join(F.transform("refs", lambda r: F.concat_ws(":", r["doc_id"], r["place"])), " ").alias("refs"))


def tag_lookup(spark, d):
    """Blocks that carry one tag."""
    return B.block_tags(B.blocks(_docs(spark, d))).where("confirmed and tag = 'tutorial'").select("doc_id", *_BIG("place"), "source")


def blocks_stats(spark, d):
    b = B.blocks(_docs(spark, d))
    return B.block_stats(b, B.block_tags(b))


QUERIES = {
    f.__name__: f
    for f in (md_blocks, block_ids, block_type_counts, block_worthiness, block_summaries, tag_suggestions_unified, tag_suggestions_rich, auto_confirm, tag_index, tag_lookup, blocks_stats)
}

_W = T.BLANK
_W1 = _W[1:-1]
_TRIM = lambda x: f"regexp_replace({x}, '^{_W}+|{_W}+$', '', 'g')"
_HEAD = rf"'^(#{{1,6}}){_W}+([^\n\r\x{{2028}}\x{{2029}}]+)$'"
_BLOCKS = rf"""
with recursive {DOCS},
l0 as (select doc_id, len(string_split(text, chr(10))) as total, unnest(string_split(text, chr(10))) as line, unnest(range(1, len(string_split(text, chr(10))) + 1)) as n from docs where text <> ''),
l as (select *, regexp_replace(line, '^{_W}+|{_W}+$', '', 'g') as t from l0),
f as (select *, starts_with(t, '```') as fence, coalesce(sum(case when starts_with(t, '```') then 1 else 0 end) over (partition by doc_id order by n rows between unbounded preceding and 1 preceding), 0) % 2 as inside from l),
k as (select doc_id, n, total, line, case when fence and inside = 0 then 'open' when fence then 'close' when inside = 1 then 'code' when regexp_matches(line, {_HEAD}) then 'heading' when starts_with(t, '>') then 'blockquote'
  when regexp_matches(t, '^[-*+]|[0-9]+\.{_W}') then 'list' when starts_with(t, '|') or (contains(t, '|') and regexp_matches(t, '^\|?[{_W1}:|-]+\|?$')) then 'table'
  when starts_with(t, '<') and not starts_with(t, '<!--') then case when ends_with(t, '>') or regexp_matches(t, '<[^>]+/>') then 'html1' else 'html' end when t = '' then 'blank' else 'paragraph' end as kind from f),
r as (select distinct doc_id, 0::bigint as n, '' as cur, 0::bigint as beg, false as tab, '' as done, 0::bigint as done_at, 0::bigint as done_end, '' as self from k
  union all
  select doc_id, kn, case kind when 'open' then 'code' when 'code' then cur when 'close' then '' when 'heading' then '' when 'html1' then '' when 'blank' then case when c2 = 'paragraph' then c2 else '' end else kind end,
    case when kind = 'code' then beg when kind = 'blank' then beg when kind in ('blockquote', 'list', 'table') and cur = kind then beg when kind = 'paragraph' and c2 = kind then beg else kn end,
    case when leak then false when kind = 'table' and cur <> 'table' then true else tab end,
    case when kind = 'close' or shut then cur else '' end, beg, case when kind = 'close' then kn else kn - 1 end, case when kind = 'heading' then 'heading' when kind = 'html1' then 'html' else '' end
  from (select r.*, kk.kind, kk.n as kn, kind in ('html', 'html1', 'blank', 'paragraph') and tab and cur <> '' as leak, case when kind in ('html', 'html1', 'blank', 'paragraph') and tab and cur <> '' then '' else cur end as c2,
      (kind in ('html', 'html1', 'blank', 'paragraph') and tab and cur <> '') or (cur <> '' and (kind in ('open', 'heading', 'html', 'html1') or (kind in ('blockquote', 'list', 'table') and cur <> kind)
        or (kind in ('blank', 'paragraph') and cur <> 'paragraph'))) as shut from r join k kk on kk.doc_id = r.doc_id and kk.n = r.n + 1) z),
b0 as (select doc_id, done as type, done_at as line, done_end as end_line from r where done <> '' union all select doc_id, self, n, n from r where self <> ''
  union all select doc_id, cur, beg, n from r where cur <> '' and n = (select max(n) from k where k.doc_id = r.doc_id)),
b as (select doc_id, row_number() over (partition by doc_id order by line) - 1 as place, count(*) over (partition by doc_id) as total, line, end_line, type from b0),
c as (select b.doc_id, b.place, b.total, b.type, b.line as first, k.n, k.line from b join k on k.doc_id = b.doc_id and k.n between b.line and b.end_line and k.kind not in ('blank', 'open')),
bt as (select b.doc_id, b.place, b.total, b.type, coalesce(string_agg(c.line, chr(10) order by c.n), '') as text, count(c.n) as items, coalesce(string_agg(c.line, ' ' order by c.n), '') as flat from b left join c on b.doc_id = c.doc_id and b.place = c.place group by 1, 2, 3, 4),
h as (select b.*, case when type = 'heading' then regexp_extract(k.line, {_HEAD}, ['m', 't']) end as g from b join k on k.doc_id = b.doc_id and k.n = b.line)"""
_HEADS = f"{_BLOCKS}, hh as (select *, length(g.m)::bigint as level, {_TRIM('g.t')} as heading from h)"
_SLUG = rf"substring(regexp_replace(regexp_replace(regexp_replace(lower(heading), '[^a-z0-9_\-{_W1}]', '', 'g'), '(?:{_W}|_)+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 50)"
_R3 = lambda x: f"floor(round({x}, 9) * 1000 + 0.5::double) / 1000"
_WORTH = rf"""{_HEADS},
bw as (select doc_id, place, unnest({tok("text")}) as term from bt), bc as (select doc_id, place, term, count(*) as n from bw group by all), bv as (select doc_id, place, term, n / max(n) over (partition by doc_id, place) as w from bc),
bn as (select doc_id, place, sqrt(sum(w * w)) as norm from bv group by all),
dw as (select doc_id, unnest({tok("text")}) as term from docs), dc as (select doc_id, term, count(*) as n from dw group by all), dv as (select doc_id, term, n / max(n) over (partition by doc_id) as w from dc), dn as (select doc_id, sqrt(sum(w * w)) as norm from dv group by all),
s1 as (select a.doc_id, a.place, sum(a.w * p.w) as dot from bv a join bv p on a.doc_id = p.doc_id and p.place = a.place - 1 and a.term = p.term group by all),
s2 as (select a.doc_id, a.place, sum(a.w * p.w) as dot from bv a join dv p on a.doc_id = p.doc_id and a.term = p.term group by all),
ew as (select doc_id, place, list_filter(regexp_split_to_array(text, '{_W}+'), lambda x: x <> '') as ws from bt),
ed as (select doc_id, place, case when len(ws) = 0 then 0 else least(1, (len(list_filter(ws, lambda x: regexp_matches(x, '^[A-Z][a-z]'))) + len(list_filter(ws, lambda x: regexp_matches(x, '[a-z][A-Z]|_|^[A-Z]{{2,}}$')))
  + 0.5::double * len(list_filter(ws, lambda x: regexp_matches(x, '[.:\[\]()<>{{}}]')))) / len(ws)) end as density from ew),
sig as (select bt.doc_id, bt.place, case when pn.norm is null then 0.5::double else 1 - coalesce(s1.dot / (bn.norm * pn.norm), 0) end as shift, density,
  case when dn.norm is null then 0.5::double else 1 - coalesce(s2.dot / (bn.norm * dn.norm), 0) end as nov,
  least(1, case bt.type when 'heading' then 1 - (level - 1) * 0.15::double when 'code' then 0.7::double when 'table' then 0.65::double when 'blockquote' then 0.5::double when 'list' then least(0.6::double, 0.3::double + items * 0.05::double)
    else least(0.5::double, 0.2::double + len(regexp_split_to_array(flat, '{_W}+')) * 0.005::double) end + case when bt.place < 3 then 0.1::double else 0 end + case when bt.place >= bt.total - 2 then 0.05::double else 0 end) as struc
  from bt join hh on hh.doc_id = bt.doc_id and hh.place = bt.place join ed on ed.doc_id = bt.doc_id and ed.place = bt.place left join bn on bn.doc_id = bt.doc_id and bn.place = bt.place
  left join bn pn on pn.doc_id = bt.doc_id and pn.place = bt.place - 1 left join dn on dn.doc_id = bt.doc_id left join s1 on s1.doc_id = bt.doc_id and s1.place = bt.place left join s2 on s2.doc_id = bt.doc_id and s2.place = bt.place),
wr as (select doc_id, place, {_R3("shift")} as topic_shift, {_R3("density")} as entity_density, {_R3("nov")} as novelty, {_R3("struc")} as structural, {_R3("shift * 0.2::double + density * 0.25::double + nov * 0.2::double + struc * 0.35::double")} as score from sig)"""
_VOCAB = ", ".join(f"({i}, '{k}', '{t.lower()}')" for i, (k, t, _) in enumerate(tag_terms()))
_TAGS = rf"""{_WORTH},
st as (select path, max(tags) as tags from strands where path is not null group by path), dt as (select d.doc_id, unnest(st.tags) as t, unnest(range(len(st.tags))) as i from documents d join st on st.path = d.path),
worthy as (select bt.doc_id, bt.place, bt.text from bt join wr on wr.doc_id = bt.doc_id and wr.place = bt.place and score >= 0.5),
il as (select doc_id, place, unnest(string_split(text, chr(10))) as line, unnest(range(1, len(string_split(text, chr(10))) + 1)) as ln from worthy),
ix as (select doc_id, place, ln, unnest(regexp_extract_all(line, '#([a-zA-Z][a-zA-Z0-9_/-]*)', 1)) as tag, unnest(range(len(regexp_extract_all(line, '#([a-zA-Z][a-zA-Z0-9_/-]*)', 1)))) as j from il),
iy as (select doc_id, place, lower(tag) as tag, min(ln * 100000 + j) as o, min(ln) as line from ix where not regexp_full_match(lower(tag), 'h[1-6]') group by all),
v(i, k, term) as (values {_VOCAB}),
nl as (select doc_id, place, k as tag, 0.7::double as confidence, 'nlp' as source, i::bigint as o from worthy join v on contains(lower(text), k) or contains(lower(text), term)
  union all select w.doc_id, place, regexp_replace(lower(t), '{_W}+', '-', 'g'), 0.5::double, 'existing', 1000 + i from worthy w join dt on dt.doc_id = w.doc_id where trim(t) <> ''),
n1 as (select * from nl qualify row_number() over (partition by doc_id, place, tag order by o) = 1), n2 as (select * from n1 qualify row_number() over (partition by doc_id, place order by o) <= 10),
al as (select doc_id, place, tag, 1.0::double as confidence, 'inline' as source, o, line, 0 as part from iy union all select doc_id, place, tag, confidence, source, o, null, 1 from n2),
a1 as (select * from al qualify row_number() over (partition by doc_id, place, tag order by part, o) = 1),
sg as (select doc_id, place, row_number() over (partition by doc_id, place order by part, o) - 1 as pos, tag, confidence, source, line from a1 qualify row_number() over (partition by doc_id, place order by part, o) <= 10)"""

SQL = {
    "md_blocks": f"{_HEADS} select doc_id, place::bigint as place, line::bigint as line, end_line::bigint as end_line, level, type, heading from hh",
    "block_ids": f"{_HEADS} select doc_id, place::bigint as place, case when coalesce({_SLUG}, '') <> '' then {_SLUG} else 'block-' || line end as id from hh",
    "block_type_counts": f"{_BLOCKS} select type, count(*)::bigint as blocks, count(distinct doc_id)::bigint as documents from b group by type",
    "block_worthiness": f"{_WORTH} select doc_id, place::bigint as place, topic_shift, entity_density, novelty, structural, score from wr",
    "block_summaries": f"""{_WORTH}, p as (select bt.doc_id, bt.place, list_filter(list_transform(regexp_split_to_array(bt.text, '[.!?]+'), lambda x: {_TRIM("x")}), lambda x: length(x) > 10)[1] as s from bt join wr on wr.doc_id = bt.doc_id and wr.place = bt.place
where bt.type = 'paragraph' and score >= 0.5) select doc_id, place::bigint as place, substring(s, 1, 200) as summary from p where s is not null""",
    "tag_suggestions_unified": f"{_TAGS} select doc_id, place::bigint as place, pos::bigint as pos, tag, confidence, source, line::bigint as line from sg",
    "tag_index": f"{_TAGS} select tag, floor(doc_id / 100000)::bigint as chunk, string_agg(doc_id || ':' || place, ' ' order by doc_id, place) as refs from sg where confidence >= 0.5 group by 1, 2",
    "tag_lookup": f"{_TAGS} select doc_id, place::bigint as place, source from sg where tag = 'tutorial' and confidence >= 0.5",
    "blocks_stats": f"""{_TAGS} select (select count(distinct doc_id) from b)::bigint as documents, (select count(*) from b)::bigint as blocks, (select count(*) from wr where score >= 0.5)::bigint as worthy, count(*) filter (confidence >= 0.5)::bigint as confirmed,
count(distinct tag)::bigint as distinct_tags, 0::bigint as pending, count(*) filter (source = 'inline')::bigint as from_inline, count(*) filter (source = 'nlp')::bigint as from_nlp, count(*) filter (source = 'existing')::bigint as from_existing from sg""",
}
