"""Queries of the incremental operators and their DuckDB SQL."""

from __future__ import annotations

from corpusmill.operators import incremental as inc
from corpusmill.session import table


def p7_found(spark, d):
    return inc.changes(table(spark, d, "files"), table(spark, d, "runs"), table(spark, d, "file_scan")).select("path", "change_kind")


def p7_next_state(spark, d):
    """What is stored after the next run, although that run fails between writing and publishing and has to be repeated."""
    return inc.next_state(table(spark, d, "files"), table(spark, d, "runs"), table(spark, d, "file_scan")).select("key", "sha", "mtime")


QUERIES = {"p7_found": p7_found, "p7_next_state": p7_next_state}

_KEY = r"regexp_replace(regexp_replace(regexp_replace(trim(nfc_normalize(path)), '\\', '/', 'g'), '/(\./)+', '/', 'g'), '^(\./)+', '')"
_SHA = r"nullif(regexp_replace(lower(trim(sha)), '^sha-?256[:=]\s*', ''), '')"

_STATES = rf"""
with r as (select epoch_us(started_at) as s, lead(epoch_us(started_at)) over (order by started_at) as e, status from runs where started_at is not null),
f as (select {_KEY} as k, path, {_SHA} as sha, mtime, indexed_at from files join r on indexed_at * 1000 >= s and (e is null or indexed_at * 1000 < e) and lower(trim(status)) = 'ok'),
st as (select * from f qualify row_number() over (partition by k order by indexed_at desc, mtime desc nulls last, sha desc nulls last) = 1),
s as (select {_KEY} as k, {_SHA} as sha, mtime, seen_at from file_scan),
dk as (select * from s where sha is not null and mtime is not null qualify row_number() over (partition by k order by seen_at desc nulls last, mtime desc, sha desc) = 1)"""

SQL = {
    "p7_found": f"""{_STATES}
select st.path as path, 'deleted' as change_kind from st where k not in (select k from s)
union all select st.path, 'modified' from st join dk using (k) where st.sha is distinct from dk.sha or st.mtime is distinct from dk.mtime
union all select dk.k, 'added' from dk where k not in (select k from st)""",
    "p7_next_state": f"""{_STATES}
select k as key, sha, mtime from dk union all select k, sha, mtime from st where k in (select k from s) and k not in (select k from dk)""",
}
