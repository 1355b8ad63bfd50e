import math
import os

import pytest

import __spark_entry__ as entry

DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test data")


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "~"
    if isinstance(v, float):
        return f"{v:.6g}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(norm, v)) + "]"
    return str(v)


def rows(columns, data):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted("|".join(norm(r[i]) for i in order) for r in data)


@pytest.fixture(scope="session")
def duck():
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for f in os.listdir(DIR):
        c.execute(f"create view {f.split('.')[0]} as select * from '{DIR}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, DIR)
    r = duck.execute(entry.oracle_sql()[name])
    columns = [x[0] for x in r.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, df.collect()) == rows(columns, r.fetchall())


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_other_queries_run(spark, name):
    df = entry.queries()[name](spark, DIR)
    assert len(set(df.columns)) == len(df.columns)
    rows = df.collect()
    assert rows and any(v is not None for v in rows[0])


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_classification_uses_the_whole_vocabulary(spark, tmp_path):
    rows = [(1, "p", "t", "Kernel internals: cryptography and encryption against malware and phishing. A python seminar paper by a virtuoso.")]
    spark.createDataFrame(rows, "doc_id bigint, path string, title string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "path string, summary string").write.parquet(f"{tmp_path}/strands.parquet")
    for name in ("auto_categorise", "index_entries"):
        r = entry.queries()[name](spark, str(tmp_path)).first()
        assert "security" in r.subjects and r.difficulty == "expert" and "python" in r.skills
    got = {(r.category, r.name) for r in entry.queries()["stem_classify"](spark, str(tmp_path)).collect()}
    assert got >= {("subjects", "security"), ("difficulty", "expert"), ("skills", "python")}
