from pyspark.sql import functions as F

from corpusmill.functions import text as T
from corpusmill.functions.register import register
from corpusmill.operators import pipeline as P


def test_index_entries(spark):
    rows = [(1, "weaves/a/b/x.md", "A title", None, "# Head\n\nThe software api is a software api for research work.\n"), (2, None, None, None, None), (3, "p", "t", "A summary that is long enough.", "")]
    d = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id bigint, path string, title string, summary string, text string, keywords string")
    got = {r.doc_id: r for r in P.index_entries(d).collect()}
    assert set(got) == {1, 2, 3} and got[1].subjects == ["technology", "science"] and got[1].phrases == ["software api"] and "software" in got[1].keywords
    assert got[2].keywords == [] and got[2].errors[0] == "Missing required field: title" and got[3].summary == "A summary that is long enough."
    assert P.index_entries(d.where("false")).count() == 0


def test_sql_functions(spark):
    register(spark)
    assert spark.sql("select stem('running'), size(word_tokens('a bcd efg')), inline_tags('#A #h1 #a')").first()[:] == ("run", 2, ["a"])
    got = spark.sql("select b.* from values ('# X\n\ntext'), (null), ('') as t(x), lateral md_blocks(x) b order by place").collect()
    assert [(r.type, r.heading) for r in got] == [("heading", "X"), ("paragraph", None)]


def test_placement(spark):
    s = spark.createDataFrame([("a", "cook", "oven oven dough"), ("b", "cook", "oven pan"), ("c", "law", "court judge"), ("d", "law", "oven oven"), ("e", "law", "")], "path string, loom string, t string")
    got = {r.path: (r.loom, r.decision) for r in P.placement(s, T.tokens(F.col("t"))).collect()}
    assert got["a"] == ("cook", "place") and got["d"][0] == "cook" and "e" not in got
    assert P.placement(s.where("false"), T.tokens(F.col("t"))).count() == 0


def test_placement_by_whole_profiles(spark):
    # the rarest word of a loom of 60 words places a strand, and a strand like no loom is new
    many = " ".join(f"word{i} word{i}" for i in range(60))
    rows = [("a", "x", many), ("b", "x", "rareword"), ("c", "y", "other words"), ("d", None, "rareword"), ("e", None, "unlike anything"), ("f", "y", "")]
    s = spark.createDataFrame(rows, "path string, loom string, t string")
    got = {r.path: (r.loom, r.similarity, r.decision) for r in P.placement(s, T.tokens(F.col("t"))).collect()}
    length = (60 * 4 + 1) ** 0.5
    assert got["b"] == got["d"] == ("x", round(1 / length, 6), "new") and got["e"] == (None, 0.0, "new") and "f" not in got
    assert got["a"][0] == "x" and got["a"][1] == round(240 / (240**0.5 * length), 6)
