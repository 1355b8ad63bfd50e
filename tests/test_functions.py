import pytest
from pyspark.sql import functions as F

from corpusmill.functions import markdown as M, normal as N, skills as K, text as T
from corpusmill.functions.stem import stem, stem_term
from corpusmill.functions.vocabulary import Vocabulary, tag_terms


def value(spark, text, column):
    return spark.createDataFrame([(text,)], "t string").select(column(F.col("t"))).first()[0]


@pytest.mark.parametrize(
    ("word", "want"),
    [("cats", "cat"), ("dogs", "dog"), ("trees", "tree"), ("files", "file"), ("running", "run"), ("coding", "code"), ("programming", "program"), ("coded", "code"), ("jumped", "jump"), ("a", "a"), ("an", "an"), ("the", "the"), ("run", "run"), ("test", "test"), ("state-machines", "state-machin"), ("", "")],
)
def test_stems(word, want):
    assert stem_term(word) == want


def test_stem_udf_keeps_nulls(spark):
    assert [r[0] for r in spark.createDataFrame([("cats",), (None,)], "t string").select(stem("t")).collect()] == ["cat", None]


@pytest.mark.parametrize(("term", "want"), [("HELLO", "hello"), ("test!", "test"), ("hello@world", "helloworld"), ("--test--", "test"), ("state-management", "state-management"), (None, None)])
def test_normal_terms(spark, term, want):
    assert value(spark, term, T.normal_term) == want


def test_plain_forms(spark):
    assert value(spark, " Over__View -x ", N.plain_keyword) == "over-view-x"
    assert value(spark, "##Café -", N.plain_tag) == "café"
    assert value(spark, " # ", N.plain_tag) is None and value(spark, None, N.plain_keyword) is None
    assert value(spark, ".\\a\\b//c.md ", N.path_key) == "a/b/c.md" and value(spark, " SHA256:AB ", N.sha_key) == "ab"


def test_text_functions(spark):
    assert value(spark, "What's New?", T.slug) == "whats-new" and value(spark, "a" * 100, T.slug) == "a" * 50
    assert value(spark, "#web/javascript #123 #v2 #React #h2 #react", T.hashtags) == ["web/javascript", "v2", "react"]
    assert value(spark, "The cat_2 x-ray, CAT", lambda c: T.tokens(c)) == ["the", "cat_2", "ray", "cat"]
    assert value(spark, "x-ray of it", lambda c: T.tokens(c, keep=r"_\-")) == ["x-ray"]
    assert value(spark, "one two three", lambda c: T.ngrams(T.tokens(c), 2)) == ["one two", "two three"]
    assert value(spark, "one", lambda c: T.ngrams(T.tokens(c), 3)) == []
    assert tuple(value(spark, "feat(indexer): add x", T.commit)) == ("feat", "indexer", "add x")
    assert tuple(value(spark, "fix: y", T.commit)) == ("fix", None, "y") and tuple(value(spark, "Merge stuff", T.commit)) == ("other", None, "Merge stuff")
    assert value(spark, "a/b/c-d/e.md", T.loom) == "c-d" and value(spark, "a/b.md", T.loom) == "" and value(spark, "a/b-c", T.segment_title) == "A / B C"
    assert value(spark, 'Sure:\n```json\n{"a": [1]}\n```', T.first_json) == '{"a": [1]}' and value(spark, "none", T.first_json) is None


def test_summary_and_readability_of_odd_texts(spark):
    df = spark.createDataFrame([(1, ""), (2, "short"), (3, "One sentence that is long enough to count. Another one that repeats: sentence long enough enough!  "), (4, "x" * 1000)], "doc_id int, text string")
    s = {r.doc_id: r.summary for r in T.with_summary(df).collect()}
    assert s[1] == "..." and s[2] == "short..." and s[3].startswith("Another one") and s[4] == "x" * 297 + "..."
    r = {x.doc_id: x for x in T.with_readability(df).collect()}
    assert r[1].grade == 0 and r[1].words == 0 and r[3].sentences == 2


def kinds(text):
    return [(b.kind, b.line, b.end) for b in M.segment(text)]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("", []), ("# Heading 1\n\n## Heading 2\n\n### Heading 3", [("heading", 1, 1), ("heading", 3, 3), ("heading", 5, 5)]),
        ("# Heading\n\nParagraph text here.\n\nMore text.", [("heading", 1, 1), ("paragraph", 3, 5)]), ("```js\na\n```\n\n```\nb\n```", [("code", 1, 3), ("code", 5, 7)]), ("**bold** start", [("list", 1, 1)]),
        ("see step 3. now", [("list", 1, 1)]), ("<div>\ntext", [("html", 1, 1), ("paragraph", 2, 2)]), ("|a|\n# H\nx\ny", [("table", 1, 1), ("heading", 2, 2), ("paragraph", 3, 3), ("paragraph", 4, 4)]),
        ("> q\n> r\n\ntext", [("blockquote", 1, 2), ("paragraph", 4, 4)]), ("```\nopen", [("code", 1, 2)]), ("## T\r", [("paragraph", 1, 1)]),
    ],
)
def test_segments(text, want):
    assert kinds(text) == want


def test_block_scores():
    assert M.similarity({"a": 1.0}, {"a": 0.5}) == 1 and M.similarity({"a": 1.0}, {"b": 1.0}) == 0 and M.similarity({}, {"b": 1.0}) == 0
    assert M.weights(["word", "word", "test"]) == {"word": 1.0, "test": 0.5} and M.weights(["constructor", "x"], compat=True) == {"constructor": 0.0, "x": 0.0}
    b = M.segment("# A\n" + "\n".join(f"## h{i}" for i in range(9)))
    assert M.structure(b[0], 0, 10) == 1.0
    s = M.scores(b, "# A")
    assert all(0 <= v <= 1 for x in s for v in x.values())


def test_tag_suggestions():
    t = M.suggest_unified("about #Search and design\n#x", tag_terms(), ["My Tag", "search"])
    assert [x[0] for x in t] == ["search", "x", "design", "my-tag"] and t[0][3] == 1 and t[1][3] == 2
    r = M.suggest_rich("def foo():\n  return python", "code", {"python": "python"}, ["pythons"], ["foo"])
    assert ("python", 0.85, "nlp", None) in r and len(r) <= 5 and r == sorted(r, key=lambda x: -x[1])
    assert M.suggest_rich("  ", "paragraph", {}, [], []) == []
    assert M.distance("kitten", "sitting", 3) == 3 and M.distance("abc", "xyz", 1) == 2


def test_skills(spark):
    text = "```ts\nimport x from 'react-query'\nconst a = require(\"pg\")\n```\nfrom django import y\nkubectl get pods; the team will review"
    assert value(spark, text, K.fence_skills) == ["typescript"]
    assert set(value(spark, text, lambda c: F.transform(K.imported(c), K.package_skill))) >= {"react", "postgresql", "django"}
    assert "kubernetes" in value(spark, text, K.pattern_skills) and value(spark, text, K.soft_skills) == ["collaboration"]


def test_vocabulary_files(tmp_path):
    (tmp_path / "subjects").mkdir()
    (tmp_path / "subjects" / "data.txt").write_text("﻿# comment\nTables rows\n\nrows\n", encoding="utf-8")
    (tmp_path / "stopwords.txt").write_text("the\n", encoding="utf-8")
    v = Vocabulary.load(str(tmp_path))
    assert v.categories["subjects"]["data"] == ("tables", "tabl", "rows", "row") and v.stop_words == ("the",)
    assert Vocabulary.load(str(tmp_path / "none")).stats()["subjects"]["technology"] == 5
    assert [k for k, _, _ in tag_terms({"a": {"b c": ["D"]}})] == ["a", "b-c", "d"]


def test_shipped_vocabulary():
    v = Vocabulary.shipped()
    assert {c: len(n) for c, n in v.categories.items()} == {"difficulty": 4, "skills": 5, "subjects": 8, "topics": 5} and len(v.stop_words) >= 415
    assert sum(len(t) for n in v.categories.values() for t in n.values()) > 2300 and v.categories["difficulty"]["expert"][0] == "expert"
