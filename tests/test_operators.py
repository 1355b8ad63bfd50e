import datetime as dt

import pytest
from pyspark.sql import functions as F

from corpusmill.functions import text as T
from corpusmill.operators import activity as A, blocks as B, classify as C, corpus_stats as S, incremental as I, model_calls as L, quality as Q, skew, snapshots as P
from corpusmill.sources import corpus as R
from corpusmill.streaming import daily

UTC = dt.timezone.utc


def at(day, hour=0):
    return dt.datetime(2025, 3, day, hour, tzinfo=UTC)


def ms(day, hour=0):
    return int(at(day, hour).timestamp() * 1000)


def frames(spark, files, runs, scan):
    return (
        spark.createDataFrame(files, "path string, sha string, mtime bigint, indexed_at bigint, key string, day int"),
        spark.createDataFrame(runs, "run_id bigint, started_at timestamp, status string, start int"),
        spark.createDataFrame(scan, "path string, sha string, mtime bigint, seen_at timestamp, stored string"),
    )


RUNS = [(1, at(1), "ok", 0), (2, at(2), "failed", 0), (3, at(3), "ok", 0), (4, None, "ok", 0), (5, at(9), None, 0)]


def test_changes(spark):
    files = [
        ("a", "s1", 1, ms(1, 1)), ("a", "s2", 2, ms(2, 1)), ("b", "s1", 1, ms(3, 1)), ("b", "s0", 1, ms(1, 1)), ("c", "s1", 1, ms(1, 2)), ("d", "s1", 1, ms(1, 2)), ("e", None, 1, ms(1, 2)), ("f", "s", 1, ms(1) - 1),
        ("g", "s", 1, ms(1)), ("h", "s", 1, ms(9, 1)), (None, "s", 1, ms(1)), ("i", "s", 1, None), ("a", "s1", 1, ms(1, 1)), ("café", "s", 1, ms(1, 2)),
    ]
    scan = [
        ("./a", "SHA256:S1", 1, at(10)), ("b", "s2", 1, at(11)), ("b", "s1", 1, at(10)), ("c", None, None, at(10)), ("e", "s9", 1, at(10)), ("f", "s", 1, at(10)), ("g\\x", "s", 1, at(10)), ("h", "s", 1, None),
        (None, "s", 1, at(10)), ("n", None, 1, at(10)), ("café", "s", 1, at(10)), ("b", None, 3, at(12)),
    ]
    got = {r.path: r.change_kind for r in I.changes(*frames(spark, [(*f, "k", 1) for f in files], RUNS, [(*s, "x") for s in scan])).collect()}
    assert got == {"b": "modified", "d": "deleted", "e": "modified", "f": "added", "g": "deleted", "g/x": "added", "h": "added"}


def test_changes_of_empty_tables(spark):
    f, r, s = frames(spark, [("a", "s", 1, ms(1, 1), "k", 1)], RUNS, [("b", "s", 1, at(4), "x")])
    none = lambda d: d.where("false")
    assert I.changes(none(f), none(r), none(s)).count() == 0
    assert [tuple(x)[:2] for x in I.changes(none(f), r, s).collect()] == [("b", "added")] and [tuple(x)[:2] for x in I.changes(f, r, none(s)).collect()] == [("a", "deleted")]
    assert [tuple(x)[:2] for x in I.changes(f, none(r), none(s)).collect()] == []


def test_versioned_target_survives_failures(spark, tmp_path):
    t = I.VersionedTarget(spark, f"file://{tmp_path}/target", "id", ["sha"])
    source = lambda rows: spark.createDataFrame(rows, "id string, sha string")
    seen = []

    def work(d):
        seen.append(sorted(r.id for r in d.collect()))
        return d.withColumn("out", F.upper("id"))

    assert t.read() is None
    t.run(source([("a", "1"), ("b", "1"), ("n", None), (None, "1")]), work)
    before = t.versions()
    with pytest.raises(Exception, match="lost"):
        t.run(source([("a", "2"), ("b", "1"), ("c", "1")]), lambda d: d.withColumn("out", F.raise_error(F.lit("lost"))))
    assert t.versions() == before and t.read().count() == 3

    def crash():
        raise InterruptedError

    with pytest.raises(InterruptedError):
        t.run(source([("a", "2"), ("b", "1"), ("c", "1"), ("n", None)]), lambda d: d.withColumn("out", F.upper("id")), crash)
    assert t.versions() == before and t.read().count() == 3
    folders = t._folders(before[-1])
    t.run(source([("a", "2"), ("b", "1"), ("c", "1"), ("n", None)]), work)
    assert seen == [["a", "b", "n"], ["a", "c"]]
    assert sorted((r.id, r.sha or "", r.out) for r in t.read().collect()) == [("a", "2", "A"), ("b", "1", "B"), ("c", "1", "C"), ("n", "", "N")]
    # Only the buckets of a and c were written anew, and a run without changes publishes nothing.
    changed = {b for b, f in t._folders(2).items() if folders.get(b) != f}
    assert t.versions() == [1, 2] and len(changed) <= 2 and len(folders) == 3
    assert t.run(source([("a", "2"), ("b", "1"), ("c", "1"), ("n", None)]), work) == 2 and t.versions() == [1, 2]
    # A run that another one overtook is refused.
    with pytest.raises(I.ConcurrentRun):
        t.run(source([("a", "3"), ("b", "1")]), lambda d: d.withColumn("out", F.upper("id")), lambda: t.run(source([("b", "1")]), work))
    assert t.versions() == [1, 2, 3] and [r.id for r in t.read().collect()] == ["b"]
    assert t.vacuum(1) >= 2 and t.versions() == [3] and [r.id for r in t.read().collect()] == ["b"]
    t.run(source([]), work)
    assert t.read() is None and sorted(r.id for r in t.pending(source([("z", "1")])).collect()) == ["z"]


def test_skewed_lookup(spark):
    rows = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(300)] + [(999, None)], "id int, key string")
    counts = rows.where("key is not null").groupBy("key").agg(F.count("*").alias("n"))
    got = skew.lookup(rows, counts, "key", "n", 300, F.col("id"), share=0.1).collect()
    assert len(got) == 301 and {r.n for r in got if r.key == "hot"} == {200} and {r.n for r in got if r.key not in ("hot", None)} == {1} and [r.n for r in got if r.key is None] == [None]


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def test_statistics(spark):
    d = docs(spark, [(1, "apple pie apple"), (2, "pie chart"), (3, "")])
    w = T.tokens(F.col("text"))
    top = {(r.doc_id, r.rank): r.term for r in S.keywords_tfidf(d, w).collect()}
    assert top[1, 1] == "apple" and top[2, 1] == "chart"
    assert [(r.doc_id, r.rank) for r in S.bm25(d, w, ["pie", "chart"]).collect()] == [(2, 1), (1, 2)] and S.bm25(d, w, ["zzz"]).count() == 0
    assert S.bm25(d.where("false"), w, ["pie"]).count() == 0
    assert {r.phrase for r in S.repeated_phrases(docs(spark, [(1, "red car red car blue")]), w, 2).collect()} == {"red car"}
    p = {r.term: [tuple(x) for x in r.list] for r in S.postings(d, w).collect()}
    assert p["pie"] == [(1, 1), (2, 1)] and p["apple"] == [(1, 2)]
    v = S.max_normalised(d, w)
    assert {(r.doc_id, round(r.cosine, 6)) for r in S.cosine(v, v, ["doc_id"]).collect()} == {(1, 1.0), (2, 1.0)}


def test_nearest_vectors(spark):
    e = spark.createDataFrame([(1, [1.0, 0.0]), (2, [2.0, 0.1]), (3, [0.0, 5.0]), (4, [0.0, 0.0])], "vec_id bigint, embedding array<float>")
    got = S.nearest(e, e.where("vec_id = 1"), 2).collect()
    assert [r.vec_id for r in sorted(got, key=lambda r: r.rank)] == [2, 3]


def test_blocks_and_index(spark):
    d = spark.createDataFrame([(1, "# Search API\n\ntext #x about metadata\n\n```py\nimport a\n```", ["t"]), (2, None, None), (3, "", [])], "doc_id bigint, text string, tags array<string>")
    b = B.blocks(d)
    assert [(r.type, r.id) for r in b.orderBy("place").collect()] == [("heading", "search-api"), ("paragraph", "block-3"), ("code", "block-5")]
    t = B.block_tags(b)
    s = B.block_stats(b, t).first()
    assert s.documents == 1 and s.blocks == 3 and s.confirmed == t.where("confirmed").count()
    assert {r.tag for r in B.tag_index(t).collect()} >= {"search", "api", "t"}
    assert B.blocks(d, tagger="rich").count() == 3 and B.blocks(d.where("false")).count() == 0


def test_classification(spark):
    from corpusmill.functions.vocabulary import Vocabulary

    d = docs(spark, [(1, "Software and api research, a basic intro"), (2, "")]).withColumn("title", F.lit(None).cast("string"))
    m = {(r.doc_id, r.name): r.confidence for r in C.matches(d, Vocabulary(), "subjects").collect()}
    assert m == {(1, "technology"): 0.4, (1, "science"): 0.2}
    assert {r.doc_id: r.difficulty for r in C.difficulty(d, Vocabulary()).collect()} == {1: "beginner", 2: "intermediate"}
    f = lambda t, w: docs(spark, [(1, t)]).select(C.context_factor(F.col("text"), w)).first()[0]
    assert f("the public library", "library") == 0.3 and f("npm install library code", "library") == 2.0 and f("none", "library") == 1.0
    assert {(r.category, r.name) for r in C.stem_classify(d, Vocabulary()).where("doc_id = 1").collect()} >= {("subjects", "technology"), ("difficulty", "beginner")}
    tags = spark.createDataFrame([(1, "Softwares"), (1, "zzz")], "doc_id bigint, tag string")
    assert [(r.tag, r.tokens) for r in C.fuzzy_tags(d, tags).collect()] == [("Softwares", 1)]


def test_stem_classification_levels(spark):
    from corpusmill.functions.vocabulary import Vocabulary

    def scores(text, vocabulary):
        return {(r.category, r.name): (r.score, r.confidence) for r in C.stem_classify(docs(spark, [(1, text)]), vocabulary).collect()}

    built_in = Vocabulary()
    assert scores("Documentation", built_in)["subjects", "knowledge"] == (1.0, 0.1)
    # As two words for one subject; one of the words speaks for another.
    both = scores("machine learning", built_in)
    assert both["subjects", "ai"] == (2.0, 0.2) and both["subjects", "knowledge"][0] == 1.5  # `machine` is near
    # A file's terms and their stems are terms of their own.
    own = Vocabulary({"subjects": {"x": ("documentation", "document")}, "topics": {"y": ("machine-learning", "machin-learn")}, "skills": {"tools": ("docker", "hands-on")}, "difficulty": built_in.categories["difficulty"]})
    assert scores("documentation", own)["subjects", "x"][0] == 2.0
    assert scores("machine learning", own)["topics", "y"] == (3.5 * 1.0, pytest.approx(3.5 / 6))
    assert scores("learning by machines", own)["topics", "y"][0] == 3.0  # all parts apart, of the term and of its stem
    got = scores("Docker hands-on basic simple", own)
    assert got["skills", "docker"] == (1.0, pytest.approx(1 / 3)) and got["skills", "hands-on"][0] == 1.0 and got["difficulty", "beginner"] == (2.0, None)
    assert scores("", own) == {("difficulty", "intermediate"): (0.0, None)}
    # A hyphenated subject does not count as one word, a topic does; three words weigh most.
    hyphen = Vocabulary({"subjects": {"s": ("deep-learning",)}, "topics": {"t": ("deep-learning", "state-of-art")}})
    assert scores("deep-learning", hyphen) == {("topics", "t"): (1.0, pytest.approx(1 / 6)), ("difficulty", "intermediate"): (0.0, None)}
    assert scores("state of art", hyphen)["topics", "t"][0] == 3.0


def test_hits_with_and_without_the_automaton(spark, monkeypatch):
    from corpusmill.functions.vocabulary import Vocabulary

    d = docs(spark, [(1, "A TUTORIAL on api design and software"), (2, ""), (3, None)])
    v = Vocabulary({"a": {"x": ("api", "tutorial", "none"), "y": ()}, "b": {"z": ("soft", "api")}})
    want = {1: [[0, 1], [], [0, 1]], 2: [[], [], []], 3: [[], [], []]}
    assert {r.doc_id: r.hits for r in C.with_hits(d, v).collect()} == want

    def missing(v):
        raise ImportError

    monkeypatch.setattr(C, "hits", missing)
    assert {r.doc_id: r.hits for r in C.with_hits(d, v).collect()} == want


def test_folder_scores(spark):
    d = spark.createDataFrame([(1, "Stars and stars", "Star chart", ["starlight", None]), (2, "nothing", None, None), (3, "cart", "x", [])], "doc_id bigint, text string, title string, tags array<string>")
    got = {(r.doc_id, r.folder): (round(r.score, 4), r.rank, r.confidence) for r in C.folder_scores(d, {"sky": ["stars", "star"], "art": ["art"]}, "rest", "tags").collect()}
    # `stars` twice as a token, `star` twice but as no token; title and tag hold `star` alone.
    assert got == {(1, "sky"): (round(4 * C.SINGLE + 8, 4), 1, 0.75), (2, "rest"): (0.0, 1, 0.3), (3, "rest"): (0.0, 1, 0.3)}


def test_improvements_from_an_analysis(spark):
    d = spark.createDataFrame([("i", "1", ["t"], "r", "d", ["k"], ["ai"], ["x", "y"], "expert", ["p q"]), (None, None, None, None, None, ["k1", "k2"], [], [], "beginner", [])], "id string, version string, tags array<string>, relationships string, difficulty string, keywords array<string>, subjects array<string>, topics array<string>, level string, phrases array<string>")
    got = [r.suggestions for r in Q.improvements(d).collect()]
    assert got == [["Auto-detected subjects: ai", "Auto-detected topics: x, y", "Key phrases found: p q"], ["Add unique ID", "Add version number", "Consider adding tags: k1, k2", "Consider adding relationships", "Auto-detected subjects: ", "Auto-detected topics: ", "Suggested difficulty: beginner"]]


def test_quality_rules(spark):
    d = spark.createDataFrame([("a/x.md", None, "short", "TODO: x"), ("a/wiki/y.md", "ok title", "s" * 301, "lorem ipsum " * 20)], "path string, title string, summary string, content string")
    r = {x.path: (x.errors, x.warnings) for x in Q.content_rules(d).collect()}
    assert r["a/x.md"] == (["Missing required field: title", "Contains TODO comments"], ["Summary too short (< 20 chars)", "Content very short (< 100 chars)"])
    assert r["a/wiki/y.md"] == ([], ["Summary too long (> 300 chars)"])
    rep = Q.report(Q.content_rules(d)).first()
    assert tuple(rep) == (2, 1, 2, 3)
    t = spark.createDataFrame([("b", "X y"), ("a", "x-Y"), ("c", None), ("d", ""), ("a", "x-Y")], "path string, title string")
    assert [tuple(x) for x in Q.repeats(t, Q.title_key()).collect()] == [("b", "xy", "a")]


def test_education_rules(spark):
    rows = [
        '{"learningDesign": {"objectives": [{"bloomsLevel": "apply"}, {"description": "x", "bloomsLevel": "guess"}]}, "assessments": {"summative": [{"id": 1, "type": "t", "weight": 2, "passingScore": 50}]}}',
        '{"timeEstimates": {"reading": 10, "exercises": 5, "total": 30}, "accessibility": {"wcagLevel": "AA", "features": ["captions", "odd"]}, "modalities": {"text": "yes"}}', None, "broken",
    ]
    got = [tuple(r) for r in Q.education_rules(spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "i int, metadata string")).orderBy("i").select("errors", "warnings", "suggestions").collect()]
    assert got[0][0] == ["learningDesign.objectives: missing description", "learningDesign.objectives[*].bloomsLevel: not allowed", "assessments.summative[*].weight must be between 0 and 1"]
    assert got[1][0] == ["modalities.text must be boolean"] and got[1][1] == ["timeEstimates.total does not match its parts", "accessibility.features[*]: unknown"]
    assert got[2] == got[3] == ([], [], ["Consider adding educational fields"])


def test_json_schema(spark):
    s = {"type": "object", "required": ["a"], "properties": {"a": {"type": "number", "minimum": 1, "maximum": 3}, "b": {"type": "string", "enum": ["x"]}}}
    d = spark.createDataFrame([(1, '{"a": 2, "b": "x"}'), (2, '{"a": 9, "b": "y"}'), (3, "[1]"), (4, "no"), (5, None), (6, '{"a": "s"}')], "i int, j string")
    got = {r.i: r.e for r in d.select("i", Q.schema_errors(F.col("j"), s).alias("e")).collect()}
    assert got[1] == [] and got[2] == ["a: above 3", "b: not allowed"] and "expected object" in got[3] and got[4] == got[5] == ["not JSON"] and "a: expected number" in got[6]


def test_snapshots(spark):
    f = lambda rows: spark.createDataFrame(rows, "k int, v string")
    old, new = f([(1, "a"), (2, None), (3, "c")]), f([(1, "b"), (2, None), (4, "d")])
    diff = P.difference(old, new, "k", ["v"])
    assert {r.k: r.change for r in diff.collect()} == {1: "modified", 2: "unchanged", 3: "deleted", 4: "added"}
    assert {(r.k, r.v) for r in P.upsert(old, new, "k").collect()} == {(1, "b"), (2, None), (3, "c"), (4, "d")}
    assert {r.k for r in P.delete(old, diff.where("change = 'deleted'"), "k").collect()} == {1, 2}
    assert P.hit_rate(diff).first().rate == pytest.approx(1 / 3) and P.hit_rate(diff.where("false")).first().rate == 0
    assert {r.k for r in P.orphans(old, new.withColumnRenamed("k", "p"), "k", "p").collect()} == {3}


def test_activity_log_is_not_repeated(spark, tmp_path):
    e = spark.createDataFrame([(at(1, 1), "a"), (at(1, 2), "a"), (at(2), "b"), (None, "a")], "ts timestamp, event_type string")
    days = A.daily(e).select("date", "type", "n")
    out = f"file://{tmp_path}/log"
    assert A.append_months(days, out) == 2 and A.append_months(days, out) == 0
    late = spark.createDataFrame([(at(1).date(), "c", 1)], "date date, type string, n bigint")
    assert A.append_months(late, out) == 1 and spark.read.json(out).count() == 3


def test_streams(spark, tmp_path):
    src = tmp_path / "in"
    for i, part in enumerate([[(at(1, 1), "a"), (at(2), "b")], [(at(1, 3), "a"), (at(9), "a")]]):
        spark.createDataFrame(part, "ts timestamp, event_type string").coalesce(1).write.parquet(str(tmp_path / f"t{i}"))
        src.mkdir(exist_ok=True)
        next((tmp_path / f"t{i}").glob("*.parquet")).rename(src / f"events{i}.parquet")
    stream = spark.readStream.schema("ts timestamp, event_type string").parquet(str(src))
    out = f"file://{tmp_path}/log"
    for _ in range(2):
        daily.append_stream(stream, out, f"{tmp_path}/cp").awaitTermination()
    assert {(r.type, r.n) for r in spark.read.json(out).collect()} == {("a", 2), ("b", 1)}


def test_corpus_files(spark, tmp_path):
    for name, text in {"a/x.md": "---\ntitle: T\ntags: [q]\n---\nBody", "b.yaml": "k: 1", ".git/c.md": "no", "node_modules/d.md": "no", "e.txt": "no", "f.md": "plain", "g.md": "---\nbad: [\n---\nB"}.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text)
    assert {r.path for r in R.read_files(spark, str(tmp_path)).collect()} == {"a/x.md", "b.yaml", "f.md", "g.md"}
    got = {r.path: (r.metadata, r.text) for r in R.read_strands(spark, str(tmp_path)).collect()}
    pytest.importorskip("yaml")
    assert got == {"a/x.md": ('{"title": "T", "tags": ["q"]}', "Body"), "f.md": (None, "plain"), "g.md": (None, "B")}


def test_header_is_replaced_and_files_written(spark, tmp_path):
    d = spark.createDataFrame([("a/x.md", "---\nid: 1\n---\nBody\n", '{"id": 2}'), ("y.md", "plain", None), (None, "t", None)], "path string, text string, metadata string")
    assert [r[0] for r in d.where("path is not null").select(R.header_kept(F.col("text"))).collect()] == ["id: 1", None]
    out = d.select("path", R.with_header(F.col("text"), F.col("metadata")).alias("text"))
    for _ in range(2):
        R.write_files(out, f"file://{tmp_path}/out")
    pytest.importorskip("yaml")
    assert {(r.path, r.metadata, r.text) for r in R.read_strands(spark, f"{tmp_path}/out").collect()} == {("a/x.md", '{"id": 2}', "Body\n"), ("y.md", None, "plain")}
    with pytest.raises(Exception, match="leaves"):
        R.write_files(spark.createDataFrame([("../x", "t")], "path string, text string"), str(tmp_path / "out"))


def test_file_messages(spark):
    pytest.importorskip("yaml")
    files = {
        "w/weave.yaml": "slug: Bad Slug\ntitle: T", "w/l/loom.yaml": "slug: l\ntitle: T\nsummary: S", "w/l/other.yaml": "a: [", "w/l/bad.md": "---\nx: [\n---\n" + "b" * 200, "w/l/ok.md": "---\nid: 6f1c9a52-3c0e-4c1b-9a77-0d6a5b1f2e3d\nslug: s\ntitle: T\nversion: 1.0\n---\n" + "b" * 200,
        "w/l/plain.md": "todo: x", "n.txt": "x",
    }
    d = spark.createDataFrame([*files.items(), (None, "x")], "path string, text string")
    got = {}
    for r in Q.file_messages(d).collect():
        got.setdefault(r.path, set()).add((r.kind[0], r.message))
    need = {("e", f"Missing required field '{c}'") for c in ("id", "slug", "title")}
    assert got == {
        "w/weave.yaml": {("e", "Slug must be lowercase alphanumeric with hyphens")}, "w/l/other.yaml": {("e", "Cannot be parsed")}, "w/l/bad.md": {("e", "Cannot be parsed")},
        "w/l/ok.md": {("w", "Version should follow semver format (x.y.z)")}, "w/l/plain.md": need | {("w", "Content is very short (< 100 characters)"), ("w", "Contains TODO/FIXME comments")},
    }


def test_documents_and_cache_are_read_back(spark, tmp_path):
    d = spark.createDataFrame([("a", 1, 0.5, ["x"]), (None, None, None, None)], "path string, mtime bigint, score double, tags array<string>")
    R.write_cache(d, str(tmp_path / "c.db"), "files")
    R.write_cache(d, str(tmp_path / "c.db"), "files")
    assert {tuple(r) for r in R.read_cache(spark, str(tmp_path / "c.db"), "files").collect()} == {("a", 1, 0.5, '["x"]'), (None, None, None, None)}
    R.write_document(d, f"{tmp_path}/i.json", version="1")
    import json

    doc = json.loads((tmp_path / "i.json").read_text())
    assert doc["version"] == "1" and len(doc["entries"]) == 2 and {"path": "a", "mtime": 1, "score": 0.5, "tags": ["x"]} in doc["entries"]


def test_related_and_synonyms(spark):
    t = spark.createDataFrame([("a", "x"), ("b", "x"), ("a", "y"), ("b", "y"), ("c", "y"), ("c", None)], "loom string, tag string")
    assert [tuple(r) for r in S.related(t).collect()] == [("a", "b", 2)] and S.related(t, 1).count() == 3
    from corpusmill.functions.markdown import suggest_rich

    got = suggest_rich("retrieval of llm output", "paragraph", {"retrieval": "retrieval"}, [], [], {"llm": "language-model"})
    assert ("retrieval", 0.85, "nlp", None) in got and ("language-model", 0.7, "nlp", None) in got


def test_template_is_read_back(spark):
    pytest.importorskip("yaml")
    d = spark.createDataFrame([(R.strand_template('A "new" page', "x-1"),)], "text string").select(R.yaml_json(R.front_matter(F.col("text"))).alias("m"), R.body(F.col("text")).alias("b")).first()
    assert '"slug": "a-new-page"' in d.m and '"id": "x-1"' in d.m and d.b.strip() == '# A "new" page'


def test_json_index_and_commits(spark, tmp_path):
    (tmp_path / "ok.json").write_text('[{"a": 1}]')
    (tmp_path / "empty.json").write_text("[]")
    assert R.read_index(spark, str(tmp_path / "ok.json")).count() == 1
    for bad in ("empty.json", "missing.json"):
        with pytest.raises(ValueError):
            R.read_index(spark, str(tmp_path / bad))
    (tmp_path / "log").write_text("1\0a\0e\0d\0feat: x\0line\nline\0\x1e\n2\0a\0e\0d\0fix: y\0\0\x1e")
    assert [(r.sha, r.subject, r.body) for r in R.read_commits(spark, str(tmp_path / "log")).orderBy("sha").collect()] == [("1", "feat: x", "line\nline"), ("2", "fix: y", "")]


def test_sqlite_cache(spark, tmp_path):
    import sqlite3

    db = sqlite3.connect(tmp_path / "c.db")
    db.execute("create table files (path text, mtime integer, score real)")
    db.execute("insert into files values ('a', 1, 0.5), (null, null, null)")
    db.commit()
    db.close()
    assert {tuple(r) for r in R.read_cache(spark, str(tmp_path / "c.db"), "files").collect()} == {("a", 1, 0.5), (None, None, None)}


def test_model_calls(spark):
    calls = iter(["no json", '```json\n{"tags": 1}\n```', '{"tags": []}'])
    waits = []
    assert L.ask("p", lambda _: next(calls), L.SCHEMAS["tags"], sleep=waits.append) == ('{"tags": []}', None, 3) and len(waits) == 2
    assert L.ask("p", lambda _: 1 / 0, sleep=waits.append)[1] == "division by zero"
    assert 0.5 <= L.wait(0) <= 1 and 8 <= L.wait(9) <= 16
    p = spark.createDataFrame([(1, "search engines search"), (2, None)], "id bigint, prompt string")
    got = {r.id: (r.answer, r.error) for r in L.answers(p).collect()}
    assert '"search"' in got[1][0] and got[2] == (None, "no prompt")
    b = spark.createDataFrame([(d, i, 1.0) for d in (1, 20_000) for i in range(3)], "doc_id bigint, place int, c double")
    assert {(r.doc_id, r.place) for r in L.within_budget(b, F.col("c"), 4.0).collect()} == {(1, 0), (1, 1), (1, 2), (20_000, 0)}
    s = "doc_id bigint, place int, score double, tags array<struct<tag: string, confidence: double, source: string, line: int>>"
    old = spark.createDataFrame([(1, 0, 0.9, [("a", 0.9, "nlp", None), ("b", 0.5, "nlp", None), ("c", 0.9, "nlp", None)]), (1, 1, 0.1, [("z", 0.1, "nlp", None)])], s)
    rep = spark.createDataFrame([(1, 0, [("A", 0.8), ("d", 0.6)], ["c"]), (1, 1, [("y", 1.0)], [])], "doc_id bigint, place int, added array<struct<tag: string, confidence: double>>, removed array<string>")
    assert {r.place: [t.tag for t in r.tags] for r in L.enhanced(old, rep).collect()} == {0: ["a", "d"], 1: ["z"]}
