import math
from collections import Counter, defaultdict

from corpusmill.llm.cooccurrence import cooccurrence
from corpusmill.llm.distinctiveness import term_scores, top_keyword
from corpusmill.llm.term_counts import dictionary, term_counts

# Columns that no operator asks for, named as their inner ones.
KEYWORDS = "file_path string, keyword string, tfidf_score double, frequency int, term string, n int, slot int"


def keywords(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], KEYWORDS)


ROWS = [
    ("a", "Over View", 0.1, 2), ("a", "over_view", 0.2, 3), ("a", "over-view", 0.2, 3), ("a", "over-view", 0.2, 3), ("a", "café", 0.1, 1), ("b", "café", 0.1, None), ("b", None, 0.1, 4),
    ("b", "  ", 0.1, 4), (None, "lost", 0.1, 4), ("c", "zeta", None, 5), ("c", "alpha", None, 5),
]


def test_counts_merge_spellings_and_drop_repeats(spark):
    got = {r.keyword: (r.occurrences, r.files, r.mark) for r in term_counts(keywords(spark, ROWS)).collect()}
    # one twentieth of three files is less than one file, but rare wins
    assert got == {"over-view": (8, 1, "rare"), "café": (2, 2, "rare"), "zeta": (5, 1, "rare"), "alpha": (5, 1, "rare")}


def test_counts_mark_common(spark):
    rows = [(f"f{i}", "everywhere", 0.1, 1) for i in range(100)] + [(f"f{i}", "some", 0.1, 1) for i in range(5)] + [(f"f{i}", "more", 0.1, 1) for i in range(6)] + [("f1", "few", 0.1, 1)]
    got = {r.keyword: r.mark for r in term_counts(keywords(spark, rows)).collect()}
    assert got == {"everywhere": "common", "some": None, "more": "common", "few": "rare"}


def test_counts_by_range_of_identifiers(spark, monkeypatch):
    """Several ranges, arrays sent on early, and the dictionary by shuffle as well as by broadcast."""
    from corpusmill.llm import term_counts as tc

    rows = [(f"f{i % 70}", f"w{i % 190}" if i % 3 else "hot", 0.1, i % 4 or None) for i in range(1500)]
    f = defaultdict(Counter)
    for p, k, _, n in set(rows):
        f[k][p] += n or 1
    want = {k: (sum(c.values()), len(c)) for k, c in f.items()}
    monkeypatch.setattr(tc, "BLOCK", 16)
    monkeypatch.setattr(tc, "HELD", 2)
    for most in (10, 10_000):
        monkeypatch.setattr(tc, "BROADCAST_TERMS", most)
        got = term_counts(keywords(spark, rows)).collect()
        assert {r.keyword: (r.occurrences, r.files) for r in got} == want and sorted(r.id for r in got) == list(range(len(want)))


def test_dictionary_is_dense(spark):
    terms = spark.createDataFrame([(f"t{i}",) for i in range(500)], "term string")
    ids = sorted(r.id for r in dictionary(terms, 7).collect())
    assert ids == list(range(500))


def test_empty_tables(spark):
    empty = keywords(spark, [])
    assert term_counts(empty).count() == 0 and top_keyword(term_scores(empty)).count() == 0
    assert cooccurrence(spark.createDataFrame([], "path string, tags array<string>")).count() == 0


def test_top_keyword_against_loop(spark):
    rows = [(f"f{i % 40}", f"w{(i * i) % 23}", 0.1, i % 5 or None) for i in range(900)] + [(f"f{i}", "hot", 0.5, 9) for i in range(40)]
    seen = set(rows)
    f = defaultdict(Counter)
    for p, k, _, n in seen:
        f[p][k] += n or 1
    files = Counter(k for c in f.values() for k in c)
    want = {p: min(c, key=lambda k: (-round(c[k] * math.log(len(f) / files[k]), 9), k)) for p, c in f.items()}
    assert {r.file_path: r.keyword for r in top_keyword(term_scores(keywords(spark, rows), alpha=0, presence=True)).collect()} == want
    scores = term_scores(keywords(spark, rows))
    ppmi = {(r.file_path, r.keyword): r.ppmi for r in scores.collect()}
    total = sum(sum(c.values()) for c in f.values())
    smooth = sum(sum(c.values()) ** 0.75 for c in f.values())
    for (p, k), v in ppmi.items():
        t = sum(c[k] for c in f.values())
        d = sum(f[p].values())
        assert abs(v - max(0, math.log(f[p][k] / total / (t / total * d**0.75 / smooth)))) < 1e-9


def test_ties_take_the_first_keyword(spark):
    got = top_keyword(term_scores(alpha=0, presence=True, keywords=keywords(spark, [("a", "z", 0.1, 1), ("a", "b", 0.1, 1), ("c", "x", 0.1, 1)]))).collect()
    assert {r.file_path: r.keyword for r in got} == {"a": "b", "c": "x"}


def test_cooccurrence_against_loop(spark):
    rows = [(f"p{i}", [f"t{i % 7}", f" #T{i % 7} ", f"t{(i % 7) + 10}", None, " ", f"u{i % 3}"], 1, "b") for i in range(210)]
    df = spark.createDataFrame([*rows, rows[0], ("p1", None, 1, "b"), (None, ["t1", "t11"], 1, "b")], "path string, tags array<string>, n_ab int, b string")
    baskets = [{"t%d" % (i % 7), "t%d" % ((i % 7) + 10), "u%d" % (i % 3)} for i in range(210)]
    c, ab = Counter(x for b in baskets for x in b), Counter((x, y) for b in baskets for x in b for y in b if x < y)
    want = {k for k, n in ab.items() if n >= 5 and n / 210 >= 0.002 and n * 210 / (c[k[0]] * c[k[1]]) >= 4}
    got = {(r.tag_a, r.tag_b): r for r in cooccurrence(df).collect()}
    assert set(got) == want and want
    assert all(r.n == 210 and r.n_ab == ab[k] and r.llr > 3.841 for k, r in got.items())


def test_canonical_meets_long_segments_of_many_sizes(spark, monkeypatch):
    from corpusmill.llm import canonical

    known = canonical.bounded
    monkeypatch.setattr(canonical, "bounded", lambda df, rows: rows != 500 and known(df, rows))
    long = "".join("abcdefghij"[i * i % 7 + i % 3] for i in range(300))
    refs = spark.createDataFrame([(long, [])], "tag string, aliases array<string>")
    values = spark.createDataFrame([(long[:150] + "z" + long[150:],)], "raw_tag string")
    assert canonical.canonical_values(values, refs).first().tag == long
