import random
import re
import unicodedata
from collections import Counter

import pytest

from corpusmill.llm import bpe, leakage, shared_spans as ss

DOCS = "doc_id bigint, text string, tid int, pos int, h int, key string"


def docs(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, "k") for r in rows], DOCS)


@pytest.fixture(scope="module")
def reference_encoder():
    tiktoken = pytest.importorskip("tiktoken")
    return tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=bpe.read_ranks(), special_tokens={})


def test_bpe_equals_a_known_encoder(spark, reference_encoder):
    rng = random.Random(1)
    texts = ["", "a", " ", "\n\n  x", "<|endoftext|> plain", "café \U0001f469‍\U0001f52c 知识", "don't we'll", "aaaa" * 3000, "".join(rng.choice("etaoin shrdlu\n.,'19") for _ in range(5000))]
    got = {r.doc_id: list(r.ids) for r in bpe.token_ids(docs(spark, [*enumerate(texts), (99, None)])).collect()}
    assert got.pop(99) == []
    assert got == {i: reference_encoder.encode_ordinary(t) for i, t in enumerate(texts)}


def test_bpe_round_trip_and_types(spark):
    ranks = {i: t for t, i in bpe.read_ranks().items()}
    df = bpe.token_ids(docs(spark, [(1, "Résumé ﻿ x")]))
    assert dict(df.dtypes)["ids"] == "array<int>"
    assert b"".join(ranks[i] for i in df.first().ids).decode() == "Résumé ﻿ x"
    assert bpe.token_ids(docs(spark, [])).count() == 0


def test_merge_takes_the_leftmost_of_equal_ranks():
    ranks = {bytes([i]): i for i in range(256)} | {b"aa": 300, b"aaa": 301}
    assert bpe.merge(b"aaaaa", ranks) == [300, 301] and bpe.merge(b"aaaa", ranks) == [300, 300]


ITEM = "The bright farmer from Mumafan repairs 52 heavy bricks near the bakery while a tired miller counts 9 ropes by the frozen quarry"


def words(t):
    return re.findall(r"[^\W_]+", unicodedata.normalize("NFKC", t).casefold())


def found(spark, rows, items=((7, ITEM),), **more):
    i = spark.createDataFrame([(k, p, "pos") for k, p in items], "item_id bigint, passage string, doc_id string")
    return {(r.doc_id, r.item_id): r for r in leakage.leaks(docs(spark, rows), i, **more).collect()}


def test_leakage_cases(spark):
    w = ITEM.split()
    rows = [
        (1, "x " + " ".join(w[3:15]) + " y"), (2, " ".join(w[:11])), (3, "// " + "\n// ".join(w[:14]).upper()), (4, "**" + "_ _".join(w[:13]) + "**"),
        (5, " ".join(w[:13]).replace("52", "５２").replace("fi", "ﬁ").replace(" ", " ")), (6, " ".join(reversed(w))), (7, " ".join(w[:6] + ["no"] + w[6:])), (8, None), (9, ""),
        (10, "filler " * 50_000 + ITEM), (11, ITEM), (11, ITEM), (None, ITEM),
    ]
    got = found(spark, rows, [(7, ITEM), (7, ITEM), (8, "too short"), (9, None)])
    assert set(got) == {(d, 7) for d in (1, 3, 4, 5, 7, 10, 11)}
    assert got[1, 7].longest == 12 and got[11, 7].longest == got[11, 7].words == len(w)


def test_leakage_against_loop(spark):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(12)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(20))) for i in range(12)]
    rows = []
    for d in range(120):
        t = [rng.choice(vocab) for _ in range(rng.randrange(40))]
        p = rng.choice(items)[1].split()
        a = rng.randrange(10)
        rows.append((d, " ".join(t + p[a : a + rng.randrange(4, 20)] + t)))
    grams = lambda t: {tuple(t[i : i + 6]) for i in range(len(t) - 5)}
    want = {(d, i) for d, t in rows for i, p in items if grams(words(t)) & grams(words(p))}
    assert set(found(spark, rows, items, run=6)) == want and len(want) > 20


def test_leakage_by_shuffle_and_proximity(spark, monkeypatch):
    items = [(i, " ".join(f"v{i}x{j}" for j in range(14))) for i in range(5)]
    broken = items[2][1].split()
    rows = [(i, p) for i, p in items] + [(50, " ".join(broken[:12] + ["extra"] + broken[12:]))]
    for most in (leakage.BROADCAST_ROWS, 1):
        monkeypatch.setattr(leakage, "BROADCAST_ROWS", most)
        monkeypatch.setattr(leakage, "BROADCAST_WORDS", most)
        got = found(spark, rows, items, slop=1)
        assert set(got) == {(i, i) for i in range(5)} | {(50, 2)}
        assert got[50, 2].longest == 12 and got[50, 2].near == got[50, 2].matched == 14


def test_near_matches(spark):
    """Passages of 40 words in which every sixth word is another, is left out or has a neighbour inserted: no 12 words in a row are left."""
    rng = random.Random(6)
    items = [(i, " ".join(f"t{rng.randrange(3000)}" for _ in range(40))) for i in range(60)]
    rows = []
    for i, p in items:
        w = p.split()
        out = []
        for j, x in enumerate(w):
            kind = i % 3 if j % 6 == 5 else 3
            if kind == 1 and j > 20:  # several words left out in a row would move the rest too far
                kind = 0
            out += {0: ["other"], 1: [] if j == 5 else [x], 2: [x, "more"] if j == 5 else [x] if j % 12 else ["other"], 3: [x]}[kind]
            out += ["cut"] if kind == 1 and j == 17 else []
        rows.append((i, " ".join(["noise"] * (i % 4) + out)))
    exact, near = found(spark, rows, items), found(spark, rows, items, slop=2)
    third = {(i, i) for i in range(0, 60, 3)}
    assert not third & set(exact) and set(exact) <= set(near)
    assert set(near) <= {(i, i) for i in range(60)} and len(near) >= 54 and third <= set(near)
    assert all(near[k].near >= 30 and near[k].longest == 5 for k in third)


def test_leakage_empty(spark):
    assert found(spark, []) == {} and found(spark, [(1, ITEM)], []) == {}


def brute(rows, span):
    seen = {}
    for d, t in rows:
        for i in range(len(t or "") - span + 1):
            seen.setdefault(t[i : i + span], set()).add(d)
    return {d: {i for i in range(len(t or "") - span + 1) if len(seen[t[i : i + span]]) > 1} for d, t in rows if d is not None}


def made(seed, n=90, span=60):
    """Texts of which many share pieces of about the span's length, in several lengths around one core."""
    rng = random.Random(seed)
    noise = lambda k: "".join(rng.choice("abcdefgh é\U0001f600") for _ in range(k))
    cores = [noise(100) for _ in range(4)] + ["ab" * 60]
    rows = []
    for d in range(n):
        c = rng.choice(cores)
        a = rng.randrange(30)
        piece = c[a : a + rng.randrange(span - 25, span + 25)]
        rows.append((d, noise(rng.randrange(80)) + piece + noise(rng.randrange(80))))
    return [*rows, (1000, rows[0][1]), (1001, rows[0][1]), (1002, ""), (1003, None), (1004, noise(20))]


@pytest.mark.parametrize("seed", [1, 2])
def test_shared_spans_against_loop(spark, seed):
    rows = made(seed)
    want = brute(rows, 60)
    df = docs(spark, [*rows, (None, rows[0][1])])
    assert {r.doc_id for r in ss.recurring(df, 60).collect()} == {d for d, s in want.items() if s}
    cover = {r.doc_id: r.shared for r in ss.coverage(df, 60).collect()}
    assert cover == {d: len({i + k for i in s for k in range(60)}) for d, s in want.items()}


def test_shared_spans_find_what_a_representative_lacks(spark):
    # 1 shares 50 characters of the core with all, 2 and 3 share 62: their link does not pass by 1
    rng = random.Random(5)
    noise = lambda k: "".join(rng.choice("klmnopqrstuvwxyz") for _ in range(k))
    core = noise(62)
    rows = [(1, noise(40) + core[6:56] + noise(40)), (2, noise(40) + core + noise(40)), (3, noise(40) + core + noise(40))]
    assert {r.doc_id for r in ss.recurring(docs(spark, rows), 60).collect()} == {2, 3}


def test_passages_link_texts_that_are_settled_by_others(spark):
    # as above, but each of 1, 2 and 3 shares a passage with 4 as well; 1 holds every grid key of the core that 2 and 3 have in common
    rng = random.Random(0)
    noise = lambda k: "".join(rng.choice("klmnopqrstuvwxyz") for _ in range(k))
    core, p, q, r = noise(62), noise(70), noise(70), noise(70)
    rows = [(1, noise(40) + core[6:56] + noise(40) + p), (2, noise(40) + core + noise(40) + q), (3, noise(40) + core + noise(40) + r), (4, p + noise(40) + q + noise(40) + r)]
    got = {(x.a, x.b) for x in ss.passages(docs(spark, rows), 60).where("longest >= 60").collect()}
    assert got == {(1, 4), (2, 3), (2, 4), (3, 4)}


@pytest.mark.parametrize("seed", [1, 2])
def test_passages_connect_the_holders_of_every_window(spark, seed):
    rows = made(seed)
    copies = {}
    for d, t in rows:
        if d is not None:
            copies.setdefault(t, d)
    text = {d: t for t, d in copies.items() if t}
    pairs = {(r.a, r.b) for r in ss.passages(docs(spark, rows), 60).where("longest >= 60").collect()}
    holders = {}
    for d, t in text.items():
        for i in range(len(t) - 59):
            holders.setdefault(t[i : i + 60], set()).add(d)
    for held in holders.values():
        reached, todo = set(), [min(held)]
        while todo:
            d = todo.pop()
            if d not in reached:
                reached.add(d)
                todo += [x for x in held if (min(d, x), max(d, x)) in pairs]
        assert reached == held


def test_shared_spans_hot_group_and_long_text(spark):
    rng = random.Random(6)
    noise = lambda k: "".join(rng.choice("abcdefghijklmnop ") for _ in range(k))
    core = noise(320)
    rows = [(d, noise(50) + core + noise(50)) for d in range(300)] + [(900, noise(200_000) + core), (901, noise(400))]
    df = docs(spark, rows)
    assert {r.doc_id for r in ss.recurring(df).collect()} == {*range(300), 900}
    assert ss.passages(df).count() < 2500  # in proportion to documents, not to pairs
    assert ss.recurring(docs(spark, [])).count() == 0 and ss.coverage(docs(spark, [])).count() == 0


def test_shared_spans_keep_a_span_that_branches_off_a_better_chain(spark):
    # the 300 characters at (2300, 1900) cost more gap than they score: their predecessor belongs to a better chain
    rng = random.Random(8)
    noise = lambda k, of: "".join(rng.choice(of) for _ in range(k))
    pieces = [noise(n, "abcdefghijklm") for n in (290, 190, 190, 300)]

    def text(places, of):
        t = list(noise(2700, of))
        for p, piece in zip(places, pieces):
            t[p : p + len(piece)] = piece
        return "".join(t)

    rows = [(1, text((0, 2300, 2491, 1900), "nopqrst")), (2, text((0, 1900, 2091, 2300), "uvwxyz"))]
    want = brute(rows, 300)
    assert all(want.values())
    df = docs(spark, rows)
    assert {(r.a, r.b, r.longest_a, r.longest_b) for r in ss.passages(df).where("longest >= 300").collect()} == {(1, 2, 1900, 2300)}
    assert {r.doc_id for r in ss.recurring(df).collect()} == set(want)


def test_chain_prefers_collinear_anchors():
    anchors = [(0, 0, 30), (40, 500, 30), (45, 45, 30), (90, 95, 30)]
    best = ss.chains(anchors)[0]
    assert [anchors[i] for i in best[1]] == [(0, 0, 30), (45, 45, 30), (90, 95, 30)]
    assert abs(best[0] - (90 - ss.GAP * (15 + 15) - ss.GAP * (15 + 20))) < 1e-9


def test_seeds_depend_on_content_only():
    rng = random.Random(7)
    noise = lambda k: "".join(rng.choice("abcd") for _ in range(k))
    core = noise(300)
    a, b = ss.Hashes(noise(77) + core + noise(9)), ss.Hashes(noise(5) + core + noise(300))
    sa, sb = (set(ss.seeds(h, 300)[0].tolist()) for h in (a, b))
    assert sa & sb


def test_batches_have_the_seeds_of_single_texts():
    rng = random.Random(8)
    texts = ["".join(rng.choice("ab cd") for _ in range(n)) for n in (0, 299, 300, 1200, 31, 5000)]
    together = ss.Hashes(*texts)
    v, pos, first, last = ss.seeds(together, 300)
    begin = 0
    for t in texts:
        own = (first >= begin) & (first < begin + len(t))
        alone = ss.seeds(ss.Hashes(t), 300)
        assert [x.tolist() for x in alone] == [v[own].tolist(), (pos[own] - begin).tolist(), (first[own] - begin).tolist(), (last[own] - begin).tolist()]
        begin += len(t)


def test_partners_hang_together_without_a_hub(spark):
    rows = spark.range(3000).selectExpr("id AS doc_id", "7 AS key").unionByName(spark.range(5000, 5002).selectExpr("id AS doc_id", "8 AS key"))
    pairs = [(r.a, r.b) for r in ss._partners(rows).collect()]
    degree = Counter(x for p in pairs for x in p)
    root = {i: i for p in pairs for i in p}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        root[find(a)] = find(b)
    assert len(pairs) == 2999 + 1 and max(degree.values()) <= 4 and len({find(i) for i in range(3000)}) == 1 and all(a < b for a, b in pairs)


def test_fuzzy_passages_by_seeds(spark):
    """Passages of 900 characters with an edit in every hundred: recall of their pairs, by the shared seeds alone."""
    rng = random.Random(12)
    noise = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz     ") for _ in range(n))

    def edited(t):
        out = list(t)
        for i in range(50, len(out), 100):
            out[i] = "#"
        return "".join(out)

    rows, want = [], set()
    for k in range(60):
        core = noise(900)
        rows += [(2 * k, noise(400) + core + noise(300)), (2 * k + 1, noise(200) + edited(core) + noise(500))]
        want.add((2 * k, 2 * k + 1))
    found = {(r.a, r.b): r for r in ss.passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert set(found) <= want and len(found) >= 0.9 * len(want)
    assert all(r.longest < 300 and r.identity > 0.9 for r in found.values())


def test_classes(spark):
    t = "x" * 300
    rows = [(5, t), (3, t), (9, t + "y"), (1, "short"), (None, t), (7, None)]
    assert {(r.doc_id, r.class_id) for r in ss.classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()} == {(5, 3), (3, 3), (9, 9)}
