"""Problem 10: long spans that stand verbatim in more than one document, by chaining shared k-mer seeds."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from corpusmill.session import materialise

#: Length of the k-mers of which each window's least is a seed, and of those that anchor chains.
SEED_K = 32
CHAIN_K = 24
#: Width of a grid cell of window starts relative to their seed.
CELL = 27
#: Parts of one key's documents that are put in order by themselves.
SALTS = 256
#: A seed in more than this share of all seed rows is looked up by broadcast: at most 1/HOT such seeds exist.
HOT = 0.001
#: Neighbours by so many seeds are chained though they share no grid substring.
SEEDS = 2
#: Cost of a skipped character in either text when anchors are chained.
GAP = 0.05

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of a 64-bit value."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hashes:
    """Hash of any substring of a text (code points) in constant time: a polynomial modulo 2^64 over mixed characters.

    Several texts may stand one after another; `ends` are then where each ends.
    """

    def __init__(self, *texts: str):
        self.codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        n = self.n = len(self.codes)
        self.ends = np.cumsum([len(t) for t in texts])
        power = np.full(n + 1, _BASE)
        back = np.full(n + 1, _INVERSE)
        power[0] = back[0] = 1
        np.multiply.accumulate(power, out=power)
        self.back = np.multiply.accumulate(back)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_mix(self.codes.astype(np.uint64) + np.uint64(0x9E37)) * power[:n], out=self.sums[1:])
        self._first: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def of(self, start: np.ndarray, length: int) -> np.ndarray:
        return _mix((self.sums[start + length] - self.sums[start]) * self.back[start])

    def all(self, length: int) -> np.ndarray:
        m = self.n - length + 1
        return _mix((self.sums[length:] - self.sums[:m]) * self.back[:m]) if m > 0 else np.zeros(0, np.uint64)


    def first(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct hashes of the substrings of one length in order, the first place and the number of each."""
        if length not in self._first:
            self._first[length] = np.unique(self.all(length), return_index=True, return_counts=True)
        return self._first[length]


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` consecutive values, by doubling."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = np.minimum(x[:-step], x[step:])
        have += step
    return x


def seeds(h: Hashes, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, position, first, last) of the seeds of the texts of h, positions and starts as in the texts put together.

    A seed is the least k-mer hash (leftmost of equal ones) of a window of `span` characters; first..last are the
    starts of the windows it is the least of. Equal windows have equal seeds at equal places, wherever they stand.
    """
    v = h.all(SEED_K)
    if h.n < span:
        return v[:0], *(np.zeros(0, np.int64) for _ in range(3))
    # Half of the hash orders the k-mers, then their place: the choice depends on nothing but the window.
    low = np.uint64(0xFFFFFFFF)
    at = (_sliding_min((v & ~low) | np.arange(len(v), dtype=np.uint64), span - SEED_K + 1) & low).astype(np.int64)
    start = np.arange(len(at))
    text = np.searchsorted(h.ends, start, side="right")
    inside = start + span <= h.ends[np.minimum(text, len(h.ends) - 1)]  # windows that lie in one text
    at, start = at[inside], start[inside]
    if not len(at):
        return v[:0], *(np.zeros(0, np.int64) for _ in range(3))
    new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1)])
    return v[at[new]], at[new], start[new], start[np.r_[new[1:] - 1, len(at) - 1]]


def cells(h: Hashes, positions: np.ndarray, span: int, cell: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of the grid substrings of the windows whose seed stands at one of `positions`.

    A window that begins o characters before its seed holds the substring of span - cell + 1 characters that begins
    cell * (o // cell) before it. So equal windows share such a substring, and with cell = 1 it is the window itself.
    """
    _, pos, first, last = seeds(h, span)
    keep = np.isin(pos, positions)
    pos, low, high = pos[keep], (pos - last)[keep] // cell, (pos - first)[keep] // cell
    many = high - low + 1
    c = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    start = np.repeat(pos, many) - c * cell
    return h.of(start, span - cell + 1), start


def _runs(px: np.ndarray, py: np.ndarray, length: int) -> list[tuple[int, int, int]]:
    """Matches of one length as maximal runs (x, y, length) on their diagonals."""
    if not len(px):
        return []
    o = np.lexsort((px, px - py))
    px, py = px[o], py[o]
    new = np.flatnonzero(np.r_[True, (np.diff(px) != 1) | (np.diff(py) != 1)])
    size = np.diff(np.r_[new, len(px)])
    return list(zip(px[new].tolist(), py[new].tolist(), (size + length - 1).tolist()))


def anchors(x: Hashes, y: Hashes, span: int) -> list[tuple[int, int, int]]:
    """Exact matches (x, y, length): runs of k-mers that are unique in y, and of windows of `span` at their first place in y.

    The latter anchor texts so repetitive that no k-mer is unique. Each run is extended as far as the texts agree.
    """
    found = set()
    for k, single in ((CHAIN_K, True), (span, False)):
        a = x.all(k)
        u, first, count = y.first(k)
        if single:
            u, first = u[count == 1], first[count == 1]
        if not len(u) or not len(a):
            continue
        i = np.minimum(np.searchsorted(u, a), len(u) - 1)
        hit = np.flatnonzero(u[i] == a)
        for p, q, n in _runs(hit, first[i[hit]], k):
            if not np.array_equal(x.codes[p : p + n], y.codes[q : q + n]):
                continue  # a hash collision
            m = min(p, q)
            d = np.flatnonzero(x.codes[p - m : p][::-1] != y.codes[q - m : q][::-1])
            left = int(d[0]) if len(d) else m
            m = min(x.n - p - n, y.n - q - n)
            d = np.flatnonzero(x.codes[p + n : p + n + m] != y.codes[q + n : q + n + m])
            right = int(d[0]) if len(d) else m
            found.add((p - left, q - left, n + left + right))
    return sorted(found)


class _Fenwick:
    """Greatest value over a prefix of ranks."""

    def __init__(self, n: int):
        self.best = [(float("-inf"), -1)] * (n + 1)

    def put(self, rank: int, value: tuple[float, int]) -> None:
        rank += 1
        while rank < len(self.best):
            if value > self.best[rank]:
                self.best[rank] = value
            rank += rank & -rank

    def upto(self, rank: int) -> tuple[float, int]:
        out = (float("-inf"), -1)
        while rank > 0:
            if self.best[rank] > out:
                out = self.best[rank]
            rank -= rank & -rank
        return out


def chains(found: list[tuple[int, int, int]], gap: float = GAP) -> list[tuple[float, list[int]]]:
    """(score, anchors in order) of the collinear chains of anchors (x, y, length), best first; each anchor is in one.

    score = matched characters - gap * (characters skipped in x and in y). The cost splits into a part of the left
    and a part of the right anchor, so the best predecessor is a prefix maximum over ends in y, which a Fenwick tree
    gives while the anchors are swept in order of x: O(n log n).
    """
    n = len(found)
    ends = sorted({q + m for _, q, m in found})
    rank = {e: i for i, e in enumerate(ends)}
    by_end = sorted(range(n), key=lambda i: found[i][0] + found[i][2])
    tree, score, before, k = _Fenwick(len(ends)), [0.0] * n, [-1] * n, 0
    import bisect

    for j in sorted(range(n), key=lambda i: found[i]):
        p, q, m = found[j]
        while k < n and found[by_end[k]][0] + found[by_end[k]][2] <= p:
            i = by_end[k]
            e = found[i][1] + found[i][2]
            tree.put(rank[e], (score[i] + gap * (found[i][0] + found[i][2] + e), i))
            k += 1
        best, i = tree.upto(bisect.bisect_right(ends, q))
        gain = best - gap * (p + q)
        score[j] = m + max(0.0, gain)
        before[j] = i if gain > 0 else -1
    out, used = [], [False] * n
    for j in sorted(range(n), key=lambda i: -score[i]):
        chain = []
        i = j
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(i)
            i = before[i]
        if chain:
            out.append((score[j] - (score[i] if i >= 0 else 0.0), chain[::-1]))
    return out


def align(x: Hashes, y: Hashes, found: list[tuple[int, int, int]], chain: list[int]) -> tuple[int, int, int, int, int, int, float]:
    """(x start, x end, y start, y end, longest exact run, its start in x, identity) of a chain.

    Between anchors the texts are aligned from both sides of the gap as far as they agree, position by position where
    the gap is as long in both; identity is the share of equal characters of the longer side.
    """
    a = [found[i] for i in chain]
    x0, y0, x1, y1 = a[0][0], a[0][1], a[-1][0] + a[-1][2], a[-1][1] + a[-1][2]
    equal = sum(m for _, _, m in a)
    for (p, q, m), (p2, q2, _) in zip(a, a[1:]):
        g, h = x.codes[p + m : p2], y.codes[q + m : q2]
        s = min(len(g), len(h))
        if len(g) == len(h):
            equal += int((g == h).sum())
        elif s:
            tail = np.flatnonzero(g[::-1][:s] != h[::-1][:s])
            equal += int(tail[0]) if len(tail) else s
    longest = max(a, key=lambda r: (r[2], -r[0]))
    return x0, x1, y0, y1, longest[2], longest[0], min(1.0, equal / max(x1 - x0, y1 - y0))


_TYPES = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64()}


def _columns(schema: str) -> pa.Schema:
    return pa.schema([(n, _TYPES[t]) for n, t in (c.strip().split() for c in schema.split(","))])


def _map(df: DataFrame, schema: str, rows: Callable[[dict], Iterator[tuple]]) -> DataFrame:
    """mapInArrow that handles one input row at a time and sends on results in batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = _columns(schema)
        parts: list[list] = [[] for _ in target]
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                for row in batch.slice(i, 256).to_pylist():
                    for part, column in zip(parts, rows(row)):
                        part.append(column)
                if parts[0] and sum(map(len, parts[0])) > 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(p), f.type) for p, f in zip(parts, target)], schema=target)
                    parts = [[] for _ in target]
        if parts[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(p), f.type) for p, f in zip(parts, target)], schema=target)

    return df.mapInArrow(run, schema)


#: Characters that are hashed together; a longer text is hashed by itself.
TOGETHER = 200_000


def _groups(batch: pa.RecordBatch, text: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """The batch in slices of about TOGETHER characters, with their texts."""
    texts, first, size = [], 0, 0
    for i in range(batch.num_rows):
        texts.append(batch.column(text)[i].as_py())
        size += len(texts[-1])
        if size >= TOGETHER:
            yield batch.slice(first, i + 1 - first), texts
            texts, first, size = [], i + 1, 0
    if texts:
        yield batch.slice(first), texts


def _classes(documents: DataFrame, span: int) -> DataFrame:
    """doc_id, text, h, g of each document of at least `span` characters; (h, g), 128 bits, are equal for equal texts."""
    d = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where(F.col("doc_id").isNotNull() & (F.length("text") >= span))
    return d.withColumn("h", F.xxhash64("text", F.length("text"))).withColumn("g", F.xxhash64(F.lit(1), "text"))


def classes(documents: DataFrame, span: int = 300) -> DataFrame:
    """doc_id, class_id of each document of at least `span` characters: the least doc_id of those with an equal text.

    Copies stand for one another in passages(), which names class_ids. Null ids and texts give no rows.
    """
    d = _classes(documents, span).select("doc_id", "h", "g").distinct()
    return d.join(d.groupBy("h", "g").agg(F.min("doc_id").alias("class_id")), ["h", "g"]).groupBy("doc_id").agg(F.min("class_id").alias("class_id"))


def _seed_rows(docs: DataFrame, span: int) -> DataFrame:
    """seed, pos, h, g, doc_id of the seeds of every text."""
    schema = "seed bigint, pos int, h bigint, g bigint, doc_id bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in _groups(batch, 0):
                hashes = Hashes(*texts)
                v, pos, first, _ = seeds(hashes, span)
                i = np.searchsorted(hashes.ends, first, side="right")
                own = pos - np.r_[0, hashes.ends[:-1]][i]
                yield pa.RecordBatch.from_arrays([pa.array(v.view(np.int64)), pa.array(own.astype(np.int32)), *(part.column(c).take(pa.array(i)) for c in (1, 2, 3))], schema=_columns(schema))

    return docs.select("text", "h", "g", "doc_id").mapInArrow(run, schema)


def _shared_rows(docs: DataFrame, span: int) -> DataFrame:
    """seed, pos, doc_id: of each class of equal texts the least doc_id, with the seeds it shares with another class."""
    s = materialise(_seed_rows(docs, span), "seeds")
    own = F.struct("h", "g")
    per = s.groupBy("seed").agg(F.min(own).alias("a"), F.max(own).alias("b"), F.count("*").alias("n"))
    total = s.count()
    shared = per.where("a <> b")
    hot = shared.where(F.col("n") > HOT * total).select("seed", F.lit(True).alias("hot"))
    cold = shared.where(F.col("n") <= HOT * total).select(F.col("seed").alias("key"))
    # Rows of hot seeds are settled by the broadcast; their keys then match nothing and spread by document.
    j = s.join(F.broadcast(hot), "seed", "left")
    is_hot = F.col("hot").isNotNull()
    columns = ["seed", "pos", "h", "g", "doc_id"]
    kept = j.where(is_hot).select(*columns).unionByName(j.where(~is_hot).join(cold, F.col("seed") == F.col("key"), "left_semi").select(*columns))
    return kept.groupBy("h", "g", "pos").agg(F.min("doc_id").alias("doc_id"), F.first("seed").alias("seed")).select("seed", "pos", "doc_id")


def _shared(docs: DataFrame, span: int) -> DataFrame:
    """doc_id, at: the positions of the shared seeds of each class."""
    return _shared_rows(docs, span).groupBy("doc_id").agg(F.collect_set("pos").alias("at"))


def _cell_rows(texts: DataFrame, span: int, cell: int) -> DataFrame:
    """key, doc_id, start from doc_id, text, at."""
    schema = "key bigint, doc_id bigint, start int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in _groups(batch, 0):
                hashes, at = Hashes(*texts), part.column(1)
                begin = np.r_[0, hashes.ends[:-1]]
                positions = at.flatten().to_numpy() + np.repeat(begin, at.value_lengths().to_numpy())
                key, start = cells(hashes, positions, span, cell)
                i = np.searchsorted(hashes.ends, start, side="right")
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), part.column(2).take(pa.array(i)), pa.array((start - begin[i]).astype(np.int32))], schema=_columns(schema))

    return texts.select("text", "at", "doc_id").mapInArrow(run, schema)


def _partners(rows: DataFrame, key: str = "key", distinct: bool = True) -> DataFrame:
    """a, b (a < b): the neighbours in order of doc_id among the documents of each key.

    The documents of a key are put in order within SALTS parts, then the first ones of the parts: as many pairs as
    rows, and no document has more than a few partners by one key, however many hold it.
    """
    r = rows.select(key, "doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).alias("salt")).distinct()
    r = r.withColumn("before", F.lag("doc_id").over(Window.partitionBy(key, "salt").orderBy("doc_id")))
    heads = r.where("before is null").withColumn("before", F.lag("doc_id").over(Window.partitionBy(key).orderBy("doc_id")))
    pairs = r.unionByName(heads).where("before is not null").select(F.col("before").alias("a"), F.col("doc_id").alias("b"))
    return pairs.distinct() if distinct else pairs  # else once for each key


_PASSAGE = "a bigint, b bigint, a_start int, a_end int, b_start int, b_end int, longest int, longest_a int, longest_b int, score double, identity double"


def _chained(pairs: DataFrame, docs: DataFrame, span: int, least: float) -> DataFrame:
    """Passages of each pair whose chain scores at least `least` or holds an anchor of `span` characters.

    A chain that branches off a better one counts only its own anchors less the gaps, so its score may fall below
    `least` however long an anchor it holds.
    """

    def rows(r: dict):
        # Pairs of one a come mostly together.
        if last.get("a") != r["a"]:
            last.update(a=r["a"], y=Hashes(r["ta"]))
        x, y = Hashes(r["tb"]), last["y"]
        found = anchors(x, y, span)
        out = []
        for score, chain in chains(found):
            if score >= least or any(found[i][2] >= span for i in chain):
                x0, x1, y0, y1, longest, at, same = align(x, y, found, chain)
                at_y = next(q for p, q, m in (found[i] for i in chain) if p == at and m == longest)
                out.append((r["a"], r["b"], y0, y1, x0, x1, longest, at_y, at, score, same))
        return [np.array(c) for c in zip(*out)]

    last: dict = {}
    t = docs.select("doc_id", "text")
    j = pairs.join(t.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b").join(t.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a")
    return _map(j.select("a", "b", "ta", "tb"), _PASSAGE, rows)


def _passages(documents: DataFrame, span: int, every: bool) -> DataFrame:
    """Passages by the steps of passages(); without `every` only keys of documents that lack a passage of `span` are cut again."""
    docs = _classes(documents, span)
    shared = materialise(_shared_rows(docs, span), "shared-seeds")
    at = shared.groupBy("doc_id").agg(F.collect_set("pos").alias("at"))
    texts = docs.select("doc_id", "text")
    keys = materialise(_cell_rows(texts.join(at, "doc_id"), span, CELL), "cells")
    pairs = _partners(keys)
    if every:
        near = _partners(shared, "seed", distinct=False).groupBy("a", "b").agg(F.count("*").alias("n")).where(F.col("n") >= SEEDS).select("a", "b")
        pairs = pairs.unionByName(near).distinct()
    first = materialise(_chained(pairs, texts, span, span / 2), "passages")
    sizes = keys.groupBy("key").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    crowded = sizes.where("low <> high").select("key")
    if not every:
        done = first.where(F.col("longest") >= span).select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
        crowded = crowded.join(keys.join(done, "doc_id", "left_anti").select("key").distinct(), "key", "left_semi")
    members = keys.join(crowded, "key", "left_semi").select("doc_id").distinct()
    fine = _cell_rows(texts.join(at.join(members, "doc_id", "left_semi"), "doc_id"), span, 1)
    tried = first.select("a", "b").distinct()
    second = _chained(_partners(fine).join(tried, ["a", "b"], "left_anti"), texts, span, span / 2)
    return first.unionByName(second)


def passages(documents: DataFrame, span: int = 300) -> DataFrame:
    """a, b, a_start, a_end, b_start, b_end, longest, longest_a, longest_b, score, identity: passages that documents a < b share.

    Exact copies stand for one another: a and b are the least doc_ids of their classes, which classes() gives. The
    classes that hold a window of `span` characters hang together by rows of pairs that both hold it:

    1. Each window of `span` characters has a seed, its least k-mer; seeds of two classes are joined (counts first,
       so that nothing is keyed by a seed that only one class has).
    2. Documents with a shared seed give the grid substrings around it; neighbours in the order of a key's documents
       become pairs, and so do those that are neighbours by SEEDS seeds, which need no verbatim run of any length.
    3. The pair's k-mer matches are chained (Fenwick tree) and aligned.
    4. A pair of one grid key agrees on span - CELL + 1 characters, which may fall short of `span` though other
       members of the key reach it. Keys of several documents are therefore cut again with cells of one character,
       where all members agree on the whole window, and their partners chained likewise.

    Pairs grow with the documents and the different windows they share, not with pairs of documents. Chains scoring
    under span / 2 are reported only where they hold `span` equal characters.
    Null or shorter texts and null ids give no rows; of rows with one doc_id and text one counts; an empty table
    gives no rows.
    """
    return _passages(documents, span, True)


def recurring(documents: DataFrame, span: int = 300) -> DataFrame:
    """doc_id of each document that holds `span` consecutive characters (code points) of another document's text.

    Documents with a copy are such if they are long enough; the others come from the verbatim runs of the chained
    passages; one passage settles a document, so only keys of the others are cut again. Cases as in passages().
    """
    docs = _classes(documents, span)
    own = docs.select("doc_id", "h", "g")
    size = own.groupBy("h", "g").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low <> high")
    copies = own.join(size, ["h", "g"], "left_semi").select("doc_id")
    p = _passages(documents, span, False).where(F.col("longest") >= span)
    return copies.unionByName(p.select(F.explode(F.array("a", "b")).alias("doc_id"))).distinct()


def coverage(documents: DataFrame, span: int = 300) -> DataFrame:
    """doc_id, n_chars, shared, share of each document: how many of its characters lie in windows of `span` characters that another document holds.

    Every shared window counts, whoever holds it; a copy of another document is shared wholly. Null and short texts
    have 0; a share of an empty or null text is 0. The windows come from the same seeds and grid cells as the
    passages, cut again with cells of one character.
    """
    docs = _classes(documents, span)
    texts = docs.select("doc_id", "text")
    at = materialise(_shared(docs, span), "shared-seeds")
    keys = _cell_rows(texts.join(at, "doc_id"), span, CELL)
    crowded = keys.groupBy("key").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low <> high").select("key")
    members = keys.join(crowded, "key", "left_semi").select("doc_id").distinct()
    fine = materialise(_cell_rows(texts.join(at.join(members, "doc_id", "left_semi"), "doc_id"), span, 1), "windows")
    twice = fine.groupBy("key").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low <> high").select("key")
    starts = fine.join(twice, "key", "left_semi").select("doc_id", "start").distinct()
    ahead = F.lead("start").over(Window.partitionBy("doc_id").orderBy("start")) - F.col("start")
    part = starts.select("doc_id", F.least(F.lit(span), F.coalesce(ahead, F.lit(span))).alias("new")).groupBy("doc_id").agg(F.sum("new").alias("part"))
    own = docs.select("doc_id", "h", "g")
    copied = own.join(own.groupBy("h", "g").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low <> high"), ["h", "g"], "left_semi").select("doc_id").distinct().withColumn("copied", F.lit(True))
    every = documents.where("doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max(F.coalesce(F.length("text"), F.lit(0))).cast("bigint").alias("n_chars"))
    j = every.join(part, "doc_id", "left").join(copied, "doc_id", "left")
    shared = F.when(F.col("copied").isNotNull(), F.col("n_chars")).otherwise(F.coalesce("part", F.lit(0)).cast("bigint"))
    return j.select("doc_id", "n_chars", shared.alias("shared")).withColumn("share", F.when(F.col("n_chars") > 0, F.col("shared") / F.col("n_chars")).otherwise(F.lit(0.0)))
