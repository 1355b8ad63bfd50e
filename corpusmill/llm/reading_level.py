"""Problem 2: the reading level of a text, from its own wording."""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusmill.llm import _segments as S
from corpusmill.llm._gbrt import Trees
from corpusmill.session import materialise, wide

# The grades in order.
LEVELS = ("beginner", "intermediate", "advanced", "expert")
#: Labelled texts that the model is fitted on at most: those of the least hashes, the same in every run.
LABELLED = 12_000
FOLDS = 5
#: Least number of blank-separated words of a text that is rated.
WORDS = 5

_NOISE = re.compile(r"`[^`]*`|https?://\S+|www\.\S+|^\s*v\d+(?:\.\d+)+\s*\([^)]*\)\s*:|<[^>]+>|\{[^}]*\}")
_PIECE = re.compile(r"[^\W\d_]+(?:[-'’][^\W\d_]+)*|[.!?]+(?:\s+|$)|\n+")
_VOWELS = re.compile(r"[aeiouyáàâäéèêëíìîïóòôöúùûüœæ]+")
#: Distinct words remembered by a task; beyond it the memory is emptied, results stay the same.
REMEMBER = 500_000
#: Draw of a term's mean grade towards the overall mean, in texts; least number of texts of a term that counts.
PRIOR, LEAST = 4.0, 3
BASE, GRADED = 42, 10


class Words:
    """Numbers words; number 0 ends a sentence. Holds what the features need of each word once."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.lower: dict[str, int] = {"": 0, "<name>": 1, "<s>": 2}
        self.length, self.syllables, self.capital, self.low = [0], [0], [False], [0]

    def __call__(self, text: str) -> list[int]:
        get, out = self.number.get, []
        for w in _PIECE.findall(_NOISE.sub(" ", text)):
            n = get(w)
            out.append(self._add(w) if n is None else n)
        return out

    def _add(self, word: str) -> int:
        n = 0
        if word[0].isalpha():
            n, low = len(self.length), word.lower()
            self.length.append(len(low))
            self.syllables.append(len(_VOWELS.findall(low)) or 1)
            self.capital.append(word[0].isupper())
            self.low.append(self.lower.setdefault(low, len(self.lower)))
        self.number[word] = n
        return n


class Texts:
    """A batch of texts as flat arrays of words, and those of their features that no labels are needed for.

    text, sentence: of each word; low: its number in lower case, 1 for a name - a capital inside an English, French or
    Spanish sentence, which says nothing of the level; base: a row of BASE features per text, all 0 without words.
    """

    def __init__(self, texts: list[str], words: Words):
        if len(words.number) > REMEMBER:
            words.clear()
        parts = [words(t) for t in texts]
        self.n, size = len(texts), np.fromiter(map(len, parts), np.int64, len(parts))
        flat = np.fromiter((i for p in parts for i in p), np.int64, int(size.sum()))
        text = np.repeat(np.arange(self.n), size)
        ends = np.cumsum(flat == 0) + text  # grows at the end of a sentence and of a text
        kept = flat > 0
        flat, self.text, ends = flat[kept], text[kept], ends[kept]
        self.at = S.starts(ends)  # first word of each sentence
        self.size = np.diff(np.r_[self.at, len(flat)])
        self.sentence = np.repeat(np.arange(len(self.at)), self.size)
        self.place = np.arange(len(flat)) - self.at[self.sentence] if len(flat) else flat
        name = (self.place > 0) & np.array(words.capital)[flat]
        low = np.array(words.low)[flat]
        self.plain, self.low, self.words = ~name, np.where(name, 1, low), words
        self.of = self.text[self.at]  # text of each sentence
        self.first = S.starts(self.of)  # first sentence of each text that has words
        self.rows = self.of[self.first]
        self.sentences = np.diff(np.r_[self.first, len(self.at)])
        self.base = np.zeros((self.n, BASE))
        if len(flat):
            self.base[self.rows] = self._base(texts, flat, low)

    def _base(self, texts: list[str], flat: np.ndarray, low: np.ndarray) -> np.ndarray:
        plain, w = self.plain, self.words
        length, syllables = np.array(w.length, float)[flat[plain]], np.array(w.syllables)[flat[plain]]
        by_text, by_sentence = S.starts(self.text[plain]), S.starts(self.sentence[plain])  # the first word of a sentence is no name
        count, inside = np.diff(np.r_[by_text, len(length)]), np.diff(np.r_[by_sentence, len(length)])
        every = S.sums(self.size, self.first)
        mean = S.sums(length, by_text) / count
        share = lambda x: S.sums(x.astype(float), by_text) / count
        over = lambda x: S.spread(x, self.first, self.sentences)
        # Distinct words per text; distinct longer words per sentence, and those that the next sentence holds too.
        m = len(w.lower)
        text_words = np.unique(self.text[plain] * m + low[plain])
        distinct = np.bincount(text_words // m, minlength=self.n)[self.rows]
        long = plain & (np.array(w.length)[flat] > 3)
        pairs = np.unique(self.sentence[long] * m + low[long])
        held = np.bincount(pairs // m, minlength=len(self.at))
        after = pairs + m
        i = np.minimum(np.searchsorted(pairs, after), max(len(pairs) - 1, 0))
        common = np.bincount(pairs[pairs[i] == after] // m, minlength=len(self.at)) if len(pairs) else held
        overlap = common[:-1] / np.maximum(1, np.minimum(held[:-1], held[1:]))
        within = self.of[1:] == self.of[:-1]
        overlap = np.where(np.r_[within, False], np.r_[overlap, 0.0], 0.0)  # of each sentence with the next of its text
        distinct_long = np.bincount(np.unique(self.text[long] * m + low[long]) // m, minlength=self.n)[self.rows]
        source = [texts[i] for i in self.rows]
        marks = [np.array([t.count(c) for t in source]) / self.sentences for c in ",?;"]
        foreign = [0.0 if t.isascii() else sum(1 for c in t if c > "\x7f") / len(t) for t in source]
        return np.stack([
            every, self.sentences, *over(self.size.astype(float)),
            mean, np.sqrt(S.sums((length - np.repeat(mean, count)) ** 2, by_text) / count), *S.quantiles(length, by_text, count, (0.25, 0.5, 0.75, 0.9, 1.0)),
            *[share(length >= k) for k in (7, 9, 11, 13)],
            share(syllables), np.maximum.reduceat(syllables, by_text), *[share(syllables >= k) for k in (3, 4, 5)],
            *over(S.sums((length >= 10).astype(float), by_sentence) / inside), *over(S.sums(length, by_sentence) / inside),
            distinct / count, (every - count) / every, *marks, foreign,
            S.sums(overlap, self.first) / np.maximum(1, self.sentences - 1), np.maximum.reduceat(overlap, self.first), 1 - distinct_long / np.maximum(1, S.sums(held, self.first)),
        ], 1)

    def terms(self) -> tuple[np.ndarray, np.ndarray]:
        """What vocabulary scores are learned for, of each word: its number, and the pair of the number before (2 at the start) and its own."""
        before = np.where(self.place > 0, np.r_[0, self.low[:-1]], 2) if len(self.low) else self.low
        return self.low, before * PAIR + self.low

    def graded(self, word: np.ndarray, known: np.ndarray, pair: np.ndarray, mean: float) -> np.ndarray:
        """A row of GRADED features per text from the score of each word (the mean where it is not `known`) and pair."""
        out = np.zeros((self.n, GRADED))
        if not len(word):
            return out
        per = S.sums(word + pair, self.at) / (2 * self.size)
        out[self.rows, :5] = np.stack(S.spread(per, self.first, self.sentences), 1)
        out[self.rows, 5:9] = mean
        k = known & self.plain
        if k.any():
            at = S.starts(self.text[k])
            size, rows = np.diff(np.r_[at, k.sum()]), self.text[k][at]
            out[rows, 5:9] = np.stack([S.sums(word[k], at) / size, *S.quantiles(word[k], at, size, (0.1, 0.5, 0.9))], 1)
        plain = np.bincount(self.text[self.plain], minlength=self.n)[self.rows]
        out[self.rows, 9] = np.bincount(self.text[k], minlength=self.n)[self.rows] / plain
        return out


#: Numbers of words stay below it, so that a pair is one number.
PAIR = 1 << 31


class Scores:
    """Mean grade of the labelled texts that hold a term, drawn towards the overall mean; kept by fold so that folds can be left out."""

    def __init__(self, t: Texts, grade: np.ndarray, fold: np.ndarray):
        self.grade, self.fold, self.sides = grade, fold, []
        for numbers in t.terms():
            terms, at = np.unique(numbers, return_inverse=True)
            held = np.unique(at * t.n + t.text)  # each term of a text once
            term, text = held // t.n, held % t.n
            key = term * FOLDS + fold[text]
            shape = (len(terms), FOLDS)
            count = np.bincount(key, minlength=len(terms) * FOLDS).reshape(shape)
            total = np.bincount(key, grade[text], len(terms) * FOLDS).reshape(shape)
            self.sides.append((terms, at, count, total))

    def without(self, *folds: int) -> tuple[float, list[np.ndarray]]:
        """Overall mean and the scores of words and of pairs, NaN for terms of too few texts, from texts outside the folds."""
        kept = [f for f in range(FOLDS) if f not in folds]
        own = self.grade[np.isin(self.fold, kept)]
        mean = float(own.mean()) if len(own) else 1.0
        out = []
        for _, _, count, total in self.sides:
            n = count[:, kept].sum(1)
            out.append(np.where(n >= LEAST, (total[:, kept].sum(1) + PRIOR * mean) / (n + PRIOR), np.nan))
        return mean, out

    def features(self, t: Texts, *folds: int) -> np.ndarray:
        """Graded features of the labelled texts themselves, scored without the folds."""
        mean, scores = self.without(*folds)
        w, p = (s[side[1]] for s, side in zip(scores, self.sides))
        return t.graded(np.where(np.isnan(w), mean, w), ~np.isnan(w), np.where(np.isnan(p), mean, p), mean)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points of the non-decreasing step function nearest to y over x (pool adjacent violators)."""
    o = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []
    for a, b in zip(x[o], y[o]):
        blocks.append([b, 1, a])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v, n, at = blocks.pop()
            u, m, first = blocks[-1]
            blocks[-1] = [(u * m + v * n) / (m + n), m + n, first]
    return np.array([b[2] for b in blocks]), np.array([b[0] for b in blocks])


def cutpoints(pred: np.ndarray, label: np.ndarray, weight: np.ndarray) -> list[float]:
    """The three limits between grades with the most labels on their right side, each found by itself."""
    out = []
    o = np.argsort(pred, kind="stable")
    p, w = pred[o], weight[o]
    for k in range(1, len(LEVELS)):
        high = (label[o] >= k) * w
        wrong = np.r_[0, high.cumsum()] + np.r_[((w - high)[::-1].cumsum())[::-1], 0]
        best = np.flatnonzero(wrong <= wrong.min() + 1e-9)
        i = int(best[len(best) // 2])
        out.append(float(p[0] - 1 if i == 0 else p[-1] + 1 if i == len(p) else (p[i - 1] + p[i]) / 2))
    return np.maximum.accumulate(out).tolist()


class Model:
    """Grades texts. Holds nothing but the trees, the calibration and the vocabulary scores of the labelled sample."""

    def __init__(self, trees: Trees, held_out: np.ndarray, grade: np.ndarray, weight: np.ndarray, scores: tuple[float, dict[str, float], dict[tuple[str, str], float]]):
        self.trees = trees
        self.calibration = isotonic(held_out, grade)
        self.cuts = cutpoints(self.grade(held_out), np.rint(grade), weight)
        self.mean, self.words, self.pairs = scores

    def grade(self, raw: np.ndarray) -> np.ndarray:
        """Calibrated grade: 0 beginner .. 3 expert, as judges would give it on average."""
        return np.interp(raw, *self.calibration)

    def level(self, grade: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.cuts, grade, side="right")


class Grader:
    """Raw grades by a model within one task."""

    def __init__(self, model: Model):
        self.model, self.seen, self.memory, self.words = model, 0, {}, Words()
        self.by_word = np.zeros(0)

    def _scores(self) -> None:
        """Scores of the words seen so far, by their number; pairs of words that both are in the model."""
        w, m = self.words, self.model
        if len(w.lower) < self.seen:
            self.seen, self.by_word = 0, np.zeros(0)
        new = list(w.lower)[self.seen :]
        self.by_word = np.r_[self.by_word, [m.words.get(x, np.nan) for x in new]]
        self.seen = len(w.lower)

    def __call__(self, texts: list[str]) -> np.ndarray:
        m, t = self.model, Texts(texts, self.words)
        self._scores()
        word, pair = t.terms()
        w = self.by_word[word]
        names = None
        u, at = np.unique(pair, return_inverse=True)
        score = np.full(len(u), m.mean)
        if m.pairs:
            names = list(self.words.lower)
            get, mean = m.pairs.get, m.mean
            score = np.fromiter((get((names[p // PAIR], names[p % PAIR]), mean) for p in u.tolist()), float, len(u))
        x = np.concatenate([t.base, t.graded(np.where(np.isnan(w), m.mean, w), ~np.isnan(w), score[at], m.mean)], 1)
        return m.trees.predict(x)


def learn(texts: list[str], grade: np.ndarray, weight: np.ndarray, group: list[str], fit: Callable[[list[tuple]], list]) -> Model:
    """The model of labelled texts. `fit` maps training jobs (x, y, weight, rows to predict) to (trees, predictions).

    Folds are whole groups. A training row's vocabulary scores come from folds other than its own, as they will when
    the model is used; where fold k is held out, they come from neither its own nor k, so nothing of fold k's labels
    reaches the trees that grade it.
    """
    words = Words()
    t = Texts(texts, words)
    fold = np.array([zlib.crc32(g.encode()) % FOLDS for g in group], int) if len(set(group)) >= FOLDS else np.arange(len(texts)) % FOLDS
    scores = Scores(t, grade, fold)
    whole = lambda *folds: np.concatenate([t.base, scores.features(t, *folds)], 1)
    alone = [whole(k) for k in range(FOLDS)]
    jobs, x = [], np.choose(fold[:, None], alone)
    for k in range(FOLDS):
        own = fold == k
        if own.any() and not own.all():
            inside = np.choose(fold[:, None], [alone[k] if j == k else whole(j, k) for j in range(FOLDS)])
            jobs.append((inside[~own], grade[~own], weight[~own], alone[k][own]))
    done = fit([*jobs, (x, grade, weight, x[:0])])
    held_out = np.full(len(texts), grade.mean())
    for k, (_, p) in zip([k for k in range(FOLDS) if (fold == k).any() and not (fold == k).all()], done):
        held_out[fold == k] = p
    mean, (w, p) = scores.without()
    names = list(words.lower)
    by_word = {names[i]: float(v) for i, v in zip(scores.sides[0][0], w) if v == v}
    by_pair = {(names[i // PAIR], names[i % PAIR]): float(v) for i, v in zip(scores.sides[1][0].tolist(), p) if v == v}
    model = Model(done[-1][0], held_out, grade, weight, (mean, by_word, by_pair))
    model.held_out = held_out
    return model


def fit_here(jobs: list[tuple]) -> list[tuple[Trees, np.ndarray]]:
    return [((t := Trees().fit(x, y, w)), t.predict(q)) for x, y, w, q in jobs]


def fit_in_tasks(spark: SparkSession) -> Callable[[list[tuple]], list]:
    """One Spark task for each training job; a job is as large as the bounded sample."""

    def fit(jobs: list[tuple]) -> list[tuple[Trees, np.ndarray]]:
        shared = spark.sparkContext.broadcast(jobs)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for i in b.column(0).to_pylist():
                    trees, predicted = fit_here([shared.value[i]])[0]
                    yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([pickle.dumps((vars(trees), predicted))], pa.binary())], names=["id", "made"])

        out = []
        for r in sorted(spark.range(0, len(jobs), 1, len(jobs)).mapInArrow(run, "id bigint, made binary").collect()):
            state, predicted = pickle.loads(r["made"])
            trees = Trees()
            vars(trees).update(state)
            out.append((trees, predicted))
        return out

    return fit


def labelled(rated: DataFrame, labels: DataFrame, limit: int = LABELLED) -> pd.DataFrame:
    """path, summary, source, grade (mean over judges), judges of labelled strands; at most `limit` of them, chosen by hash."""
    grade = F.array_position(F.array(*map(F.lit, LEVELS)), F.lower(F.trim("label"))) - 1
    g = labels.where("kind = 'level' and path is not null").select("path", "judge", "label").distinct().withColumn("grade", grade).where("grade >= 0")
    g = g.groupBy("path").agg(F.avg("grade").alias("grade"), F.count("*").alias("judges"))
    return rated.join(g, "path").orderBy(F.xxhash64("path"), "path").limit(limit).toPandas()


def _rated(strands: DataFrame) -> DataFrame:
    """path, summary, source of each path with a summary long enough; of several summaries the first in binary order."""
    s = strands.select("path", "summary", F.concat_ws("/", "weave", "loom").alias("source")).where("path is not null and summary is not null")
    s = s.where(F.size(F.filter(F.split("summary", r"(?U)\s+"), lambda w: w != "")) >= WORDS)
    # Repeated rows of a path are merged before the first shuffle; the second only spreads what is left over the cores.
    return wide(s.groupBy("path").agg(F.min(F.struct("summary", "source")).alias("x")).select("path", "x.summary", "x.source"), "path")


def train(rated: DataFrame, labels: DataFrame, limit: int = LABELLED) -> Model | None:
    """The model of the labelled ones of the strands that _rated() gives, None if there are none; folds are fitted in tasks."""
    t = labelled(rated, labels, limit)
    if not len(t):
        return None
    return learn(t["summary"].tolist(), t["grade"].to_numpy(float), t["judges"].to_numpy(float), t["source"].fillna("").tolist(), fit_in_tasks(rated.sparkSession))


def reading_levels(strands: DataFrame, labels: DataFrame, limit: int = LABELLED) -> DataFrame:
    """path, difficulty, grade: one row per strand whose summary has at least WORDS blank-separated words.

    Boosted regression trees over length, vocabulary, syntax and cohesion features, fitted on at most `limit` labelled
    strands; folds are whole sources, the calibration of the grade comes from held-out predictions, and the level from
    limits on the calibrated grade. What the strand declares is not used. Null paths and null or shorter summaries give
    no row, a path given twice gives one. Without any label every text is `intermediate` of grade 1.
    """
    s = materialise(_rated(strands), "rated")  # read for the labels and for the result
    model = train(s, labels, limit)
    s = s.select("path", "summary")
    if model is None:
        return s.select("path", F.lit(LEVELS[1]).alias("difficulty"), F.lit(1.0).alias("grade"))
    shared = strands.sparkSession.sparkContext.broadcast(model)  # bounded by the sample

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        grader = Grader(m)
        for b in batches:
            for at in range(0, b.num_rows, 4000):
                part = b.slice(at, 4000)
                grade = m.grade(grader(part.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.array(LEVELS)[m.level(grade)]), pa.array(grade)], names=["path", "difficulty", "grade"])

    return s.mapInArrow(rate, "path string, difficulty string, grade double")
