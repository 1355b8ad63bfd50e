"""Problem 4: the subject areas of a text, by complement naive Bayes with expectation-maximisation and calibrated posteriors."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusmill.llm import _segments as S
from corpusmill.session import materialise, wide

#: Labelled texts that the model is fitted on at most: those of the least hashes.
LABELLED = 20_000
#: Buckets that words are hashed into; the model's size, whatever the corpus.
BUCKETS = 1 << 16
#: Rounds of expectation-maximisation over all texts at most, and the relative change of the counts at which they end.
ROUNDS, SETTLED = 5, 0.02
#: One labelled text in so many is held out for the calibration.
HELD_OUT = 4
WORDS = 5
#: What a word of the title weighs against one of the summary.
TITLE = 0.5
SMOOTH = 0.3
PREDICTORS = 10

_NOISE = re.compile(r"`[^`]*`|https?://\S+|www\.\S+")
_TOKEN = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*")


class Hasher:
    """Buckets of words; remembers words within a task."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(text, bucket) of every word of the texts."""
        known, flat, size = self.known, [], []
        if len(known) > 300_000:
            known.clear()
        for t in texts:
            words = _TOKEN.findall(_NOISE.sub(" ", t)) if t else ()
            size.append(len(words))
            for w in words:
                b = known.get(w)
                if b is None:
                    b = known[w] = zlib.crc32(w.lower().encode()) % BUCKETS
                flat.append(b)
        return np.repeat(np.arange(len(size)), size), np.array(flat, np.int64)


class Bags:
    """Word bags of texts: bag i holds ids[at[i]:at[i+1]] with weights n of the same places."""

    def __init__(self, at: np.ndarray, ids: np.ndarray, n: np.ndarray):
        self.at, self.ids, self.n = at, ids, n
        self.full = np.flatnonzero(np.diff(at))  # bags that hold a word
        self.first = at[:-1][self.full]
        self.text = np.repeat(np.arange(len(at) - 1), np.diff(at))

    def __len__(self) -> int:
        return len(self.at) - 1

    def take(self, rows: np.ndarray) -> Bags:
        keep = np.isin(self.text, rows)
        size = np.diff(self.at)[rows]
        return Bags(np.r_[0, np.cumsum(size)], self.ids[keep], self.n[keep])

    def per_text(self, x: np.ndarray) -> np.ndarray:
        """Sums of x, a row per word, by text."""
        out = np.zeros((len(self), *x.shape[1:]), x.dtype)
        if len(self.full):
            out[self.full] = np.add.reduceat(x, self.first, axis=0)
        return out


def bags(text: np.ndarray, ids: np.ndarray, weight: np.ndarray, texts: int) -> Bags:
    """Words of one text and bucket together; a repeated word counts with diminishing weight."""
    key, at = np.unique(text * BUCKETS + ids, return_inverse=True)
    n = np.log1p(np.bincount(at, weight, len(key)))
    return Bags(np.searchsorted(key, np.arange(texts + 1) * BUCKETS), key % BUCKETS, n)


class Weights:
    """Complement naive Bayes: for each bucket and class the log odds of the class against all others."""

    def __init__(self, counts: np.ndarray):
        total = counts.sum(0)
        rest = total.sum() - total
        inside = np.log((counts + SMOOTH) / (total + SMOOTH * len(counts)))
        outside = np.log((counts.sum(1, keepdims=True) - counts + SMOOTH) / (rest + SMOOTH * len(counts)))
        self.odds = (inside - outside).astype(np.float32)
        self.ratio = np.exp(self.odds - self.odds.max(1, keepdims=True))
        # Words that speak for no class hardly count.
        self.telling = np.maximum(self.odds.max(1), 1e-3)

    def share(self, b: Bags, steps: int = 8) -> np.ndarray:
        """How the words of each text divide among the classes: posteriors of the words under the complement odds and
        the text's proportions of classes, which a few steps of expectation-maximisation find."""
        k = self.odds.shape[1]
        pi = np.full((len(b), k), 1 / k, np.float32)
        p = self.ratio[b.ids]
        w = (b.n * self.telling[b.ids]).astype(np.float32)
        for _ in range(steps):
            of = (p * pi[b.text]).sum(1) + 1e-30
            pi = pi * b.per_text(p * (w / of)[:, None]) + 0.02
            pi /= pi.sum(1, keepdims=True)
        return pi

    def evidence(self, b: Bags) -> np.ndarray:
        return b.per_text(self.odds[b.ids] * b.n.astype(np.float32)[:, None]) / np.maximum(1.0, b.per_text(b.n))[:, None]

    def posterior(self, b: Bags) -> np.ndarray:
        """Of each word of the texts: how much of it goes to each class."""
        r = self.ratio[b.ids] * self.share(b, 5)[b.text]
        return r / (r.sum(1, keepdims=True) + 1e-30)


def predictors(w: Weights, b: Bags, title: Bags, hint: np.ndarray) -> np.ndarray:
    """(texts, classes, PREDICTORS): share, its rank and log, evidence, the loom's stale hint, the title's share."""
    pi, e = w.share(b).astype(float), w.evidence(b).astype(float)
    k = pi.shape[1]
    order = np.sort(pi, 1)[:, ::-1]
    rank = np.argsort(np.argsort(-pi, 1, kind="stable"), 1, kind="stable")
    wide = lambda x: np.repeat(x[:, None], k, 1)
    named = w.share(title).astype(float)
    named[np.diff(title.at) == 0] = 1 / k
    return np.stack([pi, np.log(pi + 1e-4), e, e - wide(e.max(1)), pi / wide(order[:, 0]), (rank == 0) * 1.0, (rank == 1) * 1.0, wide(order[:, min(1, k - 1)]), hint, named], 2)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 25) -> np.ndarray:
    """Newton's method for ridge logistic regression."""
    b = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(b))
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * b)
        b += step
        if np.abs(step).max() < 1e-6:
            break
    return b


#: Subjects at most: the weights of all are held in memory. More are refused.
SUBJECTS = 200


def hint_table(stats: DataFrame | None, subjects: list[str]) -> dict[str, list[float]]:
    """Loom path to its stale subjects as 0/1 per subject; malformed lists are left out, of several the last in order counts. All looms are held in memory."""
    out: dict[str, list[float]] = {}
    if stats is None:
        return out
    low = [s.lower() for s in subjects]
    for r in stats.where("scope_type = 'loom'").select("scope", "subjects").orderBy("scope", "subjects").toLocalIterator():
        try:
            names = {str(x).strip().lower() for x in json.loads(r["subjects"] or "null") or []}
        except (ValueError, TypeError):
            continue
        if r["scope"] and names:
            out[r["scope"]] = [1.0 if s in names else 0.0 for s in low]
    return out


class Model:
    def __init__(self, subjects: list[str], weights: Weights, hints: dict[str, list[float]]):
        self.subjects, self.weights, self.hints = subjects, weights, hints
        self.coefficients, self.level, self.second = np.zeros(PREDICTORS), np.zeros(len(subjects)), 0.5

    def rows(self, b: Bags, title: Bags, looms: list[str]) -> np.ndarray:
        none = [0.5] * len(self.subjects)
        hint = np.array([self.hints.get(x, none) for x in looms]).reshape(-1, len(self.subjects))
        return predictors(self.weights, b, title, hint)

    def posterior(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probability of each subject by itself."""
        return 1 / (1 + np.exp(-np.clip(x @ self.coefficients + self.level, -30, 30)))

    def pick(self, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text, subject): the likeliest subject, and the next where its own posterior reaches the limit."""
        o = np.argsort(-p, 1, kind="stable")
        text = np.arange(len(p))
        if p.shape[1] < 2:
            return text, o[:, 0]
        two = p[text, o[:, 1]] >= self.second
        return np.r_[text, text[two]], np.r_[o[:, 0], o[two, 1]]


def _rated(strands: DataFrame) -> DataFrame:
    """path, title, summary, loom of each path with a summary long enough; of several rows the first in binary order."""
    s = strands.select("path", "title", "summary", F.concat_ws("/", F.lit("weaves"), "weave", "loom").alias("loom")).where("path is not null and summary is not null")
    s = s.where(F.size(F.filter(F.split("summary", r"(?U)\s+"), lambda w: w != "")) >= WORDS)
    # Repeated rows of a path are merged before the first shuffle; the second only spreads what is left over the cores.
    return wide(s.groupBy("path").agg(F.min(F.struct("summary", "title", "loom")).alias("x")).select("path", "x.title", "x.summary", "x.loom"), "path")


_BAGS = "path string, loom string, ids array<int>, n array<float>, title array<int>"


def encoded(rated: DataFrame) -> DataFrame:
    """path, loom, ids, n (bag of title and summary), title (distinct buckets of the title) of each text: texts are tokenised here and nowhere else."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        as_list = lambda b, x, kind: pa.ListArray.from_arrays(pa.array(b.at, pa.int32()), pa.array(x, kind))
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                m = part.num_rows
                (s, i), (t, j) = hasher(part.column(2).to_pylist()), hasher(part.column(1).to_pylist())
                both, title = bags(np.r_[s, t], np.r_[i, j], np.r_[np.ones(len(i)), np.full(len(j), TITLE)], m), bags(t, j, np.ones(len(j)), m)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(3), as_list(both, both.ids, pa.int32()), as_list(both, both.n, pa.float32()), as_list(title, title.ids, pa.int32())], names=["path", "loom", "ids", "n", "title"])

    return rated.select("path", "title", "summary", "loom").mapInArrow(run, _BAGS)


def _bag_of(ids: pa.Array, n: pa.Array | None = None) -> Bags:
    at = np.r_[0, np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False))]
    flat = ids.flatten().to_numpy(zero_copy_only=False)
    return Bags(at, flat, np.full(len(flat), np.log(2)) if n is None else n.flatten().to_numpy(zero_copy_only=False).astype(float))


def labelled(texts: DataFrame, labels: DataFrame, limit: int = LABELLED) -> pa.Table:
    """The encoded texts that are labelled, with votes (subject to judges) and judges; at most `limit`, chosen by hash."""
    l = labels.where("kind = 'subject' and path is not null").select("path", "judge", F.lower(F.trim("label")).alias("label")).distinct()
    judges = l.groupBy("path").agg(F.count_distinct("judge").alias("judges"))
    v = l.groupBy("path", "label").agg(F.count("*").alias("n")).groupBy("path").agg(F.map_from_entries(F.collect_list(F.struct("label", "n"))).alias("votes"))
    return texts.join(v, "path").join(judges, "path").orderBy(F.xxhash64("path"), "path").limit(limit).toArrow()


def _soft_counts(texts: DataFrame, models: list[Weights]) -> list[np.ndarray]:
    """For each model the word counts by class over all texts, each word divided by its posteriors: one array per task, summed by bucket."""
    shared = texts.sparkSession.sparkContext.broadcast(models)  # BUCKETS x classes each
    k = models[0].odds.shape[1]
    width = len(models) * k

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BUCKETS, width))
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                b = _bag_of(part.column(0), part.column(1))
                order = np.argsort(b.ids, kind="stable")
                first = S.starts(b.ids[order])
                for i, w in enumerate(shared.value):
                    if len(first):
                        total[b.ids[order][first], i * k : (i + 1) * k] += np.add.reduceat((w.posterior(b) * b.n[:, None])[order], first, axis=0)
        used = np.flatnonzero(total.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), *(pa.array(total[used, c]) for c in range(width))], names=["bucket", *(f"c{c}" for c in range(width))])

    names = [f"c{c}" for c in range(width)]
    sums = texts.select("ids", "n").mapInArrow(count, ", ".join(["bucket int", *(f"{c} double" for c in names)])).groupBy("bucket").agg(*(F.sum(c).alias(c) for c in names)).toPandas()
    out = np.zeros((BUCKETS, width))
    out[sums["bucket"].to_numpy()] = sums[names].to_numpy()
    return [out[:, i * k : (i + 1) * k] for i in range(len(models))]


def _labelled_counts(b: Bags, y: np.ndarray) -> np.ndarray:
    share = y / np.maximum(y.sum(1, keepdims=True), 1e-9)
    return np.stack([np.bincount(b.ids, b.n * share[b.text, c], BUCKETS) for c in range(y.shape[1])], 1)


def train(texts: DataFrame, labels: DataFrame, subjects: DataFrame, stats: DataFrame | None = None, limit: int = LABELLED, rounds: int = ROUNDS, unlabelled_weight: float = 0.1) -> Model | None:
    """The model of the texts that encoded() gives, None if there are no labels or subjects.

    1. Complement naive Bayes from the labelled sample, and once more without the held-out labels. 2. Expectation-
    maximisation, `rounds` at most: all texts' words are divided by their posteriors under the last weights and counted
    beside the labelled ones, for both models in one pass, until the counts settle. 3. Per subject a logistic
    calibration on the held-out texts, by the weights that never saw their labels; it serves the whole model.
    """
    names = [r[0] for r in subjects.select("subject").where("subject is not null").distinct().orderBy("subject").limit(SUBJECTS + 1).collect()]
    if len(names) > SUBJECTS:
        raise ValueError(f"more than {SUBJECTS} subjects")
    if not names:
        return None
    t = labelled(texts, labels, limit).combine_chunks()
    low, k = {s.lower(): i for i, s in enumerate(names)}, len(names)
    y = np.zeros((len(t), k))
    for i, (votes, judges) in enumerate(zip(t["votes"].to_pylist(), t["judges"].to_pylist())):
        for label, n in dict(votes).items():
            if label in low:
                y[i, low[label]] = n / judges
    keep = y.sum(1) > 0
    t, y = t.filter(pa.array(keep)).combine_chunks(), y[keep]
    if not len(t):
        return None
    column = lambda c: t[c].chunk(0) if t[c].num_chunks == 1 else pa.concat_arrays(t[c].chunks)
    b, title, looms = _bag_of(column("ids"), column("n")), _bag_of(column("title")), t["loom"].to_pylist()
    out = np.flatnonzero([zlib.crc32(p.encode()) % HELD_OUT == 0 for p in t["path"].to_pylist()])
    out = out if 0 < len(out) < len(t) else np.arange(len(t))  # a handful of labels serves for both
    every = _labelled_counts(b, y)
    own = [every, every - _labelled_counts(b.take(out), y[out]) if len(out) < len(t) else every]
    weights, before = [Weights(c) for c in own], None
    for _ in range(rounds):
        soft = [c * unlabelled_weight for c in _soft_counts(texts, weights)]
        weights = [Weights(o + s) for o, s in zip(own, soft)]
        if before is not None and np.abs(soft[0] - before).sum() <= SETTLED * soft[0].sum():
            break
        before = soft[0]
    model = Model(names, weights[0], hint_table(stats, names))
    y = y[out]
    x = Model(names, weights[1], model.hints).rows(b.take(out), title.take(out), [looms[i] for i in out])
    # Subjects share what a predictor means; each has its own level.
    flat = np.concatenate([x.reshape(-1, PREDICTORS), np.tile(np.eye(k), (len(y), 1))], 1)
    c = _logistic(flat, (y >= 0.5).reshape(-1) * 1.0)
    model.coefficients, model.level = c[:PREDICTORS], c[PREDICTORS:]
    p = model.posterior(x)
    order = np.sort(p, 1)
    second = order[:, -2] if k > 1 else np.zeros(len(y))
    which = np.argsort(p, 1)[:, -2] if k > 1 else np.zeros(len(y), int)
    hit = y[np.arange(len(y)), which] >= 0.5
    o = np.argsort(-second, kind="stable")
    gain = np.cumsum(np.where(hit[o], 1, -1))  # right second subjects less wrong ones
    best = int(gain.argmax()) if len(gain) else 0
    model.second = float(second[o[best]]) if len(gain) and gain[best] > 0 else 1.1
    model.held_out = (p, y)
    return model


def subject_areas(strands: DataFrame, labels: DataFrame, subjects: DataFrame, stats: DataFrame | None = None, limit: int = LABELLED) -> DataFrame:
    """path, subject, posterior: one row per strand and subject, for strands whose summary has at least WORDS blank-separated words.

    Each such strand gets its likeliest subject, and a second one where that subject's calibrated posterior reaches
    the limit found on held-out labels. A null title counts as empty; null paths and null or shorter summaries give no
    row; a path given twice gives one text. Without labels or subjects there are no rows.
    """
    s = materialise(encoded(_rated(strands)), "bags")  # read for the labels, once per round and for the result
    model = train(s, labels, subjects, stats, limit)
    if model is None:
        return s.where("false").select("path", F.lit("").alias("subject"), F.lit(0.0).alias("posterior"))
    model.held_out = None
    shared = strands.sparkSession.sparkContext.broadcast(model)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = np.array(m.subjects, object)
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                p = m.posterior(m.rows(_bag_of(part.column(2), part.column(3)), _bag_of(part.column(4)), part.column(1).to_pylist()))
                text, c = m.pick(p)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(text)), pa.array(names[c], pa.string()), pa.array(p[text, c])], names=["path", "subject", "posterior"])

    return s.mapInArrow(assign, "path string, subject string, posterior double")
