"""Toxicity by a small convolutional text classifier, trained in numpy.

A word's embedding is the sum of three rows of one hashed table: of the word
and of its first four and six bytes (so that unseen forms of a known stem are
near it). Filters of widths 1, 2 and 3 run over a document's words, each is
max-pooled over the whole text, and a logistic layer gives the score.

Training: a bounded sample of labelled rows (about ``SAMPLE`` a class and
at most ``SAMPLE_BYTES`` of text, by a hash of the key) goes to the driver,
where backpropagation through the pooled positions with AdaGrad fits
embeddings, filters and output, with words dropped at random so that no single
one decides. ``FOLDS`` classifiers are trained, each without one part of the
sample, and the mean of their logits is the raw score; so every row
of the sample trains. Then every labelled row that may be learned from, in the
sample or not, gets a logit of a classifier that has not seen it, in Spark
tasks that move no text; counts of rows and toxic rows by language and 1/``STEPS`` of a logit
come back. On these the raw scores are calibrated (a rising logistic curve),
so that a score is a probability. Labels, language, source and key are never
inputs of a score.

Thresholds: the same counts give, for each language, the threshold of
best F1 (languages with too few toxic rows use the one of all languages);
they decide ``flagged``, never ``score``.

Defined results: a null or empty text has no words, its score is that of the
intercept; with labels of one class only (or none) every score is the share
of toxic labels (0 without labels). A key with several labels is toxic if one
says so; repeated rows are scored each; an empty table gives an empty one.
Input columns named like an output give way.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.llm.frames import col, unpacked, written
from skein.llm.vec import ALNUM, Words, in_parts

SAMPLE = 2500              # labelled rows of each class, about (less than twice as many)
SAMPLE_BYTES = 24 << 20    # text of the sample, at most
ROWS, DIM, FILTERS, WIDTHS = 1 << 15, 16, 8, (1, 2, 3)
STEMS = (None, 4, 6)       # what of a word is hashed: all, or its first bytes
EPOCHS, BATCH, RATE, SEED = 4, 32, 0.08, 42
FOLDS, DROPPED = 3, 0.3    # parts of the sample; share of words left out of a text in training
STEPS = 256                # counts of logits: so many to a unit
LEAST_TOXIC = 10           # toxic rows that a language needs for a threshold of its own
OUTPUTS = ["score", "flagged", "threshold"]


def word_rows(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Embedding rows of each word (words, stems), and the first word of each text."""
    w = Words([t.lower().encode("utf-8") for t in texts], ALNUM)
    mask = np.uint64(ROWS - 1)
    return np.stack([((w.hashes(upto=n) >> np.uint64(8 * i)) & mask).astype(np.int32)
                     for i, n in enumerate(STEMS)], axis=1), w.first


def _chance(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


class Model:
    """Parameters, scoring and training of one classifier."""

    def __init__(self, base: float = 0.0):
        rnd = np.random.default_rng(SEED)
        self.table = rnd.normal(0, 0.05, (ROWS, DIM)).astype(np.float32)
        self.filters = [rnd.normal(0, 0.2, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.out = np.full(FILTERS * len(WIDTHS), 0.1, dtype=np.float32)
        self.bias, self.base = 0.0, base   # base: the score while nothing is trained
        self.trained = False

    def maps(self, rows: np.ndarray) -> np.ndarray:
        """Filter outputs at every word; a filter that would reach beyond the
        last word of ``rows`` sees nothing there."""
        x = self.table[rows[:, 0]]
        for i in range(1, rows.shape[1]):
            x = x + self.table[rows[:, i]]
        flat = x @ np.concatenate([f for own in self.filters for f in own], axis=1)
        out, at = np.zeros((len(x), FILTERS * len(WIDTHS)), dtype=np.float32), 0
        for k, w in enumerate(WIDTHS):
            for j in range(w):
                out[:len(x) - j, k * FILTERS:(k + 1) * FILTERS] += flat[j:, at:at + FILTERS]
                at += FILTERS
        return out

    def pooled(self, rows: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Rectified maxima of each text; windows do not cross texts."""
        n = np.diff(first)
        top = np.zeros((len(n), FILTERS * len(WIDTHS)), dtype=np.float32)
        if not len(rows):
            return top
        m = self.maps(rows)
        ends = first[1:][n > 0]
        for k, w in enumerate(WIDTHS):
            for back in range(1, w):   # a window that would begin here leaves its text
                at = ends - back
                m[at[at >= first[:-1][n > 0]], k * FILTERS:(k + 1) * FILTERS] = 0
        top[n > 0] = np.maximum(np.maximum.reduceat(m, first[:-1][n > 0], axis=0), 0)
        return top

    def logits(self, rows: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Of texts given by their words' rows."""
        z, step, start = np.empty(len(first) - 1), 40_000, 0   # words at once, so that maps stay in the cache
        while start < len(z):
            end = max(start + 1, int(np.searchsorted(first, first[start] + step, "right")) - 1)
            part = rows[first[start]:first[end]]
            z[start:end] = self.pooled(part, first[start:end + 1] - first[start]) @ self.out + self.bias
            start = end
        return z

    def scores(self, texts: list[str]) -> np.ndarray:
        if not self.trained:
            return np.full(len(texts), self.base)
        return _chance(self.logits(*word_rows(texts)))

    def train(self, docs: list[np.ndarray], y: np.ndarray, epochs: int = EPOCHS, dropped: float = DROPPED) -> None:
        rnd = np.random.default_rng(SEED)
        self.trained = True
        # Start: the first dimension of a row is how much likelier toxic texts hold it.
        held = np.zeros((2, ROWS))
        for d, c in zip(docs, y):
            held[int(c), np.unique(d)] += 1
        odds = np.log((held[1] + 0.5) / (y.sum() + 1)) - np.log((held[0] + 0.5) / (len(y) - y.sum() + 1))
        self.table[:, 0] += np.clip(odds * (held.sum(0) >= 3), -1, 3).astype(np.float32) / 3
        for f in self.filters:
            f[:, 0, :] += 0.5 / len(f)
        squares = [np.full(p.shape, 1e-6, dtype=np.float32) for p in (self.table, *self.filters, self.out)] + [1e-6]
        params = [self.table, *self.filters, self.out]
        for _ in range(epochs):
            order = rnd.permutation(len(docs))
            for at in range(0, len(order), BATCH):
                batch = order[at:at + BATCH]
                grads, db = self._gradients([docs[i][rnd.random(len(docs[i])) >= dropped] for i in batch], y[batch])
                for p, g, s in zip(params, grads, squares):
                    s += g * g
                    p -= RATE * g / np.sqrt(s)
                squares[-1] += db * db
                self.bias -= RATE * db / np.sqrt(squares[-1])

    def _gradients(self, docs: list[np.ndarray], y: np.ndarray):
        first = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
        rows = np.concatenate(docs)
        maps = self.maps(rows) if len(rows) else None
        top, where = np.zeros((len(docs), len(self.out)), dtype=np.float32), np.zeros((len(docs), len(self.out)), dtype=np.int64)
        for i, (s, e) in enumerate(zip(first, first[1:])):
            for k, w in enumerate(WIDTHS):
                own = slice(k * FILTERS, (k + 1) * FILTERS)
                last = e - w + 1
                if last > s:
                    where[i, own] = s + maps[s:last, own].argmax(0)
                    top[i, own] = maps[where[i, own], np.arange(own.start, own.stop)]
        top = np.maximum(top, 0)
        p = 1 / (1 + np.exp(-np.clip(top @ self.out + self.bias, -50, 50)))
        dz = ((p - y) / len(docs)).astype(np.float32)
        back = dz[:, None] * self.out * (top > 0)
        d_table = np.zeros_like(self.table)
        d_filters = [np.zeros_like(f) for f in self.filters]
        for k, w in enumerate(WIDTHS):
            own = slice(k * FILTERS, (k + 1) * FILTERS)
            i, f = np.nonzero(back[:, own])
            g = back[:, own][i, f]
            for j in range(w):
                at = where[:, own][i, f] + j
                x = self.table[rows[at]].sum(1)
                np.add.at(d_filters[k][j].T, f, g[:, None] * x)
                dx = g[:, None] * self.filters[k][j].T[f]
                for r in range(rows.shape[1]):
                    np.add.at(d_table, rows[at, r], dx)
        return [d_table, *d_filters, top.T @ dz], float(dz.sum())


class Ensemble:
    """Classifiers whose mean logit, on a calibrated curve, is the score."""

    def __init__(self, models: list[Model], slope: float = 1.0, shift: float = 0.0):
        self.models, self.slope, self.shift = models, slope, shift
        self.trained = any(m.trained for m in models)

    def scores(self, texts: list[str]) -> np.ndarray:
        if not self.trained:
            return self.models[0].scores(texts)
        rows, first = word_rows(texts)
        return self.calibrated(np.mean([m.logits(rows, first) for m in self.models], axis=0))

    def calibrated(self, z: np.ndarray) -> np.ndarray:
        return _chance(self.slope * z + self.shift)


def calibrated(z: np.ndarray, y: np.ndarray, n: np.ndarray | None = None) -> tuple[float, float]:
    """Slope (above 0) and shift of the logistic curve through the logits, by
    Newton steps on smoothed labels with a weak pull towards slope 1. With
    ``n``, each entry stands for so many rows, ``y`` of them toxic."""
    n = np.ones(len(y)) if n is None else n
    pos = y.sum()
    aim = y * (pos + 1) / (pos + 2) + (n - y) / (n.sum() - pos + 2)
    z, at = np.clip(z, -30, 30), np.array([1.0, 0.0])

    def loss(v):
        x = v[0] * z + v[1]
        return np.sum(n * np.logaddexp(0, x) - aim * x) + (v[0] - 1) ** 2

    for _ in range(60):
        p = _chance(at[0] * z + at[1])
        w, g = n * p * (1 - p) + 1e-9, n * p - aim
        step = np.linalg.solve([[np.sum(w * z * z) + 2, np.sum(w * z)], [np.sum(w * z), np.sum(w) + 1e-6]],
                               [np.sum(g * z) + 2 * (at[0] - 1), np.sum(g)])
        while loss(at - step) > loss(at) and np.abs(step).max() > 1e-9:
            step /= 2
        at = at - step
        if np.abs(step).max() < 1e-9:
            break
    return max(float(at[0]), 0.01), float(at[1])


def best_threshold(scores: np.ndarray, y: np.ndarray, n: np.ndarray | None = None) -> float:
    """The threshold of best F1; among equals the middle of the gap. With
    ``n``, each score stands for so many rows, ``y`` of them toxic."""
    n = np.ones(len(y)) if n is None else n
    order = np.argsort(-scores, kind="stable")
    s, hit = scores[order], np.cumsum(y[order])
    f1 = 2 * hit / (np.cumsum(n[order]) + y.sum())
    f1[:-1][s[:-1] == s[1:]] = -1   # equal scores fall on one side
    at = int(np.argmax(f1))
    below = s[at + 1] if at + 1 < len(s) else 0.0
    return float((s[at] + below) / 2)


def logits(df: DataFrame, models: list[Model], folds: dict, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(row, k, lang, z, unseen): each row's columns but the text, the mean
    logit of all classifiers and that of the one that has not trained on its
    key; ``folds`` has those of the sample's keys. Texts are read here once
    and stay where they are: what follows moves numbers."""
    shared = df.sparkSession.sparkContext.broadcast((models, folds))
    rows = df.select(F.struct(*[col(c) for c in df.columns if c != text]).alias("row"), col(key).alias("k"),
                     col(lang).cast("string").alias("lang"), col(text).alias("t"))
    schema = T.StructType([*rows.schema.fields[:3], T.StructField("z", T.DoubleType()), T.StructField("unseen", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, of = shared.value
        for part, texts in in_parts(batches, 3):
            fold = np.array([of[k] if k in of else zlib.crc32(str(k).encode()) % FOLDS for k in part.column(1).to_pylist()], dtype=int)
            words = word_rows(texts)
            z = np.array([m.logits(*words) for m in own])
            yield pa.RecordBatch.from_arrays([*[part.column(i) for i in range(3)], pa.array(np.mean(z, axis=0)),
                                              pa.array(z[fold, np.arange(len(texts))])], names=schema.names)

    return rows.mapInArrow(run, schema)


def unseen_counts(rows: DataFrame, known: DataFrame) -> list:
    """Of all ``rows`` of ``logits`` whose key is in ``known`` (k, y): (lang,
    z, y, n), how many rows and toxic ones have an unseen logit near z (a
    step's middle)."""
    near = (rows.select("k", "lang", F.least(F.greatest("unseen", F.lit(-30.0)), F.lit(30.0)).alias("z")).join(known, "k")
            .groupBy("lang", F.floor(F.col("z") * STEPS).alias("step")))
    return (near.agg(F.sum("y").alias("y"), F.count(F.lit(1)).alias("n")).orderBy("lang", "step")
            .select("lang", ((F.col("step") + 0.5) / STEPS).alias("z"), "y", "n").collect())


def classifiers(df: DataFrame, labels: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", lang: str = "lang",
                label: str = "toxic", sample: int = SAMPLE) -> tuple[list[Model], dict, DataFrame]:
    """The classifiers (one untrained one if the labels do not do), the folds
    of the sample's keys and the labels (k, y) that may be learned from."""
    known = (labels.filter(learn & col(key).isNotNull() & col(label).isNotNull())
             .groupBy(col(key).alias("k")).agg(F.max(col(label).cast("int")).alias("y")))
    totals = {r.y: r.n for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    pos, neg = totals.get(1, 0), totals.get(0, 0)
    if not pos or not neg:
        return [Model(1.0 if pos else 0.0)], {}, known
    # Of each class every so manieth key by its hash: about ``sample``, less than twice that.
    every = {1: max(1, pos // sample), 0: max(1, neg // sample)}
    chosen = known.filter(F.pmod(F.xxhash64("k"), F.when(F.col("y") == 1, every[1]).otherwise(every[0])) == 0).collect()
    spark = df.sparkSession
    ids = F.broadcast(spark.createDataFrame([(r.k, r.y) for r in chosen], known.schema))   # less than 4 x sample rows
    rows = (df.select(col(key).alias("k"), col(text).alias("t"), col(lang).cast("string").alias("lang"),
                      F.octet_length(col(text)).alias("size")).join(ids, "k"))
    # A first look at sizes alone keeps the sample within its bytes.
    sizes = rows.groupBy("k").agg(F.sum(F.coalesce("size", F.lit(0))).alias("size")).collect()
    fits, total = set(), 0
    for k, size in sorted(sizes, key=lambda r: (zlib.crc32(str(r[0]).encode()), str(r[0]))):
        if total + size <= SAMPLE_BYTES:   # a key whose texts do not fit is left out, later ones may fit
            fits.add(k)
            total += size
    fits = F.broadcast(spark.createDataFrame([(k,) for k in sorted(fits)], known.select("k").schema))
    got = sorted(rows.join(fits, "k").select("k", "t", "lang", "y").collect(), key=lambda r: (r.k, r.t or ""))
    y = np.array([r.y for r in got], dtype=np.float32)
    docs = []
    for start in range(0, len(got), 200):
        ids_, first = word_rows([r.t or "" for r in got[start:start + 200]])
        docs += [ids_[a:b] for a, b in zip(first, first[1:])]
    places = {k: i for i, k in enumerate(dict.fromkeys(r.k for r in got))}
    part = np.array([places[r.k] % FOLDS for r in got])   # rows of one key are left out together
    if any(len(set(y[part != k])) < 2 for k in range(FOLDS)):
        return [Model(pos / (pos + neg))], {}, known
    models = []
    for k in range(FOLDS):
        models.append(Model())
        models[k].train([d for d, p in zip(docs, part) if p != k], y[part != k])
    return models, {k: i % FOLDS for k, i in places.items()}, known


def decided(models: list[Model], rows: DataFrame, known: DataFrame) -> tuple[Ensemble, dict]:
    """The calibrated model and its thresholds by language (None: all), from
    the unseen logits of the labelled ``rows``."""
    counts = unseen_counts(rows, known)
    z, hit, n = (np.array([r[c] for r in counts], dtype=float) for c in ("z", "y", "n"))
    langs = np.array([str(r.lang) for r in counts])
    slope, shift = calibrated(z, hit, n)
    s = _chance(slope * z + shift)
    thresholds = {None: best_threshold(s, hit, n)}
    for l in set(langs):
        if hit[langs == l].sum() >= LEAST_TOXIC:
            thresholds[l] = best_threshold(s[langs == l], hit[langs == l], n[langs == l])
    model = Ensemble(models, slope, shift)
    return model, thresholds


def fit(df: DataFrame, labels: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", lang: str = "lang",
        label: str = "toxic", sample: int = SAMPLE) -> tuple[Ensemble, dict]:
    """The model and its thresholds by language (None: all), learned from the
    labelled rows for which ``learn`` (an expression over ``labels``) holds."""
    models, folds, known = classifiers(df, labels, learn, key, text, lang, label, sample)
    if not models[0].trained:
        return Ensemble(models), {None: 0.5}
    return decided(models, logits(df, models, folds, key, text, lang), known)


def classify(df: DataFrame, labels: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", lang: str = "lang",
             label: str = "toxic", sample: int = SAMPLE) -> DataFrame:
    """What ``score`` gives by the model of ``fit``, without the text: every
    text meets the classifiers once, for calibration and for its score."""
    models, folds, known = classifiers(df, labels, learn, key, text, lang, label, sample)
    if not models[0].trained:
        return score(df, Ensemble(models), {None: 0.5}, text, lang).drop(col(text))
    rows = written(logits(df, models, folds, key, text, lang), "logits")
    shared = df.sparkSession.sparkContext.broadcast(decided(models, rows, known))
    kinds = [T.DoubleType(), T.BooleanType(), T.DoubleType()]
    rows = rows.select("row", "lang", "z")
    schema = T.StructType([rows.schema["row"], *[T.StructField(o, k) for o, k in zip(OUTPUTS, kinds)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, by_lang = shared.value
        for part in batches:
            s = m.calibrated(part.column(2).to_numpy(zero_copy_only=False))
            limit = np.array([by_lang.get(str(x), by_lang[None]) for x in part.column(1).to_pylist()], dtype=float)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(s, pa.float64()), pa.array(s >= limit), pa.array(limit, pa.float64())],
                                             names=schema.names)

    return unpacked(rows.mapInArrow(run, schema), [c for c in df.columns if c != text], OUTPUTS)


def score(df: DataFrame, model: Ensemble, thresholds: dict, text: str = "text", lang: str = "lang") -> DataFrame:
    """The columns of ``df`` and ``score`` (0 to 1), ``flagged`` and the
    ``threshold`` of the row's language that decided it."""
    shared = df.sparkSession.sparkContext.broadcast((model, thresholds))
    kept = [c for c in df.columns if c.lower() not in OUTPUTS]
    keep_at = [df.columns.index(c) for c in kept]
    at, lang_at = df.columns.index(text), df.columns.index(lang)
    kinds = [T.DoubleType(), T.BooleanType(), T.DoubleType()]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(o, k) for o, k in zip(OUTPUTS, kinds)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, by_lang = shared.value
        for part, texts in in_parts(batches, at):
            s = m.scores(texts)
            limit = np.array([by_lang.get(str(x), by_lang[None]) for x in part.column(lang_at).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [*[part.column(i) for i in keep_at], pa.array(s, pa.float64()), pa.array(s >= limit), pa.array(limit, pa.float64())],
                names=[*kept, *OUTPUTS])

    return df.mapInArrow(run, schema)
