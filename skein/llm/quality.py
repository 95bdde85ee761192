"""Quality classifier from weak labels.

Overlapping heuristic labellers each vote on the documents that they have an
opinion on: those of faults vote junk or nothing, those of good prose vote
good or nothing. Votes are counted by pattern over all documents (two
outcomes of eleven labellers, at most 2,048 patterns); expectation-maximisation
on those counts estimates each labeller's accuracy and with that the
posterior probability of good for each pattern. The posteriors are the labels
that train a hashed linear scorer (word shapes, words and repetitions, as
shares of a document's words) by logistic regression in numpy, on a bounded
sample: every so manieth row by its hash, about ``SAMPLE`` to twice that, equal
rows once, as many as fit ``SAMPLE_BYTES`` in order of hash (a longer one is
left out, later ones may fit). The scorer scores every whole text.

Defined results: a null text counts as empty; a document without words gets
no votes and the score of the intercept, and is kept only if that is at least
the threshold. Rows
are scored one by one, so null keys and repeated rows need no care; an empty
table gives an empty one. Input columns named like an output give way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.llm.frames import col
from skein.llm.vec import SPACE, Words, in_parts, sums

SAMPLE = 6000      # documents that train the scorer, about
SAMPLE_BYTES = 64 << 20   # most bytes of text among them
BUCKETS = 1 << 12  # hashed features
EPOCHS = 200
KEEP = 0.3         # least score of a document that is kept
LABELLERS = ["symbols", "marks", "capitals", "bare_symbols", "tagged_words", "echoes", "runs", "repeated_lines",
             "odd_words", "plain", "flow"]   # the last two vote good, the others junk
GOOD = np.array([name in ("plain", "flow") for name in LABELLERS])
OUTPUTS = ["score", "keep", "posterior", "votes"]

_CLASS = np.full(256, 0, dtype=np.uint8)   # 0: separators and controls
_CLASS[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
_CLASS[0x41:0x5B] = 2
_CLASS[0x30:0x3A] = 3
_CLASS[[ord(c) for c in ".,;:'\"-()!?"]] = 4
_CLASS[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = 5
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[_CLASS == 1], _SHAPE[_CLASS == 2], _SHAPE[_CLASS == 3] = ord("x"), ord("X"), ord("9")
_NOT_LINE_END = np.ones(256, dtype=bool)
_NOT_LINE_END[10] = False


class Features:
    """Votes and hashed features of some texts."""

    def __init__(self, texts: list[str]):
        self.raw = [t.encode("utf-8") for t in texts]
        w = Words(self.raw, ~SPACE)
        self.words, n = w, np.maximum(w.counts, 1)
        texts_at = np.concatenate([w.text_starts, [len(w.buf)]])
        kinds = _CLASS[w.buf]
        lower, upper, digit, mark, symbol = (sums((kinds == k).view(np.int8), texts_at) for k in range(1, 6))
        shown = np.maximum(lower + upper + digit + mark + symbol, 1)
        self.hash = w.hashes()
        doc = w.text_of()
        # An echo is the word before it, or the one before that, once more.
        same = np.zeros(len(self.hash), dtype=bool)
        for back in (1, 2):
            same[back:] |= (self.hash[back:] == self.hash[:-back]) & (doc[back:] == doc[:-back])
        self.same = same
        run = np.zeros(len(self.hash), dtype=bool)
        run[2:] = (self.hash[2:] == self.hash[1:-1]) & (self.hash[2:] == self.hash[:-2]) & (doc[2:] == doc[:-2])
        # By the last two bytes of a word: plain ones end in a letter or in one mark after it.
        last = kinds[w.ends - 1] if len(w.ends) else np.zeros(0, dtype=np.uint8)
        prior = np.where(w.ends - w.starts > 1, kinds[np.maximum(w.ends - 2, 0)], 0) if len(w.ends) else last
        tagged = (last >= 4) & (prior >= 4)
        bare = (last >= 4) & (prior == 0)
        rate = lambda flags: sums(flags.view(np.int8), w.first) / n
        tags, bares, echo = rate(tagged), rate(bare), rate(same)
        lines = Words(self.raw, _NOT_LINE_END)
        at, key = lines.text_of(), lines.hashes()
        order = np.lexsort((key, at))
        again = np.zeros(len(key), dtype=bool)
        again[1:] = (key[order][1:] == key[order][:-1]) & (at[order][1:] == at[order][:-1])
        repeated = np.bincount(at[order][again], minlength=len(texts)) / np.maximum(lines.counts, 1)
        exclaim = sums((w.buf == ord("!")).view(np.int8), texts_at) / n
        symbols, capital = symbol / shown, upper / np.maximum(lower + upper, 1)
        mean = (lower + upper + digit) / n
        votes = np.stack([
            symbols > 0.05, exclaim > 0.25, capital > 0.4, bares > 0.08, tags > 0.15, echo > 0.12, rate(run) > 0.05,
            (repeated > 0.3) & (lines.counts > 2), (mean < 2) | (mean > 20) | (digit > 0.5 * shown),
            (symbols < 0.01) & (tags < 0.03) & (bares < 0.03) & (echo < 0.05),
            (symbols < 0.02) & (exclaim < 0.05) & (capital < 0.2) & (echo < 0.05) & (mean > 2.5) & (mean < 14)], axis=1)
        self.votes = votes & (w.counts >= 3)[:, None]

    def ids(self) -> tuple[np.ndarray, np.ndarray]:
        """Three hashed features of each word (rows) and its text."""
        w = self.words
        shape = _SHAPE[w.buf]
        turn = np.ones(len(shape), dtype=bool)
        turn[1:] = shape[1:] != shape[:-1]
        turn[w.starts] = True
        mask, top = np.uint64(BUCKETS // 2 - 1), BUCKETS // 2
        return np.stack([(w.hashes(buf=shape, where=turn) & mask).astype(np.int64),
                         top + 2 + ((self.hash & mask) % np.uint64(top - 2)).astype(np.int64),
                         top + self.same.astype(np.int64)], axis=1), w.text_of()

    def patterns(self) -> list[str]:
        signs = np.where(self.votes, np.where(GOOD, "1", "0"), "-")
        return ["".join(row) for row in signs.tolist()]


def estimate(counts: dict[str, int], rounds: int = 200) -> tuple[dict[str, float], np.ndarray]:
    """Posterior of good for each vote pattern, and the labellers' accuracies
    (how often a vote is right), by expectation-maximisation."""
    patterns = sorted(counts)
    accuracy, prior = np.full(len(LABELLERS), 0.9), 0.5
    if not patterns:
        return {}, accuracy
    votes = np.array([[{"0": -1, "1": 1, "-": 0}[c] for c in p] for p in patterns])
    n = np.array([counts[p] for p in patterns], dtype=float)
    for _ in range(rounds):
        odds = np.log(prior / (1 - prior)) + votes @ np.log(accuracy / (1 - accuracy))
        post = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
        right = np.where(votes > 0, post[:, None], 1 - post[:, None]) * (votes != 0) * n[:, None]
        # As if each labeller had been right in 9 votes of 10 before; none is taken for worse than chance.
        accuracy = np.clip((right.sum(0) + 9) / (((votes != 0) * n[:, None]).sum(0) + 10), 0.55, 0.99)
        prior = float(np.clip((post @ n + 1) / (n.sum() + 2), 0.05, 0.95))
    return dict(zip(patterns, post.tolist())), accuracy


def _train(ids: list[np.ndarray], shares: list[np.ndarray], target: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels over the whole sample (Adam), both
    classes weighing the same, then scaled so that its scores fit the labels."""
    w, b = np.zeros(BUCKETS), 0.0
    if not len(target) or target.min() >= 0.5 or target.max() < 0.5:
        return w, 6.0 if not len(target) or target.min() >= 0.5 else -6.0
    flat, value = np.concatenate(ids), np.concatenate(shares)
    row = np.repeat(np.arange(len(ids)), [len(i) for i in ids])
    junk = target < 0.5
    weight = np.where(junk, 0.5 / junk.sum(), 0.5 / (~junk).sum())
    m, v, mb, vb = np.zeros(BUCKETS), np.zeros(BUCKETS), 0.0, 0.0
    for t in range(1, EPOCHS + 1):
        z = b + np.bincount(row, w[flat] * value, minlength=len(target))
        g = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - target) * weight
        dw, db = np.bincount(flat, g[row] * value, minlength=BUCKETS) + 1e-6 * w, g.sum()
        m, v, mb, vb = 0.9 * m + 0.1 * dw, 0.99 * v + 0.01 * dw * dw, 0.9 * mb + 0.1 * db, 0.99 * vb + 0.01 * db * db
        rate = 0.3 * np.sqrt(1 - 0.99 ** t) / (1 - 0.9 ** t)
        w, b = w - rate * m / (np.sqrt(v) + 1e-8), b - rate * mb / (np.sqrt(vb) + 1e-8)
    z = b + np.bincount(row, w[flat] * value, minlength=len(target))
    # Scores of half: midway between the two classes' middles.
    low, high = np.median(z[junk]), np.median(z[~junk])
    scale = 8 / max(high - low, 1e-6)
    return w * scale, float((b - (low + high) / 2) * scale)


def fit(df: DataFrame, text: str = "text", sample: int = SAMPLE) -> dict:
    """The model: posteriors by pattern, accuracies, weights and intercept."""
    def patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in in_parts(batches, 0):
            seen, n = np.unique(np.array(Features(texts).patterns()), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(seen.tolist(), pa.string()), pa.array(n, pa.int64())], names=["votes", "n"])

    only = df.select(col(text).alias("text"))
    counted = only.mapInArrow(patterns, "votes string, n long").groupBy("votes").agg(F.sum("n").alias("n")).collect()
    counts = {r.votes: r.n for r in counted}
    posterior, accuracy = estimate(counts)
    every = max(1, sum(counts.values()) // sample)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in in_parts(batches, 0):
            f = Features(texts)
            ids, doc = f.ids()
            rows = []
            for i in range(len(texts)):
                own = ids[f.words.first[i]:f.words.first[i + 1]]
                which, n = np.unique(own, return_counts=True)
                rows.append((which, n / max(1, own.size)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(f.patterns(), pa.string()), pa.array([r[0] for r in rows], pa.list_(pa.int64())),
                 pa.array([r[1] for r in rows], pa.list_(pa.float64()))], names=["votes", "ids", "shares"])

    h = F.xxhash64(*map(col, df.columns))
    share = df.select(h.alias("h"), col(text).alias("text")).filter(F.pmod("h", F.lit(every)) == 0)
    # Sizes first (equal rows meet map-side), so that only the texts that fit are read by tasks and come here.
    sizes = share.groupBy("h").agg(F.max(F.coalesce(F.octet_length("text"), F.lit(0))).alias("size")).collect()
    fits, total = [], 0
    for r in sorted(sizes, key=lambda r: r.h):
        if total + r.size <= SAMPLE_BYTES:
            fits.append((r.h,))
            total += r.size
    chosen = F.broadcast(df.sparkSession.createDataFrame(fits, "h long"))   # about 2 x sample numbers at most
    rows = (share.join(chosen, "h").groupBy("h").agg(F.min("text").alias("text")).select("text")
            .mapInArrow(features, "votes string, ids array<long>, shares array<double>").collect())
    target = np.array([posterior[r.votes] for r in rows])
    w, b = _train([np.array(r.ids, dtype=np.int64) for r in rows], [np.array(r.shares) for r in rows], target)
    return {"posterior": posterior, "accuracy": accuracy, "weights": w, "intercept": b}


def score(df: DataFrame, model: dict, text: str = "text", threshold: float = KEEP) -> DataFrame:
    """The columns of ``df`` and ``score`` (0 to 1, higher is better),
    ``keep``, ``posterior`` (of the document's votes) and ``votes`` (one
    character for each of LABELLERS: 0 junk, 1 good, - none)."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    taken = set(OUTPUTS)
    kept = [c for c in df.columns if c.lower() not in taken]
    at, keep_at = df.columns.index(text), [df.columns.index(c) for c in kept]
    kinds = [T.DoubleType(), T.BooleanType(), T.DoubleType(), T.StringType()]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(o, k) for o, k in zip(OUTPUTS, kinds)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for part, texts in in_parts(batches, at):
            f = Features(texts)
            ids, _ = f.ids()
            z = m["intercept"] + sums(m["weights"][ids].sum(1), f.words.first) / np.maximum(f.words.counts * 3, 1)
            p = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
            votes = f.patterns()
            yield pa.RecordBatch.from_arrays(
                [*[part.column(i) for i in keep_at], pa.array(p, pa.float64()), pa.array(p >= threshold),
                 pa.array([m["posterior"].get(v) for v in votes], pa.float64()), pa.array(votes, pa.string())],
                names=[*kept, *OUTPUTS])

    return df.mapInArrow(run, schema)


def classify(df: DataFrame, text: str = "text", sample: int = SAMPLE, threshold: float = KEEP) -> DataFrame:
    """``score`` by a model that is fitted on ``df`` itself."""
    return score(df, fit(df, text, sample), text, threshold)
