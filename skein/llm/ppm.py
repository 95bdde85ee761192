"""Language-model scores by prediction by partial matching.

The model is a trie of byte contexts up to ``ORDER`` bytes with counts of the
bytes that followed them in the training documents. A byte is coded in its
longest context; where it was not seen there, an escape leads to the context
that is one byte shorter, without the symbols that the longer one has already
excluded, down to a uniform code over the bytes never seen. Escapes are
estimated by method D: a symbol seen c times among n has (2 c - 1) / 2 n, the
escape d / 2 n for d distinct symbols. Every text begins after ``ORDER`` bytes
FF, which UTF-8 never uses, and ends with one that is coded as well, so the
scores are those of a distribution over whole texts.

The trie is a table for each order, in Spark: the counts of the longest
grams (context and symbol, one 64-bit number) are gathered from all training
documents, combined in the tasks first, and each shorter order is their sum
by suffix. A key of one order has at most 256 in the next, so no join on it
is skewed. Scoring is one pass over the documents: the ``GRAMS`` most
frequent grams (a bounded table, broadcast) are summed in place, and only
occurrences of the rest are joined to the trie and summed by document.

The unigram baseline of the same documents (words in lower case, one end
each, add-one) is scored in the same pass, likewise with a bounded table of
the ``WORDS`` most frequent words. Words are told apart by 64-bit hashes.

Defined results: null texts count as empty, which still have an end to code;
without training documents every byte has 1/256 and the baseline 1 as its
chance; a row is scored by itself, whatever its key, and repeated rows train
as often as they come; an empty table gives an empty one. Only the named
columns are read, so none can clash.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.llm.frames import col, written
from skein.llm.vec import SPACE, Table, Words, in_parts, sums

ORDER = 5                # bytes of the longest context; 6 at most fit a gram's 64 bits
GRAMS, WORDS = 1 << 19, 1 << 18
PART = 256 << 10         # bytes of text that a worker works on at once
HELD = 600_000           # distinct keys that a counting task holds before it hands them on
_TABLES: dict[str, tuple] = {}   # of the job that a worker works on
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def gram_keys(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """The gram of every byte and end of the texts, and each text's first."""
    pad = b"\xff" * order
    flat = np.frombuffer(b"".join([x for t in texts for x in (pad, t, b"\xff")]), dtype=np.uint8)
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1
    starts = np.cumsum(lengths + order) - lengths - order
    real = np.ones(len(flat), dtype=bool)
    real[(starts[:, None] + np.arange(order)).ravel()] = False
    wide = flat.astype(np.uint64)
    g = wide[:len(flat) - order].copy()
    for i in range(1, order + 1):
        g <<= np.uint64(8)
        g |= wide[i:len(flat) - order + i]
    return g[real[order:]], np.cumsum(lengths) - lengths


def word_keys(texts: list[bytes]) -> Words:
    return Words([t.translate(_LOWER) for t in texts], ~SPACE)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, dtype=np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _counted(train: DataFrame, order: int) -> DataFrame:
    """(kind, key, n): grams (0) and words (1) of the texts (column text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _TABLES.clear()   # of an earlier job in this worker
        held: dict[int, list] = {0: [], 1: []}

        def handed_on():
            for kind, parts in held.items():
                if parts:
                    keys, counts = _merged(parts)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(keys), kind, dtype=np.int8)), pa.array(keys.view(np.int64)), pa.array(counts)],
                        names=["kind", "key", "n"])
                    parts.clear()

        for _, texts in in_parts(batches, 0, PART):
            raw = [t.encode("utf-8") for t in texts]
            for kind, keys in ((0, gram_keys(raw, order)[0]), (1, word_keys(raw).hashes())):
                held[kind].append(np.unique(keys, return_counts=True))
                if len(held[kind]) > 4:
                    held[kind] = [_merged(held[kind])]
            if sum(len(k) for parts in held.values() for k, _ in parts) > HELD:
                yield from handed_on()
        yield from handed_on()

    return (train.mapInArrow(run, "kind byte, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n")))


def _frequent(counts: DataFrame, most: int) -> int | None:
    """The least count whose keys, with all more frequent ones, are at most
    ``most`` (in steps of a sixteenth power of two)."""
    step = F.floor(F.log2("n") * 16).cast("int")
    steps = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("keys"), F.min("n").alias("least")).collect()
    least, held = None, 0
    for r in sorted(steps, key=lambda r: -r.step):
        held += r["keys"]
        if held > most:
            break
        least = r.least
    return least


class Trie:
    """The tables of a trained model, from the longest order to 0: ``grams``
    (key, n) and ``contexts`` (ctx, n, d, n_left, d_left: what the next
    shorter context holds beyond this one's symbols)."""

    def __init__(self, top: DataFrame, order: int):
        self.order, self.grams, self.contexts = order, {order: top}, {}
        for j in range(order - 1, -1, -1):
            mask = (1 << 8 * (j + 1)) - 1
            shorter = self.grams[j + 1].groupBy(F.col("key").bitwiseAND(F.lit(mask)).alias("key")).agg(F.sum("n").alias("n"))
            self.grams[j] = written(shorter, f"ppm-order{j}")
        total = self.grams[0].agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("d")).first()
        self.n, self.d = total.n or 0, total.d
        for j in range(1, order + 1):
            mask = (1 << 8 * j) - 1
            lower = self.grams[j - 1].select(F.col("key").alias("low"), F.col("n").alias("low_n"))
            own = (self.grams[j].withColumn("low", F.col("key").bitwiseAND(F.lit(mask))).join(lower, "low")
                   .groupBy(F.shiftright("key", 8).alias("ctx"))
                   .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("d"), F.sum("low_n").alias("taken")))
            if j == 1:
                own = own.withColumns({"up_n": F.lit(self.n), "up_d": F.lit(self.d)})
            else:
                up = self.contexts[j - 1].select(F.col("ctx").alias("up"), F.col("n").alias("up_n"), F.col("d").alias("up_d"))
                own = own.withColumn("up", F.col("ctx").bitwiseAND(F.lit((1 << 8 * (j - 1)) - 1))).join(up, "up")
            self.contexts[j] = written(own.select("ctx", "n", "d", (F.col("up_n") - F.col("taken")).alias("n_left"),
                                                  (F.col("up_d") - F.col("d")).alias("d_left")), f"ppm-contexts{j}")

    def code(self, keys: DataFrame) -> DataFrame:
        """(key, logp): log10 of the probability of each gram's symbol."""
        left = keys.select("key", F.lit(0.0).alias("acc"), F.lit(None).cast("long").alias("n_left"),
                           F.lit(None).cast("long").alias("d_left"))
        found = []
        for j in range(self.order, -1, -1):
            own = F.col("key").bitwiseAND(F.lit((1 << 8 * (j + 1)) - 1))
            grams = self.grams[j].select(F.col("key").alias("own"), F.col("n").alias("c"))
            step = left.withColumn("own", own).join(grams, "own", "left")
            if j:
                step = step.withColumn("ctx", F.shiftright("own", 8)).join(
                    self.contexts[j].select("ctx", "n", "d", F.col("n_left").alias("n_next"), F.col("d_left").alias("d_next")),
                    "ctx", "left")
            else:
                none = F.lit(None).cast("long")
                step = step.withColumns({"n": F.lit(self.n).cast("long"), "d": F.lit(self.d).cast("long"), "n_next": none, "d_next": none})
            n, d = F.coalesce("n_left", "n"), F.coalesce("d_left", "d")
            step = written(step.select(
                "key", F.when(F.col("c") > 0, F.col("acc") + F.log10((2 * F.col("c") - 1) / (2 * n))).alias("logp"),
                (F.col("acc") + F.when((n > 0) & (d > 0), F.log10(d / (2 * n))).otherwise(0.0)).alias("acc"),
                F.col("n_next").alias("n_left"), F.col("d_next").alias("d_left")), "ppm-code")
            found.append(step.filter(F.col("logp").isNotNull()).select("key", "logp"))
            left = step.filter(F.col("logp").isNull()).drop("logp")
        found.append(left.select("key", (F.col("acc") - float(np.log10(max(1, 256 - self.d)))).alias("logp")))
        out = found[0]
        for x in found[1:]:
            out = out.unionByName(x)
        return out

    def frequent(self, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys and log10 probabilities of the most frequent longest grams."""
        top, least = self.grams[self.order], _frequent(self.grams[self.order], most)
        if least is None:
            return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.float64)
        rows = (top.filter(F.col("n") >= least).select("key", F.shiftright("key", 8).alias("ctx"), F.col("n").alias("c"))
                .join(self.contexts[self.order], "ctx")
                .select("key", F.log10((2 * F.col("c") - 1) / (2 * F.col("n"))).alias("logp")).toArrow())
        return rows.column("key").to_numpy().astype(np.int64).view(np.uint64), rows.column("logp").to_numpy()


def _tables(name: str, shared) -> tuple:
    if name not in _TABLES:
        _TABLES.clear()
        grams, words, scale, end = shared.value
        _TABLES[name] = (Table(*grams), Table(words[0], np.log10((words[1] + 1) / scale)), end)
    return _TABLES[name]


def score(df: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", order: int = ORDER,
          grams: int = GRAMS, words: int = WORDS) -> DataFrame:
    """One row for each row of ``df``: ``key``, ``learned`` (whether it
    trained, by the expression ``learn``), ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score`` and ``score`` (log10 probabilities)."""
    sc = df.sparkSession.sparkContext
    rows = df.select(F.monotonically_increasing_id().alias("rid"), col(key).alias("key"),
                     F.coalesce(learn, F.lit(False)).alias("learned"), col(text).alias("text"))
    counts = written(_counted(rows.filter("learned").select("text"), order), "ppm-counts")
    n_docs = rows.filter("learned").count()
    trie = Trie(counts.filter("kind = 0").select("key", "n"), order)
    vocabulary = counts.filter("kind = 1").select("key", "n")
    total = vocabulary.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    tokens, distinct = (total.n or 0) + n_docs, total.v + (n_docs > 0)
    scale = float(tokens + distinct + 1)
    least = _frequent(vocabulary, words)
    top = vocabulary.filter(F.col("n") >= least).toArrow() if least is not None else None
    known = (top.column("key").to_numpy().astype(np.int64).view(np.uint64), top.column("n").to_numpy().astype(np.float64)) \
        if top is not None else (np.zeros(0, dtype=np.uint64), np.zeros(0))
    shared = sc.broadcast((trie.frequent(grams), known, scale, float(np.log10((n_docs + 1) / scale))))
    name, end_known = uuid.uuid4().hex, int(n_docs > 0)
    key_field = rows.schema["key"]
    schema = T.StructType([T.StructField("kind", T.ByteType()), T.StructField("rid", T.LongType()), T.StructField("rare", T.LongType()),
                           key_field, T.StructField("learned", T.BooleanType()), T.StructField("n_tokens", T.LongType()),
                           T.StructField("n_known", T.LongType()), T.StructField("base", T.DoubleType()),
                           T.StructField("logp", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, lexicon, end = _tables(name, shared)
        for part, texts in in_parts(batches, 3, PART):
            raw = [t.encode("utf-8") for t in texts]
            g, first = gram_keys(raw, order)
            logp, held = table.get(g)
            logp[~held] = 0
            w = word_keys(raw)
            h = w.hashes()
            base, seen = lexicon.get(h)
            base[~seen] = 0
            rid = part.column(0).to_numpy()
            of = np.repeat(np.arange(len(texts)), np.diff(np.append(first, len(g))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(texts), 2, dtype=np.int8)), part.column(0), pa.nulls(len(texts), pa.int64()), part.column(1),
                 part.column(2), pa.array(w.counts + 1), pa.array(sums(seen.astype(np.int64), w.first) + end_known),
                 pa.array(sums(base, w.first) + end), pa.array(np.add.reduceat(logp, first))], names=schema.names)
            for kind, keys, owner in ((0, g[~held], of[~held]), (1, h[~seen], w.text_of()[~seen])):
                n = len(keys)
                none = lambda t: pa.nulls(n, t)  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, kind, dtype=np.int8)), pa.array(rid[owner]), pa.array(keys.view(np.int64)),
                     none(part.column(1).type), none(pa.bool_()), none(pa.int64()), none(pa.int64()), none(pa.float64()),
                     none(pa.float64())], names=schema.names)

    first = written(rows.mapInArrow(run, schema), "ppm-scores")
    rare = first.filter("kind = 0").select("rid", "rare")
    coded = trie.code(rare.select(F.col("rare").alias("key")).distinct())
    none = F.lit(None)
    per_gram = (rare.join(coded.withColumnRenamed("key", "rare"), "rare")
                .select("rid", none.cast(key_field.dataType).alias("key"), none.cast("boolean").alias("learned"),
                        none.cast("long").alias("n_tokens"), F.lit(0).cast("long").alias("n_known"), F.lit(0.0).alias("base"), "logp"))
    count = F.coalesce(F.col("n"), F.lit(0))
    per_word = (first.filter("kind = 1").select("rid", "rare").join(vocabulary.withColumnRenamed("key", "rare"), "rare", "left")
                .select("rid", none.cast(key_field.dataType).alias("key"), none.cast("boolean").alias("learned"),
                        none.cast("long").alias("n_tokens"), (count > 0).cast("long").alias("n_known"),
                        F.log10((count + 1) / scale).alias("base"), F.lit(0.0).alias("logp")))
    whole = first.filter("kind = 2").select("rid", "key", "learned", "n_tokens", "n_known", "base", "logp")
    return (whole.unionByName(per_gram).unionByName(per_word).groupBy("rid")
            .agg(F.max("key").alias(key), F.max("learned").alias("learned"), F.max("n_tokens").alias("n_tokens"),
                 F.sum("n_known").alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
                 F.sum("base").alias("base_score"), F.sum("logp").alias("score")).drop("rid"))

