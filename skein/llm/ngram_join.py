"""N-gram Jaccard join with Bayesian candidate pruning.

Documents are sets of hashed word n-grams (five words, in lower case); two
are linked when the Jaccard similarity of their sets is at least the
threshold. Documents with the same set are copies and are joined as one; a
class is what links connect.

1. One pass makes each document's set digest and MinHash values (``HASHES``
   of 32 bits); copies collapse on the digest, map-side first.
2. Sets that share a band of ``BAND`` values fall together (at 128 values in
   bands of 4 a pair of similarity 0.8 is missed with probability 5e-8).
   Buckets give star-shaped links, never pairs, and connected components of
   these are the blocks in which candidates are sought.
3. Components are cut by hash into chunks of bounded size, and every two
   chunks of a component meet in one cell (small components share a cell).
   In a cell MinHash values are compared in steps of ``STEP``: with m of n
   equal the similarity has the posterior Beta(m + 1, n - m + 1), and a pair
   is dropped as soon as the probability of reaching the threshold falls
   below ``TOLERANCE``. The pairs left are verified exactly on their sets.
4. A cell returns one row for each linked set (its number of linked
   documents and one link of a spanning tree), so no plan node holds pairs;
   components of the tree links are the classes.

Defined results: null and empty texts (and texts of white space) have the
empty set and are copies of each other, linked to nothing else; texts shorter
than n words have one n-gram, all their words; a null key ranks last for the
names of classes; repeated rows are copies. An empty table gives an empty
one. Only the named columns reach the result, so none can clash.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.llm.frames import col, field, packed, partitions, written
from skein.llm.graph import components
from skein.llm.vec import SPACE, Words, in_parts, mixed, powers

WORDS, THRESHOLD = 5, 0.8
HASHES, BAND, STEP, TOLERANCE = 128, 4, 16, 1e-6
CHUNK_SETS, CHUNK_GRAMS = 400, 400_000   # of a chunk, about
_RND = np.random.default_rng(20)
_A = (_RND.integers(0, 1 << 32, HASHES, dtype=np.uint32) | 1)[:, None]
_B = _RND.integers(0, 1 << 32, HASHES, dtype=np.uint32)[:, None]


def gram_sets(texts: list[str], n: int = WORDS) -> list[np.ndarray]:
    """The sorted hashed n-grams of each text."""
    w = Words([t.lower().encode("utf-8") for t in texts], ~SPACE)
    h, k = w.hashes(), w.counts
    base = powers(n + 1)
    whole = np.zeros(max(0, len(h) - n + 1), dtype=np.uint64)
    for i in range(n):
        whole += h[i:len(h) - n + 1 + i] * base[i] if len(h) >= n else whole
    whole, sets = mixed(whole), []
    for a, c in zip(w.first, k):
        if c >= n:
            sets.append(np.unique(whole[a:a + c - n + 1]))
        elif c:
            sets.append(mixed((h[a:a + c] * base[:c]).sum(keepdims=True) + np.uint64(c)))
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
    return sets


def min_hashes(grams: np.ndarray) -> np.ndarray:
    """HASHES least values of affine maps of the n-grams' 32-bit hashes."""
    x = (grams >> np.uint64(32)).astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(x), 2048):
        y = x[at:at + 2048] * _A
        y += _B
        y ^= y >> np.uint32(15)
        y *= np.uint32(0x2C1B3C6D)
        np.minimum(out, y.min(axis=1), out=out)
    return out


def least_matches(n: int, threshold: float, tolerance: float) -> int:
    """The fewest equal values among n with which the posterior probability
    of reaching the threshold is at least the tolerance. For Beta(m + 1,
    n - m + 1) that probability is P(Binomial(n + 1, threshold) <= m)."""
    total = 0.0
    for m in range(n + 2):
        total += math.comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        if total >= tolerance:
            return m
    return n + 1


def linked(sets: list[np.ndarray], hashes: np.ndarray, left: np.ndarray, right: np.ndarray, threshold: float = THRESHOLD,
           tolerance: float = TOLERANCE):
    """The linked pairs (i, j) of ``left`` x ``right`` (indexes; pairs with
    i < j if they are the same), one array of partners for each i."""
    same = left is right
    steps = [(n, least_matches(n, threshold, tolerance)) for n in range(STEP, HASHES + 1, STEP)]
    vocabulary, flat = np.unique(np.concatenate([sets[i] for i in (left if same else np.concatenate([left, right]))]),
                                 return_inverse=True)
    size = np.array([len(sets[i]) for i in (left if same else np.concatenate([left, right]))])
    start = np.cumsum(size) - size
    ids = [flat[s:s + n] for s, n in zip(start, size)]
    shift = 0 if same else len(left)
    mark = np.zeros(len(vocabulary), dtype=bool)
    for a, i in enumerate(left):
        others = np.arange(a + 1, len(right)) if same else np.arange(len(right))
        # No similarity is above the ratio of the sizes.
        n, m = size[a], size[others + shift]
        others = others[np.minimum(n, m) >= threshold * np.maximum(n, m) - 1e-9]
        equal, done = np.zeros(len(others), dtype=np.int32), 0
        for upto, least in steps:
            equal += (hashes[right[others], done:upto] == hashes[i, done:upto]).sum(1, dtype=np.int32)
            keep = equal >= least
            others, equal, done = others[keep], equal[keep], upto
            if not len(others):
                break
        if not len(others):
            continue
        mark[ids[a]] = True
        own = [ids[o + shift] for o in others]
        lengths = size[others + shift]
        common = np.add.reduceat(mark[np.concatenate(own)].astype(np.int32), np.cumsum(lengths) - lengths)
        mark[ids[a]] = False
        others = others[common >= threshold * (size[a] + lengths - common) - 1e-9]
        if len(others):
            yield i, right[others]


def _cell(pdf: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links within one cell: (node, links, parent) of each linked set."""
    pdf = pdf.sort_values(["component", "i", "j", "chunk", "node"], kind="stable").drop_duplicates(["component", "i", "j", "node"])
    sets = [np.frombuffer(x, dtype=np.uint64) for x in pdf["grams"]]
    hashes = np.frombuffer(b"".join(pdf["hashes"]), dtype=np.uint32).reshape(-1, HASHES)
    nodes, copies, chunk = pdf["node"].to_numpy(), pdf["copies"].to_numpy(), pdf["chunk"].to_numpy()
    links, parent = np.zeros(len(pdf), dtype=np.int64), np.arange(len(pdf))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    group = pdf.groupby(["component", "i", "j"], sort=False).indices
    for (_, i, j), at in group.items():
        left = at[chunk[at] == i]
        right = left if i == j else at[chunk[at] == j]
        if not len(left) or not len(right):
            continue
        for a, others in linked(sets, hashes, left, right, threshold):
            links[a] += copies[others].sum()
            links[others] += copies[a]
            for b in others:
                x, y = root(a), root(b)
                if x != y:
                    parent[max(x, y)] = min(x, y)
    hit = np.flatnonzero(links)
    top = np.array([root(x) for x in hit], dtype=np.int64)
    return pd.DataFrame({"node": nodes[hit], "links": links[hit], "parent": nodes[top] if len(hit) else nodes[:0]})


def _documents(df: DataFrame, key: str, text: str, n: int) -> DataFrame:
    """(key, row, cls, size, hashes) of each document; ``row`` is a hash of
    the whole row."""
    rows = df.select(col(key).alias("key"), F.xxhash64(*map(col, df.columns)).alias("row"), col(text).alias("text"))
    schema = T.StructType([rows.schema["key"], T.StructField("row", T.LongType()), T.StructField("cls", T.BinaryType()),
                           T.StructField("size", T.IntegerType()), T.StructField("hashes", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in in_parts(batches, 2):
            sets = gram_sets(texts, n)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1),
                 pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                 pa.array([len(s) for s in sets], pa.int32()),
                 pa.array([min_hashes(s).tobytes() if len(s) else b"" for s in sets], pa.binary())],
                names=["key", "row", "cls", "size", "hashes"])

    return rows.mapInArrow(run, schema)


def _sets(rows: DataFrame, n: int) -> DataFrame:
    """(node, grams): the n-grams of the documents that stand for their class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in in_parts(batches, 0):
            want, node, grams = part.column(1).to_pylist(), [], []
            for c, i, s in zip(want, part.column(2).to_pylist(), gram_sets(texts, n)):
                # A key may name several texts: only the one with the class's set counts.
                if hashlib.blake2b(s.tobytes(), digest_size=16).digest() == c:
                    node.append(i)
                    grams.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(grams, pa.binary())], names=["node", "grams"])

    return rows.select("text", "cls", "node").mapInArrow(run, "node long, grams binary")


def classes(df: DataFrame, key: str = "doc_id", text: str = "text", n: int = WORDS, threshold: float = THRESHOLD):
    """(documents, sets): documents with ``key``, ``row`` and ``cls``; sets
    with ``cls``, ``copies``, ``copy_id``, ``links``, ``class_id`` and
    ``component`` (tells apart classes whose least key is the same)."""
    parts = partitions(df.sparkSession)
    docs = written(_documents(df, key, text, n), "gram-docs")
    sets = written(docs.groupBy("cls").agg(F.min("key").alias("copy_id"), F.count(F.lit(1)).alias("copies"), F.first("size").alias("size"),
                                           F.first("hashes").alias("hashes"), F.min(F.struct("key", "row")).alias("one"))
                   .withColumn("node", F.monotonically_increasing_id()), "gram-sets")
    # Buckets: sets with equal values in a band, as links to the least of them.
    bands = sets.filter("size > 0").select(
        "node", F.explode(F.array(*[F.xxhash64(F.lit(b), F.substring("hashes", 4 * BAND * b + 1, 4 * BAND))
                                    for b in range(HASHES // BAND)])).alias("band"))
    hubs = bands.groupBy("band").agg(F.min("node").alias("hub"), F.max("node").alias("top")).filter("hub < top").select("band", "hub")
    near = components(bands.join(hubs, "band").select(F.col("node").alias("a"), F.col("hub").alias("b")))
    near = written(near.join(sets, "node").select("node", "component", "cls", "copies", "size", "hashes", "one"), "gram-near")
    total = (near.groupBy("component").agg(F.sum("size").alias("grams"), F.count(F.lit(1)).alias("n"))
             .select("component", F.ceil(F.greatest(F.col("grams") / CHUNK_GRAMS, F.col("n") / CHUNK_SETS)).cast("int").alias("k")))
    weight = near.agg(F.sum("size").alias("s")).first().s or 0
    bins = max(1, parts, math.ceil(weight / CHUNK_GRAMS))   # cells for the components that fit one chunk
    rows = df.select(col(key).alias("key"), F.xxhash64(*map(col, df.columns)).alias("row"), col(text).alias("text"))
    wanted = near.select(F.col("one.key").alias("w_key"), F.col("one.row").alias("w_row"), "cls", "node")
    found = rows.join(wanted, (F.col("row") == F.col("w_row")) & F.col("key").eqNullSafe(F.col("w_key")))
    chunked = (near.join(total, "component").join(_sets(found, n), "node")
               .withColumn("chunk", F.pmod(F.xxhash64("node", F.lit(1)), F.col("k")).cast("int"))
               .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
               .withColumns({"i": F.least("chunk", "other"), "j": F.greatest("chunk", "other")})
               .withColumn("cell", F.when(F.col("k") == 1, F.pmod(F.xxhash64("component"), F.lit(bins)))
                           .otherwise(F.xxhash64("component", "i", "j"))))
    cells = chunked.select("cell", "component", "i", "j", "chunk", "node", "copies", "hashes", "grams")
    hits = written(cells.groupBy("cell").applyInPandas(lambda pdf: _cell(pdf, threshold), "node long, links long, parent long"),
                   "gram-links")
    links = hits.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(hits.select(F.col("node").alias("a"), F.col("parent").alias("b")))
    out = (sets.select("node", "cls", "copies", "copy_id").join(links, "node", "left").join(joined, "node", "left")
           .withColumn("component", F.coalesce("component", "node")))
    names = out.groupBy("component").agg(F.min("copy_id").alias("class_id"))
    out = out.join(names, "component").select("cls", "copies", "copy_id", F.coalesce("links", F.lit(0)).alias("links"), "class_id", "component")
    return docs.select("key", "row", "cls"), out


def join(df: DataFrame, key: str = "doc_id", text: str = "text", n: int = WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """One row for each row of ``df``: ``key``, ``class_id`` (least key of all
    documents that links connect), ``copy_id`` (least key of those with the
    same set), ``n_copies`` (how many those are) and ``n_links`` (documents at
    or above the threshold, copies included, itself not)."""
    docs, sets = classes(df, key, text, n, threshold)
    return docs.join(sets, "cls").select(
        F.col("key").alias(key), "class_id", "copy_id", F.col("copies").alias("n_copies"),
        (F.col("links") + F.col("copies") - 1).alias("n_links"))


def deduplicated(df: DataFrame, key: str = "doc_id", text: str = "text", n: int = WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """The row of each class with the least key, with the columns of ``df``."""
    docs, sets = classes(df, key, text, n, threshold)
    best = (docs.join(sets, "cls").groupBy("component")
            .agg(F.min(F.struct(F.col("key").isNull().alias("last"), "key", "row")).alias("best")).select(F.col("best.row").alias("row")))
    rows = df.select(packed(df, "whole"), F.xxhash64(*map(col, df.columns)).alias("row"))
    out = rows.join(best, "row", "left_semi").dropDuplicates(["row"])
    return out.select(*[field(c, "whole").alias(c) for c in df.columns])
