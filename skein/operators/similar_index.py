"""The documents most similar to each of a set of queries (SI6).

``similar`` takes vectors and returns, for every query row, the ``k`` other
vectors of greatest cosine. It is an inverted file over cells:

* rows with equal vectors are one entry with a count, gathered in the map tasks
  first, so copies cost once however many there are;
* cells are k-means centres fitted on a bounded sample (``SAMPLE`` entries);
  every entry is indexed in its nearest cell, a query looks into its nearest
  ``probes`` cells;
* a cell of more than ``HOT`` entries is split by a second hash: the signs of
  fixed random projections of what is left after the centre is taken away. A
  query looks into its own part there and those one sign away;
* the entries of a part are dealt into blocks of ``BLOCK``, its queries into
  blocks too, so the work of one task is bounded whatever the skew. A block
  returns the ``k`` best of each of its queries; such lists merge by taking
  the ``k`` best of both, which Spark's window limit does before and after
  the exchange. Pairs are never rows.

With ``exact`` there is one cell, not split: every query meets every entry,
block by block.

Defined results: a vector that is null, empty or zero has no neighbours and is
none; the vector of a query is its own neighbour only if other rows have it
(``n_rows`` then leaves out the query's own); equal similarities go to the
least id; repeated rows are copies of each other; null keys rank last as
names and are no queries.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.operators.similar import embed
from skein.session import ensure_checkpoint_dir

SAMPLE = 20_000          # entries that the cells are fitted on, about
CELLS = 4096             # cells, at most (a broadcast of CELLS x dimensions numbers)
BLOCK, QUERIES = 4096, 1024   # entries and queries of one block, about
HOT, BITS = 65_536, 16   # entries from which a cell is split; signs, at most
SEED = 42


def _written(df: DataFrame, name: str) -> DataFrame:
    import uuid
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/skein-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def entries(df: DataFrame, key: str, vector: str, is_query: Column) -> tuple[DataFrame, DataFrame]:
    """(entries, members): one row a distinct vector (id, n_rows, asked, vec of
    length 1), and (key, id) of the query rows."""
    squares = F.aggregate(F.col(vector), F.lit(0.0).cast("double"), lambda a, x: a + x.cast("double") * x.cast("double"))
    hashes = [F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2")]

    def usable(part: DataFrame) -> DataFrame:
        rows = part.select(F.col(key).alias("key"), F.col(vector).alias("v"), squares.alias("sq"),
                           F.coalesce(is_query & F.col(key).isNotNull(), F.lit(False)).alias("asked"))
        return rows.filter((F.col("sq") > 0) & (F.col("sq") < float("inf")))

    unit = F.transform("v", lambda x: x.cast("double") / F.sqrt("sq"))
    rows = usable(df).select("key", "asked", unit.alias("vec"), *hashes)
    first = F.min(F.struct(F.col("key").isNull().alias("last"), "key", "vec"))
    found = rows.groupBy("h1", "h2").agg(first.alias("f"), F.count(F.lit(1)).alias("n_rows"), F.max("asked").alias("asked"))
    found = _written(found.select(F.xxhash64("h1", "h2").alias("id"), "h1", "h2", F.col("f.key").alias("name"), "n_rows", "asked",
                                  F.col("f.vec").alias("vec")), "similar-entries")
    # The query rows are picked before their vectors are made again.
    members = usable(df.filter(is_query & F.col(key).isNotNull())).select("key", *hashes).select("key", F.xxhash64("h1", "h2").alias("id"))
    return found.drop("h1", "h2"), members


def fit_cells(found: DataFrame, n: int, cells: int) -> np.ndarray:
    """The centres, of length 1, from a hash sample of the entries."""
    every = max(1, n // SAMPLE)
    sample = found.filter(F.pmod(F.xxhash64("id", F.lit(SEED)), F.lit(every)) == 0).select(array_to_vector("vec").alias("features"))
    model = KMeans(k=cells, maxIter=12, seed=SEED, initMode="random").fit(sample)
    centres = np.array(model.clusterCenters())
    return centres / np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)


def _signs(dim: int) -> np.ndarray:
    return np.random.default_rng(SEED).normal(size=(dim, BITS))


def _placed(rows: DataFrame, centres: np.ndarray, probes: int) -> DataFrame:
    """Each row with its ``probes`` nearest cells and its signs there."""
    shared = rows.sparkSession.sparkContext.broadcast(centres)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value
        planes, powers = _signs(own.shape[1]), 1 << np.arange(BITS)
        for pdf in batches:
            x = np.stack(pdf["vec"].to_numpy())
            near = x @ own.T
            top = np.argsort(-near, axis=1, kind="stable")[:, :probes]
            code = [((((x - own[top[:, j]]) @ planes) > 0) @ powers) for j in range(top.shape[1])]
            at = np.repeat(np.arange(len(x)), top.shape[1])
            yield pdf.iloc[at].assign(cell=top.ravel().astype("int32"), code=np.stack(code, axis=1).ravel().astype("int32"))

    return rows.mapInPandas(run, T.StructType([*rows.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("code", T.IntegerType())]))


def _block_best(k: int):
    def best(key, docs: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(docs) or not len(asked):
            return pd.DataFrame({"query": [], "id": [], "similarity": []}).astype({"query": "int64", "id": "int64", "similarity": "float64"})
        docs = docs.sort_values("name", kind="stable", na_position="last")   # so that places break ties
        ids, n_rows = docs["id"].to_numpy(), docs["n_rows"].to_numpy()
        near = np.round(np.stack(asked["vec"].to_numpy()) @ np.stack(docs["vec"].to_numpy()).T, 6)
        out = []
        for q, row in zip(asked["id"].to_numpy(), near):
            row[(ids == q) & (n_rows == 1)] = -np.inf
            limit = np.partition(row, len(row) - k)[len(row) - k] if len(row) > k else -np.inf
            at = np.flatnonzero((row >= limit) & (row > -np.inf))
            at = at[np.argsort(-row[at], kind="stable")[:k]]
            out.append(pd.DataFrame({"query": q, "id": ids[at], "similarity": row[at]}))
        return pd.concat(out, ignore_index=True)
    return best


def similar(df: DataFrame, key: str, vector: str, is_query: Column, k: int = 10, exact: bool = False, cells: int | None = None,
            probes: int | None = None) -> DataFrame:
    """SI6: (``key``, rank, similar_id, n_rows, similarity) for each row of
    ``df`` for which ``is_query`` holds: its ``k`` nearest vectors, each named
    by the least key of the rows that have it. ``cells`` (about the root of
    the number of entries, if not given) and ``probes`` (an eighth of them, 6
    at least) decide recall and cost."""
    found, members = entries(df, key, vector, is_query)
    n = found.count()
    cells = 1 if exact else cells or max(1, min(CELLS, 1 << int(math.log2(max(1.0, math.sqrt(n))))))
    probes = min(cells, probes or max(6, cells // 8))
    if cells == 1:
        at = {"cell": F.lit(0), "code": F.lit(0)}
        docs, asked = found.withColumns(at), found.filter("asked").withColumns(at)
    else:
        centres = fit_cells(found, n, cells)
        docs, asked = _placed(found, centres, 1), _placed(found.filter("asked"), centres, probes)
    docs, asked = _written(docs, "similar-docs"), _written(asked.select("id", "vec", "cell", "code"), "similar-queries")
    # Signs that split a hot cell: at most CELLS rows.
    split = F.when(F.lit(exact) | (F.col("n") <= HOT), 0).otherwise(F.least(F.lit(BITS), F.ceil(F.log2(F.col("n") / HOT)))).cast("int")
    cut = F.broadcast(docs.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).select("cell", split.alias("bits")))
    mask = F.expr("(shiftleft(1, bits) - 1)")
    docs = docs.join(cut, "cell").withColumn("part", F.col("code").bitwiseAND(mask))
    own = F.col("code").bitwiseAND(mask)
    one_off = F.expr("transform(filter(sequence(0, 15), i -> i < bits), i -> (code & (shiftleft(1, bits) - 1)) ^ shiftleft(1, i))")
    asked = asked.join(cut, "cell").withColumn("part", F.explode(F.concat(F.array(own), one_off)))
    count = lambda t, name, size: t.groupBy("cell", "part").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias(name))
    sizes = _written(count(docs, "blocks", BLOCK).join(count(asked, "turns", QUERIES), ["cell", "part"]), "similar-sizes")
    of = lambda n, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    by = ["cell", "part", "block", "turn"]
    docs = (docs.join(sizes, ["cell", "part"]).withColumn("block", of("blocks", 1)).withColumn("turn", each("turns"))
            .select(*by, "id", "n_rows", "name", "vec"))
    asked = (asked.join(sizes, ["cell", "part"]).withColumn("turn", of("turns", 2)).withColumn("block", each("blocks"))
             .select(*[F.col(c).alias(c) for c in by], F.col("id").alias("id"), F.col("vec").alias("vec")))
    lists = docs.groupBy(*by).cogroup(asked.groupBy(*by)).applyInPandas(_block_best(k), "query long, id long, similarity double")
    names = found.select("id", F.col("name").alias("similar_id"), F.col("n_rows").alias("of_rows"))
    # A part and those one sign away are different, and so are cells: no entry comes twice.
    lists = lists.join(names, "id")
    order = Window.partitionBy("query").orderBy(F.desc("similarity"), F.col("similar_id").asc_nulls_last())
    top = lists.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    own_rows = F.col("of_rows") - (F.col("query") == F.col("id")).cast("long")
    return (members.join(top.withColumn("n_rows", own_rows).drop("id").withColumnRenamed("query", "id"), "id")
            .select(F.col("key").alias(key), "rank", "similar_id", "n_rows", "similarity"))


def similar_documents(df: DataFrame, key: str, text: str, is_query: Column, k: int = 10, dim: int = 64, **options) -> DataFrame:
    """SI6 over whole texts: their embeddings (SI3, hashed terms) searched by
    ``similar``; texts with the same words in any order are copies here."""
    return similar(embed(df.select(key, text), text, "embedding", "hashing", dim).drop(text), key, "embedding", is_query, k, **options)
