"""TF-IDF in long form and TF-IDF cosine between text columns (M1, M2, SI1).

Vectors are sparse long tables (key, term, weight), never dense rows. The idf
table is broadcast only when a vocabulary cap bounds it; otherwise it joins on
``term`` by shuffle and AQE splits the partitions of very common terms.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skein.operators.terms import term_counts
from skein.session import shuffle_partitions


def tfidf_counts(df: DataFrame, key: str, tok: str) -> DataFrame:
    """M1's kept model: (term, tf, df), the corpus and document frequency of
    each term, and one row with a null term whose ``df`` is the number of rows.
    Counts of different rows add up (``merged_counts``), so a model is refreshed
    with new rows alone. One partial aggregate gives per-(row, term) counts;
    a second gives both frequencies."""
    per_term = (term_counts(df, key, tok).groupBy("term")
                .agg(F.sum("n").alias("tf"), F.count(F.lit(1)).alias("df")))
    rows = df.agg(F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("tf"), F.count(F.lit(1)).alias("df"))
    return per_term.unionByName(rows)


def merged_counts(*counts: DataFrame) -> DataFrame:
    """The counts of all rows that any of ``counts`` was made from (each row in
    one of them)."""
    both = counts[0]
    for c in counts[1:]:
        both = both.unionByName(c)
    return both.groupBy("term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))


def idf_of(counts: DataFrame, size: int | None = None) -> DataFrame:
    """(term, idf) of kept counts: ``idf = ln((1+n)/(1+df)) + 1``; with
    ``size`` only the most frequent ``size`` terms."""
    n = counts.filter("term IS NULL").agg(F.coalesce(F.sum("df"), F.lit(0)).alias("n")).first().n
    terms = counts.filter("term IS NOT NULL")
    if size:
        terms = terms.orderBy(F.col("tf").desc(), F.col("term")).limit(size)
    return terms.select("term", (F.log((1.0 + n) / (1.0 + F.col("df"))) + 1.0).alias("idf"))


def fit_tfidf(df: DataFrame, key: str, tok: str, size: int | None = None) -> DataFrame:
    """M1 fit: (term, idf) with ``idf = ln((1+n)/(1+df)) + 1`` over the rows of
    ``df``; with ``size`` only the most frequent ``size`` terms are kept.

    One partial aggregate gives per-(row, term) counts; a second gives both
    corpus frequency and document frequency per term."""
    n = df.select(key).count()
    per_term = (term_counts(df, key, tok).groupBy("term")
                .agg(F.sum("n").alias("tf"), F.count(F.lit(1)).alias("df")))
    if size:
        per_term = per_term.orderBy(F.col("tf").desc(), F.col("term")).limit(size)
    return per_term.select("term", (F.log((1.0 + n) / (1.0 + F.col("df"))) + 1.0).alias("idf"))


def _idf_side(idf: DataFrame, bounded: bool) -> DataFrame:
    return F.broadcast(idf) if bounded else idf


def tfidf_weights(df: DataFrame, key: str, tok: str, idf: DataFrame, bounded: bool = False) -> DataFrame:
    """M1 transform / M2: (key, term, weight), each row scaled to unit length;
    terms outside the fitted vocabulary are dropped."""
    tf = term_counts(df, key, tok)
    w = tf.join(_idf_side(idf, bounded), "term", "inner").select(key, "term", (F.col("n") * F.col("idf")).alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(key)))
    return w.select(key, "term", (F.col("w") / norm).alias("weight"))


def _side(i: int):
    def f(t):
        return F.struct(F.lit(i).alias("side"), t.alias("term"))
    return f


def cosine_tfidf(df: DataFrame, key: str, cols: Sequence[str], pairs: Sequence[tuple[str, str, str]],
                 fit_on: str, tok_fn, size: int | None = None) -> DataFrame:
    """SI1: TF-IDF cosine for several column pairs at once.

    The vectoriser is fitted on ``fit_on``; every column is tokenised once and
    exploded in a single Generate tagged by column, so all pairs share one
    aggregate on (key, term). Output: key + one column per pair (0 when a side
    has no known term)."""
    # Every column is tokenised before one exchange of the token arrays by
    # key; every per-key step below (counts, norms, per-term products, sums)
    # then stays in its partition (on a wide scan: 4 exchanges instead of 6).
    base = (df.select(key, *[tok_fn(F.col(c)).alias(f"__t{i}") for i, c in enumerate(cols)])
            .repartition(shuffle_partitions(df), key))
    fit_df = base.select(key, F.col(f"__t{list(cols).index(fit_on)}").alias("__tok"))
    idf = fit_tfidf(fit_df, key, "__tok", size)
    tagged = F.flatten(F.array(*[F.transform(F.col(f"__t{i}"), _side(i)) for i in range(len(cols))]))
    ex = (base.select(key, F.explode_outer(tagged).alias("e")).filter(F.col("e").isNotNull())
          .select(key, "e.side", "e.term"))
    # One row for each term of a row's key goes to its idf, with its count in every column; lengths and
    # products are then sums of one aggregate.
    tf = ex.groupBy(key, "term").agg(*[F.sum(F.when(F.col("side") == i, 1).otherwise(0)).alias(f"n{i}") for i in range(len(cols))])
    w = tf.join(_idf_side(idf, size is not None), "term", "inner")
    idx = {c: i for i, c in enumerate(cols)}
    product = {(i, j): F.sum(F.col(f"n{i}") * F.col(f"n{j}") * F.col("idf") * F.col("idf"))
               for i, j in {(i, i) for i in idx.values()} | {(idx[a], idx[b]) for _, a, b in pairs}}
    sums = w.groupBy(key).agg(*[v.alias(f"p{i}_{j}") for (i, j), v in product.items()])
    sims = sums.select(key, *[
        F.when(F.col(f"p{idx[a]}_{idx[b]}") > 0, F.col(f"p{idx[a]}_{idx[b]}")
               / F.sqrt(F.col(f"p{idx[a]}_{idx[a]}")) / F.sqrt(F.col(f"p{idx[b]}_{idx[b]}"))).alias(name)
        for name, a, b in pairs])
    return (base.select(key).join(sims, key, "left")
            .select(key, *[F.coalesce(F.col(name), F.lit(0.0)).alias(name) for name, _, _ in pairs]))
