"""Projection, null handling, deterministic sampling and splitting."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A prefix with this many rows or fewer is ranked directly (one row comes to the driver either way).
_SELECT_FINAL = 50_000


def select_text(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep the relevant columns (pruned down to the scan by Catalyst)."""
    return df.select(*cols)


def fill_text(df: DataFrame, cols: Sequence[str], value: str = "") -> DataFrame:
    """Null text -> ``value``, everything as string."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(value)) for c in cols})


def drop_null_text(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows whose text is null (a pushed-down IS NOT NULL filter)."""
    return df.dropna(subset=list(cols))


def seeded_hash(key, seed: int = 42):
    """Stable per-row draw: md5 of ``key:seed`` (same value in any engine); a
    null key draws as the empty string."""
    return F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(f":{seed}")))


def sample_n(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """P5: exactly ``min(n, rows)`` rows, seeded, without replacement.

    ``orderBy(hash).limit(n)`` plans as TakeOrderedAndProject: each task keeps
    its best n rows, so at most n x tasks rows move, whatever the table size."""
    return df.orderBy(seeded_hash(key, seed), F.col(key)).limit(n)


def _kth_smallest(df: DataFrame, draw: str, k: int) -> str:
    """Exact k-th smallest value of a column of distinct hex strings, by radix
    selection over prefixes.

    Each level is one aggregate (counts per next 4 hex digits inside the
    current prefix, at most 65,536 rows to the driver); once a prefix holds
    few rows the wanted one alone is fetched."""
    prefix, before = "", 0
    while True:
        scope = df.filter(F.startswith(F.col(draw), F.lit(prefix))) if prefix else df
        if scope.count() <= _SELECT_FINAL:
            return scope.select(draw).orderBy(draw).offset(k - before - 1).limit(1).first()[0]
        width = len(prefix) + 4
        counts = (scope.groupBy(F.substring(F.col(draw), 1, width).alias("p")).count()
                  .orderBy("p").collect())
        for row in counts:
            if before + row["count"] >= k:
                prefix = row["p"]
                break
            before += row["count"]


def _in_test(df: DataFrame, key: str, test: float, seed: int) -> DataFrame:
    """``df`` with ``__test``: true for exactly ``ceil(test * n)`` rows.

    Rows are drawn by the seeded hash of their key; rows that share a key are
    told apart by a hash of the whole row and, if they are equal in all, by
    their place in the input, so the count holds for any keys."""
    tie = F.md5(F.concat_ws(":", F.xxhash64(*[F.col(c) for c in df.columns]).cast("string"),
                            F.monotonically_increasing_id().cast("string")))
    drawn = df.withColumn("__draw", F.concat(seeded_hash(key, seed), tie))
    k = math.ceil(test * drawn.count())
    if k == 0:
        return drawn.withColumn("__test", F.lit(False)).drop("__draw")
    return drawn.withColumn("__test", F.col("__draw") <= F.lit(_kth_smallest(drawn, "__draw", k))).drop("__draw")


def split_exact(df: DataFrame, key: str, test: float = 0.2, seed: int = 42
                ) -> tuple[DataFrame, DataFrame]:
    """Exact split, ``ceil(test * n)`` rows to test, chosen by seeded hash.

    The test set is the rows whose draw is at most the k-th smallest; both
    halves are then plain filters over the input and complements of each
    other: no join, no shuffle, and the same rows on every re-run."""
    drawn = _in_test(df, key, test, seed)
    return drawn.filter(~F.col("__test")).drop("__test"), drawn.filter("__test").drop("__test")


def split_approx(df: DataFrame, key: str, test: float = 0.2, seed: int = 42
                 ) -> tuple[DataFrame, DataFrame]:
    """Bernoulli split by a 32-bit hash threshold: one filter per side,
    no count and no ordering, for any table size; rows with one key (null
    included) stay together."""
    low = _below(key, test, seed)
    return df.filter(~low), df.filter(low)


def _below(key: str, test: float, seed: int):
    return F.conv(F.substring(seeded_hash(key, seed), 1, 8), 16, 10).cast("bigint") < int(test * 2 ** 32)


def split_column(df: DataFrame, key: str, test: float = 0.2, seed: int = 42, exact: bool = True
                 ) -> DataFrame:
    """Both halves as one table with a ``split`` column ('train' / 'test'), in
    one projection."""
    marked = _in_test(df, key, test, seed) if exact else df.withColumn("__test", _below(key, test, seed))
    return marked.withColumn("split", F.when(F.col("__test"), "test").otherwise("train")).drop("__test")


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str],
         var: str = "Type", val: str = "Sentiment") -> DataFrame:
    """Wide -> long (one Expand/Generate, no shuffle)."""
    return df.unpivot(list(ids), list(values), var, val)


def with_row_id(df: DataFrame, keys: Sequence[str], name: str = "row_id") -> DataFrame:
    """P10: stable id from the key columns (same on every re-run, unlike
    ``monotonically_increasing_id``); which keys are null counts as well."""
    return df.withColumn(name, F.xxhash64(*[F.col(k) for k in keys], *[F.col(k).isNull() for k in keys]))
