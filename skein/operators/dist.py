"""Distributions behind the charts.

All series are first stacked into one long table (one Expand, no shuffle),
so every metric shares each aggregate. Per-series statistics are tiny (one
row per series) and are joined back by broadcast: their size is the number
of series, not of rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skein.session import cut_lineage


def stack(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(series, x) for the given numeric columns, nulls and NaN dropped."""
    return (df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("series"), F.col(c).cast("double").alias("x"))
                                          for c in cols])).alias("s"))
            .select("s.series", "s.x").filter(F.col("x").isNotNull() & ~F.isnan("x")))


def histogram(df: DataFrame, cols: Sequence[str], bins: int = 20) -> DataFrame:
    """(series, bin, lo, hi, n), equal-width bins over each series' own
    [min, max]; bin = least(floor((x - min) / w), bins - 1); one bin if
    max = min.

    The bins need each series' range first, so the stacked values are read
    twice; they are checkpointed into the shared folder (a few numbers per
    row) so the input - e.g. a tokenising similarity pass - runs once."""
    long = cut_lineage(stack(df, cols))
    rng = long.groupBy("series").agg(F.min("x").alias("mn"), F.max("x").alias("mx"))
    w = (F.col("mx") - F.col("mn")) / bins
    b = (F.when(F.col("mx") == F.col("mn"), F.lit(0))
         .otherwise(F.least(F.floor((F.col("x") - F.col("mn")) / w), F.lit(bins - 1)))).cast("int")
    counted = (long.join(F.broadcast(rng), "series").withColumn("bin", b)
               .groupBy("series", "bin", "mn", "mx").agg(F.count(F.lit(1)).alias("n")))
    lo = F.when(F.col("mx") == F.col("mn"), F.col("mn")).otherwise(F.col("mn") + F.col("bin") * w)
    hi = F.when(F.col("mx") == F.col("mn"), F.col("mx")).otherwise(F.col("mn") + (F.col("bin") + 1) * w)
    return counted.select("series", "bin", F.round(lo, 6).alias("lo"), F.round(hi, 6).alias("hi"), "n")


def density(df: DataFrame, cols: Sequence[str], lo: float = -1.0, hi: float = 1.0, points: int = 200,
            resolution: int = 1000) -> DataFrame:
    """Gaussian kernel density on a grid of ``points`` over [lo, hi].

    Values are pre-binned to 1/``resolution`` (b = floor(x*res + 0.5)/res)
    with counts, so the work is grid x distinct bins, not grid x rows; each
    binned row emits its grid contributions through a Generate (no join of
    the grid with the data). Bandwidth h = stddev_samp x n^(-1/5); y is null
    when h = 0."""
    long = stack(df, cols).withColumn("b", F.floor(F.col("x") * resolution + 0.5) / resolution)
    # Bin counts and per-series statistics come out of one grouping-sets
    # aggregate (one Expand, one partial aggregate, one exchange). Its result
    # (one row per bin, plus one per series) is checkpointed into the shared
    # folder, so the input - often a whole scoring job - runs once although
    # two branches read it; no series is ever gathered into one task.
    agg = cut_lineage(long.groupingSets([["series", "b"], ["series"]], "series", "b")
                      .agg(F.count(F.lit(1)).alias("c"), F.stddev_samp("x").alias("sd"),
                           F.grouping_id().alias("gid")))
    stats = (agg.filter(F.col("gid") == 1)
             .select("series", F.col("c").alias("n"), (F.col("sd") * F.pow(F.col("c").cast("double"), -0.2)).alias("h")))
    binned = agg.filter(F.col("gid") == 0).select("series", "b", "c")
    g = F.lit(lo) + F.lit(hi - lo) * F.col("i") / (points - 1)
    contrib = (binned.join(F.broadcast(stats), "series")
               .select("series", "b", "c", "n", "h", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
               .withColumn("k", F.col("c") * F.exp(-F.pow((g - F.col("b")) / F.col("h"), 2) / 2)))
    y = F.sum("k") / (F.first("n") * F.first("h") * math.sqrt(2 * math.pi))
    out = contrib.groupBy("series", "i").agg(F.when(F.first("h") > 0, y).alias("y"))
    return out.select("series", "i", F.round(g, 6).alias("x"), F.round("y", 6).alias("y"))


def metric_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """N, mean, sd, min and max per series."""
    long = stack(df, cols)
    return long.groupBy("series").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("x"), 6).alias("mean"),
        F.round(F.stddev_samp("x"), 6).alias("sd"), F.min("x").alias("min"), F.max("x").alias("max"))


def metric_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Exact quantiles per series: (series, q), the least value at or below
    which lie at least p of the rows.

    Counts per distinct value are range-partitioned and ranked in two steps,
    the totals of the partitions first (one row for each series and
    partition), then running sums inside each, so no series is gathered in
    one task."""
    long = stack(df, cols)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = long.groupBy("series", "x").agg(F.count(F.lit(1)).alias("c"))
    ranged = cut_lineage(counts.repartitionByRange(n, "series", "x").withColumn("part", F.spark_partition_id()))
    parts = ranged.groupBy("series", "part").agg(F.sum("c").alias("own"))
    by_series = Window.partitionBy("series")
    before = by_series.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("series", "part", F.coalesce(F.sum("own").over(before), F.lit(0)).alias("before"),
                         F.sum("own").over(by_series).alias("n"))
    running = Window.partitionBy("series", "part").orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rank = F.col("before") + F.sum("c").over(running)
    ranked = ranged.join(parts, ["series", "part"]).withColumn("rank", rank)
    least = [F.min(F.when(F.col("rank") >= F.ceil(F.lit(p) * F.col("n")), F.col("x"))) for p in probs]
    return ranked.groupBy("series").agg(F.array(*least).alias("q"))
