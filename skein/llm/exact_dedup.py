"""Exact deduplication by content sort, in DataFrame operations only.

Texts are equal when they are identical after lower-casing A-Z; null counts
as empty. Sampled splitters range-partition the rows by their normalised
bytes (a leading slice, then a 64-bit digest, so that splitters stay short),
each partition is sorted on the full normalised text (Spark's external sort),
which places equals adjacent, and every row is compared in full with its
neighbour. Whole texts cross the network once.

Hot texts: a first narrow pass counts digests. A digest with more than
rows / (4 x partitions) rows is hot; there are at most 4 x partitions of
those, so their list is broadcast. The rows of a hot digest are spread over
all partitions by a salt that extends the sort key; their runs (at most one
a salt) are then merged by a second sort and the same full comparison.

Defined results: a null key ranks last; of rows that tie on the key, the one
whose whole-row hash is smallest stays; repeated rows count each. An empty
table gives an empty table. Input columns named like an output give way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.llm.frames import col, field, packed, partitions, unpacked, written

OUTPUTS = ["keep_id", "group_size", "kept", "text_sha256"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SLICE = 24  # bytes of the sort key that lead the splitters


def normalised(text: Column) -> Column:
    """A-Z lower-cased, nothing else; null is empty. ``lower`` does just that
    to pure ASCII, and is faster than ``translate``."""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def _best(id_: Column, keep: str) -> list[Column]:
    return [id_.desc_nulls_last() if keep == "largest" else id_.asc_nulls_last(), F.col("tie").asc()]


def _runs(df: DataFrame, cell: list[str], keep: str) -> DataFrame:
    """Number the runs of equal ``norm`` within each cell by comparing every
    row with the one before it."""
    w = Window.partitionBy(*cell).orderBy("norm", *_best(F.col("id"), keep))
    before = F.lag("norm").over(w)
    return (df.withColumn("starts", F.when(before.isNull() | (before != F.col("norm")), 1).otherwise(0))
            .withColumn("run", F.sum("starts").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
            .drop("starts"))


def _grouped(df: DataFrame, key: str, text: str, keep: str) -> DataFrame:
    """``row`` (all input columns) and the outputs."""
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    n = partitions(df.sparkSession)
    digest = F.xxhash64(normalised(col(text)))
    total = df.count()
    hot = (df.groupBy(digest.alias("digest")).count().filter(F.col("count") > max(64, total // (4 * n)))
           .select("digest", F.lit(True).alias("hot")))  # at most 4 n rows
    norm = normalised(field(text))
    dealt = (df.select(packed(df), F.substring(F.encode(normalised(col(text)), "UTF-8"), 1, SLICE).alias("head"),
                       digest.alias("digest"))
             .join(F.broadcast(hot), "digest", "left")
             .withColumn("tie", F.xxhash64("row"))
             .withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("tie"), F.lit(n))).otherwise(0).cast("int"))
             .repartitionByRange(n, "head", "digest", "salt"))
    cell = ["head", "digest", "salt"]
    runs = _runs(dealt.withColumn("norm", norm).withColumn("id", field(key)), cell, keep)
    in_run = Window.partitionBy(*cell, "run")
    ranked = (runs.withColumn("text_sha256", F.sha2(F.encode("norm", "UTF-8"), 256))
              .withColumn("place", F.row_number().over(in_run.orderBy(*_best(F.col("id"), keep))))
              .withColumn("top", F.first(F.struct("id", "tie")).over(in_run.orderBy(*_best(F.col("id"), keep))))
              .withColumn("size", F.count(F.lit(1)).over(in_run))
              .withColumn("norm", F.when(F.col("hot") & (F.col("place") == 1), F.col("norm"))))
    step = written(ranked.select("row", "hot", "digest", "salt", "run", "place", "top", "size", "norm", "text_sha256"),
                   "exact-dedup")
    cold = (step.filter(F.col("hot").isNull())
            .select("row", F.col("top.id").alias("keep_id"), F.col("size").alias("group_size"),
                    (F.col("place") == 1).alias("kept"), "text_sha256"))
    # Runs of hot texts: one row for each salt, merged by the same comparison.
    heads = step.filter(F.col("norm").isNotNull()).select("digest", "salt", "run", "norm", "size", "top.id", "top.tie")
    merged = _runs(heads.withColumnRenamed("run", "own"), ["digest"], keep)
    whole = Window.partitionBy("digest", "run")
    merged = merged.select(
        "digest", "salt", F.col("own").alias("run"),
        F.first(F.struct("id", "tie", "salt")).over(whole.orderBy(*_best(F.col("id"), keep), "salt")).alias("best"),
        F.sum("size").over(whole).alias("all"))
    warm = (step.filter(F.col("hot")).drop("norm", "size").join(merged, ["digest", "salt", "run"])
            .select("row", F.col("best.id").alias("keep_id"), F.col("all").alias("group_size"),
                    ((F.col("place") == 1) & (F.col("salt") == F.col("best.salt"))).alias("kept"), "text_sha256"))
    return cold.unionByName(warm)


def exact_dedup(df: DataFrame, key: str = "doc_id", text: str = "text", keep: str = "smallest") -> DataFrame:
    """Every row of ``df`` with ``keep_id`` (key of the row that stays),
    ``group_size``, ``kept`` (true for one row of each group) and
    ``text_sha256`` (lowercase hex of the normalised text)."""
    return unpacked(_grouped(df, key, text, keep), df.columns, OUTPUTS)


def deduplicated(df: DataFrame, key: str = "doc_id", text: str = "text", keep: str = "smallest") -> DataFrame:
    """The rows of ``df`` that stay, one of each group of equal texts, with
    the columns of ``df``."""
    out = _grouped(df, key, text, keep).filter("kept")
    return out.select(*[field(c).alias(c) for c in df.columns])
