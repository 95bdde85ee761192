"""Sharding indivisible groups by Karmarkar-Karp differencing.

Rows with equal texts form a group that may not be divided; a row weighs the
UTF-8 bytes of its text plus one. Differencing starts from one partial
partition for each group (its weight in one of k places) and repeatedly takes
the two with the largest spread and adds them oppositely ordered, the largest
places of one onto the smallest of the other, until one is left.

The work is done in levels so that no task or driver holds all groups: the
groups are dealt by hash into blocks of about ``BLOCK`` items, each block is
differenced into ``BUNDLES`` even bundles, the bundles are the items of the
next level, and the level that fits one block is differenced into the shards.
A group heavier than its block's share becomes a bundle of its own and so
reaches the last level alone, where the rest is laid against it.

Defined results: a null text has no bytes (weight 1, crc32 of nothing) and
shares a group with empty texts; null and repeated keys are rows like any
other; slots number the rows of a shard without gaps. An empty table gives an
empty table. Input columns named like an output give way.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skein.llm.frames import col, partitions, unpacked, written

BLOCK = 4096      # items that one task differences
LEAST = 16        # items that a block hands on, at least
OUTPUTS = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]


def differenced(weights: Sequence[int], k: int) -> list[int]:
    """The part (0 to k-1) of each weight, by k-way differencing."""
    if not weights:
        return []
    heap = []
    for i, w in enumerate(weights):
        # (spread, order of making, place sums from largest to smallest, members of each place)
        heap.append((-int(w), i, [int(w)] + [0] * (k - 1), [[i]] + [None] * (k - 1)))
    heapq.heapify(heap)
    made = len(heap)
    while len(heap) > 1:
        _, _, sums, members = heapq.heappop(heap)
        _, _, other, others = heapq.heappop(heap)
        new = []
        for s, m, t, n in zip(sums, members, reversed(other), reversed(others)):
            if m and n:
                if len(m) < len(n):
                    m, n = n, m
                m.extend(n)
            new.append((s + t, m or n))
        new.sort(key=lambda x: -x[0])
        least = new[-1][0]
        heapq.heappush(heap, (least - new[0][0], made, [s - least for s, _ in new], [m for _, m in new]))
        made += 1
    part = [0] * len(weights)
    for place, members in enumerate(heap[0][3]):
        for i in members or ():
            part[i] = place
    return part


def _parts(items: DataFrame, block, k: int, singles: int = 0) -> DataFrame:
    """(item, weight, block, part): each block differenced into k parts, but
    for ``singles`` items that are parts of their own."""
    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["weight", "item"], ascending=[False, True], kind="stable").reset_index(drop=True)
        n = len(pdf)
        alone = sorted({n - 1 - i * i * n // (singles * singles) for i in range(singles)}) if n > singles else []
        rest = sorted(set(range(n)) - set(alone))
        part = pd.Series(0, index=pdf.index)
        part[rest] = differenced(pdf["weight"][rest].tolist(), k)
        part[alone] = range(k, k + len(alone))
        return pdf.assign(part=part.astype("int32"))

    return (items.select("item", "weight", block.cast("long").alias("block")).groupBy("block")
            .applyInPandas(one, "item string, weight long, block long, part int"))


def assigned(groups: DataFrame, shards: int, block: int = BLOCK) -> DataFrame:
    """(item, shard) for ``groups`` (item string, weight long)."""
    items, levels = written(groups, "shard-items"), []
    n = items.count()
    while n > block:
        blocks = math.ceil(n / block)
        quota = max(LEAST, min(block // blocks, block // 2))
        parts = _parts(items, F.pmod(F.xxhash64("item", F.lit(len(levels))), F.lit(blocks)), quota - quota // 4, quota // 4)
        step = written(parts.select("item", F.concat_ws("-", "block", "part").alias("bundle"), "weight"), "shard-level")
        levels.append(step.select("item", "bundle"))
        items = step.groupBy(F.col("bundle").alias("item")).agg(F.sum("weight").alias("weight"))
        n = items.count()
    out = _parts(items, F.lit(0), shards).select("item", F.col("part").alias("shard"))
    for level in reversed(levels):
        out = level.join(out.withColumnRenamed("item", "bundle"), "bundle").select("item", "shard")
    return out


def shard(df: DataFrame, shards: int = 8, key: str = "doc_id", text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The columns ``carry`` of ``df`` (all, if not given; texts that are not
    needed further need not travel) and of each row ``size``, ``text_crc32``, ``law``
    ('bytes'), ``shard``, ``slot`` (its place in the shard, from 0) and
    ``grown_shard`` (null: this law deals afresh when the count changes)."""
    n = partitions(df.sparkSession)
    raw = F.coalesce(col(text), F.lit(""))
    carry = df.columns if carry is None else carry
    rows = df.select(F.struct(*map(col, carry)).alias("row"), col(key).alias("id"), F.sha2(F.encode(raw, "UTF-8"), 256).alias("item"),
                     (F.octet_length(raw) + 1).cast("long").alias("size"),
                     F.crc32(F.encode(raw, "UTF-8")).alias("text_crc32"))
    groups = rows.groupBy("item").agg(F.sum("size").alias("weight"))
    placed = written(rows.join(assigned(groups, shards), "item")
                     .withColumn("bucket", F.pmod(F.xxhash64("id", "row"), F.lit(n)).cast("int")), "shard-rows")
    # Slots: a count for each (shard, bucket), at most shards x partitions rows, then places in a bucket.
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (placed.groupBy("shard", "bucket").count()
              .select("shard", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start")))
    within = Window.partitionBy("shard", "bucket").orderBy(F.col("id").asc_nulls_last(), "item", F.xxhash64("row"))
    out = (placed.join(F.broadcast(starts), ["shard", "bucket"])
           .withColumn("slot", (F.row_number().over(within) - 1 + F.col("start")).cast("long"))
           .withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int")))
    return unpacked(out, carry, OUTPUTS)


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder for each shard, rows in slot order within and across files."""
    n = partitions(sharded.sparkSession)
    (sharded.repartitionByRange(n, "shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
