"""Connected components of a graph of links, as a forest built by hooking.

Every link points from its larger node to its smaller one. In a pass the
links are dealt by their larger node; each task joins what it holds
(union-find over its links) and gives each of its nodes one link to the least
node it found. A node with several smaller neighbours so keeps one, and the
others are linked with each other for the next pass, until no node has two.
Links are contracted in the tasks before they are dealt, and a hub with many
larger neighbours is never dealt by itself, so it is no hot key. The forest's
links are then doubled along (a join that Spark splits at a hub) until all
lead to the roots.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.frames import partitions, written

LINKS = 1 << 20   # that a task holds before it contracts them


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least node of each node's component (those that are least left out)."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        la, lb = label[a], label[b]
        open_ = la != lb
        if not open_.any():
            break
        a, b = a[open_], b[open_]
        np.minimum.at(label, np.maximum(la, lb)[open_], np.minimum(la, lb)[open_])
        while not np.array_equal(up := label[label], label):
            label = up
    below = label != np.arange(len(nodes))
    return nodes[below], nodes[label[below]]


def _contracted(links: DataFrame) -> DataFrame:
    """(a, b, own): a forest over the links of each partition; ``own`` tells
    whether a is the larger node of a link there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = b = own = np.zeros(0, dtype=np.int64)
        waiting, size = [], 0

        def joined():
            x, y = (np.concatenate([old, *[w[i] for w in waiting]]) for i, old in ((0, a), (1, b)))
            return *forest(x, y), np.union1d(own, np.concatenate([own, *[w[0] for w in waiting]]))

        for batch in batches:
            waiting.append([batch.column(i).to_numpy() for i in (0, 1)])
            size += batch.num_rows
            if size > LINKS:
                (a, b, own), waiting, size = joined(), [], 0
        if waiting or len(a):
            a, b, own = joined()
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(np.isin(a, own))], names=["a", "b", "own"])

    return links.mapInArrow(run, "a long, b long, own boolean")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: long) that has a
    link to another; a component is named by its least node. Every pass is
    written to the shared folder, so plans stay short."""
    n = partitions(edges.sparkSession)
    links = _contracted(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    while True:
        links = written(_contracted(links.select("a", "b").repartition(n, "a")), "forest")
        if links.filter("NOT own").isEmpty():
            break
    tree, deep = links.select("a", "b"), True
    while deep:
        up = tree.select(F.col("a").alias("b"), F.col("b").alias("c"))
        tree = written(tree.join(up, "b", "left").select("a", F.coalesce("c", "b").alias("b"), F.col("c").isNotNull().alias("moved")), "forest")
        deep = not tree.filter("moved").isEmpty()
        tree = tree.select("a", "b")
    return (tree.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(tree.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()))
