"""Connected components: of an edge table by alternating stars, and within one task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limnocast.session import checkpointed


class Forest:
    """Union of row numbers; the label of a row is the smallest row joined to it."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.label[a], self.label[b]
            apart = x != y
            if not apart.any():
                return
            a, b = a[apart], b[apart]
            np.minimum.at(self.label, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
            while not np.array_equal(up := self.label[self.label], self.label):
                self.label = up


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; the root is the smallest node reachable.

    ``a`` and ``b`` are long. Self-loops, repeated and reversed edges and null ends are ignored;
    an empty table gives an empty result. Each round hangs the larger neighbours of every node, then the
    smaller ones, on the smallest of them, so a chain shortens by a factor while the
    number of edges never grows. A node of very high degree is one row on one side of a join
    whose other side Spark may split; nothing is gathered per node. Every round is written
    to the checkpoint folder.
    """
    now = checkpointed(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    seen = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.shiftright(F.xxhash64("u", "v"), 16)), F.bit_xor(F.xxhash64("u", "v"))).head()
        if mark[0] == 0 or mark == seen:
            break
        seen = mark
        now = checkpointed(_small_star(_large_star(now)))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def _large_star(edges: DataFrame) -> DataFrame:
    around = edges.union(edges.select("v", "u")).toDF("u", "v")
    low = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return around.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low).distinct()
