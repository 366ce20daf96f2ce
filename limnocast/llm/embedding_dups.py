"""Near-duplicate vectors by int8 tile products with error bounds."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limnocast.llm.graph import Forest, components
from limnocast.llm.vectors import SLACK, Rounded, blocked, longs_of, usable, vectors_of, with_sizes
from limnocast.session import checkpointed

COSINE = 0.98
#: Vectors in a block; a tile is a pair of blocks.
BLOCK_ROWS = 2048
#: Numbers in the arrays of pairs that are computed again in full.
PAIR_NUMBERS = 1 << 22


def tile_links(
    a: np.ndarray, b: np.ndarray | None, cosine: float
) -> tuple[np.ndarray, np.ndarray]:
    """Places of the linked pairs of ``a`` and ``b``, or within ``a``; vectors are double and not zero."""
    a = a / np.abs(a).max(axis=1, keepdims=True)
    a = a / np.sqrt((a * a).sum(axis=1, keepdims=True))
    if b is None:
        b = a
        within = True
    else:
        b = b / np.abs(b).max(axis=1, keepdims=True)
        b = b / np.sqrt((b * b).sum(axis=1, keepdims=True))
        within = False
    x, y = Rounded.of(a), Rounded.of(b)
    # |u.v - u'.v'| <= |u'| |dv| + |du| |v'| + |du| |dv| for the rounded u', v' and their errors.
    bound = x.norm[:, None] * y.error + x.error[:, None] * (y.norm + y.error)
    maybe = x.dots(y) + bound >= cosine - SLACK
    if within:
        maybe = np.triu(maybe, 1)
    rows, cols = np.nonzero(maybe)
    step = max(1, PAIR_NUMBERS // a.shape[1])
    keep = np.empty(len(rows), bool)
    for i in range(0, len(rows), step):
        part = slice(i, i + step)
        keep[part] = np.einsum("ij,ij->i", a[rows[part]], b[cols[part]]) >= cosine
    return rows[keep], cols[keep]


def _tile(group: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Per linked vector of a tile: its number of links there, and a vector it hangs on."""
    sides = [group.iloc[i] for i in range(len(group))]
    ids, copies = [longs_of(s["key"]) for s in sides], [longs_of(s["copies"]) for s in sides]
    vectors = [vectors_of(s["vector"], s["kind"], len(i)) for s, i in zip(sides, ids, strict=True)]
    i, j = tile_links(vectors[0], vectors[1] if len(sides) > 1 else None, cosine)
    if len(sides) > 1:
        j = j + len(ids[0])
    key, number = np.concatenate(ids), np.concatenate(copies)
    links = np.bincount(i, number[j], len(key)) + np.bincount(j, number[i], len(key))
    forest = Forest(len(key))
    forest.link(i, j)
    linked = np.flatnonzero(links)
    return pd.DataFrame({"a": key[linked], "b": key[forest.label[linked]], "links": links[linked].astype(np.int64)})


def near_duplicates(
    rows: DataFrame,
    cosine: float = COSINE,
    block_rows: int = BLOCK_ROWS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for each row.

    Rows of one label link if their cosine is ``cosine`` or more. Vectors that are null, empty, zero or
    hold null or non-finite components link with nothing, nor do rows without a label; vectors of different
    lengths do not link. A component is named by its smallest id. Repeated rows are vectors of their own that
    link with each other. A null id is never a name and never kept. An empty table gives an empty result.

    Copies collapse first and count in the links. The rest of a label is dealt into blocks of about
    ``block_rows``; each pair of blocks is a task that gives at most one row per vector, however many links it has.
    """
    held = rows.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(label_col).alias("label"),
        F.when(usable(vector_col) & F.col(label_col).isNotNull(), F.col(vector_col)).alias("vector"),
    )
    fit = held.where("vector is not null")
    classes = fit.groupBy("label", "vector").agg(F.count("*").alias("copies"), F.min("id").alias("low"))
    classes = checkpointed(classes.withColumn("key", F.monotonically_increasing_id()).withColumn("width", F.size("vector")))
    sizes = classes.groupBy("label", "width").agg(F.ceil(F.count("*") / block_rows).alias("blocks"))
    dealt = with_sizes(classes, sizes, ["label", "width"], "key").withColumn("block", F.pmod(F.xxhash64("key"), "blocks"))
    blocks = blocked(dealt, ["label", "width", "blocks", "block"], ["key", "copies"], "vector")
    tiles = blocks.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "label", "width", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "block", "key", "copies", "vector", "kind",
    )

    def run(group: pd.DataFrame) -> pd.DataFrame:
        return _tile(group.sort_values("block"), cosine)

    linked = checkpointed(tiles.groupBy("label", "width", "low", "high").applyInPandas(run, "a long, b long, links long"))
    links = linked.groupBy(F.col("a").alias("key")).agg(F.sum("links").alias("links"))
    root = components(linked.select("a", "b")).withColumnRenamed("node", "key")
    named = classes.join(links, "key", "left").join(root, "key", "left").withColumn("root", F.coalesce("root", "key"))
    names = named.groupBy("root").agg(F.min("low").alias("component_id"))
    found = named.join(names, "root").select(
        "label", "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    placed = fit.join(found, ["label", "vector"]).select("id", "n_links", "component_id")
    alone = held.where("vector is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept")
    return placed.union(alone).select(F.col("id").alias(id_col), "n_links", "component_id", kept)
