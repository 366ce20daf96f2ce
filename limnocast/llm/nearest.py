"""Nearest neighbours by a block matrix join on int8 products with error bounds."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from limnocast.llm.vectors import SLACK, Rounded, blocked, longs_of, usable, vectors_of, with_sizes
from limnocast.session import checkpointed

NEIGHBOURS = 10
#: Rows in a block of candidates and of queries, and blocks of candidates that a task walks through for one of queries.
CANDIDATE_ROWS, QUERY_ROWS, STRIPE_BLOCKS = 8192, 1024, 16
#: Beyond any loss by underflow, for vectors whose largest number is about 1.
TINY = 2.0**-900
#: Query rows whose distances to a block of candidates are held at a time.
STRIP_ROWS = 128


def exact_distances(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Distances in double precision, summed component by component in order as a plain loop would.

    Each difference is scaled by a power of two first, which changes no digit and keeps squares from
    leaving the range of doubles.
    """
    apart = np.ascontiguousarray(rows.T) - query[:, None]
    _, power = np.frexp(np.abs(apart).max(axis=0, initial=0.0))
    return np.ldexp(np.sqrt(np.add.reduce(np.ldexp(apart, -power) ** 2, axis=0)), power)


def nearest_in_block(
    queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, number: int, within: np.ndarray | None = None
) -> list[list[tuple[float, int]]]:
    """For each query its nearest rows with another id, as (distance, id) in order, one per id.

    ``within`` gives a distance for each query beyond which no row is of use.
    """
    out: list[list[tuple[float, int]]] = []
    # Bounds are taken after scaling all by one power of two, so that no norm leaves the range of doubles.
    _, power = np.frexp(max(np.abs(queries).max(initial=0.0), np.abs(rows).max(initial=0.0)))
    y = Rounded.of(np.ldexp(rows, -power))
    for begin in range(0, len(queries), STRIP_ROWS):
        strip, own = queries[begin : begin + STRIP_ROWS], query_ids[begin : begin + STRIP_ROWS]
        x = Rounded.of(np.ldexp(strip, -power))
        square = x.norm[:, None] ** 2 + y.norm[None, :] ** 2 - 2 * x.dots(y)
        near = np.sqrt(np.maximum(square, 0))
        # The true distance is within the two errors of that of the rounded vectors; cancellation needs room of its own.
        # What the scaling itself may have lost lies below TINY.
        room = x.error[:, None] + y.error + np.sqrt(SLACK) * 1e-2 * (x.norm[:, None] + y.norm) + TINY
        high = near + room
        high[own[:, None] == ids[None, :]] = np.inf
        # With repeated ids the bound must hold for as many rows as one id can have.
        least = number + len(ids) - len(np.unique(ids))
        limit = np.partition(high, least - 1, axis=1)[:, least - 1] if least <= len(ids) else np.full(len(strip), np.inf)
        if within is not None:
            limit = np.minimum(limit, np.ldexp(within[begin : begin + STRIP_ROWS], -power))
        maybe = (near - room <= limit[:, None]) & (own[:, None] != ids[None, :])
        for i in range(len(strip)):
            chosen = np.flatnonzero(maybe[i])
            exact = exact_distances(strip[i], rows[chosen])
            best: dict[int, float] = {}
            for distance, key in zip(exact.tolist(), ids[chosen].tolist(), strict=True):
                if distance < best.get(key, np.inf):
                    best[key] = distance
            out.append(heapq.nsmallest(number, ((d, key) for key, d in best.items())))
    return out


def _block(group: pd.DataFrame, number: int) -> pd.DataFrame:
    """A block of queries walks through the candidate blocks of a task with a heap each, whose worst distance only falls."""
    asking, offered = group[group["asks"]], group[~group["asks"]]
    flat = []
    for _, q in asking.iterrows():
        query_ids = longs_of(q["id"])
        queries = vectors_of(q["vector"], q["kind"], len(query_ids))
        best: list[dict[int, float]] = [{} for _ in query_ids]
        worst = np.full(len(query_ids), np.inf)
        for _, c in offered.iterrows():
            ids = longs_of(c["id"])
            found = nearest_in_block(queries, query_ids, vectors_of(c["vector"], c["kind"], len(ids)), ids, number, worst)
            for i, near in enumerate(found):
                held = best[i]
                for distance, key in near:
                    if distance < held.get(key, np.inf):
                        held[key] = distance
                if len(held) > number:
                    best[i] = held = {key: d for d, key in heapq.nsmallest(number, ((d, key) for key, d in held.items()))}
                if len(held) == number:
                    worst[i] = max(held.values())
        flat += [(int(key), other, d) for key, held in zip(query_ids, best, strict=True) for other, d in held.items()]
    return pd.DataFrame(flat, columns=["query_id", "vec_id", "score"])


def nearest(
    rows: DataFrame,
    is_query: Column,
    number: int = NEIGHBOURS,
    candidate_rows: int = CANDIDATE_ROWS,
    query_rows: int = QUERY_ROWS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the nearest rows of each query by Euclidean distance, nearest first.

    ``is_query`` picks the queries; every row with another id is a candidate. Fewer than ``number`` candidates are
    all returned; ties go to the smaller id. Vectors that are null, empty, zero or hold null or non-finite
    components take no part, nor do null ids; vectors of different lengths do not meet. A repeated row counts
    once; of several vectors under one id the nearest counts. An empty table gives an empty result.
    The result is exact: blocks are compared by int8 products, and what may be
    among the nearest by their error bounds is computed in double precision.
    """
    held = rows.where(usable(vector_col) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks")
    )
    held = checkpointed(held.distinct().withColumn("width", F.size("vector")))
    sizes = held.groupBy("width").agg(
        F.ceil(F.count("*") / candidate_rows).alias("candidate_blocks"),
        F.greatest(F.ceil(F.sum(F.col("asks").cast("long")) / query_rows), F.lit(1)).alias("query_blocks"),
    ).withColumn("stripes", F.ceil(F.col("candidate_blocks") / STRIPE_BLOCKS))
    dealt = with_sizes(held.withColumn("mix", F.xxhash64("id", "vector")), sizes, ["width"], "mix")
    every = dealt.withColumn("asks", F.lit(False)).withColumn("block", F.pmod("mix", "candidate_blocks"))
    asking = dealt.where("asks").withColumn("block", F.pmod("mix", "query_blocks"))
    keys = ["width", "asks", "block", "stripes", "query_blocks"]

    def met(side: DataFrame, stripe: Column, queries: Column) -> DataFrame:
        packed = blocked(side, keys, ["id"], "vector")
        return packed.select("width", stripe.alias("s"), queries.alias("q"), "asks", "id", "vector", "kind")

    def each(number: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(number) - 1))

    pairs = met(every, F.pmod("block", "stripes"), each("query_blocks")).union(met(asking, each("stripes"), F.col("block")))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        return _block(group, number)

    found = pairs.groupBy("width", "s", "q").applyInPandas(run, "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= number)
    return ranked.select("query_id", "rank", "vec_id", "score")
