"""Shards cut from a Hilbert curve over quantised metadata, so that files can be skipped on several columns."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from limnocast.session import checkpointed

SHARDS = 16
#: Bits of each dimension on the curve: sixteen levels of about equally many rows each.
BITS = 4


def hilbert_index(point: tuple[int, ...], bits: int) -> int:
    """Place of a grid point on the Hilbert curve, with ``bits`` bits in each of its dimensions.

    Level by level: the cell's corner bits are turned into the frame of the sub-cube that the curve
    is in, their Gray rank is the next digit, and the frame moves on to that sub-cube.
    """
    n = len(point)
    full = (1 << n) - 1

    def left(x: int, by: int) -> int:
        by %= n
        return (x << by | x >> (n - by)) & full

    def ones(x: int) -> int:
        return (~x & (x + 1)).bit_length() - 1

    place = entry = axis = 0
    for level in reversed(range(bits)):
        corner = sum((c >> level & 1) << i for i, c in enumerate(point))
        rank = turned = left(corner ^ entry, -(axis + 1))
        while turned := turned >> 1:
            rank ^= turned
        place = place << n | rank
        low = 0 if rank == 0 else (rank - 1) & ~1
        entry ^= left(low ^ low >> 1, axis + 1)
        axis = (axis + 1 + (0 if rank == 0 else ones(rank if rank & 1 else rank - 1))) % n
    return place


def hilbert_indices(points: np.ndarray, bits: int) -> np.ndarray:
    """``hilbert_index`` of each row of ``points``."""
    number, n = points.shape
    full = (1 << n) - 1

    def left(x: np.ndarray, by: np.ndarray) -> np.ndarray:
        by = by % n
        return (x << by | x >> (n - by)) & full

    place, entry, axis = (np.zeros(number, np.int64) for _ in range(3))
    ones = np.array([(~x & (x + 1)).bit_length() - 1 for x in range(full + 1)])
    for level in reversed(range(bits)):
        corner = sum((points[:, i] >> level & 1) << i for i in range(n))
        rank = turned = left(corner ^ entry, -(axis + 1))
        for _ in range(n):
            turned = turned >> 1
            rank = rank ^ turned
        place = place << n | rank
        low = np.where(rank == 0, 0, (rank - 1) & ~1)
        entry = entry ^ left(low ^ low >> 1, axis + 1)
        axis = (axis + 1 + np.where(rank == 0, 0, ones[np.where(rank & 1, rank, rank - 1)])) % n
    return place


def _text_cuts(rows: DataFrame, name: str, levels: int) -> list[str | None]:
    """Strings at which a column is cut into levels of about equally many rows; null where nulls fill the levels below.

    Distinct values are counted, dealt into ranges in their order and accumulated: by range first, then inside.
    """
    counted = rows.groupBy(name).agg(F.count("*").alias("n"))
    dealt = counted.where(F.col(name).isNotNull()).repartitionByRange(F.col(name)).withColumn("range", F.spark_partition_id())
    dealt = checkpointed(dealt)
    sums = rows.agg(F.count("*").alias("all"), F.count(F.when(F.col(name).isNull(), 1)).alias("nulls")).head()
    # One row per range of the sort.
    earlier = F.coalesce(F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = dealt.groupBy("range").agg(F.sum("n").alias("n")).select("range", earlier.alias("earlier"))
    inside = F.sum("n").over(Window.partitionBy("range").orderBy(name).rowsBetween(Window.unboundedPreceding, 0))
    upto = dealt.withColumn("inside", inside).join(offsets, "range").withColumn("upto", F.col("earlier") + F.col("inside") + sums["nulls"])
    steps = [sums["all"] * i / levels for i in range(1, levels)]
    cuts = upto.agg(*[F.min(F.when(F.col("upto") >= step, F.col(name))).alias(f"q{i}") for i, step in enumerate(steps)]).head()
    return [None if sums["nulls"] >= step else cut for step, cut in zip(steps, cuts, strict=True)]


def _levels(rows: DataFrame, dims: list[str], bits: int) -> list[Column]:
    """The level of a row in each dimension: quantiles over all rows, null first, equal cuts once."""
    kinds, out = dict(rows.dtypes), {}
    steps = [i / (1 << bits) for i in range(1, 1 << bits)]
    codes = {d: F.coalesce(F.col(d).cast("double"), F.lit(float("-inf"))) for d in dims if kinds[d] != "string"}
    numbers = rows.agg(*(F.percentile_approx(c, steps, 10_000).alias(d) for d, c in codes.items())).head() if codes else {}
    for d in dims:
        level = F.lit(0)
        if d in codes:
            for cut in sorted(set(numbers[d] or [])):
                level = level + (codes[d] > cut).cast("int")
        else:
            cuts = set(_text_cuts(rows, d, 1 << bits))
            if None in cuts:
                level = level + F.col(d).isNotNull().cast("int")
            for cut in sorted(cuts - {None}):
                level = level + F.coalesce(F.col(d) > cut, F.lit(False)).cast("int")
        out[d] = level
    return [out[d] for d in dims]


def _on_curve(rows: DataFrame, dims: list[str], bits: int) -> DataFrame:
    """``rows`` with ``curve``, the place of their cell."""
    if bits * len(dims) > 62:
        raise ValueError("a place on the curve of so many dimensions does not fit 64 bits")

    @F.pandas_udf("long")
    def place(*levels: pd.Series) -> pd.Series:
        return pd.Series(hilbert_indices(np.stack([x.to_numpy(np.int64) for x in levels], axis=1), bits))

    return rows.withColumn("curve", place(*_levels(rows, dims, bits)))


def _ranked(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with ``rank`` from 0 in the order of ``keys``: sorted in ranges, then offset by range."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = F.monotonically_increasing_id()
    ordered = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("_at", at)
    ordered = checkpointed(ordered).withColumn("_part", F.shiftright("_at", 33))
    ordered = ordered.withColumn("_place", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
    # One row per range of the sort, so this window and this broadcast are as small as the number of tasks.
    before = F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = ordered.groupBy("_part").agg(F.count("*").alias("n")).select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    return ordered.join(F.broadcast(offsets), "_part").withColumn("rank", F.col("_before") + F.col("_place")).drop(
        "_at", "_part", "_place", "_before"
    )


def shard(
    docs: DataFrame,
    shards: int = SHARDS,
    dims: tuple[str, ...] = ("lang", "source"),
    bits: int = BITS,
    id_col: str = "doc_id",
    text_col: str = "text",
    row_col: str | None = None,
) -> DataFrame:
    """Where each row of ``docs`` goes: ``(doc_id, size, text_crc32, law, shard, slot, grown_shard, curve)``.

    Rows are put in the order of a Hilbert curve over the columns ``dims`` and the size, each cut
    at its quantiles, and the order is cut into ``shards`` runs whose counts are at most one apart (law ``rows``).
    Rows of one cell are ordered by the checksum of the text and the id, so equal texts of a cell stand together.
    ``size`` is the bytes of the text and 1; a null text has none and checksum 0. Nulls come first in a dimension. ``slot`` counts
    from 0 in a shard. Repeated rows each get a slot; with fewer rows than shards the last stay empty. ``row_col``
    names a column to hand on. Only these few columns are shuffled, never the texts.
    """
    held = checkpointed(
        docs.select(
            F.col(id_col).alias("_id"),
            *([F.col(row_col).alias("_row")] if row_col else []),
            *(F.col(d).alias(f"_d{i}") for i, d in enumerate(dims)),
            (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long").alias("size"),
            F.coalesce(F.crc32(F.col(text_col).cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        )
    )
    placed = _on_curve(held, [*(f"_d{i}" for i in range(len(dims))), "size"], bits)
    ranked = _ranked(placed, ["curve", "text_crc32", "_id", "size"])
    each, more = divmod(held.count(), shards)
    long = more * (each + 1)
    rank = F.col("rank")
    number = F.when(rank < long, F.floor(rank / (each + 1))).otherwise(more + F.floor((rank - long) / max(1, each)))
    ranked = ranked.withColumn("shard", number.cast("int"))
    start = F.col("shard") * each + F.least("shard", F.lit(more))
    return ranked.select(
        F.col("_id").alias(id_col),
        *([F.col("_row").alias(row_col)] if row_col else []),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        (rank - start).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, dims: tuple[str, ...] = ("lang", "source"), **names: str) -> None:
    """Write the rows of ``docs`` to ``path`` as one folder ``shard=N`` per shard, in the order of the curve.

    ``docs`` must read the same twice, as files do, and have no column ``shard`` or ``_row``.
    """
    marked = docs.withColumn("_row", F.monotonically_increasing_id())
    place = shard(marked, shards, dims, row_col="_row", **names).select("_row", "shard", "slot")
    out = marked.join(place, "_row").repartitionByRange(4 * shards, "shard", "slot").sortWithinPartitions("shard", "slot")
    out.drop("_row", "slot").write.partitionBy("shard").parquet(path)


def manifest(written: DataFrame, dims: tuple[str, ...] = ("lang", "source"), text_col: str = "text") -> DataFrame:
    """Per shard of what ``write_shards`` wrote: rows, bytes and the range of each dimension, to choose files by."""
    size = (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long")
    ranges = [f(d).alias(f"{f.__name__}_{d}") for d in dims for f in (F.min, F.max)]
    return written.groupBy("shard").agg(
        F.count("*").alias("rows"), F.sum(size).alias("bytes"), *ranges, F.min(size).alias("min_size"), F.max(size).alias("max_size")
    )
