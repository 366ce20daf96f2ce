"""Ranking inside groups too large for one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from limnocast.operators.joins import BROADCAST_ROWS, join_null_safe, sized  # noqa: F401
from limnocast.session import checkpointed

HOT_ROWS = 200_000
BINS = 512


def ranked_values(df: DataFrame, keys: Sequence[str], value: str, bins: int = BINS) -> DataFrame:
    """Distinct values per group with copies, rank of the last copy, and group size.

    Columns: keys, value, ``copies``, ``upto``, ``members``. Copies are counted first. The distinct values are then
    dealt into ``bins`` ranges of about equally many rows, cut at sampled quantiles of (group, value), so
    the shape of the values does not matter and a large group lies in many ranges. Counts are accumulated over
    ranges (at most ``bins`` rows per window), and only the inside of a range is sorted.
    """
    keys = list(keys)
    counted = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("copies"))
    dealt = counted.repartitionByRange(bins, *keys, value).withColumn("_bin", F.spark_partition_id())
    cut = checkpointed(dealt)

    totals = cut.groupBy(*keys, "_bin").agg(F.sum("copies").alias("_n"))
    over_bins = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys,
        "_bin",
        F.coalesce(F.sum("_n").over(over_bins), F.lit(0)).alias("_offset"),
        F.sum("_n").over(Window.partitionBy(*keys)).alias("members"),
    )
    inside = Window.partitionBy(*keys, "_bin").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    return (
        cut.withColumn("_run", F.sum("copies").over(inside))
        .transform(lambda d: join_null_safe(d, offsets, [*keys, "_bin"]))
        .select(*keys, value, "copies", (F.col("_offset") + F.col("_run")).alias("upto"), "members")
    )
