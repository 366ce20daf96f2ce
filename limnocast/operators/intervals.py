"""Joins of instants with intervals, as equi-joins on buckets of time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limnocast.functions.keys import DAY, epoch


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    point: str,
    start: str,
    end: str,
    keys: Sequence[str] = (),
    bucket_seconds: int = DAY,
) -> DataFrame:
    """Each row of ``points`` beside each interval that holds its instant, both ends included.

    An interval is copied to the buckets it reaches and an instant lies in one, so the join is on equal ``keys`` and buckets, and
    the ends are tested only within a bucket. Gaps, overlaps and intervals of any length may be mixed; a long one is spread
    over its buckets. An interval without a start or end, or that ends before it starts, holds nothing.
    """
    keys = list(keys)

    def bucket(name: str):
        return F.floor(epoch(F.col(name)) / bucket_seconds)

    reached = intervals.where(F.col(start) <= F.col(end)).withColumn(
        "_bucket", F.explode(F.sequence(bucket(start), bucket(end)))
    )
    placed = points.where(F.col(point).isNotNull()).withColumn("_bucket", bucket(point))
    joined = placed.join(reached, [*keys, "_bucket"])
    return joined.where((F.col(point) >= F.col(start)) & (F.col(point) <= F.col(end))).drop("_bucket")
