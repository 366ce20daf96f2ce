"""Gridded weather: nearest cell, nearest issue, time slices, members."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from limnocast.functions.keys import DAY, epoch


def nearest_cell(grid: DataFrame, lon: float, lat: float) -> DataFrame:
    """Rows of the cell nearest to a point, each axis chosen on its own.

    Of two coordinates equally close the larger is taken. Both come from one pass over
    the two axis columns, as a scalar inside the filter.
    """

    def closest(axis: str, wanted: float) -> Column:
        distance = F.struct(F.abs(F.col(axis) - F.lit(wanted)), -F.col(axis))
        return F.min_by(axis, distance).alias(axis)

    cell = grid.agg(
        F.struct(closest("latitude", lat), closest("longitude", lon)).alias("cell")
    ).scalar()
    return grid.where(
        (F.col("latitude") == cell["latitude"]) & (F.col("longitude") == cell["longitude"])
    )


def nearest_issues(grid: DataFrame, start: str, end: str) -> DataFrame:
    """For each date ``start`` to ``end`` the issue time closest to it.

    Every issue time owns the dates between the midpoints to its neighbours. The window
    runs over distinct issue times, the time axis of the grid, not over its data.
    """
    axis = grid.select("init_time").distinct().withColumn("_t", epoch(F.col("init_time")))
    order = Window.orderBy("_t")
    first, last = (F.unix_date(F.lit(d).cast("date")) for d in (start, end))
    lower = F.ceil((F.lag("_t").over(order) + F.col("_t")) / F.lit(2.0 * DAY))
    upper = F.ceil((F.lead("_t").over(order) + F.col("_t")) / F.lit(2.0 * DAY)) - 1
    owned = axis.select(
        "init_time",
        F.greatest(first, F.coalesce(lower, first)).alias("_from"),
        F.least(last, F.coalesce(upper, last)).alias("_to"),
    )
    return owned.where(F.col("_from") <= F.col("_to")).select(
        "init_time",
        F.explode(F.sequence("_from", "_to")).alias("_day"),
    ).select("init_time", F.date_from_unix_date(F.col("_day").cast("int")).alias("reference_datetime"))


def anchored_slice(df: DataFrame, time: str, start: str, end: str, anchor_days: int = 1) -> DataFrame:
    """Times from ``start`` through ``end`` plus the anchor days, both ends included.

    The day after the end gives interpolation a sample to run to.
    """
    kind = df.schema[time].dataType
    first = F.lit(start).cast("date").cast(kind)
    after = F.date_add(F.lit(end).cast("date"), anchor_days + 1).cast(kind)
    return df.where((F.col(time) >= first) & (F.col(time) < after))


def replicate_members(df: DataFrame, members: int, column: str = "parameter") -> DataFrame:
    """The same series for every member 0 .. members - 1."""
    ids = F.transform(F.sequence(F.lit(0), F.lit(members - 1)), lambda i: i.cast("double"))
    keep = [c for c in df.columns if c != column]
    return df.select(*keep, F.explode(ids).alias(column))
