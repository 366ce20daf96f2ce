"""Equi-joins in which null keys match, and the merges built on them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limnocast.session import checkpointed

DEPTH_KEYS = ["_depth_value", "_depth_missing"]
BROADCAST_ROWS = 100_000


def with_depth_keys(df: DataFrame) -> DataFrame:
    """Add two plain columns that stand for the nullable ``depth`` as a join key.

    Joining on them is the null-safe comparison, and since they are ordinary columns
    a later grouping by them keeps the partitioning the join has set up.
    """
    return df.withColumns(
        {
            "_depth_value": F.coalesce("depth", F.lit(0.0)),
            "_depth_missing": F.col("depth").isNull(),
        }
    )


def depth_keyed(keys: Sequence[str]) -> list[str]:
    """``keys`` with ``depth`` replaced by its two stand-in columns."""
    plain = [k for k in keys if k != "depth"]
    return plain + DEPTH_KEYS if "depth" in keys else plain


def join_null_safe(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    condition: Column | None = None,
) -> DataFrame:
    """Join on equal keys with null equal to null; the left key columns are kept."""
    hidden = {k: f"_right_{k}" for k in keys}
    right = right.withColumnsRenamed(hidden)
    on = reduce(
        lambda a, b: a & b,
        [F.col(f"`{k}`").eqNullSafe(F.col(f"`{h}`")) for k, h in hidden.items()],
    )
    if condition is not None:
        on = on & condition
    joined = left.join(right, on, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*hidden.values())


def distinct_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct key rows; copies collapse before the shuffle."""
    return df.select(*[F.col(f"`{k}`") for k in keys]).distinct()


def sized(df: DataFrame) -> DataFrame:
    """Ask for a broadcast after counting that ``df`` is small; else leave joins to AQE.

    ``df`` is a written table, so the count costs nothing to speak of.
    """
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def restrict_to(df: DataFrame, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose keys are listed in ``groups``.

    The list is written out and counted. A short one is broadcast, for then a group may hold most of the rows, which
    a shuffle by its keys would bring to one task.
    """
    listed = sized(checkpointed(distinct_by(groups, keys)))
    return join_null_safe(df, listed, keys, "left_semi")


def keep_latest(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Union in which an incoming row replaces the stored row of the same key.

    The winner per key is a partial aggregate, so a key with many copies shrinks before it
    is shuffled. Of copies from one side the largest is kept.
    """
    values = [c for c in existing.columns if c not in keys]
    tagged = existing.withColumn("_new", F.lit(False)).unionByName(
        incoming.withColumn("_new", F.lit(True))
    )
    packed = F.col(values[0]) if len(values) == 1 else F.struct(*values)
    merged = tagged.groupBy(*keys).agg(
        F.max("_new").alias("_has_new"),
        F.max(F.when(F.col("_new"), packed)).alias("_incoming"),
        F.max(F.when(~F.col("_new"), packed)).alias("_stored"),
    )
    winner = F.when(F.col("_has_new"), F.col("_incoming")).otherwise(F.col("_stored"))
    picked = {values[0]: winner} if len(values) == 1 else {v: winner[v] for v in values}
    return merged.select(*[picked.get(c, F.col(c)).alias(c) for c in existing.columns])
