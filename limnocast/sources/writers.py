"""Writers: partitioned archives whose partitions are replaced whole."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limnocast.schemas import (
    FORECAST_PARTITIONS,
    SCORE_PARTITIONS,
    STAGE2_PARTITIONS,
    STAGE3_PARTITIONS,
)
from limnocast.session import checkpointed
from limnocast.sources.catalogue import MONTH, is_by_month

STAGE3_ORDER = ["datetime", "family", "parameter", "variable"]


def write_partitions(
    df: DataFrame, path: str, partitions: Sequence[str], order: Sequence[str] = ()
) -> None:
    """Replace the partitions ``df`` has rows for and leave the others alone.

    The rebalance hint gathers each partition's rows into few files, and lets AQE split
    a partition that holds far more rows than the rest over several tasks. A ``month`` among the
    partitions is that of ``datetime``, so a day's rows touch the files of one month only.
    """
    if MONTH in partitions and MONTH not in df.columns:
        df = df.withColumn(MONTH, F.date_format("datetime", "yyyy-MM"))
    placed = df.hint("rebalance", *partitions)
    if order:
        placed = placed.sortWithinPartitions(*partitions, *order)
    (
        placed.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def write_forecasts(df: DataFrame, path: str) -> None:
    write_partitions(df, path, FORECAST_PARTITIONS)


def write_scores(df: DataFrame, path: str) -> None:
    write_partitions(df, path, SCORE_PARTITIONS)


def write_batch_scores(df: DataFrame, path: str) -> None:
    """Scores of one run, laid out like the forecasts they belong to."""
    write_partitions(df, path, FORECAST_PARTITIONS)


def write_stage2(df: DataFrame, path: str) -> None:
    """Forecast drivers, per issue date and site."""
    write_partitions(df, path, STAGE2_PARTITIONS)


def write_stage3(df: DataFrame, path: str) -> None:
    """History drivers per site, sorted inside each file."""
    write_partitions(df, path, STAGE3_PARTITIONS, STAGE3_ORDER)


def rewrite_partitions(df: DataFrame, path: str, partitions: Sequence[str], order: Sequence[str] = ()) -> None:
    """Replace partitions of the archive that ``df`` itself was read from.

    The result is written out in full before any partition is touched.
    """
    write_partitions(checkpointed(df), path, partitions, order)


def migrate_to_months(df: DataFrame, path: str, partitions: Sequence[str], order: Sequence[str] = ()) -> None:
    """Write an archive ``df`` of any layout anew by months under its ``partitions``; ``path`` must be new."""
    if is_by_month(df.sparkSession, path) is not None:
        raise ValueError(f"{path} is not new")
    write_partitions(df.drop(MONTH), path, [*partitions, MONTH], order)


def write_targets(df: DataFrame, path: str) -> None:
    df.select([F.col(f"`{c}`") for c in df.columns]).write.mode("overwrite").csv(
        path, header=True, nullValue="NA"
    )
