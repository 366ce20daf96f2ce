"""Wide to long, long to wide, appending, and selection of rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limnocast.functions.keys import relabel, sample_family


def melt(
    df: DataFrame,
    values: Sequence[str],
    names: Mapping[str, str] | None = None,
    drop_nulls: bool = True,
) -> DataFrame:
    """One row per (id columns, variable); ``names`` renames variables on the way."""
    ids = [c for c in df.columns if c not in values]
    long = df.unpivot(ids, list(values), "variable", "prediction")
    if names:
        long = long.withColumn("variable", relabel(F.col("variable"), names))
    return long.where(F.col("prediction").isNotNull()) if drop_nulls else long


def depths_wide(df: DataFrame, depths: Mapping[str, float]) -> DataFrame:
    """Predictions at the named depths side by side, other columns as the row id.

    A conditional maximum per depth is a partial aggregate over the two rows wanted.
    """
    ids = [c for c in df.columns if c not in ("depth", "prediction")]
    return (
        df.where(F.col("depth").isin(*depths.values()))
        .groupBy(*ids)
        .agg(
            *[
                F.max(F.when(F.col("depth") == at, F.col("prediction"))).alias(name)
                for name, at in depths.items()
            ]
        )
    )


def append(df: DataFrame, *others: DataFrame) -> DataFrame:
    """Union by name; columns one side lacks become null."""
    for other in others:
        df = df.unionByName(other, allowMissingColumns=True)
    return df


def archive_slice(
    forecasts: DataFrame,
    models: Sequence[str] | None = None,
    variables: Sequence[str] | None = None,
    depths: Sequence[float] | None = None,
    variable_types: Sequence[str] | None = None,
    issued: Column | None = None,
    dated: Column | None = None,
) -> DataFrame:
    """Equality and IN filters on the archive; they reach partitions and the scan.

    ``dated`` is the value of the partition column ``reference_date``.
    """
    tests = {
        "model_id": models,
        "variable": variables,
        "depth": depths,
        "variable_type": variable_types,
    }
    for column, wanted in tests.items():
        if wanted is not None:
            forecasts = forecasts.where(F.col(column).isin(*wanted))
    if dated is not None:
        forecasts = forecasts.where(F.col("reference_date") == dated)
    if issued is not None:
        forecasts = forecasts.where(F.col("reference_datetime") == issued)
    return forecasts


def scoreable(forecasts: DataFrame, targets: DataFrame) -> DataFrame:
    """Complete forecast rows no later than the last observation, families normalised."""
    return forecasts.where(
        (F.col("datetime") <= last_observed(targets).scalar())
        & F.col("model_id").isNotNull()
        & F.col("parameter").isNotNull()
        & F.col("prediction").isNotNull()
    ).withColumn("family", sample_family(F.col("family")))


def last_observed(targets: DataFrame) -> DataFrame:
    """One row: the time of the last non-null observation."""
    return targets.where(F.col("observation").isNotNull()).agg(F.max("datetime").alias("datetime"))


def latest_issue(forecasts: DataFrame, models: Sequence[str]) -> DataFrame:
    """One row: the latest issue time over a set of models.

    With a ``reference_date`` partition column the newest date is found first, by a scan that
    reads no data column, and only that date's rows are read for the time.
    """
    chosen = forecasts.where(F.col("model_id").isin(*models))
    if "reference_date" in forecasts.columns:
        chosen = chosen.where(F.col("reference_date") == newest_date(forecasts, models))
    return chosen.agg(F.max("reference_datetime").alias("reference_datetime"))


def newest_date(forecasts: DataFrame, models: Sequence[str]) -> Column:
    """The newest ``reference_date`` of a set of models, as a scalar that prunes partitions."""
    return forecasts.where(F.col("model_id").isin(*models)).agg(F.max("reference_date")).scalar()


def latest_slice(forecasts: DataFrame, models: Sequence[str], **tests) -> DataFrame:
    """Rows of the latest issue; of an archive by ``reference_date`` only that date's partitions are read."""
    dated = newest_date(forecasts, models) if "reference_date" in forecasts.columns else None
    issued = latest_issue(forecasts, models).scalar()
    return archive_slice(forecasts, models=models, issued=issued, dated=dated, **tests)


def extent(df: DataFrame) -> DataFrame:
    """One row: first and last time held."""
    return df.agg(F.min("datetime").alias("min"), F.max("datetime").alias("max"))


def date_trim(df: DataFrame, start: str, end: str | None = None) -> DataFrame:
    """Rows dated ``start`` to ``end``, both included; one day when ``end`` is absent.

    Written as a half-open range of the time column itself so that it is pushed to the scan.
    """
    return df.where(between_days(df, start, end))


def between_days(df: DataFrame, start: str, end: str | None = None) -> Column:
    """The test of ``date_trim``."""
    kind = df.schema["datetime"].dataType
    first = F.lit(start).cast("date").cast(kind)
    after = F.date_add(F.lit(end or start).cast("date"), 1).cast(kind)
    return (F.col("datetime") >= first) & (F.col("datetime") < after)
