"""Diagnostics derived from a forecast archive, and their place in it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from limnocast.functions.keys import existing
from limnocast.functions.water import Hypsography
from limnocast.operators.profiles import METRICS, PROFILE_KEY, mixing_probability, profile_metrics
from limnocast.operators.reshape import append, melt
from limnocast.schemas import FORECAST_PARTITIONS, with_constants
from limnocast.sources.readers import read_forecasts
from limnocast.sources.writers import rewrite_partitions

MIXED = "prob_mixed_density"


def _as_archive(rows: DataFrame, like: DataFrame, **constants) -> DataFrame:
    """Add the constant columns and conform to the columns and types of ``like``."""
    full = with_constants(rows, **constants)
    if "reference_date" not in full.columns:
        full = full.withColumn("reference_date", F.date_format("reference_datetime", "yyyy-MM-dd"))
    have = set(full.columns)
    return full.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in like.schema.fields
        ]
    )


def _keys(forecasts: DataFrame) -> list[str]:
    """What tells profiles apart, and the partition that their derived rows belong to."""
    return existing(forecasts, [*PROFILE_KEY, "reference_date"])


def mixing_rows(forecasts: DataFrame, top=0.5, bottom=5.0, threshold=0.1) -> DataFrame:
    """Mixing probability as archive rows of family ``bernoulli``."""
    return _as_archive(
        mixing_probability(forecasts, top, bottom, threshold, _keys(forecasts)),
        forecasts,
        family="bernoulli",
        parameter="prob",
        variable=MIXED,
        variable_type="diagnostic",
        log_weight=0.0,
    )


def metric_rows(forecasts: DataFrame, hypsography: Hypsography, **options) -> DataFrame:
    """Profile diagnostics as archive rows, one per metric and member."""
    wide = profile_metrics(forecasts, hypsography, keys=_keys(forecasts), **options)
    return _as_archive(
        melt(wide, METRICS, drop_nulls=False),
        forecasts,
        family="ensemble",
        variable_type="diagnostic",
        log_weight=0.0,
    )


def with_diagnostics(forecasts: DataFrame, hypsography: Hypsography, **options) -> DataFrame:
    """Forecast rows plus the rows derived from them.

    Rows derived earlier are dropped first, so a second run gives the same table.
    """
    source = forecasts.where(~F.col("variable").isin(MIXED, *METRICS))
    return append(source, mixing_rows(source), metric_rows(source, hypsography, **options))


def add_diagnostics(
    spark: SparkSession,
    path: str,
    site_id: str,
    model_id: str,
    reference_date: str,
    hypsography: Hypsography,
) -> None:
    """Derive diagnostics for one stored forecast and rewrite its partition."""
    stored = read_forecasts(spark, path).where(
        (F.col("site_id") == site_id)
        & (F.col("model_id") == model_id)
        & (F.col("reference_date") == reference_date)
    )
    rewrite_partitions(with_diagnostics(stored, hypsography), path, FORECAST_PARTITIONS)
