"""Scoring jobs: incremental against a score archive, and of one batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from limnocast.functions.keys import horizon_fraction
from limnocast.operators.joins import join_null_safe
from limnocast.operators.ranking import HOT_ROWS
from limnocast.operators.reshape import archive_slice, scoreable
from limnocast.operators.scoring import merge_scores, score_forecasts, still_valid
from limnocast.schemas import SCORE_PARTITIONS, SCORE_SCHEMA, conform
from limnocast.session import checkpointed
from limnocast.sources.catalogue import MONTH, archive_partitions
from limnocast.sources.readers import read_forecasts, read_layout, read_scores, read_targets
from limnocast.sources.writers import rewrite_partitions


def score_incremental(
    forecasts: DataFrame,
    targets: DataFrame,
    scores: DataFrame | None = None,
    rescore: bool = False,
    tolerance: float = 1e-2,
    absolute: bool = False,
    summaries: bool = True,
    hot_rows: int = HOT_ROWS,
    extra_groups: Sequence[str] = (),
) -> DataFrame:
    """Scores of the forecasts that have an observation and no valid score yet.

    ``rescore`` treats a score whose observation has since changed as not there.
    """
    if scores is not None and rescore:
        scores = still_valid(scores, targets, tolerance, absolute)
    return score_forecasts(scoreable(forecasts, targets), targets, summaries, hot_rows, scores, extra_groups)


def update_scores(
    spark: SparkSession,
    forecasts_path: str,
    targets_path: str,
    scores_path: str,
    duration: str = "P1D",
    latest_only: bool = False,
    by_month: bool | None = None,
    **options,
) -> None:
    """Score what is new and merge it into the score archive.

    Only the (site, variable, model) partitions that gain a score are read back and
    replaced, with all they hold, rows without an observation included. New scores are written out
    once, since both steps use them. A new archive has a level of months of valid time below, so that a daily run replaces
    the files of a month and not of all time; an archive stored without months stays so (``migrate_to_months`` makes
    one of the other). ``by_month`` asks for either.
    """
    layout = archive_partitions(spark, scores_path, SCORE_PARTITIONS, by_month)
    forecasts = read_forecasts(spark, forecasts_path).withColumn("duration", F.lit(duration))
    targets = read_targets(spark, targets_path)
    stored = read_scores(spark, scores_path)
    new = checkpointed(
        conform(score_incremental(forecasts, targets, stored, **options), SCORE_SCHEMA)
    )
    touched = touched_partitions(read_layout(spark, scores_path, SCORE_SCHEMA, layout), new, layout)
    rewrite_partitions(merge_scores(touched.drop(MONTH), new, latest_only), scores_path, layout)


def touched_partitions(stored: DataFrame, new: DataFrame, partitions: Sequence[str] = SCORE_PARTITIONS) -> DataFrame:
    """Rows of the stored partitions that ``new`` has rows for; the scan opens no others.

    The driver gets one row per partition touched, and asks for those partitions by value.
    """
    if MONTH in partitions:
        new = new.withColumn(MONTH, F.date_format("datetime", "yyyy-MM"))
    touched = new.select(*partitions).distinct()
    groups = touched.collect()
    if not groups:
        return stored.limit(0)
    for column in partitions:
        values = {g[column] for g in groups}
        wanted = F.col(column).isin(sorted(values - {None}))
        stored = stored.where(wanted | F.col(column).isNull() if None in values else wanted)
    return join_null_safe(stored, touched, partitions, "left_semi")


def score_batch(
    forecasts: DataFrame,
    targets: DataFrame,
    variable_types: Sequence[str] = ("state",),
    hot_rows: int = HOT_ROWS,
    extra_groups: Sequence[str] = (),
) -> DataFrame:
    """Scores of one run's variables of the given types, with horizon and issue date."""
    chosen = archive_slice(forecasts, variable_types=variable_types)
    issued = F.col("reference_datetime")
    return score_forecasts(chosen, targets, True, hot_rows, None, extra_groups).withColumns(
        {
            "horizon": horizon_fraction(issued, F.col("datetime")),
            "reference_date": F.date_format(issued, "yyyy-MM-dd"),
        }
    )
