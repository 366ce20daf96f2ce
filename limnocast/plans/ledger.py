"""Incremental scoring that opens only what can hold something new.

Two small logs beside the scores say what the last runs saw. The ledger has a row per forecast partition scored: the mark of its
files, and the span of its valid times. The other holds every version of an observation a run has met. From them and a
listing of the archive follow the partitions to open: those whose files are new or rewritten, and those
whose span holds an observation that is new or has changed since it was scored. Both logs are only ever appended to, after the scores
are written; a run that fails in between is repeated by the next one, which gives the same scores.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from limnocast.operators.intervals import interval_join
from limnocast.operators.joins import depth_keyed, join_null_safe, with_depth_keys
from limnocast.operators.scoring import OBSERVATION_KEY, merge_scores, observed
from limnocast.plans.scorekeeping import score_incremental, touched_partitions
from limnocast.schemas import FORECAST_PARTITIONS, FORECAST_SCHEMA, SCORE_PARTITIONS, SCORE_SCHEMA, TARGET_SCHEMA, conform
from limnocast.session import checkpointed
from limnocast.sources.catalogue import MONTH, archive_partitions, stored_partitions
from limnocast.sources.readers import read_layout, read_or_empty, read_targets
from limnocast.sources.writers import rewrite_partitions

LEDGER_KEY = [*FORECAST_PARTITIONS, "duration"]
LEDGER_SCHEMA = T.StructType(
    [
        *(T.StructField(k, T.StringType()) for k in LEDGER_KEY),
        T.StructField("mark", T.LongType()),
        T.StructField("first_valid", T.TimestampType()),
        T.StructField("last_valid", T.TimestampType()),
        T.StructField("noted", T.TimestampType()),
    ]
)
SEEN_SCHEMA = T.StructType(
    [*TARGET_SCHEMA.fields, T.StructField("live", T.BooleanType()), T.StructField("noted", T.TimestampType())]
)


def latest_notes(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last row noted of each key."""
    rest = [c for c in log.columns if c not in (*keys, "noted")]
    last = log.groupBy(*keys).agg(F.max_by(F.struct(*rest), "noted").alias("_last"))
    return last.select(*keys, *[F.col("_last")[c].alias(c) for c in rest])


def observation_changes(
    now: DataFrame, seen: DataFrame, tolerance: float = 1e-2, absolute: bool = False
) -> DataFrame:
    """The change set of observations: ``(key, was, observation, change)``.

    ``change`` is ``new`` for a key that was never seen, ``changed`` for a version seen that no observation of now is within
    ``tolerance`` of, and ``gone`` for one whose key has none now. The test is that of ``still_valid``: relative to the signed
    version seen, or to its size with ``absolute``.
    """
    keys = depth_keyed(OBSERVATION_KEY)
    current = with_depth_keys(observed(now))
    before = with_depth_keys(observed(seen))
    new = current.join(before.select(*keys).distinct(), keys, "left_anti").select(
        *OBSERVATION_KEY, F.lit(None).cast("double").alias("was"), "observation", F.lit("new").alias("change")
    )
    was, value = F.col("observation"), F.col("_now")
    scale = F.nullif(F.abs(was) if absolute else was, F.lit(0.0))
    near = F.coalesce(F.abs(was - value) / scale < tolerance, F.lit(False))
    beside = before.join(current.select(*keys, F.col("observation").alias("_now")), keys, "left")
    judged = beside.groupBy(*OBSERVATION_KEY, "observation").agg(F.max(near).alias("_near"), F.max("_now").alias("_now"))
    moved = judged.where(~F.col("_near")).select(
        *OBSERVATION_KEY, was.alias("was"), F.col("_now").alias("observation"),
        F.when(F.col("_now").isNull(), "gone").otherwise("changed").alias("change"),
    )
    return new.unionByName(moved)


def partitions_to_open(stored: DataFrame, ledger: DataFrame, fresh: DataFrame) -> DataFrame:
    """Keys of the ``stored`` partitions that can hold something to score.

    ``stored`` and ``ledger`` have the ledger's key and ``mark``, the ledger also the span of valid times; ``fresh`` has the
    ``site_id`` and ``datetime`` of observations that are new or have changed. No forecast is read.
    """
    keys = [*LEDGER_KEY, "mark"]
    rewritten = join_null_safe(stored.select(*keys), ledger, keys, "left_anti").select(*LEDGER_KEY)
    known = join_null_safe(ledger, stored, keys, "left_semi")
    instants = fresh.select(F.col("site_id"), "datetime").distinct()
    reached = interval_join(instants, known, "datetime", "first_valid", "last_valid", ["site_id"])
    return rewritten.unionByName(reached.select(*LEDGER_KEY)).distinct()


def _append(df: DataFrame, path: str, at: datetime) -> None:
    df.withColumn("noted", F.lit(at)).write.mode("append").parquet(path)


def update_scores_by_ledger(
    spark: SparkSession,
    forecasts_path: str,
    targets_path: str,
    scores_path: str,
    state_path: str,
    duration: str = "P1D",
    latest_only: bool = False,
    rescore: bool = False,
    tolerance: float = 1e-2,
    absolute: bool = False,
    by_month: bool | None = None,
    **options,
) -> list[str]:
    """``update_scores`` that opens only the forecast partitions the ledger in ``state_path`` calls for; returns their folders.

    Gives the scores a full run gives. Where nothing is new no forecast and no score is read. A score archive that is not there
    makes the logs void: all is scored anew. Another ``duration`` has a ledger of its own.
    """
    at = datetime.now(timezone.utc)
    targets = read_targets(spark, targets_path)
    ledger_path, seen_path = f"{state_path}/ledger", f"{state_path}/observations"
    layout = archive_partitions(spark, scores_path, SCORE_PARTITIONS, by_month)
    ledger = latest_notes(read_or_empty(spark, ledger_path, LEDGER_SCHEMA), LEDGER_KEY)
    seen = latest_notes(read_or_empty(spark, seen_path, SEEN_SCHEMA), [*OBSERVATION_KEY, "observation"])
    if stored_partitions(spark, scores_path, []).isEmpty():
        ledger, seen = ledger.limit(0), seen.limit(0)

    changes = checkpointed(observation_changes(targets, seen.where("live"), tolerance, absolute))
    called = changes.where("change = 'new'" if not rescore else "change <> 'gone'")
    stored = stored_partitions(spark, forecasts_path, FORECAST_PARTITIONS).withColumn("duration", F.lit(duration))
    stored = checkpointed(stored)
    opened = checkpointed(
        join_null_safe(stored, partitions_to_open(stored, ledger, called), LEDGER_KEY, "left_semi").select(*LEDGER_KEY, "folder", "mark")
    )
    folders = sorted(r["folder"] for r in opened.select("folder").collect())
    if folders:
        reader = spark.read.schema(FORECAST_SCHEMA).option("basePath", forecasts_path)
        forecasts = reader.parquet(*folders).withColumn("duration", F.lit(duration))
        spans = forecasts.groupBy(*LEDGER_KEY).agg(F.min("datetime").alias("first_valid"), F.max("datetime").alias("last_valid"))
        spans = checkpointed(join_null_safe(opened.select(*LEDGER_KEY, "mark"), spans, LEDGER_KEY, "left"))
        stored_scores = read_layout(spark, scores_path, SCORE_SCHEMA, layout)
        kept = scores_beside(stored_scores, spans).where(F.col("observation").isNotNull()).drop(MONTH)
        new = checkpointed(
            conform(
                score_incremental(forecasts, targets, kept, rescore=rescore, tolerance=tolerance, absolute=absolute, **options),
                SCORE_SCHEMA,
            )
        )
        if not new.isEmpty():
            touched = touched_partitions(stored_scores, new, layout).drop(MONTH)
            rewrite_partitions(merge_scores(touched, new, latest_only), scores_path, layout)
        _append(spans.select(*LEDGER_KEY, "mark", "first_valid", "last_valid"), ledger_path, at)
    versions = [*OBSERVATION_KEY, "observation"]
    fresh = join_null_safe(observed(targets), seen.where("live"), versions, "left_anti").withColumn("live", F.lit(True))
    if rescore:
        # What was scored with an earlier version has been scored with the present one now.
        over = changes.where("change = 'changed'").select(*OBSERVATION_KEY, F.col("was").alias("observation"), F.lit(False).alias("live"))
        fresh = fresh.unionByName(over)
    fresh = checkpointed(fresh.select(*versions, "live"))
    if not fresh.isEmpty():
        _append(fresh, seen_path, at)
    return folders


def scores_beside(scores: DataFrame, spans: DataFrame) -> DataFrame:
    """Stored scores that forecasts of ``spans`` can meet: by site and model, and by month of valid time where there are months.

    The driver gets one row per site, model and first and last month.
    """
    months = spans.groupBy("site_id", "model_id").agg(
        F.date_format(F.min("first_valid"), "yyyy-MM").alias("low"), F.date_format(F.max("last_valid"), "yyyy-MM").alias("high")
    )
    bounds = months.agg(
        F.collect_set("site_id").alias("sites"), F.collect_set("model_id").alias("models"), F.min("low").alias("low"), F.max("high").alias("high")
    ).first()
    if bounds["low"] is None:
        return scores.limit(0)
    scores = scores.where(F.col("site_id").isin(bounds["sites"]) & F.col("model_id").isin(bounds["models"]))
    return scores.where(F.col(MONTH).between(bounds["low"], bounds["high"])) if MONTH in scores.columns else scores
