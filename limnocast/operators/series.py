"""Time series: dense hourly grids, gap filling, sampling steps.

Two ideas keep these jobs flat at any length of series. A gap is filled by exploding
the sample before it up to the next one, so only the samples are shuffled and sorted,
never the dense grid. And a series is cut into blocks of time: windows run
inside a block, and one small row per block carries the values across block borders.
A null key, say a series without a family, is a key like any other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from limnocast.functions.keys import DAY, HOUR, epoch, time_like
from limnocast.operators.joins import join_null_safe
from limnocast.schemas import FLUX_VARIABLES, STATE_VARIABLES
from limnocast.session import checkpointed

SERIES = ["site_id", "family", "parameter", "variable"]
MEMBER = ["site_id", "family", "parameter"]
BLOCK_SECONDS = 30 * DAY
FILLS = {**{v: "linear" for v in STATE_VARIABLES}, **{v: "backfill" for v in FLUX_VARIABLES}}


def _merge(scope: Sequence[str], keys: Sequence[str]) -> list[str]:
    return list(dict.fromkeys([*scope, *keys]))


def _samples(met: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Series rows with time in seconds, place within the hour, and block of time."""
    return met.select(*keys, epoch(F.col("datetime")).alias("t"), "prediction").withColumns(
        {
            "phase": F.pmod("t", F.lit(HOUR)),
            "block": F.floor(F.col("t") / F.lit(BLOCK_SECONDS)),
        }
    )


def summarise(met: DataFrame, scope: Sequence[str] = ("site_id",)) -> DataFrame:
    """One row per series and block of time: its ends and its first known sample.

    Of copies of that sample which differ the largest counts, as everywhere. One pass, combined
    before the shuffle. The summary is about a seven-hundredth of an hourly archive and
    every step of the gridding needs it, so it is written out once.
    """
    keys = _merge(scope, SERIES)
    known = F.when(F.col("prediction").isNotNull(), F.struct("t", (-F.col("prediction")).alias("less")))
    return checkpointed(
        _samples(met, keys)
        .groupBy(*keys, "phase", "block")
        .agg(F.min("t").alias("t_min"), F.max("t").alias("t_max"), F.min(known).alias("first"))
        .select(
            *keys,
            "phase",
            "block",
            "t_min",
            "t_max",
            F.col("first.t").alias("first_t"),
            (-F.col("first.less")).alias("first_value"),
        )
    )


def _spans(blocks: DataFrame, scope: Sequence[str], variables: Sequence[str]) -> DataFrame:
    """Every series the grid must hold, with its first and last time in seconds.

    A scope (site, or issue date and site) shares its start and its variables; each
    member ends at its own last time. The variable set is bounded by ``variables``.
    """
    member = _merge(scope, MEMBER)
    ends = blocks.groupBy(*member).agg(F.max("t_max").alias("end"))
    listed = F.when(F.col("variable").isin(*variables), F.col("variable"))
    starts = blocks.groupBy(*scope).agg(
        F.min("t_min").alias("start"), F.collect_set(listed).alias("variables")
    )
    return join_null_safe(ends, starts, list(scope)).select(
        *member, F.explode("variables").alias("variable"), "start", "end"
    )


def hourly_spans(met: DataFrame, scope: Sequence[str] = ("site_id",)) -> DataFrame:
    """First hour, last hour and number of hours of each series of the dense grid."""
    keys = _merge(scope, SERIES)
    spans = _spans(summarise(met, scope), scope, list(FILLS))
    hours = F.floor((F.col("end") - F.col("start")) / HOUR)
    return spans.select(
        *keys,
        time_like(F.col("start"), met, "datetime").alias("first_hour"),
        time_like(F.col("start") + hours * HOUR, met, "datetime").alias("last_hour"),
        (hours + 1).alias("n_hours"),
    )


def hourly_grid(met: DataFrame, scope: Sequence[str] = ("site_id",)) -> DataFrame:
    """Dense grid: each member and variable at every hour up to the member's last time."""
    keys = _merge(scope, SERIES)
    spans = _spans(summarise(met, scope), scope, list(FILLS))
    hours = F.explode(F.sequence(F.col("start"), F.col("end"), F.lit(HOUR).cast("bigint")))
    return spans.select(*keys, hours.alias("t")).select(
        *keys, time_like(F.col("t"), met, "datetime").alias("datetime")
    )


def densify(
    met: DataFrame,
    fills: Mapping[str, str] = FILLS,
    scope: Sequence[str] = ("site_id",),
    summary: DataFrame | None = None,
) -> DataFrame:
    """The dense hourly grid with samples in place and gaps filled.

    ``fills`` says per variable how: ``linear`` between samples and flat beyond them,
    ``backfill`` with the next sample, or ``none``. Samples that are not a whole number
    of hours after the start of the grid have no grid row and are left out. A series
    holds one value per time; of copies that differ the largest is taken. ``summary``
    is the result of ``summarise`` when the caller already has it.
    """
    keys = _merge(scope, SERIES)
    blocks = summarise(met, scope) if summary is None else summary
    spans = _spans(blocks, scope, list(fills))
    samples = _samples(met, keys).where(
        F.col("prediction").isNotNull() & F.col("variable").isin(*fills)
    )
    # One value per series and time; copies collapse before they travel.
    samples = samples.groupBy(*keys, "t", "phase", "block").agg(F.max("prediction").alias("prediction"))

    by_series = Window.partitionBy(*keys).orderBy("block")
    known = (
        blocks.where(F.col("first_t").isNotNull() & F.col("variable").isin(*fills))
        .select(
            *keys,
            "phase",
            "block",
            F.struct(F.col("first_t").alias("t"), F.col("first_value").alias("prediction")).alias(
                "first_known"
            ),
        )
        .transform(lambda d: join_null_safe(d, spans, keys))
        .where(F.col("phase") == F.pmod("start", F.lit(HOUR)))
        .withColumns(
            {
                "next_known": F.lead("first_known").over(by_series),
                "nth": F.row_number().over(by_series),
            }
        )
    )

    # Hours before the first sample, or all hours of a series without any.
    heads = (
        join_null_safe(spans, known.where(F.col("nth") == 1).select(*keys, "first_known"), keys, "left")
        .withColumn("hours", _hours_until(F.col("start"), F.col("first_known.t"), F.col("end")))
        .select(
            *keys,
            F.explode(F.when(F.col("hours") > 0, F.sequence(F.lit(0), F.col("hours") - 1))).alias("i"),
            F.col("start").alias("t"),
            F.lit(None).cast("double").alias("here"),
            F.lit(1).alias("gap"),
            F.col("first_known.prediction").alias("after"),
            F.lit(True).alias("leading"),
        )
    )

    # Every sample covers the hours up to the next one.
    in_block = Window.partitionBy(*keys, "phase", "block").orderBy("t")
    place = [*keys, "phase", "block"]
    body = (
        join_null_safe(samples, known.select(*place, "next_known", "end"), place)
        .withColumn(
            "next", F.coalesce(F.lead(F.struct("t", "prediction")).over(in_block), F.col("next_known"))
        )
        .withColumn("hours", _hours_until(F.col("t"), F.col("next.t"), F.col("end")))
        .select(
            *keys,
            F.explode(F.when(F.col("hours") > 0, F.sequence(F.lit(0), F.col("hours") - 1))).alias("i"),
            "t",
            F.col("prediction").alias("here"),
            F.col("hours").alias("gap"),
            F.col("next.prediction").alias("after"),
            F.lit(False).alias("leading"),
        )
    )
    return body.unionByName(heads).select(
        *keys,
        time_like(F.col("t") + F.col("i") * HOUR, met, "datetime").alias("datetime"),
        _filled(fills).alias("prediction"),
    )


def _hours_until(t: Column, following: Column, end: Column) -> Column:
    """Grid hours from ``t`` up to the next sample, or through the end of the series."""
    return F.coalesce(
        F.floor((following - t) / HOUR), F.floor((end - t) / HOUR) + F.lit(1)
    ).cast("int")


def _filled(fills: Mapping[str, str]) -> Column:
    here, after, i, gap = F.col("here"), F.col("after"), F.col("i"), F.col("gap")
    linear = F.when(F.col("leading"), after).otherwise(
        F.coalesce(here + (after - here) * i / gap, here)
    )
    backfill = F.when((i == 0) & ~F.col("leading"), here).otherwise(after)
    exact = F.when((i == 0) & ~F.col("leading"), here)
    by_kind = {"linear": linear, "backfill": backfill, "none": exact}
    unknown = set(fills.values()) - set(by_kind)
    if unknown:
        raise ValueError(f"unknown fill {sorted(unknown)}")
    chosen = F.lit(None).cast("double")
    for kind, value in by_kind.items():
        variables = [v for v, k in fills.items() if k == kind]
        if variables:
            chosen = F.when(F.col("variable").isin(*variables), value).otherwise(chosen)
    return chosen


def _block_of(df: DataFrame, order: str) -> DataFrame:
    t = epoch(F.col(order))
    return df.withColumns({"_t": t, "_block": F.floor(t / F.lit(BLOCK_SECONDS))})


def fill_down_up(
    df: DataFrame,
    keys: Sequence[str] = SERIES,
    order: str = "datetime",
    value: str = "prediction",
) -> DataFrame:
    """Replace nulls by the last value before, else the first value after."""
    cut = _block_of(df, order)
    known_t = F.when(F.col(value).isNotNull(), F.col("_t"))
    blocks = cut.groupBy(*keys, "_block").agg(
        F.max_by(value, known_t).alias("_last"), F.min_by(value, known_t).alias("_first")
    )
    over = Window.partitionBy(*keys).orderBy("_block")
    carry = blocks.select(
        *keys,
        "_block",
        F.last("_last", ignorenulls=True)
        .over(over.rowsBetween(Window.unboundedPreceding, -1))
        .alias("_before"),
        F.first("_first", ignorenulls=True)
        .over(over.rowsBetween(1, Window.unboundedFollowing))
        .alias("_after"),
    )
    inside = Window.partitionBy(*keys, "_block").orderBy("_t")
    down = F.last(value, ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    up = F.first(value, ignorenulls=True).over(inside.rowsBetween(0, Window.unboundedFollowing))
    return (
        join_null_safe(cut, carry, [*keys, "_block"], "left")
        .withColumn(value, F.coalesce(down, F.col("_before"), up, F.col("_after")))
        .select(*df.columns)
    )


def median_step(
    df: DataFrame, keys: Sequence[str] = SERIES, order: str = "datetime"
) -> DataFrame:
    """Median hours between successive samples of each series."""
    cut = _block_of(df, order).select(*keys, "_block", "_t")
    over = Window.partitionBy(*keys).orderBy("_block")
    carry = cut.groupBy(*keys, "_block").agg(F.max("_t").alias("_last")).select(
        *keys, "_block", F.lag("_last").over(over).alias("_before")
    )
    inside = Window.partitionBy(*keys, "_block").orderBy("_t")
    steps = join_null_safe(cut, carry, [*keys, "_block"]).withColumn(
        "step", (F.col("_t") - F.coalesce(F.lag("_t").over(inside), F.col("_before"))) / F.lit(3600.0)
    )
    return steps.groupBy(*keys).agg(F.median("step").alias("step_hours"))


def first_gap(df: DataFrame, keys: Sequence[str] = ("site_id",)) -> DataFrame:
    """Hours between the first two distinct times, and whether they exceed one hour."""
    over = Window.partitionBy(*keys).orderBy("datetime")
    two = (
        df.select(*keys, "datetime")
        .distinct()
        .withColumn("_nth", F.row_number().over(over))
        .where(F.col("_nth") <= 2)
    )
    gap = (epoch(F.max("datetime")) - epoch(F.min("datetime"))) / F.lit(3600.0)
    return (
        two.groupBy(*keys)
        .agg(gap.alias("gap_hours"), F.count(F.lit(1)).alias("_n"))
        .select(*keys, "gap_hours", ((F.col("_n") >= 2) & (F.col("gap_hours") > 1)).alias("needs_hourly"))
    )


def daily_mean(
    df: DataFrame, value: Column, scope: Sequence[str] = ("site_id",)
) -> Column:
    """Mean over the hours of a series' day, for every row; a day has at most 24 rows."""
    keys = _merge(scope, SERIES)
    return F.avg(value).over(Window.partitionBy(*keys, F.to_date("datetime")))


def missing_hours(df: DataFrame, start: str, end: str) -> DataFrame:
    """Hours of the days ``start`` to ``end`` that ``df`` has no row for."""
    spark = df.sparkSession
    first, last = (int(datetime.fromisoformat(d + "T00:00+00:00").timestamp()) for d in (start, end))
    hours = (last + DAY - first) // HOUR
    wanted = spark.range(hours).select(
        time_like(F.lit(first) + F.col("id") * HOUR, df, "datetime").alias("datetime")
    )
    return wanted.join(df.select("datetime").distinct(), "datetime", "left_anti")


def missing_dates(stored: DataFrame, column: str, start: str, end: str) -> DataFrame:
    """Dates ``start`` to ``end`` not among the stored issue dates."""
    spark = stored.sparkSession
    days = (date.fromisoformat(end) - date.fromisoformat(start)).days + 1
    wanted = spark.range(days).select(
        F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias(column)
    )
    have = stored.select(F.to_date(column).alias(column)).distinct()
    return wanted.join(have, column, "left_anti")
