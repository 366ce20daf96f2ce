"""Rolling-origin backtests: the windows, and the observations each one covers."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from limnocast.functions.keys import DAY, epoch
from limnocast.operators.intervals import interval_join


@dataclass(frozen=True)
class Backtest:
    """Simulations 1 .. count + 1; the first only spins up and forecasts nothing.

    Simulation 1 runs from ``start`` to ``first_origin``; each later one starts
    where the one before ended and ends ``step_days`` on. The forecast of a simulation
    covers its end through ``horizon_days`` later.
    """

    start: str
    first_origin: str
    step_days: int
    count: int
    horizon_days: int
    models: Sequence[str]

    def _first(self) -> Column:
        return F.lit(self.first_origin).cast("date")


def backtest_windows(spark: SparkSession, plan: Backtest) -> DataFrame:
    """One row per simulation and model: start, end and horizon in days."""
    n = F.col("id").cast("int")
    ends = spark.range(1, plan.count + 2).select(
        n.alias("simulation"),
        F.date_add(plan._first(), (n - 1) * plan.step_days).alias("end_date"),
    )
    previous = F.date_add(plan._first(), (F.col("simulation") - 2) * plan.step_days)
    return ends.select(
        F.explode(F.array(*[F.lit(m) for m in plan.models])).alias("model"),
        "simulation",
        F.when(F.col("simulation") == 1, F.lit(plan.start).cast("date"))
        .otherwise(previous)
        .alias("start_date"),
        "end_date",
        F.when(F.col("simulation") == 1, F.lit(0)).otherwise(F.lit(plan.horizon_days)).alias("horizon"),
    )


def covered(targets: DataFrame, plan: Backtest) -> DataFrame:
    """Each observation once per simulation whose forecast covers it.

    Origins lie on a regular lattice, so the covering simulations follow from the time
    by arithmetic: at most ``horizon / step + 1`` of them, and no range join.
    """
    since = epoch(F.col("datetime")) - F.unix_date(plan._first()).cast("bigint") * DAY
    step = F.lit(plan.step_days * DAY)
    latest = F.least(F.floor(since / step) + 1, F.lit(plan.count + 1))
    earliest = F.greatest(F.ceil((since - plan.horizon_days * DAY) / step) + 1, F.lit(1))
    return (
        targets.withColumns({"_since": since, "_earliest": earliest, "_latest": latest})
        .where(F.col("_earliest") <= F.col("_latest"))
        .select("*", F.explode(F.sequence("_earliest", "_latest")).alias("_simulation"))
        .withColumn("simulation", F.col("_simulation").cast("int"))
        .where((F.col("simulation") > 1) | (F.col("_since") == 0))
        .drop("_since", "_earliest", "_latest", "_simulation")
    )


def backtest_coverage(targets: DataFrame, plan: Backtest) -> DataFrame:
    """Windows with the number and mean of the observations each forecast can be judged by."""
    held = (
        covered(targets.where(F.col("observation").isNotNull()), plan)
        .groupBy("simulation")
        .agg(
            F.count(F.lit(1)).alias("n_targets"),
            F.avg("observation").alias("mean_observation"),
        )
    )
    return (
        backtest_windows(targets.sparkSession, plan)
        .join(held, "simulation", "left")
        .withColumn("n_targets", F.coalesce("n_targets", F.lit(0)))
    )


def windows_at(origins: DataFrame, start: str) -> DataFrame:
    """One row per simulation and model from a table of origins ``(model, end_date, horizon)``.

    Origins may lie at any dates, with gaps and with horizons that overlap or differ. Each simulation starts where the
    one before it ended, the first at ``start``; that one only spins up, whatever its horizon. An origin named
    twice counts once, with its longest horizon.
    """
    once = origins.where("model is not null and end_date is not null").groupBy("model", "end_date").agg(F.max("horizon").alias("horizon"))
    order = Window.partitionBy("model").orderBy("end_date")
    numbered = once.withColumns(
        {"simulation": F.row_number().over(order), "start_date": F.coalesce(F.lag("end_date").over(order), F.lit(start).cast("date"))}
    )
    horizon = F.when(F.col("simulation") == 1, 0).otherwise(F.coalesce("horizon", F.lit(0)))
    return numbered.select("model", "simulation", "start_date", "end_date", horizon.cast("int").alias("horizon"))


def covered_at(targets: DataFrame, windows: DataFrame) -> DataFrame:
    """Each row of ``targets`` once per window whose forecast covers it: from its end through its horizon later.

    A window is copied to the days it reaches and a row has one day, so the join is on equal days whatever the windows look like.
    """
    forecast = windows.select(
        "model",
        "simulation",
        F.col("end_date").cast("timestamp").alias("_from"),
        F.timestamp_seconds(epoch(F.col("end_date")) + F.col("horizon") * DAY).alias("_upto"),
    )
    timed = targets.withColumn("_at", F.col("datetime").cast("timestamp"))
    return interval_join(timed, forecast, "_at", "_from", "_upto").drop("_at", "_from", "_upto")


def coverage_at(targets: DataFrame, windows: DataFrame) -> DataFrame:
    """Windows with the number and mean of the observations each forecast can be judged by.

    Observations of one instant collapse to their number and sum before they meet the windows.
    """
    instants = (
        targets.where(F.col("observation").isNotNull())
        .groupBy("datetime")
        .agg(F.count(F.lit(1)).alias("_n"), F.sum("observation").alias("_sum"))
    )
    held = covered_at(instants, windows).groupBy("model", "simulation").agg(
        F.sum("_n").alias("n_targets"), (F.sum("_sum") / F.sum("_n")).alias("mean_observation")
    )
    return windows.join(held, ["model", "simulation"], "left").withColumn("n_targets", F.coalesce("n_targets", F.lit(0)))
