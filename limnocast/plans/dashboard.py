"""Tables behind the latest-forecast view."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import UTC, datetime
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limnocast.functions.keys import (
    depth_label,
    depth_order,
    epoch,
    relabel,
    round_to_day,
    trace_key,
)
from limnocast.operators.reshape import last_observed, latest_slice
from limnocast.plans.diagnostics import MIXED


def latest_temperature(
    forecasts: DataFrame,
    models: Sequence[str],
    surface: float = 0.5,
    bottom: float = 5.0,
) -> DataFrame:
    """Temperature at the two focal depths from the latest issue, one lazy plan."""
    return latest_slice(forecasts, models, variables=["temperature"], depths=[surface, bottom])


def latest_mixing(forecasts: DataFrame, models: Sequence[str]) -> DataFrame:
    """Mixing probability rows of the latest issue."""
    return latest_slice(forecasts, models, variables=[MIXED])


def labelled(
    rows: DataFrame,
    labels: Mapping[str, str],
    zone: str,
    surface: float = 0.5,
    bottom: float = 5.0,
) -> DataFrame:
    """Rows with local times, depth label and order, trace key and model label."""
    kinds = {c: rows.schema[c].dataType for c in ("datetime", "reference_datetime")}
    return rows.withColumns(
        {
            **{c: local_time(F.col(c), zone).cast(k) for c, k in kinds.items()},
            "depth_label": depth_label(F.col("depth"), surface, bottom),
            "depth_order": depth_order(F.col("depth"), surface),
            "parameter": trace_key(F.col("model_id"), F.col("parameter")),
            "model_id": relabel(F.col("model_id"), labels),
        }
    )


def local_time(time, zone: str):
    """Wall-clock time in ``zone`` of a UTC time."""
    return F.from_utc_timestamp(time.cast("timestamp"), zone)


def zone_name(time, zone: str):
    """What clocks in ``zone`` call their time at a UTC time, ``CET`` or ``CEST`` for instance."""
    months = [datetime(year, month, 15, tzinfo=UTC) for year in range(1970, 2038) for month in (1, 7)]
    names = {t.astimezone(ZoneInfo(zone)).utcoffset(): t.astimezone(ZoneInfo(zone)).tzname() for t in months}
    ahead = epoch(local_time(time, zone)) - epoch(time.cast("timestamp"))
    name = F.lit(zone)
    for offset, said in names.items():
        name = F.when(ahead == int(offset.total_seconds()), said).otherwise(name)
    return name


def kpi_surface(latest: DataFrame, surface: float = 0.5) -> DataFrame:
    """Mean, least and greatest surface temperature at issue time."""
    p = F.col("prediction")
    return latest.where(
        (F.col("depth") == surface) & (F.col("datetime") == F.col("reference_datetime"))
    ).agg(F.avg(p).alias("mean"), F.min(p).alias("min"), F.max(p).alias("max"))


def kpi_mixed(mixing: DataFrame) -> DataFrame:
    """Mean mixing probability at issue time."""
    return mixing.where(F.col("datetime") == F.col("reference_datetime")).agg(
        F.avg("prediction").alias("value")
    )


def kpi_horizon(latest: DataFrame, zone: str) -> DataFrame:
    """Issue time as a label with the name of its ``zone``, and days from issue to the last valid time.

    Half days round to the even number.
    """
    issued = F.max("reference_datetime")
    days = (epoch(F.max("datetime")) - epoch(issued)) / F.lit(86400.0)
    return latest.agg(
        F.concat_ws(
            " ", F.date_format(local_time(issued, zone), "MMM dd, yyyy HH:mm"), zone_name(issued, zone)
        ).alias("issued"),
        F.bround(days).cast("int").alias("horizon_days"),
    )


def date_axis(latest: DataFrame, major_days: int = 3) -> DataFrame:
    """Daily marks between the first and last valid time that are not major marks.

    Days are those of the clock that ``latest`` shows: give it rows in local time for local days.
    """
    ends = latest.agg(F.min("datetime").alias("first"), F.max("datetime").alias("last"))
    kind = latest.schema["datetime"].dataType

    def marks(days: int) -> DataFrame:
        step = F.expr(f"INTERVAL {days} DAYS")
        return ends.select(F.explode(F.sequence("first", "last", step)).alias("mark")).select(
            round_to_day(F.col("mark")).cast(kind).alias("mark")
        )

    return marks(1).join(marks(major_days), "mark", "left_anti")


def observations_beside(
    targets: DataFrame, zone: str, surface: float = 0.5, bottom: float = 5.0
) -> DataFrame:
    """Temperature observations at the focal depths in local time, with depth label and order."""
    seen = targets.where(
        (F.col("variable") == "temperature")
        & F.col("depth").isin(surface, bottom)
        & F.col("observation").isNotNull()
    )
    kind = seen.schema["datetime"].dataType
    return seen.withColumns(
        {
            "datetime": local_time(F.col("datetime"), zone).cast(kind),
            "depth_label": depth_label(F.col("depth"), surface, bottom),
            "depth_order": depth_order(F.col("depth"), surface),
        }
    )


def dashboard_tables(
    forecasts: DataFrame,
    models: Sequence[str],
    labels: Mapping[str, str],
    zone: str = "UTC",
    surface: float = 0.5,
    bottom: float = 5.0,
    targets: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Every table the view shows, by name, each still lazy; times and days are those of ``zone``.

    With ``targets`` also the observations and the time of the last one.
    """
    latest = latest_temperature(forecasts, models, surface, bottom)
    mixing = latest_mixing(forecasts, models)
    shown = labelled(latest, labels, zone, surface, bottom)
    tables = {
        "temperature": shown,
        "mixing": labelled(mixing, labels, zone, surface, bottom),
        "kpi_surface": kpi_surface(latest, surface),
        "kpi_mixed": kpi_mixed(mixing),
        "kpi_horizon": kpi_horizon(latest, zone),
        "date_axis": date_axis(shown),
    }
    if targets is not None:
        tables["observations"] = observations_beside(targets, zone, surface, bottom)
        tables["last_observed"] = last_observed(tables["observations"])
    return tables
