"""Weather driver jobs: hourly downscaling, repair, forecast and history drivers."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from limnocast.functions.keys import day_of_year
from limnocast.functions.solar import eastern_longitude, longwave_estimate, potential_radiation
from limnocast.operators.grids import (
    anchored_slice,
    nearest_cell,
    nearest_issues,
    replicate_members,
)
from limnocast.operators.joins import join_null_safe, keep_latest
from limnocast.operators.reshape import between_days, date_trim, melt
from limnocast.operators.series import (
    FILLS,
    MEMBER,
    SERIES,
    daily_mean,
    densify,
    fill_down_up,
    first_gap,
    missing_dates,
    missing_hours,
    summarise,
)
from limnocast.schemas import (
    FLUX_VARIABLES,
    LONGWAVE,
    PRECIPITATION,
    MET_SCHEMA,
    SHORTWAVE,
    STAGE2_PARTITIONS,
    STAGE3_PARTITIONS,
    VARIABLE_NAMES,
    with_constants,
)
from limnocast.session import checkpointed
from limnocast.sources.catalogue import MONTH, archive_partitions, listed_dates
from limnocast.sources.readers import read_layout, read_member_files
from limnocast.sources.cubes import Cube
from limnocast.sources.writers import STAGE3_ORDER, rewrite_partitions, write_stage2

KELVIN_SHIFT = 273.0


def to_hourly(
    met: DataFrame,
    lon: float,
    lat: float,
    kelvin_shift: float = KELVIN_SHIFT,
    step_hours: float = 0.0,
    scope: Sequence[str] = ("site_id",),
) -> DataFrame:
    """Hourly drivers: states interpolated, fluxes back-filled, shortwave shaped by the sun.

    ``kelvin_shift`` is added to air temperature. ``scope`` names the columns that
    separate independent grids, one per issue date for instance.
    """
    summary = summarise(met, scope)
    plain = densify(met, {v: k for v, k in FILLS.items() if v != SHORTWAVE}, scope, summary)
    shortwave = densify(met, {SHORTWAVE: "backfill"}, scope, summary)
    return plain.withColumn("prediction", shift_units(kelvin_shift)).unionByName(
        downscale_shortwave(shortwave, lon, lat, step_hours, scope)
    )


def shift_units(amount: float = KELVIN_SHIFT, variable: str = "air_temperature"):
    """Prediction with ``amount`` added for one variable."""
    p = F.col("prediction")
    return F.when(F.col("variable") == variable, p + F.lit(amount)).otherwise(p)


def downscale_shortwave(
    hourly: DataFrame,
    lon: float,
    lat: float,
    step_hours: float = 0.0,
    scope: Sequence[str] = ("site_id",),
) -> DataFrame:
    """Spread each day's mean shortwave over its hours in proportion to the sun."""
    sun = potential_radiation(day_of_year(F.col("datetime")), lon, lat, step_hours)
    return (
        hourly.withColumn("_sun", sun)
        .withColumns(
            {
                "_mean_sun": daily_mean(hourly, F.col("_sun"), scope),
                "_mean": daily_mean(hourly, F.col("prediction"), scope),
            }
        )
        .withColumn(
            "prediction",
            F.when(
                (F.col("variable") == SHORTWAVE) & (F.col("_mean_sun") > 0),
                F.col("_sun") * (F.col("_mean") / F.col("_mean_sun")),
            ).otherwise(F.col("prediction")),
        )
        .drop("_sun", "_mean_sun", "_mean")
    )


def flux_coverage(met: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Known values per flux variable, and whether it is missing or empty.

    Without ``scope`` over all rows together, else for each of its keys, ``site_id`` for instance.
    """
    scope = list(scope)
    groups = met.select(*scope).distinct() if scope else met.sparkSession.range(1)
    expected = groups.select(
        *scope, F.explode(F.array(*[F.lit(v) for v in FLUX_VARIABLES])).alias("variable")
    )
    held = (
        met.where(F.col("variable").isin(*FLUX_VARIABLES))
        .groupBy(*scope, "variable")
        .agg(F.count("prediction").alias("known"))
    )
    joined = join_null_safe(expected, held, [*scope, "variable"], "left")
    return joined.select(
        *scope,
        "variable",
        F.coalesce("known", F.lit(0)).alias("known"),
        F.col("known").isNull().alias("missing"),
        (F.coalesce("known", F.lit(0)) == 0).alias("empty"),
    )


def air_temperature_beside(met: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` with the air temperature of the same member and time beside them."""
    keys = [*MEMBER, "datetime"]
    air = (
        met.where(F.col("variable") == "air_temperature")
        .groupBy(*keys)
        .agg(F.max("prediction").alias("air_temperature"))
    )
    return join_null_safe(rows, air, keys, "left")


def repair_fluxes(met: DataFrame, lon: float, lat: float, step_hours: float = 0.0) -> DataFrame:
    """Replace missing fluxes by estimates, then carry values over what is left.

    Missing precipitation is none; missing shortwave is half the potential
    radiation; missing longwave follows from air temperature. Only the rows with a missing
    longwave value take part in the lookup join.
    """
    p, v = F.col("prediction"), F.col("variable")
    needs_air = (v == LONGWAVE) & p.isNull()
    sun = potential_radiation(
        day_of_year(F.col("datetime")), eastern_longitude(lon), lat, step_hours
    )
    kept = met.where(~needs_air).withColumn(
        "prediction",
        F.when((v == PRECIPITATION) & p.isNull(), F.lit(0.0))
        .when((v == SHORTWAVE) & p.isNull(), sun * F.lit(0.5))
        .otherwise(p),
    )
    looked_up = (
        air_temperature_beside(met, met.where(needs_air))
        .withColumn("prediction", longwave_estimate(F.col("air_temperature")))
        .select(*met.columns)
    )
    return fill_down_up(kept.unionByName(looked_up))


def normalise_history(met: DataFrame, lon: float, lat: float) -> DataFrame:
    """Bring each site's stored history to hourly steps and repair its fluxes, each only where needed.

    The two tests are made per site, and only the sites that fail one go through its remedy.
    """
    site = ["site_id"]
    coarse = checkpointed(first_gap(met).where("needs_hourly").select(*site))
    broken = checkpointed(flux_coverage(met, site).where("empty").select(*site).distinct())
    if not coarse.isEmpty():
        hourly = to_hourly(join_null_safe(met, coarse, site, "left_semi"), lon, lat, kelvin_shift=0.0)
        met = join_null_safe(met, coarse, site, "left_anti").unionByName(hourly.select(*met.columns))
    if not broken.isEmpty():
        repaired = repair_fluxes(join_null_safe(met, broken, site, "left_semi"), lon, lat)
        met = join_null_safe(met, broken, site, "left_anti").unionByName(repaired)
    return met


def normalise_history_archive(spark: SparkSession, path: str, site_id: str, lon: float, lat: float) -> None:
    """``normalise_history`` of one site of a stored archive, in place; a site not stored is left so."""
    layout = archive_partitions(spark, path, STAGE3_PARTITIONS)
    stored = read_layout(spark, path, MET_SCHEMA, layout).where(F.col("site_id") == site_id).drop(MONTH)
    rewrite_partitions(normalise_history(stored, lon, lat), path, layout, STAGE3_ORDER)


def _grid_to_long(grid: DataFrame, names: dict[str, str], site_id: str) -> DataFrame:
    held = [v for v in names if v in grid.columns]
    long = melt(grid, held, names, drop_nulls=False)
    return with_constants(long, site_id=site_id, family="ensemble").withColumn(
        "prediction", F.col("prediction").cast("double")
    )


def forecast_drivers(
    grid: DataFrame | Cube,
    site_id: str,
    lon: float,
    lat: float,
    start: str,
    end: str,
    days: Sequence[str] | None = None,
    **options,
) -> DataFrame:
    """Hourly member series of the full cycle issued nearest to each date, or to each of ``days`` between.

    ``grid`` has init_time, ensemble_member, valid_time, latitude, longitude and a column
    per variable; of a stored ``Cube`` only the cell's rows of the issues wanted are read. The cell's rows are written out and
    everything after works on those.
    """
    stored = isinstance(grid, Cube)
    issues = chosen_days(nearest_issues(grid.axis("init_time") if stored else grid, start, end), days)
    if stored or days is not None:
        # At most one issue per date; as plain values they keep the scan from reading the others.
        issues = checkpointed(issues)
        wanted = sorted({r["init_time"] for r in issues.collect()})
        rows = grid.cell(lon, lat) if stored else nearest_cell(grid, lon, lat)
        cell = rows.where(F.col("init_time").isin(wanted)).join(issues, "init_time")
    else:
        cell = nearest_cell(grid, lon, lat).join(issues, "init_time")
    kept = [v for v in VARIABLE_NAMES if v in grid.columns]
    long = _grid_to_long(
        cell.select(
            "reference_datetime",
            F.col("ensemble_member").cast("double").alias("parameter"),
            F.col("valid_time").alias("datetime"),
            *kept,
        ),
        VARIABLE_NAMES,
        site_id,
    )
    scope = ("reference_datetime", "site_id")
    return to_hourly(checkpointed(long), lon, lat, scope=scope, **options)


def history_drivers(
    grid: DataFrame | Cube,
    site_id: str,
    lon: float,
    lat: float,
    start: str,
    end: str,
    members: int = 31,
    **options,
) -> DataFrame:
    """Hourly analysis series from ``start`` to ``end``, the same for every member.

    The grid is read once, the series is made hourly once, and copied to the members last.
    """
    kept = [v for v in VARIABLE_NAMES if v in grid.columns]
    cell = grid.cell(lon, lat) if isinstance(grid, Cube) else nearest_cell(grid, lon, lat)
    point = anchored_slice(cell, "time", start, end)
    single = _grid_to_long(
        point.select(F.col("time").alias("datetime"), *kept), VARIABLE_NAMES, site_id
    ).withColumn("parameter", F.lit(0.0))
    hourly = date_trim(to_hourly(checkpointed(single), lon, lat, **options), start, end)
    return replicate_members(hourly, members).select(*SERIES, "datetime", "prediction")


def chosen_days(issues: DataFrame, days: Sequence[str] | None) -> DataFrame:
    """The issues of ``days``, or all."""
    if days is None:
        return issues
    return issues.where(F.col("reference_datetime").isin([date.fromisoformat(d) for d in days]))


def merge_history(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Stored history with fresh values in place of stored ones."""
    return keep_latest(
        existing,
        incoming.select(*existing.columns),
        ["site_id", "family", "parameter", "datetime", "variable"],
    )


def update_history(
    existing: DataFrame,
    grid: DataFrame,
    site_id: str,
    lon: float,
    lat: float,
    start: str,
    end: str,
    members: int = 31,
    **options,
) -> DataFrame:
    """Add the hours of ``start`` to ``end`` that stored history lacks."""
    stored = existing.where(F.col("site_id") == site_id)
    first, last = lacking_days(stored, start, end)
    if first is None:
        return existing
    fresh = history_drivers(grid, site_id, lon, lat, first, last, members, **options)
    # Only these days of the site can change; all other rows pass through unmoved.
    days = date_trim(stored, first, last)
    rest = existing.where(~F.coalesce((F.col("site_id") == site_id) & between_days(existing, first, last), F.lit(False)))
    return rest.unionByName(merge_history(days, fresh))


def lacking_days(stored: DataFrame, start: str, end: str) -> tuple[str | None, str | None]:
    """First and last day from ``start`` to ``end`` that lacks an hour; both None if none does."""
    lacking = missing_hours(stored, start, end).agg(
        F.date_format(F.min("datetime"), "yyyy-MM-dd"), F.date_format(F.max("datetime"), "yyyy-MM-dd")
    )
    return tuple(lacking.first())


def update_history_archive(
    spark: SparkSession,
    path: str,
    grid: DataFrame,
    site_id: str,
    lon: float,
    lat: float,
    start: str,
    end: str,
    members: int = 31,
    by_month: bool | None = None,
    **options,
) -> None:
    """``update_history`` on a stored archive, replacing only the months of the site that gain hours.

    A new archive has months below its sites. One that is stored without stays so, and has the
    site's whole partition replaced; ``migrate_to_months`` makes one of the other. ``by_month`` asks for either.
    """
    layout = archive_partitions(spark, path, STAGE3_PARTITIONS, by_month)
    stored = read_layout(spark, path, MET_SCHEMA, layout).where(F.col("site_id") == site_id)
    if MONTH not in layout:
        merged = update_history(stored, grid, site_id, lon, lat, start, end, members, **options)
        rewrite_partitions(merged, path, layout, STAGE3_ORDER)
        return
    months = F.col(MONTH)
    first, last = lacking_days(stored.where(months.between(start[:7], end[:7])), start, end)
    if first is None:
        return
    fresh = history_drivers(grid, site_id, lon, lat, first, last, members, **options)
    touched = stored.where(months.between(first[:7], last[:7])).drop(MONTH)
    rewrite_partitions(merge_history(touched, fresh), path, layout, STAGE3_ORDER)


def update_forecast_archive(
    spark: SparkSession,
    path: str,
    grid: DataFrame,
    site_id: str,
    lon: float,
    lat: float,
    start: str,
    end: str,
    **options,
) -> list[str]:
    """Add the issue dates of ``start`` to ``end`` that a stored forecast archive lacks; returns them.

    What is stored is told from folder names. Issue times are looked up for the lacking dates only, so the cube's rows of
    other issues are not read, and dates already stored keep their files.
    """
    stored = listed_dates(spark, path, site_id, STAGE2_PARTITIONS)
    # One date per day asked for.
    days = sorted(r[0].isoformat() for r in missing_dates(stored, "reference_datetime", start, end).collect())
    if not days:
        return []
    fresh = forecast_drivers(grid, site_id, lon, lat, days[0], days[-1], days=days, **options)
    chosen = checkpointed(fresh.withColumn("reference_datetime", F.to_date("reference_datetime")))
    write_stage2(chosen, path)
    return [d.isoformat() for d in sorted(r[0] for r in chosen.select("reference_datetime").distinct().collect())]


def member_rows(
    wide: DataFrame,
    model_id: str,
    site_id: str,
    reference_datetime: str,
    pub_datetime: str,
) -> DataFrame:
    """Archive rows from wide member weather rows; exact duplicates once."""
    long = melt(
        wide.select(
            "parameter",
            F.col("time").alias("datetime"),
            F.col("AirTemp").alias("air_temperature"),
            F.col("WindSpeed").alias("wind_speed"),
        ),
        ["air_temperature", "wind_speed"],
    )
    issued = F.lit(reference_datetime).cast("timestamp")
    return (
        with_constants(
            long, family="ensemble", variable_type="driver", model_id=model_id, site_id=site_id
        )
        .withColumns(
            {
                "reference_datetime": issued,
                "pub_datetime": F.lit(pub_datetime).cast("timestamp"),
                "depth": F.lit(None).cast("double"),
                "reference_date": F.date_format(issued, "yyyy-MM-dd"),
            }
        )
        .select(
            "reference_datetime",
            "datetime",
            "pub_datetime",
            "depth",
            "family",
            "parameter",
            "variable",
            "prediction",
            "variable_type",
            "model_id",
            "reference_date",
            "site_id",
        )
        .distinct()
    )


def driver_forecast(
    spark: SparkSession,
    folder: str,
    model_id: str,
    site_id: str,
    reference_datetime: str,
    pub_datetime: str,
) -> DataFrame:
    """Archive rows of the weather that drove a run, from its member files."""
    return member_rows(
        read_member_files(spark, folder, model_id), model_id, site_id, reference_datetime, pub_datetime
    )
