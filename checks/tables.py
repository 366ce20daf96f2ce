"""Forecasts, observations and weather derived from the given tables.

Each table is written twice: as a DataFrame, and as the text of a common table
expression for the SQL twin. Sums are taken in whole cents, so both sides hold the same
doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SITE = "SITE"
LON, LAT = 9.6, 50.6
HYPSOGRAPHY = [(k * 0.5, 13e4 - 3e3 * (k * 0.5) * (k * 0.5)) for k in range(13)]
MODELS = ["model_a", "model_b"]
SPLIT_DATE = "2024-01-15 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _trunc(unit: str, ts: Column) -> Column:
    return F.date_trunc(unit, ts).cast("timestamp_ntz")


def _mean_cents(value: Column) -> Column:
    cents = F.sum(F.round(value * 100).cast("bigint")).cast("double")
    return cents / F.lit(100.0) / F.count(F.lit(1))


def _step_start(ts: Column, hours: int) -> Column:
    at = F.date_trunc("hour", ts)
    return (at - F.make_dt_interval(hours=F.hour(ts) % hours)).cast("timestamp_ntz")


def _temperature(v: Column, depth: Column) -> Column:
    warm = v * 20.0 / (v + 50.0)
    return (F.lit(4.0) + warm) - warm * depth / (depth + 3.0)


def _depth_rows(v: Column, *tail: Column) -> Column:
    """Array of thirteen temperature rows and the rows in ``tail``."""
    rows = F.transform(
        F.sequence(F.lit(0), F.lit(12)),
        lambda k: F.struct(
            F.lit("temperature").alias("variable"),
            F.lit("state").alias("variable_type"),
            (k * F.lit(0.5)).alias("depth"),
            _temperature(v, k * F.lit(0.5)).alias("value"),
        ),
    )
    return F.concat(rows, F.array(*tail)) if tail else rows


def _oxygen(v: Column) -> Column:
    return F.struct(
        F.lit("oxygen").alias("variable"),
        F.lit("diagnostic").alias("variable_type"),
        F.lit(None).cast("double").alias("depth"),
        v.alias("value"),
    )


def forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive rows: user is the member, week start the issue time, hour the valid time."""
    ts = F.col("ts")
    members = (
        table(spark, sf_dir, "events")
        .where(F.col("event_type") != "view")
        .groupBy(
            F.when(F.col("event_id") % 2 == 0, "model_a").otherwise("model_b").alias("model_id"),
            _trunc("week", ts).alias("reference_datetime"),
            _trunc("hour", ts).alias("datetime"),
            F.col("user_id").cast("string").alias("parameter"),
        )
        .agg(_mean_cents(F.col("value")).alias("v"))
    )
    rows = F.inline(_depth_rows(F.col("v"), _oxygen(F.col("v"))))
    return members.select(
        F.lit(SITE).alias("site_id"),
        "model_id",
        "reference_datetime",
        "datetime",
        "parameter",
        F.lit("ensemble").alias("family"),
        F.lit("PT1H").alias("duration"),
        rows,
    ).withColumnRenamed("value", "prediction")


def archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecasts with the remaining archive columns."""
    return forecasts(spark, sf_dir).withColumns(
        {
            "reference_date": F.date_format("reference_datetime", "yyyy-MM-dd"),
            "log_weight": F.lit(0.0),
        }
    )


def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations per hour and depth; every sixth hour was not observed."""
    hours = (
        table(spark, sf_dir, "events")
        .where(F.col("event_type") == "view")
        .groupBy(_trunc("hour", F.col("ts")).alias("datetime"))
        .agg(_mean_cents(F.col("value")).alias("v"))
    )
    rows = F.inline(_depth_rows(F.col("v"), _oxygen(F.col("v"))))
    return hours.select("datetime", rows).select(
        F.lit(SITE).alias("site_id"),
        "datetime",
        F.lit("PT1H").alias("duration"),
        "variable",
        "depth",
        F.when(F.hour("datetime") % 6 != 5, F.col("value")).alias("observation"),
    )


def prior_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score keys stored earlier; in even hours the observation has since changed."""
    from limnocast.operators.scoring import match_targets

    pairs = match_targets(
        forecasts(spark, sf_dir).where(
            (F.col("model_id") == "model_a")
            & (F.col("reference_datetime") < F.lit(SPLIT_DATE).cast("timestamp_ntz"))
        ),
        targets(spark, sf_dir),
    )
    y = F.col("observation")
    return pairs.select(
        "site_id",
        "datetime",
        "duration",
        "variable",
        "depth",
        "model_id",
        F.lit("sample").alias("family"),
        "reference_datetime",
        F.when(F.hour("datetime") % 2 == 0, y * F.lit(1.05)).otherwise(y).alias("observation"),
    ).distinct()


def _weather(v: Column) -> dict[str, Column]:
    return {
        "air_temperature": v / 5.0,
        "air_pressure": v + 1e5,
        "relative_humidity": v / 10.0 + 50.0,
        "eastward_wind": v / 20.0,
        "northward_wind": -v / 25.0,
        "precipitation_flux": v / 1e6,
        "surface_downwelling_longwave_flux_in_air": v / 2.0 + 300.0,
        "surface_downwelling_shortwave_flux_in_air": v * 4.0,
    }


def met(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six-hourly weather of five members, some samples unknown."""
    mean = _mean_cents(F.col("value"))
    steps = (
        table(spark, sf_dir, "events")
        .groupBy(
            (F.col("user_id") % 5).cast("double").alias("parameter"),
            _step_start(F.col("ts"), 6).alias("datetime"),
        )
        .agg(F.when(F.count(F.lit(1)) % 4 != 0, mean).alias("v"))
    )
    pairs = [
        F.struct(F.lit(n).alias("variable"), e.alias("prediction"))
        for n, e in _weather(F.col("v")).items()
    ]
    return steps.select(
        F.lit(SITE).alias("site_id"),
        F.lit("ensemble").alias("family"),
        "parameter",
        "datetime",
        F.inline(F.array(*pairs)),
    )


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A static field on a quarter-degree grid, one row per part."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        (F.lit(50.0) + (key % 41) * F.lit(0.25)).alias("latitude"),
        ((F.floor(key / 41) % 64) * F.lit(0.25)).alias("longitude"),
        (F.col("p_retailprice") / 100.0).alias("temperature_2m"),
    )


_SOURCE_NAMES = {
    "air_temperature": "temperature_2m",
    "air_pressure": "pressure_surface",
    "relative_humidity": "relative_humidity_2m",
    "eastward_wind": "wind_u_10m",
    "northward_wind": "wind_v_10m",
    "precipitation_flux": "precipitation_surface",
    "surface_downwelling_longwave_flux_in_air": "downward_long_wave_radiation_flux_surface",
    "surface_downwelling_shortwave_flux_in_air": "downward_short_wave_radiation_flux_surface",
}


def _wide_weather(v: Column) -> list[Column]:
    return [e.alias(_SOURCE_NAMES[n]) for n, e in _weather(v).items()]


def forecast_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather cube: issue (week) x member x cell x six-hour step, a column per variable."""
    ts = F.col("ts")
    cells = (
        table(spark, sf_dir, "events")
        .groupBy(
            _trunc("week", ts).alias("init_time"),
            (F.col("user_id") % 3).cast("int").alias("ensemble_member"),
            (F.lit(50.0) + (F.floor(F.col("user_id") / 3) % 4) * F.lit(0.25)).alias("latitude"),
            (F.lit(9.0) + (F.col("event_id") % 4) * F.lit(0.25)).alias("longitude"),
            _step_start(ts, 6).alias("valid_time"),
        )
        .agg(_mean_cents(F.col("value")).alias("v"))
    )
    return cells.select(
        "init_time", "ensemble_member", "latitude", "longitude", "valid_time", *_wide_weather(F.col("v"))
    )


def analysis_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather history: cell x three-hour step, a column per variable."""
    cells = (
        table(spark, sf_dir, "events")
        .groupBy(
            (F.lit(50.0) + (F.col("user_id") % 4) * F.lit(0.25)).alias("latitude"),
            (F.lit(9.0) + (F.col("event_id") % 4) * F.lit(0.25)).alias("longitude"),
            _step_start(F.col("ts"), 3).alias("time"),
        )
        .agg(_mean_cents(F.col("value")).alias("v"))
    )
    return cells.select("time", "latitude", "longitude", *_wide_weather(F.col("v")))


# ---- the same tables as common table expressions -----------------------------------------

_AVG = "CAST(SUM(CAST(ROUND(value*100) AS BIGINT)) AS DOUBLE)/1e2/COUNT(*)"
_T = "(4e0+v*2e1/(v+5e1))-(v*2e1/(v+5e1))*(k*5e-1)/(k*5e-1+3e0)"


def _step(hours: int) -> str:
    return f"date_trunc('hour',ts)-to_hours(CAST(hour(ts)%{hours} AS INTEGER))"


_WEATHER_SQL = {
    "air_temperature": "v/5e0",
    "air_pressure": "v+1e5",
    "relative_humidity": "v/1e1+5e1",
    "eastward_wind": "v/2e1",
    "northward_wind": "-v/25e0",
    "precipitation_flux": "v/1e6",
    "surface_downwelling_longwave_flux_in_air": "v/2e0+3e2",
    "surface_downwelling_shortwave_flux_in_air": "v*4e0",
}
_WIDE_SQL = ", ".join(f"{e} AS {_SOURCE_NAMES[n]}" for n, e in _WEATHER_SQL.items())

_CTES: dict[str, tuple[list[str], str]] = {
    "fc_members": (
        [],
        f"""SELECT CASE WHEN event_id%2=0 THEN 'model_a' ELSE 'model_b' END AS model_id,
          date_trunc('week',ts) AS reference_datetime, date_trunc('hour',ts) AS datetime,
          CAST(user_id AS VARCHAR) AS parameter, {_AVG} AS v
          FROM events WHERE event_type<>'view' GROUP BY ALL""",
    ),
    "fc_profile": (
        ["fc_members"],
        f"""SELECT model_id,reference_datetime,datetime,parameter,k*5e-1 AS depth,{_T} AS prediction
          FROM (SELECT *, UNNEST(generate_series(0,12)) AS k FROM fc_members)""",
    ),
    "forecasts": (
        ["fc_profile", "fc_members"],
        """SELECT 'SITE' AS site_id,model_id,reference_datetime,datetime,parameter,'ensemble' AS family,
          'PT1H' AS duration,'temperature' AS variable,'state' AS variable_type,depth,prediction FROM fc_profile
          UNION ALL SELECT 'SITE',model_id,reference_datetime,datetime,parameter,'ensemble','PT1H','oxygen',
          'diagnostic',CAST(NULL AS DOUBLE),v FROM fc_members""",
    ),
    "obs_hours": (
        [],
        f"""SELECT date_trunc('hour',ts) AS datetime,{_AVG} AS v FROM events
          WHERE event_type='view' GROUP BY 1""",
    ),
    "targets": (
        ["obs_hours"],
        f"""SELECT 'SITE' AS site_id,datetime,'PT1H' AS duration,'temperature' AS variable,k*5e-1 AS depth,
          CASE WHEN hour(datetime)%6<>5 THEN {_T} END AS observation
          FROM (SELECT *, UNNEST(generate_series(0,12)) AS k FROM obs_hours)
          UNION ALL SELECT 'SITE',datetime,'PT1H','oxygen',CAST(NULL AS DOUBLE),
          CASE WHEN hour(datetime)%6<>5 THEN v END FROM obs_hours""",
    ),
    "joined": (
        ["forecasts", "targets"],
        """SELECT f.*, t.observation FROM forecasts f JOIN targets t ON f.site_id=t.site_id
          AND f.datetime=t.datetime AND f.duration=t.duration AND f.variable=t.variable
          AND f.depth IS NOT DISTINCT FROM t.depth WHERE t.observation IS NOT NULL""",
    ),
    "prior_scores": (
        ["joined"],
        f"""SELECT DISTINCT site_id,datetime,duration,variable,depth,model_id,'sample' AS family,
          reference_datetime,CASE WHEN hour(datetime)%2=0 THEN observation*105e-2 ELSE observation END
          AS observation FROM joined
          WHERE model_id='model_a' AND reference_datetime<TIMESTAMP '{SPLIT_DATE}'""",
    ),
    "met_steps": (
        [],
        f"""SELECT CAST(user_id%5 AS DOUBLE) AS parameter,{_step(6)} AS datetime,
          CASE WHEN COUNT(*)%4<>0 THEN {_AVG} END AS v FROM events GROUP BY 1,2""",
    ),
    "met": (
        ["met_steps"],
        " UNION ALL ".join(
            f"SELECT 'SITE' AS site_id,'ensemble' AS family,parameter,datetime,'{n}' AS variable,"
            f"{e} AS prediction FROM met_steps"
            for n, e in _WEATHER_SQL.items()
        ),
    ),
    "grid": (
        [],
        """SELECT 50e0+(p_partkey%41)*25e-2 AS latitude,((p_partkey//41)%64)*25e-2 AS longitude,
          p_retailprice/1e2 AS temperature_2m FROM part""",
    ),
    "forecast_grid": (
        [],
        f"""SELECT init_time,ensemble_member,latitude,longitude,valid_time,{_WIDE_SQL} FROM (
          SELECT date_trunc('week',ts) AS init_time,CAST(user_id%3 AS INTEGER) AS ensemble_member,
          50e0+((user_id//3)%4)*25e-2 AS latitude,9e0+(event_id%4)*25e-2 AS longitude,
          {_step(6)} AS valid_time,{_AVG} AS v FROM events GROUP BY ALL)""",
    ),
    "analysis_grid": (
        [],
        f"""SELECT time,latitude,longitude,{_WIDE_SQL} FROM (
          SELECT 50e0+(user_id%4)*25e-2 AS latitude,9e0+(event_id%4)*25e-2 AS longitude,
          {_step(3)} AS time,{_AVG} AS v FROM events GROUP BY ALL)""",
    ),
}


def with_tables(*names: str, body: str, extra: dict[str, str] | None = None) -> str:
    """``body`` behind a WITH clause that holds the named tables and what they build on."""
    order: list[str] = []

    def visit(name: str) -> None:
        for needed in _CTES[name][0]:
            visit(needed)
        if name not in order:
            order.append(name)

    for name in names:
        visit(name)
    parts = [f"{n} AS MATERIALIZED ({_CTES[n][1]})" for n in order]
    parts += [f"{n} AS MATERIALIZED ({sql})" for n, sql in (extra or {}).items()]
    return f"WITH {', '.join(parts)} {body}"
