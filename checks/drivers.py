"""Queries that build hourly weather drivers."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from checks.registry import query
from checks.tables import LAT, LON, SITE, analysis_grid, forecast_grid, met, with_tables
from limnocast.functions.keys import day_of_year, epoch, time_like
from limnocast.functions.solar import cos_zenith, equation_of_time, potential_radiation
from limnocast.operators.series import (
    FILLS,
    densify,
    fill_down_up,
    first_gap,
    hourly_grid,
    hourly_spans,
    median_step,
)
from limnocast.plans import drivers as J
from limnocast.schemas import FLUX_VARIABLES, LONGWAVE, PRECIPITATION, SHORTWAVE, STATE_VARIABLES, VARIABLE_NAMES

SERIES = "site_id,family,parameter,variable"


def _list(names) -> str:
    return "(" + ",".join(f"'{n}'" for n in names) + ")"


def _doy(t: str) -> str:
    return f"(dayofyear({t})+hour({t})/24e0)"


def eot_sql(doy: str) -> str:
    f = f"({math.pi / 180!r}*(279.5e0+0.9856e0*{doy}))"
    return (
        f"((-104.7e0*SIN({f})+596.2e0*SIN(2e0*{f})+4.3e0*SIN(4e0*{f})-429.3e0*COS({f})"
        f"-2e0*COS(2e0*{f})+19.3e0*COS(3e0*{f}))/3600e0)"
    )


def cosz_sql(t: str, lon: float, lat: float) -> str:
    meridian = math.floor(lon / 15) * 15
    meridian += 15 if meridian < 0 else 0
    doy, phi = _doy(t), lat * math.pi / 180
    noon = f"(12e0+({(lon - meridian) * -4 / 60!r})-{eot_sql(doy)}-({meridian / 360 * 24!r}))"
    hour = f"({math.pi / 12!r}*(({doy}-FLOOR({doy}))*24e0-{noon}))"
    tilt = f"(-23.45e0*{math.pi!r}/180e0*COS(2e0*{math.pi!r}*({doy}+10e0)/365e0))"
    return (
        f"GREATEST(0e0,{math.sin(phi)!r}*SIN({tilt})+{math.cos(phi)!r}*COS({tilt})*COS({hour}))"
    )


def dense_sql(source: str, scope: str = "site_id") -> dict[str, str]:
    """The dense hourly grid of ``source``, one row per hour, built the long way round."""
    keys = ",".join(dict.fromkeys(f"{scope},{SERIES}".split(",")))
    member = ",".join(dict.fromkeys(f"{scope},site_id,family,parameter".split(",")))
    known = "CASE WHEN prediction IS NOT NULL THEN datetime END"
    before = f"PARTITION BY {keys} ORDER BY datetime ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    after = f"PARTITION BY {keys} ORDER BY datetime ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"
    return {
        "members": f"SELECT {member},MAX(datetime) AS finish FROM {source} GROUP BY ALL",
        "starts": f"SELECT {scope},MIN(datetime) AS start FROM {source} GROUP BY ALL",
        "kinds": f"SELECT DISTINCT {scope},variable FROM {source} WHERE variable IN {_list(FILLS)}",
        "hours": f"""SELECT {keys},UNNEST(generate_series(start,finish,INTERVAL 1 HOUR)) AS datetime
          FROM members JOIN starts USING ({scope}) JOIN kinds USING ({scope})""",
        "dense": f"SELECT h.*,s.prediction FROM hours h LEFT JOIN {source} s USING ({keys},datetime)",
        "sided": f"""SELECT *,LAST_VALUE(prediction IGNORE NULLS) OVER ({before}) AS pv,
          LAST_VALUE({known} IGNORE NULLS) OVER ({before}) AS pt,
          FIRST_VALUE(prediction IGNORE NULLS) OVER ({after}) AS nv,
          FIRST_VALUE({known} IGNORE NULLS) OVER ({after}) AS nt FROM dense""",
        "filled": f"""SELECT {keys},datetime,CASE WHEN variable IN {_list(FLUX_VARIABLES)} THEN nv
          WHEN pt IS NULL THEN nv WHEN nt IS NULL OR pt=nt THEN pv
          ELSE pv+(nv-pv)*((epoch(datetime)-epoch(pt))/36e2)/((epoch(nt)-epoch(pt))/36e2) END AS prediction
          FROM sided""",
    }


def hourly_sql(source: str, lon: float, lat: float, shift: float, scope: str = "site_id") -> dict[str, str]:
    """``dense_sql`` and the unit shift and shortwave shaping on top."""
    keys = ",".join(dict.fromkeys(f"{scope},{SERIES}".split(",")))
    return {
        **dense_sql(source, scope),
        "sunny": f"SELECT *,1366e0*{cosz_sql('datetime', lon, lat)} AS sun FROM filled",
        "means": f"""SELECT *,AVG(sun) OVER (PARTITION BY {keys},CAST(datetime AS DATE)) AS mean_sun,
          AVG(prediction) OVER (PARTITION BY {keys},CAST(datetime AS DATE)) AS mean_flux FROM sunny""",
        "hourly": f"""SELECT {keys},datetime,CASE WHEN variable='air_temperature' THEN prediction+{shift!r}
          WHEN variable='{SHORTWAVE}' AND mean_sun>0 THEN sun*(mean_flux/mean_sun)
          ELSE prediction END AS prediction FROM means""",
    }


# Interpolated values are often exact ties at the last digit, where the engines' own
# rounding differs, so both sides round by the same arithmetic.
_ROW = f"{SERIES},datetime,FLOOR(prediction*1e6+5e-1)/1e6 AS prediction"


def _rows(df, *first):
    return df.select(
        *first,
        "site_id",
        "family",
        "parameter",
        "variable",
        "datetime",
        (F.floor(F.col("prediction") * 1e6 + 0.5) / F.lit(1e6)).alias("prediction"),
    )


@query(
    "unit_shift",
    with_tables(
        "met",
        extra={
            "shifted": """SELECT * EXCLUDE (prediction),CASE WHEN variable='air_temperature'
              THEN prediction+273e0 ELSE prediction END AS prediction FROM met"""
        },
        body=f"SELECT {_ROW} FROM shifted",
    ),
)
def unit_shift(spark, d):
    return _rows(met(spark, d).withColumn("prediction", J.shift_units()))


@query(
    "hourly_grid",
    with_tables("met", extra=dense_sql("met"), body=f"SELECT {SERIES},datetime FROM hours"),
)
def grid_hours(spark, d):
    return hourly_grid(met(spark, d))


@query(
    "grid_trim",
    with_tables(
        "met",
        extra=dense_sql("met"),
        body=f"""SELECT {SERIES},MIN(datetime) AS first_hour,MAX(datetime) AS last_hour,COUNT(*) AS n_hours
        FROM hours GROUP BY ALL""",
    ),
)
def grid_trim(spark, d):
    return hourly_spans(met(spark, d))


@query("densify", with_tables("met", extra=dense_sql("met"), body=f"SELECT {_ROW} FROM dense"))
def densified(spark, d):
    return _rows(densify(met(spark, d), {v: "none" for v in FILLS}))


@query(
    "interpolate_linear",
    with_tables(
        "met",
        extra=dense_sql("met"),
        body=f"SELECT {_ROW} FROM filled WHERE variable IN {_list(STATE_VARIABLES)}",
    ),
)
def interpolated(spark, d):
    return _rows(densify(met(spark, d), {v: "linear" for v in STATE_VARIABLES}))


@query(
    "backfill",
    with_tables(
        "met",
        extra=dense_sql("met"),
        body=f"SELECT {_ROW} FROM filled WHERE variable IN {_list(FLUX_VARIABLES)}",
    ),
)
def backfilled(spark, d):
    return _rows(densify(met(spark, d), {v: "backfill" for v in FLUX_VARIABLES}))


_FILL_SQL = f"""COALESCE(
  LAST_VALUE(prediction IGNORE NULLS) OVER (PARTITION BY {SERIES} ORDER BY datetime
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  FIRST_VALUE(prediction IGNORE NULLS) OVER (PARTITION BY {SERIES} ORDER BY datetime
  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""


@query(
    "fill_down_up",
    with_tables("met", body=f"SELECT {SERIES},datetime,FLOOR({_FILL_SQL}*1e6+5e-1)/1e6 AS prediction FROM met"),
)
def filled(spark, d):
    return _rows(fill_down_up(met(spark, d)))


@query(
    "daily_mean_over",
    with_tables(
        "met",
        extra=hourly_sql("met", LON, LAT, 273.0),
        body=f"""SELECT {SERIES},datetime,ROUND(mean_flux,6) AS daily_mean FROM means
        WHERE variable='{SHORTWAVE}'""",
    ),
)
def daily_mean_over(spark, d):
    hourly = densify(met(spark, d), {SHORTWAVE: "backfill"})
    return hourly.select(
        "site_id",
        "family",
        "parameter",
        "variable",
        "datetime",
        F.round(J.daily_mean(hourly, F.col("prediction")), 6).alias("daily_mean"),
    )


@query(
    "cadence_check",
    with_tables(
        "met",
        extra={
            "times": "SELECT DISTINCT site_id,datetime FROM met",
            "two": "SELECT *,ROW_NUMBER() OVER (PARTITION BY site_id ORDER BY datetime) AS n FROM times",
        },
        body="""SELECT site_id,(epoch(MAX(datetime))-epoch(MIN(datetime)))/36e2 AS gap_hours,
        COUNT(*)>=2 AND (epoch(MAX(datetime))-epoch(MIN(datetime)))/36e2>1 AS needs_hourly
        FROM two WHERE n<=2 GROUP BY 1""",
    ),
)
def cadence_check(spark, d):
    return first_gap(met(spark, d))


@query(
    "median_step",
    with_tables(
        "met",
        extra={
            "steps": f"""SELECT {SERIES},(epoch(datetime)-epoch(LAG(datetime) OVER
              (PARTITION BY {SERIES} ORDER BY datetime)))/36e2 AS step FROM met"""
        },
        body=f"SELECT {SERIES},MEDIAN(step) AS step_hours FROM steps GROUP BY ALL",
    ),
)
def step(spark, d):
    return median_step(met(spark, d))


@query(
    "flux_coverage",
    with_tables(
        "met",
        extra={
            "wanted": f"SELECT UNNEST([{','.join(repr(v) for v in FLUX_VARIABLES)}]) AS variable",
            "held": "SELECT variable,COUNT(prediction) AS known FROM met GROUP BY 1",
        },
        body="""SELECT variable,COALESCE(known,0) AS known,known IS NULL AS missing,
        COALESCE(known,0)=0 AS empty FROM wanted LEFT JOIN held USING (variable)""",
    ),
)
def coverage(spark, d):
    return J.flux_coverage(met(spark, d))


@query(
    "self_lookup",
    with_tables(
        "met",
        body=f"""SELECT m.site_id,m.family,m.parameter,m.variable,m.datetime,
        ROUND(a.prediction,6) AS air_temperature FROM met m LEFT JOIN met a ON a.site_id=m.site_id
        AND a.family=m.family AND a.parameter=m.parameter AND a.datetime=m.datetime
        AND a.variable='air_temperature' WHERE m.variable='{LONGWAVE}'""",
    ),
)
def self_lookup(spark, d):
    rows = met(spark, d)
    beside = J.air_temperature_beside(rows, rows.where(F.col("variable") == LONGWAVE))
    return beside.select(
        "site_id",
        "family",
        "parameter",
        "variable",
        "datetime",
        F.round("air_temperature", 6).alias("air_temperature"),
    )


@query(
    "flux_repair",
    with_tables(
        "met",
        extra={
            "estimated": f"""SELECT m.site_id,m.family,m.parameter,m.variable,m.datetime,CASE
              WHEN m.prediction IS NOT NULL THEN m.prediction
              WHEN m.variable='{PRECIPITATION}' THEN 0e0
              WHEN m.variable='{SHORTWAVE}' THEN 1366e0*{cosz_sql('m.datetime', LON, LAT)}*5e-1
              WHEN m.variable='{LONGWAVE}' THEN 0.97e0*5.67e-8*POW(a.prediction,4e0) END AS prediction
              FROM met m LEFT JOIN met a ON a.site_id=m.site_id AND a.family=m.family
              AND a.parameter=m.parameter AND a.datetime=m.datetime AND a.variable='air_temperature'"""
        },
        body=f"SELECT {SERIES},datetime,FLOOR({_FILL_SQL}*1e6+5e-1)/1e6 AS prediction FROM estimated",
    ),
)
def flux_repair(spark, d):
    return _rows(J.repair_fluxes(met(spark, d), LON, LAT))


_HOURLY = """SELECT s.site AS site_id,m.family,m.parameter,m.variable,
  TIMESTAMP '2024-01-01'+to_seconds(CAST((epoch(m.datetime)-epoch(TIMESTAMP '2024-01-01'))/6 AS BIGINT)) AS datetime,
  CASE WHEN s.site='HOLLOW' AND m.variable='{longwave}' THEN NULL ELSE m.prediction END AS prediction
  FROM met m CROSS JOIN (VALUES ('HOLLOW'),('SOUND')) s(site)"""


@query(
    "normalise_history",
    with_tables(
        "met",
        extra={
            "sites": _HOURLY.format(longwave=LONGWAVE),
            "estimated": f"""SELECT m.site_id,m.family,m.parameter,m.variable,m.datetime,CASE
              WHEN m.prediction IS NOT NULL THEN m.prediction
              WHEN m.variable='{PRECIPITATION}' THEN 0e0
              WHEN m.variable='{SHORTWAVE}' THEN 1366e0*{cosz_sql("m.datetime", LON, LAT)}*5e-1
              WHEN m.variable='{LONGWAVE}' THEN 0.97e0*5.67e-8*POW(a.prediction,4e0) END AS prediction
              FROM sites m LEFT JOIN sites a ON a.site_id=m.site_id AND a.family=m.family
              AND a.parameter=m.parameter AND a.datetime=m.datetime AND a.variable='air_temperature'
              WHERE m.site_id='HOLLOW'""",
        },
        body=f"""SELECT {SERIES},datetime,FLOOR({_FILL_SQL}*1e6+5e-1)/1e6 AS prediction FROM estimated
        UNION ALL SELECT {SERIES},datetime,FLOOR(prediction*1e6+5e-1)/1e6 FROM sites WHERE site_id='SOUND'""",
    ),
)
def normalised(spark, d):
    rows, start = met(spark, d), 1704067200
    hours = rows.withColumn(
        "datetime", time_like(F.lit(start) + ((epoch(F.col("datetime")) - start) / 6).cast("long"), rows, "datetime")
    )
    hollow = hours.withColumns(
        {
            "site_id": F.lit("HOLLOW"),
            "prediction": F.when(F.col("variable") != LONGWAVE, F.col("prediction")),
        }
    )
    return _rows(J.normalise_history(hollow.unionByName(hours.withColumn("site_id", F.lit("SOUND"))), LON, LAT))


def _met_times(spark, d):
    return met(spark, d).select("parameter", "variable", "datetime")


def _sun_sql(value: str, name: str) -> str:
    return with_tables(
        "met", body=f"SELECT parameter,variable,datetime,ROUND({value},6) AS {name} FROM met"
    )


@query("equation_of_time", _sun_sql(eot_sql(_doy("datetime")), "hours"))
def eot(spark, d):
    hours = equation_of_time(day_of_year(F.col("datetime")))
    return _met_times(spark, d).withColumn("hours", F.round(hours, 6))


@query("cos_zenith", _sun_sql(cosz_sql("datetime", LON, LAT), "cosine"))
def zenith(spark, d):
    cosine = cos_zenith(day_of_year(F.col("datetime")), LON, LAT)
    return _met_times(spark, d).withColumn("cosine", F.round(cosine, 6))


@query("potential_sw", _sun_sql(f"1366e0*{cosz_sql('datetime', LON, LAT)}", "radiation"))
def potential(spark, d):
    radiation = potential_radiation(day_of_year(F.col("datetime")), LON, LAT)
    return _met_times(spark, d).withColumn("radiation", F.round(radiation, 6))


@query(
    "downscale_sw",
    with_tables(
        "met",
        extra=hourly_sql("met", LON, LAT, 273.0),
        body=f"SELECT {_ROW} FROM hourly WHERE variable='{SHORTWAVE}'",
    ),
)
def downscale_sw(spark, d):
    hourly = densify(met(spark, d), {SHORTWAVE: "backfill"})
    return _rows(J.downscale_shortwave(hourly, LON, LAT))


@query(
    "to_hourly",
    with_tables("met", extra=hourly_sql("met", LON, LAT, 273.0), body=f"SELECT {_ROW} FROM hourly"),
)
def to_hourly(spark, d):
    return _rows(J.to_hourly(met(spark, d), LON, LAT))


_LONG = " UNION ALL ".join(
    "SELECT {keys},'SITE' AS site_id,'ensemble' AS family,'%s' AS variable,%s AS prediction FROM {source}"
    % (new, old)
    for old, new in VARIABLE_NAMES.items()
)
_CELL = (
    "WHERE latitude=(SELECT latitude FROM {g} ORDER BY ABS(latitude-%r),latitude DESC LIMIT 1) "
    "AND longitude=(SELECT longitude FROM {g} ORDER BY ABS(longitude-%r),longitude DESC LIMIT 1)"
    % (LAT, LON)
)
FIRST, LAST = "2024-01-02", "2024-01-30"
_ISSUES = {
    "issues": "SELECT DISTINCT init_time FROM forecast_grid",
    "days": f"""SELECT UNNEST(generate_series(TIMESTAMP '{FIRST}',TIMESTAMP '{LAST}',INTERVAL 1 DAY)) AS day""",
    "served": """SELECT day AS reference_datetime,(SELECT init_time FROM issues
      ORDER BY ABS(epoch(init_time)-epoch(day)),init_time DESC LIMIT 1) AS init_time FROM days""",
    "cell": "SELECT * FROM forecast_grid " + _CELL.format(g="forecast_grid"),
    "chosen": """SELECT s.reference_datetime,CAST(ensemble_member AS DOUBLE) AS parameter,valid_time AS datetime,
      c.* FROM cell c JOIN served s ON s.init_time=c.init_time""",
    "long_rows": _LONG.format(keys="reference_datetime,parameter,datetime", source="chosen"),
}


@query(
    "forecast_drivers",
    with_tables(
        "forecast_grid",
        extra={**_ISSUES, **hourly_sql("long_rows", LON, LAT, 273.0, "reference_datetime,site_id")},
        body=f"SELECT strftime(reference_datetime,'%Y-%m-%d') AS issue_date,{_ROW} FROM hourly",
    ),
)
def forecast_drivers(spark, d):
    rows = J.forecast_drivers(forecast_grid(spark, d), SITE, LON, LAT, FIRST, LAST)
    return _rows(rows, F.date_format("reference_datetime", "yyyy-MM-dd").alias("issue_date"))


def _history_sql(first: str, last: str, members: int) -> dict[str, str]:
    return {
        "point": f"""SELECT time AS datetime,0e0 AS parameter,* FROM analysis_grid
          {_CELL.format(g="analysis_grid")} AND time>=TIMESTAMP '{first}'
          AND time<TIMESTAMP '{last}'+INTERVAL 2 DAY""",
        "single": _LONG.format(keys="parameter,datetime", source="point"),
        **hourly_sql("single", LON, LAT, 273.0),
        "history": f"""SELECT site_id,family,CAST(UNNEST(generate_series(0,{members - 1})) AS DOUBLE) AS parameter,
          variable,datetime,prediction FROM hourly
          WHERE datetime>=TIMESTAMP '{first}' AND datetime<TIMESTAMP '{last}'+INTERVAL 1 DAY""",
    }


@query(
    "history_drivers",
    with_tables(
        "analysis_grid", extra=_history_sql("2024-01-03", "2024-01-28", 31), body=f"SELECT {_ROW} FROM history"
    ),
)
def history_drivers(spark, d):
    return _rows(
        J.history_drivers(analysis_grid(spark, d), SITE, LON, LAT, "2024-01-03", "2024-01-28", 31)
    )


@query(
    "upsert_latest",
    with_tables(
        "met",
        "analysis_grid",
        extra={
            **_history_sql("2024-01-10", "2024-01-20", 5),
            "both_sides": """SELECT 0 AS rank,site_id,family,parameter,variable,datetime,prediction FROM met
              UNION ALL SELECT 1,* FROM history""",
            "kept": f"""SELECT *,ROW_NUMBER() OVER (PARTITION BY {SERIES},datetime ORDER BY rank DESC) AS n
              FROM both_sides""",
        },
        body=f"SELECT {_ROW} FROM kept WHERE n=1",
    ),
)
def upsert_latest(spark, d):
    fresh = J.history_drivers(analysis_grid(spark, d), SITE, LON, LAT, "2024-01-10", "2024-01-20", 5)
    return _rows(J.merge_history(met(spark, d), fresh))


@query(
    "update_history",
    with_tables(
        "met",
        "analysis_grid",
        extra={
            # The first lacking hour is 01:00 of the first day, the last 23:00 of the last.
            **_history_sql("2024-01-05", "2024-01-25", 5),
            "both_sides": """SELECT 0 AS rank,site_id,family,parameter,variable,datetime,prediction FROM met
              UNION ALL SELECT 1,* FROM history""",
            "kept": f"""SELECT *,ROW_NUMBER() OVER (PARTITION BY {SERIES},datetime ORDER BY rank DESC) AS n
              FROM both_sides""",
        },
        body=f"SELECT {_ROW} FROM kept WHERE n=1",
    ),
)
def update_history(spark, d):
    return _rows(
        J.update_history(
            met(spark, d), analysis_grid(spark, d), SITE, LON, LAT, "2024-01-05", "2024-01-25", 5
        )
    )
