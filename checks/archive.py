"""Queries over the forecast archive, the targets and the dashboard view."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query
from checks.tables import (
    LAT,
    LON,
    MODELS,
    SITE,
    analysis_grid,
    archive,
    forecasts,
    grid,
    met,
    targets,
    with_tables,
)
from limnocast.functions.keys import (
    base_name,
    depth_label,
    depth_order,
    horizon_days,
    horizon_fraction,
    path_value,
    relabel,
    sample_family,
    split_part,
    strip,
    trace_key,
)
from limnocast.operators.grids import anchored_slice, nearest_cell, replicate_members
from limnocast.operators.reshape import (
    append,
    archive_slice,
    date_trim,
    depths_wide,
    extent,
    last_observed,
    latest_issue,
    melt,
    scoreable,
)
from limnocast.operators.series import missing_dates, missing_hours
from limnocast.plans import dashboard
from limnocast.plans.backtest import Backtest, backtest_coverage
from limnocast.plans.diagnostics import mixing_rows
from limnocast.schemas import FORECAST_SCHEMA, VARIABLE_NAMES, conform, with_constants
from limnocast.sources.readers import normalise_targets, stored_dates, with_observation

ZONE = "Europe/Paris"
LABELS = {"model_a": "Model A"}
TIMES = ("reference_datetime", "datetime", "pub_datetime")

# Probability that the two focal depths have nearly the same density, per issue and time.
MIXED_SQL = {
    "density": """SELECT model_id,reference_datetime,datetime,parameter,
      MAX(CASE WHEN depth=5e-1 THEN rho END) AS upper_rho, MAX(CASE WHEN depth=5e0 THEN rho END) AS lower_rho
      FROM (SELECT *, 1e3*(1e0-(prediction+288.9414e0)*(prediction-3.9863e0)*(prediction-3.9863e0)
      /(508929.2e0*(prediction+68.12963e0))) AS rho FROM fc_profile WHERE depth IN (5e-1,5e0)) GROUP BY ALL""",
    "mixing": """SELECT 'SITE' AS site_id,model_id,reference_datetime,datetime,
      CASE WHEN COUNT(lower_rho-upper_rho)=COUNT(*) THEN
      CAST(SUM(CASE WHEN lower_rho-upper_rho<1e-1 THEN 1 ELSE 0 END) AS DOUBLE)/COUNT(*) END AS prediction
      FROM density GROUP BY ALL""",
}


@query(
    "scan_forecasts",
    with_tables(
        "forecasts",
        body="""SELECT site_id,model_id,strftime(reference_datetime,'%Y-%m-%d') AS reference_date,
        reference_datetime,datetime,depth,family,parameter,variable,variable_type,
        ROUND(prediction,6) AS prediction,0e0 AS log_weight FROM forecasts""",
    ),
)
def scan_forecasts(spark, d):
    rows = conform(archive(spark, d), FORECAST_SCHEMA, TIMES)
    return rows.drop("pub_datetime", "forecast").withColumn("prediction", F.round("prediction", 6))


@query(
    "scan_targets",
    with_tables(
        "targets",
        body="SELECT * EXCLUDE (observation), ROUND(observation,6) AS observation FROM targets "
        "WHERE observation IS NOT NULL",
    ),
)
def scan_targets(spark, d):
    return with_observation(targets(spark, d)).withColumn("observation", F.round("observation", 6))


@query(
    "normalise_targets",
    with_tables(
        "targets",
        body="""SELECT site_id,datetime,duration,variable,CASE WHEN variable='temperature' THEN depth END AS depth,
        ROUND(observation,6) AS observation FROM targets""",
    ),
)
def normalise(spark, d):
    raw = targets(spark, d).withColumns(
        {
            "datetime": F.date_format("datetime", "yyyy-MM-dd HH:mm:ss"),
            "depth": F.coalesce("depth", F.lit(1.5)),
            "observation": F.round("observation", 6),
        }
    )
    return normalise_targets(raw, "timestamp_ntz")


@query(
    "stored_dates",
    with_tables(
        "fc_members",
        body="SELECT DISTINCT strftime(reference_datetime,'%Y-%m-%d') AS issue_date FROM fc_members",
    ),
)
def stored(spark, d):
    return stored_dates(archive(spark, d), SITE).select(
        F.date_format("reference_datetime", "yyyy-MM-dd").alias("issue_date")
    )


@query(
    "archive_slice",
    with_tables(
        "forecasts",
        body="""SELECT model_id,reference_datetime,datetime,parameter,depth,ROUND(prediction,6) AS prediction
        FROM forecasts WHERE model_id IN ('model_a') AND variable='temperature' AND depth IN (5e-1,5e0)
        AND variable_type='state'""",
    ),
)
def sliced(spark, d):
    return archive_slice(
        archive(spark, d), ["model_a"], ["temperature"], [0.5, 5.0], ["state"]
    ).select(
        "model_id",
        "reference_datetime",
        "datetime",
        "parameter",
        "depth",
        F.round("prediction", 6).alias("prediction"),
    )


@query(
    "scoreable_forecasts",
    with_tables(
        "forecasts",
        "targets",
        body="""SELECT model_id,CASE WHEN family='ensemble' THEN 'sample' ELSE family END AS family,
        reference_datetime,datetime,parameter,variable,depth,ROUND(prediction,6) AS prediction FROM forecasts
        WHERE datetime<=(SELECT MAX(datetime) FROM targets WHERE observation IS NOT NULL)
        AND model_id IS NOT NULL AND parameter IS NOT NULL AND prediction IS NOT NULL""",
    ),
)
def scoreable_forecasts(spark, d):
    return scoreable(forecasts(spark, d), targets(spark, d)).select(
        "model_id",
        "family",
        "reference_datetime",
        "datetime",
        "parameter",
        "variable",
        "depth",
        F.round("prediction", 6).alias("prediction"),
    )


@query(
    "normalise_family",
    with_tables(
        "forecasts",
        "fc_profile",
        extra=MIXED_SQL,
        body="""SELECT model_id,variable,CASE WHEN family='ensemble' THEN 'sample' ELSE family END AS family,
        COUNT(*) AS n FROM (SELECT model_id,variable,family FROM forecasts
        UNION ALL SELECT model_id,'prob_mixed_density','bernoulli' FROM mixing) GROUP BY ALL""",
    ),
)
def normalise_family(spark, d):
    rows = archive(spark, d)
    return (
        append(rows, mixing_rows(rows))
        .withColumn("family", sample_family(F.col("family")))
        .groupBy("model_id", "variable", "family")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "relabel_models",
    with_tables(
        "forecasts",
        body="""SELECT CASE model_id WHEN 'model_a' THEN 'Model A' ELSE model_id END AS model_id,variable,
        COUNT(*) AS n,ROUND(AVG(prediction),6) AS mean FROM forecasts GROUP BY ALL""",
    ),
)
def relabel_models(spark, d):
    return (
        forecasts(spark, d)
        .withColumn("model_id", relabel(F.col("model_id"), LABELS))
        .groupBy("model_id", "variable")
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("prediction"), 6).alias("mean"))
    )


@query(
    "trace_key",
    with_tables(
        "forecasts",
        body="""SELECT model_id||'_'||parameter AS trace,variable,COUNT(*) AS n FROM forecasts GROUP BY ALL""",
    ),
)
def trace(spark, d):
    key = trace_key(F.col("model_id"), F.col("parameter")).alias("trace")
    return forecasts(spark, d).groupBy(key, "variable").agg(F.count(F.lit(1)).alias("n"))


@query(
    "depth_labels",
    with_tables(
        "forecasts",
        body="""SELECT CASE WHEN depth=5e-1 THEN 'Surface (depth: 0.5 m)' ELSE 'Bottom (depth: 5 m)' END
        AS depth_label,CAST(CASE WHEN depth=5e-1 THEN 1 ELSE 2 END AS INTEGER) AS depth_order,model_id,
        reference_datetime,COUNT(*) AS n,ROUND(AVG(prediction),6) AS mean FROM forecasts
        WHERE variable='temperature' AND depth IN (5e-1,5e0) GROUP BY ALL""",
    ),
)
def depth_labels(spark, d):
    depth = F.col("depth")
    rows = archive_slice(forecasts(spark, d), variables=["temperature"], depths=[0.5, 5.0])
    return rows.groupBy(
        depth_label(depth).alias("depth_label"),
        depth_order(depth).alias("depth_order"),
        "model_id",
        "reference_datetime",
    ).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("prediction"), 6).alias("mean"))


@query(
    "conform_schema",
    with_tables(
        "fc_profile",
        extra=MIXED_SQL,
        body="""SELECT site_id,model_id,strftime(reference_datetime,'%Y-%m-%d') AS reference_date,
        reference_datetime,datetime,CAST(NULL AS DOUBLE) AS depth,'bernoulli' AS family,'prob' AS parameter,
        'prob_mixed_density' AS variable,'diagnostic' AS variable_type,0e0 AS log_weight,
        CAST(NULL AS DOUBLE) AS forecast,ROUND(prediction,6) AS prediction FROM mixing""",
    ),
)
def conform_rows(spark, d):
    rows = mixing_rows(archive(spark, d)).withColumn("prediction", F.round("prediction", 6))
    return conform(rows, FORECAST_SCHEMA, TIMES).drop("pub_datetime")


_RENAME_SQL = "CASE variable " + " ".join(
    f"WHEN '{a}' THEN '{b}'" for a, b in VARIABLE_NAMES.items()
) + " ELSE variable END"


@query(
    "rename_variables",
    with_tables(
        "analysis_grid",
        body=f"""SELECT time,latitude,longitude,{_RENAME_SQL} AS variable,ROUND(prediction,6) AS prediction FROM
        (UNPIVOT analysis_grid ON {','.join(VARIABLE_NAMES)} INTO NAME variable VALUE prediction)""",
    ),
)
def rename_variables(spark, d):
    return melt(analysis_grid(spark, d), list(VARIABLE_NAMES), VARIABLE_NAMES).withColumn(
        "prediction", F.round("prediction", 6)
    )


@query(
    "met_melt",
    with_tables(
        "analysis_grid",
        body="""SELECT 'SITE' AS site_id,'ensemble' AS family,'driver' AS variable_type,time AS datetime,
        latitude,longitude,variable,ROUND(prediction,6) AS prediction FROM (
        SELECT time,latitude,longitude,'air_temperature' AS variable,temperature_2m AS prediction FROM analysis_grid
        UNION ALL SELECT time,latitude,longitude,'wind_speed',
        CASE WHEN wind_u_10m>0 THEN wind_u_10m END FROM analysis_grid)
        WHERE prediction IS NOT NULL""",
    ),
)
def met_melt(spark, d):
    wind = F.col("wind_u_10m")
    wide = analysis_grid(spark, d).select(
        F.col("time").alias("datetime"),
        "latitude",
        "longitude",
        F.col("temperature_2m").alias("air_temperature"),
        F.when(wind > 0, wind).alias("wind_speed"),
    )
    rows = melt(wide, ["air_temperature", "wind_speed"])
    return with_constants(
        rows, site_id=SITE, family="ensemble", variable_type="driver"
    ).withColumn("prediction", F.round("prediction", 6))


@query(
    "local_time",
    with_tables(
        "targets",
        # Every date in the tables is in January, when this zone is one hour ahead.
        body="""SELECT datetime,datetime+INTERVAL 1 HOUR AS local_datetime,variable,depth FROM targets""",
    ),
)
def local_time(spark, d):
    local = dashboard.local_time(F.col("datetime"), ZONE).cast("timestamp_ntz")
    return targets(spark, d).select("datetime", local.alias("local_datetime"), "variable", "depth")


@query(
    "date_trim",
    with_tables(
        "targets",
        body="""SELECT datetime,variable,depth,ROUND(observation,6) AS observation FROM targets
        WHERE CAST(datetime AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'""",
    ),
)
def trimmed(spark, d):
    return date_trim(targets(spark, d), "2024-01-05", "2024-01-20").select(
        "datetime", "variable", "depth", F.round("observation", 6).alias("observation")
    )


@query(
    "depth_pivot",
    with_tables(
        "fc_profile",
        body="""SELECT model_id,reference_datetime,datetime,parameter,
        ROUND(MAX(CASE WHEN depth=5e-1 THEN prediction END),6) AS min_depth,
        ROUND(MAX(CASE WHEN depth=5e0 THEN prediction END),6) AS max_depth
        FROM fc_profile WHERE depth IN (5e-1,5e0) GROUP BY ALL""",
    ),
)
def depth_pivot(spark, d):
    rows = archive_slice(forecasts(spark, d), variables=["temperature"]).select(
        "model_id", "reference_datetime", "datetime", "parameter", "depth", "prediction"
    )
    wide = depths_wide(rows, {"min_depth": 0.5, "max_depth": 5.0})
    return wide.withColumns({c: F.round(c, 6) for c in ("min_depth", "max_depth")})


@query(
    "append_derived",
    with_tables(
        "forecasts",
        "fc_profile",
        extra=MIXED_SQL,
        body="""SELECT site_id,model_id,reference_datetime,datetime,parameter,family,variable,variable_type,depth,
        ROUND(prediction,6) AS prediction FROM forecasts UNION ALL
        SELECT site_id,model_id,reference_datetime,datetime,'prob','bernoulli','prob_mixed_density','diagnostic',
        CAST(NULL AS DOUBLE),ROUND(prediction,6) FROM mixing""",
    ),
)
def append_derived(spark, d):
    rows = archive(spark, d)
    return append(rows, mixing_rows(rows)).select(
        "site_id",
        "model_id",
        "reference_datetime",
        "datetime",
        "parameter",
        "family",
        "variable",
        "variable_type",
        "depth",
        F.round("prediction", 6).alias("prediction"),
    )


# ---- aggregates and view ------------------------------------------------------------------

_LATEST_SQL = {
    "latest": """SELECT * FROM forecasts WHERE variable='temperature' AND depth IN (5e-1,5e0)
      AND reference_datetime=(SELECT MAX(reference_datetime) FROM forecasts)"""
}


@query(
    "prob_mixed",
    with_tables(
        "fc_profile",
        extra=MIXED_SQL,
        body="SELECT site_id,model_id,reference_datetime,datetime,ROUND(prediction,6) AS prob_mixed FROM mixing",
    ),
)
def prob_mixed(spark, d):
    return mixing_rows(archive(spark, d)).select(
        "site_id",
        "model_id",
        "reference_datetime",
        "datetime",
        F.round("prediction", 6).alias("prob_mixed"),
    )


@query(
    "latest_issue",
    with_tables(
        "forecasts",
        body="""SELECT MAX(reference_datetime) AS reference_datetime FROM forecasts
        WHERE model_id IN ('model_a','model_b')""",
    ),
)
def latest(spark, d):
    return latest_issue(archive(spark, d), MODELS)


@query(
    "last_observed",
    with_tables(
        "targets", body="SELECT MAX(datetime) AS datetime FROM targets WHERE observation IS NOT NULL"
    ),
)
def last(spark, d):
    return last_observed(targets(spark, d))


@query(
    "archive_extent",
    with_tables("met", body='SELECT MIN(datetime) AS "min", MAX(datetime) AS "max" FROM met'),
)
def archive_extent(spark, d):
    return extent(met(spark, d))


@query(
    "kpi_surface",
    with_tables(
        "forecasts",
        extra=_LATEST_SQL,
        body="""SELECT ROUND(AVG(prediction),6) AS mean,ROUND(MIN(prediction),6) AS "min",
        ROUND(MAX(prediction),6) AS "max" FROM latest WHERE depth=5e-1 AND datetime=reference_datetime""",
    ),
)
def kpi_surface(spark, d):
    kpi = dashboard.kpi_surface(dashboard.latest_temperature(archive(spark, d), MODELS))
    return kpi.select(*[F.round(c, 6).alias(c) for c in kpi.columns])


@query(
    "kpi_mixed",
    with_tables(
        "fc_profile",
        extra=MIXED_SQL,
        body="""SELECT ROUND(AVG(prediction),6) AS value FROM mixing WHERE datetime=reference_datetime
        AND reference_datetime=(SELECT MAX(reference_datetime) FROM fc_profile)""",
    ),
)
def kpi_mixed(spark, d):
    rows = archive(spark, d)
    derived = mixing_rows(rows)
    return dashboard.kpi_mixed(dashboard.latest_mixing(derived, MODELS)).select(
        F.round("value", 6).alias("value")
    )


@query(
    "kpi_horizon",
    with_tables(
        "forecasts",
        extra=_LATEST_SQL,
        body="""SELECT strftime(MAX(reference_datetime)+INTERVAL 1 HOUR,'%b %d, %Y %H:%M')||' CET' AS issued,
        CAST(ROUND_EVEN((epoch(MAX(datetime))-epoch(MAX(reference_datetime)))/864e2,0) AS INTEGER)
        AS horizon_days FROM latest""",
    ),
)
def kpi_horizon(spark, d):
    return dashboard.kpi_horizon(dashboard.latest_temperature(archive(spark, d), MODELS), ZONE)


@query(
    "date_axis",
    with_tables(
        "forecasts",
        extra={
            "ends": "SELECT MIN(datetime)+INTERVAL 1 HOUR AS a, MAX(datetime)+INTERVAL 1 HOUR AS b "
            "FROM forecasts WHERE variable='temperature'",
            "days": "SELECT date_trunc('day',m+INTERVAL 12 HOUR) AS mark FROM "
            "(SELECT UNNEST(generate_series(a,b,INTERVAL 1 DAY)) AS m FROM ends)",
            "major": "SELECT date_trunc('day',m+INTERVAL 12 HOUR) AS mark FROM "
            "(SELECT UNNEST(generate_series(a,b,INTERVAL 3 DAY)) AS m FROM ends)",
        },
        body="SELECT mark FROM days WHERE mark NOT IN (SELECT mark FROM major)",
    ),
)
def date_axis(spark, d):
    rows = archive_slice(archive(spark, d), variables=["temperature"])
    return dashboard.date_axis(dashboard.labelled(rows, {}, ZONE))


@query(
    "dashboard_mixing",
    with_tables(
        "fc_profile",
        extra=MIXED_SQL,
        body="""SELECT CASE model_id WHEN 'model_a' THEN 'First' ELSE model_id END AS model_id,
        reference_datetime+INTERVAL 1 HOUR AS reference_datetime,datetime+INTERVAL 1 HOUR AS datetime,
        ROUND(prediction,6) AS prediction FROM mixing
        WHERE reference_datetime=(SELECT MAX(reference_datetime) FROM fc_profile)""",
    ),
)
def dashboard_mixing(spark, d):
    derived = mixing_rows(archive(spark, d))
    shown = dashboard.dashboard_tables(derived, MODELS, {"model_a": "First"}, ZONE)["mixing"]
    return shown.select("model_id", "reference_datetime", "datetime", F.round("prediction", 6).alias("prediction"))


@query(
    "score_groups",
    with_tables(
        "joined",
        body="""SELECT site_id,variable,model_id,'sample' AS family,COUNT(*) AS n_rows FROM joined GROUP BY ALL""",
    ),
)
def score_groups(spark, d):
    from limnocast.operators.joins import restrict_to
    from limnocast.operators.scoring import match_targets, score_groups

    keys = ["site_id", "variable", "model_id", "family"]
    rows = match_targets(scoreable(forecasts(spark, d), targets(spark, d)), targets(spark, d))
    return (
        restrict_to(rows, score_groups(rows), keys)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


@query(
    "distinct_rows",
    with_tables(
        "met",
        body="SELECT DISTINCT site_id,family,parameter,datetime,variable FROM "
        "(SELECT * FROM met UNION ALL SELECT * FROM met)",
    ),
)
def distinct_rows(spark, d):
    rows = met(spark, d)
    return rows.unionByName(rows).drop("prediction").distinct()


@query(
    "horizons",
    with_tables(
        "forecasts",
        body="""SELECT model_id,reference_datetime,datetime,
        CAST(date_diff('day',reference_datetime,datetime) AS INTEGER) AS horizon_days,
        ROUND((epoch(datetime)-epoch(reference_datetime))/864e2,6) AS horizon,COUNT(*) AS n
        FROM forecasts GROUP BY ALL""",
    ),
)
def horizons(spark, d):
    issued, valid = F.col("reference_datetime"), F.col("datetime")
    return (
        forecasts(spark, d)
        .groupBy("model_id", "reference_datetime", "datetime")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumns(
            {
                "horizon_days": horizon_days(issued, valid),
                "horizon": F.round(horizon_fraction(issued, valid), 6),
            }
        )
    )


@query(
    "string_parts",
    with_tables(
        "forecasts",
        body="""SELECT strftime(reference_datetime,'%Y-%m-%d') AS issue_date,model_id,
        'met_'||model_id||'_'||parameter||'.csv' AS file,parameter AS member,'b' AS last_part,COUNT(*) AS n
        FROM forecasts WHERE model_id='model_b' GROUP BY ALL
        UNION ALL SELECT strftime(reference_datetime,'%Y-%m-%d'),model_id,
        'met_'||model_id||'_'||parameter||'.csv',parameter,'a',COUNT(*)
        FROM forecasts WHERE model_id='model_a' GROUP BY ALL""",
    ),
)
def string_parts(spark, d):
    rows = archive(spark, d)
    path = F.concat(
        F.lit("drivers/reference_datetime="),
        F.col("reference_date"),
        F.lit("/site_id=SITE/met_"),
        F.col("model_id"),
        F.lit("_"),
        F.col("parameter"),
        F.lit(".csv"),
    )
    name = base_name(F.col("path"))
    stem = strip(name, "met_", ".csv")
    # A path stands on many rows; they are counted first, so each path is taken apart once.
    return (
        rows.select("model_id", path.alias("path"))
        .groupBy("model_id", "path")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(
            path_value(F.col("path"), "reference_datetime").alias("issue_date"),
            "model_id",
            name.alias("file"),
            F.regexp_extract(stem, "([^_]*)$", 1).alias("member"),
            split_part(stem, "_", 2).alias("last_part"),
            "rows",
        )
        .groupBy("issue_date", "model_id", "file", "member", "last_part")
        .agg(F.sum("rows").alias("n"))
    )


# ---- grid selection, spines, backtests ----------------------------------------------------


@query(
    "nearest_cell",
    with_tables(
        "grid",
        body=f"""SELECT latitude,longitude,ROUND(temperature_2m,6) AS temperature_2m FROM grid
        WHERE latitude=(SELECT latitude FROM grid ORDER BY ABS(latitude-{LAT}e0),latitude DESC LIMIT 1)
        AND longitude=(SELECT longitude FROM grid ORDER BY ABS(longitude-{LON}e0),longitude DESC LIMIT 1)""",
    ),
)
def nearest(spark, d):
    return nearest_cell(grid(spark, d), LON, LAT).withColumn(
        "temperature_2m", F.round("temperature_2m", 6)
    )


@query(
    "anchored_slice",
    with_tables(
        "analysis_grid",
        body="""SELECT time,latitude,longitude,ROUND(temperature_2m,6) AS temperature_2m FROM analysis_grid
        WHERE time>=TIMESTAMP '2024-01-10' AND time<TIMESTAMP '2024-01-22'""",
    ),
)
def anchored(spark, d):
    return anchored_slice(analysis_grid(spark, d), "time", "2024-01-10", "2024-01-20").select(
        "time", "latitude", "longitude", F.round("temperature_2m", 6).alias("temperature_2m")
    )


@query(
    "replicate_members",
    with_tables(
        "analysis_grid",
        body="""SELECT time,latitude,longitude,ROUND(temperature_2m,6) AS temperature_2m,
        CAST(UNNEST(generate_series(0,30)) AS DOUBLE) AS parameter FROM analysis_grid""",
    ),
)
def replicated(spark, d):
    series = analysis_grid(spark, d).select(
        "time", "latitude", "longitude", F.round("temperature_2m", 6).alias("temperature_2m")
    )
    return replicate_members(series, 31)


@query(
    "missing_times",
    with_tables(
        "targets",
        body="""SELECT h AS datetime FROM (SELECT UNNEST(generate_series(TIMESTAMP '2024-01-01 00:00:00',
        TIMESTAMP '2024-02-02 23:00:00',INTERVAL 1 HOUR)) AS h) x
        WHERE h NOT IN (SELECT datetime FROM targets WHERE observation IS NOT NULL)""",
    ),
)
def missing_times(spark, d):
    return missing_hours(with_observation(targets(spark, d)), "2024-01-01", "2024-02-02")


@query(
    "missing_dates",
    with_tables(
        "fc_members",
        body="""SELECT strftime(h,'%Y-%m-%d') AS issue_date FROM (SELECT UNNEST(generate_series(
        TIMESTAMP '2023-12-25',TIMESTAMP '2024-02-10',INTERVAL 1 DAY)) AS h) x
        WHERE h NOT IN (SELECT reference_datetime FROM fc_members)""",
    ),
)
def lacking_dates(spark, d):
    days = missing_dates(archive(spark, d), "reference_datetime", "2023-12-25", "2024-02-10")
    return days.select(F.date_format("reference_datetime", "yyyy-MM-dd").alias("issue_date"))


BACKTEST = Backtest(
    start="2023-12-27",
    first_origin="2024-01-02",
    step_days=3,
    count=8,
    horizon_days=7,
    models=MODELS,
)


@query(
    "backtest_windows",
    with_tables(
        "targets",
        extra={
            "windows": """SELECT m AS model,CAST(i AS INTEGER) AS simulation,
              CASE WHEN i=1 THEN TIMESTAMP '2023-12-27' ELSE TIMESTAMP '2024-01-02'
                +to_days(CAST((i-2)*3 AS INTEGER)) END AS start_date,
              TIMESTAMP '2024-01-02'+to_days(CAST((i-1)*3 AS INTEGER)) AS end_date,
              CAST(CASE WHEN i=1 THEN 0 ELSE 7 END AS INTEGER) AS horizon
              FROM (SELECT i, UNNEST(['model_a','model_b']) AS m
              FROM (SELECT UNNEST(generate_series(1,9)) AS i))"""
        },
        body="""SELECT w.model,w.simulation,strftime(w.start_date,'%Y-%m-%d') AS start_date,
        strftime(w.end_date,'%Y-%m-%d') AS end_date,w.horizon,COUNT(t.observation) AS n_targets,
        ROUND(AVG(t.observation),6) AS mean_observation FROM windows w LEFT JOIN targets t
        ON t.datetime>=w.end_date AND t.datetime<=w.end_date+to_days(w.horizon)
        AND t.observation IS NOT NULL GROUP BY ALL""",
    ),
)
def backtest(spark, d):
    rows = backtest_coverage(targets(spark, d), BACKTEST)
    return rows.withColumns(
        {
            "start_date": F.date_format("start_date", "yyyy-MM-dd"),
            "end_date": F.date_format("end_date", "yyyy-MM-dd"),
            "mean_observation": F.round("mean_observation", 6),
        }
    )
