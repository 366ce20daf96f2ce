"""Queries that store tables in the shared folder and work on what is stored: layouts, listings, ledgers, cubes, files."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.archive import MIXED_SQL
from checks.drivers import _ISSUES, _ROW, FIRST, LAST, SERIES, _history_sql, _rows, hourly_sql
from checks.registry import query
from checks.scoring import _G, _NAMES, _ROUNDED_SQL, GROUP, _rounded, score_sql
from checks.profiles import KEYS
from checks.tables import (
    HYPSOGRAPHY,
    LAT,
    LON,
    MODELS,
    SITE,
    analysis_grid,
    archive,
    forecast_grid,
    forecasts,
    met,
    targets,
    with_tables,
)
from limnocast.operators.profiles import per_profile
from limnocast.plans import drivers as J
from limnocast.plans.backtest import coverage_at, windows_at
from limnocast.plans.diagnostics import MIXED, add_diagnostics
from limnocast.plans.ledger import observation_changes, partitions_to_open, update_scores_by_ledger
from limnocast.plans.scorekeeping import score_batch
from limnocast.schemas import FORECAST_SCHEMA, MET_SCHEMA, SCORE_SCHEMA, STAGE2_SCHEMA, STAGE3_PARTITIONS, TARGET_SCHEMA, conform
from limnocast.session import checkpointed, scratch_folder
from limnocast.sources.catalogue import archive_partitions, listed_dates
from limnocast.sources.cubes import Cube, write_cube
from limnocast.sources.readers import read_dataset, read_forecasts, read_member_files, read_met, read_or_empty, read_targets
from limnocast.sources.writers import write_batch_scores, write_forecasts, write_partitions, write_targets

_SPLIT = "2024-01-20"


def _local(df, *columns):
    """Times without a zone, as the tables have them."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


@query(
    "member_files",
    with_tables(
        "met",
        body="""SELECT parameter,datetime,variable,ROUND(prediction,6) AS prediction FROM (
        SELECT CAST(CAST(parameter AS INTEGER) AS VARCHAR) AS parameter,datetime,
        CASE variable WHEN 'eastward_wind' THEN 'wind_speed' ELSE variable END AS variable,prediction FROM met
        WHERE variable IN ('air_temperature','eastward_wind')
        AND NOT (variable='eastward_wind' AND CAST(parameter AS INTEGER)=4)) x WHERE prediction IS NOT NULL""",
    ),
)
def member_files(spark, d):
    """Members whose files name their columns in another order, hold more of them, or lack one."""
    wide = met(spark, d).groupBy("parameter", "datetime").agg(
        F.max(F.when(F.col("variable") == "air_temperature", F.col("prediction"))).alias("AirTemp"),
        F.max(F.when(F.col("variable") == "eastward_wind", F.col("prediction"))).alias("WindSpeed"),
    )
    time = F.date_format("datetime", "yyyy-MM-dd HH:mm:ss").alias("time")
    headers = {
        0: [time, "AirTemp", "WindSpeed"],
        1: ["WindSpeed", time, "AirTemp"],
        2: [time, F.lit(7).alias("Rain"), "AirTemp", F.lit("a,b").alias("Note, long"), "WindSpeed"],
        3: ["AirTemp", "WindSpeed", time],
        4: [time, "AirTemp"],
    }
    with scratch_folder(spark, "members") as folder:
        for member, columns in headers.items():
            rows = wide.where(F.col("parameter") == member).select(*columns)
            rows.write.csv(f"{folder}/met_gefs_{member}.csv", header=True, nullValue="NA")
        read = read_member_files(spark, folder, "gefs")
        rows = J.member_rows(read, "gefs", SITE, "2024-01-01", "2024-01-01")
        out = rows.select("parameter", "datetime", "variable", F.round("prediction", 6).alias("prediction"))
        return checkpointed(_local(out, "datetime"))


@query(
    "partition_dates",
    with_tables(
        "fc_members",
        body="SELECT DISTINCT strftime(reference_datetime,'%Y-%m-%d') AS issue_date FROM fc_members WHERE model_id='model_a'",
    ),
)
def partition_dates(spark, d):
    """Stored issue dates of a site, from folder names alone."""
    held = archive(spark, d).withColumns(
        {
            "reference_datetime": F.to_date("reference_datetime"),
            "site_id": F.when(F.col("model_id") == "model_a", F.lit("one+two %")).otherwise("other"),
        }
    )
    partitions = ["reference_datetime", "site_id"]
    with scratch_folder(spark, "dates") as folder:
        write_partitions(held.select(*partitions, "datetime", "prediction"), folder, partitions)
        # A site's folder is named with its odd characters escaped.
        listed = listed_dates(spark, folder, "one+two %25", partitions)
        return checkpointed(listed.select(F.date_format("reference_datetime", "yyyy-MM-dd").alias("issue_date")))


@query(
    "score_ledger",
    with_tables(
        "joined",
        extra=score_sql("joined"),
        body=f"""SELECT {_G},'sample' AS family,ROUND(observation,6) AS observation,ROUND(crps,6) AS crps,
        ROUND(logs,6) AS logs,{_ROUNDED_SQL} FROM scores""",
    ),
)
def score_ledger(spark, d):
    """Scores after three runs by the ledger: early observations, all of them, and one with nothing new."""
    seen = conform(targets(spark, d), TARGET_SCHEMA)
    issued = conform(archive(spark, d).withColumn("forecast", F.lit(None).cast("double")), FORECAST_SCHEMA)
    with scratch_folder(spark, "ledger") as folder:
        paths = [f"{folder}/{name}" for name in ("forecasts", "targets", "scores", "state")]
        write_forecasts(issued, paths[0])
        write_targets(seen.where(F.col("datetime") < F.lit(_SPLIT).cast("timestamp")), paths[1])
        update_scores_by_ledger(spark, *paths, duration="PT1H")
        write_targets(seen, paths[1])
        update_scores_by_ledger(spark, *paths, duration="PT1H")
        if update_scores_by_ledger(spark, *paths, duration="PT1H"):
            raise AssertionError("a run with nothing new opened forecasts")
        scores = read_or_empty(spark, paths[2], SCORE_SCHEMA)
        out = _rounded(scores, "observation", "crps", "logs", *_NAMES)
        out = out.select(*GROUP, "family", "observation", "crps", "logs", *[F.col(f"`{n}`") for n in _NAMES])
        return checkpointed(_local(out, "reference_datetime", "datetime"))


def _drifted(df):
    """An earlier state of the observations: before a date, and in even hours 5 % higher."""
    y = F.col("observation")
    return df.where(F.col("datetime") < F.lit(_SPLIT).cast("timestamp_ntz")).withColumn(
        "observation", F.when(F.hour("datetime") % 2 == 0, y * F.lit(1.05)).otherwise(y)
    )


_CHANGES = {
    "before_": f"""SELECT * REPLACE (CASE WHEN hour(datetime)%2=0 THEN observation*105e-2 ELSE observation END AS observation)
      FROM targets WHERE datetime<TIMESTAMP '{_SPLIT}' AND observation IS NOT NULL""",
    "now_": "SELECT * FROM targets WHERE observation IS NOT NULL AND hour(datetime)<>3",
    "changes": """SELECT n.site_id,n.datetime,n.duration,n.variable,n.depth,CAST(NULL AS DOUBLE) AS was,n.observation,'new' AS change
      FROM now_ n WHERE NOT EXISTS (SELECT 1 FROM before_ b WHERE b.site_id=n.site_id AND b.datetime=n.datetime
      AND b.duration=n.duration AND b.variable=n.variable AND b.depth IS NOT DISTINCT FROM n.depth)
      UNION ALL SELECT b.site_id,b.datetime,b.duration,b.variable,b.depth,b.observation,n.observation,
      CASE WHEN n.observation IS NULL THEN 'gone' ELSE 'changed' END
      FROM before_ b LEFT JOIN now_ n ON b.site_id=n.site_id AND b.datetime=n.datetime
      AND b.duration=n.duration AND b.variable=n.variable AND b.depth IS NOT DISTINCT FROM n.depth
      WHERE n.observation IS NULL OR NOT COALESCE(ABS(b.observation-n.observation)/NULLIF(b.observation,0e0)<1e-2,FALSE)""",
}


def _changes(spark, d):
    now = targets(spark, d).where(F.hour("datetime") != 3)
    return observation_changes(now, _drifted(targets(spark, d)))


@query(
    "observation_changes",
    with_tables(
        "targets",
        extra=_CHANGES,
        body="SELECT * REPLACE (ROUND(was,6) AS was,ROUND(observation,6) AS observation) FROM changes",
    ),
)
def changed_observations(spark, d):
    """Observations that are new, changed or gone since an earlier state."""
    return _rounded(_changes(spark, d), "was", "observation")


_KEYS = "site_id,model_id,strftime(reference_datetime,'%Y-%m-%d') AS reference_date,'PT1H' AS duration"


@query(
    "partitions_to_open",
    with_tables(
        "forecasts",
        "targets",
        extra={
            **_CHANGES,
            "spans": f"SELECT {_KEYS},MIN(datetime) AS first_valid,MAX(datetime) AS last_valid,COUNT(*) AS n FROM forecasts GROUP BY ALL",
            "known": "SELECT * FROM spans WHERE model_id='model_a' AND n%3<>0",
        },
        body="""SELECT site_id,model_id,reference_date,duration FROM spans s
        WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.site_id=s.site_id AND k.model_id=s.model_id
        AND k.reference_date=s.reference_date)
        OR EXISTS (SELECT 1 FROM changes c WHERE c.change='changed' AND hour(c.datetime)=4
        AND c.site_id=s.site_id AND c.datetime BETWEEN s.first_valid AND s.last_valid)""",
    ),
)
def to_open(spark, d):
    """Forecast partitions that a ledger, a listing and a change set call for."""
    keyed = forecasts(spark, d).withColumn("reference_date", F.date_format("reference_datetime", "yyyy-MM-dd"))
    spans = keyed.groupBy("site_id", "model_id", "reference_date", "duration").agg(
        F.min("datetime").alias("first_valid"), F.max("datetime").alias("last_valid"), F.count("*").alias("mark")
    )
    ledger = spans.where((F.col("model_id") == "model_a") & (F.col("mark") % 3 != 0))
    fresh = _changes(spark, d).where((F.col("change") == "changed") & (F.hour("datetime") == 4))
    return partitions_to_open(spans, ledger, fresh)


_ORIGINS = """SELECT CASE WHEN event_id%2=0 THEN 'model_a' ELSE 'model_b' END AS model,CAST(ts AS DATE) AS end_date,
  CAST(MAX(user_id%5)*4+1 AS INTEGER) AS horizon FROM events WHERE event_type='purchase' AND user_id%7=3 AND day(ts)%4<>1 GROUP BY ALL"""


@query(
    "backtest_irregular",
    with_tables(
        "targets",
        extra={
            "origins": _ORIGINS,
            "numbered": """SELECT *,ROW_NUMBER() OVER w AS simulation,LAG(end_date) OVER w AS earlier FROM origins
              WINDOW w AS (PARTITION BY model ORDER BY end_date)""",
            "windows": """SELECT model,CAST(simulation AS INTEGER) AS simulation,COALESCE(earlier,DATE '2023-12-20') AS start_date,end_date,
              CAST(CASE WHEN simulation=1 THEN 0 ELSE horizon END AS INTEGER) AS horizon FROM numbered""",
        },
        body="""SELECT w.model,w.simulation,strftime(w.start_date,'%Y-%m-%d') AS start_date,
        strftime(w.end_date,'%Y-%m-%d') AS end_date,w.horizon,COUNT(t.observation) AS n_targets,
        ROUND(AVG(t.observation),6) AS mean_observation FROM windows w LEFT JOIN targets t
        ON t.datetime>=w.end_date AND t.datetime<=w.end_date+to_days(w.horizon)
        AND t.observation IS NOT NULL GROUP BY ALL""",
    ),
)
def backtest_irregular(spark, d):
    """Forecasts from irregular origins whose windows overlap and differ in length."""
    events = spark.read.parquet(f"{d}/events.parquet").where("event_type = 'purchase' AND user_id % 7 = 3 AND day(ts) % 4 <> 1")
    origins = events.groupBy(
        F.when(F.col("event_id") % 2 == 0, MODELS[0]).otherwise(MODELS[1]).alias("model"), F.to_date("ts").alias("end_date")
    ).agg((F.max(F.col("user_id") % 5) * 4 + 1).cast("int").alias("horizon"))
    rows = coverage_at(targets(spark, d), windows_at(origins, "2023-12-20"))
    return rows.withColumns(
        {
            "start_date": F.date_format("start_date", "yyyy-MM-dd"),
            "end_date": F.date_format("end_date", "yyyy-MM-dd"),
            "mean_observation": F.round("mean_observation", 6),
        }
    )


@query(
    "cube_drivers",
    with_tables(
        "forecast_grid",
        extra={**_ISSUES, **hourly_sql("long_rows", LON, LAT, 273.0, "reference_datetime,site_id")},
        body=f"""SELECT strftime(reference_datetime,'%Y-%m-%d') AS issue_date,{_ROW} FROM hourly
        WHERE day(reference_datetime)%3=0""",
    ),
)
def cube_drivers(spark, d):
    """Drivers of every third date from a stored cube, by its axes."""
    with scratch_folder(spark, "cube") as folder:
        write_cube(forecast_grid(spark, d), f"{folder}/cube", "init_time")
        days = spark.range(1).select(F.explode(F.sequence(F.lit(FIRST).cast("date"), F.lit(LAST).cast("date"))).alias("day"))
        days = [r["day"].isoformat() for r in days.where(F.day("day") % 3 == 0).collect()]
        rows = J.forecast_drivers(Cube(spark, f"{folder}/cube"), SITE, LON, LAT, FIRST, LAST, days=days)
        return checkpointed(_rows(rows, F.date_format("reference_datetime", "yyyy-MM-dd").alias("issue_date")))


@query(
    "stored_targets",
    with_tables(
        "targets", body="SELECT * REPLACE (ROUND(observation,6) AS observation) FROM targets WHERE observation IS NOT NULL"
    ),
)
def stored_targets(spark, d):
    """Observations written as CSV and read back by name."""
    with scratch_folder(spark, "targets") as folder:
        write_targets(conform(targets(spark, d), TARGET_SCHEMA), folder)
        return checkpointed(_local(_rounded(read_targets(spark, folder), "observation"), "datetime"))


@query(
    "stored_batch",
    with_tables(
        "joined",
        extra={"states": "SELECT * FROM joined WHERE variable_type='state'", **score_sql("states")},
        body=f"""SELECT {_G},'sample' AS family,ROUND(observation,6) AS observation,ROUND(crps,6) AS crps,
        ROUND(logs,6) AS logs,{_ROUNDED_SQL},
        ROUND((epoch(datetime)-epoch(reference_datetime))/864e2,6) AS horizon,
        strftime(reference_datetime,'%Y-%m-%d') AS reference_date FROM scores""",
    ),
)
def stored_batch(spark, d):
    """Scores of a batch, written by partition and read back."""
    scored = score_batch(forecasts(spark, d), targets(spark, d))
    with scratch_folder(spark, "batch") as folder:
        write_batch_scores(scored, folder)
        read = read_dataset(spark, folder).withColumn("reference_date", F.date_format("reference_date", "yyyy-MM-dd"))
        return checkpointed(_rounded(read, "observation", "crps", "logs", "horizon", *_NAMES))


@query(
    "stored_drivers",
    with_tables(
        "forecast_grid",
        extra={**_ISSUES, **hourly_sql("long_rows", LON, LAT, 273.0, "reference_datetime,site_id")},
        body=f"SELECT strftime(reference_datetime,'%Y-%m-%d') AS issue_date,{_ROW} FROM hourly",
    ),
)
def stored_drivers(spark, d):
    """A forecast driver archive that gains its dates in two runs."""
    grid = forecast_grid(spark, d)
    with scratch_folder(spark, "drivers") as folder:
        J.update_forecast_archive(spark, folder, grid, SITE, LON, LAT, "2024-01-05", "2024-01-20")
        J.update_forecast_archive(spark, folder, grid, SITE, LON, LAT, FIRST, LAST)
        read = read_or_empty(spark, folder, STAGE2_SCHEMA)
        rows = _rows(read, F.date_format("reference_datetime", "yyyy-MM-dd").alias("issue_date"))
        return checkpointed(_local(rows, "datetime"))


@query(
    "stored_history",
    with_tables(
        "met",
        "analysis_grid",
        extra={
            **_history_sql("2024-01-05", "2024-01-25", 5),
            "both_sides": """SELECT 0 AS rank,site_id,family,parameter,variable,datetime,prediction FROM met
              UNION ALL SELECT 1,* FROM history""",
            "kept": f"""SELECT *,ROW_NUMBER() OVER (PARTITION BY {SERIES},datetime ORDER BY rank DESC) AS n
              FROM both_sides""",
        },
        body=f"SELECT {_ROW} FROM kept WHERE n=1",
    ),
)
def stored_history(spark, d):
    """A history archive by months that gains the hours it lacks."""
    with scratch_folder(spark, "history") as folder:
        path = f"{folder}/met"
        write_partitions(conform(met(spark, d), MET_SCHEMA), path, archive_partitions(spark, path, STAGE3_PARTITIONS))
        J.update_history_archive(spark, path, analysis_grid(spark, d), SITE, LON, LAT, "2024-01-05", "2024-01-25", 5)
        return checkpointed(_local(_rows(read_met(spark, path)), "datetime"))


@query(
    "stored_diagnostics",
    with_tables(
        "fc_profile",
        extra=MIXED_SQL,
        body=f"""SELECT model_id,reference_datetime,datetime,'{MIXED}' AS variable,'prob' AS parameter,ROUND(prediction,6) AS prediction
        FROM mixing WHERE model_id='model_a' AND strftime(reference_datetime,'%Y-%m-%d')='2024-01-08'""",
    ),
)
def stored_diagnostics(spark, d):
    """Diagnostics added, twice, to one partition of a stored archive."""
    issued = conform(archive(spark, d).withColumn("forecast", F.lit(None).cast("double")), FORECAST_SCHEMA)
    with scratch_folder(spark, "diagnostics") as folder:
        write_forecasts(issued, folder)
        for _ in range(2):
            add_diagnostics(spark, folder, SITE, "model_a", "2024-01-08", HYPSOGRAPHY)
        rows = read_forecasts(spark, folder).where(F.col("variable") == MIXED)
        names = ["model_id", "reference_datetime", "datetime", "variable", "parameter"]
        out = rows.select(*names, F.round("prediction", 6).alias("prediction"))
        return checkpointed(_local(out, "reference_datetime", "datetime"))


@query(
    "per_profile",
    with_tables(
        "fc_profile",
        body="""SELECT model_id,reference_datetime,datetime,parameter,CAST(COUNT(*) AS BIGINT) AS depths,
        ROUND(MAX(prediction)-MIN(prediction),6) AS spread FROM fc_profile GROUP BY ALL""",
    ),
)
def spread_per_profile(spark, d):
    """A caller's own function of each profile."""
    kinds = dict(forecasts(spark, d).dtypes)
    schema = ", ".join(f"{k} {kinds[k]}" for k in KEYS) + ", depths long, spread double"

    def spread(key, profile):
        t = profile["temperature"]
        return *key, len(profile), t.max() - t.min()

    return _rounded(per_profile(forecasts(spark, d), spread, schema, KEYS), "spread")
