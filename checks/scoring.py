"""Queries that pair forecasts with observations and score them."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from checks.archive import MIXED_SQL
from checks.registry import query
from checks.tables import archive, forecasts, prior_scores, targets, with_tables
from limnocast.functions.water import water_density
from limnocast.operators.joins import restrict_to
from limnocast.operators.reshape import depths_wide, scoreable
from limnocast.operators.scoring import (
    match_targets,
    merge_scores,
    score_forecasts,
    single_observation,
    still_valid,
    unscored,
)
from limnocast.plans.diagnostics import MIXED, mixing_rows
from limnocast.plans.scorekeeping import score_batch, score_incremental

GROUP = ["site_id", "model_id", "reference_datetime", "datetime", "variable", "duration", "depth"]
_G = ",".join(GROUP)


def _rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(F.col(f"`{c}`"), digits) for c in columns})


def score_sql(rows: str) -> dict[str, str]:
    """CRPS, log score and summary of every group of ``rows``, from ranks."""
    return {
        "ranked": f"""SELECT {_G},observation AS y,prediction AS x,
          ROW_NUMBER() OVER (PARTITION BY {_G},observation ORDER BY prediction) AS i,
          COUNT(*) OVER (PARTITION BY {_G},observation) AS m FROM {rows}""",
        "summary": f"""SELECT {_G},y,m,SUM(ABS(x-y))/m-SUM(x*(2*i-m-1))/(CAST(m AS DOUBLE)*m) AS crps,
          AVG(x) AS mean,STDDEV_SAMP(x) AS sd,MIN(ABS(x-y)) AS nearest,
          quantile_cont(x,0.5) AS median,quantile_cont(x,0.975) AS q975,quantile_cont(x,0.025) AS q025,
          quantile_cont(x,0.95) AS q95,quantile_cont(x,0.05) AS q05,
          quantile_cont(x,0.75)-quantile_cont(x,0.25) AS iqr FROM ranked GROUP BY {_G},y,m""",
        "width": f"""SELECT *,CASE WHEN LEAST(sd,iqr/1.34e0)>0 THEN 1.06e0*LEAST(sd,iqr/1.34e0)
          *POW(CAST(m AS DOUBLE),-0.2e0) END AS h FROM summary""",
        "kernel": f"""SELECT {",".join("r." + g for g in GROUP)},r.y,
          SUM(EXP(-5e-1*((r.y-r.x)/h)*((r.y-r.x)/h)+5e-1*(nearest/h)*(nearest/h))) AS k
          FROM ranked r JOIN width w ON {" AND ".join(f"r.{g} IS NOT DISTINCT FROM w.{g}" for g in GROUP)}
          AND r.y=w.y WHERE h IS NOT NULL GROUP BY ALL""",
        "scores": f"""SELECT {",".join("w." + g for g in GROUP)},w.y AS observation,crps,
          LN(h)+5e-1*LN(2e0*PI())+LN(m)+5e-1*(nearest/h)*(nearest/h)-LN(k) AS logs,
          mean,median,sd,q975 AS "quantile97.5",q025 AS "quantile02.5",q95 AS quantile90,q05 AS quantile10
          FROM width w LEFT JOIN kernel k ON {" AND ".join(f"k.{g} IS NOT DISTINCT FROM w.{g}" for g in GROUP)}
          AND k.y=w.y""",
    }


def _renamed(sql: str) -> str:
    """A step of ``score_sql`` that reads a second set of steps."""
    for step in ("ranked", "summary", "width", "kernel"):
        sql = re.sub(rf"(FROM|JOIN) {step}\b", rf"\1 other_{step}", sql)
    return sql


_PAIR = """SELECT model_id,reference_datetime,datetime,variable,depth,parameter,ROUND(prediction,6) AS prediction,
  ROUND(observation,6) AS observation FROM joined"""
_PAIR_COLUMNS = [
    "model_id",
    "reference_datetime",
    "datetime",
    "variable",
    "depth",
    "parameter",
    "prediction",
    "observation",
]


def _pairs(spark, d):
    return _rounded(
        match_targets(forecasts(spark, d), targets(spark, d)), "prediction", "observation"
    ).select(*_PAIR_COLUMNS)


@query("forecast_target_join", with_tables("joined", body=_PAIR))
def forecast_target_join(spark, d):
    return _pairs(spark, d)


@query("null_safe_match", with_tables("joined", body=_PAIR + " WHERE depth IS NULL"))
def null_safe_match(spark, d):
    return _pairs(spark, d).where(F.col("depth").isNull())


_UNSCORED_SQL = """SELECT f.* FROM forecasts f WHERE NOT EXISTS (SELECT 1 FROM prior_scores s WHERE
  s.site_id=f.site_id AND s.datetime=f.datetime AND s.duration=f.duration AND s.variable=f.variable
  AND s.depth IS NOT DISTINCT FROM f.depth AND s.model_id=f.model_id
  AND s.family=CASE WHEN f.family='ensemble' THEN 'sample' ELSE f.family END
  AND s.reference_datetime=f.reference_datetime)"""


@query(
    "unscored_forecasts",
    with_tables(
        "forecasts",
        "prior_scores",
        extra={"todo": _UNSCORED_SQL},
        body="""SELECT model_id,reference_datetime,datetime,variable,depth,parameter,
        ROUND(prediction,6) AS prediction FROM todo""",
    ),
)
def unscored_forecasts(spark, d):
    return unscored(forecasts(spark, d), prior_scores(spark, d)).select(
        *_PAIR_COLUMNS[:6], F.round("prediction", 6).alias("prediction")
    )


_VALID_SQL = """SELECT s.* FROM prior_scores s JOIN targets t ON s.site_id=t.site_id AND s.datetime=t.datetime
  AND s.duration=t.duration AND s.variable=t.variable AND s.depth IS NOT DISTINCT FROM t.depth
  WHERE ABS(s.observation-t.observation)/NULLIF(s.observation,0)<1e-2"""


@query(
    "stale_scores",
    with_tables(
        "prior_scores",
        "targets",
        extra={"valid": _VALID_SQL},
        body="SELECT * EXCLUDE (observation),ROUND(observation,6) AS observation FROM valid",
    ),
)
def stale_scores(spark, d):
    return _rounded(still_valid(prior_scores(spark, d), targets(spark, d)), "observation")


@query(
    "group_restrict",
    with_tables(
        "joined",
        "prior_scores",
        body="""SELECT model_id,reference_datetime,datetime,variable,depth,parameter,
        ROUND(prediction,6) AS prediction,ROUND(observation,6) AS observation FROM joined j
        WHERE EXISTS (SELECT 1 FROM prior_scores s WHERE s.variable=j.variable AND s.model_id=j.model_id)""",
    ),
)
def group_restrict(spark, d):
    rows = match_targets(scoreable(forecasts(spark, d), targets(spark, d)), targets(spark, d))
    listed = restrict_to(
        rows, prior_scores(spark, d), ["site_id", "variable", "model_id", "family"]
    )
    return _rounded(listed, "prediction", "observation").select(*_PAIR_COLUMNS)


@query(
    "merge_scores",
    with_tables(
        "joined",
        "prior_scores",
        body="""SELECT * EXCLUDE (observation),ROUND(observation,6) AS observation FROM (
        SELECT site_id,datetime,duration,variable,depth,model_id,family,reference_datetime,observation
        FROM prior_scores UNION SELECT site_id,datetime,duration,variable,depth,model_id,'sample',
        reference_datetime,observation FROM joined)""",
    ),
)
def merged(spark, d):
    stored = prior_scores(spark, d)
    new = match_targets(scoreable(forecasts(spark, d), targets(spark, d)), targets(spark, d))
    return _rounded(merge_scores(stored, new.select(*stored.columns)), "observation")


@query(
    "crps_ensemble",
    with_tables(
        "joined",
        extra=score_sql("joined"),
        body=f"SELECT {_G},ROUND(crps,6) AS crps FROM scores",
    ),
)
def crps_ensemble(spark, d):
    scored = score_forecasts(forecasts(spark, d), targets(spark, d), summaries=False)
    return scored.select(*GROUP, F.round("crps", 6).alias("crps"))


@query(
    "logs_ensemble",
    with_tables(
        "joined",
        extra=score_sql("joined"),
        body=f"SELECT {_G},ROUND(logs,6) AS logs FROM scores",
    ),
)
def logs_ensemble(spark, d):
    scored = score_forecasts(forecasts(spark, d), targets(spark, d), summaries=False)
    return scored.select(*GROUP, F.round("logs", 6).alias("logs"))


_NAMES = ["mean", "median", "sd", "quantile97.5", "quantile02.5", "quantile90", "quantile10"]
_ROUNDED_SQL = ",".join(f'ROUND("{n}",6) AS "{n}"' for n in _NAMES)


@query(
    "ensemble_summary",
    with_tables(
        "joined",
        extra=score_sql("joined"),
        body=f"SELECT {_G},{_ROUNDED_SQL} FROM scores",
    ),
)
def ensemble_summary(spark, d):
    scored = score_forecasts(forecasts(spark, d), targets(spark, d))
    return _rounded(scored, *_NAMES).select(*GROUP, *[F.col(f"`{n}`") for n in _NAMES])


@query(
    "single_obs",
    with_tables(
        "joined",
        body=f"""SELECT {_G},ROUND(MIN(observation),6) AS observation,
        COUNT(DISTINCT observation)=1 AS single FROM joined GROUP BY ALL""",
    ),
)
def single_obs(spark, d):
    joined = match_targets(forecasts(spark, d), targets(spark, d))
    return _rounded(single_observation(joined, GROUP), "observation")


@query(
    "score_extra_groups",
    with_tables(
        "joined",
        extra={
            "one": "SELECT * FROM joined",
            **score_sql("one"),
            "other": "SELECT * REPLACE (observation+1e0 AS observation) FROM joined",
            **{f"other_{k}": _renamed(v) for k, v in score_sql("other").items()},
        },
        body=f"""SELECT {_G},'p1' AS project_id,ROUND(observation,6) AS observation,ROUND(crps,6) AS crps FROM scores
        UNION ALL SELECT {_G},'p2',ROUND(observation,6),ROUND(crps,6) FROM other_scores""",
    ),
)
def score_extra_groups(spark, d):
    seen = targets(spark, d)
    both = seen.withColumn("project_id", F.lit("p1")).union(
        seen.withColumn("observation", F.col("observation") + 1.0).withColumn("project_id", F.lit("p2"))
    )
    scored = score_forecasts(forecasts(spark, d), both, summaries=False)
    return _rounded(scored, "observation", "crps").select(*GROUP, "project_id", "observation", "crps")


_OBSERVED_MIXING_SQL = {
    "observed": """SELECT datetime,CASE WHEN rho5-rho05<1e-1 THEN 1e0 ELSE 0e0 END AS y FROM (
      SELECT datetime,MAX(CASE WHEN depth=5e0 THEN rho END) AS rho5,MAX(CASE WHEN depth=5e-1 THEN rho END) AS rho05
      FROM (SELECT datetime,depth,1e3*(1e0-(observation+288.9414e0)*(observation-3.9863e0)
      *(observation-3.9863e0)/(508929.2e0*(observation+68.12963e0))) AS rho FROM targets
      WHERE variable='temperature' AND depth IN (5e-1,5e0) AND observation IS NOT NULL) GROUP BY 1)""",
    "chances": """SELECT m.model_id,m.reference_datetime,m.datetime,m.prediction AS p,o.y,
      CASE WHEN o.y=1 THEN m.prediction ELSE 1e0-m.prediction END AS q
      FROM mixing m JOIN observed o ON m.datetime=o.datetime WHERE m.prediction IS NOT NULL""",
}


@query(
    "score_bernoulli",
    with_tables(
        "fc_profile",
        "targets",
        extra={**MIXED_SQL, **_OBSERVED_MIXING_SQL},
        body="""SELECT model_id,reference_datetime,datetime,y AS observation,ROUND((p-y)*(p-y),6) AS crps,
        CASE WHEN q<=0 THEN CAST('Infinity' AS DOUBLE) ELSE ROUND(-LN(q),6) END AS logs,
        ROUND(p,6) AS mean,ROUND(SQRT(p*(1e0-p)),6) AS sd,
        CASE WHEN 1e0-p>=5e-1 THEN 0e0 ELSE 1e0 END AS median FROM chances""",
    ),
)
def score_bernoulli(spark, d):
    probabilities = mixing_rows(archive(spark, d)).withColumn("duration", F.lit("PT1H"))
    seen = depths_wide(
        targets(spark, d)
        .where((F.col("variable") == "temperature") & F.col("observation").isNotNull())
        .withColumnRenamed("observation", "prediction"),
        {"upper": 0.5, "lower": 5.0},
    )
    mixed = water_density(F.col("lower")) - water_density(F.col("upper")) < 0.1
    outcomes = seen.select(
        "site_id",
        "datetime",
        "duration",
        F.lit(MIXED).alias("variable"),
        F.lit(None).cast("double").alias("depth"),
        F.when(mixed, 1.0).otherwise(0.0).alias("observation"),
    )
    scored = score_forecasts(probabilities, outcomes)
    finite = F.when(F.col("logs") < float("inf"), F.round("logs", 6)).otherwise(F.col("logs"))
    return _rounded(scored.withColumn("logs", finite), "crps", "mean", "sd").select(
        "model_id", "reference_datetime", "datetime", "observation", "crps", "logs", "mean", "sd", "median"
    )


_PENDING = {
    "valid": _VALID_SQL,
    "pending": """SELECT j.* FROM joined j
      WHERE j.datetime<=(SELECT MAX(datetime) FROM targets WHERE observation IS NOT NULL)
      AND NOT EXISTS (SELECT 1 FROM valid s WHERE s.site_id=j.site_id AND s.datetime=j.datetime
      AND s.duration=j.duration AND s.variable=j.variable AND s.depth IS NOT DISTINCT FROM j.depth
      AND s.model_id=j.model_id AND s.reference_datetime=j.reference_datetime)""",
}


@query(
    "score_incremental",
    with_tables(
        "joined",
        "targets",
        "prior_scores",
        extra={**_PENDING, **score_sql("pending")},
        body=f"""SELECT {_G},'sample' AS family,ROUND(observation,6) AS observation,ROUND(crps,6) AS crps,
        ROUND(logs,6) AS logs,{_ROUNDED_SQL} FROM scores""",
    ),
)
def incremental(spark, d):
    scored = score_incremental(
        forecasts(spark, d), targets(spark, d), prior_scores(spark, d), rescore=True
    )
    return _rounded(scored, "observation", "crps", "logs", *_NAMES)


@query(
    "score_batch",
    with_tables(
        "joined",
        extra={
            "states": "SELECT * FROM joined WHERE variable_type='state'",
            **score_sql("states"),
        },
        body=f"""SELECT {_G},'sample' AS family,ROUND(observation,6) AS observation,ROUND(crps,6) AS crps,
        ROUND(logs,6) AS logs,{_ROUNDED_SQL},
        ROUND((epoch(datetime)-epoch(reference_datetime))/864e2,6) AS horizon,
        strftime(reference_datetime,'%Y-%m-%d') AS reference_date FROM scores""",
    ),
)
def batch(spark, d):
    scored = score_batch(forecasts(spark, d), targets(spark, d))
    return _rounded(scored, "observation", "crps", "logs", "horizon", *_NAMES)


