"""Queries over depth profiles and their physical diagnostics."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from checks.registry import query
from checks.tables import HYPSOGRAPHY, archive, forecasts, with_tables
from limnocast.functions.water import water_density
from limnocast.operators.profiles import (
    gather_profiles,
    profile_integrals,
    profile_metrics,
    resample_profiles,
)
from limnocast.plans.diagnostics import metric_rows

KEYS = ["model_id", "reference_datetime", "datetime", "parameter"]
_K = ",".join(KEYS)
_RHO = "1e3*(1e0-({t}+288.9414e0)*({t}-3.9863e0)*({t}-3.9863e0)/(508929.2e0*({t}+68.12963e0)))"
_MIDDLE = "(L*1e-1+(L+1)*1e-1)/2e0"


def _blend(here: str, up: str, down: str) -> str:
    sdn = f"(-((L+1)*1e-1-L*1e-1)/NULLIF({down}-{here},0))"
    sup = f"((L*1e-1-(L-1)*1e-1)/NULLIF({here}-{up},0))"
    return (
        f"COALESCE(CASE WHEN L>0 AND L<59 THEN (L+1)*1e-1*({sdn}/({sdn}+{sup}))+L*1e-1*({sup}/({sdn}+{sup})) END,"
        f"{_MIDDLE})"
    )


# One row per profile and grid point, then per profile, from explicit rows and windows.
BODY_SQL = {
    "segments": f"""SELECT {_K},depth AS d0,prediction AS t0,
      LEAD(depth) OVER (PARTITION BY {_K} ORDER BY depth) AS d1,
      LEAD(prediction) OVER (PARTITION BY {_K} ORDER BY depth) AS t1 FROM fc_profile""",
    "lake": """SELECT k*5e-1 AS h0,13e4-3e3*(k*5e-1)*(k*5e-1) AS a0,(k+1)*5e-1 AS h1,
      13e4-3e3*((k+1)*5e-1)*((k+1)*5e-1) AS a1 FROM (SELECT UNNEST(generate_series(0,11)) AS k)""",
    "steps": """SELECT i,i*1e-1 AS z,CASE WHEN i=60 THEN 13e4-3e3*36e0 ELSE a0+(a1-a0)*(i*1e-1-h0)/(h1-h0) END
      AS a FROM (SELECT UNNEST(generate_series(0,60)) AS i) s
      LEFT JOIN lake ON i*1e-1>=h0-1e-9 AND i*1e-1<h1-1e-9""",
    "points": f"""SELECT {_K},i,z,a,CASE WHEN d1 IS NULL THEN t0 ELSE t0+(t1-t0)*(z-d0)/(d1-d0) END AS t
      FROM segments JOIN steps ON z>=d0-1e-9 AND (d1 IS NULL OR z<d1-1e-9)""",
    "dense": f"SELECT *,{_RHO.format(t='t')} AS rho FROM points",
    "layers": f"""SELECT *,LAG(z) OVER w AS z0,LAG(a) OVER w AS a0,LAG(rho) OVER w AS rho0
      FROM dense WINDOW w AS (PARTITION BY {_K} ORDER BY i)""",
    "volumes": f"""SELECT {_K},SUM((a0-a)*((z0+z)/2e0)) AS volume,SUM((z0*a0-z*a)*((z0+z)/2e0)) AS volume_z,
      SUM((rho0*a0-rho*a)*((z0+z)/2e0)) AS mass,SUM((z0*rho0*a0-z*rho*a)*((z0+z)/2e0)) AS mass_z,
      MAX(a) AS top_area,SUM(a) AS weight FROM layers GROUP BY ALL""",
    "bodies": f"""SELECT {_K},volume,volume_z/volume AS z_volume,mass,mass_z/mass AS z_gravity,
      mass/volume AS rho_mean,volume/top_area AS z_mean,weight FROM volumes""",
    "sums": f"""SELECT {",".join("d." + k for k in KEYS)},
      SUM(a*(rho-rho_mean)*(z-z_volume))/ANY_VALUE(weight) AS m1,
      SUM(a*(rho-rho_mean)*(z-z_volume)*(z-z_volume))/ANY_VALUE(weight) AS m2,
      SUM(a*(rho-rho_mean)*(rho-rho_mean))/ANY_VALUE(weight) AS var_rho,
      SUM(a*(z-z_volume)*(z-z_volume))/ANY_VALUE(weight) AS var_z
      FROM dense d JOIN bodies b USING ({_K}) GROUP BY ALL""",
    "gradients": f"""SELECT {_K},i-1 AS L,(rho-rho0)/(z-z0) AS g,9.81e0/rho0*((rho-rho0)/(z-z0)) AS n2
      FROM layers WHERE i>0""",
    "buoyancy": f"""SELECT {_K},MAX(n2) AS n2_max,
      CASE WHEN ABS(SUM(n2))>1e-12 THEN SUM(n2*((L+5e-1)*1e-1))/SUM(n2) END AS z_n2 FROM gradients GROUP BY ALL""",
    "ranges": f"SELECT {_K},MAX(t)-MIN(t) AS t_range FROM dense GROUP BY ALL",
    "near": f"""SELECT *,LAG(g) OVER w AS up,LEAD(g) OVER w AS down,MAX(g) OVER (PARTITION BY {_K}) AS steepest
      FROM gradients WINDOW w AS (PARTITION BY {_K} ORDER BY L)""",
    "tops": f"SELECT {_K},MIN(L) AS top_layer FROM near WHERE g=steepest GROUP BY ALL",
    "peaks": f"""SELECT {_K},MAX(L) AS peak_layer FROM near WHERE L>=1 AND L<=58 AND g>up AND g>=down
      AND g>GREATEST(15e-2*steepest,1e-1) GROUP BY ALL""",
    "depths": f"SELECT {_K},L,{_blend('g', 'up', 'down')} AS layer_z FROM near",
    "thermo": f"""SELECT {_K},CASE WHEN t_range>=1e0 THEN
      CASE WHEN peak_layer>top_layer+1 THEN GREATEST(peak_z,top_z) ELSE top_z END END AS z_therm
      FROM ranges JOIN tops USING ({_K}) LEFT JOIN peaks USING ({_K})
      JOIN (SELECT {_K},L AS top_layer,layer_z AS top_z FROM depths) s USING ({_K},top_layer)
      LEFT JOIN (SELECT {_K},L AS peak_layer,layer_z AS peak_z FROM depths) p USING ({_K},peak_layer)""",
    "metrics": f"""SELECT {_K},9.81e0*z_mean*rho_mean*(z_gravity-z_volume) AS "Ws",m1 AS "M1",m2 AS "M2",
      CASE WHEN SQRT(var_rho)*SQRT(var_z)>1e-9 THEN m1/(SQRT(var_rho)*SQRT(var_z)) END AS eta,
      CASE WHEN ABS(m1)>1e-9 THEN m2/m1 END AS m_ratio,z_therm,z_n2,n2_max,
      var_rho*9.81e0*9.81e0/(rho_mean*rho_mean) AS b_var
      FROM bodies JOIN sums USING ({_K}) JOIN buoyancy USING ({_K}) JOIN thermo USING ({_K})""",
}
# Digits kept when comparing.
DIGITS = {
    "Ws": 5,
    "M1": 6,
    "M2": 6,
    "eta": 5,
    "m_ratio": 5,
    "z_therm": 6,
    "z_n2": 6,
    "n2_max": 9,
    "b_var": 12,
}
_METRICS_SQL = ",".join(f'ROUND("{m}",{n}) AS "{m}"' for m, n in DIGITS.items())


def _sql(body: str) -> str:
    """``body`` with only those of the steps above that it needs."""
    names = list(BODY_SQL)
    needed: set[str] = set()

    def words(text: str) -> set[str]:
        return set(re.findall(r"\b[a-z_]+\b", text))

    def visit(text: str) -> None:
        for name in words(text) & set(names):
            if name not in needed:
                needed.add(name)
                visit(BODY_SQL[name])

    visit(body)
    return with_tables("fc_profile", extra={n: BODY_SQL[n] for n in names if n in needed}, body=body)


def _metrics(spark, d):
    return profile_metrics(forecasts(spark, d), HYPSOGRAPHY, keys=KEYS)


def _some(names: list[str]):
    def run(spark, d):
        rows = _metrics(spark, d)
        return rows.select(*KEYS, *[F.round(n, DIGITS[n]).alias(n) for n in names])

    return run


def _some_sql(names: list[str]) -> str:
    chosen = ",".join(f'ROUND("{n}",{DIGITS[n]}) AS "{n}"' for n in names)
    return _sql(f"SELECT {_K},{chosen} FROM metrics")


for _name, _columns in {
    "stability": ["Ws"],
    "moments": ["M1", "M2", "eta", "m_ratio"],
    "thermocline": ["z_therm"],
    "center_buoyancy": ["z_n2"],
    "n2_max": ["n2_max"],
    "b_var": ["b_var"],
    "profile_metrics": list(DIGITS),
}.items():
    query(_name, _some_sql(_columns))(_some(_columns))


@query(
    "water_density",
    with_tables(
        "fc_profile",
        body=f"SELECT {_K},depth,ROUND({_RHO.format(t='prediction')},6) AS rho FROM fc_profile",
    ),
)
def density(spark, d):
    rho = F.round(water_density(F.col("prediction")), 6).alias("rho")
    rows = forecasts(spark, d).where(F.col("variable") == "temperature")
    return rows.select(*KEYS, "depth", rho)


@query(
    "profile_resample",
    _sql(
        f"SELECT {_K},COUNT(*) AS n_points,ROUND(SUM(t),6) AS sum_temperature,ROUND(MIN(t),6) AS coldest,"
        "ROUND(SUM(a),4) AS sum_area,ROUND(SUM(i*t),5) AS depth_sum FROM points GROUP BY ALL"
    ),
)
def profile_resample(spark, d):
    profiles = gather_profiles(forecasts(spark, d), KEYS)
    t = F.col("temperature")
    return (
        resample_profiles(profiles, HYPSOGRAPHY)
        .groupBy(*KEYS)
        .agg(
            F.count(F.lit(1)).alias("n_points"),
            F.round(F.sum(t), 6).alias("sum_temperature"),
            F.round(F.min(t), 6).alias("coldest"),
            F.round(F.sum("area"), 4).alias("sum_area"),
            F.round(F.sum(F.col("i") * t), 5).alias("depth_sum"),
        )
    )


_BODY_DIGITS = {
    "volume": 4,
    "z_volume": 8,
    "mass": 0,
    "z_gravity": 8,
    "rho_mean": 6,
    "z_mean": 6,
}


@query(
    "profile_integrals",
    _sql(
        f"SELECT {_K}," + ",".join(f"ROUND({c},{n}) AS {c}" for c, n in _BODY_DIGITS.items()) + " FROM bodies"
    ),
)
def integrals(spark, d):
    resampled = resample_profiles(gather_profiles(forecasts(spark, d), KEYS), HYPSOGRAPHY)
    body = profile_integrals(resampled)
    return body.select(*KEYS, *[F.round(c, n).alias(c) for c, n in _BODY_DIGITS.items()])


@query(
    "metrics_long",
    _sql(
        " UNION ALL ".join(
            f"SELECT {_K},'ensemble' AS family,'diagnostic' AS variable_type,'{m}' AS variable,"
            f'ROUND("{m}",{n}) AS prediction FROM metrics'
            for m, n in DIGITS.items()
        )
    ),
)
def metrics_long(spark, d):
    rows = metric_rows(archive(spark, d), HYPSOGRAPHY)
    rounded = F.coalesce(
        *[F.when(F.col("variable") == m, F.round("prediction", n)) for m, n in DIGITS.items()]
    )
    return rows.select(*KEYS, "family", "variable_type", "variable", rounded.alias("prediction"))
