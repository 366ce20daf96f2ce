import math
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from limnocast.functions.water import grid_areas, layer_depth, water_density
from limnocast.operators.profiles import (
    METRICS,
    gather_profiles,
    mixing_probability,
    per_profile,
    profile_integrals,
    profile_metrics,
    resample_profiles,
)
from limnocast.plans.diagnostics import metric_rows, mixing_rows, with_diagnostics

LAKE = [(k * 0.5, 13e4 - 3e3 * (k * 0.5) ** 2) for k in range(13)]
FC = (
    "site_id string, model_id string, reference_datetime timestamp, datetime timestamp, "
    "parameter string, variable string, depth double, prediction double, family string, "
    "variable_type string, log_weight double, reference_date string"
)
T0 = datetime(2024, 1, 1)


def profile_rows(spark, members):
    rows = [
        ("S", "m", T0, T0, str(n), "temperature", float(z), float(t), "ensemble", "state", 0.0, "2024-01-01")
        for n, points in enumerate(members)
        for z, t in points
    ]
    return spark.createDataFrame(rows, FC)


def rho(t):
    t = np.asarray(t, float)
    return 1000 * (1 - (t + 288.9414) * (t - 3.9863) ** 2 / (508929.2 * (t + 68.12963)))


def trapezoid(x, y):
    return float(np.sum(np.diff(x) * (y[1:] + y[:-1]) / 2))


def direct_metrics(points, lake, dz=0.1, g=9.81):
    """The diagnostics of one profile by plain array arithmetic."""
    zs, ts = np.array(sorted(points)).T
    hz, ha = np.array(sorted(lake)).T
    n = math.floor(max(zs.max(), hz.max()) / dz + 1e-10)
    z = np.arange(n + 1) * dz
    a, t = np.interp(z, hz, ha), np.interp(z, zs, ts)
    r = rho(t)
    volume = -trapezoid(a, z)
    z_v = -trapezoid(z * a, z) / volume
    mass = -trapezoid(r * a, z)
    z_g = -trapezoid(z * r * a, z) / mass
    mean = mass / volume
    w = a / a.sum()
    m1, m2 = (w * (r - mean) * (z - z_v)).sum(), (w * (r - mean) * (z - z_v) ** 2).sum()
    s_rho, s_z = math.sqrt((w * (r - mean) ** 2).sum()), math.sqrt((w * (z - z_v) ** 2).sum())
    grad = np.diff(r) / np.diff(z)
    n2 = 9.81 / r[:-1] * grad
    mid = (z[1:] + z[:-1]) / 2
    return {
        "Ws": g * volume / a.max() * mean * (z_g - z_v),
        "M1": m1,
        "M2": m2,
        "eta": m1 / (s_rho * s_z) if s_rho * s_z > 1e-9 else None,
        "m_ratio": m2 / m1 if abs(m1) > 1e-9 else None,
        "z_therm": direct_thermocline(t, r, grad, z),
        "z_n2": (n2 * mid).sum() / n2.sum() if abs(n2.sum()) > 1e-12 else None,
        "n2_max": n2.max(),
        "b_var": (w * (9.81 * (r - mean) / mean) ** 2).sum(),
    }


def direct_thermocline(t, r, grad, z):
    if t.max() - t.min() < 1:
        return None

    def depth(i):
        if 0 < i < len(grad) - 1 and grad[i + 1] != grad[i] and grad[i] != grad[i - 1]:
            down = -(z[i + 1] - z[i]) / (grad[i + 1] - grad[i])
            up = (z[i] - z[i - 1]) / (grad[i] - grad[i - 1])
            return z[i + 1] * down / (down + up) + z[i] * up / (down + up)
        return (z[i] + z[i + 1]) / 2

    top = int(np.argmax(grad))
    cut = max(0.15 * grad[top], 0.1)
    peaks = [
        i
        for i in range(1, len(grad) - 1)
        if grad[i] > grad[i - 1] and grad[i] >= grad[i + 1] and grad[i] > cut
    ]
    if peaks and peaks[-1] > top + 1:
        return max(depth(peaks[-1]), depth(top))
    return depth(top)


def test_density_by_hand(spark):
    row = spark.range(1).select(water_density(F.lit(4.0)), water_density(F.lit(20.0))).first()
    assert row[0] == pytest.approx(999.9999985, abs=1e-7)
    assert row[1] == pytest.approx(998.2336361, abs=1e-7)


def two_steps(z):
    return 22 - 6 / (1 + math.exp(-(z - 1.5) * 8)) - 7 / (1 + math.exp(-(z - 4.3) * 6))


SHAPES = {
    "linear": [(z, 20 - 2 * z) for z in np.arange(0, 6.5, 0.5)],
    "two thermoclines": [(z, two_steps(z)) for z in np.arange(0, 6.5, 0.5)],
    "off the grid, starts below the surface": [(0.33, 19.0), (1.07, 18.2), (2.9, 9.4), (5.51, 7.0)],
    "several points in one grid cell": [(0.0, 18.0), (1.01, 17.0), (1.03, 15.0), (1.06, 14.5), (1.09, 12.0), (4, 8.0)],
    "deeper than the lake": [(0.0, 21.0), (2.0, 15.0), (5.0, 9.0), (8.3, 5.0)],
    "warm below": [(0.0, 1.0), (3.0, 2.5), (6.0, 4.0)],
    "one point": [(1.0, 12.0)],
}


@pytest.mark.parametrize("shape", list(SHAPES))
def test_metrics_equal_direct_arithmetic(spark, shape):
    points = SHAPES[shape]
    row = profile_metrics(profile_rows(spark, [points]), LAKE).first()
    for name, value in direct_metrics(points, LAKE).items():
        if value is None:
            assert row[name] is None, name
        else:
            assert row[name] == pytest.approx(value, rel=1e-7, abs=1e-9), name


def test_uniform_profile_has_no_structure(spark):
    row = profile_metrics(profile_rows(spark, [[(z, 12.0) for z in range(7)]]), LAKE).first()
    assert row["Ws"] == pytest.approx(0, abs=1e-9)
    assert row["n2_max"] == 0 and row["M1"] == pytest.approx(0, abs=1e-12)
    assert row["eta"] is None and row["m_ratio"] is None
    assert row["z_therm"] is None and row["z_n2"] is None


def test_resampling_is_linear_with_flat_ends(spark):
    rows = resample_profiles(
        gather_profiles(profile_rows(spark, [[(1.0, 10.0), (2.0, 20.0)]])), LAKE
    ).orderBy("i")
    t = [r["temperature"] for r in rows.collect()]
    assert len(t) == 61
    assert t[:11] == [10.0] * 11 and t[20:] == [20.0] * 41
    assert t[15] == pytest.approx(15.0)


def test_integral_over_depth_is_larger_by_the_bottom_slice(spark):
    grid = resample_profiles(gather_profiles(profile_rows(spark, [[(0.0, 8.0), (6.0, 8.0)]])), LAKE)
    area = profile_integrals(grid).first()
    depth = profile_integrals(grid, integral="depth").first()
    assert depth["volume"] - area["volume"] == pytest.approx(6 * LAKE[-1][1])
    with pytest.raises(ValueError):
        profile_integrals(grid, integral="other")


def test_areas_follow_the_hypsography():
    areas = grid_areas(LAKE, 0.1)
    assert len(areas) == 61
    assert areas[0] == LAKE[0][1] and areas[-1] == LAKE[-1][1]
    assert areas[5] == pytest.approx(LAKE[1][1])


def test_layer_depth_without_neighbours_is_the_middle(spark):
    none = F.lit(None).cast("double")
    row = spark.range(1).select(layer_depth(none, F.lit(1.0), F.lit(0.5), F.lit(0), 0.1)).first()
    assert row[0] == pytest.approx(0.05)


def test_copies_and_repeated_depths_are_averaged(spark):
    points = [(0.0, 10.0), (0.0, 10.0), (0.0, 13.0), (6.0, 5.0)]
    rows = profile_rows(spark, [points, [(3.0, 4.0)]])
    held = {
        r["parameter"]: [tuple(p) for p in r["points"]]
        for r in gather_profiles(rows).collect()
    }
    assert held == {"0": [(0.0, 11.0), (6.0, 5.0)], "1": [(3.0, 4.0)]}


def test_a_profile_of_many_depths_is_gathered_like_any(spark):
    points = [(k / 10, 20.0 - k / 20) for k in range(100)]
    held = gather_profiles(profile_rows(spark, [points])).first()["points"]
    assert [tuple(p) for p in held] == points


def test_grid_rows_are_not_gathered(spark):
    fc = profile_rows(spark, [[(0.0, 10.0), (6.0, 5.0)]])
    text = profile_metrics(fc, LAKE)._jdf.queryExecution().executedPlan().toString()
    # Objects are gathered per profile twice: its points, and its few peaks after the sums over the grid.
    lines = text.splitlines()
    peaks = next(i for i, x in enumerate(lines) if "ObjectHashAggregate" in x and "collect_list" in x and "peak" in x)
    assert any("HashAggregate" in x and "ObjectHash" not in x and "peak" in x for x in lines[peaks + 1 :])


def test_no_temperature_gives_no_profiles(spark):
    fc = profile_rows(spark, [[(0.0, 1.0)]]).where("variable = 'oxygen'")
    assert gather_profiles(fc).count() == 0
    assert profile_metrics(fc, LAKE).count() == 0


def test_mixing_probability(spark):
    mixed, layered = [(0.5, 10.0), (5.0, 10.0)], [(0.5, 20.0), (5.0, 8.0)]
    fc = profile_rows(spark, [mixed, layered, layered, layered])
    assert mixing_probability(fc).first()["prediction"] == 0.25
    lacking = profile_rows(spark, [mixed, layered, [(0.5, 9.0)]])
    assert mixing_probability(lacking).first()["prediction"] is None


def test_derived_rows_have_the_archive_layout_and_a_rerun_adds_nothing(spark):
    fc = profile_rows(spark, [[(z, 20 - 2 * z) for z in np.arange(0, 6.5, 0.5)]] * 3)
    assert mixing_rows(fc).columns == fc.columns
    assert metric_rows(fc, LAKE).count() == 3 * len(METRICS)
    once = with_diagnostics(fc, LAKE)
    assert once.count() == fc.count() + 1 + 3 * len(METRICS)
    twice = with_diagnostics(once, LAKE)
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))


def test_caller_supplied_metric(spark):
    fc = profile_rows(spark, [SHAPES["linear"], [(0.0, 5.0), (6.0, 5.0)]])

    def spread(pdf):
        first = pdf.iloc[:1]
        return first[["parameter"]].assign(spread=pdf.temperature.max() - pdf.temperature.min())

    got = {r["parameter"]: r["spread"] for r in per_profile(fc, spread, "parameter string, spread double").collect()}
    assert got == {"0": pytest.approx(12.0), "1": 0.0}


def test_a_caller_function_may_take_the_key_and_give_a_row(spark):
    members = [SHAPES["linear"], [(0.0, 5.0), (6.0, 5.0)], [(k / 10, 20.0 - k / 20) for k in range(100)]] * 3
    big = 2**60 + 1
    fc = (
        profile_rows(spark, members)
        .withColumn("run", F.when(F.col("parameter") != "1", F.col("parameter").cast("long") + big))
        .withColumn("odd", F.when(F.col("parameter") != "2", F.col("parameter").cast("int") % 2 == 1))
    )
    keys = ["datetime", "parameter", "run", "odd"]
    schema = "datetime timestamp, parameter string, run long, odd boolean, depths long, spread double"

    def row(key, profile):
        assert list(profile.index) == list(range(len(profile))) and list(profile.columns) == [*keys, "depth", "temperature"]
        values = tuple(None if v is None or v != v else v for v in key)
        return *values, len(profile), profile.temperature.max() - profile.temperature.min()

    def frame(profile):
        profile["spread"] = profile.temperature.max() - profile.temperature.min()
        return profile[[*keys, "spread"]][:1].assign(depths=len(profile))

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    spark.conf.set(size, 7)
    try:
        got = [per_profile(fc, f, schema, keys) for f in (row, frame)]
        assert all("FlatMapGroupsInPandas" not in plan(df) for df in got)
        rows, frames = [sorted(map(tuple, df.collect()), key=str) for df in got]
    finally:
        spark.conf.set(size, before)
    want = [
        (T0, str(n), None if n == 1 else n + big, None if n == 2 else n % 2 == 1, len(p))
        for n, p in enumerate(members)
    ]
    assert [r[:5] for r in rows] == sorted(want, key=str)
    assert rows == frames
    with pytest.raises(Exception, match="columns"):
        per_profile(fc, lambda profile: profile[["depth"]], schema, keys).collect()


def test_tasks_hold_few_profiles_however_many_there_are(spark):
    """Peak memory of a task follows its profiles, not the bytes shuffled to it."""
    n = F.col("id")
    fc = spark.range(60_000).select(
        F.lit("m").alias("model_id"),
        F.sha2(n.cast("string"), 256).alias("parameter"),
        F.lit("temperature").alias("variable"),
        F.lit(1.0).alias("depth"),
        (n % 20).cast("double").alias("prediction"),
    )
    parts = gather_profiles(fc).rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sum(parts) == 60_000
    assert len(parts) > 16 and max(parts) < 6_000
