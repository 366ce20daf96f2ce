import math
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from limnocast.functions.keys import day_of_year
from limnocast.functions.solar import cos_zenith, eastern_longitude, equation_of_time, potential_radiation
from limnocast.operators.grids import nearest_cell, nearest_issues, replicate_members
from limnocast.operators.joins import keep_latest
from limnocast.operators.series import (
    FILLS,
    densify,
    fill_down_up,
    first_gap,
    hourly_grid,
    hourly_spans,
    median_step,
    missing_dates,
    missing_hours,
)
from limnocast.plans.drivers import (
    flux_coverage,
    forecast_drivers,
    history_drivers,
    member_rows,
    normalise_history,
    repair_fluxes,
    to_hourly,
    update_history,
)
from limnocast.schemas import LONGWAVE, PRECIPITATION, SHORTWAVE, VARIABLE_NAMES

T0 = datetime(2024, 1, 20)
MET = "site_id string, family string, parameter double, datetime timestamp, variable string, prediction double"


def at(hours):
    return T0 + timedelta(hours=hours)


def met(spark, series, site="S"):
    """Rows from {(parameter, variable): {hour: value}}."""
    rows = [
        (site, "ensemble", float(p), at(h), v, None if x is None else float(x))
        for (p, v), samples in series.items()
        for h, x in samples.items()
    ]
    return spark.createDataFrame(rows, MET)


def series_of(df, parameter, variable):
    rows = df.where((F.col("parameter") == float(parameter)) & (F.col("variable") == variable)).collect()
    pairs = sorted((round((r["datetime"] - T0).total_seconds() / 3600, 6), r["prediction"]) for r in rows)
    assert len({h for h, _ in pairs}) == len(pairs)
    return dict(pairs)


def test_linear_fill_is_flat_beyond_the_samples_and_keeps_them(spark):
    m = met(
        spark,
        {
            (0, "air_pressure"): {0: None, 2: 10, 6: 18, 8: None},
            (1, "air_pressure"): {1: 5, 4: 8},
        },
    )
    dense = densify(m)
    assert series_of(dense, 0, "air_pressure") == {
        0: 10, 1: 10, 2: 10, 3: 12, 4: 14, 5: 16, 6: 18, 7: 18, 8: 18,
    }
    assert series_of(dense, 1, "air_pressure") == {0: 5, 1: 5, 2: 6, 3: 7, 4: 8}


def test_backfill_leaves_the_end_open(spark):
    dense = densify(met(spark, {(0, PRECIPITATION): {0: 1, 3: 4, 5: None}}))
    assert series_of(dense, 0, PRECIPITATION) == {0: 1, 1: 4, 2: 4, 3: 4, 4: None, 5: None}


def test_grid_holds_every_variable_of_the_site_for_every_member(spark):
    m = met(spark, {(0, "air_pressure"): {0: 1, 3: 2}, (1, PRECIPITATION): {2: 1}})
    dense = densify(m)
    assert series_of(dense, 1, "air_pressure") == {0: None, 1: None, 2: None}
    assert series_of(dense, 0, PRECIPITATION) == {h: None for h in range(4)}
    assert series_of(dense, 1, PRECIPITATION) == {0: 1, 1: 1, 2: 1}
    spans = {(r["parameter"], r["variable"]): r["n_hours"] for r in hourly_spans(m).collect()}
    assert spans == {
        (0.0, "air_pressure"): 4,
        (0.0, PRECIPITATION): 4,
        (1.0, "air_pressure"): 3,
        (1.0, PRECIPITATION): 3,
    }
    assert hourly_grid(m).count() == 14


def test_samples_off_the_lattice_are_left_out(spark):
    dense = densify(met(spark, {(0, "air_pressure"): {0.5: 1, 1: 100, 2.5: 3}}))
    assert series_of(dense, 0, "air_pressure") == {0.5: 1, 1.5: 2, 2.5: 3}


def test_long_series_across_blocks_equals_numpy(spark):
    """Gaps longer than a block, blocks without samples, and copies."""
    rng = random.Random(2)
    known = {0: 1.0}
    hour = 0
    while hour < 6000:
        hour += rng.choice([1, 3, 6, 700, 1500])
        known[hour] = rng.uniform(-5, 5)
    m = met(spark, {(0, "eastward_wind"): known})
    got = series_of(densify(m.unionByName(m)), 0, "eastward_wind")
    hours = np.arange(max(known) + 1)
    want = np.interp(hours, sorted(known), [known[h] for h in sorted(known)])
    assert list(got) == list(hours)
    assert np.allclose(list(got.values()), want)


def test_crowded_copies_are_collapsed_first(spark):
    m = met(spark, {(0, "air_pressure"): {0: 1.0, 2: 3.0}})
    copies = m.crossJoin(spark.range(800)).drop("id")
    assert series_of(densify(copies), 0, "air_pressure") == {0: 1, 1: 2, 2: 3}


def test_scopes_are_gridded_apart(spark):
    one = met(spark, {(0, "air_pressure"): {0: 1, 2: 3}}).withColumn("run", F.lit("a"))
    two = met(spark, {(0, "air_pressure"): {10: 1, 12: 3}}).withColumn("run", F.lit("b"))
    dense = densify(one.unionByName(two), scope=("run", "site_id"))
    assert {(r["run"], r["n"]) for r in dense.groupBy("run").agg(F.count("*").alias("n")).collect()} == {
        ("a", 3),
        ("b", 3),
    }


def test_unknown_fill_is_refused(spark):
    with pytest.raises(ValueError):
        densify(met(spark, {(0, "air_pressure"): {0: 1}}), {"air_pressure": "cubic"})


def test_fill_down_up_over_blocks(spark):
    samples = {0: None, 5: 1, 900: None, 2000: None, 2500: 7, 4000: None}
    filled = fill_down_up(met(spark, {(0, "x"): samples, (1, "x"): {0: None, 9: None}}))
    assert series_of(filled, 0, "x") == {0: 1, 5: 1, 900: 1, 2000: 1, 2500: 7, 4000: 7}
    assert series_of(filled, 1, "x") == {0: None, 9: None}


def test_median_step_and_first_gap(spark):
    m = met(spark, {(0, "x"): {0: 1, 6: 1, 12: 1, 2000: 1}, (1, "x"): {0: 1}})
    steps = {r["parameter"]: r["step_hours"] for r in median_step(m).collect()}
    assert steps == {0.0: 6.0, 1.0: None}
    gap = first_gap(m).first()
    assert gap["gap_hours"] == 6.0 and gap["needs_hourly"] is True
    assert first_gap(met(spark, {(0, "x"): {0: 1}})).first()["needs_hourly"] is False


def py_cosz(t, lon, lat, step):
    """Zenith cosine by scalar arithmetic."""
    doy = t.timetuple().tm_yday + t.hour / 24
    f = math.radians(279.5 + 0.9856 * doy)
    et = (
        -104.7 * math.sin(f) + 596.2 * math.sin(2 * f) + 4.3 * math.sin(4 * f)
        - 429.3 * math.cos(f) - 2 * math.cos(2 * f) + 19.3 * math.cos(3 * f)
    ) / 3600
    meridian = math.floor(lon / 15) * 15
    meridian += 15 if meridian < 0 else 0
    noon = 12 - (lon - meridian) * 4 / 60 - et - meridian / 15 - step / 2
    hour = math.pi / 12 * (t.hour - noon)
    tilt = math.radians(-23.45) * math.cos(2 * math.pi * (doy + 10) / 365)
    phi = math.radians(lat)
    return max(0.0, math.sin(phi) * math.sin(tilt) + math.cos(phi) * math.cos(tilt) * math.cos(hour))


@pytest.mark.parametrize("lon,lat,step", [(9.6, 56.3, 0), (-79.8, 37.3, 1), (170.0, -41.0, 0)])
def test_zenith_against_scalar_arithmetic(spark, lon, lat, step):
    times = [datetime(2024, m, 5, h) for m in (1, 6, 12) for h in (0, 8, 13, 20)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp")
    doy = day_of_year(F.col("t"))
    for r in df.select("t", cos_zenith(doy, lon, lat, step).alias("c")).collect():
        assert r["c"] == pytest.approx(py_cosz(r["t"], lon, lat, step), abs=1e-9)


def test_radiation_and_equation_of_time_are_in_range(spark):
    df = spark.range(1, 367).select(F.col("id").cast("double").alias("d"))
    row = df.agg(
        F.max(F.abs(equation_of_time(F.col("d")))), F.min(potential_radiation(F.col("d") + 0.5, 0.0, 50.0))
    ).first()
    assert row[0] < 0.3 and row[1] > 0
    assert eastern_longitude(-10.0) == 350.0 and eastern_longitude(10.0) == 10.0


def full_met(spark, hours, step, value=lambda v, h: 10.0 + h % 7):
    return met(
        spark,
        {(p, v): {h: value(v, h) for h in range(0, hours + 1, step)} for p in (0, 1) for v in FILLS},
    )


def test_to_hourly_keeps_daily_shortwave_means_and_shifts_temperature_once(spark):
    m = full_met(spark, 71, 1)
    hourly = to_hourly(m, 9.6, 56.3)
    assert hourly.count() == m.count()
    assert series_of(hourly, 0, "air_temperature")[3] == 13.0 + 273.0
    assert series_of(hourly, 0, "relative_humidity")[3] == 13.0
    before, after = series_of(m, 1, SHORTWAVE), series_of(hourly, 1, SHORTWAVE)
    for day in range(3):
        hours = range(24 * day, 24 * day + 24)
        assert np.mean([after[h] for h in hours]) == pytest.approx(np.mean([before[h] for h in hours]))
    assert after[0] == 0.0


def test_coverage_and_repair(spark):
    series = {
        (0, "air_temperature"): {0: 280.0, 6: 285.0},
        (0, PRECIPITATION): {0: None, 6: 2.0},
        (0, LONGWAVE): {0: None, 6: None, 12: None},
        (0, SHORTWAVE): {0: 5.0, 6: None, 12: None},
    }
    m = met(spark, series)
    cover = {r["variable"]: (r["known"], r["missing"], r["empty"]) for r in flux_coverage(m).collect()}
    assert cover == {PRECIPITATION: (1, False, False), LONGWAVE: (0, False, True), SHORTWAVE: (1, False, False)}
    fixed = repair_fluxes(m, 9.6, 56.3)
    assert series_of(fixed, 0, PRECIPITATION) == {0: 0.0, 6: 2.0}
    longwave = series_of(fixed, 0, LONGWAVE)
    assert longwave[0] == pytest.approx(0.97 * 5.67e-8 * 280.0**4)
    assert longwave[12] == longwave[6] == pytest.approx(0.97 * 5.67e-8 * 285.0**4)
    shortwave = series_of(fixed, 0, SHORTWAVE)
    assert shortwave[0] == 5.0
    assert shortwave[12] == pytest.approx(0.5 * 1366 * py_cosz(at(12), 9.6, 56.3, 0), abs=1e-6)


def test_sound_history_is_left_alone_and_coarse_history_made_hourly(spark):
    sound = full_met(spark, 30, 1)
    assert normalise_history(sound, 9.6, 56.3) is sound
    coarse = full_met(spark, 30, 3)
    assert normalise_history(coarse, 9.6, 56.3).count() == 2 * len(FILLS) * 31
    hollow = full_met(spark, 30, 1, lambda v, h: None if v == LONGWAVE else 280.0)
    assert normalise_history(hollow, 9.6, 56.3).where("prediction is null").count() == 0


def cells(spark, kind):
    names = list(VARIABLE_NAMES)
    points = [(lat, lon) for lat in (50.0, 50.5) for lon in (9.0, 9.5)]
    value = lambda lat, h, v: lat + h + len(v)
    if kind == "analysis":
        rows = [(at(h), lat, lon, *[value(lat, h, v) for v in names]) for lat, lon in points for h in range(0, 120, 3)]
        head = "time timestamp, latitude double, longitude double"
    else:
        rows = [
            (at(i), m, lat, lon, at(i + h), *[value(lat, h, v) + m for v in names])
            for lat, lon in points
            for i in (0, 48)
            for m in (0, 1)
            for h in range(0, 30, 6)
        ]
        head = "init_time timestamp, ensemble_member int, latitude double, longitude double, valid_time timestamp"
    return spark.createDataFrame(rows, head + "".join(f", {v} double" for v in names))


def test_nearest_takes_the_larger_of_two_equal_distances(spark):
    grid = cells(spark, "analysis")
    row = nearest_cell(grid, 9.1, 50.25).select("latitude", "longitude").distinct().collect()
    assert [tuple(r) for r in row] == [(50.5, 9.0)]


def test_each_date_gets_the_nearest_issue(spark):
    grid = cells(spark, "forecast")
    got = {
        str(r["reference_datetime"]): r["init_time"]
        for r in nearest_issues(grid, "2024-01-18", "2024-01-24").collect()
    }
    early, late = at(0), at(48)
    assert got == {
        "2024-01-18": early,
        "2024-01-19": early,
        "2024-01-20": early,
        "2024-01-21": late,  # halfway: the later issue
        "2024-01-22": late,
        "2024-01-23": late,
        "2024-01-24": late,
    }


def test_forecast_drivers(spark):
    rows = forecast_drivers(cells(spark, "forecast"), "S", 9.1, 50.1, "2024-01-20", "2024-01-22")
    assert rows.count() == 3 * 2 * len(FILLS) * 25
    one = rows.where("reference_datetime = '2024-01-22' and variable = 'air_pressure' and parameter = 1")
    values = [r["prediction"] for r in one.orderBy("datetime").collect()]
    assert values == pytest.approx([50 + h + len("pressure_surface") + 1 for h in range(25)])


def test_history_runs_to_the_end_of_the_last_day_and_is_equal_for_members(spark):
    rows = history_drivers(cells(spark, "analysis"), "S", 9.1, 50.1, "2024-01-20", "2024-01-21", 3)
    pressure = rows.where("variable = 'air_pressure'")
    assert pressure.count() == 3 * 48
    assert series_of(rows, 2, "air_pressure") == series_of(rows, 0, "air_pressure")
    assert series_of(rows, 0, "air_pressure")[47] == pytest.approx(50 + 47 + len("pressure_surface"))


def test_update_fills_only_what_is_missing_and_a_rerun_changes_nothing(spark):
    grid = cells(spark, "analysis")
    args = (grid, "S", 9.1, 50.1, "2024-01-20", "2024-01-22", 2)
    stored = history_drivers(grid, "S", 9.1, 50.1, "2024-01-20", "2024-01-20", 2).withColumn(
        "prediction", F.lit(-1.0)
    )
    updated = update_history(stored, *args)
    assert updated.count() == 2 * len(FILLS) * 72
    assert updated.where("prediction = -1").count() == 2 * len(FILLS) * 24
    assert update_history(updated, *args) is updated


def test_incoming_wins_even_when_null(spark):
    old = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("b", 2.0)], "k string, v double")
    new = spark.createDataFrame([("b", None), ("c", 3.0)], "k string, v double")
    got = {r["k"]: r["v"] for r in keep_latest(old, new, ["k"]).collect()}
    assert got == {"a": 1.0, "b": None, "c": 3.0}
    wide = [d.withColumn("w", F.col("v") * 2) for d in (old, new)]
    got = {r["k"]: (r["v"], r["w"]) for r in keep_latest(*wide, ["k"]).collect()}
    assert got == {"a": (1.0, 2.0), "b": (None, None), "c": (3.0, 6.0)}


def test_missing_hours_and_dates(spark):
    held = met(spark, {(0, "x"): {h: 1 for h in range(24) if h != 7}})
    lacking = [r["datetime"] for r in missing_hours(held, "2024-01-20", "2024-01-20").collect()]
    assert lacking == [at(7)]
    dates = missing_dates(held, "datetime", "2024-01-19", "2024-01-21").collect()
    assert sorted(str(r["datetime"]) for r in dates) == ["2024-01-19", "2024-01-21"]


def test_replicated_members(spark):
    df = spark.createDataFrame([(1.0, 9.0)], "v double, parameter double")
    assert sorted(r["parameter"] for r in replicate_members(df, 3).collect()) == [0.0, 1.0, 2.0]


def test_member_rows_drop_duplicates_and_nulls(spark):
    wide = spark.createDataFrame(
        [(at(0), 1.0, 2.0, "1"), (at(0), 1.0, 2.0, "1"), (at(1), None, 3.0, "1")],
        "time timestamp, AirTemp double, WindSpeed double, parameter string",
    )
    rows = member_rows(wide, "m", "S", "2024-01-20 00:00:00", "2024-01-20 13:00:00").collect()
    assert sorted((r["variable"], r["prediction"]) for r in rows) == [
        ("air_temperature", 1.0),
        ("wind_speed", 2.0),
        ("wind_speed", 3.0),
    ]
    assert rows[0]["reference_date"] == "2024-01-20" and rows[0]["variable_type"] == "driver"
