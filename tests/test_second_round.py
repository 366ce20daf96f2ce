"""Sizes, copies, null keys, several sites, files by name, and what jobs read."""

import random
from datetime import date, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from limnocast.operators.ranking import ranked_values
from limnocast.operators.series import FILLS, densify, fill_down_up, median_step
from limnocast.operators.scoring import score_forecasts, single_observation
from limnocast.plans.dashboard import dashboard_tables, labelled, latest_temperature, zone_name
from limnocast.plans.diagnostics import add_diagnostics
from limnocast.plans.drivers import (
    normalise_history,
    normalise_history_archive,
    update_forecast_archive,
    update_history,
    update_history_archive,
)
from limnocast.plans.scorekeeping import touched_partitions, update_scores
from limnocast.schemas import LONGWAVE, SCORE_SCHEMA, STAGE2_SCHEMA
from limnocast.sources.readers import (
    read_forecasts,
    read_member_files,
    read_met,
    read_or_empty,
    read_raw_observations,
    read_targets,
)
from limnocast.sources.writers import write_forecasts, write_scores, write_stage3, write_targets
from tests.test_archive import archive_rows, as_set, day, targets_rows
from tests.test_drivers import T0, at, cells, full_met, met, series_of
from tests.test_scoring import forecast, observations


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- gap filling ----


@pytest.mark.parametrize("kind,middle", [("air_pressure", [10 + 20 * i / 6 for i in range(7)]), (LONGWAVE, [10.0] + [30.0] * 6)])
@pytest.mark.parametrize("more", [0, 800])
@pytest.mark.parametrize("start", [0, 717])
def test_fills_do_not_depend_on_how_many_copies_there_are(spark, kind, middle, more, start):
    """Differing copies, also where the next sample lies beyond a border of blocks."""
    rows = met(spark, {(0, kind): {start: 10.0, start + 6: 20.0}}).union(met(spark, {(0, kind): {start + 6: 30.0}}))
    first = met(spark, {(0, kind): {start: 10.0}})
    copies = rows.union(first.crossJoin(spark.range(more)).drop("id")) if more else rows
    assert series_of(densify(copies), 0, kind) == pytest.approx({start + i: x for i, x in enumerate(middle)})


def test_a_series_with_a_null_key_is_filled_like_any(spark):
    rows = met(spark, {(0, "air_pressure"): {0: 1.0, 2: 3.0, 800: 3.0}}).withColumn("family", F.lit(None).cast("string"))
    got = series_of(densify(rows), 0, "air_pressure")
    assert got[1] == 2 and got[500] == 3 and len(got) == 801
    holes = met(spark, {(0, "x"): {0: None, 1: 4.0, 900: None}}).withColumn("family", F.lit(None).cast("string"))
    assert series_of(fill_down_up(holes), 0, "x") == {0: 4.0, 1: 4.0, 900: 4.0}
    assert median_step(rows).first()["step_hours"] == 400


# ---- history ----


def two_sites(spark):
    hollow = full_met(spark, 30, 1, lambda v, h: None if v == LONGWAVE else 280.0).withColumn("site_id", F.lit("A"))
    return hollow, full_met(spark, 30, 1).withColumn("site_id", F.lit("B"))


def test_each_site_is_tested_and_repaired_by_itself(spark):
    hollow, sound = two_sites(spark)
    coarse = full_met(spark, 30, 3).withColumn("site_id", F.lit("C"))
    out = normalise_history(hollow.union(sound).union(coarse), 9.6, 56.3)
    assert out.where("prediction is null").count() == 0
    assert as_set(out.where("site_id = 'B'")) == as_set(sound)
    assert out.where("site_id = 'C'").count() == 2 * len(FILLS) * 31


def test_history_is_normalised_in_place(spark, tmp_path):
    hollow, sound = two_sites(spark)
    path = str(tmp_path / "s3")
    write_stage3(hollow.union(sound), path)
    normalise_history_archive(spark, path, "A", 9.6, 56.3)
    after = read_met(spark, path)
    assert after.where("prediction is null").count() == 0 and after.count() == hollow.count() * 2
    assert as_set(after.where("site_id = 'B'")) == as_set(sound)
    normalise_history_archive(spark, path, "none", 9.6, 56.3)
    assert as_set(read_met(spark, path)) == as_set(after)


def test_updated_history_is_sorted_and_moves_only_lacking_days(spark, tmp_path):
    path, grid = str(tmp_path / "s3"), cells(spark, "analysis")
    update_history_archive(spark, path, grid, "S", 9.1, 50.1, "2024-01-20", "2024-01-21", 2)
    update_history_archive(spark, path, grid, "S", 9.1, 50.1, "2024-01-20", "2024-01-22", 2)
    for file in (tmp_path / "s3/site_id=S").rglob("*.parquet"):
        rows = [tuple(r) for r in spark.read.parquet(str(file)).select("datetime", "family", "parameter", "variable").collect()]
        assert rows == sorted(rows)
    # Outside the lacking days rows pass through, copies and other sites included.
    stored = read_met(spark, path).where(F.col("datetime") < at(48))
    stored = stored.union(stored.limit(5)).union(met(spark, {(0, "x"): {60: 1.0}}, "other"))
    out = update_history(stored, grid, "S", 9.1, 50.1, "2024-01-20", "2024-01-22", 2)
    assert out.count() == 2 * len(FILLS) * 72 + 6


def test_forecast_archive_gains_lacking_dates_only(spark, tmp_path):
    path, grid = str(tmp_path / "s2"), cells(spark, "forecast")
    args = (grid, "S", 9.1, 50.1)
    assert update_forecast_archive(spark, path, *args, "2024-01-20", "2024-01-21") == ["2024-01-20", "2024-01-21"]
    files = {f: f.stat().st_mtime_ns for f in (tmp_path / "s2").rglob("*.parquet")}
    assert update_forecast_archive(spark, path, *args, "2024-01-19", "2024-01-22") == ["2024-01-19", "2024-01-22"]
    assert all(f.stat().st_mtime_ns == t for f, t in files.items())
    assert update_forecast_archive(spark, path, *args, "2024-01-19", "2024-01-22") == []
    stored = read_or_empty(spark, path, STAGE2_SCHEMA)
    assert {r[0] for r in stored.select("reference_datetime").distinct().collect()} == {date(2024, 1, d) for d in (19, 20, 21, 22)}
    assert stored.count() == 4 * 2 * len(FILLS) * 25


# ---- scores ----


@pytest.mark.parametrize("shape", ["log-normal", "outliers"])
def test_hot_groups_are_cut_by_rank(spark, shape):
    rng = np.random.default_rng(1)
    x = rng.lognormal(0, 6, 60_000) if shape == "log-normal" else np.r_[rng.normal(size=59_998), 1e6, 1e12]
    df = spark.createDataFrame([("g", float(v)) for v in x], "k string, x double")
    dealt = df.groupBy("k", "x").count().repartitionByRange(512, "k", "x").groupBy(F.spark_partition_id().alias("p")).count()
    assert dealt.agg(F.max("count")).first()[0] < 0.01 * len(x)
    ranked = ranked_values(df, ["k"], "x")
    last = ranked.agg(F.max("upto"), F.max("members"), F.sum("copies"), F.count_distinct("upto")).first()
    assert tuple(last) == (60_000, 60_000, 60_000, len(set(x.tolist())))


def test_scores_of_a_skewed_hot_group_equal_the_row_route(spark):
    rng = random.Random(3)
    fc = forecast(spark, {("a", 1, "temperature", 0.5): [rng.lognormvariate(0, 6) for _ in range(400)]})
    obs = observations(spark, {(1, "temperature", 0.5): 2.0})
    one, other = (score_forecasts(fc, obs, hot_rows=n).first().asDict() for n in (10**6, 10))
    assert {k: v for k, v in one.items() if isinstance(v, float)} == pytest.approx({k: v for k, v in other.items() if isinstance(v, float)})


@pytest.mark.parametrize("hot_rows", [10**6, 1])
def test_groups_of_the_targets_each_get_their_score(spark, hot_rows):
    fc = forecast(spark, {("a", 1, "temperature", None): [1.0, 2.0, 4.0]})
    obs = observations(spark, {(1, "temperature", None): 2.0})
    both = obs.withColumn("project_id", F.lit("p")).union(obs.withColumns({"observation": F.lit(3.0), "project_id": F.lit("q")}))
    rows = {r["project_id"]: (r["observation"], r["crps"]) for r in score_forecasts(fc, both, hot_rows=hot_rows).collect()}
    assert {k: v[0] for k, v in rows.items()} == {"p": 2.0, "q": 3.0} and rows["p"][1] != rows["q"][1]
    # A column of both sides must agree, and another can be asked for.
    named = fc.withColumn("project_id", F.lit("q"))
    assert [r["observation"] for r in score_forecasts(named, both, hot_rows=hot_rows).collect()] == [3.0]
    asked = score_forecasts(fc, both.withColumnRenamed("project_id", "lab"), hot_rows=hot_rows, extra_groups=["lab"])
    assert {r["lab"] for r in asked.collect()} == {"p", "q"}


def test_single_observation(spark):
    rows = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 1.0), ("b", 2.0)], "model_id string, observation double")
    assert sorted(map(tuple, single_observation(rows).collect())) == [("a", 1.0, True), ("b", 1.0, False)]


def test_an_update_keeps_stored_rows_without_an_observation_and_reads_only_what_it_touches(spark, tmp_path):
    fc, obs, scores = (str(tmp_path / n) for n in ("fc", "obs", "scores"))
    write_forecasts(archive_rows(spark, models=("m1", "m2")), fc)
    write_targets(targets_rows(spark), obs)
    bare = spark.createDataFrame([("S", "temperature", m, 0.5) for m in ("m1", "m2", "m9")], "site_id string, variable string, model_id string, depth double")
    from limnocast.schemas import conform

    write_scores(conform(bare, SCORE_SCHEMA), scores)
    update_scores(spark, fc, obs, scores)
    after = read_or_empty(spark, scores, SCORE_SCHEMA)
    assert after.where("observation is null").count() == 3 and after.count() == 3 + 16
    touched = touched_partitions(after, after.where("model_id = 'm1'"))
    assert touched.count() == 9
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        filters = next(x for x in plan(touched).splitlines() if "FileScan" in x and "DataFilters" in x)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "model_id" in filters.split("PartitionFilters")[1] and "m1" in filters.split("PartitionFilters")[1]
    assert touched_partitions(after, after.limit(0)).count() == 0


# ---- the view ----


def test_latest_issue_reads_one_date(spark, tmp_path):
    write_forecasts(archive_rows(spark), str(tmp_path / "fc"))
    latest = latest_temperature(read_forecasts(spark, str(tmp_path / "fc")), ["m1", "m2"])
    assert {r["reference_datetime"] for r in latest.collect()} == {day(2)}
    scans = [x for x in plan(latest).splitlines() if "PartitionFilters" in x and "prediction" in x]
    assert scans and all("reference_date" in x.split("PartitionFilters")[1].split("PushedFilters")[0] for x in scans)


def test_all_tables_are_in_local_time_across_a_change_of_clocks(spark):
    rows = archive_rows(spark, issues=(1,), models=("m1",)).withColumns(
        {
            "reference_datetime": F.lit(datetime(2024, 3, 30, 12)),
            "datetime": F.when(F.hour("datetime") == 0, F.lit(datetime(2024, 3, 30, 23))).otherwise(F.lit(datetime(2024, 3, 31, 23))),
        }
    )
    mixing = rows.limit(1).withColumns({"variable": F.lit("prob_mixed_density"), "depth": F.lit(None).cast("double")})
    seen = targets_rows(spark).where("observation is not null").withColumn("datetime", F.lit(datetime(2024, 3, 31, 23)))
    tables = dashboard_tables(rows.union(mixing), ["m1"], {}, "Europe/Paris", targets=seen)
    local = {datetime(2024, 3, 31, 0), datetime(2024, 4, 1, 1)}
    assert {r["datetime"] for r in tables["temperature"].collect()} == local
    assert {r["datetime"] for r in tables["mixing"].collect()} <= local
    assert tables["kpi_horizon"].first()["issued"] == "Mar 30, 2024 13:00 CET"
    assert tables["last_observed"].first()[0] == datetime(2024, 4, 1, 1)
    assert {r["depth_order"] for r in tables["observations"].collect()} == {1, 2}
    marks = {r["mark"] for r in labelled(rows, {}, "Europe/Paris").transform(lambda d: d.selectExpr("date(datetime) as mark")).collect()}
    assert marks == {date(2024, 3, 31), date(2024, 4, 1)}
    summer = spark.range(1).select(zone_name(F.lit(datetime(2024, 7, 1)), "Europe/Paris")).first()[0]
    assert summer == "CEST"


def test_derived_rows_go_to_the_partition_of_their_source(spark, tmp_path):
    path = str(tmp_path / "fc")
    write_forecasts(archive_rows(spark, issues=(1,)).withColumn("reference_date", F.lit("2023-12-31")), path)
    write_forecasts(archive_rows(spark, issues=(1,)), path)
    add_diagnostics(spark, path, "S", "m1", "2023-12-31", [(0.0, 100.0), (5.0, 10.0)])
    dates = {r[0]: r[1] for r in read_forecasts(spark, path).groupBy("reference_date").count().collect()}
    assert dates["2024-01-01"] == 36 and dates["2023-12-31"] > 36


# ---- files by name ----


def test_targets_are_read_by_name(spark, tmp_path):
    file = tmp_path / "t.csv"
    file.write_text("project_id,depth,observation,variable,datetime,note,duration,site_id\np,0.5,4.5,temperature,2024-01-01T06:00:00Z,x,P1D,S\nq,NA,NA,oxygen,2024-01-01T06:00:00Z,,P1D,S\n")
    rows = read_targets(spark, str(file), ["project_id", "absent"]).collect()
    assert [r.asDict() for r in rows] == [
        {"site_id": "S", "datetime": day(1, 6), "duration": "P1D", "variable": "temperature", "depth": 0.5, "observation": 4.5, "project_id": "p"}
    ]
    raw = read_raw_observations(spark, str(file))
    assert raw.columns == ["site_id", "datetime", "duration", "variable", "depth", "observation"] and raw.count() == 2


def test_member_files_of_another_order_are_not_misread(spark, tmp_path):
    (tmp_path / "met_m_0.csv").write_text("time,AirTemp,WindSpeed\n2024-01-01 00:00:00,1,2\n")
    assert read_member_files(spark, str(tmp_path), "m").first()["AirTemp"] == 1.0
    (tmp_path / "met_m_1.csv").write_text("time,WindSpeed,AirTemp\n2024-01-01 00:00:00,2,1\n")
    assert {tuple(r) for r in read_member_files(spark, str(tmp_path), "m").collect()} == {
        (day(1, 0), 1.0, 2.0, "0"), (day(1, 0), 1.0, 2.0, "1")
    }


def test_start_of_the_fixture():
    assert T0 == datetime(2024, 1, 20)
