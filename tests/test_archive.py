import os
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from limnocast.functions.keys import (
    base_name,
    path_value,
    relabel,
    round_to_day,
    split_part,
    strip,
)
from limnocast.operators.reshape import append, archive_slice, latest_issue, melt
from limnocast.plans.backtest import Backtest, backtest_coverage, backtest_windows
from limnocast.plans.dashboard import dashboard_tables
from limnocast.plans.diagnostics import add_diagnostics, mixing_rows
from limnocast.plans.drivers import driver_forecast, update_history_archive
from limnocast.plans.scorekeeping import score_batch, update_scores
from limnocast.schemas import FORECAST_SCHEMA, MET_SCHEMA, SCORE_SCHEMA, TARGET_SCHEMA, conform
from limnocast.sources.readers import (
    normalise_targets,
    read_dataset,
    read_forecasts,
    read_member_files,
    read_met,
    read_raw_observations,
    read_scores,
    read_targets,
    stored_dates,
)
from limnocast.sources.writers import (
    write_batch_scores,
    write_forecasts,
    write_stage2,
    write_stage3,
    write_targets,
)

LAKE = [(k * 0.5, 13e4 - 3e3 * (k * 0.5) ** 2) for k in range(13)]


def day(n, hour=0):
    return datetime(2024, 1, n, hour)


def archive_rows(spark, issues=(1, 2), models=("m1", "m2"), members=3):
    rows = [
        (
            day(issue), day(issue, hour), day(issue, 5), depth, "ensemble", str(p), "temperature",
            20.0 - depth * (1 + p) / 2 + hour / 10, None, "state", 0.0, model, f"2024-01-{issue:02d}", "S",
        )
        for issue in issues
        for model in models
        for p in range(members)
        for hour in (0, 12)
        for depth in (0.5, 2.0, 5.0)
    ]
    return spark.createDataFrame(rows, FORECAST_SCHEMA)


def targets_rows(spark):
    rows = [
        ("S", day(d, h), "P1D", "temperature", z, 19.0 - z if d < 3 else None)
        for d in (1, 2, 3)
        for h in (0, 12)
        for z in (0.5, 5.0)
    ]
    return spark.createDataFrame(rows, TARGET_SCHEMA)


def as_set(df):
    return sorted(map(str, df.select(*[f"`{c}`" for c in sorted(df.columns)]).collect()))


def test_archive_round_trip_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "fc")
    rows = archive_rows(spark)
    write_forecasts(rows, path)
    assert sorted(os.listdir(f"{path}/site_id=S")) == ["model_id=m1", "model_id=m2"]
    back = read_forecasts(spark, path)
    assert back.schema["reference_date"].dataType.simpleString() == "string"
    assert as_set(back) == as_set(rows)
    one = archive_slice(back, models=["m1"]).where("reference_date = '2024-01-02'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "model_id" in plan.split("PartitionFilters")[1].split("]")[0]
    assert one.count() == 18
    assert read_dataset(spark, path).count() == rows.count()
    assert sorted(str(r[0]) for r in stored_dates(back, "S").collect()) == ["2024-01-01", "2024-01-02"]
    assert stored_dates(back, "other").count() == 0


def test_diagnostics_are_added_in_place_once_and_other_partitions_stay(spark, tmp_path):
    path = str(tmp_path / "fc")
    write_forecasts(archive_rows(spark), path)
    other = [f for f in (tmp_path / "fc").rglob("*.parquet") if "model_id=m2" in str(f)]
    add_diagnostics(spark, path, "S", "m1", "2024-01-02", LAKE)
    first = as_set(read_forecasts(spark, path))
    assert len(first) == 72 + 2 + 3 * 2 * 9
    add_diagnostics(spark, path, "S", "m1", "2024-01-02", LAKE)
    assert as_set(read_forecasts(spark, path)) == first
    assert all(f.exists() for f in other)


def test_missing_archives_read_as_empty(spark, tmp_path):
    assert read_scores(spark, str(tmp_path / "none")).count() == 0
    assert read_met(spark, str(tmp_path / "none")).schema == MET_SCHEMA
    assert read_member_files(spark, str(tmp_path), "gone").count() == 0


def test_targets_csv(spark, tmp_path):
    path = str(tmp_path / "targets")
    write_targets(targets_rows(spark), path)
    text = "".join(f.read_text() for f in (tmp_path / "targets").glob("*.csv"))
    assert "NA" in text
    assert read_targets(spark, path).count() == 8


def test_raw_observations_lose_depth_unless_temperature(spark, tmp_path):
    file = tmp_path / "raw.csv"
    file.write_text(
        "site_id,datetime,duration,variable,depth,observation\n"
        "S,2024-01-01T06:00:00Z,P1D,temperature,0.5,4.5\nS,2024-01-01T06:00:00Z,P1D,oxygen,0.5,NA\n"
    )
    rows = normalise_targets(read_raw_observations(spark, str(file))).orderBy("variable").collect()
    assert [(r["depth"], r["observation"], r["datetime"]) for r in rows] == [
        (None, None, day(1, 6)),
        (0.5, 4.5, day(1, 6)),
    ]


def test_member_files(spark, tmp_path):
    for member in ("0", "1", "12"):
        (tmp_path / f"met_gfs_x_{member}.csv").write_text(
            "time,AirTemp,WindSpeed,Rain\n2024-01-01 00:00:00,1.5,3.0,0\n2024-01-01 01:00:00,NA,4.0,0\n"
        )
    (tmp_path / "met_other_0.csv").write_text("time,AirTemp,WindSpeed\n2024-01-01 00:00:00,9,9\n")
    rows = driver_forecast(spark, str(tmp_path), "gfs_x", "S", "2024-01-01 00:00:00", "2024-01-01 02:00:00")
    assert sorted({r["parameter"] for r in rows.collect()}) == ["0", "1", "12"]
    assert rows.count() == 9
    out = str(tmp_path / "out")
    write_forecasts(rows, out)
    assert read_forecasts(spark, out).where("variable_type = 'driver'").count() == 9


def test_score_archive_update_is_idempotent(spark, tmp_path):
    fc, obs, scores = (str(tmp_path / n) for n in ("fc", "obs", "scores"))
    write_forecasts(archive_rows(spark, models=("m1",)), fc)
    write_targets(targets_rows(spark), obs)
    update_scores(spark, fc, obs, scores)
    first = as_set(read_scores(spark, scores))
    assert len(first) == 8
    update_scores(spark, fc, obs, scores)
    assert as_set(read_scores(spark, scores)) == first
    write_forecasts(archive_rows(spark, models=("m2",)), fc)
    update_scores(spark, fc, obs, scores)
    assert read_scores(spark, scores).count() == 16
    assert read_scores(spark, scores).schema == SCORE_SCHEMA


def test_batch_scores_and_driver_layouts(spark, tmp_path):
    fc = archive_rows(spark).withColumn("duration", F.lit("P1D"))
    write_batch_scores(score_batch(fc, targets_rows(spark)), str(tmp_path / "b"))
    assert (tmp_path / "b/site_id=S/model_id=m1/reference_date=2024-01-01").exists()
    met = spark.createDataFrame(
        [("S", "ensemble", float(p), day(1, h), "x", 1.0) for h in (3, 1, 2) for p in (1, 0)], MET_SCHEMA
    )
    write_stage2(met.withColumn("reference_datetime", F.lit("2024-01-01").cast("date")), str(tmp_path / "s2"))
    assert (tmp_path / "s2/reference_datetime=2024-01-01/site_id=S").exists()
    write_stage3(met, str(tmp_path / "s3"))
    files = list((tmp_path / "s3/site_id=S").glob("*.parquet"))
    rows = [tuple(r) for f in files for r in spark.read.parquet(str(f)).select("datetime", "parameter").collect()]
    assert len(files) == 1 and rows == sorted(rows)


def test_history_archive_update(spark, tmp_path):
    from tests.test_drivers import cells

    path = str(tmp_path / "s3")
    args = (cells(spark, "analysis"), "S", 9.1, 50.1, "2024-01-20", "2024-01-21", 2)
    update_history_archive(spark, path, *args)
    first = as_set(read_met(spark, path))
    assert len(first) == 2 * 8 * 48
    update_history_archive(spark, path, *args)
    assert as_set(read_met(spark, path)) == first


def test_conform_adds_missing_columns_and_drops_others(spark):
    df = spark.createDataFrame([("S", 1, "x")], "site_id string, depth int, other string")
    out = conform(df, TARGET_SCHEMA)
    assert out.schema == TARGET_SCHEMA
    assert out.first()["depth"] == 1.0 and out.first()["observation"] is None


def test_melt_and_append(spark):
    wide = spark.createDataFrame([("k", 1.0, None)], "id string, a double, b double")
    assert melt(wide, ["a", "b"], {"a": "first"}).collect()[0]["variable"] == "first"
    assert melt(wide, ["a", "b"], drop_nulls=False).count() == 2
    both = append(wide, spark.createDataFrame([("z", 1)], "id string, c int"))
    assert both.columns == ["id", "a", "b", "c"] and both.count() == 2


def test_latest_issue_with_and_without_a_partition_column(spark):
    rows = archive_rows(spark)
    assert latest_issue(rows, ["m1"]).first()[0] == day(2)
    assert latest_issue(rows.drop("reference_date"), ["m1"]).first()[0] == day(2)
    assert latest_issue(rows, ["none"]).first()[0] is None


def test_dashboard_tables(spark):
    rows = archive_rows(spark)
    tables = dashboard_tables(
        append(rows, mixing_rows(rows)), ["m1", "m2"], {"m1": "First"}, "Europe/Paris"
    )
    shown = tables["temperature"].collect()
    assert {r["model_id"] for r in shown} == {"First", "m2"}
    assert {(r["depth_label"], r["depth_order"]) for r in shown} == {
        ("Surface (depth: 0.5 m)", 1),
        ("Bottom (depth: 5 m)", 2),
    }
    assert min(r["datetime"] for r in shown) == day(2, 1)
    assert {r["parameter"] for r in shown} >= {"m1_0", "m2_2"}
    kpi = tables["kpi_surface"].first()
    assert kpi["max"] == pytest.approx(19.75) and kpi["min"] == pytest.approx(19.25)
    assert tables["kpi_mixed"].first()["value"] == 0.0
    horizon = tables["kpi_horizon"].first()
    # Half a day rounds to the even number of days, none.
    assert horizon["horizon_days"] == 0 and horizon["issued"] == "Jan 02, 2024 01:00 CET"
    assert tables["date_axis"].count() == 0


def test_text_and_time_helpers(spark):
    row = (
        spark.createDataFrame([("a/b=1/met_x.y_7.csv", day(1, 12), "m1")], "p string, t timestamp, m string")
        .select(
            base_name(F.col("p")),
            strip(base_name(F.col("p")), "met_x.y_", ".csv"),
            path_value(F.col("p"), "b"),
            split_part(F.lit("u_v"), "_", 2),
            split_part(F.lit("u_v"), "_", 3),
            round_to_day(F.col("t")),
            relabel(F.col("m"), {}),
        )
        .first()
    )
    assert tuple(row) == ("met_x.y_7.csv", "7", "1", "v", None, day(2), "m1")


PLAN = Backtest("2020-12-15", "2021-01-01", 7, 275, 14, ["ncep"])


def test_backtest_windows_chain(spark):
    rows = backtest_windows(spark, PLAN).orderBy("simulation").collect()
    assert len(rows) == 276
    assert str(rows[0]["start_date"]) == "2020-12-15" and rows[0]["horizon"] == 0
    assert all(a["end_date"] == b["start_date"] for a, b in zip(rows, rows[1:]))
    assert {r["horizon"] for r in rows[1:]} == {14}


def test_backtest_coverage_equals_a_range_test(spark):
    plan = Backtest("2023-12-20", "2024-01-02", 3, 4, 7, ["a", "b"])
    obs = targets_rows(spark).select("site_id", "duration", "variable", "depth").limit(1).crossJoin(
        spark.range(0, 26 * 24, 5).selectExpr(
            "timestamp '2023-12-28' + make_dt_interval(0, cast(id as int)) as datetime", "double(id) as observation"
        )
    )
    got = {(r["model"], r["simulation"]): r["n_targets"] for r in backtest_coverage(obs, plan).collect()}
    times = [r["datetime"] for r in obs.collect()]
    for w in backtest_windows(spark, plan).collect():
        start = datetime.combine(w["end_date"], datetime.min.time())
        n = sum(0 <= (t - start).total_seconds() <= w["horizon"] * 86400 for t in times)
        assert got[(w["model"], w["simulation"])] == n


def test_each_path_is_taken_apart_once(spark, tmp_path):
    from __spark_entry__ import queries

    rows = [(i, datetime(2024, 1, 1 + i % 9, i % 24), i % 5, "click" if i % 3 else "view", float(i)) for i in range(90)]
    rows += [(90, datetime(2024, 1, 2), None, "click", 1.0), (None, None, 3, "click", 2.0)]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double")
    events.write.parquet(str(tmp_path / "events.parquet"))
    df = queries()["string_parts"](spark, str(tmp_path))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Aggregate \[model_id#\d+, path#\d+\], \[[^\n]*regexp_extract\(path", plan)
    members = {}
    for e, ts, user, kind, _ in rows:
        if kind != "view":
            model = "model_a" if e is not None and e % 2 == 0 else "model_b"
            week = None if ts is None else datetime(2024, 1, 1 if ts.day < 8 else 8).strftime("%Y-%m-%d")
            known = None not in (week, user)
            key = (week if known else None, model, user if known else None)
            members.setdefault(key, set()).add((week, ts, user))
    got = {(r["issue_date"], r["model_id"], None if r["member"] is None else int(r["member"])): r["n"] for r in df.collect()}
    assert got == {k: 14 * len(v) for k, v in members.items()}
    assert all(r["last_part"] == r["model_id"][-1] for r in df.collect() if r["member"] is not None)
