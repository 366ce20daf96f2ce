"""Listings, interval joins, ledgers, months, stored cubes, and files whose headers differ."""

import os
import random
from datetime import datetime, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from limnocast.operators.intervals import interval_join
from limnocast.plans.backtest import covered_at, windows_at
from limnocast.plans.drivers import forecast_drivers, history_drivers, update_forecast_archive, update_history_archive
from limnocast.plans.ledger import observation_changes, update_scores_by_ledger
from limnocast.plans.scorekeeping import update_scores
from limnocast.schemas import MET_SCHEMA, SCORE_PARTITIONS, SCORE_SCHEMA, STAGE2_PARTITIONS, STAGE3_PARTITIONS, TARGET_SCHEMA
from limnocast.session import scratch_folder
from limnocast.sources.catalogue import archive_partitions, is_by_month, listed_dates, stored_files, stored_partitions
from limnocast.sources.cubes import Cube, axes_path, write_cube
from limnocast.sources.readers import read_layout, read_member_files, read_met, read_or_empty, read_scores, stored_dates
from limnocast.sources.writers import migrate_to_months, write_forecasts, write_partitions, write_scores, write_stage3, write_targets
from tests.test_archive import archive_rows, as_set, day, targets_rows
from tests.test_drivers import cells
from tests.test_second_round import plan


def spoil(folder):
    """Overwrite every data file with rubbish of its size and time, so that opening one fails."""
    for file in folder.rglob("*.parquet"):
        state = file.stat()
        file.write_bytes(b"x" * state.st_size)
        os.utime(file, ns=(state.st_atime_ns, state.st_mtime_ns))


# ---- listings ----


def test_listing_equals_the_scan_and_opens_nothing(spark, tmp_path):
    rows = spark.createDataFrame(
        [(f"2024-01-{d:02}", site, 1.0) for d in range(1, 6) for site in ("A", "B+ %:x", None) if site != "A" or d != 3],
        "reference_datetime string, site_id string, prediction double",
    ).withColumn("reference_datetime", F.to_date("reference_datetime"))
    path = str(tmp_path / "s2")
    write_partitions(rows, path, STAGE2_PARTITIONS)
    scanned = {tuple(r) for r in rows.select(F.col("reference_datetime").cast("string"), "site_id").collect()}
    one = {r[0] for r in stored_dates(spark.read.parquet(path), "A").collect()}
    spoil(tmp_path / "s2")
    listed = stored_files(spark, path, STAGE2_PARTITIONS)
    assert {tuple(r) for r in listed.select(*STAGE2_PARTITIONS).collect()} == scanned
    assert {r[0] for r in listed_dates(spark, path, "A", STAGE2_PARTITIONS).collect()} == one and len(one) == 4
    assert listed_dates(spark, str(tmp_path / "none"), "A", STAGE2_PARTITIONS).count() == 0
    assert listed_dates(spark, path, "Z", STAGE2_PARTITIONS).count() == 0
    assert stored_files(spark, path, STAGE2_PARTITIONS, reference_datetime="2024-01-03").count() == 2


def test_a_mark_changes_with_a_rewrite(spark, tmp_path):
    path = str(tmp_path / "fc")
    write_forecasts(archive_rows(spark, models=("m1", "m2")), path)
    keys = ["site_id", "model_id", "reference_date"]
    marks = {r["model_id"]: r["mark"] for r in stored_partitions(spark, path, keys).collect()}
    write_forecasts(archive_rows(spark, models=("m2",)), path)
    after = {r["model_id"]: r["mark"] for r in stored_partitions(spark, path, keys).collect()}
    assert after["m1"] == marks["m1"] and after["m2"] != marks["m2"]


def test_scratch_folder_goes_also_after_a_failure(spark):
    with pytest.raises(ZeroDivisionError), scratch_folder(spark, "x") as path:
        spark.range(3).write.parquet(path)
        raise ZeroDivisionError
    assert stored_files(spark, path, []).count() == 0


# ---- intervals ----


@pytest.mark.parametrize("bucket", [3600, 86400, 10**7])
def test_interval_join_equals_all_pairs(spark, bucket):
    rng = random.Random(bucket)
    t0 = datetime(2024, 1, 1)
    points = [(rng.choice("ab"), i, t0 + timedelta(minutes=rng.randint(-5000, 90000))) for i in range(300)] + [("a", 900, None)]
    windows = []
    for i in range(60):
        start = t0 + timedelta(minutes=rng.randint(-9000, 80000))
        windows.append((rng.choice("ab"), i, start, start + timedelta(minutes=rng.choice([-10, 0, 5, 700, 9000, 200_000]))))
    windows += [("a", 100, None, t0), ("b", 101, t0, None), ("a", 102, points[0][2], points[0][2])]
    p = spark.createDataFrame(points, "key string, p int, at timestamp")
    w = spark.createDataFrame(windows, "key string, w int, low timestamp, high timestamp")
    joined = interval_join(p, w, "at", "low", "high", ["key"], bucket)
    want = {(i, j) for k, i, at in points for m, j, low, high in windows if k == m and at and low and high and low <= at <= high}
    got = [(r["p"], r["w"]) for r in joined.collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 100
    assert "NestedLoop" not in plan(joined) and "Cartesian" not in plan(joined)


def test_a_long_window_is_spread_over_many_tasks(spark):
    t0 = datetime(2000, 1, 1)
    points = spark.range(20_000).select((F.lit(t0).cast("timestamp") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("at"))
    window = spark.createDataFrame([(t0, datetime(2030, 1, 1))], "low timestamp, high timestamp")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shares = interval_join(points, window, "at", "low", "high").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(r["count"] for r in shares) == 20_000 and max(r["count"] for r in shares) < 8000


def test_windows_of_irregular_origins(spark):
    rows = [("m", "2024-01-05", 3), ("m", "2024-01-05", 9), ("m", "2024-02-01", None), ("m", "2024-01-06", 40), ("n", "2024-01-09", 2), (None, "2024-01-01", 1)]
    origins = spark.createDataFrame(rows, "model string, d string, horizon int").select("model", F.to_date("d").alias("end_date"), "horizon")
    windows = windows_at(origins, "2023-12-01")
    got = sorted((r["model"], r["simulation"], str(r["start_date"]), str(r["end_date"]), r["horizon"]) for r in windows.collect())
    assert got == [
        ("m", 1, "2023-12-01", "2024-01-05", 0),
        ("m", 2, "2024-01-05", "2024-01-06", 40),
        ("m", 3, "2024-01-06", "2024-02-01", 0),
        ("n", 1, "2023-12-01", "2024-01-09", 0),
    ]
    seen = spark.createDataFrame([(day(1, 0), 1), (datetime(2024, 1, 5), 2), (datetime(2024, 2, 1), 3), (datetime(2024, 2, 15, 0, 0, 1), 4)], "datetime timestamp, k int")
    assert sorted((r["model"], r["simulation"], r["k"]) for r in covered_at(seen, windows).collect()) == [("m", 1, 2), ("m", 2, 3), ("m", 3, 3)]


# ---- ledger ----


def observed_rows(spark, factor=1.0, first=None, last=None):
    rows = targets_rows(spark).withColumn("observation", F.col("observation") * factor)
    if first is not None:
        rows = rows.where(F.col("datetime") >= first)
    return rows if last is None else rows.where(F.col("datetime") < last)


@pytest.fixture
def both(spark, tmp_path):
    """Paths of one forecast archive and targets, and scores kept by a ledger and by full runs."""
    fc, obs, by_ledger, by_all, state = (str(tmp_path / n) for n in ("fc", "obs", "ledger_scores", "all_scores", "state"))

    def run(**options):
        opened = update_scores_by_ledger(spark, fc, obs, by_ledger, state, **options)
        update_scores(spark, fc, obs, by_all, **options)
        assert as_set(read_or_empty(spark, by_ledger, SCORE_SCHEMA)) == as_set(read_or_empty(spark, by_all, SCORE_SCHEMA))
        return sorted(f.split("/fc/")[1] for f in opened)

    return fc, obs, by_ledger, run


def test_a_run_with_nothing_new_opens_no_forecast_and_no_score(spark, tmp_path, both):
    fc, obs, by_ledger, run = both
    write_forecasts(archive_rows(spark, models=("m1", "m2")), fc)
    write_targets(targets_rows(spark), obs)
    assert len(run()) >= 2
    spoil(tmp_path / "fc")
    spoil(tmp_path / "ledger_scores")
    for options in ({}, {"rescore": True}):
        assert update_scores_by_ledger(spark, fc, obs, by_ledger, str(tmp_path / "state"), **options) == []


def test_ledger_runs_equal_full_runs(spark, tmp_path, both):
    fc, obs, by_ledger, run = both
    half = day(1, 12)
    write_forecasts(archive_rows(spark, models=("m1",)), fc)
    write_targets(observed_rows(spark, last=half), obs)
    first = run()
    assert first and all("model_id=m1" in f for f in first)
    # A new partition is opened alone, and so is a rewritten one.
    write_forecasts(archive_rows(spark, models=("m2",)), fc)
    assert all("model_id=m2" in f for f in run()) and run() == []
    write_forecasts(archive_rows(spark, models=("m1",)).withColumn("prediction", F.col("prediction") + 1), fc)
    assert all("model_id=m1" in f for f in run())
    # New observations open what they can meet.
    write_targets(targets_rows(spark), obs)
    assert run() and run() == []
    # A changed one does so only when scores are to be made again; small changes do not.
    write_targets(observed_rows(spark, 1.001), obs)
    assert run(rescore=True) == []
    write_targets(observed_rows(spark, 1.2), obs)
    assert run() == [] and run(rescore=True) and run(rescore=True) == []
    write_targets(observed_rows(spark, 1.4), obs)
    assert run(rescore=True, latest_only=True) and run(rescore=True) == []
    write_targets(targets_rows(spark), obs)
    assert run(rescore=True)


def test_lost_scores_make_the_ledger_void(spark, tmp_path, both):
    fc, obs, by_ledger, _ = both
    state = str(tmp_path / "state")
    write_forecasts(archive_rows(spark, models=("m1",)), fc)
    write_targets(targets_rows(spark), obs)
    assert update_scores_by_ledger(spark, fc, obs, by_ledger, state)
    elsewhere = str(tmp_path / "new_scores")
    assert update_scores_by_ledger(spark, fc, obs, elsewhere, state)
    assert as_set(read_scores(spark, elsewhere)) == as_set(read_scores(spark, by_ledger))


def test_another_duration_has_its_own_ledger(spark, tmp_path, both):
    fc, obs, by_ledger, _ = both
    write_forecasts(archive_rows(spark, models=("m1",)), fc)
    write_targets(targets_rows(spark).union(targets_rows(spark).withColumn("duration", F.lit("PT1H"))), obs)
    state = str(tmp_path / "state")
    assert update_scores_by_ledger(spark, fc, obs, by_ledger, state)
    assert update_scores_by_ledger(spark, fc, obs, by_ledger, state, duration="PT1H")
    assert {r[0] for r in read_scores(spark, by_ledger).select("duration").distinct().collect()} == {"P1D", "PT1H"}


def test_one_changed_value_touches_one_partition(spark, tmp_path, both):
    fc, obs, by_ledger, run = both

    def spread(rows, *times):
        """The rows, the same of another variable, and both forty days later."""
        rows = rows.unionByName(rows.withColumn("variable", F.lit("oxygen")))
        later = rows.withColumns({t: F.col(t) + F.make_dt_interval(F.lit(40)) for t in times})
        return rows.unionByName(later.withColumn("reference_date", F.date_format("datetime", "yyyy-MM-dd")) if len(times) > 1 else later)

    write_forecasts(spread(archive_rows(spark, models=("m1",)), "reference_datetime", "datetime", "pub_datetime"), fc)
    seen = spread(targets_rows(spark), "datetime")
    write_targets(seen, obs)
    assert len(run()) == 4
    files = {f: f.stat().st_mtime_ns for f in (tmp_path / "ledger_scores").rglob("*.parquet")}
    assert len(files) == 4
    only = (F.col("datetime") == F.lit(day(2, 12))) & (F.col("variable") == "temperature") & (F.col("depth") == 5.0)
    write_targets(seen.withColumn("observation", F.when(only, F.col("observation") * 3).otherwise(F.col("observation"))), obs)
    assert [f.split("reference_date=")[1] for f in run(rescore=True)] == ["2024-01-02"]
    left = {f for f, t in files.items() if f.exists() and f.stat().st_mtime_ns == t}
    assert left == {f for f in files if "variable=temperature/model_id=m1/month=2024-01" not in str(f)} and len(left) == 3


def test_changes_name_new_changed_and_gone(spark):
    def rows(*values):
        return spark.createDataFrame([("S", day(1, h), "P1D", "x", depth, float(v)) for h, depth, v in values], TARGET_SCHEMA)

    now = rows((1, None, 10.0), (2, 0.5, 10.05), (3, 0.5, 12.0), (5, 0.5, 1.0), (6, 0.5, -2.0), (7, 0.5, 0.0))
    seen = rows((2, 0.5, 10.0), (3, 0.5, 10.0), (3, 0.5, 11.95), (4, 0.5, 3.0), (5, 0.5, 1.0), (6, 0.5, -1.0), (7, 0.5, 0.0))
    got = sorted((r["datetime"].hour, r["was"], r["observation"], r["change"]) for r in observation_changes(now, seen).collect())
    assert got == [(1, None, 10.0, "new"), (3, 10.0, 12.0, "changed"), (4, 3.0, None, "gone"), (7, 0.0, 0.0, "changed")]
    got = {r["datetime"].hour for r in observation_changes(now, seen, absolute=True).collect()}
    assert got == {1, 3, 4, 6, 7}


# ---- months ----


def scores_of(spark, days, value=1.0):
    rows = [("S", d, "P1D", "x", 0.5, "m", "sample", d, None, 1.0, value) for d in days]
    names = SCORE_SCHEMA.names[:11]
    frame = spark.createDataFrame(rows, ", ".join(f"{n} {SCORE_SCHEMA[n].dataType.simpleString()}" for n in names))
    from limnocast.schemas import conform

    return conform(frame, SCORE_SCHEMA)


def test_a_daily_run_leaves_other_months_alone(spark, tmp_path):
    scores, fc, obs = str(tmp_path / "scores"), str(tmp_path / "fc"), str(tmp_path / "obs")
    write_forecasts(archive_rows(spark, models=("m1",)), fc)
    write_targets(targets_rows(spark), obs)
    old = scores_of(spark, [datetime(2023, 11, 5), datetime(2023, 12, 5)]).withColumns({"model_id": F.lit("m1"), "variable": F.lit("temperature")})
    write_partitions(old, scores, archive_partitions(spark, scores, SCORE_PARTITIONS))
    files = {f: f.stat().st_mtime_ns for f in (tmp_path / "scores").rglob("*.parquet")}
    assert len(files) == 2 and all("month=2023-1" in str(f) for f in files)
    update_scores(spark, fc, obs, scores)
    assert all(f.exists() and f.stat().st_mtime_ns == t for f, t in files.items())
    assert read_scores(spark, scores).count() == 2 + 8 and read_scores(spark, scores).schema == SCORE_SCHEMA


def test_old_layouts_stay_and_can_be_migrated(spark, tmp_path):
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    rows = scores_of(spark, [datetime(2023, m, d) for m in (1, 2, 3) for d in (1, 2)])
    assert is_by_month(spark, old) is None
    write_scores(rows, old)
    assert is_by_month(spark, old) is False and archive_partitions(spark, old, SCORE_PARTITIONS) == SCORE_PARTITIONS
    with pytest.raises(ValueError, match="migrate"):
        archive_partitions(spark, old, SCORE_PARTITIONS, by_month=True)
    migrate_to_months(read_or_empty(spark, old, SCORE_SCHEMA), new, SCORE_PARTITIONS)
    assert is_by_month(spark, new) and as_set(read_or_empty(spark, new, SCORE_SCHEMA)) == as_set(rows)
    assert len(list((tmp_path / "new").rglob("month=*"))) == 3
    with pytest.raises(ValueError, match="not new"):
        migrate_to_months(rows, new, SCORE_PARTITIONS)
    one = read_layout(spark, new, SCORE_SCHEMA, [*SCORE_PARTITIONS, "month"]).where("month = '2023-02'")
    assert one.count() == 2 and len(one.inputFiles()) >= 1


@pytest.mark.parametrize("by_month", [None, False])
def test_history_gains_days_by_month(spark, tmp_path, by_month):
    path, grid = str(tmp_path / "s3"), cells(spark, "analysis")
    before = spark.createDataFrame([("S", "ensemble", 0.0, datetime(2023, 12, 5, h), "x", 1.0) for h in range(5)], MET_SCHEMA)
    write_partitions(before, path, archive_partitions(spark, path, STAGE3_PARTITIONS, by_month))
    files = {f: f.stat().st_mtime_ns for f in (tmp_path / "s3").rglob("*.parquet")}
    args = (grid, "S", 9.1, 50.1, "2024-01-20")
    update_history_archive(spark, path, *args, "2024-01-20", 2)
    update_history_archive(spark, path, *args, "2024-01-21", 2)
    assert read_met(spark, path).count() == 5 + 2 * 8 * 48
    whole = history_drivers(*args, "2024-01-21", 2).select(*MET_SCHEMA.names)
    assert {r[:5] for r in as_set(read_met(spark, path).where("datetime > '2024-01-01'"))} == {r[:5] for r in as_set(whole)}
    untouched = all(f.exists() and f.stat().st_mtime_ns == t for f, t in files.items())
    assert untouched == (by_month is None)
    update_history_archive(spark, path, *args, "2024-01-21", 2)
    assert read_met(spark, path).count() == 5 + 2 * 8 * 48


# ---- cubes ----


def test_a_stored_cube_gives_the_same_drivers(spark, tmp_path):
    path = str(tmp_path / "cube")
    grid = cells(spark, "forecast")
    write_cube(grid, path, "init_time")
    args = ("S", 9.1, 50.1, "2024-01-19", "2024-01-22")
    assert as_set(forecast_drivers(Cube(spark, path), *args)) == as_set(forecast_drivers(grid, *args))
    days = ["2024-01-19", "2024-01-22"]
    some = as_set(forecast_drivers(Cube(spark, path), *args, days=days))
    assert some == as_set(forecast_drivers(grid, *args, days=days))
    assert some == as_set(forecast_drivers(grid, *args).where(F.date_format("reference_datetime", "yyyy-MM-dd").isin(days)))
    assert update_forecast_archive(spark, str(tmp_path / "s2"), Cube(spark, path), *args) == [f"2024-01-{d}" for d in range(19, 23)]
    history = str(tmp_path / "history")
    write_cube(cells(spark, "analysis"), history, "time")
    rest = ("S", 9.1, 50.1, "2024-01-20", "2024-01-21", 2)
    assert as_set(history_drivers(Cube(spark, history), *rest)) == as_set(history_drivers(cells(spark, "analysis"), *rest))


def wide_cube(spark):
    return spark.range(40 * 30 * 24).select(
        (50 + (F.col("id") % 40) * 0.25).alias("latitude"),
        (9 + (F.floor(F.col("id") / 40) % 30) * 0.25).alias("longitude"),
        F.timestamp_seconds(1704067200 + F.floor(F.col("id") / 1200) * 3600).alias("time"),
        F.rand(3).alias("temperature_2m"),
    )


def test_looking_up_a_cell_skips_files_and_row_groups(spark, tmp_path):
    path = str(tmp_path / "cube")
    write_cube(wide_cube(spark), path, "time", files=8, **{"parquet.block.size": "16384", "parquet.page.size": "2048"})
    cell = Cube(spark, path).cell(11.6, 54.3)
    rows = cell.collect()
    assert len(rows) == 24 and {(r["latitude"], r["longitude"]) for r in rows} == {(54.25, 11.5)}
    assert "EqualTo(latitude,54.25)" in plan(cell) and "EqualTo(longitude,11.5)" in plan(cell)
    groups = held = files = 0
    for file in (tmp_path / "cube").glob("*.parquet"):
        meta, here = pq.ParquetFile(file).metadata, 0
        names = meta.schema.names
        for g in range(meta.num_row_groups):
            stats = [meta.row_group(g).column(names.index(n)).statistics for n in ("latitude", "longitude")]
            here += all(s.min <= x <= s.max for s, x in zip(stats, (54.25, 11.5), strict=True))
            groups += 1
        held += here
        files += here > 0
    assert files <= 2 and groups > 8 and held <= groups // 4
    # The lookup itself reads the axes only.
    spoil(tmp_path / "cube")
    assert Cube(spark, path).nearest("latitude", 54.3) == 54.25 and Cube(spark, path).axis("time").count() == 24


def test_cubes_grow_and_may_be_empty(spark, tmp_path):
    path = str(tmp_path / "cube")
    grid = wide_cube(spark)
    write_cube(grid.limit(0), path, "time")
    assert Cube(spark, path).cell(9.0, 50.0).count() == 0
    for hour in (3, 5):
        write_cube(grid.where(F.hour("time") == hour), path, "time", mode="append")
    assert {r[0].hour for r in Cube(spark, path).axis("time").collect()} == {3, 5}
    assert Cube(spark, path).cell(9.0, 50.0).count() == 2
    assert spark.read.parquet(axes_path(path)).count() >= 40 + 30 + 2
    # Of two coordinates equally close the larger is taken.
    assert Cube(spark, path).nearest("longitude", 9.125) == 9.25


def test_only_issues_of_lacking_dates_are_read(spark, tmp_path):
    path = str(tmp_path / "cube")
    t0 = datetime(2024, 1, 1)
    rows = [(t0 + timedelta(days=i), 0, 50.0, 9.0, t0 + timedelta(days=i, hours=h), 280.0) for i in range(30) for h in (0, 6, 12)]
    schema = "init_time timestamp, ensemble_member int, latitude double, longitude double, valid_time timestamp, temperature_2m double"
    write_cube(spark.createDataFrame(rows, schema), path, "init_time", files=30)
    lacking = ["2024-01-01", "2024-01-30"]
    # The values of all other issues are spoilt: with the first and last date lacking, nothing between is read.
    for file in (tmp_path / "cube").glob("*.parquet"):
        stamps = {r.day for r in pq.read_table(file, columns=["init_time"])["init_time"].to_pylist()}
        if not stamps & {1, 30}:
            meta = pq.ParquetFile(file).metadata
            state = file.stat()
            raw = bytearray(file.read_bytes())
            column = meta.row_group(0).column(meta.schema.names.index("temperature_2m"))
            begin = column.dictionary_page_offset or column.data_page_offset
            raw[begin : begin + column.total_compressed_size] = b"x" * column.total_compressed_size
            file.write_bytes(bytes(raw))
            os.utime(file, ns=(state.st_atime_ns, state.st_mtime_ns))
            for crc in (tmp_path / "cube").glob(f".{file.name}.crc"):
                crc.unlink()
    out = forecast_drivers(Cube(spark, path), "S", 9.0, 50.0, "2024-01-01", "2024-01-30", days=lacking)
    assert {r[0] for r in out.select(F.date_format("reference_datetime", "yyyy-MM-dd")).distinct().collect()} == set(lacking)


# ---- member files ----


def test_headers_that_differ_are_read_by_name_in_one_scan(spark, tmp_path):
    texts = {
        "0": "time,AirTemp,WindSpeed\n2024-01-01 00:00:00,1,2\n2024-01-01 01:00:00,NA,\n",
        "1": "WindSpeed,time,AirTemp\n2,2024-01-01 00:00:00,1\n",
        "2": '﻿"time","Note, long",AirTemp,Rain,WindSpeed\n2024-01-01 00:00:00,"a,b",1,9,2\n',
        "a+b": "AirTemp,time\n1,2024-01-01 00:00:00\n",
        "4": "Rain\n7\n",
        "5": "time,AirTemp,WindSpeed\n",
    }
    for member, text in texts.items():
        (tmp_path / f"met_gfs_x_{member}.csv").write_text(text)
    (tmp_path / "met_gfs_x_7.csv").mkdir()
    (tmp_path / "met_gfs_x_7.csv" / "part-0.csv").write_text("time,WindSpeed,AirTemp\n2024-01-01 00:00:00,2,1\n")
    rows = read_member_files(spark, str(tmp_path), "gfs_x")
    assert plan(rows).count("FileScan csv") == 1
    got = {}
    for r in rows.collect():
        got.setdefault(r["parameter"], []).append((r["time"], r["AirTemp"], r["WindSpeed"]))
    first = (day(1, 0), 1.0, 2.0)
    assert got == {"0": [first, (day(1, 1), None, None)], "1": [first], "2": [first], "a+b": [(day(1, 0), 1.0, None)], "4": [(None, None, None)], "7": [first]}
    assert read_member_files(spark, str(tmp_path), "absent").count() == 0
