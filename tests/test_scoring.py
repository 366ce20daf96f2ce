import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from limnocast.operators.joins import with_depth_keys
from limnocast.operators.ranking import ranked_values
from limnocast.operators.scoring import (
    match_targets,
    merge_scores,
    score_forecasts,
    score_joined,
    still_valid,
    unscored,
    work_list,
)
from limnocast.plans.scorekeeping import score_batch, score_incremental

FC = (
    "site_id string, model_id string, reference_datetime timestamp, datetime timestamp, "
    "duration string, parameter string, family string, variable string, depth double, "
    "prediction double, variable_type string"
)
OBS = "site_id string, datetime timestamp, duration string, variable string, depth double, observation double"


def stamp(hour):
    from datetime import datetime

    return datetime(2024, 1, 1 + hour // 24, hour % 24)


def forecast(spark, ensembles):
    """Rows from {(model, hour, variable, depth): members}."""
    rows = [
        ("S", model, stamp(0), stamp(hour), "PT1H", str(i), "ensemble", variable, depth, float(x), "state")
        for (model, hour, variable, depth), members in ensembles.items()
        for i, x in enumerate(members)
    ]
    return spark.createDataFrame(rows, FC)


def observations(spark, values):
    rows = [("S", stamp(h), "PT1H", v, d, y) for (h, v, d), y in values.items()]
    return spark.createDataFrame(rows, OBS)


def crps(xs, y):
    xs = np.asarray(xs, float)
    return np.abs(xs - y).mean() - 0.5 * np.abs(xs[:, None] - xs[None, :]).mean()


def log_score(xs, y):
    xs = np.asarray(xs, float)
    q75, q25 = np.percentile(xs, [75, 25])
    width = 1.06 * min(xs.std(ddof=1), (q75 - q25) / 1.34) * len(xs) ** -0.2
    kernel = np.exp(-0.5 * ((y - xs) / width) ** 2) / (width * math.sqrt(2 * math.pi))
    return -math.log(kernel.mean())


@pytest.fixture(scope="module")
def case(spark):
    rng = random.Random(3)
    ensembles = {
        ("a", 1, "temperature", 0.5): [rng.gauss(10, 2) for _ in range(40)],
        ("a", 2, "temperature", 0.5): [rng.gauss(12, 1) for _ in range(25)],
        ("b", 1, "temperature", 0.5): [round(rng.gauss(10, 1), 1) for _ in range(60)],
        ("a", 1, "oxygen", None): [rng.expovariate(0.2) for _ in range(31)],
        ("a", 3, "temperature", 0.5): [1.0, 2.0],
    }
    truth = {
        (1, "temperature", 0.5): 10.4,
        (2, "temperature", 0.5): 9.0,
        (1, "oxygen", None): 4.0,
        (3, "temperature", 0.5): None,
    }
    return ensembles, truth, forecast(spark, ensembles), observations(spark, truth)


def by_group(rows):
    return {(r["model_id"], r["datetime"].hour, r["variable"], r["depth"]): r for r in rows}


@pytest.mark.parametrize("hot_rows", [10**6, 1, 50])
def test_scores_equal_direct_formulas_on_every_route(case, hot_rows):
    """In rows, from ranks, and a mix of both: the same numbers."""
    ensembles, truth, fc, obs = case
    found = by_group(score_forecasts(fc, obs, hot_rows=hot_rows).collect())
    expected = {k: v for k, v in ensembles.items() if truth[k[1:]] is not None}
    assert set(found) == set(expected)
    for key, xs in expected.items():
        row, y = found[key], truth[key[1:]]
        assert row["family"] == "sample"
        assert row["observation"] == y
        assert row["crps"] == pytest.approx(crps(xs, y), abs=1e-9)
        assert row["logs"] == pytest.approx(log_score(xs, y), abs=1e-9)
        assert row["mean"] == pytest.approx(np.mean(xs))
        assert row["sd"] == pytest.approx(np.std(xs, ddof=1))
        for name, q in {
            "median": 50,
            "quantile97.5": 97.5,
            "quantile02.5": 2.5,
            "quantile90": 95,
            "quantile10": 5,
        }.items():
            assert row[name] == pytest.approx(np.percentile(xs, q)), name


def test_crps_of_one_member_is_the_distance_and_log_score_is_null(spark):
    row = score_forecasts(
        forecast(spark, {("a", 1, "temperature", 1.0): [3.0]}),
        observations(spark, {(1, "temperature", 1.0): 5.0}),
    ).first()
    assert row["crps"] == pytest.approx(2.0)
    assert row["logs"] is None and row["sd"] is None


def test_member_order_does_not_matter_and_crps_is_not_negative(spark):
    rng = random.Random(11)
    xs = [rng.uniform(-5, 5) for _ in range(50)]
    shuffled = xs[::-1]
    obs = observations(spark, {(1, "t", 0.0): 0.3})
    one = score_forecasts(forecast(spark, {("a", 1, "t", 0.0): xs}), obs).first()
    two = score_forecasts(forecast(spark, {("a", 1, "t", 0.0): shuffled}), obs).first()
    assert one["crps"] == pytest.approx(two["crps"]) and one["crps"] >= 0


@pytest.mark.parametrize("hot_rows", [10**6, 1])
def test_probabilities(spark, hot_rows):
    rows = [
        ("S", "a", stamp(0), stamp(h), "PT1H", "prob", "bernoulli", "mixed", None, p, "diagnostic")
        for h, p in [(1, 0.25), (2, 0.25), (3, 0.0), (4, 1.0)] * 3
    ]
    obs = observations(
        spark, {(1, "mixed", None): 1.0, (2, "mixed", None): 0.0, (3, "mixed", None): 1.0, (4, "mixed", None): 1.0}
    )
    got = {
        r["datetime"].hour: r
        for r in score_forecasts(spark.createDataFrame(rows, FC), obs, hot_rows=hot_rows).collect()
    }
    assert got[1]["crps"] == pytest.approx(0.5625) and got[1]["logs"] == pytest.approx(-math.log(0.25))
    assert got[2]["crps"] == pytest.approx(0.0625) and got[2]["logs"] == pytest.approx(-math.log(0.75))
    assert got[3]["logs"] == math.inf
    assert got[4]["crps"] == 0 and got[4]["logs"] == 0
    assert got[1]["mean"] == 0.25 and got[1]["sd"] == pytest.approx(math.sqrt(0.1875))
    assert got[1]["median"] == 0.0 and got[1]["quantile97.5"] == 1.0


def test_null_depths_match_and_nothing_else_does(case):
    _, _, fc, obs = case
    rows = match_targets(fc, obs).where("variable = 'oxygen'")
    assert rows.count() == 31
    assert rows.where("depth is not null").count() == 0


def test_copies_of_an_observation_count_once(case):
    _, _, fc, obs = case
    once = score_forecasts(fc, obs).count()
    assert score_forecasts(fc, obs.unionByName(obs)).count() == once


def test_ranked_values_match_a_plain_sort(spark):
    rng = random.Random(5)
    groups = {
        "skewed": [rng.choice([0.0, 1e30, 5.0]) for _ in range(200)],
        "flat": [7.0] * 50,
        "spread": [rng.gauss(0, 1e-9) for _ in range(300)] + [1e9],
        None: [3.0, 1.0, 2.0],
    }
    df = spark.createDataFrame([(k, x) for k, xs in groups.items() for x in xs], "k string, x double")
    rows = ranked_values(df, ["k"], "x", bins=4).collect()
    for key, xs in groups.items():
        mine = sorted((r["x"], r["copies"], r["upto"], r["members"]) for r in rows if r["k"] == key)
        ordered = sorted(xs)
        expected = [
            (x, xs.count(x), len(ordered) - ordered[::-1].index(x), len(xs)) for x in sorted(set(xs))
        ]
        assert mine == expected


def test_work_list_holds_the_pending_groups_with_their_sizes(case):
    _, _, fc, obs = case
    keyed = with_depth_keys(fc.withColumn("family", F.lit("sample")))
    sizes = {
        (r["model_id"], r["datetime"].hour, r["variable"]): r["n_rows"]
        for r in work_list(keyed, obs).collect()
    }
    assert sizes == {
        ("a", 1, "temperature"): 40,
        ("a", 2, "temperature"): 25,
        ("b", 1, "temperature"): 60,
        ("a", 1, "oxygen"): 31,
    }
    done = score_forecasts(fc.where("model_id = 'a'"), obs)
    assert [r["model_id"] for r in work_list(keyed, obs, done).collect()] == ["b"]


def test_unscored_leaves_only_new_keys(case):
    _, _, fc, obs = case
    scores = score_forecasts(fc.where("model_id = 'a'"), obs)
    left = unscored(fc, scores)
    groups = {(r["model_id"], r["datetime"].hour) for r in left.select("model_id", "datetime").distinct().collect()}
    assert groups == {("b", 1), ("a", 3)}


def test_incremental_scoring_is_idempotent(case):
    _, _, fc, obs = case
    first = score_incremental(fc, obs)
    again = score_incremental(fc, obs, first)
    assert again.count() == 0
    merged = merge_scores(first, again)
    assert merged.count() == first.count()


def test_empty_score_table_means_nothing_is_scored(case):
    _, _, fc, obs = case
    full = score_incremental(fc, obs)
    empty = full.where("false")
    assert score_incremental(fc, obs, empty, rescore=True).count() == full.count()


def test_changed_observation_is_rescored_only_when_asked(case):
    _, _, fc, obs = case
    stored = score_incremental(fc, obs)
    changed = obs.withColumn("observation", F.col("observation") * 1.2)
    assert score_incremental(fc, changed, stored).count() == 0
    redone = score_incremental(fc, changed, stored, rescore=True)
    assert redone.count() == stored.count()
    assert merge_scores(stored, redone).count() == 2 * stored.count()
    assert merge_scores(stored, redone, latest_only=True).count() == stored.count()


def test_signed_and_absolute_tolerance(spark):
    obs = observations(spark, {(1, "t", 0.0): -20.0})
    scores = obs.withColumn("observation", F.lit(-10.0))
    assert still_valid(scores, obs).count() == 1
    assert still_valid(scores, obs, absolute=True).count() == 0
    small = obs.withColumn("observation", F.lit(-19.9))
    assert still_valid(small, obs, absolute=True).count() == 1


def test_batch_scores_have_horizon_and_issue_date(case):
    _, _, fc, obs = case
    rows = score_batch(fc, obs).collect()
    assert {r["reference_date"] for r in rows} == {"2024-01-01"}
    assert all(r["horizon"] == pytest.approx(r["datetime"].hour / 24) for r in rows)
    assert score_batch(fc, obs, variable_types=["driver"]).count() == 0


def test_without_summaries_the_columns_are_the_key_and_the_scores(case):
    _, _, fc, obs = case
    short = score_joined(match_targets(fc, obs), summaries=False)
    assert short.columns[-3:] == ["observation", "crps", "logs"]
    full = by_group(score_forecasts(fc, obs).collect())
    for key, row in by_group(short.collect()).items():
        assert row["crps"] == pytest.approx(full[key]["crps"])


def test_grouping_uses_the_columns_that_exist(case):
    _, _, fc, obs = case
    published = fc.withColumn("pub_datetime", F.lit(stamp(1)))
    assert "pub_datetime" in score_forecasts(published, obs).columns
    assert "pub_datetime" not in score_forecasts(fc, obs).columns


def test_a_short_list_of_groups_moves_no_row(spark, monkeypatch):
    """One group may hold most rows; by a shuffle on its keys they would meet in one task."""
    from limnocast.operators import joins

    rows = spark.createDataFrame(
        [("a", i) for i in range(50)] + [(None, 50), ("b", 51), ("c", 52)], "model_id string, n int"
    )
    groups = spark.createDataFrame([("a",), ("a",), (None,), ("z",)], "model_id string")
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        kept = joins.restrict_to(rows, groups, ["model_id"])
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
        short = sorted(r["n"] for r in kept.collect())
        monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
        long = sorted(r["n"] for r in joins.restrict_to(rows, groups, ["model_id"]).collect())
    finally:
        spark.conf.set(threshold, before)
    assert short == long == list(range(51))
