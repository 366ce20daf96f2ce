"""Pairing forecasts with observations and scoring each ensemble."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limnocast.functions import scores as S
from limnocast.functions.keys import existing, sample_family
from limnocast.operators.joins import (
    DEPTH_KEYS,
    depth_keyed,
    distinct_by,
    join_null_safe,
    with_depth_keys,
)
from limnocast.operators.ranking import HOT_ROWS, ranked_values, sized
from limnocast.session import checkpointed

OBSERVATION_KEY = ["site_id", "datetime", "duration", "variable", "depth"]
SCORE_KEY = [*OBSERVATION_KEY, "model_id", "family", "reference_datetime"]
GROUPING = [
    "model_id",
    "reference_datetime",
    "site_id",
    "datetime",
    "family",
    "variable",
    "pub_datetime",
    "project_id",
    "duration",
    "depth",
]
SUMMARIES = ["mean", "median", "sd", "quantile97.5", "quantile02.5", "quantile90", "quantile10"]


def observed(targets: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Non-null observations with the ``extra`` columns beside them; exact copies count once."""
    return (
        targets.where(F.col("observation").isNotNull())
        .select(*OBSERVATION_KEY, *extra, "observation")
        .distinct()
    )


def target_groups(forecasts: DataFrame, targets: DataFrame, extra: Sequence[str] = ()) -> list[str]:
    """Grouping columns that only the targets have: ``project_id`` and what ``extra`` names."""
    named = dict.fromkeys(["project_id", *extra])
    return [c for c in named if c in targets.columns and c not in forecasts.columns]


def shared_groups(forecasts: DataFrame, targets: DataFrame, extra: Sequence[str] = ()) -> list[str]:
    """Grouping columns that both sides have and so must agree in, null with null."""
    named = dict.fromkeys(["project_id", *extra])
    return [c for c in named if c in targets.columns and c in forecasts.columns]


def single_observation(joined: DataFrame, groups: Sequence[str] | None = None) -> DataFrame:
    """Per group of a joined table its least ``observation`` and whether it is the only one."""
    y = F.col("observation")
    return joined.groupBy(*(groups or existing(joined, GROUPING))).agg(
        F.min(y).alias("observation"), (F.min(y) == F.max(y)).alias("single")
    )


def match_targets(forecasts: DataFrame, targets: DataFrame, how: str = "inner") -> DataFrame:
    """Forecast rows with their observation; a null depth matches a null depth."""
    return _paired(with_depth_keys(forecasts), observed(targets), how).drop(*DEPTH_KEYS)


def _paired(keyed_forecasts: DataFrame, targets: DataFrame, how: str = "inner") -> DataFrame:
    right = with_depth_keys(targets).drop("depth")
    return keyed_forecasts.join(right, depth_keyed(OBSERVATION_KEY), how)


def unscored(forecasts: DataFrame, scores: DataFrame) -> DataFrame:
    """Forecast rows whose score key is not among the stored scores.

    Families are compared as they are scored, so ``ensemble`` rows meet ``sample`` scores.
    """
    keys = depth_keyed(SCORE_KEY)
    done = distinct_by(with_depth_keys(scores), keys)
    named = with_depth_keys(forecasts.withColumn("family", sample_family(F.col("family"))))
    return named.join(done, keys, "left_anti").select(*forecasts.columns)


def still_valid(
    scores: DataFrame, targets: DataFrame, tolerance: float = 1e-2, absolute: bool = False
) -> DataFrame:
    """Scores whose observation has not changed by more than ``tolerance``.

    The change is relative to the signed stored value, so a negative one always
    passes; ``absolute=True`` divides by its size instead.
    """
    keys = depth_keyed(OBSERVATION_KEY)
    now = with_depth_keys(observed(targets)).select(*keys, F.col("observation").alias("_now"))
    stored = F.col("observation")
    scale = F.nullif(F.abs(stored) if absolute else stored, F.lit(0.0))
    return (
        with_depth_keys(scores)
        .join(now, keys)
        .where(F.abs(stored - F.col("_now")) / scale < tolerance)
        .select(*[F.col(f"`{c}`") for c in scores.columns])
    )


def merge_scores(existing_scores: DataFrame, new: DataFrame, latest_only: bool = False) -> DataFrame:
    """Stored and new scores together, equal rows once.

    A changed score is added beside the stored one; ``latest_only=True`` lets it
    replace the stored one of the same key.
    """
    if latest_only:
        existing_scores = join_null_safe(
            existing_scores, distinct_by(new, SCORE_KEY), SCORE_KEY, "left_anti"
        )
    return existing_scores.unionByName(new, allowMissingColumns=True).distinct()


def score_groups(rows: DataFrame) -> DataFrame:
    """The (site, variable, model, family) groups there are rows to score for."""
    return distinct_by(
        rows.where(F.col("model_id").isNotNull()), ["site_id", "variable", "model_id", "family"]
    )


def work_list(
    keyed_forecasts: DataFrame,
    targets: DataFrame,
    scores: DataFrame | None = None,
    extra_groups: Sequence[str] = (),
) -> DataFrame:
    """The score keys to be scored, each with its observation and its number of rows.

    Grouping columns that only the targets have come along: a key then has one row for each of their values.

    Reads the key columns only: rows collapse to one per ensemble before they are shuffled,
    and the joins with observations and stored scores run on those. Written out once, so
    that every later use sees the same list.
    """
    keys = depth_keyed(SCORE_KEY)
    groups = keyed_forecasts.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    beside = target_groups(keyed_forecasts, targets, extra_groups)
    shared = shared_groups(keyed_forecasts, targets, extra_groups)
    seen = with_depth_keys(observed(targets, [*beside, *shared])).drop("depth")
    if shared:
        seen = seen.withColumnsRenamed({c: f"_seen_{c}" for c in shared})
    todo = groups.join(seen, depth_keyed(OBSERVATION_KEY))
    if scores is not None:
        todo = todo.join(distinct_by(with_depth_keys(scores), keys), keys, "left_anti")
    return checkpointed(todo)


def score_forecasts(
    forecasts: DataFrame,
    targets: DataFrame,
    summaries: bool = True,
    hot_rows: int = HOT_ROWS,
    scores: DataFrame | None = None,
    extra_groups: Sequence[str] = (),
) -> DataFrame:
    """CRPS, log score and ensemble summary of every forecast group with an observation.

    ``extra_groups`` names columns of either table to group by beside the usual ones, of which
    ``project_id`` is one; a column of both must agree.
    Groups whose key is among ``scores`` are left out. Forecast rows join the work list
    on the keys the aggregate groups by, so they move once; when the list is short
    it is broadcast and only the rows to score move at all. Each ensemble, a hundred or
    so members, is gathered in its row. Groups with more than ``hot_rows`` rows are
    split off and scored from distributed ranks instead, with equal results.
    """
    keys = depth_keyed(SCORE_KEY)
    keyed = with_depth_keys(
        forecasts.where(F.col("prediction").isNotNull()).withColumn(
            "family", sample_family(F.col("family"))
        )
    )
    work = work_list(keyed, targets, scores, extra_groups)
    shared = shared_groups(keyed, targets, extra_groups)

    def joined(rows: DataFrame, listed: DataFrame) -> DataFrame:
        rows = rows.join(sized(listed), keys)
        for c in shared:
            rows = rows.where(F.col(c).eqNullSafe(F.col(f"_seen_{c}"))).drop(f"_seen_{c}")
        return rows

    crowded = work.where(F.col("n_rows") > hot_rows).drop("n_rows")
    if crowded.isEmpty():
        return score_in_rows(joined(keyed, work.drop("n_rows")), summaries, extra_groups)
    usual = work.where(F.col("n_rows") <= hot_rows).drop("n_rows")
    kept_out = sized(crowded.select(*keys).distinct())
    rows = joined(keyed.join(kept_out, keys, "left_anti"), usual)
    hot = joined(keyed, crowded)
    chance = F.col("family") == "bernoulli"
    return (
        score_in_rows(rows, summaries, extra_groups)
        .unionByName(score_by_rank(hot.where(~chance), summaries, extra_groups))
        .unionByName(score_probabilities(hot.where(chance), summaries, extra_groups))
    )


def score_joined(joined: DataFrame, summaries: bool = True) -> DataFrame:
    """Score an already joined table of forecasts with their ``observation``."""
    named = joined.withColumn("family", sample_family(F.col("family")))
    return score_in_rows(with_depth_keys(named), summaries)


def _group_keys(joined: DataFrame, extra_groups: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    groups = existing(joined, list(dict.fromkeys([*GROUPING, *extra_groups])))
    return groups, [*groups, *existing(joined, DEPTH_KEYS), "observation"]


def _finish(scored: DataFrame, groups: Sequence[str], summaries: bool) -> DataFrame:
    chosen = SUMMARIES if summaries else []
    return scored.select(*groups, "observation", "crps", "logs", *[F.col(f"`{c}`") for c in chosen])


def _chance_columns(p: Column, y: Column) -> dict[str, Column]:
    return {
        "crps": S.bernoulli_crps(p, y),
        "logs": S.bernoulli_log_score(p, y),
        "mean": p,
        "sd": F.sqrt(p * (F.lit(1.0) - p)),
        **{name: S.bernoulli_quantile(p, q) for name, q in S.QUANTILES.items()},
    }


def score_in_rows(
    joined: DataFrame, summaries: bool = True, extra_groups: Sequence[str] = ()
) -> DataFrame:
    """Score ensembles that fit in a row: one aggregate, then array expressions."""
    groups, keys = _group_keys(joined, extra_groups)
    members = joined.groupBy(*keys).agg(
        F.sort_array(F.collect_list("prediction")).alias("xs"),
        F.avg("prediction").alias("mean"),
        F.stddev_samp("prediction").alias("sd"),
    )
    xs, y = F.col("xs"), F.col("observation")
    sample = {
        "crps": S.sorted_crps(xs, y),
        "logs": S.sorted_log_score(xs, y, F.col("sd")),
        "mean": F.col("mean"),
        "sd": F.col("sd"),
        **{name: S.sorted_quantile(xs, q) for name, q in S.QUANTILES.items()},
    }
    chance = _chance_columns(F.get(xs, F.lit(0)), y)
    wanted = list(sample) if summaries else ["crps", "logs"]
    scored = members.select(
        *groups,
        y,
        *[
            F.when(F.col("family") == "bernoulli", chance[n]).otherwise(sample[n]).alias(n)
            for n in wanted
        ],
    )
    return _finish(scored, groups, summaries)


def score_probabilities(
    joined: DataFrame, summaries: bool = True, extra_groups: Sequence[str] = ()
) -> DataFrame:
    """Score event probabilities: one probability per group, whatever its copies."""
    groups, keys = _group_keys(joined, extra_groups)
    p = joined.groupBy(*keys).agg(F.min("prediction").alias("_p"))
    return _finish(p.withColumns(_chance_columns(F.col("_p"), F.col("observation"))), groups, summaries)


def score_by_rank(
    joined: DataFrame, summaries: bool = True, extra_groups: Sequence[str] = ()
) -> DataFrame:
    """Score ensembles of any size from ranked values, with partial aggregates only."""
    groups, keys = _group_keys(joined, extra_groups)
    ranked = ranked_values(joined, keys, "prediction")
    spread = joined.groupBy(*keys).agg(
        F.avg("prediction").alias("mean"), F.stddev_samp("prediction").alias("sd")
    )
    x, y, copies, upto, m = (
        F.col("prediction"),
        F.col("observation"),
        F.col("copies"),
        F.col("upto"),
        F.col("members"),
    )

    def order_statistic(position: Column) -> Column:
        return F.max(F.when((position >= upto - copies) & (position < upto), x))

    wanted = {**S.QUANTILES, "_q25": 0.25, "_q75": 0.75}
    place = {n: (m - 1) * F.lit(float(q)) for n, q in wanted.items()}
    sums = ranked.groupBy(*keys, "members").agg(
        F.sum(copies * F.abs(x - y)).alias("_distance"),
        F.sum(copies * x * (upto * 2 - copies - m)).alias("_spread"),
        F.min(F.abs(x - y)).alias("_nearest"),
        *[order_statistic(F.floor(h)).alias(f"{n}_low") for n, h in place.items()],
        *[order_statistic(F.ceil(h)).alias(f"{n}_high") for n, h in place.items()],
    )
    quantiles = {
        n: F.col(f"`{n}_low`")
        + (h - F.floor(h)) * (F.col(f"`{n}_high`") - F.col(f"`{n}_low`"))
        for n, h in place.items()
    }
    stats = join_null_safe(sums.withColumns(quantiles), spread, keys).withColumn(
        "_width", S.bandwidth(F.col("sd"), F.col("_q75") - F.col("_q25"), m)
    )
    power = lambda d: F.lit(-0.5) * (d / F.col("_width")) * (d / F.col("_width"))
    kernel = (
        join_null_safe(
            ranked.drop("members"), stats.select(*keys, "_width", "_nearest"), keys
        )
        .groupBy(*keys)
        .agg(F.sum(copies * F.exp(power(y - x) - power(F.col("_nearest")))).alias("_kernel"))
    )
    scored = join_null_safe(stats, kernel, keys).withColumns(
        {
            "crps": S.crps_from_sums(F.col("_distance"), F.col("_spread"), m),
            "logs": S.log_score_from_sum(
                F.col("_kernel"), power(F.col("_nearest")), F.col("_width"), m
            ),
        }
    )
    return _finish(scored, groups, summaries)
