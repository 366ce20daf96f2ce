"""Proper scores and summaries of one ensemble held as a sorted array."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from limnocast.functions.keys import let

# Column name -> probability. The 90 and 10 columns hold the bounds of the central
# 90 % interval, that is the 95 % and 5 % quantiles.
QUANTILES = {
    "median": 0.5,
    "quantile97.5": 0.975,
    "quantile02.5": 0.025,
    "quantile90": 0.95,
    "quantile10": 0.05,
}
LOG_ROOT_TWO_PI = 0.5 * math.log(2.0 * math.pi)


def sorted_quantile(xs: Column, p: float) -> Column:
    """Quantile of a sorted array, linear between order statistics."""
    return let(
        (F.size(xs) - 1) * F.lit(float(p)),
        lambda h: F.get(xs, F.floor(h).cast("int"))
        + (h - F.floor(h))
        * (F.get(xs, F.ceil(h).cast("int")) - F.get(xs, F.floor(h).cast("int"))),
    )


def sorted_crps(xs: Column, y: Column) -> Column:
    """Sample CRPS: mean distance to the observation less half the mean member distance."""
    m = F.size(xs)
    zero = F.struct(
        F.lit(1).alias("rank"), F.lit(0.0).alias("distance"), F.lit(0.0).alias("spread")
    )
    return F.aggregate(
        xs,
        zero,
        lambda acc, x: F.struct(
            (acc["rank"] + F.lit(1)).alias("rank"),
            (acc["distance"] + F.abs(x - y)).alias("distance"),
            (acc["spread"] + x * (acc["rank"] * 2 - m - 1)).alias("spread"),
        ),
        lambda acc: crps_from_sums(acc["distance"], acc["spread"], acc["rank"] - 1),
    )


def crps_from_sums(distance: Column, spread: Column, members: Column) -> Column:
    """CRPS from ``sum |x - y|`` and ``sum x * (2 * rank - members - 1)``."""
    m = members.cast("double")
    return distance / m - spread / (m * m)


def bandwidth(sd: Column, iqr: Column, members: Column) -> Column:
    """Normal-reference kernel width; null when the ensemble has no spread."""
    width = F.lit(1.06) * F.least(sd, iqr / F.lit(1.34)) * F.pow(members.cast("double"), F.lit(-0.2))
    return F.when(width > 0, width)


def sorted_log_score(xs: Column, y: Column, sd: Column) -> Column:
    """Negative log of a Gaussian kernel density at the observation."""
    return let(
        bandwidth(sd, sorted_quantile(xs, 0.75) - sorted_quantile(xs, 0.25), F.size(xs)),
        lambda width: let(
            F.transform(xs, lambda x: F.lit(-0.5) * ((y - x) / width) * ((y - x) / width)),
            lambda powers: let(
                F.array_max(powers),
                lambda top: log_score_from_sum(
                    F.aggregate(powers, F.lit(0.0), lambda acc, e: acc + F.exp(e - top)),
                    top,
                    width,
                    F.size(xs),
                ),
            ),
        ),
    )


def log_score_from_sum(total: Column, top: Column, width: Column, members: Column) -> Column:
    """Log score from ``sum exp(e - top)`` over kernel exponents ``e`` with maximum ``top``."""
    return F.log(width) + F.lit(LOG_ROOT_TWO_PI) + F.log(members.cast("double")) - top - F.log(total)


def bernoulli_crps(p: Column, y: Column) -> Column:
    return (p - y) * (p - y)


def bernoulli_log_score(p: Column, y: Column) -> Column:
    """Infinite when the outcome was given no probability at all."""
    chance = F.when(y == 1, p).otherwise(F.lit(1.0) - p)
    return F.when(chance > 0, -F.log(chance)).when(chance <= 0, F.lit(float("inf")))


def bernoulli_quantile(p: Column, q: float) -> Column:
    return F.when(F.lit(1.0) - p >= F.lit(float(q)), F.lit(0.0)).when(p.isNotNull(), F.lit(1.0))
