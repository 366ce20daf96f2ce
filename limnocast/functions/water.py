"""Water physics on an even depth grid ``z = i * dz``, as column expressions."""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from limnocast.functions.keys import let

Hypsography = Sequence[tuple[float, float]]


def water_density(temperature: Column) -> Column:
    """Density of fresh water in kg/m3 from temperature in C."""
    # Published density polynomial.
    t = temperature
    return F.lit(1000.0) * (
        F.lit(1.0)
        - (t + 288.9414) * (t - 3.9863) * (t - 3.9863) / (F.lit(508929.2) * (t + 68.12963))
    )


def grid_steps(max_depth: Column, dz: float) -> Column:
    """Number of whole steps of ``dz`` from the surface to ``max_depth``."""
    return F.floor(max_depth / F.lit(dz) + F.lit(1e-10)).cast("int")


def grid_areas(hypsography: Hypsography, dz: float) -> list[float]:
    """Lake area at every grid depth down to the deepest hypsography point."""
    points = sorted((float(d), float(a)) for d, a in hypsography)
    depths = [d for d, _ in points]
    steps = math.floor(depths[-1] / dz + 1e-10)
    areas = []
    for i in range(steps + 1):
        z = i * dz
        k = bisect_right(depths, z)
        if k == 0:
            areas.append(points[0][1])
        elif k == len(points):
            areas.append(points[-1][1])
        else:
            (d0, a0), (d1, a1) = points[k - 1], points[k]
            areas.append(a0 + (a1 - a0) * (z - d0) / (d1 - d0))
    return areas


def grid_area(areas: Sequence[float], i: Column) -> Column:
    """Area at grid point ``i``; below the deepest known point the last area holds."""
    return F.get(F.array(*[F.lit(float(a)) for a in areas]), F.least(i, F.lit(len(areas) - 1)))


def first_index(depth: Column, steps: Column, dz: float) -> Column:
    """First grid point at or below a depth, one past the grid when there is none."""
    index = F.ceil(depth / F.lit(dz) - F.lit(1e-10)).cast("int")
    return F.greatest(F.lit(0), F.least(index, steps + F.lit(1)))


def between(p: Column, q: Column, z: Column) -> Column:
    """Temperature at depth ``z`` on the line from point p to point q, flat without q."""
    run = (q["temperature"] - p["temperature"]) * (z - p["depth"]) / (q["depth"] - p["depth"])
    return F.when(q.isNull() | (z <= p["depth"]), p["temperature"]).otherwise(p["temperature"] + run)


def slice_width(i: Column, steps: Column, dz: float, integral: str = "area") -> Column:
    """Weight of grid point ``i`` in an integral by the trapezoid rule.

    ``"depth"`` integrates over depth. ``"area"`` integrates depth over the change of
    the integrand, ``-sum(dx * mean z)``, which is the depth integral less the bottom
    depth times the integrand there.
    """
    if integral not in ("area", "depth"):
        raise ValueError(f"unknown integral {integral}")
    half = F.lit(dz / 2.0)
    bottom = half if integral == "depth" else half - steps * F.lit(dz)
    return F.when(i == 0, half).when(i == steps, bottom).otherwise(F.lit(dz))


def density_gradient(rho: Column, rho_below: Column, i: Column, dz: float) -> Column:
    """Density change per metre from grid point ``i`` to the next."""
    return (rho_below - rho) / ((i + F.lit(1)) * F.lit(dz) - i * F.lit(dz))


def buoyancy_frequency(rho: Column, gradient: Column, g: float = 9.81) -> Column:
    """Squared buoyancy frequency of a layer."""
    return F.lit(g) / rho * gradient


def layer_depth(up: Column, here: Column, down: Column, i: Column, dz: float) -> Column:
    """Depth within layer ``i``, pulled from its middle towards the steeper neighbour.

    ``up`` and ``down`` are the gradients of the layers above and below. Without one of
    them, or level with one, the middle of the layer is taken.
    """
    upper, lower = i * F.lit(dz), (i + F.lit(1)) * F.lit(dz)
    upper_before = (i - F.lit(1)) * F.lit(dz)
    slope_down = -(lower - upper) / F.nullif(down - here, F.lit(0.0))
    slope_up = (upper - upper_before) / F.nullif(here - up, F.lit(0.0))
    total = F.nullif(slope_down + slope_up, F.lit(0.0))
    return F.coalesce(
        lower * (slope_down / total) + upper * (slope_up / total), (upper + lower) / F.lit(2.0)
    )


def thermocline_depth(
    temperature_range: Column,
    peaks: Column,
    layers: Column,
    min_gradient: float = 0.1,
    peak_share: float = 0.15,
    mixed_range: float = 1.0,
) -> Column:
    """Depth of the seasonal thermocline, null for a mixed profile.

    ``peaks`` is the array of layers that stand out from their neighbours, as structs of
    ``i``, ``g`` and ``depth``. The steepest of them (the shallowest, if equal) marks a
    thermocline; the deepest inner one steeper than
    ``max(peak_share * steepest, min_gradient)`` replaces it when it lies more than one
    layer below.
    """
    inner = lambda x: (x["i"] > 0) & (x["i"] < layers - 1)

    def choose(steepest: Column) -> Column:
        cut = F.greatest(F.lit(peak_share) * steepest["g"], F.lit(min_gradient))
        deepest = F.array_max(F.filter(peaks, lambda x: inner(x) & (x["g"] > cut)))
        return let(
            deepest,
            lambda p: F.when(
                p["i"] > steepest["i"] + F.lit(1), F.greatest(p["depth"], steepest["depth"])
            ).otherwise(steepest["depth"]),
        )

    by_gradient = F.array_max(
        F.transform(
            peaks,
            lambda x: F.struct(
                x["g"].alias("g"), (-x["i"]).alias("order"), x["i"].alias("i"), x["depth"].alias("depth")
            ),
        )
    )
    return F.when(
        (temperature_range >= F.lit(mixed_range)) & (layers >= 3), let(by_gradient, choose)
    )
