"""Depth profiles: gathering them, and the diagnostics of each."""

from __future__ import annotations

import inspect
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from limnocast.functions import water as P
from limnocast.functions.keys import existing, let
from limnocast.operators.reshape import depths_wide

PROFILE_KEY = [
    "site_id",
    "model_id",
    "reference_datetime",
    "datetime",
    "parameter",
    "pub_datetime",
]
METRICS = ["Ws", "M1", "M2", "eta", "m_ratio", "z_therm", "z_n2", "n2_max", "b_var"]
# Stands for the points of a profile that are no peak.
NO_PEAK = -1
# Below this a spread of density counts as none, and ratios to it are null.
FLAT = 1e-9
# Rows of a caller's function that are handed back to Spark together.
ROWS_OUT = 10_000


def gather_profiles(forecasts: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """One row per member and time with its (depth, temperature) points in depth order.

    Copies and repeated depths are averaged before they travel, whatever depths there are; a profile then gathers
    one point for each of its depths, of which a model has a few.
    """
    keys = list(keys or existing(forecasts, PROFILE_KEY))
    rows = forecasts.where(
        (F.col("variable") == "temperature")
        & F.col("depth").isNotNull()
        & F.col("prediction").isNotNull()
    )
    points = rows.groupBy(*keys, "depth").agg(F.avg("prediction").alias("temperature"))
    return points.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("depth", "temperature"))).alias("points")
    )


def resample_profiles(profiles: DataFrame, hypsography: P.Hypsography, dz: float = 0.1) -> DataFrame:
    """One row per profile and grid point ``z = i * dz``: temperature, density, lake area.

    Temperature is linear between points and flat beyond both ends. ``rho_at`` also holds
    the densities one point up and one and two points down, so that layers need no window.
    Every point explodes to the grid points up to the next one: generated rows
    stay in compiled code and in the partition of their profile.
    """
    keys = [c for c in profiles.columns if c != "points"]
    deepest = max(float(d) for d, _ in hypsography)
    areas = P.grid_areas(hypsography, dz)
    last = F.get("points", F.size("points") - 1)["depth"]
    points = profiles.select(
        *keys,
        P.grid_steps(F.greatest(last, F.lit(deepest)), dz).alias("steps"),
        "points",
        F.posexplode("points").alias("k", "p"),
    )
    i, k, p, steps = F.col("i"), F.col("k"), F.col("p"), F.col("steps")
    o, q, r = F.get("points", k - 1), F.get("points", k + 1), F.get("points", k + 2)

    def index(point: Column) -> Column:
        return P.first_index(point["depth"], steps, dz)

    start = F.when(k == 0, F.lit(0)).otherwise(index(p))
    end = F.when(q.isNull(), steps + 1).otherwise(index(q))
    grid = points.select(
        *keys,
        "steps",
        "points",
        "k",
        "p",
        start.alias("start"),
        end.alias("end"),
        F.explode(F.when(end > start, F.sequence(start, end - 1))).alias("i"),
    )

    def temperature_at(offset: int) -> Column:
        """Temperature at a neighbouring grid point, which mostly lies in this or the next gap."""
        j = i + offset
        z = j * F.lit(dz)
        # Only where several points lie between two grid points is there anything to search.
        above = F.filter("points", lambda x: index(x) <= j)
        searched = let(
            F.greatest(F.size(above), F.lit(1)),
            lambda n: P.between(F.get("points", n - 1), F.get("points", n), z),
        )
        return (
            F.when((j < 0) | (j > steps), F.lit(None).cast("double"))
            .when((j >= F.col("start")) & (j < F.col("end")), P.between(p, q, z))
            .when((j >= F.col("end")) & (r.isNull() | (j < index(r))), P.between(q, r, z))
            .when((j < F.col("start")) & ((k == 1) | (j >= index(o))), P.between(o, p, z))
            .otherwise(searched)
        )

    def rho_at(offset: int) -> Column:
        return P.water_density(F.col(f"t{offset}"))

    return grid.select(
        *keys,
        "steps",
        "i",
        (i * F.lit(dz)).alias("z"),
        P.grid_area(areas, i).alias("area"),
        F.get("points", F.lit(0))["temperature"].alias("surface"),
        *[temperature_at(n).alias(f"t{n}") for n in (-1, 0, 1, 2)],
    ).select(
        *keys,
        "steps",
        "i",
        "z",
        "area",
        P.water_density(F.col("surface")).alias("surface_rho"),
        F.col("t0").alias("temperature"),
        rho_at(0).alias("rho"),
        rho_at(-1).alias("rho_above"),
        rho_at(1).alias("rho_below"),
        rho_at(2).alias("rho_second"),
    )


def _layers(resampled: DataFrame, dz: float) -> DataFrame:
    """Add the layer below each grid point: gradient, buoyancy, and whether it stands out.

    A layer stands out when it is steeper than the one above and no less steep than the
    one below, or is the first or last: a handful per profile, the steepest among them.
    """
    c, i = F.col, F.col("i")
    up = P.density_gradient(c("rho_above"), c("rho"), i - 1, dz)
    here = P.density_gradient(c("rho"), c("rho_below"), i, dz)
    down = P.density_gradient(c("rho_below"), c("rho_second"), i + 1, dz)
    stands_out = (F.coalesce(c("here") > c("up"), F.lit(True))) & (
        F.coalesce(c("here") >= c("down"), F.lit(True))
    )
    return (
        resampled.withColumns({"up": up, "here": here, "down": down})
        .withColumns(
            {
                "n2": P.buoyancy_frequency(c("rho"), c("here")),
                "peak": F.when(c("here").isNotNull() & stands_out, i).otherwise(NO_PEAK),
            }
        )
        .withColumn("peak_depth", F.when(c("peak") >= 0, P.layer_depth(c("up"), c("here"), c("down"), i, dz)))
        .drop("up", "down", "rho_above", "rho_second")
    )


GRID_COLUMNS = [
    "steps",
    "i",
    "z",
    "area",
    "surface_rho",
    "temperature",
    "rho",
    "rho_above",
    "rho_below",
    "rho_second",
]


def profile_integrals(
    resampled: DataFrame, dz: float = 0.1, integral: str = "area", clip_negative: bool = False
) -> DataFrame:
    """One row per profile: integrals over the lake, moments, and the layers.

    Everything is a sum or maximum over grid points, so rows are combined as they are
    generated: to one row for each of a profile's few peaks, and one for all other points. Those are numbers of fixed
    width, which stay in generated code; only the handful of rows left of a profile is gathered.
    Densities are taken relative to the surface, which keeps small differences exact.
    """
    keys = [c for c in resampled.columns if c not in GRID_COLUMNS]
    c = F.col
    z, a, n2 = c("z"), c("area"), c("n2")
    x = c("rho") - c("surface_rho")
    w = P.slice_width(c("i"), c("steps"), dz, integral)
    middle = (c("i") + F.lit(0.5)) * F.lit(dz)
    if clip_negative:
        n2 = F.greatest(n2, F.lit(0.0))
    highest = {"surface_rho": c("surface_rho"), "steps": c("steps"), "warmest": c("temperature"), "top_area": a, "n2_max": c("n2")}
    added = {
        "volume": w * a,
        "volume_z": w * a * z,
        "excess": w * a * x,
        "excess_z": w * a * z * x,
        "weight": a,
        "a_z": a * z,
        "a_zz": a * z * z,
        "a_x": a * x,
        "a_zx": a * z * x,
        "a_zzx": a * z * z * x,
        "a_xx": a * x * x,
        "n2_sum": n2,
        "n2_moment": n2 * middle,
    }
    parts = _layers(resampled, dz).groupBy(*keys, "peak").agg(
        *[F.max(e).alias(n) for n, e in highest.items()],
        *[F.sum(e).alias(n) for n, e in added.items()],
        F.min("temperature").alias("coldest"),
        F.max(F.when(c("peak") >= 0, c("here"))).alias("g"),
        F.max("peak_depth").alias("depth"),
    )
    layer = F.struct(c("peak").alias("i"), "g", "depth")
    sums = parts.groupBy(*keys).agg(
        *[F.max(n).alias(n) for n in highest],
        *[F.sum(n).alias(n) for n in added],
        F.min("coldest").alias("coldest"),
        F.collect_list(F.when(c("peak") >= 0, layer)).alias("peaks"),
    )
    mass = c("volume") * c("surface_rho") + c("excess")
    z_volume = c("volume_z") / c("volume")
    return sums.withColumns(
        {
            "mass": mass,
            "z_volume": z_volume,
            "z_gravity": z_volume + (c("excess_z") - z_volume * c("excess")) / mass,
            "rho_mean": c("surface_rho") + c("excess") / c("volume"),
            "z_mean": c("volume") / c("top_area"),
        }
    )


def profile_metrics(
    forecasts: DataFrame,
    hypsography: P.Hypsography,
    dz: float = 0.1,
    g: float = 9.81,
    integral: str = "area",
    clip_negative: bool = False,
    keys: Sequence[str] | None = None,
) -> DataFrame:
    """Nine physical diagnostics of each temperature profile, one row per profile."""
    keys = list(keys or existing(forecasts, PROFILE_KEY))
    resampled = resample_profiles(gather_profiles(forecasts, keys), hypsography, dz)
    c = F.col
    # Moments about the means, expanded so that one pass over the grid gives the sums.
    v, r, w = c("z_volume"), c("excess") / c("volume"), c("weight")
    m1 = (c("a_zx") - v * c("a_x") - r * (c("a_z") - v * w)) / w
    m2 = (
        c("a_zzx")
        - v * c("a_zx") * 2
        + v * v * c("a_x")
        - r * (c("a_zz") - v * c("a_z") * 2 + v * v * w)
    ) / w
    var_rho = (c("a_xx") - r * c("a_x") * 2 + r * r * w) / w
    var_z = (c("a_zz") - v * c("a_z") * 2 + v * v * w) / w
    sums = profile_integrals(resampled, dz, integral, clip_negative).withColumns(
        {
            "M1": m1,
            "M2": m2,
            "var_rho": F.greatest(var_rho, F.lit(0.0)),
            "scale": F.sqrt(F.greatest(var_rho, F.lit(0.0))) * F.sqrt(var_z),
        }
    )
    return sums.select(
        *keys,
        (F.lit(g) * c("z_mean") * c("rho_mean") * (c("z_gravity") - c("z_volume"))).alias("Ws"),
        "M1",
        "M2",
        F.when(c("scale") > FLAT, c("M1") / c("scale")).alias("eta"),
        F.when(F.abs(c("M1")) > FLAT, c("M2") / c("M1")).alias("m_ratio"),
        P.thermocline_depth(
            c("warmest") - c("coldest"), c("peaks"), c("steps")
        ).alias("z_therm"),
        F.when(F.abs(c("n2_sum")) > 1e-12, c("n2_moment") / c("n2_sum")).alias("z_n2"),
        "n2_max",
        (c("var_rho") * F.lit(9.81 * 9.81) / (c("rho_mean") * c("rho_mean"))).alias("b_var"),
    )


def mixing_probability(
    forecasts: DataFrame,
    top: float = 0.5,
    bottom: float = 5.0,
    threshold: float = 0.1,
    keys: Sequence[str] | None = None,
) -> DataFrame:
    """Share of members whose density differs by less than ``threshold`` between depths.

    A member that lacks one of the depths leaves the whole probability null.
    """
    member = list(keys or existing(forecasts, PROFILE_KEY))
    group = [k for k in member if k != "parameter"]
    pairs = depths_wide(
        forecasts.where(F.col("variable") == "temperature").select(*member, "depth", "prediction"),
        {"upper": top, "lower": bottom},
    )
    mixed = (P.water_density(F.col("lower")) - P.water_density(F.col("upper")) < threshold).cast("int")
    share = F.when(F.count(mixed) == F.count(F.lit(1)), F.sum(mixed) / F.count(F.lit(1)).cast("double"))
    return pairs.groupBy(*group).agg(share.alias("prediction"))


def per_profile(forecasts: DataFrame, function, schema, keys: Sequence[str] | None = None) -> DataFrame:
    """Caller-supplied metrics: a pandas function applied to each profile.

    ``function`` takes the profile, or the tuple of its key values and the profile: a frame with a row for each depth.
    It returns a frame, or, for a single row, a tuple in the order of ``schema``, which costs far less than a frame.
    Many profiles cross to Python at once and are told apart there, so none pays for a transfer of its own.
    """
    keys = list(keys or existing(forecasts, PROFILE_KEY))
    schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    profiles = gather_profiles(forecasts, keys).withColumn("_profile", F.monotonically_increasing_id())
    # Beside a null, pandas would turn whole numbers into floats; so nulls of such keys travel as flags.
    kinds = {k: profiles.schema[k].dataType for k in keys}
    flagged = {k: t for k, t in kinds.items() if isinstance(t, (T.IntegralType, T.BooleanType))}
    points = profiles.select(
        *[F.coalesce(k, F.lit(0).cast(flagged[k])).alias(k) if k in flagged else F.col(f"`{k}`") for k in keys],
        *[F.col(f"`{k}`").isNull().alias(f"_null_{k}") for k in flagged],
        "_profile",
        F.inline("points"),
    )
    absent = {k: None if isinstance(t, T.BooleanType) else np.nan for k, t in flagged.items()}
    return points.mapInPandas(_each_profile(function, schema.fieldNames(), keys, absent), schema)


def _each_profile(function, names: list[str], keys: list[str], absent: dict):
    """A function of batches of points that calls ``function`` on every profile; ``absent`` stands for null keys.

    All parts are nested, so that they travel by value: executors need not have this package.
    """
    with_key = len(inspect.getfullargspec(function).args) == 2

    def whole_profiles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Blocks of whole profiles; the last profile of a batch may go on in the next."""
        held: list[pd.DataFrame] = []
        for batch in batches:
            if batch.empty:
                continue
            ids = batch["_profile"].to_numpy()
            last = int(np.searchsorted(ids, ids[-1]))
            if held and (last or held[-1]["_profile"].iloc[-1] != ids[0]):
                yield pd.concat([*held, batch.iloc[:last]], ignore_index=True)
                held = []
            elif last:
                yield batch.iloc[:last]
            held.append(batch.iloc[last:])
        if held:
            yield pd.concat(held, ignore_index=True)

    def check_names(result: pd.DataFrame) -> None:
        """As Spark does: by name where a label is text, else by place."""
        labels = list(result.columns)
        named = any(isinstance(label, str) for label in labels)
        if set(labels) != set(names) if named else len(labels) != len(names):
            raise ValueError(f"columns {names} expected, not {labels}")

    def together(results: list) -> pd.DataFrame:
        if isinstance(results[0], pd.DataFrame):
            return pd.concat(results, ignore_index=True)
        columns = {n: pd.Series(list(v), dtype=object) for n, v in zip(names, zip(*results, strict=True), strict=True)}
        # Only times are given a type of their own; whole numbers beside a null would become floats.
        times = {n: c.infer_objects() for n, c in columns.items()}
        return pd.DataFrame({n: times[n] if times[n].dtype.kind == "M" else c for n, c in columns.items()})

    def results(block: pd.DataFrame) -> Iterator:
        ids = block["_profile"].to_numpy()
        starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
        nulls = {k: block[f"_null_{k}"].to_numpy() for k in absent}
        body = block[[*keys, "depth", "temperature"]]
        firsts = zip(*[list(body[k].iloc[starts].array) for k in keys], strict=True)
        for key, a, b in zip(firsts, starts, [*starts[1:], len(ids)], strict=True):
            profile = body.iloc[a:b].reset_index(drop=True)
            for k in absent:
                if nulls[k][a]:
                    profile[k] = absent[k]
                    key = tuple(absent[k] if name == k else v for name, v in zip(keys, key, strict=True))
            yield function(key, profile) if with_key else function(profile)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in whole_profiles(batches):
            alike, kind, rows = [], None, 0
            for result in results(block):
                if isinstance(result, pd.DataFrame):
                    if result.empty and not len(result.columns):
                        continue
                    check_names(result)
                    this, size = (tuple(result.columns), tuple(result.dtypes)), len(result)
                elif isinstance(result, tuple):
                    if len(result) != len(names):
                        raise ValueError(f"a row of {len(names)} values expected, not {len(result)}")
                    this, size = "rows", 1
                else:
                    raise TypeError(f"a frame or a tuple expected, not {type(result).__name__}")
                # Frames of other types are not put together: that could change values.
                if alike and (this != kind or rows >= ROWS_OUT):
                    yield together(alike)
                    alike, rows = [], 0
                alike.append(result)
                kind, rows = this, rows + size
            if alike:
                yield together(alike)

    return run
