"""Vectors in blocks, and their int8 forms with bounds on what rounding can change."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Covers the rounding of double arithmetic beside the bounds proper, relative to the numbers involved.
SLACK = 1e-9
#: Ways that the rows of one key are spread before they meet the size of their key.
SALTS = 64


def usable(vector: str | Column) -> Column:
    """True for vectors without null or non-finite components that are not empty, zero or null."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(sound & F.exists(vector, lambda x: x != 0), F.lit(False))


def with_sizes(rows: DataFrame, sizes: DataFrame, keys: list[str], mix: str) -> DataFrame:
    """``rows`` joined to ``sizes``, one row per ``keys``, so that a key with most of the rows is spread by ``mix``."""
    salted = sizes.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("_salt", F.pmod(F.xxhash64(mix), F.lit(SALTS)).cast("int")).join(salted, [*keys, "_salt"]).drop("_salt")


def blocked(rows: DataFrame, keys: list[str], longs: list[str], vector: str) -> DataFrame:
    """One row per group of ``keys``: the ``longs`` and the vectors of its rows as bytes.

    Groups must be of bounded size; vectors of a group have one length.
    """
    kind = "<f4" if dict(rows.dtypes)[vector] == "array<float>" else "<f8"

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(longs, kind="stable")
        out = {k: [group[k].iloc[0]] for k in keys}
        out |= {c: [group[c].to_numpy(np.int64).tobytes()] for c in longs}
        out[vector] = [np.stack(group[vector].to_list()).astype(kind).tobytes()]
        return pd.DataFrame(out | {"kind": [kind]})

    kinds = dict(rows.dtypes)
    schema = [*(f"{k} {kinds[k]}" for k in keys), *(f"{c} binary" for c in longs), f"{vector} binary", "kind string"]
    return rows.select(*keys, *longs, vector).groupBy(*keys).applyInPandas(run, ", ".join(schema))


def longs_of(block: bytes) -> np.ndarray:
    return np.frombuffer(block, np.int64)


def vectors_of(block: bytes, kind: str, number: int) -> np.ndarray:
    return np.frombuffer(block, kind).reshape(number, -1).astype(np.float64)


@dataclass(frozen=True)
class Rounded:
    """``scale * whole`` stands for each vector, off by a vector of length ``error`` at most."""

    whole: np.ndarray
    scale: np.ndarray
    norm: np.ndarray
    error: np.ndarray

    @staticmethod
    def of(vectors: np.ndarray) -> Rounded:
        scale = np.abs(vectors).max(axis=1) / 127
        scale[scale == 0] = 1
        whole = np.rint(vectors / scale[:, None])
        near = whole * scale[:, None]
        # Products of int8 values of up to about a thousand components are whole numbers that float32 holds exactly.
        kind = np.float32 if vectors.shape[1] <= 1024 else np.float64
        error = np.sqrt(((vectors - near) ** 2).sum(axis=1)) * (1 + SLACK)
        return Rounded(whole.astype(np.int8).astype(kind), scale, np.sqrt((near**2).sum(axis=1)), error)

    def dots(self, other: Rounded) -> np.ndarray:
        """Products of the rounded vectors, a tile of ``len(self)`` by ``len(other)``."""
        return (self.whole @ other.whole.T) * self.scale[:, None] * other.scale[None, :]
