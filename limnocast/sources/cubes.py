"""Weather cubes stored so that a cell is found without reading them: axes beside the data, rows clustered by cell and time."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LATITUDE, LONGITUDE = "latitude", "longitude"


def write_cube(grid: DataFrame, path: str, time: str, mode: str = "error", files: int | None = None, **options) -> None:
    """Store a cube whose ``time`` column is its issue or analysis time; ``mode="append"`` adds to one.

    Rows are range-partitioned and sorted by cell and time, so the statistics of files and row groups tell a
    lookup which to skip. The distinct coordinates of each axis go to a small table beside it, written after the rows: what the
    axes name is there. ``options`` go to the Parquet writer.
    """
    order = [LATITUDE, LONGITUDE, time]
    placed = grid.repartitionByRange(files, *order) if files else grid.repartitionByRange(*order)
    placed.sortWithinPartitions(*order).write.mode(mode).options(**options).parquet(path)
    kind = dict(grid.dtypes)[time]
    entries = F.array(
        *[F.struct(F.lit(a).alias("axis"), F.col(a).cast("double").alias("at"), F.lit(None).cast(kind).alias("instant")) for a in order[:2]],
        F.struct(F.lit(time).alias("axis"), F.lit(None).cast("double").alias("at"), F.col(time).alias("instant")),
    )
    axes = grid.select(*order).select(F.inline(entries)).distinct()
    axes.write.mode(mode).parquet(axes_path(path))


def axes_path(path: str) -> str:
    return path.rstrip("/") + "_axes"


@dataclass(frozen=True)
class Cube:
    """A stored cube; see ``write_cube``."""

    spark: SparkSession
    path: str

    @property
    def rows(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    @property
    def columns(self) -> list[str]:
        return self.rows.columns

    def axis(self, name: str) -> DataFrame:
        """Distinct coordinates of an axis, from the table of axes."""
        value = "at" if name in (LATITUDE, LONGITUDE) else "instant"
        axes = self.spark.read.parquet(axes_path(self.path))
        return axes.where((F.col("axis") == name) & F.col(value).isNotNull()).select(F.col(value).alias(name)).distinct()

    def nearest(self, name: str, wanted: float) -> float | None:
        """The coordinate closest to ``wanted``; of two equally close the larger."""
        distance = F.struct(F.abs(F.col(name) - F.lit(wanted)), -F.col(name))
        return self.axis(name).agg(F.min_by(name, distance)).first()[0]

    def cell(self, lon: float, lat: float) -> DataFrame:
        """Rows of the cell nearest to a point, each axis chosen on its own.

        Coordinates come from the axes as plain values, so the scan of the cube skips what cannot hold them.
        """
        at = {LATITUDE: self.nearest(LATITUDE, lat), LONGITUDE: self.nearest(LONGITUDE, lon)}
        rows = self.rows
        if None in at.values():
            return rows.limit(0)
        for name, value in at.items():
            rows = rows.where(F.col(name) == F.lit(value))
        return rows
