"""Table layouts and the by-name conforming every derived table goes through."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


FORECAST_SCHEMA = _struct(
    reference_datetime=T.TimestampType(),
    datetime=T.TimestampType(),
    pub_datetime=T.TimestampType(),
    depth=T.DoubleType(),
    family=T.StringType(),
    parameter=T.StringType(),
    variable=T.StringType(),
    prediction=T.DoubleType(),
    forecast=T.DoubleType(),
    variable_type=T.StringType(),
    log_weight=T.DoubleType(),
    model_id=T.StringType(),
    reference_date=T.StringType(),
    site_id=T.StringType(),
)

TARGET_SCHEMA = _struct(
    site_id=T.StringType(),
    datetime=T.TimestampType(),
    duration=T.StringType(),
    variable=T.StringType(),
    depth=T.DoubleType(),
    observation=T.DoubleType(),
)

SCORE_SCHEMA = _struct(
    site_id=T.StringType(),
    datetime=T.TimestampType(),
    duration=T.StringType(),
    variable=T.StringType(),
    depth=T.DoubleType(),
    model_id=T.StringType(),
    family=T.StringType(),
    reference_datetime=T.TimestampType(),
    pub_datetime=T.TimestampType(),
    observation=T.DoubleType(),
    crps=T.DoubleType(),
    logs=T.DoubleType(),
    mean=T.DoubleType(),
    median=T.DoubleType(),
    sd=T.DoubleType(),
    **{
        "quantile97.5": T.DoubleType(),
        "quantile02.5": T.DoubleType(),
        "quantile90": T.DoubleType(),
        "quantile10": T.DoubleType(),
    },
)

MET_SCHEMA = _struct(
    site_id=T.StringType(),
    family=T.StringType(),
    parameter=T.DoubleType(),
    datetime=T.TimestampType(),
    variable=T.StringType(),
    prediction=T.DoubleType(),
)

STAGE2_SCHEMA = T.StructType([*MET_SCHEMA.fields, T.StructField("reference_datetime", T.DateType())])

FORECAST_PARTITIONS = ["site_id", "model_id", "reference_date"]
SCORE_PARTITIONS = ["site_id", "variable", "model_id"]
STAGE2_PARTITIONS = ["reference_datetime", "site_id"]
STAGE3_PARTITIONS = ["site_id"]

# Names in the gridded source -> standard names.
VARIABLE_NAMES = {
    "temperature_2m": "air_temperature",
    "relative_humidity_2m": "relative_humidity",
    "pressure_surface": "air_pressure",
    "wind_u_10m": "eastward_wind",
    "wind_v_10m": "northward_wind",
    "downward_long_wave_radiation_flux_surface": "surface_downwelling_longwave_flux_in_air",
    "downward_short_wave_radiation_flux_surface": "surface_downwelling_shortwave_flux_in_air",
    "precipitation_surface": "precipitation_flux",
}

# Variables that hold a state of the air, and those that hold a flux.
STATE_VARIABLES = [
    "air_pressure",
    "relative_humidity",
    "air_temperature",
    "eastward_wind",
    "northward_wind",
]
LONGWAVE = "surface_downwelling_longwave_flux_in_air"
SHORTWAVE = "surface_downwelling_shortwave_flux_in_air"
PRECIPITATION = "precipitation_flux"
FLUX_VARIABLES = [PRECIPITATION, LONGWAVE, SHORTWAVE]


def conform(df: DataFrame, schema: T.StructType, keep_types: tuple[str, ...] = ()) -> DataFrame:
    """Select ``schema``'s columns in order, cast them, and add absent ones as null.

    ``keep_types`` names columns that keep the type they arrive with (a timestamp
    without zone, say).
    """
    present = set(df.columns)
    return df.select(
        *[
            F.lit(None).cast(f.dataType).alias(f.name)
            if f.name not in present
            else F.col(f"`{f.name}`")
            if f.name in keep_types
            else F.col(f"`{f.name}`").cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def with_constants(df: DataFrame, **values) -> DataFrame:
    """Add constant metadata columns (site, family, variable type ...)."""
    return df.withColumns({name: F.lit(value) for name, value in values.items()})
