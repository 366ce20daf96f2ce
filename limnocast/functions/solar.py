"""Solar geometry as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

SOLAR_CONSTANT = 1366.0


def equation_of_time(doy: Column) -> Column:
    """Hours the sun runs ahead of the clock on a day of the year."""

    # Published series, seconds of time.
    def series(f: Column) -> Column:
        return (
            F.lit(-104.7) * F.sin(f)
            + F.lit(596.2) * F.sin(f * 2.0)
            + F.lit(4.3) * F.sin(f * 4.0)
            - F.lit(429.3) * F.cos(f)
            - F.lit(2.0) * F.cos(f * 2.0)
            + F.lit(19.3) * F.cos(f * 3.0)
        ) / F.lit(3600.0)

    return series(F.lit(math.pi / 180.0) * (F.lit(279.5) + F.lit(0.9856) * doy))


def cos_zenith(doy: Column, lon: float, lat: float, step_hours: float = 0.0) -> Column:
    """Cosine of the solar zenith angle, 0 below the horizon.

    ``step_hours`` is the sampling step; the angle is taken at the middle of the bin.
    """
    meridian = math.floor(lon / 15.0) * 15.0
    if meridian < 0:
        meridian += 15.0
    longitude_correction = (lon - meridian) * -4.0 / 60.0
    zone_hours = meridian / 360.0 * 24.0
    clock = (doy - F.floor(doy)) * F.lit(24.0)
    noon = F.lit(12.0 + longitude_correction - zone_hours - 0.5 * step_hours) - equation_of_time(doy)
    hour_angle = F.lit(math.pi / 12.0) * (clock - noon)
    declination = F.lit(-23.45 * math.pi / 180.0) * F.cos(
        F.lit(2.0 * math.pi) * (doy + 10.0) / F.lit(365.0)
    )
    phi = lat * math.pi / 180.0
    cosine = F.lit(math.sin(phi)) * F.sin(declination) + F.lit(math.cos(phi)) * F.cos(
        declination
    ) * F.cos(hour_angle)
    return F.greatest(cosine, F.lit(0.0))


def potential_radiation(doy: Column, lon: float, lat: float, step_hours: float = 0.0) -> Column:
    """Radiation at the top of the air in W/m2."""
    return F.lit(SOLAR_CONSTANT) * cos_zenith(doy, lon, lat, step_hours)


def eastern_longitude(lon: float) -> float:
    """Longitude on the 0 to 360 scale."""
    return lon + 360.0 if lon < 0 else lon


def longwave_estimate(air_temperature: Column) -> Column:
    """Grey-body radiation of the air from its temperature in K."""
    # Emissivity and the Stefan-Boltzmann constant.
    return F.lit(0.97) * F.lit(5.67e-8) * F.pow(air_temperature, F.lit(4.0))
