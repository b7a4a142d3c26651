"""Expressions over orbital elements."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Earth radius (km), gravitational parameter (km^3/s^2), minutes per day.
EARTH_RADIUS_KM = 6371.0
EARTH_MU = 398600.4418
MINUTES_PER_DAY = 1440.0

# Limits of the orbit regimes.
GEO_ALTITUDE_KM = 35786.0
GEO_TOLERANCE_KM = 200.0
GEO_MAX_INCLINATION_DEG = 5.0
HEO_MIN_ECCENTRICITY = 0.25
LEO_MAX_APOGEE_KM = 2000.0


def mean_altitude(apogee_km: Column, perigee_km: Column) -> Column:
    return (perigee_km + apogee_km) / F.lit(2.0)


def circular_period_minutes(altitude_km: Column) -> Column:
    """Period of a circular orbit at this altitude, in minutes to 3 decimals."""
    r = F.lit(EARTH_RADIUS_KM) + altitude_km
    seconds = F.lit(2.0) * F.pi() * F.sqrt(r * r * r / F.lit(EARTH_MU))
    return F.round(seconds / F.lit(60.0), 3)


def eccentricity(apogee_km: Column, perigee_km: Column) -> Column:
    center = F.lit(EARTH_RADIUS_KM) + mean_altitude(apogee_km, perigee_km)
    return F.round(F.try_divide(apogee_km - perigee_km, F.lit(2.0) * center), 7)


def mean_motion(period_minutes: Column) -> Column:
    """Revolutions per day to 8 decimals; NULL for a zero period."""
    return F.round(F.try_divide(F.lit(MINUTES_PER_DAY), period_minutes), 8)


def regime(apogee_km: Column, perigee_km: Column, inclination_deg: Column) -> Column:
    """Exactly one of GEO, HEO, LEO, MEO or UNKNOWN; the first rule that holds wins."""

    def near_geo(altitude: Column) -> Column:
        return F.abs(altitude - F.lit(GEO_ALTITUDE_KM)) <= GEO_TOLERANCE_KM

    return (
        F.when(
            apogee_km.isNull() | perigee_km.isNull() | inclination_deg.isNull(), F.lit("UNKNOWN")
        )
        .when(
            near_geo(apogee_km)
            & near_geo(perigee_km)
            & (F.abs(inclination_deg) <= GEO_MAX_INCLINATION_DEG),
            F.lit("GEO"),
        )
        .when(eccentricity(apogee_km, perigee_km) >= HEO_MIN_ECCENTRICITY, F.lit("HEO"))
        .when(apogee_km < LEO_MAX_APOGEE_KM, F.lit("LEO"))
        .otherwise(F.lit("MEO"))
    )
