"""Expressions over close-approach records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit conversions, the albedo diameter constants and the date format of the feed.
MILES_PER_KM = 0.621371
FEET_PER_METER = 3.28084
KM_PER_LUNAR_DISTANCE = 384400.0
KM_PER_AU = 1.496e8
SECONDS_PER_HOUR = 3600.0
DIAMETER_CONSTANT_KM = 1329.0
ALBEDO = 0.154
DIAMETER_LOW = 0.8
DIAMETER_HIGH = 1.2
APPROACH_TIME_FORMAT = "yyyy-MMM-dd HH:mm"


def approach_time(full_date: Column) -> Column:
    """Approach minute, without a zone, from text such as `2025-Jan-03 12:34`."""
    return F.try_to_timestamp(full_date, F.lit(APPROACH_TIME_FORMAT)).cast("timestamp_ntz")


def approach_time_text(moment: Column) -> Column:
    return F.date_format(moment, APPROACH_TIME_FORMAT)


def epoch_time(epoch_ms: Column) -> Column:
    return F.timestamp_millis(epoch_ms)


def approach_day(full_date: Column) -> Column:
    """Day part of the approach minute. It depends on the natural key alone, so equal keys
    always share it."""
    return F.try_to_date(F.substring(full_date, 1, 11), "yyyy-MMM-dd")


def diameter_from_magnitude(magnitude: Column, factor: float) -> Column:
    """Diameter in km for absolute magnitude H, times `factor` (0.8 and 1.2 give the band)."""
    base = F.lit(DIAMETER_CONSTANT_KM) / F.sqrt(F.lit(ALBEDO))
    return F.round(base * F.pow(F.lit(10.0), -magnitude / F.lit(5.0)) * F.lit(factor), 6)


def km_to_miles(km: Column) -> Column:
    return km * F.lit(MILES_PER_KM)


def meters_to_feet(meters: Column) -> Column:
    return meters * F.lit(FEET_PER_METER)


def km_to_lunar(km: Column) -> Column:
    return km / F.lit(KM_PER_LUNAR_DISTANCE)


def km_to_au(km: Column) -> Column:
    return km / F.lit(KM_PER_AU)


def per_second_to_per_hour(velocity: Column) -> Column:
    return velocity * F.lit(SECONDS_PER_HOUR)
