"""Cleaning and safe typing of raw text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalized(column: Column) -> Column:
    """Lower case without surrounding blanks."""
    return F.lower(F.trim(column))


def to_number(column: Column, type_name: str = "double") -> Column:
    """Cast text to a number; malformed or empty text gives NULL.

    An integer may be written with a fraction (`5.0`), which is cut off.
    """
    if type_name in ("int", "bigint"):
        # Most numbers are whole; the decimal is made only for the others.
        return F.coalesce(
            column.try_cast(type_name), column.try_cast("decimal(38,18)").try_cast(type_name)
        )
    return column.try_cast(type_name)


def to_measure(column: Column) -> Column:
    """The same double as `to_number`, for plain columns in which many texts are no numbers.

    The cast raises an exception inside for each of those, which costs more than the rest of the row. So
    texts without a digit, infinity or NaN are not cast.
    """
    return F.when(column.rlike("(?i)[0-9]|inf|nan"), to_number(column))


def to_day(column: Column) -> Column:
    """`yyyy-MM-dd` text to a date; malformed or empty text gives NULL.

    A cast behind a check of the form: unlike a parse by pattern, it raises no exception inside
    for each bad value, which would dominate the run time of dirty columns.
    """
    return F.when(column.rlike(r"^\d{4}-\d{2}-\d{2}$"), column.try_cast("date"))


def day_of_iso_timestamp(column: Column) -> Column:
    """Calendar day written at the head of an ISO timestamp, whatever zone follows it."""
    return to_day(F.substring(column, 1, 10))


def map_number(column: Column, key: str) -> Column:
    """Number under `key` of a string map; absent or malformed gives NULL."""
    return F.try_element_at(column, F.lit(key)).try_cast("double")


def flag(column: Column) -> Column:
    """Boolean to 1 or 0, with NULL counted as 0."""
    return F.when(column, F.lit(1)).otherwise(F.lit(0))


def joined_fields(columns: list[Column], separator: str = ",") -> Column:
    """Fields joined by a separator; a missing field stays as an empty one."""
    return F.array_join(F.array(*columns), separator, "")


def is_synthetic(json_column: Column) -> Column:
    """True where a raw record carries the marker of generated data."""
    return F.coalesce(F.get_json_object(json_column, "$._synthetic"), F.lit("false")) == "true"
