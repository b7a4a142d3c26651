"""Close-approach feed documents (JSON) to bronze rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.text import to_day
from skyledger.schemas import FEED_DOCUMENT, FEED_OBJECT


def read_feed_documents(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """Feed documents as text column `document`, one per file or one per line."""
    return spark.read.text(path, wholetext=not one_per_line).withColumnRenamed("value", "document")


def flatten_feed(documents: DataFrame, document: str = "document") -> DataFrame:
    """One row per close approach, with the attributes of its object repeated.

    Every object is taken as JSON text first. That text is kept as `raw_neo`, with members unknown
    to the schema. An object without approaches gives no row.
    """
    days = documents.select(
        F.from_json(document, FEED_DOCUMENT).getField("near_earth_objects").alias("by_day")
    ).select(F.explode("by_day").alias("feed_day", "objects"))
    objects = days.select(F.explode("objects").alias("raw_neo"))
    parsed = objects.select("raw_neo", F.from_json("raw_neo", FEED_OBJECT).alias("o"))
    approaches = parsed.select(
        "raw_neo", "o", F.explode(F.col("o.close_approach_data")).alias("a")
    )
    return approaches.select(
        F.col("o.id").alias("neo_id"),
        F.col("o.neo_reference_id").alias("neo_reference_id"),
        F.col("o.name").alias("neo_name"),
        F.col("o.is_potentially_hazardous_asteroid").alias("is_potentially_hazardous_asteroid"),
        F.col("o.absolute_magnitude_h").alias("absolute_magnitude_h"),
        F.col("o.estimated_diameter").alias("estimated_diameter"),
        to_day(F.col("a.close_approach_date")).alias("close_approach_date"),
        F.col("a.close_approach_date_full").alias("close_approach_date_full"),
        F.col("a.epoch_date_close_approach").alias("epoch_date_close_approach"),
        F.col("a.relative_velocity").alias("relative_velocity"),
        F.col("a.miss_distance").alias("miss_distance"),
        F.col("a.orbiting_body").alias("orbiting_body"),
        "raw_neo",
    )


def bronze_rows(
    documents: DataFrame, start_date: Column, end_date: Column, document: str = "document"
) -> DataFrame:
    """Flattened feed with the dates of the request."""
    flat = flatten_feed(documents, document)
    return flat.select(
        start_date.cast("date").alias("feed_start_date"),
        end_date.cast("date").alias("feed_end_date"),
        *flat.columns,
    )


def backfill_windows(ranges: DataFrame, start: str, end: str, days: int = 7) -> DataFrame:
    """Split each date range into windows of at most `days` days.

    The feed answers at most seven days per request. `ranges` has date columns `start` and `end`;
    its other columns are repeated for each window.
    """
    others = [c for c in ranges.columns if c not in (start, end)]
    first_days = F.sequence(F.col(start), F.col(end), F.make_dt_interval(days=F.lit(days)))
    return ranges.filter(F.col(start) <= F.col(end)).select(
        *others, F.explode(first_days).alias("window_start"), F.col(end).alias("_end")
    ).select(
        *others,
        "window_start",
        F.least(F.date_add("window_start", days - 1), F.col("_end")).alias("window_end"),
    )
