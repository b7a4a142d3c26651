"""Approach events: bronze to silver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions.text import to_number
from skyledger.operators.dedup import first_per_key
from skyledger.operators.lookup import lookup
from skyledger.operators.merge import not_yet_in
from skyledger.operators.numbering import bucketed, dense_number, next_base
from skyledger.schemas import DIAMETER, DISTANCE, SILVER_APPROACH, SILVER_NEO, VELOCITY
from skyledger.session import staged

DIM_KEY = ["neo_id"]
APPROACH_KEY = ["neo_id", "close_approach_date_full", "orbiting_body"]


def neo_candidates(bronze: DataFrame) -> DataFrame:
    """One row per object, without its surrogate key.

    Attributes come from the latest event of the object, first and last seen from all of them.
    """
    attributes = F.struct(
        "neo_reference_id",
        F.col("neo_name").alias("name"),
        "absolute_magnitude_h",
        "estimated_diameter",
        "is_potentially_hazardous_asteroid",
    )
    grouped = bronze.groupBy("neo_id").agg(
        F.max_by(attributes, F.struct("close_approach_date", "event_id")).alias("a"),
        F.min("close_approach_date").alias("first_seen_date"),
        F.max("close_approach_date").alias("last_seen_date"),
    )
    # Parsed after the grouping: once per object, not once per event.
    parsed = grouped.withColumn("d", F.from_json("a.estimated_diameter", DIAMETER))
    return parsed.select(
        "neo_id",
        F.col("a.neo_reference_id").alias("neo_reference_id"),
        F.col("a.name").alias("name"),
        F.col("a.absolute_magnitude_h").alias("absolute_magnitude_h"),
        to_number(F.col("d.kilometers.estimated_diameter_min")).alias("estimated_diameter_km_min"),
        to_number(F.col("d.kilometers.estimated_diameter_max")).alias("estimated_diameter_km_max"),
        F.col("a.is_potentially_hazardous_asteroid").alias("is_potentially_hazardous_asteroid"),
        F.lit(None).cast("boolean").alias("is_sentry_object"),
        F.lit(None).cast("string").alias("nasa_jpl_url"),
        "first_seen_date",
        "last_seen_date",
    )


def approach_candidates(bronze: DataFrame) -> DataFrame:
    """One typed row per approach, without keys; the lowest event id of a natural key wins."""
    raw = first_per_key(
        bronze.select(
            "event_id",
            *APPROACH_KEY,
            "close_approach_date",
            "epoch_date_close_approach",
            "relative_velocity",
            "miss_distance",
        ),
        APPROACH_KEY,
        [F.col("event_id")],
    )
    parsed = raw.withColumns(
        {
            "v": F.from_json("relative_velocity", VELOCITY),
            "m": F.from_json("miss_distance", DISTANCE),
        }
    )
    return parsed.select(
        "neo_id",
        "close_approach_date",
        "close_approach_date_full",
        "epoch_date_close_approach",
        "orbiting_body",
        to_number(F.col("v.kilometers_per_second")).alias("rel_velocity_km_s"),
        to_number(F.col("v.kilometers_per_hour")).alias("rel_velocity_km_h"),
        to_number(F.col("v.miles_per_hour")).alias("rel_velocity_mi_h"),
        to_number(F.col("m.kilometers")).alias("miss_distance_km"),
        to_number(F.col("m.lunar")).alias("miss_distance_lunar"),
        to_number(F.col("m.astronomical")).alias("miss_distance_au"),
        to_number(F.col("m.miles")).alias("miss_distance_miles"),
    )


def new_neos(candidates: DataFrame, existing: DataFrame) -> DataFrame:
    """Candidates whose object is not in the dimension yet."""
    return not_yet_in(candidates, existing, DIM_KEY)


def new_approaches(candidates: DataFrame, existing: DataFrame) -> DataFrame:
    """Candidates whose approach is not in the fact table yet."""
    return not_yet_in(candidates, existing, APPROACH_KEY)


def with_neo_key(approaches: DataFrame, neo: DataFrame) -> DataFrame:
    """Facts with the key of their object; facts without a dimension row are left out.

    The facts should be staged: they are counted per key before they are joined.
    """
    return lookup(approaches, neo.select("neo_sk", "neo_id"), DIM_KEY, APPROACH_KEY)


def number_neos(new: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    base = next_base(existing, "neo_sk") if existing is not None else 0
    return dense_number(new, DIM_KEY, "neo_sk", base).select(*SILVER_NEO.fieldNames())


def number_approaches(new: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    base = next_base(existing, "approach_sk") if existing is not None else 0
    numbered = dense_number(new, APPROACH_KEY, "approach_sk", base)
    return numbered.select(*[c for c in SILVER_APPROACH.fieldNames() if c in numbered.columns])


def build_neo(bronze: DataFrame) -> DataFrame:
    """Full build of the dimension from bronze; staged once, as the numbering reads it twice."""
    return number_neos(staged(bucketed(neo_candidates(bronze), DIM_KEY)))


def build_approaches(bronze: DataFrame, neo: DataFrame) -> DataFrame:
    """Full build of the fact table from bronze."""
    keyed = with_neo_key(staged(approach_candidates(bronze)), neo)
    return number_approaches(staged(bucketed(keyed, APPROACH_KEY)))
