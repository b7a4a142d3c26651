"""Gold marts and feature tables.

Marts that group by a fact key count the facts per key first and join the dimension afterwards, so
a hot key reaches the join as a few rows. Should the dimension hold a key twice, the counts are
multiplied as a join before the grouping would. Satellites have at most one snapshot per day, so
joins on the catalog number cannot run hot.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions.text import flag
from skyledger.operators.lookup import lookup
from skyledger.schemas import GOLD_ORBIT_PARTIAL, ORBIT_MEASURES


def neo_daily_activity(approaches: DataFrame, neo: DataFrame) -> DataFrame:
    """Approaches, distinct objects and hazardous approaches per day."""
    per_object = approaches.groupBy("close_approach_date", "neo_id").agg(
        F.count(F.lit(1)).alias("n")
    )
    objects = neo.groupBy("neo_id").agg(
        F.count(F.lit(1)).alias("copies"),
        F.sum(flag(F.col("is_potentially_hazardous_asteroid"))).alias("hazardous"),
    )
    return (
        per_object.join(objects, "neo_id", "inner")
        .groupBy("close_approach_date")
        .agg(
            F.sum(F.col("n") * F.col("copies")).alias("total_approaches"),
            F.count(F.lit(1)).alias("unique_objects"),
            F.sum(F.col("n") * F.col("hazardous")).alias("hazardous_approaches"),
        )
    )


def hazard_partials(approaches: DataFrame) -> DataFrame:
    """Activity per object, in a form that `merged_hazards` can add up."""
    return approaches.groupBy("neo_id").agg(
        F.count(F.lit(1)).alias("total_approaches"),
        F.min("close_approach_date").alias("first_approach_date"),
        F.max("close_approach_date").alias("last_approach_date"),
        F.min("miss_distance_km").alias("closest_approach_km"),
    )


def merged_hazards(*partials: DataFrame) -> DataFrame:
    """Partials over disjoint approaches as one. A stored summary serves as a partial as well."""
    columns = [
        "neo_id", "total_approaches", "first_approach_date", "last_approach_date",
        "closest_approach_km",
    ]
    together = reduce(DataFrame.unionByName, [p.select(*columns) for p in partials])
    return together.groupBy("neo_id").agg(
        F.sum("total_approaches").alias("total_approaches"),
        F.min("first_approach_date").alias("first_approach_date"),
        F.max("last_approach_date").alias("last_approach_date"),
        F.min("closest_approach_km").alias("closest_approach_km"),
    )


def hazard_summary(partials: DataFrame, neo: DataFrame) -> DataFrame:
    """Partials with name and flag. Objects without a dimension row stay."""
    objects = neo.groupBy("neo_id").agg(
        F.max("name").alias("name"),
        F.bool_or("is_potentially_hazardous_asteroid").alias("is_hazardous"),
        F.count(F.lit(1)).alias("copies"),
    )
    return partials.join(objects, "neo_id", "left").select(
        "neo_id",
        "name",
        "is_hazardous",
        (F.col("total_approaches") * F.coalesce("copies", F.lit(1))).alias("total_approaches"),
        "first_approach_date",
        "last_approach_date",
        "closest_approach_km",
    )


def neo_hazard_summary(approaches: DataFrame, neo: DataFrame) -> DataFrame:
    """Activity and closest approach per object. Objects without a dimension row stay."""
    return hazard_summary(hazard_partials(approaches), neo)


def orbit_partials(snapshots: DataFrame) -> DataFrame:
    """Counts, dates and exact sums per satellite, in a form that `merged_orbits` can add up."""
    sums = []
    for c in ORBIT_MEASURES:
        sums += [
            F.sum(F.col(c).cast("decimal(38,9)")).alias(f"sum_{c}"),
            F.count(c).alias(f"count_{c}"),
        ]
    return snapshots.groupBy("norad_cat_id").agg(
        F.count(F.lit(1)).alias("snapshot_count"),
        F.min("snapshot_date").alias("first_snapshot_date"),
        F.max("snapshot_date").alias("last_snapshot_date"),
        *sums,
    )


def merged_orbits(*partials: DataFrame) -> DataFrame:
    """Partials over disjoint snapshots as one."""
    names = GOLD_ORBIT_PARTIAL.fieldNames()
    together = reduce(DataFrame.unionByName, [p.select(*names) for p in partials])
    summed = [
        F.sum(c).alias(c) for c in names if c.startswith(("sum_", "count_", "snapshot_count"))
    ]
    return together.groupBy("norad_cat_id").agg(
        F.min("first_snapshot_date").alias("first_snapshot_date"),
        F.max("last_snapshot_date").alias("last_snapshot_date"),
        *summed,
    ).select(*names)


def orbit_summary(satellites: DataFrame, partials: DataFrame) -> DataFrame:
    """Partials with the attributes of their satellite and the mean elements."""
    names = satellites.groupBy("norad_cat_id").agg(
        F.max("object_name").alias("object_name"),
        F.max("object_type").alias("object_type"),
        F.max("owner").alias("owner"),
        F.count(F.lit(1)).alias("copies"),
    )
    means = [
        F.try_divide(F.col(f"sum_{c}").cast("double"), F.col(f"count_{c}").cast("double"))
        for c in ORBIT_MEASURES
    ]
    return partials.join(names, "norad_cat_id", "inner").select(
        "norad_cat_id",
        "object_name",
        "object_type",
        "owner",
        (F.col("snapshot_count") * F.col("copies")).alias("snapshot_count"),
        "first_snapshot_date",
        "last_snapshot_date",
        *[mean.alias(f"avg_{c}") for c, mean in zip(ORBIT_MEASURES, means)],
    )


def satcat_orbit_summary(satellites: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Snapshot count, date span and mean elements per satellite."""
    return orbit_summary(satellites, orbit_partials(snapshots))


def ai_neo_features(approaches: DataFrame, neo: DataFrame) -> DataFrame:
    """One feature row per approach with the hazard label of its object."""
    objects = neo.select(
        "neo_id",
        "absolute_magnitude_h",
        flag(F.col("is_potentially_hazardous_asteroid")).alias("is_hazardous_label"),
    )
    measures = approaches.select(
        "approach_sk",
        "neo_id",
        "close_approach_date",
        "rel_velocity_km_s",
        "rel_velocity_km_h",
        "miss_distance_km",
        "miss_distance_lunar",
        "miss_distance_au",
    )
    return lookup(measures, objects, ["neo_id"], ["approach_sk"]).select(
        "approach_sk",
        "neo_id",
        "close_approach_date",
        "rel_velocity_km_s",
        "rel_velocity_km_h",
        "miss_distance_km",
        "miss_distance_lunar",
        "miss_distance_au",
        "absolute_magnitude_h",
        "is_hazardous_label",
    )


def ai_satcat_features(satellites: DataFrame, snapshots: DataFrame) -> DataFrame:
    """One feature row per snapshot with type and owner of its satellite."""
    owners = satellites.select("norad_cat_id", "object_type", "owner")
    return snapshots.join(owners, "norad_cat_id", "inner").select(
        "orbit_snapshot_sk",
        "norad_cat_id",
        "snapshot_date",
        "period_minutes",
        "inclination_deg",
        "apogee_km",
        "perigee_km",
        "object_type",
        "owner",
    )
