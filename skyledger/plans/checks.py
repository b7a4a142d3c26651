"""The platform's quality checks: gates of the jobs and tests of the built tables."""

from __future__ import annotations

from skyledger.operators.quality import Check, accepted_values, non_null, unique, value_range

# Gates that the bronze-to-silver jobs apply to the rows they are about to add.
JOB_GATES: dict[str, list[Check]] = {
    "silver.neo": [
        non_null("silver.neo.non_null_neo_id", "neo_id"),
        unique("silver.neo.unique_neo_id", ["neo_id"]),
        value_range("silver.neo.abs_mag_reasonable_range", "absolute_magnitude_h", -5.0, 40.0),
        non_null("silver.neo.non_null_hazard_flag", "is_potentially_hazardous_asteroid"),
    ],
    "silver.neo_close_approach": [
        non_null("silver.neo_close_approach.non_null_neo_id", "neo_id"),
        non_null("silver.neo_close_approach.non_null_date", "close_approach_date"),
    ],
    "silver.satcat_satellite": [
        non_null("silver.satcat_satellite.non_null_norad_cat_id", "norad_cat_id"),
        unique("silver.satcat_satellite.unique_norad_cat_id", ["norad_cat_id"]),
        non_null("silver.satcat_satellite.non_null_object_name", "object_name"),
    ],
    "silver.satcat_orbit_snapshot": [
        non_null("silver.satcat_orbit_snapshot.non_null_norad_cat_id", "norad_cat_id"),
        non_null("silver.satcat_orbit_snapshot.non_null_snapshot_date", "snapshot_date"),
        unique(
            "silver.satcat_orbit_snapshot.unique_norad_snapshot_date",
            ["norad_cat_id", "snapshot_date"],
        ),
        value_range("silver.satcat_orbit_snapshot.apogee_non_negative", "apogee_km", low=0.0),
    ],
}

# Tests of the built tables, required columns, then unique columns.
_REQUIRED: dict[str, tuple[str, ...]] = {
    "gold.neo_daily_activity": (
        "close_approach_date",
        "total_approaches",
        "unique_objects",
        "hazardous_approaches",
    ),
    "gold.neo_hazard_summary": (
        "neo_id",
        "is_hazardous",
        "total_approaches",
        "closest_approach_km",
    ),
    "gold.satcat_orbit_summary": ("norad_cat_id", "object_name", "snapshot_count"),
    "gold.ai_neo_features": (
        "approach_sk",
        "neo_id",
        "close_approach_date",
        "rel_velocity_km_s",
        "miss_distance_km",
        "absolute_magnitude_h",
        "is_hazardous_label",
    ),
    "gold.ai_satcat_features": ("orbit_snapshot_sk", "norad_cat_id", "snapshot_date"),
    "silver.neo": (
        "neo_sk",
        "neo_id",
        "is_potentially_hazardous_asteroid",
        "first_seen_date",
        "last_seen_date",
    ),
    "silver.neo_close_approach": ("approach_sk", "neo_sk", "neo_id", "close_approach_date"),
    "silver.satcat_satellite": (
        "satellite_sk",
        "norad_cat_id",
        "object_name",
        "first_seen_date",
        "last_seen_date",
    ),
    "silver.satcat_orbit_snapshot": (
        "orbit_snapshot_sk",
        "satellite_sk",
        "norad_cat_id",
        "snapshot_date",
    ),
}
_UNIQUE: dict[str, tuple[str, ...]] = {
    "gold.neo_daily_activity": ("close_approach_date",),
    "gold.neo_hazard_summary": ("neo_id",),
    "gold.satcat_orbit_summary": ("norad_cat_id",),
    "gold.ai_neo_features": ("approach_sk",),
    "gold.ai_satcat_features": ("orbit_snapshot_sk",),
    "silver.neo": ("neo_sk", "neo_id"),
    "silver.neo_close_approach": ("approach_sk",),
    "silver.satcat_satellite": ("satellite_sk", "norad_cat_id"),
    "silver.satcat_orbit_snapshot": ("orbit_snapshot_sk",),
}

TABLE_TESTS: dict[str, list[Check]] = {
    table: [non_null(f"{table}.not_null_{c}", c) for c in required]
    + [unique(f"{table}.unique_{c}", [c]) for c in _UNIQUE[table]]
    for table, required in _REQUIRED.items()
}
TABLE_TESTS["gold.ai_neo_features"].append(
    accepted_values(
        "gold.ai_neo_features.accepted_is_hazardous_label", "is_hazardous_label", [0, 1]
    )
)
