"""Analyst queries over silver and gold tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from skyledger.functions import approach as ap
from skyledger.functions import orbit as ob
from skyledger.functions.aggregates import exact_avg
from skyledger.functions.text import is_synthetic
from skyledger.operators.dedup import last_per_key
from skyledger.operators.lookup import lookup

# --- approaches -------------------------------------------------------------


def approaches_within(approaches: DataFrame, lunar_distances: float, period: str = "day") -> DataFrame:
    """Approaches within a distance, counted per day, week or month."""
    start = (
        F.col("close_approach_date")
        if period == "day"
        else F.date_trunc(period, F.col("close_approach_date")).cast("date")
    )
    return (
        approaches.filter(F.col("miss_distance_lunar") <= F.lit(lunar_distances))
        .groupBy(start.alias("period_start"))
        .agg(F.count(F.lit(1)).alias("approaches"))
    )


def top_closest(approaches: DataFrame, neo: DataFrame, limit: int = 20) -> DataFrame:
    """The closest approaches with name, velocity and hazard flag.

    Facts without a dimension row do not count. They are left out by a semi join on the key alone;
    the names are fetched for the `limit` rows that remain.
    """
    order = [F.asc_nulls_last("miss_distance_lunar"), F.asc("approach_sk")]
    measures = approaches.select(
        "approach_sk", "neo_id", "close_approach_date", "miss_distance_lunar", "rel_velocity_km_s"
    )
    # Adaptive execution splits a hot key of the left side of a semi join.
    known = measures.join(neo.select("neo_id"), "neo_id", "left_semi")
    ranked = known.orderBy(*order).limit(limit)
    names = neo.select("neo_id", "name", "is_potentially_hazardous_asteroid")
    return names.join(F.broadcast(ranked), "neo_id", "inner").orderBy(*order).select(
        "approach_sk",
        "name",
        "close_approach_date",
        "miss_distance_lunar",
        "rel_velocity_km_s",
        "is_potentially_hazardous_asteroid",
    )


def hazardous_by_closeness(hazard_summary: DataFrame) -> DataFrame:
    """Hazardous objects, closest first."""
    return (
        hazard_summary.filter("is_hazardous")
        .select("neo_id", "name", "total_approaches", "closest_approach_km", "is_hazardous")
        .orderBy(F.asc_nulls_last("closest_approach_km"), "neo_id")
    )


def approach_bands(approaches: DataFrame) -> DataFrame:
    """Distance and velocity bands per day."""
    return approaches.groupBy("close_approach_date").agg(
        F.min("miss_distance_lunar").alias("min_ld"),
        exact_avg(F.col("rel_velocity_km_s")).alias("avg_velocity"),
        F.max("rel_velocity_km_s").alias("max_velocity"),
    )


def discoveries_by_month(neo: DataFrame) -> DataFrame:
    """Objects first seen per month."""
    return neo.groupBy(
        F.date_trunc("month", F.col("first_seen_date")).cast("date").alias("month")
    ).agg(F.count(F.lit(1)).alias("discoveries"))


def hazard_briefing(
    approaches: DataFrame, neo: DataFrame, first_day: Column, lunar_distances: float, days: int = 7
) -> DataFrame:
    """Approaches of the coming days within a distance, hazardous and close ones first."""
    window = F.col("close_approach_date").between(first_day, F.date_add(first_day, days - 1))
    near = approaches.filter(window & (F.col("miss_distance_lunar") <= F.lit(lunar_distances)))
    names = neo.select("neo_id", "name", "is_potentially_hazardous_asteroid")
    return (
        lookup(near, names, ["neo_id"], ["approach_sk"])
        .select(
            "approach_sk",
            "neo_id",
            "name",
            "close_approach_date",
            "miss_distance_lunar",
            "miss_distance_km",
            "rel_velocity_km_s",
            "is_potentially_hazardous_asteroid",
        )
        .orderBy(
            F.desc_nulls_last("is_potentially_hazardous_asteroid"),
            "miss_distance_lunar",
            "approach_sk",
        )
    )


def without_synthetic(bronze: DataFrame, raw_column: str = "raw_neo") -> DataFrame:
    """Rows whose raw record does not carry the marker of generated data."""
    return bronze.filter(~is_synthetic(F.col(raw_column)))


def diameter_units(neo: DataFrame) -> DataFrame:
    """Diameter band estimated from the magnitude, in four units."""
    km = neo.select(
        "neo_id",
        "absolute_magnitude_h",
        ap.diameter_from_magnitude(F.col("absolute_magnitude_h"), ap.DIAMETER_LOW).alias("min_km"),
        ap.diameter_from_magnitude(F.col("absolute_magnitude_h"), ap.DIAMETER_HIGH).alias("max_km"),
    )

    def in_units(bound: str) -> list[Column]:
        km_value = F.col(f"{bound}_km")
        meters = km_value * F.lit(1000.0)
        return [
            meters.alias(f"{bound}_m"),
            ap.km_to_miles(km_value).alias(f"{bound}_mi"),
            ap.meters_to_feet(meters).alias(f"{bound}_ft"),
        ]

    return km.select("*", *in_units("min"), *in_units("max"))


def approach_units(approaches: DataFrame) -> DataFrame:
    """Distances and velocities converted from km and km/s, with the feed's decimals."""
    km, km_s = F.col("miss_distance_km"), F.col("rel_velocity_km_s")
    km_h = F.round(ap.per_second_to_per_hour(km_s), 3)
    return approaches.select(
        "approach_sk",
        "miss_distance_km",
        F.round(ap.km_to_lunar(km), 4).alias("lunar"),
        F.round(ap.km_to_au(km), 9).alias("au"),
        F.round(ap.km_to_miles(km), 2).alias("miles"),
        "rel_velocity_km_s",
        km_h.alias("km_h"),
        F.round(ap.km_to_miles(km_h), 3).alias("mi_h"),
    )


def approach_times(approaches: DataFrame) -> DataFrame:
    """Approach minute parsed from its text, the text written back, and the epoch milliseconds."""
    moment = ap.approach_time(F.col("close_approach_date_full"))
    return approaches.select(
        "neo_id",
        "close_approach_date_full",
        "epoch_date_close_approach",
        moment.alias("approach_time"),
        ap.approach_time_text(moment).alias("written_back"),
    )


# --- satellites -------------------------------------------------------------


def latest_snapshots(snapshots: DataFrame) -> DataFrame:
    """Latest snapshot per satellite."""
    return last_per_key(snapshots, ["norad_cat_id"], ["snapshot_date"])


def with_regime(orbits: DataFrame) -> DataFrame:
    return orbits.withColumn(
        "orbit_regime",
        ob.regime(F.col("apogee_km"), F.col("perigee_km"), F.col("inclination_deg")),
    )


def satellites_by_regime(snapshots: DataFrame) -> DataFrame:
    """Satellites per regime, by their latest snapshot."""
    latest = latest_snapshots(
        snapshots.select("norad_cat_id", "snapshot_date", "apogee_km", "perigee_km", "inclination_deg")
    )
    return with_regime(latest).groupBy("orbit_regime").agg(
        F.count(F.lit(1)).alias("satellite_count")
    )


def satellites_by_regime_owner(snapshots: DataFrame, satellites: DataFrame) -> DataFrame:
    """Satellites per regime and owner, by their latest snapshot."""
    latest = latest_snapshots(
        snapshots.select("norad_cat_id", "snapshot_date", "apogee_km", "perigee_km", "inclination_deg")
    )
    return (
        with_regime(latest)
        .join(satellites.select("norad_cat_id", "owner"), "norad_cat_id", "inner")
        .groupBy("orbit_regime", "owner")
        .agg(F.count(F.lit(1)).alias("satellite_count"))
    )


def owner_inclination_band(
    satellites: DataFrame, snapshots: DataFrame, owner: str, low: float, high: float
) -> DataFrame:
    """Snapshots of one owner's satellites within an inclination band."""
    owned = satellites.filter(F.col("owner") == owner).select("norad_cat_id", "object_name", "owner")
    banded = snapshots.filter(F.col("inclination_deg").between(low, high))
    return (
        banded.join(owned, "norad_cat_id", "inner")
        .select("norad_cat_id", "object_name", "owner", "snapshot_date", "inclination_deg")
        .orderBy("inclination_deg", "norad_cat_id", "snapshot_date")
    )


def satellite_profile(orbit_summary: DataFrame, norad_cat_id: int) -> DataFrame:
    """Orbital profile of one satellite."""
    return orbit_summary.filter(F.col("norad_cat_id") == norad_cat_id).select(
        "norad_cat_id",
        "object_name",
        "avg_period_minutes",
        "avg_apogee_km",
        "avg_perigee_km",
        "avg_inclination_deg",
    )


_ELEMENTS = ("period_minutes", "apogee_km", "perigee_km")


# The windows below partition by satellite. Silver holds one snapshot per satellite and day, so a
# partition is bounded by the number of calendar days, not by the size of the table.


def _by_satellite() -> WindowSpec:
    return Window.partitionBy("norad_cat_id")


def _by_date() -> WindowSpec:
    return _by_satellite().orderBy("snapshot_date")


def orbit_history(snapshots: DataFrame) -> DataFrame:
    """Numbered snapshot history per satellite with a flag where an element changed."""
    history = _by_date()
    changed = reduce(
        lambda a, b: a | b, [~F.col(c).eqNullSafe(F.lag(c).over(history)) for c in _ELEMENTS]
    )
    position = F.row_number().over(history).cast("long")
    return snapshots.select(
        "norad_cat_id",
        "snapshot_date",
        *_ELEMENTS,
        position.alias("snapshot_number"),
        ((position > 1) & changed).alias("is_changed"),
    )


def orbit_deltas(snapshots: DataFrame) -> DataFrame:
    """Change of each element since the previous snapshot of the satellite."""
    history = _by_date()
    return snapshots.select(
        "norad_cat_id",
        "snapshot_date",
        F.lag("snapshot_date").over(history).alias("previous_date"),
        *[(F.col(c) - F.lag(c).over(history)).alias(f"delta_{c}") for c in _ELEMENTS],
    )


def orbit_anomalies(snapshots: DataFrame) -> DataFrame:
    """Z-score of each delta against the satellite's own history, to 6 decimals, and the largest.

    A satellite whose deltas never vary has no score.
    """
    deltas = orbit_deltas(snapshots)
    satellite, scores = _by_satellite(), []
    for c in _ELEMENTS:
        delta = F.col(f"delta_{c}")
        mean = F.avg(delta).over(satellite)
        spread = F.stddev_samp(delta).over(satellite)
        score = F.round((delta - mean) / F.nullif(spread, F.lit(0.0)), 6)
        scores.append(score.alias(f"z_{c}"))
    scored = deltas.select("norad_cat_id", "snapshot_date", *scores)
    return scored.withColumn(
        "anomaly_score", F.greatest(*[F.abs(F.col(f"z_{c}")) for c in _ELEMENTS])
    )


def top_anomalies(anomalies: DataFrame, limit: int = 20) -> DataFrame:
    """Snapshots that deviate most from the history of their satellite."""
    return (
        anomalies.filter(F.col("anomaly_score").isNotNull())
        .select("norad_cat_id", "snapshot_date", "anomaly_score")
        .orderBy(F.desc("anomaly_score"), "norad_cat_id", "snapshot_date")
        .limit(limit)
    )


def derived_elements(snapshots: DataFrame) -> DataFrame:
    """Eccentricity, circular period, mean motion and regime from apogee and perigee."""
    altitude = ob.mean_altitude(F.col("apogee_km"), F.col("perigee_km"))
    with_period = with_regime(snapshots).withColumn(
        "circular_period_minutes", ob.circular_period_minutes(altitude)
    )
    return with_period.select(
        "norad_cat_id",
        "snapshot_date",
        "apogee_km",
        "perigee_km",
        ob.eccentricity(F.col("apogee_km"), F.col("perigee_km")).alias("eccentricity"),
        "circular_period_minutes",
        ob.mean_motion(F.col("circular_period_minutes")).alias("mean_motion_rev_per_day"),
        "orbit_regime",
    )


# --- all layers -------------------------------------------------------------


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def freshness(table: DataFrame, moment: str, now: Column, limit_hours: float = 24) -> DataFrame:
    """Latest ingestion, its lag in seconds, and whether the lag is within the limit."""
    latest = table.agg(F.max(moment).alias("latest_ingest"))
    lag = F.timestamp_diff("SECOND", F.col("latest_ingest"), now)
    return latest.select(
        "latest_ingest",
        lag.alias("lag_seconds"),
        (lag <= F.lit(limit_hours * 3600)).alias("is_fresh"),
    )


def reconcile_daily_activity(daily: DataFrame, approaches: DataFrame) -> DataFrame:
    """Days of the mart or of the facts, with the approaches of both and the difference."""
    direct = approaches.groupBy("close_approach_date").agg(F.count(F.lit(1)).alias("silver_total"))
    mart = daily.select(
        F.col("close_approach_date").alias("_day"), F.col("total_approaches").alias("gold_total")
    )
    both = mart.join(direct, F.col("_day").eqNullSafe(F.col("close_approach_date")), "full")
    gold, silver = (F.coalesce(c, F.lit(0)) for c in ("gold_total", "silver_total"))
    return both.select(
        F.coalesce("close_approach_date", "_day").alias("close_approach_date"),
        gold.alias("gold_total"),
        silver.alias("silver_total"),
        (gold - silver).alias("difference"),
    )


def daily_activity_by_date(daily: DataFrame) -> DataFrame:
    """The daily mart, oldest day first, with the place of each day."""
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("close_approach_date")))
    # One row per day, however many approaches there are.
    return daily.withColumn("place", place.cast("long")).orderBy("place")


def reconcile_totals(
    daily: DataFrame, hazard: DataFrame, approaches: DataFrame
) -> DataFrame:
    """Total approaches by both marts and by the facts, one row per source."""
    parts = [
        daily.agg(F.sum("total_approaches").alias("total")).select(
            F.lit("gold.neo_daily_activity").alias("source"), "total"
        ),
        hazard.agg(F.sum("total_approaches").alias("total")).select(
            F.lit("gold.neo_hazard_summary").alias("source"), "total"
        ),
        approaches.agg(F.count(F.lit(1)).alias("total")).select(
            F.lit("silver.neo_close_approach").alias("source"), "total"
        ),
    ]
    return reduce(DataFrame.unionByName, parts)

