"""Catalog snapshots: bronze to silver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions.text import to_day, to_measure, to_number
from skyledger.operators.dedup import first_per_key
from skyledger.operators.merge import not_yet_in
from skyledger.operators.numbering import bucketed, dense_number, next_base
from skyledger.schemas import SATCAT_FIELDS, SILVER_SATELLITE, SILVER_SNAPSHOT
from skyledger.session import staged

DIM_KEY = ["norad_cat_id"]
SNAPSHOT_KEY = ["norad_cat_id", "snapshot_date"]


def parse_records(bronze: DataFrame) -> DataFrame:
    """Typed catalog records from their JSON text; rows without a usable catalog number are left out.

    `json_tuple` is a generator, so the filter on the catalog number stays above it. With
    `from_json` the optimizer would copy the parse into a pushed-down filter and parse twice.
    """
    return _typed(
        bronze.select(
            "id",
            "snapshot_date",
            "snapshot_group",
            F.json_tuple("parsed_record", *SATCAT_FIELDS).alias(*SATCAT_FIELDS),
        )
    )


def variant_records(bronze: DataFrame) -> DataFrame:
    """The same from `record`, the VARIANT that stored rows have.

    A scan reads only the members that are used further up, without any JSON text. A NULL record is
    one that was malformed when it was stored.
    """
    members = [F.try_variant_get("record", f"$.{f}", "string").alias(f) for f in SATCAT_FIELDS]
    return _typed(bronze.select("id", "snapshot_date", "snapshot_group", *members))


def _typed(raw: DataFrame) -> DataFrame:
    typed = raw.select(
        "id",
        "snapshot_date",
        F.col("snapshot_group").alias("source_group"),
        to_number(F.col("NORAD_CAT_ID"), "int").alias("norad_cat_id"),
        F.col("OBJECT_ID").alias("object_id"),
        F.col("OBJECT_NAME").alias("object_name"),
        F.col("OBJECT_TYPE").alias("object_type"),
        F.col("OWNER").alias("owner"),
        F.col("OPS_STATUS_CODE").alias("ops_status_code"),
        to_day(F.col("LAUNCH_DATE")).alias("launch_date"),
        F.col("LAUNCH_SITE").alias("launch_site"),
        to_day(F.col("DECAY_DATE")).alias("decay_date"),
        F.col("ORBIT_CENTER").alias("orbit_center"),
        F.col("ORBIT_TYPE").alias("orbit_type"),
        to_measure(F.col("RCS")).alias("rcs"),
        to_measure(F.col("PERIOD")).alias("period_minutes"),
        to_measure(F.col("INCLINATION")).alias("inclination_deg"),
        to_measure(F.col("APOGEE")).alias("apogee_km"),
        to_measure(F.col("PERIGEE")).alias("perigee_km"),
    )
    return typed.filter(F.col("norad_cat_id").isNotNull())


def satellite_candidates(records: DataFrame) -> DataFrame:
    """One row per satellite, without its surrogate key.

    Attributes come from the latest record, first and last seen from all of them.
    """
    names = [
        "object_id", "object_name", "object_type", "owner", "ops_status_code", "launch_date",
        "launch_site", "decay_date", "orbit_center", "orbit_type", "rcs",
    ]
    grouped = records.groupBy("norad_cat_id").agg(
        F.max_by(F.struct(*names), F.struct("snapshot_date", "id")).alias("a"),
        F.min("snapshot_date").alias("first_seen_date"),
        F.max("snapshot_date").alias("last_seen_date"),
    )
    return grouped.select(
        "norad_cat_id",
        *[F.col(f"a.{n}").alias(n) for n in names],
        "first_seen_date",
        "last_seen_date",
    )


def snapshot_candidates(records: DataFrame) -> DataFrame:
    """One row per satellite and day, without keys; the lowest ingest id wins.

    The group of a record is not part of the key: one satellite listed in two groups on a day
    gives one snapshot.
    """
    kept = first_per_key(
        records.select(
            "id",
            *SNAPSHOT_KEY,
            "source_group",
            "period_minutes",
            "inclination_deg",
            "apogee_km",
            "perigee_km",
        ),
        SNAPSHOT_KEY,
        [F.col("id")],
    )
    return kept.select(
        "norad_cat_id",
        "snapshot_date",
        "period_minutes",
        "inclination_deg",
        "apogee_km",
        "perigee_km",
        F.lit(None).cast("double").alias("ecc"),
        F.lit(None).cast("double").alias("mean_motion_rev_per_day"),
        "source_group",
    )


def new_satellites(candidates: DataFrame, existing: DataFrame) -> DataFrame:
    return not_yet_in(candidates, existing, DIM_KEY)


def new_snapshots(candidates: DataFrame, existing: DataFrame) -> DataFrame:
    return not_yet_in(candidates, existing, SNAPSHOT_KEY)


def with_satellite_key(snapshots: DataFrame, satellites: DataFrame) -> DataFrame:
    """Snapshots with the key of their satellite. A satellite has at most one row per day, so no
    key of this join can grow without bound."""
    return snapshots.join(
        satellites.select("satellite_sk", "norad_cat_id"), "norad_cat_id", "inner"
    )


def number_satellites(new: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    base = next_base(existing, "satellite_sk") if existing is not None else 0
    return dense_number(new, DIM_KEY, "satellite_sk", base).select(*SILVER_SATELLITE.fieldNames())


def number_snapshots(new: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    base = next_base(existing, "orbit_snapshot_sk") if existing is not None else 0
    numbered = dense_number(new, SNAPSHOT_KEY, "orbit_snapshot_sk", base)
    return numbered.select(*[c for c in SILVER_SNAPSHOT.fieldNames() if c in numbered.columns])


def build_satellites(records: DataFrame) -> DataFrame:
    """Full build of the dimension; staged once, as the numbering reads it twice."""
    return number_satellites(staged(bucketed(satellite_candidates(records), DIM_KEY)))


def satellite_keys(records: DataFrame) -> DataFrame:
    """(satellite_sk, norad_cat_id) as `build_satellites` gives them, without the attributes.

    The numbers depend on the catalog numbers only, which are grouped without a sort of the records.
    """
    known = staged(bucketed(records.select(*DIM_KEY).distinct(), DIM_KEY))
    return dense_number(known, DIM_KEY, "satellite_sk")


def build_snapshots(records: DataFrame, satellites: DataFrame) -> DataFrame:
    """Full build of the fact table."""
    snapshots = snapshot_candidates(records)
    keyed = with_satellite_key(snapshots, satellites)
    return number_snapshots(staged(bucketed(keyed, SNAPSHOT_KEY)))
