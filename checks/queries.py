"""Registered queries: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.standins import Inputs
from skyledger.functions import text
from skyledger.operators import ledger, merge, numbering, quality
from skyledger.operators.dedup import duplicate_keys
from skyledger.operators.quality import QualityGateError
from skyledger.plans import analysis, gold, jobs, ml, model_jobs, moments, silver_neo, silver_satcat
from skyledger.plans.checks import JOB_GATES, TABLE_TESTS
from skyledger.schemas import MODEL_REGISTRY
from skyledger.session import fresh_dir, literal_rows, staged
from skyledger.sources import catalog as catalog_source
from skyledger.sources import feed, messages
from skyledger.sources.tables import Warehouse
from skyledger.streaming import bronze as streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

EXISTING_BEFORE = "1998-01-01"  # what the merge queries take as already stored
SATELLITES_BEFORE = "1992-06-01"  # by then, some satellites have no record yet
NOW = "2001-08-01 12:00:00"  # the moment the time-relative queries take as now
BRIEFING_DAY = "1998-06-01"
LUNAR_LIMIT = 40.0
MESSAGES_PER_FILE = 500_000
PIPELINES = ("1-URGENT", "2-HIGH")


def query(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    QUERIES[build.__name__] = lambda spark, sf_dir: build(Inputs(spark, sf_dir))
    return build


def _now():
    return F.lit(NOW).cast("timestamp_ntz")


def _before(column: str, day: str = EXISTING_BEFORE):
    return F.col(column) < F.lit(day).cast("date")


def _placed(df: DataFrame) -> DataFrame:
    """Number the rows of a sorted result as they come out, so that the order is compared.

    The sorted partitions stay as they are: each gets the number of rows before it, and its rows are
    numbered by their place in it. Only one count per partition meets in a task.
    """
    seen = staged(df.withColumn("_seen", F.monotonically_increasing_id()))
    part, inside = F.shiftrightunsigned("_seen", 33), F.col("_seen").bitwiseAND((1 << 33) - 1)
    sizes = seen.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")
    offsets = sizes.select("_part", before.alias("_before"))
    numbered = seen.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return numbered.select(*df.columns, (F.col("_before") + inside + 1).alias("place"))


# --- sources and bronze ------------------------------------------------------


def _feed_documents(t: Inputs) -> DataFrame:
    """One feed document per order: its object with two approaches, or with none."""
    day = F.col("o_orderdate").cast("date")
    km = F.col("o_totalprice").cast("decimal(18,2)")

    def approach(date, body, distance):
        return F.struct(
            date.cast("string").alias("close_approach_date"),
            F.concat(date.cast("string"), F.lit(" 00:00")).alias("close_approach_date_full"),
            F.col("o_orderkey").alias("epoch_date_close_approach"),
            F.struct(F.lit("7.5").alias("kilometers_per_second")).alias("relative_velocity"),
            distance.alias("miss_distance"),
            F.lit(body).alias("orbiting_body"),
        )

    distance = F.struct(km.cast("string").alias("kilometers"))
    no_distance = F.lit(None).cast("struct<kilometers: string>")
    approaches = F.when(
        F.col("o_orderstatus") != "P",
        F.array(
            approach(day, "Earth", distance), approach(F.date_add(day, 30), "Moon", no_distance)
        ),
    )
    diameter = F.abs(F.col("c_acctbal")).cast("decimal(18,2)")
    neo = F.struct(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_name").alias("name"),
        (F.col("c_mktsegment") == "MACHINERY").alias("is_potentially_hazardous_asteroid"),
        F.struct(
            F.struct(
                diameter.alias("estimated_diameter_min"),
                (diameter * 2).alias("estimated_diameter_max"),
            ).alias("kilometers")
        ).alias("estimated_diameter"),
        approaches.alias("close_approach_data"),
    )
    document = F.struct(
        F.create_map(day.cast("string"), F.array(neo)).alias("near_earth_objects")
    )
    orders, customers = t.table("orders"), t.table("customer")
    joined = orders.join(customers, orders["o_custkey"] == customers["c_custkey"], "inner")
    return joined.select(F.to_json(document).alias("document"))


@query
def neo_feed_flatten(t):
    rows = feed.bronze_rows(
        _feed_documents(t), F.lit("1995-01-01").cast("date"), F.lit("1995-01-07").cast("date")
    )
    return rows.select(
        "feed_start_date",
        "feed_end_date",
        "neo_id",
        "neo_reference_id",
        "neo_name",
        "is_potentially_hazardous_asteroid",
        F.get_json_object("estimated_diameter", "$.kilometers.estimated_diameter_max")
        .cast("double")
        .alias("diameter_km_max"),
        "close_approach_date",
        "close_approach_date_full",
        "epoch_date_close_approach",
        F.get_json_object("miss_distance", "$.kilometers").alias("miss_km"),
        "orbiting_body",
        F.get_json_object("raw_neo", "$.name").alias("raw_name"),
    )


@query
def satcat_csv_record(t):
    """Parts written as a catalog CSV and read back."""
    path = fresh_dir(t.spark, "catalog-csv")
    t.table("part").select(
        F.col("p_partkey").alias("NORAD_CAT_ID"),
        F.concat("p_name", F.lit(", "), "p_type").alias("OBJECT_NAME"),
        F.when(F.col("p_size") > 10, F.col("p_size")).alias("RCS"),
        F.col("p_brand").alias("OWNER"),
    ).write.csv(path, header=True)
    rows = catalog_source.read_catalog_csv(t.spark, path)
    return catalog_source.bronze_rows(rows, F.lit("active"), F.lit("1998-01-02").cast("date"))


@query
def backfill_windows(t):
    ranges = t.table("orders").groupBy("o_orderpriority").agg(
        F.min(F.col("o_orderdate").cast("date")).alias("first_day"),
        F.max(F.col("o_orderdate").cast("date")).alias("last_day"),
    )
    return feed.backfill_windows(ranges, "first_day", "last_day")


@query
def bronze_neo_dedup(t):
    stored = t.bronze_neo.filter(_before("close_approach_date"))
    new = merge.insert_or_ignore(
        t.bronze_neo, stored, silver_neo.APPROACH_KEY, [F.col("event_id")]
    )
    return new.select("event_id", *silver_neo.APPROACH_KEY, "neo_name", "close_approach_date")


@query
def bronze_satcat_load_once(t):
    """Third lines arrive without a group."""
    nameless = F.floor(F.col("id") / 100_000_000) % 10 == 3
    arrivals = t.bronze_satcat.withColumn(
        "snapshot_group", F.when(~nameless, F.col("snapshot_group"))
    )
    stored = arrivals.filter(_before("snapshot_date"))
    new = merge.load_once(arrivals, stored, ["snapshot_group", "snapshot_date"])
    return new.select("id", "snapshot_group", "snapshot_date")


@query
def bronze_without_synthetic(t):
    return analysis.without_synthetic(t.bronze_neo).select("event_id", "neo_id")


# --- silver ------------------------------------------------------------------


@query
def silver_neo_dimension(t):
    return t.neo


@query
def silver_neo_close_approach(t):
    return t.approaches


@query
def silver_satcat_satellite(t):
    return t.satellites


@query
def silver_satcat_orbit_snapshot(t):
    return t.snapshots


@query
def silver_satcat_records_variant(t):
    """Typed records from the VARIANT that stored rows have, next to the state of their text."""
    warehouse = _warehouse(t)
    warehouse.append(t.bronze_satcat, "bronze.satcat_raw", "load")
    return silver_satcat.variant_records(warehouse.read("bronze.satcat_raw"))


@query
def merge_pruned_neo(t):
    """Two loads of objects; the second reads the key buckets of its own objects only."""
    warehouse = _warehouse(t)
    _land_approaches(t, warehouse)
    for load in ("early", "late"):
        jobs.neo_to_silver(warehouse, f"silver-{load}", [load])
    stored = warehouse.stored("silver.neo")
    return stored.select("neo_id", "name", "first_seen_date", "last_seen_date", "load_run")


@query
def merge_new_neo(t):
    stored = silver_neo.build_neo(t.bronze_neo.filter(_before("close_approach_date")))
    new = staged(silver_neo.new_neos(t.objects, stored))
    return silver_neo.number_neos(new, stored).select(
        "neo_sk", "neo_id", "name", "first_seen_date", "last_seen_date"
    )


@query
def merge_new_approach(t):
    early = t.bronze_neo.filter(_before("close_approach_date"))
    stored = silver_neo.build_approaches(early, silver_neo.build_neo(early))
    new = silver_neo.new_approaches(t.facts, stored)
    keyed = staged(silver_neo.with_neo_key(new, t.neo))
    return silver_neo.number_approaches(keyed, stored).select(
        "approach_sk", "neo_sk", *silver_neo.APPROACH_KEY, "miss_distance_km"
    )


@query
def merge_new_satellite(t):
    early = t.records.filter(_before("snapshot_date", SATELLITES_BEFORE))
    stored = silver_satcat.build_satellites(early)
    new = staged(silver_satcat.new_satellites(t.catalog, stored))
    return silver_satcat.number_satellites(new, stored).select(
        "satellite_sk", "norad_cat_id", "object_name", "first_seen_date"
    )


@query
def merge_new_snapshot(t):
    early = t.records.filter(_before("snapshot_date"))
    stored = silver_satcat.build_snapshots(early, silver_satcat.satellite_keys(early))
    new = silver_satcat.new_snapshots(t.orbits, stored)
    keyed = silver_satcat.with_satellite_key(new, t.satellite_keys)
    keyed = staged(numbering.bucketed(keyed, silver_satcat.SNAPSHOT_KEY))
    return silver_satcat.number_snapshots(keyed, stored).select(
        "orbit_snapshot_sk", "satellite_sk", *silver_satcat.SNAPSHOT_KEY, "apogee_km"
    )


@query
def surrogate_keys(t):
    lines = t.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_shipdate").cast("date").alias("day")
    )
    return numbering.dense_number(
        lines, ["l_orderkey", "l_linenumber", "l_partkey", "day"], "line_sk"
    )


# --- gold --------------------------------------------------------------------


@query
def gold_neo_daily_activity(t):
    return gold.neo_daily_activity(t.facts, t.objects)


@query
def gold_neo_hazard_summary(t):
    return gold.neo_hazard_summary(t.facts, t.objects)


@query
def gold_satcat_orbit_summary(t):
    return gold.satcat_orbit_summary(t.catalog, t.orbits)


@query
def gold_ai_neo_features(t):
    return gold.ai_neo_features(t.approaches, t.neo)


@query
def gold_ai_satcat_features(t):
    return gold.ai_satcat_features(t.satellites, t.snapshots)


# --- analyst queries: approaches ---------------------------------------------


@query
def approaches_within_ld_daily(t):
    return analysis.approaches_within(t.facts, LUNAR_LIMIT)


@query
def approaches_within_ld_weekly(t):
    return analysis.approaches_within(t.facts, LUNAR_LIMIT, "week")


@query
def top_closest_approaches(t):
    return analysis.top_closest(t.approaches, t.neo)


@query
def hazardous_by_closeness(t):
    return _placed(analysis.hazardous_by_closeness(gold.neo_hazard_summary(t.facts, t.objects)))


@query
def approach_bands_daily(t):
    return analysis.approach_bands(t.facts)


@query
def discovery_monthly(t):
    return analysis.discoveries_by_month(t.objects)


@query
def hazard_briefing_7d(t):
    return _placed(
        analysis.hazard_briefing(
            t.approaches, t.neo, F.lit(BRIEFING_DAY).cast("date"), LUNAR_LIMIT
        )
    )


@query
def neo_diameter_units(t):
    return analysis.diameter_units(t.objects)


@query
def approach_unit_conversions(t):
    return analysis.approach_units(t.approaches)


@query
def approach_time_parse(t):
    return analysis.approach_times(t.facts)


@query
def neo_names_normalized(t):
    return t.objects.select(
        "neo_id",
        text.normalized(F.concat(F.lit("  "), F.col("name"), F.lit(" "))).alias("name_normalized"),
    )


# --- analyst queries: satellites ---------------------------------------------


@query
def satellites_by_regime(t):
    return analysis.satellites_by_regime(t.orbits)


@query
def satellites_by_regime_owner(t):
    return analysis.satellites_by_regime_owner(t.orbits, t.catalog)


@query
def owner_inclination_band(t):
    found = analysis.owner_inclination_band(t.catalog, t.orbits, "Brand#7", 50.0, 60.0)
    return _placed(found)


@query
def satellite_profile(t):
    return analysis.satellite_profile(gold.satcat_orbit_summary(t.catalog, t.orbits), 42)


@query
def satellite_lookup_stored(t):
    """One satellite from the stored dimension: two loads, of which its bucket is compacted."""
    warehouse, table = _warehouse(t), "silver.satcat_satellite"
    satellites = staged(t.satellites)
    early = _before("first_seen_date", SATELLITES_BEFORE)
    for load, rows in (("early", satellites.filter(early)), ("late", satellites.filter(~early))):
        warehouse.append(rows, table, load)
    one = literal_rows(t.spark, T.StructType().add("norad_cat_id", "integer"), [(42,)])
    warehouse.compact(table, warehouse.parts_of(table, one)[0], "merged")
    return warehouse.find(table, 42)


@query
def orbit_history(t):
    return analysis.orbit_history(t.orbits)


@query
def orbit_deltas(t):
    return analysis.orbit_deltas(t.orbits)


@query
def orbit_anomaly_zscore(t):
    return analysis.orbit_anomalies(t.orbits)


@query
def orbit_anomaly_top(t):
    return analysis.top_anomalies(analysis.orbit_anomalies(t.orbits))


@query
def orbit_anomaly_incremental(t):
    """Scores of the second of two loads, from moments that the first has left."""
    warehouse = _warehouse(t)
    early = _before("snapshot_date")
    for load, negate in LOADS:
        # Each record is in one load only, so nothing is gained by staging them all before.
        records = silver_satcat.parse_records(t.bronze_satcat.filter(~early if negate else early))
        part = silver_satcat.snapshot_candidates(records)
        warehouse.append(part, "silver.satcat_orbit_snapshot", load)
        scored = moments.score_new_snapshots(warehouse, f"score-{load}")
    return scored


@query
def orbit_elements_derived(t):
    return analysis.derived_elements(t.orbits)


@query
def latest_orbit_snapshot(t):
    return analysis.latest_snapshots(t.orbits).select(
        "norad_cat_id", "snapshot_date", "period_minutes", "apogee_km", "perigee_km", "source_group"
    )


# --- quality -----------------------------------------------------------------


def _silver_tables(t: Inputs) -> dict[str, DataFrame]:
    return {
        "silver.neo": t.neo,
        "silver.neo_close_approach": t.approaches,
        "silver.satcat_satellite": t.satellites,
        "silver.satcat_orbit_snapshot": t.snapshots,
    }


def _unkeyed_silver_tables(t: Inputs) -> dict[str, DataFrame]:
    return {
        "silver.neo": t.objects,
        "silver.neo_close_approach": t.facts,
        "silver.satcat_satellite": t.catalog,
        "silver.satcat_orbit_snapshot": t.orbits,
    }


@query
def dq_job_checks(t):
    """The row-level checks are counted while each table is written, as the jobs do."""
    records = [
        quality.staged_and_evaluated(df, JOB_GATES[name])[1]
        for name, df in _unkeyed_silver_tables(t).items()
    ]
    return reduce(DataFrame.unionByName, records)


@query
def dq_table_tests(t):
    tables, records = {}, {}
    for name, df in _silver_tables(t).items():  # staged whole: the marts read them
        tables[name], records[name] = quality.staged_and_evaluated(df, TABLE_TESTS[name])
    neo, approaches, satellites, snapshots = tables.values()
    marts = {
        "gold.neo_daily_activity": gold.neo_daily_activity(approaches, neo),
        "gold.neo_hazard_summary": gold.neo_hazard_summary(approaches, neo),
        "gold.satcat_orbit_summary": gold.satcat_orbit_summary(satellites, snapshots),
        "gold.ai_neo_features": gold.ai_neo_features(approaches, neo),
        "gold.ai_satcat_features": gold.ai_satcat_features(satellites, snapshots),
    }
    tested = quality.evaluate_all(marts, {name: TABLE_TESTS[name] for name in marts})
    return reduce(DataFrame.unionByName, [*records.values(), tested]).drop("details")


@query
def dq_pass_rates(t):
    return ledger.record_pass_rates(dq_job_checks(t))


@query
def dq_duplicates(t):
    return duplicate_keys(t.bronze_neo, silver_neo.APPROACH_KEY)


@query
def dq_foreign_keys(t):
    """Approaches whose object was not known before the cut-off."""
    early = silver_neo.neo_candidates(t.bronze_neo.filter(_before("close_approach_date")))
    return quality.orphans(t.facts, early, "neo_id")


@query
def reconcile_gold_silver(t):
    """The mart lacks the first day and has a day that no fact has."""
    daily = gold.neo_daily_activity(t.facts, t.objects)
    first = t.facts.agg(F.min("close_approach_date")).scalar()
    stray = daily.agg(F.date_add(F.max("close_approach_date"), 1).alias("close_approach_date"))
    kept = daily.filter(F.col("close_approach_date") > first)
    return analysis.reconcile_daily_activity(
        kept.unionByName(stray.withColumn("total_approaches", F.lit(5).cast("long")), True), t.facts
    )


@query
def daily_activity_by_date(t):
    return analysis.daily_activity_by_date(gold.neo_daily_activity(t.facts, t.objects))


@query
def reconcile_totals(t):
    daily = gold.neo_daily_activity(t.facts, t.objects)
    hazard = gold.neo_hazard_summary(t.facts, t.objects)
    return analysis.reconcile_totals(daily, hazard, t.facts)


@query
def layer_row_counts(t):
    return analysis.row_counts(
        {
            "bronze.neo_event_raw": t.bronze_neo,
            "bronze.satcat_raw": t.bronze_satcat,
            "silver.neo": t.objects,
            "silver.neo_close_approach": t.facts,
            "silver.satcat_satellite": t.catalog,
            "silver.satcat_orbit_snapshot": t.orbits,
            "gold.neo_daily_activity": gold.neo_daily_activity(t.facts, t.objects),
            "gold.ai_neo_features": gold.ai_neo_features(
                t.facts.withColumn("approach_sk", F.lit(None).cast("long")), t.objects
            ),
        }
    )


@query
def freshness(t):
    return analysis.freshness(t.bronze_neo, "ingestion_timestamp", _now())


# --- run ledger --------------------------------------------------------------


@query
def run_state(t):
    return t.runs.drop("dag_id", "task_id")


@query
def supervision_failed(t):
    return ledger.failed_runs(t.runs, PIPELINES, _now(), hours=24 * 30)


@query
def supervision_stale(t):
    return _placed(ledger.stale_runs(t.runs, PIPELINES, _now()))


@query
def supervision_issues(t):
    issues = ledger.supervision_issues(t.runs, PIPELINES, _now())
    return issues.groupBy("pipeline_name", "issue").agg(F.count(F.lit(1)).alias("runs"))


@query
def recent_runs(t):
    return ledger.recent_runs(t.runs)


@query
def latest_run_health(t):
    return ledger.latest_run_health(t.runs, _now(), max_age_hours=24)


@query
def run_kpis(t):
    kpis = ledger.weekly_run_kpis(t.runs)
    return kpis.select(
        "week",
        "runs",
        F.round("success_percent", 6).alias("success_percent"),
        F.round("mean_seconds", 6).alias("mean_seconds"),
        F.round("variance_seconds", 3).alias("variance_seconds"),
    )


# --- messages and streams ----------------------------------------------------


@query
def message_encode(t):
    encoded = messages.encode_approaches(
        t.bronze_neo.drop("event_id", "ingestion_timestamp", "feed_start_date", "feed_end_date")
    )
    path = {
        "neo_name": "$.neo_name",
        "hazardous": "$.is_potentially_hazardous_asteroid",
        "day": "$.close_approach_date",
        "diameter_max": "$.estimated_diameter.kilometers.estimated_diameter_max",
        "km_per_second": "$.relative_velocity.kilometers_per_second",
        "lunar": "$.miss_distance.lunar",
        "raw_id": "$.raw_neo.id",
    }
    columns = {name: F.get_json_object("value", p) for name, p in path.items()}
    columns["diameter_max"] = columns["diameter_max"].cast("double")
    return encoded.select("key", *[c.alias(name) for name, c in columns.items()])


@query
def message_encode_catalog(t):
    encoded = messages.encode_catalog(t.bronze_satcat, F.col("ingestion_timestamp"))
    path = {
        "snapshot_group": "$.snapshot_group",
        "snapshot_timestamp": "$.snapshot_timestamp",
        "object_name": "$.satcat.OBJECT_NAME",
        "apogee": "$.satcat.APOGEE",
    }
    return encoded.select(
        "key", *[F.get_json_object("value", p).alias(name) for name, p in path.items()]
    )


def _write_lines(t: Inputs, values: DataFrame, label: str) -> str:
    """Message files. A compressed one is read by one task, so a file has MESSAGES_PER_FILE at most."""
    path = fresh_dir(t.spark, label)
    writer = values.select("value").write.option("compression", "gzip")
    writer.option("maxRecordsPerFile", str(MESSAGES_PER_FILE)).text(path)
    return path


def _run_stream(t: Inputs, start, lines: str, label: str) -> Warehouse:
    """Run the stream over all message files that are there, then return its tables."""
    warehouse = Warehouse(t.spark, fresh_dir(t.spark, f"{label}-tables"))
    checkpoint = fresh_dir(t.spark, f"{label}-checkpoint")
    stream = start(
        messages.file_stream(t.spark, lines), warehouse, checkpoint, availableNow=True
    )
    stream.awaitTermination()
    return warehouse


@query
def stream_neo_to_bronze(t):
    sent = messages.encode_approaches(
        t.bronze_neo.drop("event_id", "ingestion_timestamp", "feed_start_date", "feed_end_date")
    )
    lines = _write_lines(t, sent, "neo-messages")
    landed = _run_stream(t, streams.start_approach_stream, lines, "neo-stream")
    objects_and_facts = silver_neo.approach_candidates(landed.read("bronze.neo_event_raw"))
    return objects_and_facts.select(
        *silver_neo.APPROACH_KEY,
        "close_approach_date",
        "epoch_date_close_approach",
        "rel_velocity_km_s",
        "miss_distance_km",
        "miss_distance_lunar",
    )


@query
def stream_satcat_to_bronze(t):
    sent = messages.encode_catalog(t.bronze_satcat, F.col("ingestion_timestamp"))
    lines = _write_lines(t, sent, "satcat-messages")
    landed = _run_stream(t, streams.start_catalog_stream, lines, "satcat-stream")
    records = silver_satcat.parse_records(landed.read("bronze.satcat_raw"))
    return records.groupBy("norad_cat_id", "snapshot_date", "source_group").agg(
        F.count(F.lit(1)).alias("messages"),
        F.min("apogee_km").alias("min_apogee_km"),
        F.max("perigee_km").alias("max_perigee_km"),
    )


@query
def stream_neo_stateful(t):
    """Two starts on one checkpoint; the second gets all messages again, and new ones."""
    early = t.bronze_neo.filter(_before("close_approach_date"))
    warehouse = _warehouse(t)
    checkpoint, lines = (fresh_dir(t.spark, f"stateful-{n}") for n in ("checkpoint", "messages"))
    for rows in (early, t.bronze_neo):
        sent = messages.encode_approaches(
            rows.drop("event_id", "ingestion_timestamp", "feed_start_date", "feed_end_date")
        )
        writer = sent.select("value").write.mode("append").option("compression", "gzip")
        writer.option("maxRecordsPerFile", str(MESSAGES_PER_FILE)).text(lines)
        source = messages.file_stream(t.spark, lines)
        for stream in streams.start_unique_approach_stream(
            source, warehouse, checkpoint, availableNow=True
        ):
            stream.awaitTermination()
    landed = warehouse.read("bronze.neo_event_raw")
    return landed.groupBy(*silver_neo.APPROACH_KEY).agg(
        F.count(F.lit(1)).alias("copies"), F.countDistinct("event_id").alias("ids")
    )


@query
def stream_satcat_file_sink(t):
    """The file sink over all messages, started twice on one checkpoint."""
    sent = messages.encode_catalog(t.bronze_satcat, F.col("ingestion_timestamp"))
    lines = _write_lines(t, sent, "sink-messages")
    path, checkpoint = (fresh_dir(t.spark, f"satcat-{n}") for n in ("files", "files-checkpoint"))
    for _ in range(2):
        streams.start_catalog_file_stream(
            messages.file_stream(t.spark, lines), path, checkpoint, availableNow=True
        ).awaitTermination()
    records = silver_satcat.variant_records(streams.read_catalog_files(t.spark, path))
    return records.groupBy("norad_cat_id", "snapshot_date", "source_group").agg(
        F.count(F.lit(1)).alias("messages"),
        F.min("apogee_km").alias("min_apogee_km"),
        F.max("perigee_km").alias("max_perigee_km"),
    )


@query
def stream_silver_lag(t):
    """A stream, then the job that takes its batches over: all within the limit of 30 minutes."""
    log = streams.ProgressLog()
    t.spark.streams.addListener(log)
    try:
        sent = messages.encode_catalog(t.bronze_satcat, F.col("ingestion_timestamp"))
        lines = _write_lines(t, sent, "lag-messages")
        warehouse = _run_stream(t, streams.start_catalog_stream, lines, "lag-stream")
        # The report of a batch comes after the batch.
        deadline = time.monotonic() + 60
        while not log.store(warehouse, "progress") and time.monotonic() < deadline:
            time.sleep(0.2)
    finally:
        t.spark.streams.removeListener(log)
    jobs.recorded(warehouse, "satcat_to_silver", lambda run: jobs.satcat_to_silver(warehouse, run))
    runs = ledger.run_state(warehouse.read("meta.pipeline_run"))
    lags = streams.silver_lag(warehouse.read("meta.stream_progress"), runs)
    return lags.groupBy("stream").agg(
        F.sum("input_rows").alias("input_rows"),
        F.bool_and("is_fresh").alias("is_fresh"),
        F.bool_and(F.col("lag_seconds") >= 0).alias("in_order"),
    )


@query
def stream_quarantine(t):
    """Event properties sent as catalog messages: some broken, some without key or time."""
    value = (
        F.when(F.col("event_type") == "error", F.concat(F.lit('{"snapshot_group": '), "props"))
        .when(F.col("event_type") == "view", F.col("props"))
        .when(
            F.col("event_type") == "click",
            F.concat(F.lit('{"snapshot_group":"active","satcat":'), "props", F.lit("}")),
        )
        .otherwise(
            F.concat(
                F.lit('{"snapshot_group":"active","snapshot_timestamp":"2024-01-01T00:00:00"'),
                F.lit(',"satcat":'),
                "props",
                F.lit("}"),
            )
        )
    )
    lines = _write_lines(t, t.table("events").select(value.alias("value")), "event-messages")
    landed = _run_stream(t, streams.start_catalog_stream, lines, "event-stream")
    return streams.quarantine_counts(landed.read("bronze.quarantine"))


# --- models ------------------------------------------------------------------


@query
def ml_stratified_split(t):
    features = gold.ai_neo_features(t.approaches, t.neo)
    return ml.stratified_split(
        features.select("approach_sk", "is_hazardous_label"), "approach_sk", "is_hazardous_label"
    )


def _features(t: Inputs) -> DataFrame:
    return gold.ai_neo_features(t.approaches, t.neo)


@query
def ml_hazard_scores(t):
    """One score per approach: its range, its label and whether a feature was missing."""
    features = staged(_features(t))
    model, _ = ml.train_hazard(features)
    return ml.score_hazard(model, features).select(
        "entity_key",
        "snapshot_ref",
        F.col("predicted_score").between(0.0, 1.0).alias("in_range"),
        (F.col("predicted_label") == (F.col("predicted_score") > 0.5).cast("int").cast("string"))
        .alias("label_follows"),
        "is_imputed",
    )


def _magnitude_rule(features: DataFrame, cut: float = -22.0) -> DataFrame:
    """A fixed score, whole magnitudes with a cut, as a model's output."""
    score = -F.floor("absolute_magnitude_h").cast("double")
    return features.select(
        "is_hazardous_label",
        array_to_vector(F.array(-score, score)).alias("rawPrediction"),
        (score >= cut).cast("double").alias("prediction"),
    )


@query
def ml_hazard_metrics(t):
    """The trained model's metrics on its test split; its ROC AUC has to beat that of a fixed rule."""
    features = staged(_features(t))
    _, metrics = ml.train_hazard(features)
    rule = ml.binary_metrics(_magnitude_rule(features)).filter("metric_name = 'roc_auc'")
    auc = rule.first()["metric_value"]
    is_auc = F.col("metric_name") == "roc_auc"
    return metrics.select(
        "metric_name",
        F.col("metric_value").between(0.0, 1.0).alias("in_range"),
        F.when(is_auc, F.lit(round(auc, 9))).alias("rule_auc"),
        F.when(is_auc, F.col("metric_value") > auc).alias("beats_rule"),
    )


@query
def ml_binary_metrics(t):
    """Metrics of a fixed score: whole magnitudes, with a cut at 22."""
    metrics = ml.binary_metrics(_magnitude_rule(_features(t)))
    return metrics.select("metric_name", F.round("metric_value", 9).alias("metric_value"))


@query
def ml_regime_agreement(t):
    latest = staged(analysis.latest_snapshots(t.orbits))  # what both of the model's steps work on
    model, _ = ml.train_regime(latest)
    scored = ml.predicted_regimes(model, latest)
    agreement = staged(ml.regime_agreement(scored))
    # A model that always answers with the commonest class agrees in just its share.
    known = agreement.filter("predicted_regime IS NOT NULL")
    agreed = F.when(F.col("orbit_regime") == F.col("predicted_regime"), F.col("satellites"))
    hits = known.agg(F.sum(agreed)).scalar()
    largest = known.groupBy("orbit_regime").agg(F.sum("satellites").alias("n")).agg(F.max("n"))
    return agreement.groupBy("orbit_regime").agg(
        F.sum("satellites").alias("satellites"),
        F.sum(F.when(F.col("predicted_regime").isNull(), F.col("satellites")).otherwise(0)).alias(
            "without_prediction"
        ),
    ).select("*", largest.scalar().alias("largest_class"), (hits > largest.scalar()).alias("beats_it"))


@query
def ml_class_metrics(t):
    """Regime by rule against a guess from the apogee alone."""
    guess = F.when(F.col("apogee_km") < 20000, F.lit("LEO")).otherwise(F.lit("GEO"))
    latest = analysis.with_regime(analysis.latest_snapshots(t.orbits)).withColumn("guess", guess)
    metrics = ml.class_metrics(latest, "orbit_regime", "guess")
    return metrics.select("metric_name", F.round("metric_value", 9).alias("metric_value"))


@query
def ml_clusters(t):
    """Clusters of latest orbits; they have to leave less variance inside than the orbit regimes."""
    latest = staged(analysis.latest_snapshots(t.orbits))  # read by every pass of the model
    assigned, silhouette = ml.cluster_orbits(latest)
    rows = staged(assigned.join(analysis.with_regime(latest), "norad_cat_id"))
    complete = rows.filter(F.col("cluster").isNotNull())
    rule = ml.within_share(complete, "orbit_regime")
    return rows.select(
        "norad_cat_id",
        F.col("cluster").isNotNull().alias("is_clustered"),
        F.coalesce(F.col("cluster").between(0, 3), F.lit(True)).alias("in_range"),
        F.lit(-1.0 <= silhouette <= 1.0).alias("silhouette_in_range"),
        F.round(F.lit(rule), 9).alias("rule_share"),
        F.lit(ml.within_share(complete, "cluster") < rule).alias("beats_rule"),
    )


def _three_hazard_models(t: Inputs, features: DataFrame) -> tuple[Warehouse, list[str]]:
    """A fixed rule registered three times: another cut, the cut at 22, and one that missed its gate."""
    warehouse = _warehouse(t)
    model = PipelineModel([VectorAssembler(inputCols=["absolute_magnitude_h"], outputCol="features")])
    ids = []
    for n, (cut, passed) in enumerate([(-20.0, True), (-22.0, True), (-24.0, False)]):
        metrics = ml.binary_metrics(_magnitude_rule(features, cut))
        ids.append(
            model_jobs.register(
                warehouse, f"train-{n}", model, metrics, ml.HAZARD_MODEL, "rule",
                "gold.ai_neo_features", fresh_dir(t.spark, "models"), passed, {},
            )
        )
    return warehouse, ids


@query
def ml_active_model_metrics(t):
    """Metrics of the active one of three versions, from the registry in the warehouse."""
    warehouse, _ = _three_hazard_models(t, staged(_features(t)))
    found = model_jobs.active_model_metrics(warehouse)
    return found.withColumn("metric_value", F.round("metric_value", 9))


@query
def ml_hazard_top_risk(t):
    """Riskiest approaches by the active version; the two others have scored all approaches too."""
    features = staged(_features(t))
    warehouse, ids = _three_hazard_models(t, features)
    risk = F.lit(1.0) / (F.lit(1.0) + F.col("absolute_magnitude_h"))
    for n, (model_id, factor) in enumerate(zip(ids, (2.0, 1.0, 3.0))):
        scores = features.select(
            F.lit("neo").alias("entity_type"),
            F.col("neo_id").alias("entity_key"),
            F.col("approach_sk").cast("string").alias("snapshot_ref"),
            (risk > 0.05).cast("int").cast("string").alias("predicted_label"),
            (risk * factor).alias("predicted_score"),
        )
        warehouse.append(ml.prediction_rows(scores, model_id, f"score-{n}"), "ml.prediction", f"score-{n}")
    return model_jobs.hazard_top_risk(warehouse)


@query
def ml_active_top_predictions(t):
    """Top scores of the active one of three versions of an anomaly model."""
    registry = literal_rows(t.spark, MODEL_REGISTRY, [])
    for passed in (True, True, False):
        row = ml.registry_row(
            registry, "orbit_anomaly", "z_score", "silver.satcat_orbit_snapshot", "models",
            datetime(2001, 1, 1), "run", passed, {},
        ).first()
        registry = registry.union(literal_rows(t.spark, MODEL_REGISTRY, [row]))
    active = ml.active_models(registry).first()["model_id"]
    anomalies = analysis.orbit_anomalies(t.orbits).filter(F.col("anomaly_score").isNotNull())
    predictions = ml.prediction_rows(ml.anomaly_scores(anomalies), active, "run")
    return ml.top_predictions(predictions, registry, "orbit_anomaly")


# --- jobs --------------------------------------------------------------------


def _warehouse(t: Inputs) -> Warehouse:
    return Warehouse(t.spark, fresh_dir(t.spark, "job-tables"))


LOADS = (("early", False), ("late", True))


def _land_approaches(t: Inputs, warehouse: Warehouse) -> None:
    """Two loads of approaches, cut by date."""
    approaches = t.bronze_neo.withColumnRenamed("event_id", "position")  # each load stages its rows
    day = _before("close_approach_date")
    for run, negate in LOADS:
        part = approaches.filter(~day if negate else day)
        jobs.land_approaches(warehouse, part, run, ["position"])


def _land(t: Inputs, warehouse: Warehouse) -> None:
    """Two loads of approaches and of catalog snapshots, cut by date."""
    _land_approaches(t, warehouse)
    catalog = t.bronze_satcat.drop("id")  # each load stages its rows
    day = _before("snapshot_date")
    for run, negate in LOADS:
        jobs.land_catalog(warehouse, catalog.filter(~day if negate else day), run)


@query
def job_neo_increment(t):
    """Two loads, each taken to silver by a job run of its own."""
    warehouse = _warehouse(t)
    _land(t, warehouse)
    for load in ("early", "late"):
        jobs.neo_to_silver(warehouse, f"silver-{load}", [load])
    facts, objects = (warehouse.read(n) for n in ("silver.neo_close_approach", "silver.neo"))
    keys = objects.select("neo_sk", F.col("neo_id").alias("_id"))
    right = F.col("neo_id") == F.col("_id")
    return facts.join(keys, "neo_sk").select(
        *silver_neo.APPROACH_KEY, "close_approach_date", "rel_velocity_km_s", "miss_distance_km",
        right.alias("key_fits"),
    )


@query
def job_satcat_increment(t):
    warehouse = _warehouse(t)
    _land(t, warehouse)
    for load in ("early", "late"):
        jobs.satcat_to_silver(warehouse, f"silver-{load}", [load])
    return warehouse.read("silver.satcat_orbit_snapshot").groupBy("norad_cat_id").agg(
        F.count(F.lit(1)).alias("snapshots"),
        F.countDistinct("satellite_sk").alias("keys"),
        F.min("snapshot_date").alias("first_day"),
        F.max("snapshot_date").alias("last_day"),
    )


SILVER_TABLES = (
    "silver.neo", "silver.neo_close_approach", "silver.satcat_satellite",
    "silver.satcat_orbit_snapshot",
)


@query
def job_rerun_counts(t):
    """Rows after one run of the jobs, and after another run over the same input."""
    warehouse = _warehouse(t)
    _land(t, warehouse)
    counts = []
    for run in ("first", "second"):
        jobs.neo_to_silver(warehouse, run)
        jobs.satcat_to_silver(warehouse, run)
        counts.append(staged(analysis.row_counts({n: warehouse.read(n) for n in SILVER_TABLES})))
    first, second = (
        c.withColumnRenamed("row_count", name) for c, name in zip(counts, ("first_run", "second_run"))
    )
    return first.join(second, "table_name")


@query
def job_dq_ledger(t):
    """What the ledger holds after a gate has failed, and how many rows the job has added."""
    warehouse = _warehouse(t)
    bad = t.bronze_neo.withColumn("absolute_magnitude_h", F.col("absolute_magnitude_h") + 29.5)
    jobs.land_approaches(
        warehouse, bad.withColumnRenamed("event_id", "position"), "load", ["position"]
    )
    try:
        jobs.recorded(warehouse, "neo_to_silver", lambda run: jobs.neo_to_silver(warehouse, run))
    except QualityGateError:
        pass  # the outcome is in the ledger
    records = warehouse.read("meta.data_quality_run")
    runs = ledger.run_state(warehouse.read("meta.pipeline_run"))
    run_status = runs.select("run_id", F.col("status").alias("run_status"))
    added = analysis.row_counts({"a": warehouse.read("silver.neo")}).agg(F.max("row_count")).scalar()
    return records.join(run_status, "run_id").select(
        "check_name", "status", "total_records", "failed_records", "run_status",
        added.alias("rows_added"),
    )


@query
def job_gold_tables(t):
    """Rows and totals of the marts that the job has built, and the outcome of its tests."""
    warehouse = _warehouse(t)
    _land(t, warehouse)
    jobs.neo_to_silver(warehouse, "s")
    jobs.satcat_to_silver(warehouse, "s")
    jobs.silver_to_gold(warehouse, "g")
    totals = {
        "gold.neo_daily_activity": F.sum("total_approaches"),
        "gold.neo_hazard_summary": F.sum("total_approaches"),
        "gold.satcat_orbit_summary": F.sum("snapshot_count"),
        "gold.ai_neo_features": F.count("approach_sk"),
        "gold.ai_satcat_features": F.count("orbit_snapshot_sk"),
    }
    parts = [
        warehouse.read(name).agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"), total.alias("total")
        )
        for name, total in totals.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def job_gold_increment(t):
    """Marts after two loads, each taken to gold by a job that only adds what is new."""
    warehouse = _warehouse(t)
    _land_approaches(t, warehouse)
    day = _before("snapshot_date")
    for load, negate in LOADS:
        # Stored with the ids that they have, which decide between two snapshots of a day.
        part = t.bronze_satcat.filter(~day if negate else day)
        warehouse.append(part, "bronze.satcat_raw", load)
        jobs.neo_to_silver(warehouse, load, [load])
        jobs.satcat_to_silver(warehouse, load, [load])
        jobs.silver_changes_to_gold(warehouse, f"gold-{load}")
    text, number = "string", "double"

    def rows(table: str, key: str, first: str, n: str | None, value: str | None) -> DataFrame:
        return warehouse.read(table).select(
            F.lit(table).alias("mart"),
            F.col(key).cast(text).alias("entity"),
            F.col(first).alias("day"),
            (F.col(n) if n else F.lit(None)).cast("long").alias("n"),
            (F.col(value) if value else F.lit(None)).cast(number).alias("value"),
        )

    parts = [
        rows("gold.neo_daily_activity", "unique_objects", "close_approach_date", "total_approaches",
             "hazardous_approaches"),
        rows("gold.neo_hazard_summary", "neo_id", "last_approach_date", "total_approaches",
             "closest_approach_km"),
        rows("gold.satcat_orbit_summary", "norad_cat_id", "last_snapshot_date", "snapshot_count",
             "avg_apogee_km"),
        rows("gold.ai_neo_features", "neo_id", "close_approach_date", "is_hazardous_label",
             "miss_distance_km"),
        rows("gold.ai_satcat_features", "norad_cat_id", "snapshot_date", None, "perigee_km"),
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def stream_ledger(t):
    """What the ledger holds after a stream has run over all catalog messages."""
    sent = messages.encode_catalog(t.bronze_satcat, F.col("ingestion_timestamp"))
    lines = _write_lines(t, sent, "ledger-messages")
    landed = _run_stream(t, streams.start_catalog_stream, lines, "ledger-stream")
    runs = ledger.run_state(landed.read("meta.pipeline_run"))
    return runs.groupBy("pipeline_name", "triggered_by", "status").agg(
        F.sum("records_processed").alias("records"),
        F.bool_and(F.col("end_time") >= F.col("start_time")).alias("in_order"),
    )


@query
def feed_to_messages(t):
    """Feed documents flattened, then encoded as stream messages."""
    rows = feed.bronze_rows(
        _feed_documents(t), F.lit("1995-01-01").cast("date"), F.lit("1995-01-07").cast("date")
    )
    sent = messages.encode_approaches(rows.drop("feed_start_date", "feed_end_date"))
    return sent.select(
        "key",
        F.get_json_object("value", "$.neo_name").alias("neo_name"),
        F.get_json_object("value", "$.close_approach_date").alias("day"),
        F.get_json_object("value", "$.miss_distance.kilometers").alias("kilometers"),
    )


@query
def freshness_silver(t):
    """Freshness of the newest facts under the limit for streams, 30 minutes."""
    newest = t.runs.filter("status = 'success'")
    return analysis.freshness(newest, "end_time", _now(), limit_hours=0.5)


@query
def dq_recent(t):
    """Newest quality records of the ledger, after a job has written some."""
    warehouse = _warehouse(t)
    _land_approaches(t, warehouse)
    jobs.neo_to_silver(warehouse, "silver")
    records = ledger.recent_checks(warehouse.read("meta.data_quality_run"))
    return _placed(records.drop("created_at"))
