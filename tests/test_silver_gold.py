import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from skyledger.plans import analysis, gold, silver_neo, silver_satcat
from tests.samples import dicts, event, neo_frame, record, satcat_frame


def test_dimension_takes_the_latest_attributes_and_the_whole_date_span(spark):
    bronze = neo_frame(
        spark,
        event(1, "a", close_approach_date=date(2025, 1, 5), neo_name="late"),
        event(2, "a", close_approach_date=date(2025, 1, 1), neo_name="early"),
        event(3, "b", estimated_diameter=None),
    )
    a, b = dicts(silver_neo.build_neo(bronze), "neo_id")
    assert (a["name"], a["first_seen_date"], a["last_seen_date"]) == (
        "late", date(2025, 1, 1), date(2025, 1, 5),
    )
    assert (a["estimated_diameter_km_min"], a["estimated_diameter_km_max"]) == (0.1, 0.25)
    assert b["estimated_diameter_km_min"] is None
    assert {a["neo_sk"], b["neo_sk"]} == {1, 2}
    assert a["is_sentry_object"] is None and a["nasa_jpl_url"] is None


def test_approach_dedup_keeps_the_lowest_event_and_null_is_a_key_value(spark):
    bronze = neo_frame(
        spark,
        event(2, "a", miss_distance=json.dumps({"kilometers": "2"})),
        event(1, "a", miss_distance=json.dumps({"kilometers": "1"})),
        event(3, "a", full=None),
        event(4, "a", full=None),
        event(5, "a", body="Moon"),
    )
    rows = dicts(silver_neo.approach_candidates(bronze), "orbiting_body", "close_approach_date_full")
    assert len(rows) == 3
    assert rows[1]["miss_distance_km"] == 1.0
    assert rows[1]["miss_distance_lunar"] is None


def test_dirty_numbers_become_null(spark):
    bronze = neo_frame(
        spark,
        event(1, "a", relative_velocity="not json", miss_distance='{"lunar": "", "kilometers": "x"}'),
    )
    row = dicts(silver_neo.approach_candidates(bronze))[0]
    assert row["rel_velocity_km_s"] is None
    assert row["miss_distance_lunar"] is None and row["miss_distance_km"] is None


def test_facts_without_a_dimension_row_are_left_out(spark):
    bronze = neo_frame(spark, event(1, "a"), event(2, "b"))
    dim = silver_neo.build_neo(neo_frame(spark, event(1, "a")))
    assert [r["neo_id"] for r in dicts(silver_neo.build_approaches(bronze, dim))] == ["a"]


def test_merges_find_only_new_rows(spark):
    old = neo_frame(spark, event(1, "a"), event(2, "a", full=None))
    both = neo_frame(
        spark, event(1, "a"), event(2, "a", full=None), event(3, "a", full="2025-Feb-01 00:00"),
        event(4, "b"),
    )
    dim = silver_neo.build_neo(old)
    facts = silver_neo.build_approaches(old, dim)
    new_dims = silver_neo.new_neos(silver_neo.neo_candidates(both), dim)
    numbered = dicts(silver_neo.number_neos(new_dims, dim))
    assert [(r["neo_id"], r["neo_sk"]) for r in numbered] == [("b", 2)]
    new = silver_neo.new_approaches(silver_neo.approach_candidates(both), facts)
    assert sorted((r["neo_id"], r["close_approach_date_full"]) for r in dicts(new)) == [
        ("a", "2025-Feb-01 00:00"), ("b", "2025-Jan-03 12:34"),
    ]


def test_catalog_typing(spark):
    bronze = satcat_frame(
        spark,
        record(1, RCS="", PERIOD="abc", LAUNCH_DATE="2024-13-45", DECAY_DATE=""),
        record(2, norad=""),
        record(3, norad="x7"),
        (4, "active", date(2025, 1, 3), "raw", None),
        (5, "active", date(2025, 1, 3), "raw", "not json"),
    )
    rows = dicts(silver_satcat.parse_records(bronze))
    assert len(rows) == 1
    row = rows[0]
    assert row["norad_cat_id"] == 25544
    assert row["rcs"] is None and row["period_minutes"] is None
    assert row["launch_date"] is None and row["decay_date"] is None
    assert row["apogee_km"] == 420.0


def test_catalog_record_is_parsed_once(spark, tmp_path):
    satcat_frame(spark, record(1)).write.parquet(str(tmp_path / "b"))
    parsed = silver_satcat.parse_records(spark.read.parquet(str(tmp_path / "b")))
    text = parsed._jdf.queryExecution().executedPlan().toString()
    assert text.count("json_tuple(") == 1 and "from_json" not in text


def test_one_snapshot_per_satellite_and_day(spark):
    bronze = satcat_frame(
        spark,
        record(2, group="all", APOGEE="500"),
        record(1, group="active", APOGEE="420"),
        record(3, day=date(2025, 1, 4)),
    )
    rows = dicts(silver_satcat.snapshot_candidates(silver_satcat.parse_records(bronze)), "snapshot_date")
    assert [(r["snapshot_date"].day, r["source_group"], r["apogee_km"]) for r in rows] == [
        (3, "active", 420.0), (4, "active", 420.0),
    ]
    assert rows[0]["ecc"] is None and rows[0]["mean_motion_rev_per_day"] is None


def test_satellite_keys_are_those_of_the_dimension(spark):
    bronze = satcat_frame(spark, *[record(i, norad=str(i % 7)) for i in range(20)])
    records = silver_satcat.parse_records(bronze)
    whole = silver_satcat.build_satellites(records).select("satellite_sk", "norad_cat_id")
    keys = silver_satcat.satellite_keys(records).select("satellite_sk", "norad_cat_id")
    assert sorted(keys.collect()) == sorted(whole.collect()) and keys.count() == 7


def test_satellite_takes_the_latest_record(spark):
    bronze = satcat_frame(
        spark,
        record(1, day=date(2025, 1, 4), OWNER="NEW"),
        record(2, day=date(2025, 1, 3), OWNER="OLD"),
    )
    row = dicts(silver_satcat.build_satellites(silver_satcat.parse_records(bronze)))[0]
    assert (row["owner"], row["first_seen_date"], row["last_seen_date"]) == (
        "NEW", date(2025, 1, 3), date(2025, 1, 4),
    )


# --- gold ---


@pytest.fixture(scope="module")
def facts(spark):
    schema = (
        "approach_sk LONG, neo_id STRING, close_approach_date DATE, miss_distance_km DOUBLE, "
        "miss_distance_lunar DOUBLE, miss_distance_au DOUBLE, rel_velocity_km_s DOUBLE, "
        "rel_velocity_km_h DOUBLE"
    )
    d1, d2 = date(2025, 1, 1), date(2025, 1, 9)
    return spark.createDataFrame(
        [
            (1, "a", d1, 100.0, 1.0, 0.1, 5.0, 18000.0),
            (2, "a", d1, 90.0, 0.9, 0.1, 6.0, 21600.0),
            (3, "b", d1, 80.0, None, 0.1, 7.0, 25200.0),
            (4, "b", d2, 70.0, 6.0, 0.1, 8.0, 28800.0),
            (5, "lost", d2, 60.0, 0.5, 0.1, 9.0, 32400.0),
        ],
        schema,
    )


@pytest.fixture(scope="module")
def neo(spark):
    return spark.createDataFrame(
        [("a", "Apollo", True, 20.0, date(2025, 1, 1)), ("b", "Bennu", None, 21.0, date(2025, 2, 1))],
        "neo_id STRING, name STRING, is_potentially_hazardous_asteroid BOOLEAN, "
        "absolute_magnitude_h DOUBLE, first_seen_date DATE",
    )


def test_daily_activity_counts_only_facts_with_a_dimension_row(facts, neo):
    rows = dicts(gold.neo_daily_activity(facts, neo), "close_approach_date")
    assert [tuple(r.values())[1:] for r in rows] == [(3, 2, 2), (1, 1, 0)]


def test_hazard_summary_keeps_facts_without_a_dimension_row(facts, neo):
    rows = {r["neo_id"]: r for r in dicts(gold.neo_hazard_summary(facts, neo))}
    assert rows["a"]["total_approaches"] == 2 and rows["a"]["closest_approach_km"] == 90.0
    assert rows["a"]["is_hazardous"] is True
    assert rows["lost"]["name"] is None and rows["lost"]["is_hazardous"] is None
    assert rows["lost"]["total_approaches"] == 1


def test_marts_equal_the_join_first_form_even_with_a_repeated_dimension_key(spark, facts, neo):
    twice = neo.unionByName(neo.filter("neo_id = 'a'"))
    facts.createOrReplaceTempView("f")
    twice.createOrReplaceTempView("n")
    daily = spark.sql(
        "SELECT close_approach_date, count(*) AS total_approaches, "
        "count(DISTINCT neo_id) AS unique_objects, "
        "sum(CASE WHEN is_potentially_hazardous_asteroid THEN 1 ELSE 0 END) AS hazardous_approaches "
        "FROM f JOIN n USING (neo_id) GROUP BY close_approach_date"
    )
    key = "close_approach_date"
    assert dicts(gold.neo_daily_activity(facts, twice), key) == dicts(daily, key)
    summary = spark.sql("SELECT neo_id, count(*) AS c FROM f LEFT JOIN n USING (neo_id) GROUP BY neo_id")
    got = {r["neo_id"]: r["total_approaches"] for r in dicts(gold.neo_hazard_summary(facts, twice))}
    assert got == {r["neo_id"]: r["c"] for r in summary.collect()}


def test_feature_label_counts_null_as_zero(facts, neo):
    rows = dicts(gold.ai_neo_features(facts, neo), "approach_sk")
    assert [r["is_hazardous_label"] for r in rows] == [1, 1, 0, 0]


def test_gold_reconciles_with_silver(facts, neo):
    daily = gold.neo_daily_activity(facts, neo)
    hazard = gold.neo_hazard_summary(facts, neo)
    totals = {r["source"]: r["total"] for r in analysis.reconcile_totals(daily, hazard, facts).collect()}
    assert totals == {
        "gold.neo_daily_activity": 4,
        "gold.neo_hazard_summary": 5,
        "silver.neo_close_approach": 5,
    }
    by_day = dicts(analysis.reconcile_daily_activity(daily, facts), "close_approach_date")
    assert [r["difference"] for r in by_day] == [0, -1]
    stale = daily.limit(1).withColumn("close_approach_date", F.lit("2030-01-01").cast("date"))
    by_day = dicts(
        analysis.reconcile_daily_activity(daily.unionByName(stale), facts), "close_approach_date"
    )
    assert (by_day[-1]["silver_total"], by_day[-1]["difference"]) == (0, by_day[-1]["gold_total"])


def test_daily_activity_by_date(facts, neo):
    rows = analysis.daily_activity_by_date(gold.neo_daily_activity(facts, neo)).collect()
    days = [r["close_approach_date"] for r in rows]
    assert days == sorted(days) and [r["place"] for r in rows] == list(range(1, len(days) + 1))


# --- analysis ---


def test_threshold_counts(facts):
    day = dicts(analysis.approaches_within(facts, 1.0), "period_start")
    assert [r["approaches"] for r in day] == [2, 1]
    week = dicts(analysis.approaches_within(facts, 10.0, "week"), "period_start")
    assert [(r["period_start"], r["approaches"]) for r in week] == [
        (date(2024, 12, 30), 2), (date(2025, 1, 6), 2),
    ]


def test_top_closest_sorts_null_last_and_skips_facts_without_object(facts, neo):
    everything = analysis.top_closest(facts, neo, 10).collect()
    assert [r["approach_sk"] for r in everything] == [2, 1, 4, 3] or len(everything) == 4
    assert [r["approach_sk"] for r in analysis.top_closest(facts, neo, 3).collect()] == [2, 1, 4]


def test_hazard_briefing_window_is_seven_days(facts, neo):
    def ids(first):
        rows = analysis.hazard_briefing(facts, neo, F.lit(first).cast("date"), 10.0).collect()
        return [r["approach_sk"] for r in rows]

    assert ids("2025-01-01") == [2, 1]
    assert ids("2025-01-03") == [4]
    assert ids("2025-01-02") == []


def test_hazardous_objects_closest_first(facts, neo):
    rows = analysis.hazardous_by_closeness(gold.neo_hazard_summary(facts, neo)).collect()
    assert [r["neo_id"] for r in rows] == ["a"]


def test_bands_and_discoveries(facts, neo):
    bands = dicts(analysis.approach_bands(facts), "close_approach_date")
    assert (bands[0]["min_ld"], bands[0]["avg_velocity"], bands[0]["max_velocity"]) == (0.9, 6.0, 7.0)
    months = dicts(analysis.discoveries_by_month(neo), "month")
    assert [(r["month"], r["discoveries"]) for r in months] == [
        (date(2025, 1, 1), 1), (date(2025, 2, 1), 1),
    ]


@pytest.fixture(scope="module")
def snapshots(spark):
    def row(norad, day, period, apogee, perigee, inclination=50.0):
        return (norad, date(2025, 1, day), period, apogee, perigee, inclination)

    return spark.createDataFrame(
        [
            row(1, 1, 90.0, 400.0, 390.0), row(1, 2, 90.0, 400.0, 390.0),
            row(1, 3, 91.0, 410.0, 390.0), row(1, 4, 91.0, 500.0, 390.0),
            row(2, 1, 95.0, 600.0, 590.0),
            row(3, 1, 96.0, 700.0, 690.0), row(3, 2, 96.0, 700.0, 690.0), row(3, 3, 96.0, 700.0, 690.0),
            row(4, 1, 1436.0, 35786.0, 35786.0, 0.0), row(5, 1, None, None, None, None),
        ],
        "norad_cat_id INT, snapshot_date DATE, period_minutes DOUBLE, apogee_km DOUBLE, "
        "perigee_km DOUBLE, inclination_deg DOUBLE",
    )


def test_history_and_deltas(snapshots):
    history = dicts(analysis.orbit_history(snapshots).filter("norad_cat_id = 1"), "snapshot_date")
    assert [(r["snapshot_number"], r["is_changed"]) for r in history] == [
        (1, False), (2, False), (3, True), (4, True),
    ]
    deltas = dicts(analysis.orbit_deltas(snapshots).filter("norad_cat_id = 1"), "snapshot_date")
    assert [r["delta_apogee_km"] for r in deltas] == [None, 0.0, 10.0, 90.0]


def test_anomaly_score_needs_varying_deltas(snapshots):
    scores = {
        (r["norad_cat_id"], r["snapshot_date"].day): r["anomaly_score"]
        for r in analysis.orbit_anomalies(snapshots).collect()
    }
    assert scores[(2, 1)] is None  # a single snapshot
    assert scores[(3, 2)] is None  # a constant orbit
    # Period deltas of satellite 1 are 0, 1, 0: mean 1/3, deviation 1/sqrt(3).
    assert scores[(1, 3)] == 1.154701
    # Apogee deltas are 0, 10, 90: mean 100/3, variance 7300/3.
    assert scores[(1, 4)] == round((90 - 100 / 3) / (7300 / 3) ** 0.5, 6)
    top = analysis.top_anomalies(analysis.orbit_anomalies(snapshots), 1).collect()
    assert (top[0]["norad_cat_id"], top[0]["snapshot_date"].day) == (1, 3)


def test_regime_counts_cover_every_satellite_once(spark, snapshots):
    counts = {r["orbit_regime"]: r["satellite_count"] for r in analysis.satellites_by_regime(snapshots).collect()}
    assert counts == {"LEO": 3, "GEO": 1, "UNKNOWN": 1}
    owners = spark.createDataFrame([(i, "US") for i in range(1, 6)], "norad_cat_id INT, owner STRING")
    by_owner = analysis.satellites_by_regime_owner(snapshots, owners).collect()
    assert sum(r["satellite_count"] for r in by_owner) == 5


def test_owner_band_and_profile(spark, snapshots):
    satellites = spark.createDataFrame(
        [(1, "one", "PAY", "US"), (2, "two", "PAY", "FR")],
        "norad_cat_id INT, object_name STRING, object_type STRING, owner STRING",
    )
    band = analysis.owner_inclination_band(satellites, snapshots, "US", 50.0, 60.0).collect()
    assert len(band) == 4 and {r["owner"] for r in band} == {"US"}
    summary = gold.satcat_orbit_summary(satellites, snapshots)
    profile = analysis.satellite_profile(summary, 1).collect()
    assert profile[0]["avg_apogee_km"] == 427.5
    assert {r["norad_cat_id"]: r["snapshot_count"] for r in summary.collect()} == {1: 4, 2: 1}


def test_freshness(spark):
    frame = spark.sql("SELECT timestamp_ntz'2025-01-01 00:00:00' AS t")
    now = F.lit("2025-01-01 01:00:00").cast("timestamp_ntz")
    row = analysis.freshness(frame, "t", now).first()
    assert (row["lag_seconds"], row["is_fresh"]) == (3600, True)
    assert analysis.freshness(frame, "t", now, limit_hours=0).first()["is_fresh"] is False
