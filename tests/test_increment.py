import json
from datetime import date
from pathlib import Path

import pytest

from skyledger.plans import jobs, silver_satcat
from skyledger.schemas import TABLES
from skyledger.sources.tables import KEY_BUCKETS, SPLITS, Warehouse
from tests.samples import event, record, satcat_frame
from tests.test_jobs import content, land

ODD_RECORDS = [
    None, "", "{", "[1]", "text", '{"NORAD_CAT_ID":"1","NORAD_CAT_ID":"2"}', "null", "7",
    '{"NORAD_CAT_ID":5,"APOGEE":420.5,"RCS":null,"OWNER":true}',
    '{"NORAD_CAT_ID":"5.0","LAUNCH_DATE":"1998","DECAY_DATE":"2024-13-45","PERIOD":"n/a"}',
    '{"NORAD_CAT_ID":" 42 ","OBJECT_NAME":"a \\"b\\" é","APOGEE":"1e3","PERIGEE":"","LAUNCH_DATE":" 1998-11-20"}',
    '{"NORAD_CAT_ID":"99999999999","OBJECT_NAME":"too large"}', '{"norad_cat_id":"6"}',
    '{"OBJECT_NAME":{"nested":[1, 2]},"NORAD_CAT_ID":"8"}',
]


def test_variant_records_equal_those_of_the_text(warehouse, spark):
    rows = [(k, "active", date(2025, 1, 3), "raw", text) for k, text in enumerate(ODD_RECORDS)]
    rows += [record(100 + k, norad=str(k)) for k in range(5)]
    frame = satcat_frame(spark, *rows)
    warehouse.append(frame, "bronze.satcat_raw", "r")
    stored = warehouse.read("bronze.satcat_raw")
    malformed = {r["id"] for r in stored.filter("record IS NULL").select("id").collect()}
    assert malformed == {0, 1, 2, 4, 5}  # the last one repeats a member
    by_text = {r["id"]: r for r in silver_satcat.parse_records(frame).collect()}
    by_variant = {r["id"]: r for r in silver_satcat.variant_records(stored).collect()}
    assert by_text.pop(5)["norad_cat_id"] == 2
    assert set(by_text) == set(by_variant) == {8, 9, 10, 13, *range(100, 105)}
    for k, row in by_text.items():
        expected, found = row.asDict(), by_variant[k].asDict()
        if k == 13:  # a nested member keeps its JSON, not its blanks
            assert json.loads(expected.pop("object_name")) == json.loads(found.pop("object_name"))
        assert found == expected


def test_a_scan_reads_only_the_members_it_needs(warehouse, spark):
    warehouse.append(satcat_frame(spark, record(1), record(2)), "bronze.satcat_raw", "r")
    records = silver_satcat.variant_records(warehouse.read("bronze.satcat_raw"))
    plan = records.select("apogee_km")._jdf.queryExecution().executedPlan().toString()
    assert "parsed_record" not in plan and "record:struct<0:string,1:string>" in plan.replace("`", "")


def test_compaction_fills_records_of_older_rows(warehouse, spark, monkeypatch):
    from skyledger.sources import tables

    table = "bronze.satcat_raw"
    with monkeypatch.context() as older:
        older.setattr(tables, "DERIVED", {})
        warehouse.append(satcat_frame(spark, record(1)), table, "a")
        warehouse.append(satcat_frame(spark, record(2)), table, "b")
    assert warehouse.read(table).filter("record IS NOT NULL").isEmpty()
    assert warehouse.compact(table, date(2025, 1, 1), "merged") == 2
    assert warehouse.read(table).filter("record IS NOT NULL").count() == 2


# --- key buckets ---


def buckets(warehouse, names):
    rows = warehouse.spark.createDataFrame([(n,) for n in names], "neo_id STRING")
    return warehouse.parts_of("silver.neo", rows)


def folders(df, column):
    return {next(p for p in f.split("/") if p.startswith(column)) for f in df.inputFiles()}


def test_a_merge_lists_only_the_buckets_of_its_batch(warehouse, monkeypatch):
    names = [f"n{k}" for k in range(300)]
    land(warehouse, "l1", [event(k, n) for k, n in enumerate(names)])
    jobs.neo_to_silver(warehouse, "s1", ["l1"])
    assert len(folders(warehouse.read("silver.neo"), "key_bucket")) > 50

    one_per_bucket = {buckets(warehouse, [n])[0]: n for n in names[:40]}
    chosen = sorted(one_per_bucket)[:3]
    known = [one_per_bucket[b] for b in chosen]
    later = [event(1000 + k, n, full="2025-Feb-01 00:00", close_approach_date=date(2025, 2, 1))
             for k, n in enumerate(known)]
    land(warehouse, "l2", later)
    listed = []
    real = Warehouse.stored_for

    def watched(self, table, rows, without_run=None):
        found = real(self, table, rows, without_run)
        listed.append((table, folders(found, "key_bucket")))
        return found

    monkeypatch.setattr(Warehouse, "stored_for", watched)
    assert jobs.neo_to_silver(warehouse, "s2", ["l2"]) == 3  # three facts, no new object
    expected = {f"key_bucket={b}" for b in chosen}
    assert listed == [("silver.neo", expected), ("silver.neo", expected)]


def test_buckets_hold_every_key_once(warehouse, spark):
    names = [None, "", "a", "ä", *map(str, range(200))]
    rows = spark.createDataFrame([(n, False) for n in names], "neo_id STRING, is_potentially_hazardous_asteroid BOOLEAN")
    warehouse.append(rows, "silver.neo", "r")
    for name in names[:8]:
        one = spark.createDataFrame([(name,)], "neo_id STRING")
        found = warehouse.stored_for("silver.neo", one).filter(
            "neo_id IS NULL" if name is None else f"neo_id = '{name}'"
        )
        assert found.count() == 1
    assert set(warehouse.parts_of("silver.neo", rows)) <= set(range(KEY_BUCKETS))
    assert warehouse.stored_for("silver.neo", rows.limit(0)).isEmpty()


# --- marts by change ---

MARTS = [*jobs.NEO_MARTS, *jobs.SATCAT_MARTS]


def marts(warehouse):
    keys = ("approach_sk", "orbit_snapshot_sk")
    return {t: content(warehouse, t, *[k for k in keys if k in TABLES[t].fieldNames()]) for t in MARTS}


def files(warehouse, table):
    return {f.split(warehouse.path(table))[1] for f in warehouse.read(table).inputFiles()}


def load(warehouse, name, events, records):
    land(warehouse, name, events, records)
    jobs.neo_to_silver(warehouse, name, [name])
    jobs.satcat_to_silver(warehouse, name, [name])


def month_events(month, names, first):
    day = date(2025, month, 3)
    return [event(first + k, n, full=f"{day:%Y-%b-%d} 0{k % 9}:00", close_approach_date=day,
                  is_potentially_hazardous_asteroid=n == "a") for k, n in enumerate(names)]


def test_increments_equal_a_rebuild_and_keep_other_files(warehouse):
    load(warehouse, "l1", month_events(1, "aabc", 1) + month_events(2, "ab", 10),
         [record(k, norad=str(k % 5), day=date(2025, 1 + k % 2, 1 + k), APOGEE=str(400 + k)) for k in range(9)])
    first = jobs.silver_changes_to_gold(warehouse, "g1")
    assert first["gold.neo_daily_activity"] == 2 and set(first) == set(MARTS)
    before = {t: files(warehouse, t) for t in MARTS}

    load(warehouse, "l2", month_events(2, "cd", 20) + month_events(3, "a", 30),
         [record(50, norad="2", day=date(2025, 2, 20), APOGEE="", PERIOD="n/a"), record(51, norad="77", day=date(2025, 2, 21))])
    second = jobs.silver_changes_to_gold(warehouse, "g2")
    assert second["gold.neo_daily_activity"] == second["gold.ai_neo_features"] == 2
    assert second["gold.ai_satcat_features"] == 1
    after = {t: files(warehouse, t) for t in MARTS}
    january = "storage_month=2025-01-01"
    for table in ("gold.neo_daily_activity", "gold.ai_neo_features", "gold.ai_satcat_features"):
        assert {f for f in after[table] if january in f} == {f for f in before[table] if january in f} != set()
        assert not {f for f in after[table] if "2025-02" in f} & before[table]
    touched = {f"key_bucket={b}" for b in buckets(warehouse, ["a", "c", "d"])}
    kept = {f for f in before["gold.neo_hazard_summary"] if f.split("/")[1] not in touched}
    assert kept and kept <= after["gold.neo_hazard_summary"]

    merged = marts(warehouse)
    # A retry, and another run without anything new, change nothing.
    assert jobs.silver_changes_to_gold(warehouse, "g2") == jobs.silver_changes_to_gold(warehouse, "g3") == {}
    assert {t: files(warehouse, t) for t in MARTS} == after
    jobs.silver_to_gold(warehouse, "full")
    assert marts(warehouse) == merged
    assert jobs.silver_changes_to_gold(warehouse, "g4") == {}  # the rebuild holds all loads


def test_a_failed_increment_goes_on(warehouse, monkeypatch):
    load(warehouse, "l1", month_events(1, "ab", 1), [record(1)])
    real, calls = Warehouse.replace_parts, []

    def failing(self, df, table, run, parts, loads=()):
        calls.append(table)
        if len(calls) == 3:  # it dies after its rows are written, before they count
            self._note(table, "pending", "00000001-g1")
            self._write(self.shaped(df, table), table, "00000001-g1")
            raise OSError("lost")
        real(self, df, table, run, parts, loads)

    with monkeypatch.context() as broken:
        broken.setattr(Warehouse, "replace_parts", failing)
        with pytest.raises(OSError):
            jobs.silver_changes_to_gold(warehouse, "g1")
    assert warehouse.read("gold.ai_neo_features").isEmpty()
    rest = jobs.silver_changes_to_gold(warehouse, "g1")
    assert set(rest) == set(MARTS[2:])
    found = marts(warehouse)
    jobs.silver_to_gold(warehouse, "full")
    assert marts(warehouse) == found


def test_replaced_parts(warehouse, spark):
    table = "gold.neo_daily_activity"

    def days(*rows):
        return spark.createDataFrame([(date(2025, m, d), n, 1, 0) for m, d, n in rows], TABLES[table])

    def stored():
        return sorted((r[0].month, r[0].day, r[1]) for r in warehouse.read(table).collect())

    warehouse.overwrite(days((1, 1, 5), (1, 2, 5), (2, 1, 5), (3, 1, 5)), table)
    assert not warehouse.finished(table, "r") and SPLITS[table].column == "storage_month"
    # March is named without rows, so it empties; the row of April is outside the named parts.
    warehouse.replace_parts(days((2, 7, 8), (4, 1, 9)), table, "r", [date(2025, 2, 1), date(2025, 3, 1)], ["x"])
    assert stored() == [(1, 1, 5), (1, 2, 5), (2, 7, 8)]
    assert warehouse.finished(table, "r") and warehouse.merged_loads(table) == {"x"}
    versions = [p.name for p in Path(warehouse.path(table)).glob("storage_month=2025-02-01/*")]
    assert versions == ["load_run=00000002-r"]
    warehouse.overwrite(days((5, 1, 1)), table)
    assert stored() == [(5, 1, 1)]
    with pytest.raises(ValueError, match="replace_parts"):
        warehouse.append(days((1, 1, 1)), table, "r")


def test_a_lookup_reads_one_row_group_of_many(warehouse, spark):
    import pyarrow.parquet as pq
    from pyspark.sql import functions as F

    table = "silver.satcat_orbit_snapshot"
    day = F.lit("2025-01-03").cast("date")
    for run, parity in (("a", 0), ("b", 1)):
        number = (F.col("id") * 2 + parity).cast("int")
        rows = spark.range(20_000).select(number.alias("norad_cat_id"), day.alias("snapshot_date"),
                                          F.rand(parity).alias("apogee_km"))
        warehouse.append(rows, table, run)
    spark.sparkContext._jsc.hadoopConfiguration().setInt("parquet.block.size", 64_000)
    try:
        assert warehouse.compact(table, date(2025, 1, 1), "merged") == 2
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.block.size")
    files = [f.removeprefix("file://") for f in warehouse.read(table).inputFiles()]
    groups = sum(pq.ParquetFile(f).metadata.num_row_groups for f in files)
    found = warehouse.find(table, 12_345)
    assert [r["norad_cat_id"] for r in found.collect()] == [12_345] and groups > 10
    scan = found._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert 0 < scan.metrics().apply("numOutputRows").value() <= 40_000 / groups * 2
    assert warehouse.find(table, -1).isEmpty()


def test_a_lookup_in_a_dimension_lists_one_bucket(warehouse, spark):
    table = "silver.satcat_satellite"
    rows = spark.range(500).selectExpr("cast(id as int) as norad_cat_id", "cast(id as string) as object_name")
    warehouse.append(rows, table, "r")
    found = warehouse.find(table, 77)
    assert len(folders(found, "key_bucket")) == 1
    assert [r["object_name"] for r in found.collect()] == ["77"]


def test_moments_of_several_loads_equal_the_history(warehouse, spark):
    import random
    import statistics

    from skyledger.plans import moments

    rng, rows = random.Random(3), []
    for satellite in range(1, 9):
        for day in range(1, 25):
            if rng.random() < 0.8:
                values = [rng.choice([None, *range(90, 95)]) if satellite > 1 else 90 for _ in range(3)]
                rows.append((satellite, date(2025, 1, day), *[None if v is None else float(v) for v in values]))
    schema = "norad_cat_id INT, snapshot_date DATE, period_minutes DOUBLE, apogee_km DOUBLE, perigee_km DOUBLE"
    cuts = [(1, 8), (8, 9), (9, 25)]
    found = {}
    for low, high in cuts:
        part = [r for r in rows if low <= r[1].day < high]
        warehouse.append(spark.createDataFrame(part, schema), "silver.satcat_orbit_snapshot", f"l{low}")
        scored = moments.score_new_snapshots(warehouse, f"m{low}").collect()
        assert {(r["norad_cat_id"], r["snapshot_date"]) for r in scored} == {r[:2] for r in part}
        found |= {(r["norad_cat_id"], r["snapshot_date"]): r for r in scored}
    for satellite in range(1, 9):
        own = sorted(r for r in rows if r[0] == satellite)
        for k, name in enumerate(("period_minutes", "apogee_km", "perigee_km"), 2):
            pairs = [(b[1], None if None in (a[k], b[k]) else b[k] - a[k]) for a, b in zip(own, own[1:])]
            deltas = [d for _, d in pairs if d is not None]
            spread = statistics.stdev(deltas) if len(deltas) > 1 else 0
            for day, d in pairs:
                if day.day >= 9:
                    z = found[satellite, day][f"z_{name}"]
                    expected = None if d is None or not spread else (d - statistics.mean(deltas)) / spread
                    assert z == (None if expected is None else pytest.approx(expected, abs=1e-6))
    # Nothing new gives no scores; a late snapshot has none and leaves the moments alone.
    before = content(warehouse, "gold.orbit_moments")
    assert moments.score_new_snapshots(warehouse, "again").isEmpty()
    late = spark.createDataFrame([(2, date(2024, 12, 1), 1.0, 1.0, 1.0)], schema)
    warehouse.append(late, "silver.satcat_orbit_snapshot", "late")
    assert moments.score_new_snapshots(warehouse, "late").isEmpty()
    assert content(warehouse, "gold.orbit_moments") == before


def test_new_snapshots_are_sorted_once_for_their_deltas(warehouse, spark):
    from skyledger.plans import moments
    from skyledger.schemas import ORBIT_MOMENTS

    schema = "norad_cat_id INT, snapshot_date DATE, period_minutes DOUBLE, apogee_km DOUBLE, perigee_km DOUBLE"
    new = spark.createDataFrame([(1, date(2025, 1, day), 1.0, 2.0, 3.0) for day in (3, 4)], schema)
    state = spark.createDataFrame([(1, date(2025, 1, 3), *[1.0, 1, 0.0, 0.0] * 3)], ORBIT_MOMENTS)
    deltas = moments.new_deltas(new, state)
    plan = deltas._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1
    assert [r["snapshot_date"].day for r in deltas.collect()] == [4]
