import json
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from skyledger.session import default_setting
from skyledger.sources import catalog, feed, messages, tables
from skyledger.sources.tables import path_exists, read_jdbc, write_jdbc
from tests.samples import dicts, event, neo_frame, record, satcat_frame

NEO = {
    "id": "7", "neo_reference_id": "7", "name": "Seven",
    "is_potentially_hazardous_asteroid": True, "absolute_magnitude_h": 21.5,
    "estimated_diameter": {
        "kilometers": {"estimated_diameter_min": 0.12, "estimated_diameter_max": 0.3}
    },
    "close_approach_data": [
        {
            "close_approach_date": "2025-01-03", "close_approach_date_full": "2025-Jan-03 12:34",
            "epoch_date_close_approach": 1735907640000,
            "relative_velocity": {"kilometers_per_second": "12.5"},
            "miss_distance": {"kilometers": "100.5"}, "orbiting_body": "Earth",
        },
        {"close_approach_date": "2025-01-04", "orbiting_body": "Moon"},
    ],
    "_synthetic": True,
}


def documents(spark, *docs):
    return spark.createDataFrame([(json.dumps(d),) for d in docs], "document STRING")


def test_feed_gives_one_row_per_approach(spark):
    no_data = {"id": "8", "name": "no approaches"}
    empty = {"id": "9", "close_approach_data": []}
    docs = documents(
        spark,
        {"near_earth_objects": {"2025-01-03": [NEO, no_data, empty], "2025-01-04": []}},
        {"other": 1},
    )
    rows = dicts(
        feed.bronze_rows(docs, F.lit("2025-01-01"), F.lit("2025-01-07")), "close_approach_date"
    )
    assert len(rows) == 2
    first, second = rows
    assert first["feed_start_date"] == date(2025, 1, 1) and first["feed_end_date"] == date(2025, 1, 7)
    assert first["neo_id"] == "7" and first["neo_name"] == "Seven"
    assert json.loads(first["miss_distance"]) == {"kilometers": "100.5"}
    assert json.loads(first["estimated_diameter"]) == NEO["estimated_diameter"]
    assert json.loads(first["raw_neo"]) == NEO  # with members the schema does not know
    assert second["orbiting_body"] == "Moon" and second["miss_distance"] is None


def test_feed_files_one_document_each(spark, tmp_path):
    for i in range(2):
        document = {"near_earth_objects": {"2025-01-03": [dict(NEO, id=str(i))]}}
        (tmp_path / f"{i}.json").write_text(json.dumps(document, indent=2))
    rows = feed.flatten_feed(feed.read_feed_documents(spark, str(tmp_path))).collect()
    assert sorted(r["neo_id"] for r in rows) == ["0", "0", "1", "1"]


def test_catalog_csv_keeps_empty_fields(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        'NORAD_CAT_ID,OBJECT_NAME,RCS\n1,"A, with comma",\n2,say ""hi"",3.5\n3,short\n'
    )
    rows = dicts(
        catalog.bronze_rows(
            catalog.read_catalog_csv(spark, str(tmp_path)), F.lit("active"), F.lit("2025-01-03")
        ),
        "raw_csv_row",
    )
    assert rows[0]["raw_csv_row"] == "1,A, with comma,"
    assert json.loads(rows[0]["parsed_record"]) == {
        "NORAD_CAT_ID": "1", "OBJECT_NAME": "A, with comma", "RCS": "",
    }
    assert json.loads(rows[2]["parsed_record"]) == {
        "NORAD_CAT_ID": "3", "OBJECT_NAME": "short", "RCS": "",
    }
    assert {r["snapshot_date"] for r in rows} == {date(2025, 1, 3)}


def test_backfill_windows_cover_the_range_without_overlap(spark):
    ranges = spark.createDataFrame(
        [("a", date(2025, 1, 1), date(2025, 1, 16)), ("b", date(2025, 1, 1), date(2025, 1, 1)),
         ("c", date(2025, 1, 2), date(2025, 1, 1))],
        "name STRING, s DATE, e DATE",
    )
    rows = dicts(feed.backfill_windows(ranges, "s", "e"), "name", "window_start")
    assert [(r["name"], r["window_start"].day, r["window_end"].day) for r in rows] == [
        ("a", 1, 7), ("a", 8, 14), ("a", 15, 16), ("b", 1, 1),
    ]


def test_approach_message_nests_its_objects(spark):
    row = messages.encode_approaches(neo_frame(spark, event(1, "a")).drop("event_id")).first()
    body = json.loads(row["value"])
    assert row["key"] == "a"
    assert len(body) == 13
    assert body["estimated_diameter"]["kilometers"]["estimated_diameter_max"] == 0.25
    assert body["miss_distance"]["lunar"] == "19.5"
    assert body["raw_neo"] == {"id": "a"}


def test_catalog_message_envelope(spark):
    frame = satcat_frame(spark, record(1))
    row = messages.encode_catalog(frame, F.lit("2025-01-03 01:02:03").cast("timestamp_ntz")).first()
    body = json.loads(row["value"])
    assert row["key"] == "25544"
    assert set(body) == {"snapshot_group", "snapshot_timestamp", "satcat"}
    assert body["snapshot_timestamp"].startswith("2025-01-03T01:02:03")
    assert body["satcat"]["OWNER"] == "US"


def test_message_writes_null_members(spark):
    frame = spark.createDataFrame([("a", None)], "k STRING, v STRING")
    assert json.loads(messages.encode(frame, F.col("k")).first()["value"]) == {"k": "a", "v": None}


# --- table storage ---


def test_append_is_idempotent_per_run(spark, warehouse):
    rows = neo_frame(spark, event(1, "a"), event(2, "b", close_approach_date=date(2025, 2, 1)))
    for _ in range(2):
        warehouse.append(rows, "bronze.neo_event_raw", "run1")
    warehouse.append(neo_frame(spark, event(3, "c")), "bronze.neo_event_raw", "run2")
    table = "bronze.neo_event_raw"
    assert warehouse.read(table).count() == 3
    assert warehouse.read(table, ["run2"]).count() == 1
    assert warehouse.stored(table, without_run="run1").count() == 1
    assert warehouse.read(table).columns[0] == "event_id"


def test_missing_table_is_empty(spark, warehouse):
    assert not warehouse.exists("silver.neo")
    assert warehouse.read("silver.neo").isEmpty()
    assert not path_exists(spark, warehouse.root)


def test_month_pruning_never_loses_a_key(spark, warehouse):
    table = "bronze.neo_event_raw"
    rows = neo_frame(
        spark,
        event(1, "jan"),
        event(2, "mar", full="2025-Mar-03 00:00", close_approach_date=date(2025, 3, 3)),
        event(3, "nokey", full=None),
        event(4, "disagree", full="2025-Mar-09 00:00", close_approach_date=date(2025, 1, 3)),
    )
    warehouse.append(rows, table, "r")

    def between(first, last):
        return {r["neo_id"] for r in warehouse.stored_between(table, first, last).collect()}

    assert between(date(2025, 1, 1), date(2025, 1, 9)) == {"jan", "nokey", "disagree"}
    assert between(date(2025, 3, 9), date(2025, 3, 9)) == {"mar", "nokey", "disagree"}
    assert between(None, None) == {"nokey", "disagree"}


def _snapshots(warehouse, run, months):
    rows = satcat_frame(
        warehouse.spark, *[record(m, norad=run, day=date(2025, m, 3)) for m in months]
    )
    warehouse.append(rows, "bronze.satcat_raw", run)


def test_a_month_read_lists_only_its_folders(warehouse):
    from pathlib import Path

    table = "bronze.satcat_raw"
    _snapshots(warehouse, "real", [1, 2])
    folder = Path(warehouse.path(table))
    part = next((folder / "storage_month=2025-01-01" / "load_run=real").glob("*.parquet"))
    for month in range(3, 13):
        for run in range(20):  # 200 run folders of other months
            other = folder / f"storage_month=2025-{month:02d}-01" / f"load_run=r{run}"
            other.mkdir(parents=True)
            (other / part.name).write_bytes(part.read_bytes())
    read = warehouse.stored_between(table, date(2025, 1, 1), date(2025, 1, 31))
    files = read.inputFiles()
    assert len(files) == 1 and "storage_month=2025-01-01" in files[0]
    assert read._jdf.queryExecution().analyzed().toString().count("load_run") and read.count() == 1
    assert warehouse.stored(table).count() == 202


def test_unfinished_runs_are_not_read(warehouse):
    table = "bronze.satcat_raw"
    _snapshots(warehouse, "good", [1])
    warehouse._note(table, "pending", "dead")
    warehouse._write(warehouse.shaped(satcat_frame(warehouse.spark, record(9)), table), table, "dead")
    assert [r["load_run"] for r in warehouse.stored(table).collect()] == ["good"]
    assert warehouse.finished(table, "good") and not warehouse.finished(table, "dead")
    _snapshots(warehouse, "dead", [2])  # the retry replaces what the first try left
    assert sorted(r["snapshot_date"].month for r in warehouse.read(table).collect()) == [1, 2]


def test_compaction_keeps_the_rows(warehouse, monkeypatch):
    table = "bronze.satcat_raw"
    for run in ("a", "b", "c"):
        _snapshots(warehouse, run, [1, 2])
    before = sorted(map(str, warehouse.read(table).collect()))
    assert warehouse.compact(table, date(2025, 1, 9), "merged") == 3
    assert sorted(map(str, warehouse.read(table).collect())) == before
    runs = {(r["storage_month"].month, r["load_run"]) for r in warehouse.stored(table).collect()}
    assert runs == {(1, "merged"), (2, "a"), (2, "b"), (2, "c")}
    assert warehouse.compact(table, date(2025, 1, 9), "again") == 0

    # A failure while the old runs are removed: a second call goes on.
    import skyledger.sources.tables as tables

    real, calls = tables.remove, []

    def failing(spark, path):
        calls.append(path)
        if len(calls) == 2:
            raise OSError("lost")
        real(spark, path)

    monkeypatch.setattr(tables, "remove", failing)
    with pytest.raises(OSError):
        warehouse.compact(table, date(2025, 2, 1), "feb")
    monkeypatch.setattr(tables, "remove", real)
    warehouse.compact(table, date(2025, 2, 1), "feb")
    assert sorted(map(str, warehouse.read(table).collect())) == before


def test_keys_grow_by_run_and_never_repeat(spark, warehouse):
    table = "silver.neo"
    first = spark.createDataFrame([("a", False), ("b", False)], "neo_id STRING, is_potentially_hazardous_asteroid BOOLEAN")
    second = spark.createDataFrame([("c", False)], "neo_id STRING, is_potentially_hazardous_asteroid BOOLEAN")
    assert warehouse.append_keyed(first, table, "r1", "neo_sk", ["neo_id"]) == 2
    assert warehouse.append_keyed(second, table, "r2", "neo_sk", ["neo_id"]) == 1
    assert {r["neo_sk"] for r in warehouse.read(table).collect()} == {1, 2, 3}
    assert warehouse.finished(table, "r2") and not warehouse.finished(table, "r3")
    # A run that died before it wrote has reserved its keys all the same.
    warehouse.append(
        spark.createDataFrame([(table, "dead", 50)], "table_name STRING, reserved_by STRING, last_key LONG"),
        "meta.key_range", table,
    )
    warehouse.append_keyed(
        spark.createDataFrame([("d", True)], first.schema), table, "r3", "neo_sk", ["neo_id"]
    )
    assert warehouse.read(table).filter("neo_id = 'd'").first()["neo_sk"] == 51


def test_rows_without_a_natural_key_get_distinct_ids(spark, warehouse):
    rows = satcat_frame(spark, *[record(None) for _ in range(20)]).drop("id")
    warehouse.append_unkeyed_rows(rows, "bronze.satcat_raw", "r", "id")
    assert sorted(r["id"] for r in warehouse.read("bronze.satcat_raw").collect()) == list(range(1, 21))


def test_views(spark, warehouse):
    warehouse.overwrite(
        spark.createDataFrame([("a", True)], "neo_id STRING, is_potentially_hazardous_asteroid BOOLEAN"), "silver.neo"
    )
    warehouse.register_views(["silver.neo"])
    assert spark.sql("SELECT neo_id FROM silver_neo").first()[0] == "a"


def test_overwrite_replaces(spark, warehouse):
    for day in (1, 2):
        frame = spark.createDataFrame([(date(2025, 1, day), 1, 1, 0)], "close_approach_date DATE, total_approaches LONG, unique_objects LONG, hazardous_approaches LONG")
        warehouse.overwrite(frame, "gold.neo_daily_activity")
    assert [r[0].day for r in warehouse.read("gold.neo_daily_activity").collect()] == [2]


def test_connectors_name_what_they_lack(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        messages.kafka_stream(spark, "broker:9092", messages.NEO_TOPIC, max_offsets=10)
    with pytest.raises(Exception, match="(?i)driver"):
        read_jdbc(spark, "jdbc:none://host/db", "t", "id", 0, 10, 2)
    with pytest.raises(Exception, match="(?i)driver"):
        write_jdbc(spark.range(1), "jdbc:none://host/db", "t")


def test_stored_records_have_no_dictionary(warehouse):
    """One would be built for texts that hardly repeat."""
    parquet = pytest.importorskip("pyarrow.parquet")
    rows = satcat_frame(warehouse.spark, *[record(i, norad=str(i)) for i in range(1, 4)])
    warehouse.append(rows, "bronze.satcat_raw", "r")
    files = [*Path(warehouse.path("bronze.satcat_raw")).rglob("*.parquet")]
    encodings = {}
    for file in files:
        group = parquet.ParquetFile(file).metadata.row_group(0)
        for i in range(group.num_columns):
            encodings.setdefault(group.column(i).path_in_schema, set()).update(group.column(i).encodings)
    assert not any("DICTIONARY" in e for e in encodings["parsed_record"])
    assert any("DICTIONARY" in e for e in encodings["snapshot_group"])


def test_rows_are_written_without_a_sort_by_part(warehouse, monkeypatch):
    """Also where a task has rows of more parts than it holds files open; settings are left alone."""
    months = [date(2000 + i // 12, i % 12 + 1, 1) for i in range(3 * tables.OPEN_PARTS)]
    rows = [record(i, day=day) for i, day in enumerate(months * 2, 1)]
    settings, spark = [], warehouse.spark
    monkeypatch.setattr(
        tables, "default_setting", lambda *a: settings.append(a[1:]) or default_setting(*a)
    )
    warehouse.append(satcat_frame(spark, *rows), "bronze.satcat_raw", "r")
    assert settings == [("spark.sql.maxConcurrentOutputFileWriters", str(tables.OPEN_PARTS))]
    assert spark.conf.get(settings[0][0], None) is None
    stored = warehouse.stored("bronze.satcat_raw")
    assert stored.filter("storage_month <> trunc(snapshot_date, 'month')").isEmpty()
    assert sorted(r["id"] for r in stored.collect()) == [*range(1, len(rows) + 1)]
    with default_setting(spark, settings[0][0], "3"), default_setting(spark, settings[0][0], "4"):
        assert spark.conf.get(settings[0][0]) == "3"  # one that is set stays
