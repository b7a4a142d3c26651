import json

import pytest
from pyspark.sql import functions as F

from skyledger.operators import ledger
from skyledger.plans import jobs, silver_neo
from skyledger.sources import messages
from skyledger.streaming import bronze
from tests.samples import dicts, event, neo_frame, record, satcat_frame


def write_lines(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def run(start, spark, warehouse, lines, checkpoint):
    stream = start(
        messages.file_stream(spark, str(lines)), warehouse, str(checkpoint), availableNow=True
    )
    stream.awaitTermination()


def approach_lines(spark, *events):
    frame = neo_frame(spark, *events).drop("event_id")
    return [r["value"] for r in messages.encode_approaches(frame).collect()]


def test_stream_gives_the_same_silver_rows_as_batch(spark, warehouse, tmp_path):
    from skyledger.sources.tables import Warehouse

    events = [event(1, "a"), event(2, "b", full=None), event(3, "a", body="Moon"), event(4, "a")]
    write_lines(tmp_path / "in", "1.txt", approach_lines(spark, *events))
    run(bronze.start_approach_stream, spark, warehouse, tmp_path / "in", tmp_path / "cp")
    batch = Warehouse(spark, str(tmp_path / "batch"))
    rows = neo_frame(spark, *events).withColumnRenamed("event_id", "position")
    jobs.land_approaches(batch, rows, "b", ["position"])

    def silver(w):
        b = w.read("bronze.neo_event_raw")
        return (
            sorted(map(str, silver_neo.neo_candidates(b).collect())),
            sorted(map(str, silver_neo.approach_candidates(b).collect())),
        )

    assert silver(warehouse) == silver(batch)
    dims = dicts(silver_neo.neo_candidates(warehouse.read("bronze.neo_event_raw")), "neo_id")
    assert dims[0]["estimated_diameter_km_max"] == 0.25  # nested objects survive the stream
    row = warehouse.read("bronze.neo_event_raw").first()
    assert row["feed_start_date"] == row["feed_end_date"] == row["close_approach_date"]


def test_restart_and_new_checkpoint_add_nothing_twice(spark, warehouse, tmp_path):
    write_lines(tmp_path / "in", "1.txt", approach_lines(spark, event(1, "a"), event(2, "b")))
    for checkpoint in ("cp", "cp", "other"):  # restart, then replay of everything
        run(bronze.start_approach_stream, spark, warehouse, tmp_path / "in", tmp_path / checkpoint)
        assert warehouse.read("bronze.neo_event_raw").count() == 2
    write_lines(tmp_path / "in", "2.txt", approach_lines(spark, event(1, "a"), event(3, "c")))
    run(bronze.start_approach_stream, spark, warehouse, tmp_path / "in", tmp_path / "cp")
    rows = dicts(warehouse.read("bronze.neo_event_raw"), "event_id")
    assert [r["event_id"] for r in rows] == [1, 2, 3]


def test_replayed_batch_replaces_its_output(spark, warehouse):
    rows = neo_frame(spark, event(1, "a")).drop("event_id")
    for _ in range(2):
        jobs.land_approaches(warehouse, rows, "stream-id-0", ["raw_neo"])
    assert warehouse.read("bronze.neo_event_raw").count() == 1


def test_bad_approach_messages_are_quarantined_whole(spark, warehouse, tmp_path):
    good = approach_lines(spark, event(1, "a"))
    no_key = json.dumps({"close_approach_date": "2025-01-03"})
    no_date = json.dumps({"neo_id": "z", "close_approach_date": "soon"})
    broken = '{"neo_id": "a", '
    write_lines(tmp_path / "in", "1.txt", [*good, no_key, no_date, broken])
    run(bronze.start_approach_stream, spark, warehouse, tmp_path / "in", tmp_path / "cp")
    assert warehouse.read("bronze.neo_event_raw").count() == 1
    rejected = {r["reason"]: r["value"] for r in warehouse.read("bronze.quarantine").collect()}
    assert rejected == {"missing key": no_key, "missing date": no_date, "malformed": broken}
    counts = bronze.quarantine_counts(warehouse.read("bronze.quarantine"))
    assert {r["reason"]: r["messages"] for r in counts.collect()} == dict.fromkeys(rejected, 1)


def test_null_value_is_malformed(spark):
    frame = spark.createDataFrame([(None,), ("null",)], "value STRING")
    for parse in (bronze.parse_approaches, bronze.parse_catalog):
        assert [r["reason"] for r in parse(frame).collect()] == ["malformed", "malformed"]


def test_catalog_stream_appends_and_quarantines(spark, warehouse, tmp_path):
    moment = F.lit("2025-01-03 23:30:00").cast("timestamp_ntz")
    sent = messages.encode_catalog(satcat_frame(spark, record(1), record(2)), moment)
    lines = [r["value"] for r in sent.collect()]
    no_time = json.dumps({"snapshot_group": "active", "satcat": {"NORAD_CAT_ID": "1"}})
    no_satcat = json.dumps({"snapshot_group": "active", "snapshot_timestamp": "2025-01-03T00:00:00Z"})
    write_lines(tmp_path / "in", "1.txt", [*lines, no_time, no_satcat, "nonsense"])
    run(bronze.start_catalog_stream, spark, warehouse, tmp_path / "in", tmp_path / "cp")
    rows = dicts(warehouse.read("bronze.satcat_raw"), "id")
    assert len(rows) == 3 and len({r["id"] for r in rows}) == 3
    assert {str(r["snapshot_date"]) for r in rows} == {"2025-01-03"}
    assert sorted(r["parsed_record"] == "{}" for r in rows) == [False, False, True]
    runs = ledger.run_state(warehouse.read("meta.pipeline_run")).collect()
    assert [(r["pipeline_name"], r["status"], r["records_processed"], r["triggered_by"]) for r in runs] == [
        ("satcat_stream_to_bronze", "success", 3, "stream")
    ]
    reasons = sorted(r["reason"] for r in warehouse.read("bronze.quarantine").collect())
    assert reasons == ["malformed", "missing timestamp"]


def test_a_failed_batch_is_in_the_ledger(spark, warehouse, tmp_path, monkeypatch):
    def broken(*_):
        raise RuntimeError("no storage")

    monkeypatch.setattr(bronze, "append_catalog", broken)
    write_lines(tmp_path / "in", "1.txt", ["nonsense"])
    with pytest.raises(Exception, match="no storage"):
        run(bronze.start_catalog_stream, spark, warehouse, tmp_path / "in", tmp_path / "cp")
    runs = ledger.run_state(warehouse.read("meta.pipeline_run"))
    failed = ledger.failed_runs(runs, ledger.STREAM_PIPELINES, F.current_timestamp()).collect()
    assert [(r["pipeline_name"], r["error_message"]) for r in failed] == [
        ("satcat_stream_to_bronze", "no storage")
    ]


def test_nothing_rejected_writes_no_quarantine(spark, warehouse, tmp_path):
    write_lines(tmp_path / "in", "1.txt", approach_lines(spark, event(1, "a")))
    run(bronze.start_approach_stream, spark, warehouse, tmp_path / "in", tmp_path / "cp")
    assert not warehouse.exists("bronze.quarantine")


def test_broker_order_decides_the_first_arrival(spark, warehouse):
    lines = approach_lines(spark, event(1, "a", neo_name="first"), event(2, "a", neo_name="AAA"))
    frame = spark.createDataFrame(
        [(i, 0, i, line) for i, line in enumerate(sorted(lines, key=lambda v: "first" not in v))],
        "timestamp INT, partition INT, offset INT, value STRING",
    )
    parsed = bronze.usable(bronze.parse_approaches(frame))
    jobs.land_approaches(warehouse, parsed, "r", ["timestamp", "partition", "offset", "value"])
    assert warehouse.read("bronze.neo_event_raw").first()["neo_name"] == "first"


@pytest.mark.parametrize("value", ["2025-01-03T10:00:00.123456", "2025-01-03T10:00:00+14:00"])
def test_snapshot_day_is_the_written_day(spark, value):
    message = json.dumps({"snapshot_group": "g", "snapshot_timestamp": value, "satcat": {}})
    row = bronze.parse_catalog(spark.createDataFrame([(message,)], "value STRING")).first()
    assert str(row["snapshot_date"]) == "2025-01-03" and row["reason"] is None


def start_unique(spark, warehouse, lines, checkpoint):
    for stream in bronze.start_unique_approach_stream(
        messages.file_stream(spark, str(lines)), warehouse, str(checkpoint), availableNow=True
    ):
        stream.awaitTermination()


def test_keys_in_the_state_survive_a_restart(spark, warehouse, tmp_path, monkeypatch):
    from skyledger.sources.tables import Warehouse

    def unread(*args, **kwargs):
        raise AssertionError("bronze was read")

    monkeypatch.setattr(Warehouse, "stored_between", unread)
    first = [event(1, "a"), event(2, "a"), event(3, "b", full=None), event(4, "b", full=None)]
    write_lines(tmp_path / "in", "1.txt", [*approach_lines(spark, *first), "broken {"])
    start_unique(spark, warehouse, tmp_path / "in", tmp_path / "cp")
    write_lines(tmp_path / "in", "2.txt", approach_lines(spark, *first, event(5, "a", body="Moon")))
    start_unique(spark, warehouse, tmp_path / "in", tmp_path / "cp")
    rows = dicts(warehouse.read("bronze.neo_event_raw"), "event_id")
    assert sorted((r["neo_id"], r["orbiting_body"], r["close_approach_date_full"] is None) for r in rows) == [
        ("a", "Earth", False), ("a", "Moon", False), ("b", "Earth", True),
    ]
    assert len({r["event_id"] for r in rows}) == 3
    rejected = dicts(bronze.quarantine_counts(warehouse.read("bronze.quarantine")))
    assert rejected == [{"stream": "neo_stream_to_bronze", "reason": "malformed", "messages": 1}]
    assert "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass")


def catalog_lines(spark, *records):
    frame = satcat_frame(spark, *records)
    moment = F.lit("2025-01-03 00:00:00").cast("timestamp")
    return [r["value"] for r in messages.encode_catalog(frame, moment).collect()]


def test_file_sink_writes_each_message_once(spark, tmp_path):
    path = str(tmp_path / "files")
    write_lines(tmp_path / "in", "1.txt", [*catalog_lines(spark, record(1), record(2, norad="5")), "broken {"])

    def go():
        source = messages.file_stream(spark, str(tmp_path / "in"))
        bronze.start_catalog_file_stream(source, path, str(tmp_path / "cp"), availableNow=True).awaitTermination()
        return bronze.read_catalog_files(spark, path)

    assert go().count() == go().count() == 2
    write_lines(tmp_path / "in", "2.txt", catalog_lines(spark, record(1)))
    rows = go()
    assert rows.count() == 3 and rows.select("id").distinct().count() == 2
    from skyledger.plans import silver_satcat

    assert {r["norad_cat_id"] for r in silver_satcat.variant_records(rows).collect()} == {25544, 5}
    # What a batch left behind that never finished is not in the sink's log.
    stray = next((tmp_path / "files").glob("part-*.parquet"))
    (tmp_path / "files" / "part-stray.parquet").write_bytes(stray.read_bytes())
    assert bronze.read_catalog_files(spark, path).count() == 3


def test_silver_lag(spark):
    from datetime import datetime, timedelta

    at = datetime(2025, 1, 3, 23, 50)

    def minutes(n):
        return at + timedelta(minutes=n)

    progress = spark.createDataFrame(
        [("neo_stream_to_bronze", "q", k, t, 5) for k, t in enumerate([at, at, minutes(30), minutes(9000)])]
        + [("neo_stream_to_bronze", "q", 0, at, 5), ("other", "q", 0, at, 1)],
        "stream STRING, query_id STRING, batch_id LONG, finished_at TIMESTAMP, input_rows LONG",
    )
    runs = spark.createDataFrame(
        [("r0", "neo_to_silver", "success", minutes(-1), minutes(1)),  # began before the batch
         ("r1", "neo_to_silver", "failed", minutes(2), minutes(3)),
         ("r2", "neo_to_silver", "success", minutes(15), minutes(20)),
         ("r3", "neo_to_silver", "success", minutes(61), minutes(65)),
         ("r4", "satcat_to_silver", "success", minutes(1), minutes(2))],
        "run_id STRING, pipeline_name STRING, status STRING, start_time TIMESTAMP, end_time TIMESTAMP",
    )
    found = dicts(bronze.silver_lag(progress, runs), "stream", "batch_id")
    assert [(r["batch_id"], r["silver_run"], r["lag_seconds"], r["is_fresh"]) for r in found] == [
        (0, "r2", 1200, True), (1, "r2", 1200, True), (2, "r3", 2100, False), (3, None, None, False),
        (0, None, None, False),
    ]


def test_a_batch_is_not_cached_and_rejects_are_counted_in_passing(spark, warehouse, tmp_path, monkeypatch):
    """A cached batch holds its texts several times over, on disk where memory runs out."""
    from pyspark.sql import DataFrame

    def cached(*_):
        raise AssertionError("a batch was cached")

    monkeypatch.setattr(DataFrame, "persist", cached)
    monkeypatch.setattr(DataFrame, "cache", cached)
    line = json.dumps(
        {"snapshot_group": "a", "snapshot_timestamp": "2025-01-03T00:00:00", "satcat": {"NORAD_CAT_ID": "7"}}
    )
    write_lines(tmp_path / "in", "1.txt", [line, "{", line])
    for checkpoint in ("cp", "cp"):
        run(bronze.start_catalog_stream, spark, warehouse, tmp_path / "in", tmp_path / checkpoint)
    stored = warehouse.read("bronze.satcat_raw").collect()
    assert sorted(r["id"] for r in stored) == [1, 2]
    assert all(r["raw_csv_row"] == r["parsed_record"] for r in stored)
    assert [r["value"] for r in warehouse.read("bronze.quarantine").collect()] == ["{"]
