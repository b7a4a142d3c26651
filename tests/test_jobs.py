from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from skyledger.operators import ledger
from skyledger.operators.quality import QualityGateError, non_null
from skyledger.plans import jobs
from skyledger.sources.tables import Warehouse
from tests.samples import dicts, event, neo_frame, record, satcat_frame

SILVER = (
    "silver.neo", "silver.neo_close_approach", "silver.satcat_satellite",
    "silver.satcat_orbit_snapshot",
)


def land(warehouse, run, events=(), records=()):
    if events:
        rows = neo_frame(warehouse.spark, *events).withColumnRenamed("event_id", "position")
        jobs.land_approaches(warehouse, rows, run, ["position"])
    if records:
        jobs.land_catalog(warehouse, satcat_frame(warehouse.spark, *records).drop("id"), run)


def content(warehouse, table, *drop):
    dropped = ("ingestion_timestamp", "source_run_id", *drop)
    rows = warehouse.read(table).drop(*dropped).collect()
    return sorted(map(str, rows))


def test_bronze_to_gold_and_rerun_invariance(warehouse):
    events = [
        event(1, "a"), event(2, "a", full="2025-Feb-05 00:00", close_approach_date=date(2025, 2, 5)),
        event(3, "b"), event(4, "b", full=None), event(5, "b", full=None),
    ]
    records = [record(1), record(2, norad="5"), record(3, day=date(2025, 1, 4)), record(4, group="all")]
    land(warehouse, "l1", events, records)
    assert warehouse.read("bronze.neo_event_raw").count() == 4  # NULL keys are equal
    assert warehouse.read("bronze.satcat_raw").count() == 4

    jobs.neo_to_silver(warehouse, "s1")
    jobs.satcat_to_silver(warehouse, "s1")
    before = {t: content(warehouse, t) for t in SILVER}
    assert [len(before[t]) for t in SILVER] == [2, 4, 2, 3]

    land(warehouse, "l2", events, records)  # the same input again
    for run in ("s2", "s1"):  # a new run, and a retry of the first
        jobs.neo_to_silver(warehouse, run)
        jobs.satcat_to_silver(warehouse, run)
        assert {t: len(content(warehouse, t)) for t in SILVER} == {t: len(v) for t, v in before.items()}
    assert warehouse.read("bronze.neo_event_raw").count() == 4
    assert warehouse.read("bronze.satcat_raw").count() == 4

    jobs.silver_to_gold(warehouse, "g1")
    daily = dicts(warehouse.read("gold.neo_daily_activity"), "close_approach_date")
    assert [(r["total_approaches"], r["unique_objects"]) for r in daily] == [(3, 2), (1, 1)]
    records_written = warehouse.read("meta.data_quality_run").filter("run_id = 'g1'")
    assert records_written.count() == 51
    assert records_written.filter("status = 'fail'").isEmpty()


def test_new_approach_of_a_known_object_is_loaded(warehouse):
    land(warehouse, "l1", [event(1, "a")])
    jobs.neo_to_silver(warehouse, "s1")
    land(warehouse, "l2", [event(2, "a", full="2025-Jan-09 00:00", close_approach_date=date(2025, 1, 9))])
    assert jobs.neo_to_silver(warehouse, "s2") == 1
    facts = dicts(warehouse.read("silver.neo_close_approach"), "approach_sk")
    assert [r["approach_sk"] for r in facts] == [1, 2]
    assert len({r["neo_sk"] for r in facts}) == 1


def test_incremental_loads_equal_one_full_pass(warehouse, spark, tmp_path):
    from skyledger.sources.tables import Warehouse

    whole = Warehouse(spark, str(tmp_path / "whole"))
    slices = [
        [event(10 * s + i, f"n{(s + i) % 4}", full=f"2025-Jan-0{s + 1} 0{i}:00",
               close_approach_date=date(2025, 1, s + 1)) for i in range(4)]
        for s in range(2)
    ]
    for i, part in enumerate(slices):
        land(warehouse, f"l{i}", part, [record(i, norad=str(i // 2 + 1), day=date(2025, 1, i + 1))])
        jobs.neo_to_silver(warehouse, f"s{i}", loads=[f"l{i}"])
        jobs.satcat_to_silver(warehouse, f"s{i}", loads=[f"l{i}"])
    land(whole, "all", [e for part in slices for e in part],
         [record(i, norad=str(i // 2 + 1), day=date(2025, 1, i + 1)) for i in range(2)])
    jobs.neo_to_silver(whole, "all")
    jobs.satcat_to_silver(whole, "all")
    facts = ("neo_sk", "approach_sk", "satellite_sk", "orbit_snapshot_sk")
    for table in ("silver.neo_close_approach", "silver.satcat_orbit_snapshot"):
        assert content(warehouse, table, *facts) == content(whole, table, *facts)
    keys = [r["approach_sk"] for r in warehouse.read("silver.neo_close_approach").collect()]
    assert sorted(keys) == list(range(1, len(keys) + 1))


def test_catalog_snapshot_is_loaded_once(warehouse):
    assert jobs.land_catalog(warehouse, satcat_frame(warehouse.spark, record(1)).drop("id"), "a") == 1
    again = satcat_frame(warehouse.spark, record(2, norad="9"), record(3, day=date(2025, 1, 4))).drop("id")
    assert jobs.land_catalog(warehouse, again, "b") == 1
    assert jobs.append_catalog(warehouse, again, "c") == 2


def test_arrivals_with_a_null_group_stay(warehouse, spark):
    schema = "snapshot_group STRING, snapshot_date DATE, raw_csv_row STRING, parsed_record STRING"
    day = date(2025, 1, 3)
    rows = spark.createDataFrame([(None, day, "r", "{}"), ("a", day, "r", "{}")], schema)
    assert jobs.land_catalog(warehouse, rows, "l1") == 2
    assert jobs.land_catalog(warehouse, rows, "l2") == 0


def test_first_arrival_wins_whatever_its_text(warehouse):
    events = [event(1, "a", neo_name="zzz"), event(2, "a", neo_name="aaa")]
    land(warehouse, "l1", events)
    assert warehouse.read("bronze.neo_event_raw").first()["neo_name"] == "zzz"


def test_staged_copies_go_with_the_run(warehouse, spark):
    from pathlib import Path

    from skyledger.session import shared_dir

    folder = Path(shared_dir(spark))
    land(warehouse, "l1", [event(1, "a")])
    before = set(folder.iterdir())
    jobs.recorded(warehouse, "p", lambda run: jobs.neo_to_silver(warehouse, run))
    assert set(folder.iterdir()) == before
    assert warehouse.read("silver.neo").count() == 1


def test_gate_records_before_it_raises(warehouse, spark):
    frame = spark.createDataFrame([(None,)], "a INT")
    with pytest.raises(QualityGateError, match="my_check"):
        jobs.gate(warehouse, frame, [non_null("my_check", "a")], "r", "t")
    jobs.gate(warehouse, frame, [non_null("soft", "a")], "r", "t2", fail_on_error=False)
    rows = dicts(warehouse.read("meta.data_quality_run"), "check_name")
    assert [(r["check_name"], r["status"], r["failed_records"]) for r in rows] == [
        ("my_check", "fail", 1), ("soft", "fail", 1),
    ]


def test_job_stops_at_a_failed_gate(warehouse):
    land(warehouse, "l", [event(1, "a", absolute_magnitude_h=99.0)])
    with pytest.raises(QualityGateError, match="abs_mag"):
        jobs.neo_to_silver(warehouse, "s")
    assert warehouse.read("silver.neo").isEmpty()


# --- ledger ---


def test_recorded_runs(warehouse):
    good = jobs.recorded(warehouse, "p", lambda run: 7, triggered_by="test")
    with pytest.raises(ZeroDivisionError):
        jobs.recorded(warehouse, "p", lambda run: 1 // 0, run_id="bad")
    runs = {r["run_id"]: r for r in ledger.run_state(warehouse.read("meta.pipeline_run")).collect()}
    assert (runs[good]["status"], runs[good]["records_processed"]) == ("success", 7)
    assert runs[good]["triggered_by"] == "test"
    assert runs["bad"]["status"] == "failed" and "division" in runs["bad"]["error_message"]
    assert runs[good]["end_time"] >= runs[good]["start_time"]


NOW = datetime(2025, 1, 1, 12, 0, tzinfo=timezone.utc)


@pytest.fixture(scope="module")
def runs(spark):
    def run(run_id, pipeline, minutes_ago, status=None, after=5):
        start = NOW - timedelta(minutes=minutes_ago)
        rows = [ledger.run_event(spark, run_id, pipeline, "start", "running", start)]
        if status:
            rows.append(
                ledger.run_event(
                    spark, run_id, pipeline, "end", status, start + timedelta(minutes=after),
                    records_processed=3, error_message="x" if status == "failed" else None,
                )
            )
        return rows

    frames = [
        *run("f59", "s", 59, "failed"), *run("f61", "s", 61, "failed"), *run("other", "t", 5, "failed"),
        *run("r14", "s", 14), *run("r16", "s", 16), *run("ok", "s", 2, "success", after=1),
    ]
    events = frames[0]
    for frame in frames[1:]:
        events = events.unionByName(frame)
    return ledger.run_state(events).cache()


def now():
    return F.lit(NOW)


def test_failed_and_stale_limits(runs):
    assert [r["run_id"] for r in ledger.failed_runs(runs, ["s"], now()).collect()] == ["f59"]
    assert [r["run_id"] for r in ledger.stale_runs(runs, ["s"], now()).collect()] == ["r16"]


def test_supervision_raises_only_with_issues(runs):
    with pytest.raises(ledger.SupervisionError, match="s: 1 failed, oldest f59; s: 1 stale, oldest r16"):
        ledger.supervise(runs, now(), ["s"])
    ledger.supervise(runs, now(), ["unknown"])


def test_supervision_counts_all_issues(spark):
    start = NOW - timedelta(minutes=30)
    runs = spark.range(50).select(
        F.lit("s").alias("pipeline_name"), F.format_string("run%02d", "id").alias("run_id"),
        F.when(F.col("id") < 45, "failed").otherwise("running").alias("status"), F.lit(start).alias("start_time"),
    )
    assert ledger.supervision_issues(runs, ["s"], now()).count() == 50
    with pytest.raises(ledger.SupervisionError, match="s: 45 failed, oldest run00, run01; s: 5 stale"):
        ledger.supervise(runs, now(), ["s"], shown=2)


def test_recent_checks(spark):
    rows = [(NOW - timedelta(minutes=i), "r", f"c{i}", "pass", 1, 0) for i in range(5)]
    frame = spark.createDataFrame(
        rows, "created_at TIMESTAMP, run_id STRING, check_name STRING, status STRING, "
        "total_records LONG, failed_records LONG",
    )
    assert [r["check_name"] for r in ledger.recent_checks(frame, 2).collect()] == ["c0", "c1"]


def test_latest_run_health(runs):
    health = {r["pipeline_name"]: r["is_healthy"] for r in ledger.latest_run_health(runs, now(), 24).collect()}
    assert health == {"s": True, "t": False}
    assert not ledger.latest_run_health(runs, now(), 0).filter("is_healthy").count()


def test_kpis_and_recent(runs):
    kpi = ledger.weekly_run_kpis(runs).collect()
    assert len(kpi) == 1 and kpi[0]["runs"] == 6
    assert kpi[0]["success_percent"] == pytest.approx(100 / 6)
    assert kpi[0]["mean_seconds"] == pytest.approx((300 * 3 + 60) / 4)
    recent = ledger.recent_runs(runs, 2).collect()
    assert [r["run_id"] for r in recent] == ["ok", "other"]
    assert recent[0]["duration_seconds"] == 60


def test_later_end_event_keeps_earlier_values(spark):
    events = ledger.run_event(spark, "r", "p", "start", "running", NOW)
    for minutes, status, count in ((1, "failed", 5), (2, "success", None)):
        events = events.unionByName(
            ledger.run_event(
                spark, "r", "p", "end", status, NOW + timedelta(minutes=minutes), records_processed=count
            )
        )
    row = ledger.run_state(events).first()
    assert (row["status"], row["records_processed"]) == ("success", 5)


def test_record_pass_rates(spark):
    records = spark.createDataFrame(
        [("c", 10, 1), ("c", 10, 0), ("empty", 0, 0)],
        "check_name STRING, total_records LONG, failed_records LONG",
    )
    rates = {r["check_name"]: r["pass_percent"] for r in ledger.record_pass_rates(records).collect()}
    assert rates == {"c": 95.0, "empty": None}


def test_ledger_snapshot_and_tail(warehouse, spark):
    """500 runs leave a bounded number of folders, and every state is what it was."""
    from pathlib import Path

    table = "meta.pipeline_run"
    number, second = F.col("id").cast("int"), F.make_interval(secs=F.col("id"))
    one = F.struct(F.lit("start").alias("event"), F.lit("running").alias("status"), F.lit(None).cast("long").alias("n"))
    two = F.struct(F.lit("end").alias("event"), F.when(number % 3 == 0, "failed").otherwise("success").alias("status"),
                   number.cast("long").alias("n"))
    three = F.struct(F.lit("end").alias("event"), F.lit("success").alias("status"), F.lit(None).cast("long").alias("n"))
    events = F.when(number % 7 == 0, F.array(one)).when(number % 5 == 0, F.array(one, two, three)).otherwise(F.array(one, two))
    rows = spark.range(500).select("id", F.posexplode(events).alias("k", "e")).select(
        F.format_string("run%03d", "id").alias("run_id"), F.lit("p").alias("pipeline_name"), "e.event", "e.status",
        (F.lit(NOW) + second + F.make_interval(mins=F.col("k"))).alias("event_time"),
        F.col("e.n").alias("records_processed"), F.when(F.col("e.status") == "failed", "x").alias("error_message"),
        F.concat_ws("-", "id", "k").alias("load_run"),
    )
    shaped = warehouse.shaped(rows, table).withColumn("load_run", F.monotonically_increasing_id().cast("string"))
    shaped.write.partitionBy("load_run").parquet(warehouse.path(table))
    folder = Path(warehouse.path(table))
    for name in [p.name.split("=")[1] for p in folder.glob("load_run=*")]:
        warehouse._note(table, "done", name)

    def state():
        return sorted(map(str, ledger.run_state(warehouse.read(table)).collect()))

    before = state()
    assert len(before) == 500 and len(list(folder.glob("load_run=*"))) > 900
    assert jobs.compact_ledger(warehouse, "snapshot-1") > 900
    assert state() == before
    assert len(list(folder.glob("load_run=*"))) == len(list(folder.glob("_done/*[!c]"))) == 1
    assert warehouse.read(table).count() < 1000
    # Later events add to the snapshot, and the next snapshot takes both in.
    run_id = "run007"
    late = ledger.run_event(spark, run_id, "p", "end", "success", NOW + timedelta(days=1), records_processed=9)
    warehouse.append(late, table, "tail")
    ended = {r["run_id"]: r for r in ledger.run_state(warehouse.read(table)).collect()}[run_id]
    assert (ended["status"], ended["records_processed"]) == ("success", 9)
    with_tail = state()
    assert jobs.compact_ledger(warehouse, "snapshot-2") == 2 and state() == with_tail
    assert jobs.compact_ledger(warehouse, "snapshot-3") == 0


def test_equal_arrivals_are_told_apart_without_their_json(spark, tmp_path, monkeypatch):
    """Rows that differ only in which value is missing: the same one lands in any order."""
    pair = [event(1, "1", orbiting_body="Earth", raw_neo=None, neo_name="x"),
            event(1, "1", orbiting_body="Earth", raw_neo="x", neo_name=None)]
    landed = []
    for n, rows in enumerate((pair, pair[::-1])):
        frame = neo_frame(spark, *rows).withColumnRenamed("event_id", "position")
        warehouse = Warehouse(spark, str(tmp_path / str(n)))
        with monkeypatch.context() as patch:
            patch.setattr(jobs.F, "to_json", lambda *_: pytest.fail("whole rows as JSON"))
            assert jobs.land_approaches(warehouse, frame, "r", ["position"]) == 1
        landed.append(warehouse.read("bronze.neo_event_raw").first()["neo_name"])
    assert landed[0] == landed[1]


def test_landing_chooses_without_the_wide_columns(warehouse, monkeypatch):
    """The digest for ties and the span of days are taken while the rows are staged."""
    staged, spans = [], []
    stage, between = jobs.staged_with, Warehouse.stored_between
    monkeypatch.setattr(
        jobs, "staged_with",
        lambda df, **metrics: staged.append((df.columns, set(metrics))) or stage(df, **metrics),
    )
    monkeypatch.setattr(
        Warehouse, "stored_between",
        lambda self, *a, **b: spans.append(a[1:]) or between(self, *a, **b),
    )
    land(warehouse, "l", [event(1, "a", full="2025-Feb-05 00:00"), event(2, "b"), event(3, "c", full="x")])
    columns, metrics = staged[0]
    assert "_tie" in columns and {"first", "last"} <= metrics
    assert spans == [(date(2025, 1, 3), date(2025, 2, 5))]
    land(warehouse, "m", [event(4, "d", full=None)])
    assert spans[1:] == [(None, None)] and warehouse.read("bronze.neo_event_raw").count() == 4


def test_catalog_groups_are_taken_once(warehouse, spark):
    """A load passes over its rows for the distinct groups and for the staged rows alone."""
    seen = spark.sparkContext.accumulator(0)

    def counted(rows):
        for row in rows:
            seen.add(1)
            yield row

    frame = satcat_frame(spark, *[record(i, norad=str(i)) for i in range(1, 5)]).drop("id", "record")
    rows = spark.createDataFrame(frame.rdd.mapPartitions(counted), frame.schema)
    assert jobs.land_catalog(warehouse, rows, "l") == 4
    assert seen.value == 8


def test_snapshots_are_staged_once_with_their_keys(warehouse, monkeypatch):
    land(warehouse, "l", records=[record(1), record(2, norad="5"), record(3, day=date(2025, 1, 4))])
    staged, looked = [], []
    stage, stored = jobs.staged, Warehouse.stored_for
    monkeypatch.setattr(jobs, "staged", lambda df: staged.append(df.columns) or stage(df))
    monkeypatch.setattr(
        Warehouse, "stored_for",
        lambda self, table, rows, *a, **b: looked.append(table) or stored(self, table, rows, *a, **b),
    )
    assert jobs.satcat_to_silver(warehouse, "s") == 5
    assert not any("period_minutes" in columns for columns in staged)
    assert looked == ["silver.satcat_satellite"] * 2


def test_snapshots_of_a_retry_find_satellites_done_before(warehouse, monkeypatch):
    land(warehouse, "l", records=[record(1), record(2, norad="5"), record(3, day=date(2025, 1, 4))])
    keyed = Warehouse.append_keyed

    def fails(self, df, table, *rest):
        if table == "silver.satcat_orbit_snapshot":
            raise RuntimeError("lost")
        return keyed(self, df, table, *rest)

    monkeypatch.setattr(Warehouse, "append_keyed", fails)
    with pytest.raises(RuntimeError):
        jobs.satcat_to_silver(warehouse, "s")
    monkeypatch.undo()
    assert jobs.satcat_to_silver(warehouse, "s") == 3
    assert len(content(warehouse, "silver.satcat_satellite")) == 2
