from pathlib import Path

import pytest

import __spark_entry__ as spark_entry
from skyledger import session

SMALL = Path("/root/testdata/sf0.001")


def test_every_query_has_sql():
    from checks.oracle import ORACLE_SQL
    from checks.queries import QUERIES

    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(spark_entry.queries())
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


@pytest.mark.skipif(not SMALL.exists(), reason="needs the test tables")
@pytest.mark.parametrize(
    "name", ["gold_neo_daily_activity", "gold_ai_neo_features", "merge_new_satellite", "run_state", "job_dq_ledger"]
)
def test_query_equals_its_sql(spark, name):
    from checks.compare import compare, duckdb_connection

    connection = duckdb_connection(str(SMALL))
    query, oracle = spark_entry.queries()[name], spark_entry.oracle_sql()[name]
    assert compare(spark, connection, query, oracle, str(SMALL)) == ""


class _Session:
    """Stands for a session without a configured checkpoint folder."""

    class conf:
        @staticmethod
        def get(key, default):
            return default

    def __init__(self, master):
        self.sparkContext = type("Context", (), {"master": master})


def test_shared_folder_is_temporary_only_in_local_mode(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert Path(session.shared_dir(_Session("local[2]"))).exists()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(_Session("spark://host:7077"))


@pytest.mark.skipif(not SMALL.exists(), reason="needs the test tables")
def test_snapshots_are_keyed_without_the_attributes_of_satellites(spark):
    from checks.standins import Inputs

    inputs = Inputs(spark, str(SMALL))
    assert inputs.snapshots.count() > 0 and "satellites" not in inputs.__dict__


def test_scans_are_bounded_unless_the_session_says_otherwise(spark):
    before = spark.conf.get(session.SPLIT_BYTES)
    try:
        for given, kept in (("134217728b", "32m"), ("64m", "64m")):
            spark.conf.set(session.SPLIT_BYTES, given)
            session.bound_splits(spark)
            assert spark.conf.get(session.SPLIT_BYTES) == kept
    finally:
        spark.conf.set(session.SPLIT_BYTES, before)


@pytest.mark.parametrize(("group_rows", "dealt"), [(1000, False), (1_000_000, True)])
def test_tables_with_row_groups_for_all_cores_are_not_dealt(spark, tmp_path, group_rows, dealt):
    import duckdb

    from checks.standins import Inputs

    path = tmp_path / "a table.parquet"
    duckdb.sql(
        f"copy (select range as id from range(100000)) to '{path}' "
        f"(format parquet, row_group_size {group_rows})"
    )
    rows = Inputs(spark, str(tmp_path)).rows("a table")
    assert ("Exchange" in rows._jdf.queryExecution().executedPlan().toString()) == dealt
    assert rows.count() == 100_000


@pytest.mark.skipif(not SMALL.exists(), reason="needs the test tables")
def test_incremental_scores_do_not_stage_the_whole_records(spark, monkeypatch):
    from checks.compare import compare, duckdb_connection
    from checks.standins import Inputs

    def records(inputs):
        raise AssertionError("each record is read by one load only")

    monkeypatch.setattr(Inputs, "records", property(records))
    name, connection = "orbit_anomaly_incremental", duckdb_connection(str(SMALL))
    query, oracle = spark_entry.queries()[name], spark_entry.oracle_sql()[name]
    assert compare(spark, connection, query, oracle, str(SMALL)) == ""


@pytest.mark.parametrize("given", [None, "3"])
def test_scans_have_tasks_for_all_cores_unless_the_session_says_otherwise(spark, given):
    name = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(name, None)
    try:
        spark.conf.unset(name) if given is None else spark.conf.set(name, given)
        session.bound_splits(spark)
        assert spark.conf.get(name) == (given or str(4 * spark.sparkContext.defaultParallelism))
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
