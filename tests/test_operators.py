import hashlib
from datetime import date

import pytest
from pyspark.sql import functions as F

from skyledger.operators import merge, quality
from skyledger.operators.dedup import duplicate_keys, first_per_key, last_per_key
from skyledger.operators.lookup import lookup
from skyledger.operators.numbering import bucketed, dense_number, next_base
from skyledger.session import staged


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_and_last_per_key_treat_null_as_a_value(spark):
    frame = spark.createDataFrame(
        [(None, 2, "b"), (None, 1, "a"), ("k", 3, "c"), ("k", 4, "d")], "k STRING, n INT, v STRING"
    )
    first = {r["k"]: r["v"] for r in first_per_key(frame, ["k"], [F.col("n")]).collect()}
    last = {r["k"]: r["v"] for r in last_per_key(frame, ["k"], ["n"]).collect()}
    assert first == {None: "a", "k": "c"}
    assert last == {None: "b", "k": "d"}


def test_dedup_limits_each_key_before_the_shuffle(spark):
    frame = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    text = plan(first_per_key(frame, ["k"], [F.col("id")]))
    after, before = text.split("Exchange hashpartitioning", 1)
    assert "WindowGroupLimit" in before and "Partial" in before


def test_duplicate_keys(spark):
    frame = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k INT")
    assert {tuple(r) for r in duplicate_keys(frame, ["k"]).collect()} == {(1, 2), (None, 2)}


@pytest.mark.parametrize("partitions", [1, 5])
def test_dense_number_follows_the_digest_order(spark, partitions):
    frame = spark.range(500).select(F.col("id").alias("k")).repartition(partitions)
    numbered = {r["k"]: r["sk"] for r in dense_number(frame, ["k"], "sk", 100).collect()}
    order = sorted(range(500), key=lambda k: hashlib.md5(str(k).encode()).hexdigest())
    assert numbered == {k: 101 + i for i, k in enumerate(order)}


def test_dense_number_per_group(spark):
    frame = spark.range(300).select((F.col("id") % 3).alias("g"), "id")
    numbered = dense_number(frame, ["id"], "n", within="g")
    sizes = numbered.groupBy("g").agg(F.min("n"), F.max("n"), F.count_distinct("n")).collect()
    assert {tuple(r) for r in sizes} == {(g, 1, 100, 100) for g in range(3)}


def test_dense_number_never_ranks_in_one_task(spark):
    frame = spark.range(1000).select(F.col("id").alias("k"))
    text = plan(dense_number(frame, ["k"], "sk"))
    ranked = [line for line in text.splitlines() if "row_number()" in line]
    assert ranked and all("windowspecdefinition(_bucket" in line for line in ranked)


def test_dense_number_takes_the_staged_bucket(spark):
    frame = spark.range(50).select(F.col("id").cast("string").alias("k"), "id")
    numbered = dense_number(staged(bucketed(frame, ["k"])), ["k"], "n", 7)
    assert numbered.columns == ["n", "k", "id"]
    assert plan(numbered).count("md5(") == 1  # for the order inside a bucket, after the shuffle
    assert sorted(numbered.collect()) == sorted(dense_number(frame, ["k"], "n", 7).collect())


def test_next_base(spark):
    stored = spark.createDataFrame([(7,), (9,)], "sk LONG")
    frame = spark.range(1)
    assert frame.select(next_base(stored, "sk")).first()[0] == 9
    assert frame.select(next_base(stored.limit(0), "sk")).first()[0] == 0


def test_not_yet_in_matches_null_keys(spark):
    new = spark.createDataFrame([("a", None), ("a", "x"), ("b", None)], "p STRING, q STRING")
    stored = spark.createDataFrame([("a", None)], "p STRING, q STRING")
    left = merge.not_yet_in(new, stored, ["p", "q"])
    assert {tuple(r) for r in left.collect()} == {("a", "x"), ("b", None)}
    assert "NestedLoop" not in plan(left) and "Cartesian" not in plan(left)


def test_load_once_skips_loaded_groups(spark):
    schema = "g STRING, d DATE, v INT"
    day, other = date(2025, 1, 1), date(2025, 1, 2)
    arrivals = spark.createDataFrame(
        [("active", day, 1), ("active", day, 2), ("active", other, 3), ("all", day, 4)], schema
    )
    stored = spark.createDataFrame([("active", day, 9)], schema)
    new = merge.load_once(arrivals, stored, ["g", "d"])
    assert sorted(r["v"] for r in new.collect()) == [3, 4]
    assert merge.load_once(arrivals, arrivals, ["g", "d"]).isEmpty()


def test_load_once_keeps_arrivals_with_null_in_their_group(spark):
    schema = "g STRING, d DATE, v INT"
    day = date(2025, 1, 1)
    arrivals = spark.createDataFrame([(None, day, 1), ("a", None, 2), (None, None, 3)], schema)
    new = merge.load_once(arrivals, arrivals.limit(0), ["g", "d"])
    assert sorted(r["v"] for r in new.collect()) == [1, 2, 3] and new.columns == ["g", "d", "v"]
    assert sorted(r["v"] for r in merge.load_once(arrivals, arrivals.filter("v = 1"), ["g", "d"]).collect()) == [2, 3]


def test_lookup_has_one_plan_at_every_size(spark):
    rows = spark.range(1000).select("id", F.col("id").alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [plan(lookup(rows, spark.range(n).select("id"), ["id"], ["v"])) for n in (1, 10**6)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert all("SortMergeJoin [id" in p and "_part" in p and "GlobalLimit" not in p for p in plans)


@pytest.mark.parametrize("how", ["inner", "left_semi"])
def test_lookup_spreads_a_hot_key_and_loses_nothing(spark, how):
    hot = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
    rows = spark.range(30000).select(hot.alias("k"), F.col("id").alias("v"))
    side = spark.range(20000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    expected = rows.join(side, "k", how)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookup(rows, side, ["k"], ["v"], how)
        columns = ["k", "v"] + (["w"] if how == "inner" else [])
        assert joined.columns == columns
        assert joined.exceptAll(expected).isEmpty() and expected.exceptAll(joined).isEmpty()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# --- quality ---


def record(df, check):
    return {r["check_name"]: r for r in quality.evaluate(df, [check]).collect()}[check.name]


def test_non_null(spark):
    frame = spark.createDataFrame([(1,), (None,)], "a INT")
    row = record(frame, quality.non_null("c", "a"))
    assert (row["status"], row["total_records"], row["failed_records"]) == ("fail", 2, 1)
    assert row["details"] == '{"column": "a"}'


def test_unique_counts_groups_and_null_is_one_group(spark):
    frame = spark.createDataFrame([(1,), (1,), (1,), (None,), (None,), (2,)], "a INT")
    row = record(frame, quality.unique("c", ["a"]))
    assert (row["status"], row["total_records"], row["failed_records"]) == ("fail", 6, 2)
    empty = record(frame.limit(0), quality.unique("c", ["a"]))
    assert (empty["status"], empty["total_records"], empty["failed_records"]) == ("pass", 0, 0)


@pytest.mark.parametrize(
    "value, fails", [(-5.0, 0), (40.0, 0), (-5.01, 1), (40.01, 1), (None, 0)]
)
def test_value_range_is_inclusive_and_passes_null(spark, value, fails):
    frame = spark.createDataFrame([(value,)], "a DOUBLE")
    assert record(frame, quality.value_range("c", "a", -5.0, 40.0))["failed_records"] == fails


@pytest.mark.parametrize("value, fails", [(-1.0, 1), (0.0, 0), (None, 0)])
def test_value_range_with_one_bound(spark, value, fails):
    frame = spark.createDataFrame([(value,)], "a DOUBLE")
    assert record(frame, quality.value_range("c", "a", low=0.0))["failed_records"] == fails


def test_value_range_without_bounds_gives_no_record(spark):
    frame = spark.createDataFrame([(1.0,)], "a DOUBLE")
    checks = [quality.value_range("none", "a"), quality.non_null("some", "a")]
    assert [r["check_name"] for r in quality.evaluate(frame, checks).collect()] == ["some"]


def test_accepted_values(spark):
    frame = spark.createDataFrame([(0,), (1,), (2,), (None,)], "a INT")
    assert record(frame, quality.accepted_values("c", "a", [0, 1]))["failed_records"] == 1


def test_row_level_checks_share_one_scan(spark, tmp_path):
    spark.range(10).select(F.col("id").alias("a"), F.col("id").alias("b")).write.parquet(
        str(tmp_path / "t")
    )
    frame = spark.read.parquet(str(tmp_path / "t"))
    checks = [quality.non_null("x", "a"), quality.non_null("y", "b"), quality.value_range("z", "a", 0)]
    assert plan(quality.evaluate(frame, checks)).count("FileScan") == 1


def test_all_checks_of_a_table_compute_it_once(spark):
    frame = spark.range(6).select("id", F.uuid().alias("u"), F.lit(None).cast("int").alias("unread"))
    checks = [quality.non_null("a", "u"), quality.unique("b", ["u"]), quality.unique("c", ["id"])]
    records = quality.evaluate_all({"t": frame}, {"t": checks})
    assert "uuid(" not in plan(records)
    assert {tuple(r)[:4] for r in records.collect()} == {(n, "pass", 6, 0) for n in "abc"}


def test_orphans(spark):
    fact = spark.createDataFrame([("a",), ("b",), ("b",)], "k STRING")
    dim = spark.createDataFrame([("a",)], "k STRING")
    assert [tuple(r) for r in quality.orphans(fact, dim, "k").collect()] == [("b", 2)]


def test_raise_on_failure_names_all_failures(spark):
    frame = spark.createDataFrame([(None, -1.0)], "a INT, b DOUBLE")
    checks = [quality.non_null("first", "a"), quality.value_range("second", "b", low=0.0)]
    with pytest.raises(quality.QualityGateError, match="first.*second"):
        quality.raise_on_failure(quality.evaluate(frame, checks))


def test_nothing_stored_takes_no_join(spark):
    from pyspark.sql import types as T

    from skyledger.session import literal_rows

    empty = literal_rows(spark, T.StructType().add("k", "long"), [])
    frame = spark.range(10).select(F.col("id").alias("k"))
    new = merge.not_yet_in(frame, empty, ["k"])
    assert "Join" not in plan(new)
    assert new.count() == 10
