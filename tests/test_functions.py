import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from skyledger.functions import approach, orbit, text
from skyledger.functions.aggregates import exact_avg


def value(spark, column, **inputs):
    frame = spark.range(1).select(*[F.lit(v).alias(k) for k, v in inputs.items()])
    return frame.select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "raw, expected",
    [("12.5", 12.5), ("", None), ("abc", None), (None, None), (" 7 ", 7.0), ("1e3", 1000.0)],
)
def test_number_of_dirty_text(spark, raw, expected):
    column = F.lit(raw).cast("string")
    assert spark.range(1).select(text.to_number(column)).first()[0] == expected


def test_a_measure_equals_the_cast_of_its_text(spark):
    raws = ["12.5", "", " ", "n/a", "abc", None, " 7 ", "1e3", "-.5", "1d", "0x1p3", "a1", "\n3\n", "\u0663"]
    raws += ["NaN", "nan", " INF", "-inf", "+Infinity", "infinit", "in f", "1\n", "-", ".", "e"]
    rows = spark.createDataFrame([(raw,) for raw in raws], "raw string")
    both = rows.select(text.to_number(F.col("raw")).alias("a"), text.to_measure(F.col("raw")).alias("b"))
    assert both.filter(~F.col("a").eqNullSafe(F.col("b"))).isEmpty()
    assert both.filter(F.col("b").isNotNull()).count() == 13


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("2024-02-29", date(2024, 2, 29)),
        ("2023-02-29", None),
        ("2024-13-45", None),
        ("", None),
        ("2024", None),
        ("2024-1-1", None),
        ("2024-01-01T00:00", None),
        (None, None),
    ],
)
def test_day_of_dirty_text(spark, raw, expected):
    column = F.lit(raw).cast("string")
    assert spark.range(1).select(text.to_day(column)).first()[0] == expected


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("2025-01-03T23:59:59.1", date(2025, 1, 3)),
        ("2025-01-03T23:59:59+09:00", date(2025, 1, 3)),
        ("2025-01-03", date(2025, 1, 3)),
        ("yesterday", None),
        (None, None),
    ],
)
def test_day_of_iso_timestamp(spark, raw, expected):
    column = F.lit(raw).cast("string")
    assert spark.range(1).select(text.day_of_iso_timestamp(column)).first()[0] == expected


def test_text_helpers(spark):
    row = spark.sql("SELECT '  MiXed ' AS a, map('x', '1.5', 'y', '') AS m").select(
        text.normalized(F.col("a")).alias("n"),
        text.map_number(F.col("m"), "x").alias("x"),
        text.map_number(F.col("m"), "y").alias("y"),
        text.map_number(F.col("m"), "z").alias("z"),
        text.joined_fields([F.lit("a"), F.lit(None).cast("string"), F.lit("c")]).alias("j"),
    ).first()
    assert tuple(row) == ("mixed", 1.5, None, None, "a,,c")


def test_flag_counts_null_as_zero(spark):
    frame = spark.createDataFrame([(True,), (False,), (None,)], "b BOOLEAN")
    assert [r[0] for r in frame.select(text.flag(F.col("b"))).collect()] == [1, 0, 0]


def test_synthetic_marker(spark):
    frame = spark.createDataFrame(
        [('{"_synthetic": true}',), ('{"_synthetic": "true"}',), ('{"id": "1"}',), (None,)],
        "j STRING",
    )
    assert [r[0] for r in frame.select(text.is_synthetic(F.col("j"))).collect()] == [
        True, True, False, False,
    ]


def test_approach_time_round_trip(spark):
    row = spark.range(1).select(
        approach.approach_time(F.lit("2025-Jan-03 12:34")).alias("t"),
        approach.approach_time_text(approach.approach_time(F.lit("2025-Jan-03 12:34"))).alias("s"),
        approach.approach_time(F.lit("someday")).alias("bad"),
        approach.approach_day(F.lit("2025-Jan-03 12:34")).alias("d"),
        F.unix_millis(approach.epoch_time(F.lit(1735907640000))).alias("ms"),
    ).first()
    assert row["t"] == datetime(2025, 1, 3, 12, 34)
    assert row["s"] == "2025-Jan-03 12:34"
    assert row["bad"] is None
    assert row["d"] == date(2025, 1, 3)
    assert row["ms"] == 1735907640000


def test_diameter_from_magnitude(spark):
    expected = round(1329 / math.sqrt(0.154) * 10 ** (-22.0 / 5) * 0.8, 6)
    assert value(spark, approach.diameter_from_magnitude(F.col("h"), 0.8), h=22.0) == expected


def test_unit_conversions(spark):
    assert value(spark, approach.km_to_lunar(F.col("k")), k=384400.0) == 1.0
    assert value(spark, approach.km_to_au(F.col("k")), k=1.496e8) == 1.0
    assert value(spark, approach.km_to_miles(F.col("k")), k=1.0) == 0.621371
    assert value(spark, approach.meters_to_feet(F.col("k")), k=1.0) == 3.28084
    assert value(spark, approach.per_second_to_per_hour(F.col("k")), k=2.0) == 7200.0


def test_orbit_formulas(spark):
    geo = value(spark, orbit.circular_period_minutes(F.col("a")), a=35786.0)
    assert geo == pytest.approx(1436.0, abs=1.0)
    assert value(spark, orbit.mean_motion(F.col("p")), p=90.0) == 16.0
    assert value(spark, orbit.mean_motion(F.col("p")), p=0.0) is None
    ecc = value(spark, orbit.eccentricity(F.col("a"), F.col("p")), a=40000.0, p=500.0)
    assert ecc == round((40000 - 500) / (2 * (6371 + 20250)), 7)


@pytest.mark.parametrize(
    "apogee, perigee, inclination, expected",
    [
        (420.0, 410.0, 51.6, "LEO"),
        (20200.0, 20100.0, 55.0, "MEO"),
        (35786.0, 35780.0, 0.1, "GEO"),
        (35786.0, 35780.0, -0.1, "GEO"),
        (35786.0, 35780.0, 30.0, "MEO"),
        (40000.0, 500.0, 63.4, "HEO"),
        (35400.0, 35300.0, 0.0, "MEO"),
        (None, 500.0, 1.0, "UNKNOWN"),
        (500.0, 400.0, None, "UNKNOWN"),
    ],
)
def test_regime_is_one_class_per_row(spark, apogee, perigee, inclination, expected):
    frame = spark.createDataFrame(
        [(apogee, perigee, inclination)], "apogee_km DOUBLE, perigee_km DOUBLE, incl DOUBLE"
    )
    regime = orbit.regime(F.col("apogee_km"), F.col("perigee_km"), F.col("incl"))
    assert frame.select(regime).first()[0] == expected


def test_exact_avg_ignores_row_order_and_null(spark):
    values = [0.1] * 1000 + [1e12, -1e12, None]
    frame = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
    results = {
        frame.repartition(n).agg(exact_avg(F.col("v"))).first()[0] for n in (1, 3, 7)
    }
    assert results == {100.0 / 1002}
    assert frame.filter("v IS NULL").agg(exact_avg(F.col("v"))).first()[0] is None
