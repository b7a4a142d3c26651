"""One row per key.

Spark keeps only the best row per key within each map task before the shuffle (the rank limit below
is applied on both sides of it). A key that holds a large share of all rows therefore costs one row
per map task and never gathers in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The row of each key that comes first in `order`. NULL is an ordinary key value.

    `order` must end in a unique column, or in all columns, for a repeatable choice.
    """
    by_key = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_position", F.row_number().over(by_key)).filter(
        F.col("_position") == 1
    ).drop("_position")


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that comes last by the columns of `order`."""
    return first_per_key(df, keys, [F.desc_nulls_last(c) for c in order])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")
