"""Joins from a large table to a smaller one that stay balanced under hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PARTS = 4096  # no join group holds more than about 1/PARTS of the rows
PART_ROWS = 256  # nor is a group worth splitting below this size


def lookup(
    rows: DataFrame,
    side: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    how: str = "inner",
    counts: DataFrame | None = None,
) -> DataFrame:
    """Join `rows` to `side`, which has few rows per key. `how` is 'inner', 'left' or 'left_semi'.

    Keys that hold more than 1/PARTS of the rows (so fewer than PARTS keys) are spread: each of
    their rows gets a part number from a hash of `spread_by`, and their rows of `side` are repeated
    once per part. All other keys keep one part. The plan is the same at every size; where `side`
    turns out to be small, adaptive execution broadcasts it by its measured bytes.

    `counts` (the keys and a column `_n`) saves the count of rows per key where it is known.
    """
    if counts is None:
        counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    share = F.greatest(counts.agg(F.sum("_n")).scalar() / F.lit(PARTS), F.lit(float(PART_ROWS)))
    hot = counts.filter(F.col("_n") > share).select(
        *keys, F.ceil(F.col("_n") / share).cast("int").alias("_parts")
    )
    parts = F.coalesce("_parts", F.lit(1))
    spread = rows.join(F.broadcast(hot), list(keys), "left").withColumn(
        "_part", F.pmod(F.xxhash64(*spread_by), parts).cast("int")
    )
    repeated = side.join(F.broadcast(hot), list(keys), "left").select(
        *side.columns, F.explode(F.sequence(F.lit(0), parts - 1)).alias("_part")
    )
    return spread.join(repeated, [*keys, "_part"], how).drop("_part", "_parts")
