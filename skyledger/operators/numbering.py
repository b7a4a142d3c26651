"""Dense numbering of a whole table without a global sort.

Rows are spread over 16**HEX_DIGITS buckets by the leading hex digits of the md5 of their key. A
first pass counts the rows per bucket, a running sum over those counts gives each bucket its
offset, and a second pass ranks the rows inside every bucket. The numbers equal
`row_number() over (order by md5(key), key)`, but no task ever sorts more than a few buckets. The
order depends on the key only, so repeated runs and lost executors give the same numbers.

The key must be unique; duplicates belong to `dedup` first. Both passes read the input, so hand in
a staged table where building it is expensive, and stage it with `bucketed`: then the digest is taken
once before the shuffle, not once a pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HEX_DIGITS = 4  # 65,536 buckets: the offsets stay a small broadcast at any table size
BUCKET = "_bucket"
_SEPARATOR = "|"
_NULL_TEXT = "~"


def key_digest(keys: Sequence[str]) -> Column:
    """md5 of the key columns as text."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit(_NULL_TEXT)) for k in keys]
    return F.md5(F.concat_ws(_SEPARATOR, *parts).cast("binary"))


def bucketed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`df` with the bucket of its key, which `dense_number` by the same keys then takes from there."""
    digits = F.substring(key_digest(keys), 1, HEX_DIGITS)
    return df.withColumn(BUCKET, F.conv(digits, 16, 10).cast("int"))


def dense_number(
    df: DataFrame, keys: Sequence[str], name: str, base: Column | int = 0, within: str | None = None
) -> DataFrame:
    """Add column `name`: base + 1, base + 2, ... in digest order, restarting per `within` value."""
    group = [within] if within else []
    digest = key_digest(keys)
    columns = [c for c in df.columns if c != BUCKET]
    marked = df if BUCKET in df.columns else bucketed(df, keys)
    counts = marked.groupBy(*group, BUCKET).agg(F.count(F.lit(1)).alias("_n"))
    # At most 16**HEX_DIGITS rows per group, whatever the size of `df`.
    running = Window.partitionBy(*group).orderBy(BUCKET)
    offsets = counts.select(
        *group,
        BUCKET,
        (F.sum("_n").over(running) - F.col("_n")).alias("_offset"),
    )
    in_bucket = Window.partitionBy(*group, BUCKET).orderBy("_digest", *keys)
    # The digest is taken again after the shuffle, which is spared its 32 characters a row.
    placed = marked.repartition(*group, BUCKET).withColumn("_digest", digest)
    ranked = placed.withColumn("_rank", F.row_number().over(in_bucket).cast("long"))
    number = F.col("_offset") + F.col("_rank")
    base_column = F.lit(base).cast("long") if isinstance(base, int) else base
    return ranked.join(F.broadcast(offsets), [*group, BUCKET], "inner").select(
        (base_column + number).alias(name), *columns
    )


def number_by_position(df: DataFrame, position: str, name: str, base: int = 0) -> DataFrame:
    """Add column `name`: base + 1, base + 2, ... in the order of `position`, which goes.

    `position` is the `monotonically_increasing_id` that `df` was staged with, all rows of it. Each
    partition of that time gets the number of rows before it; one count per partition meets in a
    task, and the rows themselves are not shuffled.
    """
    part = F.shiftrightunsigned(position, 33)
    sizes = df.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")
    offsets = F.broadcast(sizes.select("_part", before.alias("_before")))
    inside = F.col(position).bitwiseAND((1 << 33) - 1)
    number = F.lit(base).cast("long") + F.col("_before") + inside + 1
    columns = [c for c in df.columns if c not in (name, position)]
    return df.withColumn("_part", part).join(offsets, "_part").select(number.alias(name), *columns)


def next_base(existing: DataFrame, name: str) -> Column:
    """Highest number in use, or 0, as a scalar subquery."""
    return F.coalesce(existing.agg(F.max(name)).scalar(), F.lit(0).cast("long"))
