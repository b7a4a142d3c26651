"""Insert-only merges and load guards."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.operators.dedup import first_per_key
from skyledger.operators.lookup import lookup
from skyledger.session import staged_with

BROADCAST_GROUPS = 100_000  # guard groups that every task may hold


def not_yet_in(df: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `df` whose key is absent from `existing`; NULL equals NULL.

    An ordinary anti join never matches NULL, so a row with a NULL in its key would be added again
    by each run. Null-safe equality is still an equi-join key for Spark.
    """
    stored = existing.select(*[F.col(k).alias(f"_old_{k}") for k in keys])
    condition = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_old_{k}")) for k in keys]
    )
    return df.join(stored, condition, "left_anti")


def insert_or_ignore(
    arrivals: DataFrame, existing: DataFrame, keys: Sequence[str], arrival_order: Sequence[Column]
) -> DataFrame:
    """Arrivals to append: first arrival per key, keys already stored left out."""
    return not_yet_in(first_per_key(arrivals, keys, arrival_order), existing, keys)


def load_once(
    arrivals: DataFrame,
    existing: DataFrame,
    guard: Sequence[str],
    groups: DataFrame | None = None,
) -> DataFrame:
    """Arrivals of those guard groups of which nothing is stored yet.

    One group (a whole snapshot) may hold most arrivals. So the groups are compared first, as
    distinct keys, and the arrivals are then filtered by the short list of open groups. NULL is an
    ordinary value of a group: the filter compares the guard as one struct. `groups`, the distinct
    guards of the arrivals, saves a pass over these where they are known.
    """
    if groups is None:
        groups = arrivals.select(*guard).distinct()
    open_groups = not_yet_in(groups, existing.select(*guard).distinct(), guard)
    group = F.struct(*guard).alias("_guard")
    listed, found = staged_with(open_groups.select(group), rows=F.count(F.lit(1)))
    rows = arrivals.select("*", group)
    if found["rows"] <= BROADCAST_GROUPS:  # then no arrival is shuffled
        return rows.join(F.broadcast(listed), "_guard", "left_semi").drop("_guard")
    return lookup(rows, listed, ["_guard"], arrivals.columns, "left_semi").drop("_guard")
