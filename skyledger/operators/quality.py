"""Declarative data-quality checks.

A table's row-level checks share one aggregate; each uniqueness check is one grouped count.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.aggregates import count_where
from skyledger.session import staged_with

RECORD_COLUMNS = ["check_name", "status", "total_records", "failed_records", "details"]


@dataclass(frozen=True)
class Check:
    """One check of one table. Build it with the functions below."""

    name: str
    kind: str
    columns: tuple[str, ...]
    details: str
    low: float | None = None
    high: float | None = None
    accepted: tuple = ()

    def fails(self) -> Column:
        """Condition under which one row fails. A NULL passes all but `non_null`."""
        column = F.col(self.columns[0])
        if self.kind == "non_null":
            return column.isNull()
        if self.kind == "accepted":
            return ~column.isin(*self.accepted)
        bounds = []
        if self.low is not None:
            bounds.append(column < F.lit(self.low))
        if self.high is not None:
            bounds.append(column > F.lit(self.high))
        return reduce(lambda a, b: a | b, bounds)


def non_null(name: str, column: str) -> Check:
    return Check(name, "non_null", (column,), json.dumps({"column": column}))


def unique(name: str, columns: Sequence[str]) -> Check:
    """Fails count the duplicate groups; NULL keys form one group."""
    return Check(name, "unique", tuple(columns), json.dumps({"columns": list(columns)}))


def value_range(name: str, column: str, low: float | None = None, high: float | None = None) -> Check:
    """Inclusive bounds. Without any bound the check gives no record."""
    details = json.dumps({"column": column, "min_value": low, "max_value": high})
    return Check(name, "range", (column,), details, low, high)


def accepted_values(name: str, column: str, values: Sequence) -> Check:
    details = json.dumps({"column": column, "values": list(values)})
    return Check(name, "accepted", (column,), details, accepted=tuple(values))


def _record(check_name, total, failed, details) -> Column:
    return F.struct(
        F.lit(check_name).alias("check_name"),
        F.when(failed == 0, F.lit("pass")).otherwise(F.lit("fail")).alias("status"),
        total.alias("total_records"),
        failed.alias("failed_records"),
        F.lit(details).alias("details"),
    )


def _row_level(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    fails = [count_where(c.fails()).alias(f"f{i}") for i, c in enumerate(checks)]
    counted = df.agg(F.count(F.lit(1)).alias("n"), *fails)
    records = [
        _record(c.name, F.col("n"), F.col(f"f{i}"), c.details) for i, c in enumerate(checks)
    ]
    return counted.select(F.inline(F.array(*records)))


def _uniqueness(df: DataFrame, check: Check) -> DataFrame:
    groups = df.groupBy(*check.columns).agg(F.count(F.lit(1)).alias("n"))
    counted = groups.agg(
        F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("n"),
        F.count(F.when(F.col("n") > 1, F.lit(1))).alias("f"),
    )
    return counted.select(F.inline(F.array(_record(check.name, F.col("n"), F.col("f"), check.details))))


def _active(checks: Iterable[Check]) -> list[Check]:
    active = [
        c for c in checks if not (c.kind == "range" and c.low is None and c.high is None)
    ]
    if not active:
        raise ValueError("no check to evaluate")
    return active


def evaluate(df: DataFrame, checks: Iterable[Check]) -> DataFrame:
    """One record per check."""
    active = _active(checks)
    row_level = [c for c in active if c.kind != "unique"]
    parts = [_uniqueness(df, c) for c in active if c.kind == "unique"]
    if row_level:
        parts.insert(0, _row_level(df, row_level))
    return reduce(DataFrame.unionByName, parts)


def staged_and_evaluated(
    df: DataFrame, checks: Iterable[Check]
) -> tuple[DataFrame, DataFrame]:
    """`df` written to the shared storage, and one record per check.

    The row-level checks are counted while the rows are written, so they cost no pass of their own.
    Each uniqueness check reads its key columns of the written rows.
    """
    active = _active(checks)
    row_level = [c for c in active if c.kind != "unique"]
    fails = {f"f{i}": count_where(c.fails()) for i, c in enumerate(row_level)}
    rows, found = staged_with(df, n=F.count(F.lit(1)), **fails)
    total = F.lit(found["n"]).cast("long")
    records = [
        _record(c.name, total, F.lit(found[f"f{i}"]).cast("long"), c.details)
        for i, c in enumerate(row_level)
    ]
    parts = [_uniqueness(rows, c) for c in active if c.kind == "unique"]
    if records:
        one = df.sparkSession.range(0, 1, 1, 1)
        parts.insert(0, one.select(F.inline(F.array(*records))))
    return rows, reduce(DataFrame.unionByName, parts)


def evaluate_all(tables: Mapping[str, DataFrame], checks: Mapping[str, Sequence[Check]]) -> DataFrame:
    """Records for several tables; `checks` maps a table name to its checks.

    Each table is computed once, however many checks it has: the columns that they read are staged.
    """
    records = []
    for name, list_ in checks.items():
        columns = dict.fromkeys(c for check in list_ for c in check.columns)
        records.append(staged_and_evaluated(tables[name].select(*columns), list_)[1])
    return reduce(DataFrame.unionByName, records)


def orphans(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact keys without a dimension row, with their row count.

    Facts are counted per key before the join, so a hot key travels as one row per map task.
    """
    counted = fact.groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.join(dim.select(key), key, "left_anti")


class QualityGateError(ValueError):
    """At least one data-quality check failed."""


def failures(records: DataFrame) -> list[str]:
    """Descriptions of the failed checks. Records are few: one per check."""
    failed = records.filter(F.col("status") == "fail").orderBy("check_name").collect()
    return [
        f"{r['check_name']} {r['details']}: {r['failed_records']} of {r['total_records']}"
        for r in failed
    ]


def raise_on_failure(records: DataFrame) -> None:
    messages = failures(records)
    if messages:
        raise QualityGateError("data-quality checks failed: " + "; ".join(messages))
