"""Connected components of a graph that no single machine has to hold."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.workers import released
from skyledger.session import staged


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every id in `edges` (columns a, b: long, not null).

    `component` is the least id that can be reached. Each partition first replaces its edges by a
    spanning forest (union-find). Then stars are merged until nothing changes: every id links its
    larger neighbours, then its smaller ones, to the least of them (Kiveris et al. 2014). The rounds
    grow with the logarithm of the size. Each round is a table in the shared folder, so a lost
    executor costs one round at most.
    """
    forest = edges.mapInArrow(released(_spanning_forest), "a long, b long")
    current = staged(forest.filter("a > b").distinct())
    mark = _mark(current)
    while True:
        current = staged(_small_star(_large_star(current)))
        previous, mark = mark, _mark(current)
        if mark == previous:
            break
    ids = current.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return ids.union(current.select("b", "b").distinct())


def _mark(edges: DataFrame) -> tuple:
    digest = F.xxhash64("a", "b").cast("decimal(20,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(digest)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b != m").select(F.col("b").alias("a"), "m")
    return moved.union(least).select("a", F.col("m").alias("b")).distinct()


def _spanning_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            top = x
            while (up := parent.get(top, top)) != top:
                top = up
            while x != top:
                parent[x], x = top, parent.get(x, x)
            return top

        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        pairs = [(x, root(x)) for x in parent]
        yield pa.record_batch(
            [pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["a", "b"]
        )
