"""Exact histogram of encoded lengths, and what its suffix sums tell about context limits."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.tokens import default_ranks, encoded
from skyledger.llm.workers import released

_BLOCK = 1024  # lengths per block of the suffix sums


def length_histogram(docs: DataFrame, ranks_path: str | None = None) -> DataFrame:
    """(n_tokens, n_docs): how many rows of `docs` have each encoded length.

    NULL and empty texts have length 0. Every row counts, also repeated ones and those without
    doc_id; columns other than `text` are ignored. No rows give an empty histogram. Lengths are
    counted per batch before the shuffle, so its size follows the distinct lengths.
    """
    ranks_path = ranks_path or default_ranks()

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.diff(at) for _, _, _, at in encoded(batch.column(0), ranks_path)]
            length, count = np.unique(
                np.concatenate(found) if found else np.empty(0, np.int64), return_counts=True
            )
            yield pa.record_batch(
                [pa.array(length, pa.int64()), pa.array(count, pa.int64())],
                names=["n_tokens", "n_docs"],
            )

    counted = docs.select("text").mapInArrow(released(lengths), "n_tokens long, n_docs long")
    return counted.groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))


def suffix_totals(histogram: DataFrame) -> DataFrame:
    """One row per length L that occurs, with what a limit of L tokens means:

    docs_at_least and tokens_at_least (documents of L tokens or more), truncated_total (tokens left
    when every document is cut to L) and share (documents of L tokens or fewer, 0 to 1).

    The sums run over blocks of lengths first, then inside each block, so no task sees more rows
    than there are blocks or lengths in a block.
    """
    rows = histogram.withColumn("block", F.floor(F.col("n_tokens") / F.lit(_BLOCK))).withColumn(
        "tokens", F.col("n_tokens") * F.col("n_docs")
    )
    longer = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        rows.groupBy("block")
        .agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
        .select(
            "block",
            F.coalesce(F.sum("d").over(longer), F.lit(0)).alias("later_docs"),
            F.coalesce(F.sum("t").over(longer), F.lit(0)).alias("later_tokens"),
        )
    )
    down = Window.partitionBy("block").orderBy(F.desc("n_tokens"))
    summed = rows.join(F.broadcast(blocks), "block").select(
        "n_tokens",
        "n_docs",
        (F.col("later_docs") + F.sum("n_docs").over(down)).alias("docs_at_least"),
        (F.col("later_tokens") + F.sum("tokens").over(down)).alias("tokens_at_least"),
    )
    all_docs = rows.agg(F.sum("n_docs")).scalar()
    all_tokens = rows.agg(F.sum("tokens")).scalar()
    return summed.select(
        "*",
        (all_tokens - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")).alias(
            "truncated_total"
        ),
        ((all_docs - F.col("docs_at_least") + F.col("n_docs")) / all_docs).alias("share"),
    )


def at_limits(totals: DataFrame, limits: Sequence[int]) -> DataFrame:
    """(context, docs_over, truncated_total) for any context limits, from `suffix_totals`."""
    everything = F.max(
        F.col("truncated_total") - F.col("n_tokens") * F.col("docs_at_least") + F.col("tokens_at_least")
    )
    rows = []
    for limit in limits:
        at = F.col("n_tokens") > F.lit(limit)
        first = F.min_by(
            F.struct("docs_at_least", "tokens_at_least"), F.when(at, F.col("n_tokens"))
        )
        docs = F.coalesce(first["docs_at_least"], F.lit(0))
        tokens = F.coalesce(first["tokens_at_least"], F.lit(0))
        rows.append(
            F.struct(
                F.lit(limit).cast("long").alias("context"),
                docs.alias("docs_over"),
                (everything - tokens + F.lit(limit) * docs).alias("truncated_total"),
            )
        )
    return totals.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def quantiles(totals: DataFrame, shares: Sequence[float]) -> DataFrame:
    """(share, n_tokens): least length that at least this share of the documents stays within."""
    rows = [
        F.struct(
            F.lit(s).alias("share"),
            F.min(F.when(F.col("share") >= F.lit(s), F.col("n_tokens"))).alias("n_tokens"),
        )
        for s in shares
    ]
    return totals.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))
