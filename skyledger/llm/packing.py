"""Packing documents into training sequences by best-two-fit.

Where a document goes depends on its length alone. So the driver packs the histogram of lengths,
which has no more entries than a sequence has tokens, into patterns of lengths, each with the number
of sequences that use it. Pieces are numbered inside their length, and their number tells the
sequence and the place.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.tokens import default_ranks, encoded
from skyledger.llm.workers import released
from skyledger.session import staged

CAPACITY = 2048
END_ID = 0
SALTS = 256  # parts that the pieces of one length are numbered in
_SHIFT = 40  # a slot key holds the length above and the number inside the length below


class Pattern(NamedTuple):
    lengths: tuple[int, ...]
    times: int


def pieces(
    docs: DataFrame,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    ranks_path: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document.

    A document is its token ids and `end_id`. One of more than `capacity` ids is cut from its end
    into pieces of `capacity`, so only the first piece may be shorter. A NULL or empty text is
    `end_id` alone. Rows without doc_id and repeated rows are packed like all others.
    """
    ranks_path = ranks_path or default_ranks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, _, ids, at in encoded(batch.column(1), ranks_path):
                rows: list[tuple] = []
                for k in range(len(at) - 1):
                    own = np.append(ids[at[k] : at[k + 1]], np.uint32(end_id)).astype("<u4")
                    ends = range((len(own) - 1) % capacity + 1, len(own) + 1, capacity)
                    for piece, end in enumerate(ends):
                        start = max(0, end - capacity)
                        part = own[start if piece else 0 : end]
                        rows.append((i + k, piece, end - len(part), part))
                parts = [r[3] for r in rows]
                out = [
                    batch.column(0).take(pa.array([r[0] for r in rows], pa.int64())),
                    pa.array([r[1] for r in rows], pa.int32()),
                    pa.array([r[2] for r in rows], pa.int64()),
                    pa.array([len(p) for p in parts], pa.int64()),
                    pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                ]
                if with_ids:
                    out.append(pa.array([p.astype(np.int32) for p in parts], pa.list_(pa.int32())))
                yield pa.record_batch(out, names=names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    schema += ", ids array<int>" if with_ids else ""
    names = [field.split()[0] for field in schema.split(", ")]
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(released(run), schema)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Best-two-fit over a histogram of lengths (1 to `capacity`).

    A sequence takes the longest piece left, then again the longest that fits, until none does.
    Then its smallest piece makes way for the two pieces left that fill the larger gap best, as
    long as that leaves less room. A pattern is used for as many sequences as the counts allow,
    which is what packing them one by one would choose.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, count in counts.items():
        left[length] = count
    patterns = []
    sizes = np.arange(capacity + 1)
    while left.any():
        free, gap, chosen = left.copy(), capacity, []
        while (fit := np.flatnonzero(free[: gap + 1])).size:
            chosen.append(int(fit[-1]))
            free[fit[-1]] -= 1
            gap -= chosen[-1]
        while gap and len(chosen) > 1:
            least = min(chosen)
            room = gap + least
            below = np.maximum.accumulate(np.where(free > 0, sizes, 0))
            first = np.flatnonzero(free[:room])
            second = below[room - first]
            alone = (second == first) & (free[first] < 2)
            second = np.where(alone, below[first - 1], second)
            total = np.where(second > 0, first + second, 0)
            if not len(total) or total.max() <= least:
                break
            best = int(total.argmax())
            chosen.remove(least)
            free[least] += 1
            for size in (int(first[best]), int(second[best])):
                chosen.append(size)
                free[size] -= 1
            gap = capacity - sum(chosen)
        used = np.bincount(chosen, minlength=capacity + 1)
        times = int((left[used > 0] // used[used > 0]).min())
        left -= used * times
        patterns.append(Pattern(tuple(sorted(chosen, reverse=True)), times))
    return patterns


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    ranks_path: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """Place of every piece: the columns of `pieces`, sequence_id, and offset (gapless from 0).

    Texts are encoded once, into a table of the shared folder. Sequence ids are dense from 0. An
    empty table gives no rows.
    """
    cut = staged(pieces(docs, capacity, end_id, ranks_path, with_ids))
    salt = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(SALTS)).cast("int")
    cut = cut.withColumn("salt", salt)
    # At most SALTS rows for each length.
    by_salt = staged(cut.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")))
    counts = {r["length"]: r["n"] for r in by_salt.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    key, first, base, offset = _slots(plan(counts, capacity))

    before = Window.partitionBy("length").orderBy("salt")
    offsets = by_salt.select(
        "length", "salt", (F.sum("n").over(before) - F.col("n")).alias("before")
    )
    inside = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32", "start")
    numbered = (
        cut.withColumn("number", F.row_number().over(inside).cast("long") - 1)
        .join(offsets, ["length", "salt"])
        .withColumn("number", F.col("number") + F.col("before"))
        .drop("salt", "before")
    )
    columns = [c for c in cut.columns if c != "salt"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (batch.column(c).to_numpy() for c in ("length", "number"))
            slot = np.searchsorted(key, (length << _SHIFT) | number, "right") - 1
            sequence = base[slot] + number - first[slot]
            yield pa.record_batch(
                [*(batch.column(c) for c in columns), pa.array(sequence), pa.array(offset[slot])],
                names=[*columns, "sequence_id", "offset"],
            )

    fields = ", ".join(f"{c} {kind}" for c, kind in cut.select(*columns).dtypes)
    return numbered.mapInArrow(released(place), f"{fields}, sequence_id long, offset long")


def _slots(patterns: list[Pattern]) -> tuple[np.ndarray, ...]:
    """Sorted key (length, first number), first number, first sequence and offset of each slot."""
    rows, used, sequence = [], {}, 0
    for pattern in patterns:
        offset = 0
        for length in pattern.lengths:
            start = used.get(length, 0)
            rows.append(((length << _SHIFT) | start, start, sequence, offset))
            used[length] = start + pattern.times
            offset += length
        sequence += pattern.times
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 4)
    return table[:, 0], table[:, 1], table[:, 2], table[:, 3]


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the token ids of each sequence, from `pack(..., with_ids=True)`."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(parts["ids"]).alias("ids"))
