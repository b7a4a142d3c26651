"""Spelling variants: words at edit distance one, found by pairs of trie nodes.

All words are put into a forward trie (nodes are prefixes) and a reversed trie (nodes are suffixes),
and the nodes are numbered. Leaving out the character at position i of a word gives the pair
(node of the prefix before i, node of the suffix behind i); leaving out nothing gives the pair of the
two halves at i. Two words that differ by one replaced character share a pair of the first kind. A
word and a shorter one that lacks one of its characters share a pair of the first and one of the
second kind. Nothing else shares a pair, so equal pairs are exactly the neighbours, without any
comparison of texts. A group of equal pairs has one word per character at most, whatever the size of
the table.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.workers import released
from skyledger.session import staged

HELD_WORDS = 200_000  # distinct words that a task counts before it hands them on
HEAD = 6  # nodes up to this depth are numbered by their own characters, deeper ones in sorted order
OUT_ROWS = 100_000
_SPACE = 32

_LETTERS = bytearray([_SPACE]) * 256
for _code in range(256):
    if 65 <= _code <= 90:
        _LETTERS[_code] = _code + 32
    elif 97 <= _code <= 122 or _code >= 0xC0:
        _LETTERS[_code] = _code
_LETTERS = bytes(_LETTERS)  # other characters end a run; only A-Z change case


def word_counts(
    docs: DataFrame, min_chars: int = 7, min_count: int = 2, drop_every: int | None = None
) -> DataFrame:
    """(word, n) of all runs of `[A-Za-z\\u00C0-\\u00FF]` in `docs` (doc_id, text), A-Z in lower case.

    Words of at least `min_chars` code points that occur at least `min_count` times. With
    `drop_every`, a run loses one code point where the crc32 h of the UTF-8 text `<doc_id>:<run>` is a
    multiple of it: the one at h modulo the length of the run. A NULL text has no runs and a NULL
    doc_id is written as nothing. Repeated rows count each time. Other columns are ignored.
    """
    count = partial(_counted, min_chars, drop_every)
    counts = docs.select(F.col("doc_id").cast("string"), "text").mapInArrow(
        released(count), "word string, n long"
    )
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def _counted(min_chars, drop_every, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter[bytes] = Counter()
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if text is None:
                continue
            # One byte per code point; what Latin-1 lacks becomes `?`, which ends a run as well.
            runs = text.encode("latin-1", "replace").translate(_LETTERS).split()
            runs = [run for run in runs if len(run) >= min_chars]
            if drop_every is None:
                held.update(runs)
            else:
                begin = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for run, n in Counter(runs).items():
                    plain = run if run.isascii() else run.decode("latin-1").encode()
                    digest = zlib.crc32(plain, begin)
                    if digest % drop_every == 0:
                        at = digest % len(run)
                        run = run[:at] + run[at + 1 :]
                        if len(run) < min_chars:
                            continue
                    held[run] += n
            if len(held) > HELD_WORDS:
                yield _count_rows(held)
                held.clear()
    if held:
        yield _count_rows(held)


def _count_rows(held: Counter[bytes]) -> pa.RecordBatch:
    words = pa.array([word.decode("latin-1") for word in held], pa.string())
    return pa.record_batch([words, pa.array(held.values(), pa.int64())], names=["word", "n"])


def variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each row of `words` (word, n).

    Words are near if they differ by exactly one inserted, deleted or replaced code point; `n_near`
    counts those of a word. Its `form` is the near word of largest n (ties: the smallest in
    code-point order), if that n is at least `ratio` times its own, which has to be above 1; else
    NULL, like `form_n`, its count. `root` is reached by following forms; a word without a form is
    its own root.

    `words` must be unique, not NULL, and of code points from 1 to 255 (`word_counts` gives such).
    Other columns are ignored. An empty table gives an empty result. Words may be of any length: only
    integers are kept per position.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 at least, else forms may lead in circles")
    spark = words.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Words with one head meet in one task, in order; equal heads never fall on both sides of a bound.
    in_order = (
        words.select("word", F.col("n").cast("long"))
        .repartitionByRange(parts, F.substring("word", 1, HEAD))
        .sortWithinPartitions("word")
    )
    numbered = staged(
        in_order.mapInArrow(
            released(_forward_nodes), "id long, word string, n long, prefixes array<long>"
        )
    )
    backwards = (
        numbered.select("id", "n", "prefixes", F.reverse("word").alias("drow"))
        .repartition(parts, F.substring("drow", 1, HEAD))
        .sortWithinPartitions("drow")
    )
    pairs = backwards.mapInArrow(
        released(_node_pairs), "prefix long, suffix long, kind byte, id long, n long"
    )
    met = (
        pairs.repartition(parts, "prefix", "suffix")
        .sortWithinPartitions("prefix", "suffix")
        .mapInArrow(released(_neighbours), "id long, near long, best_n long, best long")
    )
    near = met.groupBy("id").agg(
        F.sum("near").alias("n_near"),
        F.max(F.struct("best_n", (-F.col("best")).alias("back"))).alias("best"),
    )
    table = numbered.select("id", "word", "n").join(near, "id", "left")
    accepted = F.col("best.best_n") >= F.col("n") * ratio
    table = staged(
        table.select(
            "id",
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(accepted, -F.col("best.back")).alias("form_id"),
            F.when(accepted, F.col("best.best_n")).alias("form_n"),
        )
    )
    linked = _rooted(table.filter("form_id IS NOT NULL").select("id", "form_id"))
    names = table.select(F.col("id").alias("form_id"), F.col("word").alias("form"))
    roots = table.select(F.col("id").alias("root_id"), F.col("word").alias("root"))
    named = linked.join(names, "form_id").join(roots, "root_id").select("id", "form", "root")
    return table.join(named, "id", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _rooted(links: DataFrame) -> DataFrame:
    """(id, form_id, root_id): the end of each chain, by doubling. Counts grow along a chain by the
    ratio at least, so it has fewer than 64 steps and ends after six rounds."""
    current = staged(links.withColumn("root_id", F.col("form_id")))
    while True:
        further = current.select(F.col("id").alias("root_id"), F.col("root_id").alias("next"))
        step = staged(current.join(further, "root_id", "left"))
        if step.filter("next IS NOT NULL").isEmpty():
            return current
        current = step.select("id", "form_id", F.coalesce("next", "root_id").alias("root_id"))


class _Trie:
    """Numbers of the nodes along one word after another, which come in order.

    A node of at most HEAD characters has them as its number. A deeper one gets the next free number
    of this task; words that share it are neighbours in the order and in this task.
    """

    def __init__(self):
        self.word = b""
        self.path = [0]
        self.next = (1 << 62) | (TaskContext.get().partitionId() << 40)

    def nodes(self, word: bytes) -> list[int]:
        """Numbers of the len(word) + 1 prefixes; valid until the next call."""
        old, most = self.word, min(len(self.word), len(word))
        same = most
        if old[:most] != word[:most]:
            same = next(i for i in range(most) if old[i] != word[i])
        path = self.path
        del path[same + 1 :]
        while len(path) <= min(HEAD, len(word)):
            depth = len(path)
            path.append(path[-1] | word[depth - 1] << 8 * (HEAD - depth))
        fresh = len(word) + 1 - len(path)
        path.extend(range(self.next, self.next + fresh))
        self.next += fresh
        self.word = word
        return path


def _forward_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    trie, number = _Trie(), TaskContext.get().partitionId() << 40
    for batch in batches:
        flat: list[int] = []
        ends = [0]
        for word in batch.column(0).to_pylist():
            flat += trie.nodes(word.encode("latin-1"))
            ends.append(len(flat))
        ids = np.arange(number, number + len(batch), dtype=np.int64)
        number += len(batch)
        nodes = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))
        yield pa.record_batch(
            [pa.array(ids), batch.column(0), batch.column(1), nodes],
            names=["id", "word", "n", "prefixes"],
        )


WHOLE, SKIP, FIRST_SKIP = 0, 1, 2  # nothing left out, a character, the first of equal characters


def _node_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    trie = _Trie()
    for batch in batches:
        ids, counts, prefixes, reversed_words = batch.columns
        words = [word.encode("latin-1") for word in reversed_words.to_pylist()]
        low = 0
        while low < len(words):
            high, size = low, 0
            while high < len(words) and (high == low or size < OUT_ROWS):
                size += 2 * len(words[high]) + 1
                high += 1
            part = slice(low, high)
            yield _pairs_of(
                trie, words[part], ids[part], counts[part], prefixes[part].flatten()
            )
            low = high


def _pairs_of(trie, words, ids, counts, prefixes: pa.Array) -> pa.RecordBatch:
    forward = prefixes.to_numpy(zero_copy_only=False)
    backward = np.array([x for word in words for x in reversed(trie.nodes(word))], np.int64)
    letters = np.frombuffer(b"".join(word[::-1] + b"\0" for word in words), np.uint8)
    length = np.array([len(word) for word in words])
    word_of = np.repeat(np.arange(len(words)), length + 1)
    inner = letters != 0  # places that hold a character; the last of each word holds none
    first = inner.copy()
    first[1:] &= letters[1:] != letters[:-1]
    place = np.flatnonzero(inner)
    kind = np.where(first[place], FIRST_SKIP, SKIP)
    whose = np.concatenate([word_of, word_of[place]])
    return pa.record_batch(
        [
            pa.array(np.concatenate([forward, forward[place]])),
            pa.array(np.concatenate([backward, backward[place + 1]])),
            pa.array(np.concatenate([np.full(len(forward), WHOLE), kind]).astype(np.int8)),
            pa.array(ids.to_numpy()[whose]),
            pa.array(counts.to_numpy()[whose]),
        ],
        names=["prefix", "suffix", "kind", "id", "n"],
    )


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per word and pair that it shares: how many near words it has there, and the best of them.

    A deleted character that stands among equal ones gives the same shorter word at each of their
    places; it counts at the first.
    """
    rest = None
    for batch in batches:
        rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if rest is not None:
            rows = [np.concatenate(pair) for pair in zip(rest, rows)]
        if not len(rows[0]):
            continue
        prefix, suffix = rows[:2]
        last = (prefix == prefix[-1]) & (suffix == suffix[-1])
        begin = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
        rest = [c[begin:].copy() for c in rows]
        yield from _met([c[:begin] for c in rows])
    if rest is not None:
        yield from _met(rest)


def _met(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    prefix, suffix, kind, ids, counts = rows
    if len(prefix) < 2:
        return
    fresh = np.ones(len(prefix), bool)
    fresh[1:] = (prefix[1:] != prefix[:-1]) | (suffix[1:] != suffix[:-1])
    start = np.flatnonzero(fresh)
    size = np.diff(np.append(start, len(prefix)))
    chosen = np.repeat(size > 1, size)
    if not chosen.any():
        return
    size = size[size > 1]
    group = np.repeat(np.arange(len(size)), size)
    kind, ids, counts = kind[chosen], ids[chosen], counts[chosen]
    order = np.lexsort((ids, -counts, group))  # best of each group first
    kind, ids, counts = kind[order], ids[order], counts[order]
    start = np.concatenate([[0], np.cumsum(size)[:-1]])
    top, second = start[group], start[group] + 1
    best = np.where(np.arange(len(ids)) == top, second, top)
    whole = np.add.reduceat(kind == WHOLE, start, dtype=np.int64)[group]
    firsts = np.add.reduceat(kind == FIRST_SKIP, start, dtype=np.int64)[group]
    replaced = size[group] - whole - 1
    near = np.where(kind == WHOLE, firsts, replaced + np.where(kind == FIRST_SKIP, whole, 0))
    yield pa.record_batch(
        [pa.array(c) for c in (ids, near.astype(np.int64), counts[best], ids[best])],
        names=["id", "near", "best_n", "best"],
    )
