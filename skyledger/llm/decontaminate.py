"""Benchmark passages in documents, with edits, by pigeonhole pieces and Myers' bit-parallel distance.

An item of L characters may differ in k = L * percent // 100 edits. It is split into k + 1 pieces, at
least one of which stands unchanged in any such passage. All pieces are searched at once
(Aho-Corasick). A piece hit is checked upwards: neighbouring pieces are joined two by two, and m
joined pieces must match within m - 1 edits, or some other hit accounts for the passage. The last
step compares the whole item. Texts and items are compared in lower case with single blanks.

The items are the query set: they reach the tasks in blocks of bounded size, one scan per block.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from skyledger.llm.workers import released
from skyledger.session import staged

ERROR_PERCENT = 8
BLOCK_CHARS = 4_000_000  # of item text in one scan


class Node:
    """Some joined pieces of an item: their place in it, and the node they are joined in."""

    __slots__ = ("begin", "end", "leaves", "up", "_masks")

    def __init__(self, begin: int, end: int, leaves: int):
        self.begin, self.end, self.leaves, self.up, self._masks = begin, end, leaves, None, None

    def masks(self, item: str) -> dict[str, int]:
        if self._masks is None:
            self._masks = {}
            for k, char in enumerate(item[self.begin : self.end]):
                self._masks[char] = self._masks.get(char, 0) | 1 << k
        return self._masks


def normal(text: str | None) -> str:
    """Lower case, words parted by one blank."""
    return " ".join((text or "").lower().split())


def piece_tree(length: int, errors: int) -> list[Node]:
    """`errors` + 1 pieces of nearly equal length, joined by pairs up to the whole."""
    n = errors + 1
    cuts = [k * length // n for k in range(n + 1)]
    leaves = [Node(a, b, 1) for a, b in zip(cuts, cuts[1:])]
    level = leaves
    while len(level) > 1:
        above = []
        for k in range(0, len(level), 2):
            pair = level[k : k + 2]
            if len(pair) == 1:
                above.append(pair[0])
                continue
            node = Node(pair[0].begin, pair[1].end, pair[0].leaves + pair[1].leaves)
            pair[0].up = pair[1].up = node
            above.append(node)
        level = above
    return leaves


def best_match(masks: dict[str, int], length: int, text: str) -> tuple[int, int]:
    """Least edit distance of a pattern to any part of `text`, and the first end of such a part.

    Myers 1999: one column of the table is two bit vectors, and each character a few operations.
    """
    full, top = (1 << length) - 1, 1 << (length - 1)
    plus, minus, score = full, 0, length
    best, at = length, 0
    for k, char in enumerate(text):
        equal = masks.get(char, 0)
        vertical = equal | minus
        diagonal = (((equal & plus) + plus) ^ plus) | equal
        up = minus | (full & ~(diagonal | plus))
        down = plus & diagonal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = (up << 1) & full
        down = (down << 1) & full
        plus = down | (full & ~(vertical | up))
        minus = up & vertical
        if score < best:
            best, at = score, k + 1
    return best, at


class Searcher:
    """All passages of some items in a text."""

    def __init__(self, items: list[tuple[int, str]], percent: int):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        owners: dict[str, list] = {}
        self.items = []
        for item_id, text in items:
            text = normal(text)
            if not text:
                continue
            errors = len(text) * percent // 100
            for leaf in piece_tree(len(text), errors):
                owners.setdefault(text[leaf.begin : leaf.end], []).append((len(self.items), leaf))
            self.items.append((item_id, text, errors))
        for piece, found in owners.items():
            self.automaton.add_word(piece, (len(piece), found))
        if owners:
            self.automaton.make_automaton()

    def __call__(self, text: str) -> dict[int, tuple[int, int]]:
        """Item id -> (least distance, first end of such a passage in the normal text)."""
        found: dict[int, tuple[int, int]] = {}
        if not self.items:
            return found
        done: set[tuple] = set()
        for last, (size, owners) in self.automaton.iter(text):
            for k, leaf in owners:
                origin = last + 1 - size - leaf.begin  # where the item would begin
                self._climb(text, k, leaf, origin, done, found)
        return found

    def _climb(self, text, k, node, origin, done, found) -> None:
        item_id, item, _ = self.items[k]
        hit = (0, origin + len(item))
        while node.up is not None:
            node = node.up
            slack = node.leaves - 1
            key = (k, node.begin, node.end, origin)
            if key in done:
                return
            done.add(key)
            low = max(0, origin + node.begin - slack)
            high = origin + node.end + slack
            distance, end = best_match(node.masks(item), node.end - node.begin, text[low:high])
            if distance > slack:
                return
            hit = (distance, low + end)
        found[item_id] = min(found.get(item_id, hit), hit)


@lru_cache(1)
def _searcher(items: tuple[tuple[int, str], ...], percent: int) -> Searcher:
    return Searcher(list(items), percent)


def leaks(docs: DataFrame, benchmark: DataFrame, percent: int = ERROR_PERCENT) -> DataFrame:
    """(doc_id, item_id, distance, end_char) for each document and item that it holds a passage of.

    `distance` is the least edit distance found and `end_char` where that passage ends in the normal
    text. Items and texts that are NULL or blank match nothing; items without item_id are left out.
    An item too short for an edit must stand there exactly. Repeated rows of either side give one
    result; rows without doc_id report NULL as their id. Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out, schema = None, "doc_id long, item_id long, distance int, end_char int"
    n, blocks = _blocks(benchmark)
    for block in blocks:
        found = rows.mapInArrow(released(_search(block, percent)), schema)
        # Of several blocks each is done with before the next is read.
        found = staged(found) if n > 1 else found
        out = found if out is None else out.union(found)
    first = F.min(F.struct("distance", "end_char")).alias("first")
    return out.groupBy("doc_id", "item_id").agg(first).select("doc_id", "item_id", "first.*")


def without_leaks(docs: DataFrame, benchmark: DataFrame, percent: int = ERROR_PERCENT) -> DataFrame:
    """The rows of `docs`, all columns, that hold no passage of any item."""
    at = docs.columns.index("text")
    n, blocks = _blocks(benchmark)
    for block in blocks:
        docs = docs.mapInArrow(released(_filter(block, percent, at)), docs.schema)
        docs = staged(docs) if n > 1 else docs
    return docs


def _blocks(benchmark: DataFrame) -> tuple[int, Iterator[tuple[tuple[int, str], ...]]]:
    """Number of blocks, and the distinct items block by block; one block at least.

    Items are dealt to blocks of about BLOCK_CHARS characters by a hash and written to the shared
    folder. Only the block that is asked for comes to the driver, to be sent to the tasks.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    items = items.filter("item_id IS NOT NULL AND text IS NOT NULL").distinct()
    chars = items.agg(F.sum(F.char_length("text").cast("long"))).first()[0] or 0
    n = -(-chars // BLOCK_CHARS) or 1
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    written = staged(items.withColumn("block", block).repartition("block"))

    def read() -> Iterator[tuple[tuple[int, str], ...]]:
        for k in range(n):
            rows = written.filter(F.col("block") == k).select("item_id", "text").collect()
            yield tuple(sorted((r["item_id"], r["text"]) for r in rows))

    return n, read()


def _search(items: tuple, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = _searcher(items, percent)
        for batch in batches:
            hits: list[tuple] = []
            for k in range(batch.num_rows):
                found = search(normal(batch.column(1)[k].as_py()))
                hits += [(k, item, *hit) for item, hit in found.items()]
            columns = list(zip(*hits)) or [(), (), (), ()]
            yield pa.record_batch(
                [batch.column(0).take(pa.array(columns[0], pa.int64())),
                 pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int32()),
                 pa.array(columns[3], pa.int32())],
                names=["doc_id", "item_id", "distance", "end_char"],
            )

    return run


def _filter(items: tuple, percent: int, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = _searcher(items, percent)
        for batch in batches:
            texts = batch.column(at)
            clean = [not search(normal(texts[k].as_py())) for k in range(batch.num_rows)]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return run
