"""Quality rules as a short-circuit cascade.

A rule rejects a text by a few counts over it. The rules run in the order of rejections per second
of cost, both measured on a sample of the documents; a text that a rule rejects costs nothing in
the rules after it. The verdict is that of all rules together, so the order never changes it.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.words import (
    ALNUM,
    SPACED_CASED,
    Texts,
    Words,
    mix,
    prefix_values,
    shingles_of,
    slices,
    subset,
    texts_of,
    words_of,
)
from skyledger.llm.workers import released

WINDOW = 5
SAMPLE_DOCS = 2000  # expected size of the sample that orders the rules
SYMBOLS = b"#*$%&|<>"


class Counts:
    """Counts over some texts, each made when it is first asked for."""

    def __init__(self, texts: Texts):
        self.texts = texts
        self._made: dict[str, np.ndarray] = {}
        self._words: Words | None = None

    def __getitem__(self, name: str) -> np.ndarray:
        if name not in self._made:
            self._made[name] = _COUNTERS[name](self)
        return self._made[name]

    @property
    def words(self) -> Words:
        if self._words is None:
            self._words = words_of(self.texts, SPACED_CASED)
        return self._words

    def per_text(self, marks: np.ndarray) -> np.ndarray:
        """Number of marked bytes in each text."""
        total = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
        return np.diff(total[self.texts.offsets])

    def only(self, chosen: np.ndarray) -> Counts:
        """Counts over the chosen texts; what is already known is kept."""
        part = Counts(subset(self.texts, chosen))
        part._made = {name: values[chosen] for name, values in self._made.items()}
        return part


def _word_chars(c: Counts) -> np.ndarray:
    """Code points in words: their bytes without UTF-8 continuation bytes."""
    data = c.texts.data
    return c.per_text(SPACED_CASED.inside[data] & ((data & 0xC0) != 0x80))


def _marked(chars: bytes) -> Callable[[Counts], np.ndarray]:
    table = np.zeros(256, bool)
    table[np.frombuffer(chars, np.uint8)] = True
    return lambda c: c.per_text(table[c.texts.data])


def _lines(c: Counts) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprint and text of each line that has a word."""
    data, offsets = c.texts
    breaks = np.flatnonzero(data == ord("\n"))
    start = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    start = start[start < len(data)]
    end = np.minimum(np.append(start[1:], len(data)), len(data))
    owner = np.searchsorted(offsets, start, "right") - 1
    inside = np.concatenate([[0], np.cumsum(SPACED_CASED.inside[data], dtype=np.int64)])
    has_word = inside[end] > inside[start]
    start, end, owner = start[has_word], end[has_word], owner[has_word]
    end = end - (data[end - 1] == ord("\n"))
    total, down = prefix_values(SPACED_CASED.values[data])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64)), owner


def _n_lines(c: Counts) -> np.ndarray:
    return np.bincount(_lines(c)[1], minlength=len(c.texts))


def _n_dup_lines(c: Counts) -> np.ndarray:
    value, owner = _lines(c)
    _, at = np.unique(mix(value + owner.astype(np.uint64)), return_index=True)
    size = len(c.texts)
    return np.bincount(owner, minlength=size) - np.bincount(owner[at], minlength=size)


def _n_repeat_words(c: Counts) -> np.ndarray:
    """Words in windows of WINDOW words that occur twice or more in the text."""
    words = c.words
    value, owner = shingles_of(words, WINDOW)
    key = mix(value + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    repeated = np.zeros(len(key), bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    per_text = np.bincount(owner, minlength=len(c.texts))
    first = np.concatenate([[0], np.cumsum(per_text)])
    begin = words.first[:-1][owner] + np.arange(len(owner)) - first[owner]
    change = np.zeros(len(words.value) + WINDOW + 1, np.int64)
    change[: len(words.value)] += np.bincount(begin[repeated], minlength=len(words.value))
    change[WINDOW:] -= change[:-WINDOW].copy()
    covered = np.concatenate([[0], np.cumsum(np.cumsum(change)[: len(words.value)] > 0)])
    return np.diff(covered[words.first])


def _n_plain_ends(c: Counts) -> np.ndarray:
    """Words that end in a letter, a digit, a non-ASCII sign or an ordinary stop."""
    plain = ALNUM.inside.copy()
    plain[np.frombuffer(b".,;:?", np.uint8)] = True
    good = plain[c.texts.data[c.words.end - 1]] if len(c.words.end) else np.empty(0, bool)
    return np.diff(np.concatenate([[0], np.cumsum(good)])[c.words.first])


def _n_distinct(c: Counts) -> np.ndarray:
    size = len(c.texts)
    owner = np.repeat(np.arange(size), np.diff(c.words.first))
    _, at = np.unique(mix(c.words.value + owner.astype(np.uint64)), return_index=True)
    return np.bincount(owner[at], minlength=size)


_COUNTERS: dict[str, Callable[[Counts], np.ndarray]] = {
    "n_words": lambda c: np.diff(c.words.first),
    "word_chars": _word_chars,
    "n_symbols": _marked(SYMBOLS),
    "n_shouts": _marked(b"!"),
    "n_stops": _marked(b".?"),
    "n_capitals": _marked(bytes(range(ord("A"), ord("Z") + 1))),
    "n_distinct": _n_distinct,
    "n_plain_ends": _n_plain_ends,
    "n_alnum": lambda c: c.per_text(
        ALNUM.inside[c.texts.data] & ((c.texts.data & 0xC0) != 0x80)
    ),
    "n_lines": _n_lines,
    "n_dup_lines": _n_dup_lines,
    "n_repeat_words": _n_repeat_words,
}


class Rule(NamedTuple):
    name: str
    rejects: Callable[[Counts], np.ndarray]


RULES = (
    Rule("few_words", lambda c: c["n_words"] < 10),
    Rule("repeated_words", lambda c: 100 * c["n_repeat_words"] > 20 * c["n_words"]),
    Rule("symbols", lambda c: 10 * c["n_symbols"] > 3 * c["n_words"]),
    Rule("shouting", lambda c: 10 * c["n_shouts"] > 3 * c["n_words"]),
    Rule("repeated_lines", lambda c: 10 * c["n_dup_lines"] > 3 * c["n_lines"]),
    Rule("long_words", lambda c: c["word_chars"] > 25 * c["n_words"]),
)
BASE = ("few_words", "repeated_words")


def cascade(texts: Texts, rules: Sequence[Rule], counts: Counts | None = None) -> np.ndarray:
    """Which texts no rule rejects; each rule sees only what the rules before it left."""
    kept = np.arange(len(texts))
    counts = counts or Counts(texts)
    for rule in rules:
        good = ~rule.rejects(counts)
        if not good.all():
            kept = kept[good]
            counts = counts.only(np.flatnonzero(good))
        if not len(kept):
            break
    out = np.zeros(len(texts), bool)
    out[kept] = True
    return out


def measured(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(name, seconds, rejected, n_docs) of every rule over all rows of `docs`, each on its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, part in slices(texts_of(batch.column(0))):
                rows = []
                for rule in rules:
                    began = time.perf_counter()
                    rejected = int(rule.rejects(Counts(part)).sum())
                    rows.append((rule.name, time.perf_counter() - began, rejected, j - i))
                columns = ("name", "seconds", "rejected", "n_docs")
                yield pa.record_batch([pa.array(c) for c in zip(*rows)], names=list(columns))

    schema = "name string, seconds double, rejected long, n_docs long"
    each = docs.select("text").mapInArrow(released(run), schema)
    return each.groupBy("name").agg(
        F.sum("seconds").alias("seconds"),
        F.sum("rejected").alias("rejected"),
        F.sum("n_docs").alias("n_docs"),
    )


def ordered(
    docs: DataFrame, rules: Sequence[Rule] = RULES, sample_docs: int = SAMPLE_DOCS
) -> list[Rule]:
    """The rules by rejections per second on a sample; without one, in the order given."""
    n = docs.count()
    if not n:
        return list(rules)
    sample = docs.sample(fraction=min(1.0, sample_docs / n), seed=9)
    worth = {r["name"]: r["rejected"] / max(r["seconds"], 1e-9) for r in measured(sample, rules).collect()}
    return sorted(rules, key=lambda rule: -worth.get(rule.name, 0.0))


def keep_good(
    docs: DataFrame, rules: Sequence[Rule] = RULES, sample_docs: int = SAMPLE_DOCS
) -> DataFrame:
    """The rows of `docs` that no rule rejects, with all their columns.

    NULL and empty texts have no words and are rejected as too short. Other columns may be NULL or
    have any name but are passed on untouched; repeated rows are judged alike.
    """
    order, at = ordered(docs, rules, sample_docs), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [cascade(part, order) for _, _, part in slices(texts_of(batch.column(at)))]
            yield batch.filter(pa.array(np.concatenate(kept) if kept else np.empty(0, bool)))

    return docs.mapInArrow(released(run), docs.schema)


def judged(
    docs: DataFrame, rules: Sequence[Rule] = RULES, sample_docs: int = SAMPLE_DOCS
) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept).

    One row per row of `docs`. The counts are made for every text; the verdict is the cascade's,
    which takes the counts that it needs from them. NULL and empty texts have counts of 0 and fail;
    repeated rows are judged alike; columns other than doc_id and text are ignored.
    """
    order = ordered(docs, rules, sample_docs)
    base = [rule for rule in rules if rule.name in BASE]
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for i, j, part in slices(texts_of(batch.column(1))):
                counts = Counts(part)
                columns = [pa.array(counts[name], pa.int64()) for name in names]
                failed = np.any([rule.rejects(counts) for rule in base], axis=0)
                kept = cascade(part, order, counts)
                yield pa.record_batch(
                    [ids.slice(i, j - i), *columns, pa.array(failed), pa.array(kept)],
                    names=["doc_id", *names, "base_failed", "kept"],
                )

    fields = "".join(f"{name} long, " for name in names)
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(released(run), f"doc_id long, {fields}base_failed boolean, kept boolean")
