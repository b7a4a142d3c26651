"""Removal of sentences that lie in a span which stands elsewhere before.

A text is cut into sentences: at a line end, and after a word that ends in . ! or ? (closing quotes
and brackets may follow). A sentence of LONG words or more is cut every PIECE words, so that a long
passage without full stops has several too. A span is `size` consecutive sentences, lengthened until
it has `min_words` words; where the last sentences before a given end are too few words, the span
that ends there is lengthened to the front as well, so the edges of a passage are covered.

Sentences and their pieces are counted from their own start, so a passage that begins or ends inside
one may share none of them with its other place. Therefore the words are cut a second time without
regard to sentences, lines or offsets: before every word whose hash is the least of some WINDOW
words in a row. Wherever the same WINDOW words stand, they give the same cut, and cuts are WINDOW
words apart at most. From each cut to the first one `min_words` or more behind it goes a span too.
So a passage of 42 words or more shares such spans at any offset, and of its words at most 7 in
front and 15 behind are outside of them.

Every span is hashed and all spans of all documents meet by hash. A span's first place is in the
least doc_id that holds it, and there its first place in the text. The words of every other place
are removed. Of a sentence of fewer than LONG words that is only covered in part that part stays,
unless half of the passage could stay with it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.words import SPACED, Texts, mix, prefix_values, slices, texts_of, words_of
from skyledger.llm.workers import released, unused
from skyledger.operators.lookup import lookup
from skyledger.session import staged

SIZE = 2
MIN_WORDS = 20
LONG, PIECE = 24, 12
WINDOW = 8
#: Words of a passage that may lie outside its spans from cut to cut.
EDGES = 3 * WINDOW - 2
_ENDS = np.isin(np.arange(256), list(b".!?"))
_CLOSERS = np.isin(np.arange(256), list(b"\"')]"))


class Sentences:
    """Sentences of some texts: first word, text, and where their bytes begin."""

    def __init__(self, texts: Texts):
        words = words_of(texts, SPACED)
        self.words, self.texts = words, texts
        n = len(words.value)
        self.owner = owner = np.searchsorted(texts.offsets, words.start, "right") - 1
        opens = np.ones(n, bool)
        if n:
            data = texts.data
            last = data[words.end - 1]
            before = data[np.maximum(words.end - 2, words.start)]
            stop = _ENDS[last] | (_CLOSERS[last] & _ENDS[before])
            breaks = np.concatenate([[0], np.cumsum(data == ord("\n"))])
            line = breaks[words.start[1:]] > breaks[words.end[:-1]]
            opens[1:] = stop[:-1] | line | (owner[1:] != owner[:-1])
        begin = np.flatnonzero(opens)
        #: First word of each whole sentence.
        self.whole = begin
        length = np.diff(np.append(begin, n))
        within = np.arange(n) - np.repeat(begin, length)
        pieces = np.repeat(np.where(length >= LONG, length // PIECE, 1), length)
        opens |= (within % PIECE == 0) & (within // PIECE < pieces)
        self.first = np.flatnonzero(opens)
        self.of = owner[self.first]
        #: Sentence number of each text's first sentence; one more entry at the end.
        self.text_first = np.searchsorted(self.of, np.arange(len(texts) + 1))

    def __len__(self) -> int:
        return len(self.first)

    def spans(self, size: int, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first word, word after the last, hash) of every span; one place may come twice."""
        n = len(self)
        if not n:
            empty = np.empty(0, np.int64)
            return empty, empty, empty.astype(np.uint64)
        edge = np.append(self.first, len(self.words.value))  # word where each sentence begins
        low, high = self.text_first[self.of], self.text_first[self.of + 1]
        here = np.arange(n)
        end = np.maximum(here + size, np.searchsorted(edge, edge[here] + min_words))
        a, b = here[end <= high], end[end <= high]
        start = np.minimum(
            here + 1 - size, np.searchsorted(edge, edge[here + 1] - min_words, "right") - 1
        )
        back = start >= low
        c, d = start[back], here[back] + 1
        extra = end[c] != d
        a, b = np.concatenate([a, c[extra]]), np.concatenate([b, d[extra]])
        cuts = self.cuts()
        here = np.arange(len(cuts))
        end = np.maximum(here + size, np.searchsorted(cuts, cuts + min_words))
        inside = end < len(cuts)
        inside[inside] = self.owner[cuts[end[inside]]] == self.owner[cuts[inside]]
        x = np.concatenate([edge[a], cuts[inside]])
        y = np.concatenate([edge[b], cuts[end[inside]]])
        total, down = prefix_values(self.words.value)
        return x, y, mix((total[y] - total[x]) * down[x] + (y - x).astype(np.uint64))

    def cuts(self) -> np.ndarray:
        """Every word that is the first of the least ones in some WINDOW words of its text."""
        value, owner = self.words.value, self.owner
        n = len(value)
        reach = np.ones(n, np.int64)  # words around it of which it is the first of the least
        for step, beats in ((-1, np.less), (1, np.less_equal)):
            open_ = np.ones(n, bool)
            for k in range(1, min(WINDOW, n)):
                here, there = (slice(k, n), slice(0, n - k))[::-step]
                open_[here] &= (owner[here] == owner[there]) & beats(value[here], value[there])
                open_[n - k if step > 0 else 0 : n if step > 0 else k] = False
                reach += open_
        return np.flatnonzero(reach >= WINDOW)

    def removed(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Marks of the words of some spans, without parts of short sentences that may stay."""
        n = len(self.words.value)
        marks = np.zeros(n + 1, np.int64)
        np.add.at(marks, first, 1)
        np.add.at(marks, end, -1)
        gone = np.cumsum(marks)[:-1] > 0
        if not gone.any():
            return gone
        sums = np.concatenate([[0], np.cumsum(gone)])
        bounds = np.append(self.whole, n)
        length = np.diff(bounds)
        part = np.repeat((length < LONG) & (np.diff(sums[bounds]) < length), length) & gone
        turns = np.ones(n, bool)
        turns[1:] = (gone[1:] != gone[:-1]) | (self.owner[1:] != self.owner[:-1])
        begin = np.flatnonzero(turns)
        size = np.diff(np.append(begin, n))
        stay = 2 * np.add.reduceat(part.astype(np.int64), begin) + EDGES <= size
        return gone & ~(part & np.repeat(stay, size))

    def text_without(self, removed: np.ndarray) -> list[bytes]:
        """Each text without the marked words; white space goes with the word before."""
        out, data = [], self.texts.data
        bounds = self.words.first
        for k in range(len(self.texts)):
            low, high = self.texts.offsets[k], self.texts.offsets[k + 1]
            i, j = bounds[k], bounds[k + 1]
            gone = removed[i:j]
            if not gone.any():
                out.append(data[low:high].tobytes())
                continue
            turns = np.concatenate([[0], np.flatnonzero(gone[1:] != gone[:-1]) + 1])
            cuts = np.concatenate([[low], self.words.start[i + turns[1:]], [high]])
            keep = np.flatnonzero(~gone[turns])
            out.append(b"".join(data[cuts[q] : cuts[q + 1]].tobytes() for q in keep))
        return out


def removals(docs: DataFrame, size: int = SIZE, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, hashes): per document, the spans that a document with a smaller id has too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for i, j, part in slices(texts_of(batch.column(1))):
                sentences = Sentences(part)
                first, _, value = sentences.spans(size, min_words)
                owner = sentences.owner[first]
                order = np.lexsort((value, owner))
                value, owner = value[order], owner[order]
                new = np.ones(len(value), bool)
                new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
                yield pa.record_batch(
                    [pa.array(value[new].view(np.int64)), pa.array(ids[i:j][owner[new]])],
                    names=["span", "doc_id"],
                )

    rows = docs.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("long"), "text")
    spans = staged(rows.mapInArrow(released(run), "span long, doc_id long"))
    counts = spans.groupBy("span").agg(
        F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("top"), F.count(F.lit(1)).alias("_n")
    )
    repeated = staged(counts.filter("first_doc < top").select("span", "first_doc", "_n"))
    later = lookup(
        spans, repeated.select("span", "first_doc"), ["span"], ["doc_id"],
        counts=repeated.select("span", "_n"),
    ).filter("doc_id != first_doc")
    # A document has no more spans than three times its words.
    return later.groupBy("doc_id").agg(F.collect_set("span").alias("hashes"))


def without_repeats(
    docs: DataFrame, size: int = SIZE, min_words: int = MIN_WORDS, with_counts: bool = False
) -> DataFrame:
    """`docs` with repeated spans cut out of `text`; all other columns as they are.

    NULL texts stay NULL; a text that consists of repeats becomes empty. Rows with equal doc_id are
    one document, and no span of theirs counts as repeated between them; rows without doc_id lose
    only what repeats inside their own text. `with_counts` adds n_sentences and n_removed, the
    sentences (or pieces) of which no word is left, in the place of columns that have these names.
    """
    if with_counts:
        docs = docs.drop("n_sentences", "n_removed")
    own, own_id = unused(docs, "repeated_spans"), unused(docs, "repeated_spans_of")
    gone = removals(docs, size, min_words).select(
        F.col("doc_id").alias(own_id), F.col("hashes").alias(own)
    )
    joined = docs.join(gone, F.col("doc_id").cast("long") == F.col(own_id), "left").drop(own_id)
    at, extra = docs.columns.index("text"), ["n_sentences", "n_removed"] if with_counts else []
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, hashes = batch.column(at), batch.column(len(names))
            texts, total, cut = [], [], []
            for i, j, part in slices(texts_of(column)):
                sentences = Sentences(part)
                first, end, value = sentences.spans(size, min_words)
                owner = sentences.owner[first]
                # Inside a text, every place of a span but the first.
                order = np.lexsort((first, value, owner))
                again = np.zeros(len(value), bool)
                same = (value[order][1:] == value[order][:-1]) & (
                    owner[order][1:] == owner[order][:-1]
                )
                same &= first[order][1:] != first[order][:-1]
                again[order[1:][same]] = True
                by_text = np.argsort(owner, kind="stable")
                bounds = np.searchsorted(owner[by_text], np.arange(j - i + 1))
                for k in range(j - i):
                    if not hashes[i + k].is_valid:
                        continue
                    own = by_text[bounds[k] : bounds[k + 1]]
                    listed = hashes[i + k].values.to_numpy().view(np.uint64)
                    again[own] |= np.isin(value[own], listed)
                removed = sentences.removed(first[again], end[again])
                texts += sentences.text_without(removed)
                kept = np.concatenate([[0], np.cumsum(~removed)])
                left = np.diff(kept[np.append(sentences.first, len(removed))])
                sums = np.concatenate([[0], np.cumsum(left == 0)])
                total.append(np.diff(sentences.text_first))
                cut.append(np.diff(sums[sentences.text_first]))
            new = pa.array(texts, pa.binary()).cast(pa.string())
            if column.null_count:
                new = pa.array([t if v.is_valid else None for t, v in zip(new.to_pylist(), column)])
            out = [*(batch.column(c) for c in range(len(names)))]
            out[at] = new
            if extra:
                none = [np.empty(0, np.int64)]
                out += [pa.array(np.concatenate(x or none), pa.int64()) for x in (total, cut)]
            yield pa.record_batch(out, names=[*names, *extra])

    schema = docs.schema
    for name in extra:
        schema = schema.add(name, "long")
    return joined.mapInArrow(released(run), schema)
