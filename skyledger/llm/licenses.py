"""License scan by a positional index of rare words.

Templates are license notices with key phrases that must stand in them. Their words are indexed with
their positions. How rare a word is comes from its document frequency over all scanned documents. In
each file, the highest-IDF license words that it has are looked up for every template whose key
phrases it has the words of. A posting tells where the template would have to begin; places on which
the postings of several rare words agree, up to a few words inserted or left out, are held against the
whole template, and the key phrases must stand there in order.

The base phrases are counted at every place where they stand word for word: each is looked up by its
rarest word.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.words import ALNUM, Texts, Words, slices, texts_of, words_of
from skyledger.llm.workers import released


GAP = 3  # words that may be inserted or missing on either side of a rare word
RARE = 4  # license words of a file that are looked up for a template


class Template(NamedTuple):
    """`base` templates are phrases counted wherever they stand. Others give their label where all
    key `phrases` stand in order, with GAP words between theirs at most and none of `without` among
    them, and `least` of the IDF weight of `text` agrees."""

    label: str
    phrases: tuple[str, ...]
    text: str
    base: bool = False
    least: float = 0.6
    without: tuple[str, ...] = ()


_GNU = ("lesser", "library", "affero")
_GNU_NOTICE = (
    "is free software you can redistribute it and or modify it under the terms of the gnu {} "
    "as published by the free software foundation either version {} of the license or at your option "
    "any later version"
)

#: The base phrases, and notices as the licenses themselves word them.
TEMPLATES = (
    Template("mit", ("under the mit license",), "under the mit license", True),
    Template("apache-2", ("apache license version 2",), "apache license version 2", True),
    Template("cc-by-nc", ("cc by nc",), "cc by nc", True),
    Template("mit", ("permission is hereby granted free of charge",),
             "permission is hereby granted free of charge to any person obtaining a copy of this "
             "software and associated documentation files the software to deal in the software "
             "without restriction including without limitation the rights to use copy modify merge "
             "publish distribute sublicense and or sell copies of the software"),
    Template("apache-2", ("apache license version 2 0",),
             "licensed under the apache license version 2 0 the license you may not use this file "
             "except in compliance with the license", least=0.2),
    Template("gpl-3", ("gnu general public license", "version 3 of the license"),
             "this program " + _GNU_NOTICE.format("general public license", "3"), without=_GNU),
    Template("gpl-2", ("gnu general public license", "version 2 of the license"),
             "this program " + _GNU_NOTICE.format("general public license", "2"), without=_GNU),
    Template("gpl-3", ("gnu general public license version 3",),
             "this work is licensed under the gnu general public license version 3", without=_GNU),
    Template("gpl-2", ("gnu general public license version 2",),
             "this work is licensed under the gnu general public license version 2", without=_GNU),
    Template("lgpl", ("gnu lesser general public license",),
             "this library " + _GNU_NOTICE.format("lesser general public license", "2 1"),
             least=0.4),
    Template("agpl-3", ("gnu affero general public license",),
             "this program " + _GNU_NOTICE.format("affero general public license", "3"), least=0.4),
    Template("bsd", ("redistribution and use in source and binary forms",),
             "redistribution and use in source and binary forms with or without modification are "
             "permitted provided that the following conditions are met"),
    Template("mpl-2", ("mozilla public license",),
             "subject to the terms of the mozilla public license v 2 0", least=0.4),
    Template("isc", ("permission to use copy modify and or distribute this software",),
             "permission to use copy modify and or distribute this software for any purpose with "
             "or without fee is hereby granted"),
    Template("unlicense", ("free and unencumbered software released into the public domain",),
             "this is free and unencumbered software released into the public domain"),
    Template("cc-by-sa", ("cc by sa",), "licensed under cc by sa 4 0", least=0.4),
    Template("cc-by-nc", ("creative commons attribution noncommercial",),
             "licensed under the creative commons attribution noncommercial 4 0 international "
             "license", least=0.4),
    Template("cc-by", ("creative commons attribution 4 0",),
             "licensed under the creative commons attribution 4 0 international license",
             least=0.4, without=("noncommercial", "sharealike", "noderivatives")),
    Template("all-rights-reserved", ("all rights reserved",), "all rights reserved"),
)


def _values(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    return words_of(Texts(data, np.array([0, len(data)])), ALNUM).value


def vocabulary(templates: Sequence[Template]) -> np.ndarray:
    """Sorted word fingerprints of all templates."""
    texts = [t for x in templates for t in (x.text, *x.without)]
    return np.unique(np.concatenate([_values(t) for t in texts]))


def document_frequencies(
    docs: DataFrame, templates: Sequence[Template] = TEMPLATES
) -> tuple[int, dict[int, int]]:
    """Number of rows, and in how many of them each template word stands; all rows count.

    The result has one entry per word of the templates, whatever the number of documents.
    """
    known = vocabulary(templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count = np.zeros(len(known) + 1, np.int64)  # the last entry counts rows
            for i, j, part in slices(texts_of(batch.column(0))):
                words = words_of(part, ALNUM)
                at, place = _lookup(words, known)
                owner = np.searchsorted(words.first, place, "right") - 1
                pairs = np.unique(owner * len(known) + at)
                count[:-1] += np.bincount(pairs % len(known), minlength=len(known))
                count[-1] += j - i
            yield pa.record_batch(
                [pa.array(np.arange(len(known) + 1)), pa.array(count)], names=["word", "n"]
            )

    each = docs.select("text").mapInArrow(released(run), "word long, n long")
    found = {r["word"]: r["n"] for r in each.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    return found.get(len(known), 0), {k: found.get(k, 0) for k in range(len(known))}


def _lookup(words: Words, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number in `known`, word position) of each word that is in the sorted `known`."""
    # Sixteen bits of a fingerprint sort out nearly all other words before the exact search.
    table = np.zeros(1 << 16, bool)
    table[(known >> np.uint64(48)).astype(np.int64)] = True
    place = np.flatnonzero(table[(words.value >> np.uint64(48)).astype(np.int64)])
    at = np.minimum(np.searchsorted(known, words.value[place]), len(known) - 1)
    hit = known[at] == words.value[place]
    return at[hit], place[hit]


class Index:
    """Templates as word fingerprints with their positions, and how rare each word is."""

    def __init__(self, templates: Sequence[Template], n_docs: int, frequency: dict[int, int]):
        self.known = vocabulary(templates)
        idf = {
            int(value): math.log((n_docs + 1) / (frequency.get(k, 0) + 1)) + 1e-6
            for k, value in enumerate(self.known)
        }
        self.base = [t for t in templates if t.base]
        self.base_phrases = [_values(t.phrases[0]) for t in self.base]
        postings: dict[int, list[tuple[int, int]]] = {}
        for k, phrase in enumerate(self.base_phrases):
            rarest = max(range(len(phrase)), key=lambda i: (idf[int(phrase[i])], -i))
            postings.setdefault(int(phrase[rarest]), []).append((k, rarest))
        self.base_postings = postings
        self.notices = [Notice(t, idf) for t in templates if not t.base]

    def base_places(self, words: Words) -> list[np.ndarray]:
        """Per base template: the words where its phrase begins."""
        anchors = np.array(sorted(self.base_postings), np.uint64)
        out: list[list] = [[np.empty(0, np.int64)] for _ in self.base]
        if not len(anchors):
            return [x[0] for x in out]
        at, place = _lookup(words, anchors)
        owner = np.searchsorted(words.first, place, "right") - 1
        for number, anchor in enumerate(anchors):
            chosen = at == number
            for k, position in self.base_postings[int(anchor)] if chosen.any() else ():
                begin = place[chosen] - position
                low, high = words.first[owner[chosen]], words.first[owner[chosen] + 1]
                where = begin[:, None] + np.arange(len(self.base_phrases[k]))
                inside = (where >= low[:, None]) & (where < high[:, None])
                value = words.value[np.clip(where, 0, len(words.value) - 1)]
                whole = (inside & (value == self.base_phrases[k])).all(axis=1)
                out[k].append(begin[whole])
        return [np.concatenate(x) for x in out]

    def notices_in(self, words: Words) -> Iterator[tuple[int, Template, float]]:
        """(text, template, share of its weight) of each notice that a text holds."""
        at, place = _lookup(words, self.known)
        owner = np.searchsorted(words.first, place, "right") - 1
        begin = np.searchsorted(owner, np.arange(len(words.first)))
        for text in np.unique(owner).tolist():
            part = slice(begin[text], begin[text + 1])
            low, high = int(words.first[text]), int(words.first[text + 1])
            present = set(self.known[np.unique(at[part])].tolist())
            possible = [n for n in self.notices if n.required <= present]
            wanted = {value for n in possible for value in n.required}
            places: dict[int, list[int]] = {}
            for number, word in zip(at[part].tolist(), (place[part] - low).tolist()) if wanted else ():
                if (value := int(self.known[number])) in wanted:
                    places.setdefault(value, []).append(word)
            for notice in possible:
                share = notice.best(places, words.value[low:high])
                if share is not None:
                    yield text, notice.template, share


class Notice:
    """One template: postings of its words, weights, and where its key phrases stand in it."""

    def __init__(self, template: Template, idf: dict[int, float]):
        self.template = template
        self.values = _values(template.text).tolist()
        self.weights = [idf[v] for v in self.values]
        self.idf = {v: idf[v] for v in self.values}
        phrases = [_values(p) for p in template.phrases]
        text = _values(template.text)
        starts = [_find(text, p) for p in phrases]
        self.phrases = [range(a, a + len(p)) for a, p in zip(starts, phrases)]
        self.required = {int(v) for p in phrases for v in p}
        self.without = {int(v) for word in template.without for v in _values(word)}
        self.postings: dict[int, list[int]] = {}
        for position, value in enumerate(self.values):
            self.postings.setdefault(value, []).append(position)

    def best(self, places: dict[int, list[int]], words: np.ndarray) -> float | None:
        """Best share of the weight found at one place that has all key phrases, if one has `least`."""
        # Of the rarest words that the file has, each tells where the template would begin.
        rare = sorted(self.required, key=lambda v: (-self.idf[v], v))[:RARE]
        begins = [
            sorted({word - position for word in places[v] for position in self.postings[v]})
            for v in rare
        ]
        best, tried = None, None
        for begin in begins[0]:
            if not all(_near(others, begin) for others in begins[1:]) or begin == tried:
                continue
            tried = begin
            for position in self.postings[rare[0]]:
                at = begin + position
                if 0 <= at < len(words) and int(words[at]) == rare[0]:
                    share = self._share(words, at, position)
                    if share is not None and (best is None or share > best):
                        best = share
            if best is not None and best > 0.999:
                break
        return best

    def _share(self, words: np.ndarray, at: int, position: int) -> float | None:
        found = {position: at}
        for step, stop in ((1, len(self.values)), (-1, -1)):
            last = at
            for j in range(position + step, stop, step):
                # From the last word found on, at most GAP off the place that the rare word tells.
                expected = at + j - position
                low, high = max(0, expected - GAP), min(len(words) - 1, expected + GAP)
                inside = range(max(low, last + 1), high + 1) if step > 0 else range(
                    min(high, last - 1), low - 1, -1
                )
                hit = next((i for i in inside if int(words[i]) == self.values[j]), None)
                if hit is not None:
                    found[j] = last = hit
        for phrase in self.phrases:
            if not all(j in found for j in phrase):
                return None
            inside = words[found[phrase[0]] : found[phrase[-1]] + 1]
            if len(inside) > len(phrase) + GAP or self.without & set(inside.tolist()):
                return None
        share = sum(self.weights[j] for j in found) / sum(self.weights)
        return share if share >= self.template.least else None


def _near(sorted_begins: list[int], begin: int) -> bool:
    at = bisect_left(sorted_begins, begin - 2 * GAP)
    return at < len(sorted_begins) and sorted_begins[at] <= begin + 2 * GAP


def _find(values: np.ndarray, phrase: np.ndarray) -> int:
    for k in range(len(values) - len(phrase) + 1):
        if (values[k : k + len(phrase)] == phrase).all():
            return k
    raise ValueError("a template's text must hold its phrase")


def scan(docs: DataFrame, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) per row.

    n_base counts all places of base phrases, first_word and last_word are the least and greatest
    word where one begins (NULL without any). `labels` are those of the base phrases and of every
    other template found; both are distinct, sorted and joined by commas, '' without any. `score` is
    1 with a base phrase, else the best share of a template's weight found, 0 to 1. NULL and empty texts have no
    words. Other columns are ignored; repeated rows give repeated results.
    """
    index = Index(templates, *document_frequencies(docs, templates))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for i, j, part in slices(texts_of(batch.column(1))):
                yield _scanned(index, ids.slice(i, j - i), words_of(part, ALNUM))

    schema = (
        "doc_id long, n_words long, n_base long, first_word long, last_word long, "
        "base_labels string, labels string, score double"
    )
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(released(run), schema)


def _scanned(index: Index, ids: pa.Array, words: Words) -> pa.RecordBatch:
    n = len(ids)
    base, labels = [set() for _ in range(n)], [set() for _ in range(n)]
    n_base = np.zeros(n, np.int64)
    first, last, score = [None] * n, [None] * n, np.zeros(n)
    for template, place in zip(index.base, index.base_places(words)):
        owner = np.searchsorted(words.first, place, "right") - 1
        for text, word in zip(owner.tolist(), (place - words.first[owner]).tolist()):
            n_base[text] += 1
            base[text].add(template.label)
            labels[text].add(template.label)
            first[text] = word if first[text] is None else min(first[text], word)
            last[text] = word if last[text] is None else max(last[text], word)
            score[text] = 1.0
    for text, template, share in index.notices_in(words):
        labels[text].add(template.label)
        score[text] = max(score[text], min(share, 1.0))
    return pa.record_batch(
        [ids, pa.array(np.diff(words.first), pa.int64()), pa.array(n_base),
         pa.array(first, pa.int64()), pa.array(last, pa.int64()),
         pa.array([",".join(sorted(x)) for x in base], pa.string()),
         pa.array([",".join(sorted(x)) for x in labels], pa.string()), pa.array(score)],
        names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels",
               "score"],
    )
