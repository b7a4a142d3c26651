"""How the sources of a language differ in the words that they use.

Term frequencies come from single-pass in-memory indexing: a task builds a block of postings until
its memory is full, sorts it by term and hands it on as a run, cut into the hash shards of the terms.
The runs of a shard are then merged with a heap into frequencies. Divergences between two sources
start from the sums over their own terms alone; the terms that both have are streamed once more and
correct them. All arithmetic is exact, in integers.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.workers import released
from skyledger.session import staged

BLOCK_POSTINGS = 300_000  # postings that a task holds before it hands a run on
CHUNK = 2048  # postings of a run that reach the merge at once
MERGE_POSTINGS = 100_000  # postings that a merge takes in before it adds up what is complete
OUT_ROWS = 50_000
SCALE = 1_000_000_000

_TERMS = bytearray(b" " * 256)
for _byte in range(256):
    if 65 <= _byte <= 90:
        _TERMS[_byte] = _byte + 32
    elif 97 <= _byte <= 122 or _byte >= 128:
        _TERMS[_byte] = _byte
_TERMS = bytes(_TERMS)

_RUN = (
    "shard int, lang string, first string, terms array<string>, sources array<string>, "
    "n array<long>, docs array<long>"
)
_FREQUENCY = "lang string, term string, source string, n long, total long, head boolean"


def _named(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])


def frequencies(docs: DataFrame, min_docs: int = 3, shards: int | None = None) -> DataFrame:
    """(lang, term, source, n, total, head): occurrences of each term per source that has it.

    `docs` has lang, source and text; NULL counts as the empty text in each. Terms are matches of
    `[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+` with A-Z in lower case. A language keeps those that stand
    in at least `min_docs` of its rows (repeated rows count each time). `total` is the sum of `n` over
    the sources; `head` marks one row per term. Other columns are ignored.

    Runs go to `shards` hash shards, by default as many as the session has shuffle partitions. A task
    of the merge holds one chunk of each run at a time, and MERGE_POSTINGS besides.
    """
    shards = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = _named(docs).mapInArrow(released(partial(_runs, shards)), _RUN)
    in_order = runs.repartitionById(shards, "shard").sortWithinPartitions("shard", "lang", "first")
    return in_order.mapInArrow(released(partial(_merged, min_docs)), _FREQUENCY)


def _runs(shards: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block: dict[tuple[str, str], tuple[Counter[bytes], Counter[bytes]]] = {}
    held = 0
    for batch in batches:
        for lang, source, text in zip(*(c.to_pylist() for c in batch.columns)):
            words = text.encode().translate(_TERMS).split(b" ")
            counts, docs = block.setdefault((lang, source), (Counter(), Counter()))
            held -= len(counts)
            counts.update(words)
            docs.update(set(words))
            counts.pop(b"", None)
            held += len(counts)
            if held > BLOCK_POSTINGS:
                yield from _run(block, shards)
                block.clear()
                held = 0
    yield from _run(block, shards)


def _run(block: dict, shards: int) -> Iterator[pa.RecordBatch]:
    """One block as chunks, each of one shard and language, in the order of the terms."""
    by_lang: dict[str, list[str]] = {}
    for lang, source in block:
        by_lang.setdefault(lang, []).append(source)
    for lang, sources in by_lang.items():
        sources.sort()
        groups = [block[lang, source] for source in sources]
        sizes = [len(counts) for counts, _ in groups]
        if not sum(sizes):
            continue
        coded = pa.array([t for counts, _ in groups for t in counts], pa.binary()).dictionary_encode()
        terms, code = coded.dictionary, coded.indices.to_numpy()
        rank = np.empty(len(terms), np.int64)
        rank[pc.sort_indices(terms).to_numpy()] = np.arange(len(terms))
        seed = zlib.crc32(lang.encode() + b"\0")
        shard = np.array([zlib.crc32(term, seed) % shards for term in terms.to_pylist()])[code]
        source = np.repeat(np.arange(len(sources)), sizes)
        order = np.lexsort((source, rank[code], shard))
        n = np.array([n for counts, _ in groups for n in counts.values()], np.int64)
        docs = np.array([docs[term] for counts, docs in groups for term in counts], np.int64)
        shard, names = shard[order], terms.take(pa.array(code[order])).cast(pa.string())
        ends = np.append(np.flatnonzero(np.diff(shard)) + 1, len(shard))
        cuts = [0]
        for end in ends.tolist():
            cuts += [*range(cuts[-1] + CHUNK, end, CHUNK), end]
        begin = np.array(cuts[:-1])
        columns = (names, pa.array(sources).take(pa.array(source[order])), n[order], docs[order])
        lists = [
            pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(c)) for c in columns
        ]
        yield pa.record_batch(
            [pa.array(shard[begin].astype(np.int32)), pa.array([lang] * len(begin)),
             names.take(pa.array(begin)), *lists],
            names=["shard", "lang", "first", "terms", "sources", "n", "docs"],
        )


class _Merge:
    """Heap of the open chunks of a shard, ordered by the next term of each.

    Chunks arrive by their first term, so all terms before the latest first one are complete. They
    are taken from the chunks in slices, and equal ones are added up together.
    """

    def __init__(self, min_docs: int):
        self.min_docs = min_docs
        self.heap: list[tuple[str, int, pa.Table]] = []
        self.serial = self.held = 0

    def add(self, first: str, chunk: pa.Table) -> None:
        self.serial += 1
        heapq.heappush(self.heap, (first, self.serial, chunk))
        self.held += len(chunk)

    def before(self, lang: str, bound: str | None) -> Iterator[pa.RecordBatch]:
        """Frequencies of the terms before `bound`, or of all."""
        slices = []
        while self.heap and (bound is None or self.heap[0][0] < bound):
            _, number, chunk = heapq.heappop(self.heap)
            cut = len(chunk) if bound is None else _below(chunk["term"], bound)
            slices.append(chunk.slice(0, cut))
            if cut < len(chunk):
                rest = chunk.slice(cut)
                heapq.heappush(self.heap, (rest["term"][0].as_py(), number, rest))
            self.held -= cut
        if slices:
            yield from self._summed(lang, pa.concat_tables(slices))

    def _summed(self, lang: str, postings: pa.Table) -> Iterator[pa.RecordBatch]:
        sums = postings.group_by(["term", "source"]).aggregate([("n", "sum"), ("docs", "sum")])
        code = sums["term"].combine_chunks().dictionary_encode().indices.to_numpy()
        order = np.argsort(code, kind="stable")  # postings of a term together
        code = code[order]
        head = np.append(True, np.diff(code) != 0)
        start = np.flatnonzero(head)
        n, docs = (sums[c].to_numpy()[order] for c in ("n_sum", "docs_sum"))
        total = np.add.reduceat(n, start)[np.cumsum(head) - 1]
        kept = np.add.reduceat(docs, start)[np.cumsum(head) - 1] >= self.min_docs
        if not kept.any():
            return
        chosen = pa.array(order[kept])
        columns = [
            pa.array([lang] * len(chosen)), sums["term"].take(chosen).combine_chunks(),
            sums["source"].take(chosen).combine_chunks(), pa.array(n[kept]), pa.array(total[kept]),
            pa.array(head[kept]),
        ]
        yield pa.record_batch(columns, names=["lang", "term", "source", "n", "total", "head"])


def _below(terms: pa.ChunkedArray, bound: str) -> int:
    """How many of some sorted terms come before `bound`."""
    return bisect_left(range(len(terms)), bound, key=lambda k: terms[k].as_py())


def _merged(min_docs: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Heap-merge of all chunks of a shard, which arrive by their first term."""
    merge, here = _Merge(min_docs), None
    for batch in batches:
        shards, langs, firsts, *lists = batch.columns
        for k in range(len(batch)):
            place, first = (shards[k].as_py(), langs[k].as_py()), firsts[k].as_py()
            if place != here:
                if here is not None:
                    yield from merge.before(here[1], None)
                here = place
            elif merge.held >= MERGE_POSTINGS:
                yield from merge.before(here[1], first)
            columns = [values[k].values for values in lists]
            merge.add(first, pa.table(columns, names=["term", "source", "n", "docs"]))
    if here is not None:
        yield from merge.before(here[1], None)


def _part(count: Column | str, of: Column) -> Column:
    """1 + floor(SCALE * count / of); decimals, as the product may leave 64 bits."""
    scaled = F.lit(SCALE).cast("decimal(10,0)") * F.col(count).cast("decimal(19,0)")
    share = F.call_function("div", scaled, of.cast("decimal(20,0)"))
    return F.lit(1).cast("long") + share


def _gap(p: str, q: str) -> Column:
    """floor((p - q)**2 / q), which fits 64 bits as p is at most SCALE + 1."""
    apart = F.col(p) - F.col(q)
    return F.call_function("div", apart * apart, F.col(q))


def audit(docs: DataFrame, min_docs: int = 3, top: int = 200) -> DataFrame:
    """(lang, source, part, item, value, rank) for each language and source of `docs`.

    Frequencies as in `frequencies`; V terms are kept in a language and N are all their occurrences
    in one of its sources. A term has the share p = 1 + floor(10**9 * (count + 1) / (N + V)) there,
    and the divergence of shares p from q is floor((p - q)**2 / q).

    - Part `pair`: each other source of the language, the divergence from it summed over all kept
      terms (0 where the language has none); all ranks.
    - Part `term`: the source's own terms with a larger share than in the whole language, the
      divergence from that; the first `top` ranks.

    Ranks go by value downwards, then by item. Every (lang, source) of `docs` counts, also without
    terms; NULL is the empty text. An empty table gives an empty result. The result has a row for
    each two sources of a language, and the work on a term grows with the pairs of its sources.
    """
    found = staged(frequencies(docs, min_docs))
    groups = _named(docs).select("lang", "source").distinct()
    sizes = found.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    langs = found.groupBy("lang").agg(
        F.sum("n").alias("lang_size"), F.count_if("head").alias("terms")
    )
    none = F.lit(0).cast("long")
    sources = groups.join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
    sources = sources.select(
        "lang",
        "source",
        *[F.coalesce(c, none).alias(c) for c in ("size", "lang_size", "terms")],
        F.lit(1).alias("one"),
    )
    of = F.greatest(F.col("size") + F.col("terms"), F.lit(1))
    # Written out: what follows reads it several times, and its size is known to the planner.
    sources = staged(sources.withColumn("p0", _part("one", of)).drop("one"))
    shares = found.join(sources, ["lang", "source"]).withColumns(
        {"more": F.col("n") + 1, "lang_more": F.col("total") + 1}
    )
    shares = shares.select(
        "lang",
        "term",
        "source",
        "n",
        "p0",
        _part("more", of).alias("p"),
        _part("lang_more", F.col("lang_size") + F.col("terms")).alias("q"),
    )
    terms = shares.filter("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        _gap("p", "q").alias("value"),
    )
    pairs = _pairs(shares, sources).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value"
    )
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(best)
    return pairs.withColumn("rank", rank).union(
        terms.withColumn("rank", rank).filter(F.col("rank") <= top)
    )


def _pairs(shares: DataFrame, sources: DataFrame) -> DataFrame:
    """(lang, source, item, value) of each two sources of a language.

    A term that only one of them has depends on its count there alone, so these are summed over the
    distinct counts of a source. That also takes in the terms that both have; `_corrections` mends it.
    """
    other = sources.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    apart = F.col("source") != F.col("item")
    plain = sources.join(other, "lang").filter(apart)
    plain = plain.select("lang", "source", "item", (F.col("terms") * _gap("p0", "q0")).alias("value"))
    levels = shares.groupBy("lang", "source", "p", "p0").agg(F.count(F.lit(1)).alias("times"))
    own = levels.join(other, "lang").filter(apart)
    there = F.col("times") * (_gap("p", "q0") - _gap("p0", "q0"))
    back = F.col("times") * (_gap("q0", "p") - _gap("q0", "p0"))
    own = own.select(
        "lang",
        F.inline(
            F.array(
                F.struct("source", "item", there.alias("value")),
                F.struct(
                    F.col("item").alias("source"),
                    F.col("source").alias("item"),
                    back.alias("value"),
                ),
            )
        ),
    )
    # Stored in the order of the terms as it is, but read anew in other splits.
    by_term = shares.select("lang", "term", "source", "p", "p0").repartition("lang", "term")
    mended = by_term.sortWithinPartitions("lang", "term").mapInArrow(
        released(_corrections), "lang string, source string, item string, value long"
    )
    summed = plain.unionByName(own).unionByName(mended)
    return summed.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _corrections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each two sources that share a term: what the term adds in both less what each adds alone."""
    names: dict[tuple[str, str], int] = {}
    total: dict[int, int] = {}
    rest = None
    for batch in batches:
        rows = rest.to_batches() + [batch] if rest is not None else [batch]
        table = pa.Table.from_batches(rows).combine_chunks()
        same = table["term"].to_numpy() == table["term"][-1].as_py() if len(table) else np.array([])
        same &= table["lang"].to_numpy() == table["lang"][-1].as_py() if len(table) else same
        begin = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        _correct(table.slice(0, begin), names, total)
        rest = table.slice(begin)
        if len(total) > OUT_ROWS:
            yield _correction_rows(names, total)
            total.clear()
    if rest is not None:
        _correct(rest, names, total)
    yield _correction_rows(names, total)


def _correct(table: pa.Table, names: dict, total: dict) -> None:
    if len(table) < 2:
        return
    columns = [c.combine_chunks().dictionary_encode() for c in (table["lang"], table["source"])]
    lang, source = (c.indices.to_numpy() for c in columns)
    width = len(columns[1].dictionary)
    both, local = np.unique(lang * width + source, return_inverse=True)
    label = [
        names.setdefault((columns[0].dictionary[k // width].as_py(), columns[1].dictionary[k % width].as_py()), len(names))
        for k in both.tolist()
    ]
    who = np.array(label, np.int64)[local]
    terms = table["term"].to_numpy()
    fresh = np.ones(len(who), bool)
    fresh[1:] = (terms[1:] != terms[:-1]) | (lang[1:] != lang[:-1])
    term = np.cumsum(fresh)
    p, p0 = table["p"].to_numpy(), table["p0"].to_numpy()
    for step in range(1, len(who)):
        a = np.flatnonzero(term[step:] == term[:-step])
        if not len(a):
            break
        b = a + step
        for x, y in ((a, b), (b, a)):
            value = gap(p[x], p[y]) - gap(p[x], p0[y]) - gap(p0[x], p[y]) + gap(p0[x], p0[y])
            code = who[x] << 32 | who[y]
            order = np.argsort(code, kind="stable")
            start = np.flatnonzero(np.append(True, np.diff(code[order]) != 0))
            sums = np.add.reduceat(value[order], start)
            for key, part in zip(code[order][start].tolist(), sums.tolist()):
                total[key] = total.get(key, 0) + part


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _correction_rows(names: dict, total: dict) -> pa.RecordBatch:
    groups = list(names)
    pairs = [(groups[key >> 32], groups[key & 0xFFFFFFFF]) for key in total]
    return pa.record_batch(
        [
            pa.array([a[0] for a, _ in pairs], pa.string()),
            pa.array([a[1] for a, _ in pairs], pa.string()),
            pa.array([b[1] for _, b in pairs], pa.string()),
            pa.array(list(total.values()), pa.int64()),
        ],
        names=["lang", "source", "item", "value"],
    )
