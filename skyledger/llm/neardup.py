"""Near-duplicate groups by SuperMinHash signatures, banding, verification and union-find.

1. Each text becomes the set of its distinct shingles, a signature and one key per band.
2. Rows with the same set are linked to the least doc_id among them; that one stands for all.
3. In each bucket (equal band key) every member is compared with the bucket's least doc_id on the
   full sets. This is linear in the bucket and settles most of them.
4. Buckets that still hold several components are searched in blocks: members meet in cells of two
   blocks, pairs that cannot reach the similarity by their signatures are skipped, the others are
   compared on the full sets inside the task, and only links that join something are returned.
5. Components of all links give the groups.

No step returns all pairs of a bucket, and no task holds more than two blocks of one bucket.
Rows of a band and the pre-check follow from `percent`: a link at that similarity shares no bucket
with probability MISS at most (0.8: (1 - 0.8^4)^32 < 5e-8), and is skipped with MISS at most.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.components import components
from skyledger.llm.superminhash import SIZE, band_keys, signatures
from skyledger.llm.words import SPACED, Texts, shingles_of, slices, texts_of, words_of
from skyledger.llm.workers import released, unused
from skyledger.operators.lookup import lookup
from skyledger.session import staged

SHINGLE_WORDS = 5
PERCENT = 80
BAND_ROWS = 4
BLOCK_SHINGLES = 1 << 20  # of a block's sets together; a cell holds two blocks
BLOCK_DOCS = 2048
MISS = 5e-8


def band_rows(percent: int) -> int:
    """Registers in a band, BAND_ROWS or fewer, so that a link is missed with MISS at most."""
    rows, s = BAND_ROWS, percent / 100
    while rows and (1 - s**rows) ** (SIZE // rows) > MISS:
        rows //= 2
    if not rows or not 0 < percent <= 100:
        raise ValueError(f"{SIZE} registers do not find links of {percent} percent")
    return rows


def least_equal(percent: int) -> int:
    """Pairs whose signatures agree in fewer registers are not compared; by the binomial tail a link
    has fewer with probability MISS at most."""
    s, below, t = percent / 100, 0.0, 0
    while t < SIZE and (below := below + comb(SIZE, t) * s**t * (1 - s) ** (SIZE - t)) <= MISS:
        t += 1
    return t


def near_duplicates(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of `docs` (doc_id, text, ...).

    A text with fewer words than a shingle has one shingle of them all. Texts that are NULL or
    without words have no shingle and are linked with nothing, and so are rows without doc_id
    (component NULL, kept). Rows with equal doc_id are one node of the graph: they share their
    component, and repeated rows give repeated results. Other columns of `docs` are ignored.
    """
    sketch, grouped = _groups(docs, shingle_words, percent)
    return (
        sketch.select("doc_id", "n_shingles")
        .join(grouped.withColumnRenamed("id", "doc_id"), "doc_id", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.coalesce("component", "doc_id").alias("component_id"),
            F.col("doc_id").eqNullSafe(F.coalesce("component", "doc_id")).alias("kept"),
        )
    )


def keep_one(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT
) -> DataFrame:
    """The rows of `docs` whose doc_id is the least of its group, with all their columns.

    Of several rows with that doc_id the one with the least text hash stays, of equal texts the one
    whose other columns have the least hash (all but maps and variants). Rows without doc_id stay,
    and so do texts without words. Columns may have any names.
    """
    _, grouped = _groups(docs, shingle_words, percent)
    own = unused(docs, "near_duplicate")
    gone = grouped.filter("id != component").select(F.col("id").alias(own))
    named = docs.filter("doc_id IS NOT NULL")
    left = named.join(gone, F.col("doc_id").cast("long") == F.col(own), "left_anti")
    hashed = [
        f"`{f.name}`" for f in docs.schema if not re.search("map<|variant", f.dataType.simpleString())
    ]
    order = (F.xxhash64("text"), F.xxhash64(*hashed))
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy(*order))
    one = left.withColumn(own, place).filter(F.col(own) == 1).drop(own)
    return one.union(docs.filter("doc_id IS NULL"))


def _groups(docs: DataFrame, shingle_words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Sketch of each row, and (id, component) of all documents that are linked."""
    rows = band_rows(percent)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketch = staged(
        docs.mapInArrow(
            released(_sketches(shingle_words, rows)),
            "doc_id long, n_shingles long, digest binary, bands array<long>",
        )
    )
    linkable = sketch.filter("doc_id IS NOT NULL AND n_shingles > 0")
    same = linkable.groupBy("digest").agg(
        F.min("doc_id").alias("hub"), F.count(F.lit(1)).alias("_n")
    )
    copies = lookup(
        linkable.select("digest", "doc_id"),
        same.filter("_n > 1").select("digest", "hub"),
        ["digest"],
        ["doc_id"],
        counts=same.select("digest", "_n"),
    ).filter("doc_id != hub")
    copy_links = copies.select(F.col("doc_id").alias("a"), F.col("hub").alias("b"))

    heads = linkable.join(
        same.select("digest", F.col("hub").alias("doc_id")), ["digest", "doc_id"], "left_semi"
    )
    members = heads.select("doc_id", F.explode("bands").alias("band"))
    buckets = members.groupBy("band").agg(
        F.min("doc_id").alias("hub"), F.max("doc_id").alias("top"), F.count(F.lit(1)).alias("_n")
    )
    shared = buckets.filter("hub < top")
    in_buckets = staged(
        lookup(
            members,
            shared.select("band", "hub", F.col("_n").alias("size")),
            ["band"],
            ["doc_id"],
            counts=buckets.select("band", "_n"),
        ).distinct()
    )
    spokes = in_buckets.filter("doc_id != hub").select("hub", "doc_id").distinct()
    wanted = in_buckets.select("doc_id").distinct()
    sets = staged(
        docs.join(wanted, "doc_id", "left_semi").mapInArrow(
            released(_full_sets(shingle_words, rows)),
            "doc_id long, shingles binary, signature binary, keys binary",
        )
    )
    links = staged(_verified(spokes, sets, percent).union(copy_links))
    settled = components(links)
    open_links = _search_blocks(in_buckets, settled, sets, percent)
    return sketch, components(links.union(open_links))


def _verified(spokes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) among the pairs hub, doc_id, by their full sets."""
    leaf = sets.select("doc_id", F.col("shingles").alias("left_set"))
    hub = sets.select(F.col("doc_id").alias("hub"), F.col("shingles").alias("right_set"))
    per_hub = spokes.groupBy("hub").agg(F.count(F.lit(1)).alias("_n"))
    both = lookup(spokes.join(leaf, "doc_id"), hub, ["hub"], ["doc_id"], counts=per_hub)
    return both.select("doc_id", "hub", "left_set", "right_set").mapInArrow(
        released(_compare(percent)), "a long, b long"
    )


def _search_blocks(
    in_buckets: DataFrame, settled: DataFrame, sets: DataFrame, percent: int
) -> DataFrame:
    """Further links inside buckets that hold more than one component."""
    sizes = sets.groupBy("doc_id").agg(F.sum(F.length("shingles") / F.lit(8)).alias("n"))
    placed = (
        in_buckets.filter("size > 2 AND doc_id != hub")  # the least member has met all others
        .join(settled.withColumnRenamed("id", "doc_id"), "doc_id", "left")
        .join(sizes, "doc_id")
    )
    rest = placed.select(
        "band", "doc_id", F.coalesce("component", "doc_id").alias("component"), "n"
    )
    mixed = (
        rest.groupBy("band")
        .agg(
            F.min("component").alias("low"),
            F.max("component").alias("high"),
            F.sum("n").alias("shingles"),
            F.count(F.lit(1)).alias("_n"),
        )
        .filter("low < high")
    )
    needed = F.greatest(F.col("shingles") / BLOCK_SHINGLES, F.col("_n") / BLOCK_DOCS)
    per_band = mixed.select("band", F.ceil(needed).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")
    cells = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.struct(
            F.least("own", other).alias("i"), F.greatest("own", other).alias("j")
        ),
    )
    dealt = (
        lookup(rest, per_band, ["band"], ["doc_id"], counts=mixed.select("band", "_n"))
        .withColumn("own", own)
        .select("band", "doc_id", "component", "own", F.explode(cells).alias("cell"))
        .select("band", "doc_id", "component", "own", "cell.i", "cell.j")
    )
    full = dealt.join(sets, "doc_id")
    return full.groupBy("band", "i", "j").applyInArrow(_cell_search(percent), "a long, b long")


def _sketches(size: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), texts_of(batch.column(1))
            for i, j, part in slices(texts):
                sets, elements, owner = _sets(part, size)
                keys = band_keys(signatures(elements, owner, j - i), rows)
                digests = [_digest(s) if len(s) else None for s in sets]
                bands = pa.ListArray.from_arrays(
                    pa.array(np.arange(j - i + 1, dtype=np.int32) * keys.shape[1]),
                    pa.array(keys.ravel().view(np.int64)),
                )
                yield pa.record_batch(
                    [ids.slice(i, j - i), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(digests, pa.binary()), bands],
                    names=["doc_id", "n_shingles", "digest", "bands"],
                )

    return run


def _full_sets(size: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), texts_of(batch.column(1))
            for i, j, part in slices(texts):
                sets, elements, owner = _sets(part, size)
                full = signatures(elements, owner, j - i)
                short = (full >> np.uint64(41)).astype(np.uint16)
                keys = band_keys(full, rows)
                yield pa.record_batch(
                    [ids.slice(i, j - i), pa.array([s.tobytes() for s in sets], pa.binary()),
                     pa.array([row.tobytes() for row in short], pa.binary()),
                     pa.array([row.tobytes() for row in keys], pa.binary())],
                    names=["doc_id", "shingles", "signature", "keys"],
                )

    return run


def _sets(texts: Texts, size: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Sorted distinct shingles per text; the same in one array, with the text of each."""
    shingles, owner = shingles_of(words_of(texts, SPACED), size)
    ends = np.cumsum(np.bincount(owner, minlength=len(texts)))
    sets = [np.unique(shingles[a:b]) for a, b in zip(np.concatenate([[0], ends]), ends)]
    elements = np.concatenate(sets) if sets else shingles
    return sets, elements, np.repeat(np.arange(len(sets)), [len(s) for s in sets])


def _digest(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def _linked(common: int, left: int, right: int, percent: int) -> bool:
    return 100 * common >= percent * (left + right - common)


def _compare(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(2), batch.column(3)
            good = np.zeros(len(left), bool)
            for k in range(len(left)):
                x = np.frombuffer(left[k].as_buffer(), np.uint64)
                y = np.frombuffer(right[k].as_buffer(), np.uint64)
                good[k] = _linked(
                    len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y), percent
                )
            yield pa.record_batch(
                [batch.column(c).filter(pa.array(good)) for c in (0, 1)], names=["a", "b"]
            )

    return run


def _cell_search(percent: int):
    """Links inside a cell. A pair is compared in the first band that it shares: whatever bucket
    it met in before held both, so it was searched too or had one of them as its least member."""
    least = least_equal(percent)

    def run(table: pa.Table) -> pa.Table:
        ids = table["doc_id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        i, j = table["i"][0].as_py(), table["j"][0].as_py()
        keys = np.stack(_rows(table["keys"], order, np.int64))
        # Of several texts with one doc_id only those of this bucket: the others are in their own.
        here = keys == table["band"][0].as_py()
        inside = here.any(axis=1)
        band = int(here[inside.argmax()].argmax())
        keys, order = keys[inside], order[inside]
        ids = ids[order]
        group, own = (table[c].to_numpy()[order] for c in ("component", "own"))
        marks = np.stack(_rows(table["signature"], order, np.uint16))
        sets = _rows(table["shingles"], order, np.uint64)
        sizes = np.array([len(s) for s in sets])
        # Shingles as dense numbers, so that membership is one look into a table.
        distinct, number = np.unique(np.concatenate(sets), return_inverse=True)
        numbers = np.split(number, np.cumsum(sizes)[:-1])
        held = np.zeros(len(distinct), bool)
        found: list[tuple[int, int]] = []
        for x in range(len(ids) - 1):
            later = np.arange(x + 1, len(ids))
            later = later[group[later] != group[x]]
            if i != j:  # pairs inside one block meet in that block's own cell
                later = later[own[later] != own[x]]
            low, high = np.minimum(sizes[later], sizes[x]), np.maximum(sizes[later], sizes[x])
            later = later[100 * low >= percent * high]
            later = later[~(keys[later, :band] == keys[x, :band]).any(axis=1)]
            later = later[(marks[later] == marks[x]).sum(axis=1) >= least]
            if not len(later):
                continue
            held[numbers[x]] = True
            hits = held[np.concatenate([numbers[y] for y in later])]
            held[numbers[x]] = False
            begin = np.concatenate([[0], np.cumsum(sizes[later])[:-1]])
            common = np.add.reduceat(hits, begin, dtype=np.int64)
            for y in later[100 * common >= percent * (sizes[x] + sizes[later] - common)]:
                if group[x] != group[y]:
                    found.append((int(ids[y]), int(ids[x])))
                    group[group == group[y]] = group[x]
        pa.default_memory_pool().release_unused()
        return pa.table(
            {"a": pa.array([a for a, _ in found], pa.int64()),
             "b": pa.array([b for _, b in found], pa.int64())}
        )

    return run


def _rows(column: pa.ChunkedArray, order: np.ndarray, kind: type) -> list[np.ndarray]:
    """Binary values as arrays, in the given order."""
    values = column.combine_chunks()
    return [np.frombuffer(values[int(k)].as_buffer(), kind) for k in order]
