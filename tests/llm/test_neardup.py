import random
import re
from itertools import combinations
from math import comb

import pytest
from pyspark.sql import functions as F

from skyledger.llm import neardup
from skyledger.llm.components import components
from tests.llm.samples import awkward, frame, prose


def brute(rows, size, percent):
    sets, nodes = {}, {}
    for doc_id, text in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", lower)
        grams = {tuple(words[k : k + size]) for k in range(max(len(words) - size + 1, 1))}
        sets.setdefault(doc_id, []).append(grams if words else set())
    top = {i: i for i in sets}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in combinations([i for i in sets if i is not None], 2):
        for x in sets[a]:
            for y in sets[b]:
                if x and y and 100 * len(x & y) >= percent * len(x | y):
                    low, high = sorted((root(a), root(b)))
                    top[high] = low
    nodes = {i: root(i) for i in sets}
    place = {i: 0 for i in sets}
    out = []
    for doc_id, _ in rows:
        grams = sets[doc_id][place[doc_id]]
        place[doc_id] += 1
        out.append((doc_id, len(grams), nodes[doc_id], doc_id == nodes[doc_id]))
    return sorted(out, key=str)


def edited(text, seed, edits):
    rng, words = random.Random(seed), text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


def family(n):
    """Copies, near copies around the limit, and chains of them."""
    base = prose(5, 150, 5000)
    rows = [(100 + k, edited(base, k, k % 9)) for k in range(n)]
    chain = base
    for k in range(12):
        chain = edited(chain, 900 + k, 4)
        rows.append((500 + k, chain))
    return rows + [(700 + k, base) for k in range(5)] + [(40 - k, prose(50 + k, 90)) for k in range(9)]


@pytest.mark.parametrize("size", [4, 5])
def test_groups_equal_brute_force(spark, size):
    rows = awkward() + family(60)
    found = neardup.near_duplicates(frame(spark, rows), shingle_words=size)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(rows, size, 80)


def test_blocks_of_a_mixed_bucket_find_the_same(spark, monkeypatch):
    rows = family(60)
    monkeypatch.setattr(neardup, "BLOCK_DOCS", 8)
    found = neardup.near_duplicates(frame(spark, rows))
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(rows, 5, 80)


def test_second_texts_of_an_id_do_not_disturb_a_mixed_bucket(spark):
    rows = family(60)
    rows += [(i, prose(3000 + i, 60, 5000)) for i in sorted({i for i, _ in rows})]
    found = neardup.near_duplicates(frame(spark, rows))
    assert sorted(((r[0], r[2]) for r in found.collect())) == sorted(
        (i, top) for i, _, top, _ in brute(rows, 5, 80)
    )


def test_links_at_a_low_percent_are_found(spark):
    rows = []
    for k in range(80):
        common = prose(5000 + k, 104, 10**6)
        rows += [(2 * k + q, f"{common} {prose(9000 + 2 * k + q, 50, 10**6)}") for q in (0, 1)]
    found = neardup.near_duplicates(frame(spark, rows), percent=50)
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(rows, 5, 50)
    assert sum(not r[-1] for r in brute(rows, 5, 50)) == 80


def test_bounds_follow_the_percent():
    assert [neardup.band_rows(p) for p in (100, 80, 79, 50, 13)] == [4, 4, 2, 2, 1]
    for percent in (0, 12, 101):
        with pytest.raises(ValueError):
            neardup.band_rows(percent)
    for percent in (50, 80):
        s, t = percent / 100, neardup.least_equal(percent)
        tail = [sum(comb(128, k) * s**k * (1 - s) ** (128 - k) for k in range(n)) for n in (t, t + 1)]
        assert tail[0] <= neardup.MISS < tail[1]


def test_keep_one_keeps_all_columns_and_one_row_per_group(spark):
    rows = awkward() + family(20)
    docs = frame(spark, rows)
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    expected = {i for i, _, _, good in brute(rows, 5, 80) if good and i is not None}
    assert sorted(i for i in ids if i is not None) == sorted(expected)
    assert ids.count(None) == 2


def test_empty_table(spark):
    assert neardup.near_duplicates(frame(spark, awkward()).limit(0)).isEmpty()


def test_components_of_a_long_path_and_a_star(spark):
    path = [(k + 1, k) for k in range(1000, 1200)]
    star = [(5000 + k, 4999) for k in range(300)]
    edges = spark.createDataFrame(path + star + [(7, 9), (9, 8)], "a LONG, b LONG")
    found = {r["id"]: r["component"] for r in components(edges.repartition(4)).collect()}
    assert {found[k] for k in range(1000, 1201)} == {1000}
    assert {found[k] for k in range(4999, 5300)} == {4999}
    assert (found[7], found[8], found[9]) == (7, 7, 7)
    assert components(edges.filter(F.lit(False))).isEmpty()
