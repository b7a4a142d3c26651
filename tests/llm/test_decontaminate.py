import random

import pytest

from skyledger.llm import decontaminate
from skyledger.llm.decontaminate import best_match, normal, piece_tree
from tests.llm.samples import awkward, frame, prose


def least_distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        last, row = row, [i]
        for j, t in enumerate(text, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (p != t)))
    return min(row)


def edit(text, edits, seed):
    rng, chars = random.Random(seed), list(text)
    for _ in range(edits):
        k = rng.randrange(len(chars))
        kind = rng.randrange(3)
        if kind == 0:
            chars[k] = rng.choice("abcxyz")
        elif kind == 1:
            chars.insert(k, rng.choice("abcxyz"))
        else:
            del chars[k]
    return "".join(chars)


def test_myers_equals_the_table():
    rng = random.Random(3)
    for _ in range(300):
        pattern = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 90)))
        text = "".join(rng.choice("abc") for _ in range(rng.randrange(0, 120)))
        node = piece_tree(len(pattern), 0)[0]
        distance, end = best_match(node.masks(pattern), len(pattern), text)
        assert distance == least_distance(pattern, text)
        if end:
            assert least_distance(pattern, text[:end]) == distance


@pytest.mark.parametrize("errors", range(0, 24))
def test_pieces_cover_the_item_and_budgets_add_up(errors):
    leaves = piece_tree(240, errors)
    assert len(leaves) == errors + 1
    assert [x.begin for x in leaves] + [240] == [0] + [x.end for x in leaves]
    for leaf in leaves:
        while leaf.up is not None:
            assert leaf.up.begin <= leaf.begin and leaf.end <= leaf.up.end
            leaf = leaf.up
        assert (leaf.begin, leaf.end, leaf.leaves) == (0, 240, errors + 1)


def items():
    return [(k, prose(300 + k, 20 + 3 * k, 5000)) for k in range(8)] + [
        (20, "tiny"), (21, None), (22, " "), (None, "left out"), (3, prose(303, 29, 5000)),
    ]


def documents():
    rng, rows = random.Random(8), []
    for k in range(70):
        item = prose(300 + k % 8, 20 + 3 * (k % 8), 5000)
        inside = edit(item, rng.randrange(0, len(item) // 8), k)
        rows.append((1000 + k, f"{prose(k, 30)} {inside} {prose(k + 500, 20)}"))
    rows += [(100, "a TINY one"), (101, f"x  {prose(302, 26, 5000).upper()}"), (102, prose(300, 20, 5000))]
    return rows + awkward()


def brute(rows, percent):
    found = set()
    for doc_id, text in rows:
        for item_id, item in items():
            if item_id is None or not normal(item):
                continue
            distance = least_distance(normal(item), normal(text)[:2000])
            if distance <= len(normal(item)) * percent // 100:
                found.add((doc_id, item_id, distance))
    return found


def test_leaks_equal_brute_force(spark, monkeypatch):
    benchmark = spark.createDataFrame(items(), "item_id LONG, text STRING")
    found = decontaminate.leaks(frame(spark, documents()), benchmark).collect()
    assert {(r["doc_id"], r["item_id"], r["distance"]) for r in found} == brute(documents(), 8)
    assert len(found) == len({(r["doc_id"], r["item_id"]) for r in found})
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 300)
    again = decontaminate.leaks(frame(spark, documents()), benchmark).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_without_leaks(spark):
    benchmark = spark.createDataFrame(items(), "item_id LONG, text STRING")
    docs = frame(spark, documents())
    clean = decontaminate.without_leaks(docs, benchmark)
    assert clean.columns == docs.columns
    leaked = {i for i, _, _ in brute(documents(), 8)}
    expected = sorted([i for i, _ in documents() if i not in leaked], key=str)
    assert sorted([r["doc_id"] for r in clean.collect()], key=str) == expected


def test_empty_tables(spark):
    benchmark = spark.createDataFrame(items(), "item_id LONG, text STRING")
    docs = frame(spark, documents())
    assert decontaminate.leaks(docs, benchmark.limit(0)).isEmpty()
    assert decontaminate.leaks(docs.limit(0), benchmark).isEmpty()
    assert decontaminate.without_leaks(docs, benchmark.limit(0)).count() == len(documents())
