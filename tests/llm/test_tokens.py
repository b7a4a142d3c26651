import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from skyledger.llm import packing, token_counts
from skyledger.llm.tokens import default_ranks, encoder
from tests.llm.samples import awkward, frame, prose

ODD = [
    "", " ", "  ", " \n", "a  b", "a \n b", "a\n\nb  ", "\n", "x 's it's 'S we'll 've", "a b \x85c",
    "日本 語 a", "é²½ 12 a1b2", "--- ##a b##", "tab\t\tq \t z", "<|endoftext|> x", "x <|endoftext|>",
    "<|endoftext|>", "a<|endoftext|><|endoftext|>b", "<|endoftext|><|endoftext|>", "é <|endoftext|> 日", "<|endoftext|",
    "|>", "<|endof", "text|> ", "it's <|endoftext|>'s", "  <|endoftext|>  ", "  lead", "trail  ",
    "\x1c \x00 a", "ǅ ʰ ɐ a", "a' b", "''s", "\r\n x", prose(4, 300),
]


@pytest.fixture(scope="module")
def exact():
    import public_tokenizers

    tokenizer = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_ids_equal_the_tokenizer(exact):
    encode = encoder(default_ranks())
    plain = [t for t in ODD if max(t, default=" ") < "\u0250" and "'" not in t]
    for texts in ([*ODD], [*reversed(ODD)], plain * 3, *([t] for t in ODD)):
        ids, at = encode(texts)
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [exact(t) for t in texts]


def test_histogram_and_suffix_sums(spark, exact):
    rows = awkward() + [(50 + k, t) for k, t in enumerate(ODD)]
    lengths = Counter(len(exact(t)) for _, t in rows)
    totals = token_counts.suffix_totals(token_counts.length_histogram(frame(spark, rows)))
    found = {r["n_tokens"]: r for r in totals.collect()}
    assert {k: r["n_docs"] for k, r in found.items()} == dict(lengths)
    every = list(lengths.elements())
    for limit, r in found.items():
        assert r["docs_at_least"] == sum(x >= limit for x in every)
        assert r["tokens_at_least"] == sum(x for x in every if x >= limit)
        assert r["truncated_total"] == sum(min(x, limit) for x in every)
        assert r["share"] == pytest.approx(sum(x <= limit for x in every) / len(every))
    for r in token_counts.at_limits(totals, [0, 1, 7, 1000, 10**6]).collect():
        assert r["docs_over"] == sum(x > r["context"] for x in every)
        assert r["truncated_total"] == sum(min(x, r["context"]) for x in every)
    for r in token_counts.quantiles(totals, [0.1, 0.5, 1.0]).collect():
        assert r["n_tokens"] == min(
            x for x in every if sum(y <= x for y in every) >= r["share"] * len(every) - 1e-9
        )


def test_histogram_of_nothing(spark):
    empty = token_counts.length_histogram(frame(spark, awkward()).limit(0))
    assert token_counts.suffix_totals(empty).isEmpty()


def check_packing(placed, pieces, capacity):
    by_sequence = {}
    for r in placed:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(x for _, x in parts[:k]) for k in range(len(parts))]
        assert sum(x for _, x in parts) <= capacity
    got = Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in placed)
    assert got == Counter(pieces)
    return len(by_sequence)


@pytest.mark.parametrize("capacity", [64, 2048])
def test_pack(spark, exact, capacity):
    rows = awkward() + [(50 + k, prose(k, 5 + k * 3)) for k in range(60)]
    pieces = []
    for doc_id, text in rows:
        ids, start, piece = [*exact(text), 0], 0, 0
        while start < len(ids):
            size = (len(ids) - start - 1) % capacity + 1 if piece == 0 else capacity
            part = np.array(ids[start : start + size], "<u4")
            pieces.append((doc_id, piece, start, size, zlib.crc32(part.tobytes())))
            start, piece = start + size, piece + 1
    placed = packing.pack(frame(spark, rows), capacity=capacity, with_ids=True)
    n = check_packing(placed.collect(), pieces, capacity)
    tokens = sum(p[3] for p in pieces)
    assert n <= tokens / capacity * 1.02 + 1
    whole = packing.sequences(placed).collect()
    assert sum(len(r["ids"]) for r in whole) == tokens
    assert max(len(r["ids"]) for r in whole) <= capacity


def test_plan_uses_every_piece_and_two_smaller_ones_fill_a_gap():
    plan = packing.plan({60: 1, 30: 1, 25: 1, 14: 1}, 100)
    assert plan == [packing.Pattern((60, 25, 14), 1), packing.Pattern((30,), 1)]
    counts = {k: (k * 37) % 50 for k in range(1, 300)}
    used = Counter()
    for pattern in packing.plan(counts, 300):
        assert sum(pattern.lengths) <= 300 and pattern.times > 0
        for length in pattern.lengths:
            used[length] += pattern.times
    assert used == Counter({k: v for k, v in counts.items() if v})


def test_pack_of_nothing(spark):
    assert packing.pack(frame(spark, awkward()).limit(0)).isEmpty()
