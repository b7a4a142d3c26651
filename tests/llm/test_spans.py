import random
import re

import pyarrow as pa

from skyledger.llm import spans
from skyledger.llm.words import texts_of
from tests.llm.samples import awkward, frame, prose


def sentences(text):
    """(start, end, words) of each sentence."""
    tokens = [(m.start(), m.end(), m[0].lower()) for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    whole, current = [], []
    for k, (start, end, word) in enumerate(tokens):
        current.append(tokens[k])
        last = k + 1 == len(tokens)
        if last or re.search(r"[.!?]$|[.!?][\"')\]]$", word) or "\n" in text[end : tokens[k + 1][0]]:
            whole.append(current)
            current = []
    pieces = []
    for sentence in whole:
        n = len(sentence) // 12 if len(sentence) >= 24 else 1
        for q in range(n):
            pieces.append(sentence[12 * q : 12 * (q + 1) if q < n - 1 else None])
    return pieces


def runs(pieces, size=2, least=20):
    out, n = set(), len(pieces)
    for a in range(n):
        b = a + size
        while b < n and sum(len(p) for p in pieces[a:b]) < least:
            b += 1
        if b <= n and sum(len(p) for p in pieces[a:b]) >= least:
            out.add((a, b))
    for b in range(1, n + 1):
        a = b - size
        while a > 0 and sum(len(p) for p in pieces[a:b]) < least:
            a -= 1
        if a >= 0 and sum(len(p) for p in pieces[a:b]) >= least:
            out.add((a, b))
    return out


def brute(rows):
    first = {}
    parsed = []
    for doc_id, text in rows:
        pieces = sentences(text or "")
        words = {r: tuple(w for p in pieces[r[0] : r[1]] for *_, w in p) for r in runs(pieces)}
        parsed.append((pieces, words))
        if doc_id is not None:
            for value in words.values():
                first[value] = min(first.get(value, doc_id), doc_id)
    out = []
    for (doc_id, text), (pieces, words) in zip(rows, parsed):
        removed, seen = set(), set()
        for (a, b), value in sorted(words.items()):
            again = value in seen or (doc_id is not None and first[value] != doc_id)
            seen.add(value)
            if again:
                removed.update(range(a, b))
        result = text
        if removed:
            cuts = [0] + [p[0][0] for p in pieces[1:]] + [len(text)]
            result = "".join(
                text[cuts[k] : cuts[k + 1]] for k in range(len(pieces)) if k not in removed
            )
        out.append((doc_id, result, len(pieces), len(removed)))
    return sorted(out, key=str)


def corpus():
    passage = "Here stands a passage. It goes over sentences of some length, as they do. " + prose(3, 45)
    unbroken = " ".join(f"u{k}" for k in range(60))
    return [
        (10, prose(20, 80) + "\n" + passage + "\n" + prose(21, 30)),
        (11, prose(22, 15) + " " + passage),
        (12, passage), (13, passage.upper().replace(" ", "  ")), (14, passage + "\n" + passage),
        (15, prose(23, 50) + ". " + unbroken + "\n" + prose(24, 9)), (16, unbroken), (9, unbroken),
        (17, 'He said "no." Then left. ' + prose(25, 40)), (18, "Short one. Short two."),
        (19, "Short one. Short two."), (None, passage), (8, "A. B. " * 30), (30, None),
    ]


def test_removals_equal_brute_force(spark):
    rows = awkward() + corpus()
    docs = frame(spark, rows).select("doc_id", "text")
    found = spans.without_repeats(docs, with_counts=True)
    assert found.columns == ["doc_id", "text", "n_sentences", "n_removed"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(rows)


def test_a_long_shared_passage_leaves_and_the_rest_stays(spark):
    result = {r["doc_id"]: r["text"] for r in spans.without_repeats(frame(spark, corpus())).collect()}
    rows = dict(corpus())
    assert result[10] == rows[10] and result[9] == rows[9] and result[None] == rows[None]
    assert result[12] == "" and result[16] == ""
    # The passage's first sentence goes on from the words before it there, so it stays.
    assert "It goes over" not in result[11] and prose(22, 15) in result[11]
    assert len(result[11].split()) < 40
    assert result[18] == rows[18] and result[19] == rows[19]


def test_columns_stay(spark):
    docs = frame(spark, corpus())
    cut = spans.without_repeats(docs)
    assert cut.columns == docs.columns
    assert spans.without_repeats(docs.limit(0)).isEmpty()


def planted(n=120):
    """Passages of 51 to 90 words without a repeat inside, set in the middle of sentences of two
    documents each, with other words, full stops and line ends around them."""
    rng, rows, cases = random.Random(7), [], []
    for k in range(n):
        passage = [f"p{rng.randrange(5000)}" for _ in range(rng.randrange(51, 91))]
        for stop in range(rng.randrange(1, 30), len(passage) - 1, rng.choice([9, 17, 23, 100])):
            passage[stop] += "."
        for doc_id in (1000 + k, 2000 + k):
            around = [f"d{rng.randrange(10**6)}" for _ in range(rng.randrange(100, 160))]
            at = rng.randrange(len(around) + 1)
            words = around[:at] + passage + around[at:]
            ends = {rng.randrange(len(words)) for _ in range(12)} if doc_id < 2000 else ()
            text = "".join(w + ("\n" if q in ends else " ") for q, w in enumerate(words))
            rows.append((doc_id, text))
        cases.append((2000 + k, passage, around))
    return rows, cases


def test_passages_inside_sentences_leave_at_any_offset(spark):
    rows, cases = planted()
    found = spans.without_repeats(frame(spark, rows))
    result = {r["doc_id"]: r["text"].split() for r in found.collect()}
    for doc_id, text in rows:
        if doc_id < 2000:
            assert result[doc_id] == text.split()
    for doc_id, passage, around in cases:
        held = set(passage)
        left = [w for w in result[doc_id] if w in held]
        assert 2 * len(left) <= len(passage)
        assert [w for w in result[doc_id] if w not in held] == around


def test_cuts_are_the_least_words_of_all_windows():
    texts = [prose(1, 300, 30), "a b " * 40, "same " * 30, prose(2, 5), "", prose(3, 50)]
    found = spans.Sentences(texts_of(pa.array(texts)))
    values, expected = found.words.value, set()
    for low, high in zip(found.words.first, found.words.first[1:]):
        for q in range(low, high - spans.WINDOW + 1):
            expected.add(q + int(values[q : q + spans.WINDOW].argmin()))
    assert found.cuts().tolist() == sorted(expected)
