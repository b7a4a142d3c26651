import re

import numpy as np
import pyarrow as pa

from skyledger.llm import superminhash, words
from skyledger.llm.words import ALNUM, SPACED, shingles_of, slices, texts_of, words_of
from tests.llm.samples import awkward, prose

TEXTS = [t for _, t in awkward()] + ["A b\x0bC", "ß É", " x y"]


def test_words_equal_the_regex(monkeypatch):
    monkeypatch.setattr(words, "SLICE_BYTES", 64)
    for alphabet, pattern in (
        (SPACED, r"[^\x20\x09-\x0D]+"),
        (ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"),
    ):
        texts = texts_of(pa.array(TEXTS).slice(1))
        found = words_of(texts, alphabet)
        value = {}
        for k, text in enumerate(TEXTS[1:]):
            lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
            expected = re.findall(pattern, lower)
            span = range(found.first[k], found.first[k + 1])
            got = [bytes(texts.data[found.start[w] : found.end[w]]).decode() for w in span]
            assert [re.sub("[A-Z]", lambda m: m[0].lower(), g) for g in got] == expected
            for w, word in zip(span, expected):
                assert value.setdefault(word, found.value[w]) == found.value[w]
        assert len(set(value.values())) == len(value)


def test_slices_hold_all_texts_once():
    texts = texts_of(pa.array(TEXTS))
    runs = list(slices(texts, 100))
    assert [i for i, _, _ in runs] + [len(TEXTS)] == [0] + [j for _, j, _ in runs]
    assert b"".join(bytes(p.data) for _, _, p in runs) == bytes(texts.data)


def test_shingles():
    texts = texts_of(pa.array(["a b c d", "a b c", "", "a b c d e", "a"]))
    value, owner = shingles_of(words_of(texts, SPACED), 4)
    assert owner.tolist() == [0, 1, 3, 3, 4]
    assert value[0] == value[2] and len(set(value.tolist())) == 4


def test_signatures_estimate_similarity():
    errors = []
    for n in (1, 3, 40, 600):
        common = np.arange(n, dtype=np.uint64)
        for seed in range(12):
            base = words.mix(common + np.uint64(1000 * seed))
            rest = [words.mix(np.arange(n // 2, dtype=np.uint64) + np.uint64(10**6 * (k + 1) + seed))
                    for k in (0, 1)]
            sets = [np.concatenate([base, r]) for r in rest]
            owner = np.repeat([0, 1], [len(s) for s in sets])
            a, b = superminhash.signatures(np.concatenate(sets), owner, 2)
            errors.append((a == b).mean() - n / (n + 2 * (n // 2)))
            order = np.random.default_rng(seed).permutation(len(owner))
            again = superminhash.signatures(np.concatenate(sets)[order], owner[order], 2)
            assert (again[0] == a).all() and (again[1] == b).all()
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.05


def test_every_register_is_visited_once():
    key = words.mix(np.arange(50, dtype=np.uint64))
    visits = np.stack([superminhash._register(key, step) for step in range(superminhash.SIZE)])
    assert (np.sort(visits, axis=0) == np.arange(superminhash.SIZE)[:, None]).all()


def test_prose_is_stable():
    assert prose(1, 5) == prose(1, 5)
