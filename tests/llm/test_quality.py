import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from skyledger.llm import quality_rules, weak_labels
from skyledger.llm.words import texts_of
from tests.llm.samples import awkward, frame, prose


def counts_of(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    covered = set()
    for k in range(len(words) - 4):
        if windows[tuple(words[k : k + 5])] > 1:
            covered.update(range(k, k + 5))
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    n = len(words)
    failed = n < 10 or 100 * len(covered) > 20 * n
    dup = len(lines) - len(set(lines))
    kept = not (
        failed or 10 * symbols > 3 * n or 10 * text.count("!") > 3 * n
        or 10 * dup > 3 * len(lines) or sum(map(len, words)) > 25 * n
    )
    return (n, sum(map(len, words)), symbols, dup, len(covered), failed, kept)


def junk():
    line = prose(9, 12)
    return [
        (20, "spam " * 40), (21, "a b c d e f a b c d e f g h i j k l m n o p q r s t"),
        (22, " ".join(f"{w}###" for w in prose(3, 40).split())), (23, f"{line}\n" * 3 + line),
        (24, " ".join(w.upper() + "!!" for w in prose(4, 40).split())), (25, f"\n\n{line}\r\n{line}"),
        (26, "x" * 500 + " " + prose(6, 12)), (27, prose(7, 30) + "\n \n\t\n" + prose(8, 30)),
        (28, "é € 日 " * 6), (29, " | ".join(prose(11, 40).split())), (30, f"{line}\n{line} "),
    ]


def test_counts_and_verdicts_equal_brute_force(spark):
    rows = awkward() + junk() + [(60 + k, prose(k, 80)) for k in range(20)]
    found = quality_rules.judged(frame(spark, rows))
    assert found.columns == [
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    ]
    expected = sorted([(i, *counts_of(t)) for i, t in rows], key=str)
    assert sorted((tuple(r) for r in found.collect()), key=str) == expected


def test_cascade_is_the_same_in_any_order_and_skips_what_is_rejected():
    texts = texts_of(pa.array([t for _, t in awkward() + junk()]))
    expected = [counts_of(t)[-1] for _, t in awkward() + junk()]
    rules = list(quality_rules.RULES)
    for seed in range(5):
        random.Random(seed).shuffle(rules)
        assert quality_rules.cascade(texts, rules).tolist() == expected
    seen = []
    watch = quality_rules.Rule("watch", lambda c: seen.append(len(c.texts)) or c["n_words"] < 0)
    quality_rules.cascade(texts, [quality_rules.RULES[0], watch])
    assert seen == [sum(counts_of(t)[0] >= 10 for _, t in awkward() + junk())]


def test_rules_are_ordered_by_rejections_per_second(spark):
    docs = frame(spark, awkward() + junk())
    measured = {r["name"]: r for r in quality_rules.measured(docs).collect()}
    assert measured["few_words"]["rejected"] == sum(
        counts_of(t)[0] < 10 for _, t in awkward() + junk()
    )
    assert all(r["n_docs"] == len(awkward() + junk()) for r in measured.values())
    never = quality_rules.Rule("never", lambda c: c["n_words"] < 0)
    order = quality_rules.ordered(docs, [never, *quality_rules.RULES], sample_docs=1000)
    assert order[-1].name in {"never", "long_words"} and order[0].name != "never"


def test_keep_good_keeps_columns(spark):
    rows = awkward() + junk()
    docs = frame(spark, rows)
    kept = quality_rules.keep_good(docs)
    assert kept.schema == docs.schema
    expected = sorted([i for i, t in rows if counts_of(t)[-1]], key=str)
    assert sorted([r["doc_id"] for r in kept.collect()], key=str) == expected
    assert quality_rules.keep_good(docs.limit(0)).isEmpty()
    assert quality_rules.judged(docs.limit(0)).isEmpty()


def test_label_model_finds_the_accuracies():
    rng, truth = np.random.default_rng(2), np.random.default_rng(1).random(40_000) < 0.8
    accuracy, counts = [0.95, 0.9, 0.8, 0.7, 0.85], Counter()
    code = np.zeros(len(truth), np.int64)
    for a in accuracy:
        vote = np.where(rng.random(len(truth)) < a, truth, ~truth).astype(int)
        code = code * 3 + np.where(rng.random(len(truth)) < 0.2, weak_labels.NONE, vote)
    counts.update(code.tolist())
    model = weak_labels.fit_labels(counts, len(accuracy))
    assert abs(model.good - 0.8) < 0.03
    assert np.abs(model.accuracy() - accuracy).max() < 0.05


def test_scorer_tells_junk_from_prose(spark):
    rng = random.Random(4)
    good = [(5000 + k, prose(k, rng.randrange(40, 200))) for k in range(300)]
    bad = []
    for k in range(60):
        words = prose(1000 + k, 60).split()
        text = (" ".join(w + "###" for w in words), (words[0] + " ") * 60,
                " ".join(w.upper() + "!!" for w in words))[k % 3]
        bad.append((1000 + k, text))
    found = weak_labels.scored(frame(spark, good + bad + awkward()[:4]))
    result = {r["doc_id"]: r for r in found.collect()}
    assert sum(result[i]["kept"] for i, _ in good) >= 295
    assert sum(result[i]["kept"] for i, _ in bad) <= 3
    assert result[1]["score"] == 0.0 and not result[2]["kept"]
    assert all(0 <= r["score"] <= 1 for r in result.values())


def test_scorer_of_odd_tables(spark):
    docs = frame(spark, awkward())
    assert weak_labels.scored(docs).count() == len(awkward())
    assert weak_labels.scored(docs.limit(0)).isEmpty()
