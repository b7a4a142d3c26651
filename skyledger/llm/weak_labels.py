"""Quality classifier without hand-made labels.

Heuristic labellers vote good, bad or nothing on every document. Expectation-maximisation over the
vote patterns of all documents estimates how often each labeller votes how in either class, and so
the probability of each pattern to be good (Dawid and Skene 1979). There are at most 3 to the number
of labellers patterns, so only their counts leave the executors. With these probabilities as labels a
logistic regression over hashed features is trained on a bounded sample, and scores every document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.quality_rules import Counts
from skyledger.llm.words import mix, slices, texts_of
from skyledger.llm.workers import released

BAD, GOOD, NONE = 0, 1, 2
TRAIN_DOCS = 4000  # expected size of the training sample
FEATURES = 1 << 15
_ROUNDS = 100


class Labeller(NamedTuple):
    """`bad` and `good` tell which texts get which vote; where both hold, bad wins."""

    name: str
    bad: Callable[[Counts], np.ndarray]
    good: Callable[[Counts], np.ndarray]


def _share(c: Counts, name: str, of: str = "n_words") -> np.ndarray:
    return c[name] / np.maximum(c[of], 1)


LABELLERS = (
    Labeller("length", lambda c: c["n_words"] < 3, lambda c: c["n_words"] >= 50),
    Labeller("symbols", lambda c: _share(c, "n_symbols") > 0.3, lambda c: c["n_symbols"] == 0),
    Labeller("shouts", lambda c: _share(c, "n_shouts") > 0.3, lambda c: c["n_shouts"] == 0),
    Labeller("repeats", lambda c: _share(c, "n_repeat_words") > 0.2,
             lambda c: _share(c, "n_repeat_words") < 0.02),
    Labeller("word_length", lambda c: _share(c, "word_chars") > 12,
             lambda c: (_share(c, "word_chars") > 2.5) & (_share(c, "word_chars") < 9)),
    Labeller("sentences", lambda c: (c["n_stops"] * 100 < c["n_words"]) & (c["n_words"] >= 30),
             lambda c: c["n_stops"] * 60 >= c["n_words"]),
    Labeller("capitals", lambda c: _share(c, "n_capitals") > 2,
             lambda c: _share(c, "n_capitals") < 0.5),
    Labeller("endings", lambda c: _share(c, "n_plain_ends") < 0.7,
             lambda c: _share(c, "n_plain_ends") > 0.95),
    Labeller("letters", lambda c: _share(c, "n_alnum", "word_chars") < 0.8,
             lambda c: _share(c, "n_alnum", "word_chars") > 0.9),
    Labeller("variety", lambda c: (_share(c, "n_distinct") < 0.2) & (c["n_words"] >= 30),
             lambda c: _share(c, "n_distinct") > 0.4),
)


def votes(counts: Counts, labellers: Sequence[Labeller] = LABELLERS) -> np.ndarray:
    """Vote pattern of each text as one number in base 3."""
    code = np.zeros(len(counts.texts), np.int64)
    for labeller in labellers:
        vote = np.where(labeller.bad(counts), BAD, np.where(labeller.good(counts), GOOD, NONE))
        code = code * 3 + vote
    return code


def pattern_counts(docs: DataFrame, labellers: Sequence[Labeller] = LABELLERS) -> dict[int, int]:
    """Number of rows of `docs` per vote pattern; every row counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, part in slices(texts_of(batch.column(0))):
                code, n = np.unique(votes(Counts(part), labellers), return_counts=True)
                yield pa.record_batch([pa.array(code), pa.array(n)], names=["pattern", "n"])

    each = docs.select("text").mapInArrow(released(run), "pattern long, n long")
    return {r["pattern"]: r["n"] for r in each.groupBy("pattern").agg(F.sum("n").alias("n")).collect()}


class LabelModel(NamedTuple):
    """`good`: prior; `rates[class, labeller, vote]`; `posterior`: pattern -> probability good."""

    good: float
    rates: np.ndarray
    posterior: dict[int, float]

    def accuracy(self) -> np.ndarray:
        """Per labeller: how often a vote (not an abstention) names the right class."""
        right = (1 - self.good) * self.rates[0, :, BAD] + self.good * self.rates[1, :, GOOD]
        wrong = (1 - self.good) * self.rates[0, :, GOOD] + self.good * self.rates[1, :, BAD]
        return right / np.maximum(right + wrong, 1e-12)


def fit_labels(counts: dict[int, int], n_labellers: int, rounds: int = 100) -> LabelModel:
    """Expectation-maximisation; rates are smoothed by one vote.

    It starts from the belief that a bad vote is rare and mostly right: one makes a document
    doubtful, two make it bad. So the second class stays the good one.
    """
    patterns = np.array(sorted(counts), np.int64)
    n = np.array([counts[p] for p in patterns.tolist()], float)
    vote = np.stack([patterns // 3**k % 3 for k in reversed(range(n_labellers))], axis=1)
    good = np.array([0.95, 0.5, 0.1])[np.minimum((vote == BAD).sum(axis=1), 2)]
    prior, rates = 0.5, np.full((2, n_labellers, 3), 1 / 3)
    for _ in range(rounds if len(patterns) else 0):
        weight = np.stack([n * (1 - good), n * good])
        prior = float(np.clip(weight[1].sum() / n.sum(), 0.01, 0.99))
        for v in (BAD, GOOD, NONE):
            rates[:, :, v] = weight @ (vote == v) + 1
        rates /= rates.sum(axis=2, keepdims=True)
        log = np.log(rates[:, np.arange(n_labellers), vote]).sum(axis=2)
        odds = log[1] - log[0] + np.log(prior / (1 - prior))
        good = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
    return LabelModel(prior, rates, dict(zip(patterns.tolist(), good.tolist())))


def hashed(counts: Counts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, value): words, their last sign and their length as shares of all words, and
    how varied the words are."""
    words, data = counts.words, counts.texts.data
    n = np.diff(words.first)
    owner = np.repeat(np.arange(len(n)), n)
    length = np.minimum(words.end - words.start, 30).astype(np.uint64)
    last = data[words.end - 1].astype(np.uint64) if len(words.end) else length
    kinds = [
        words.value,
        mix(last + np.uint64(1 << 20)),
        mix(length + np.uint64(1 << 21)),
    ]
    mask = np.uint64(FEATURES - 1)
    feature = np.concatenate([(k & mask).astype(np.int64) for k in kinds])
    text = np.tile(owner, len(kinds))
    key, times = np.unique(text * FEATURES + feature, return_counts=True)
    text, feature = key // FEATURES, key % FEATURES
    variety = np.minimum(_share(counts, "n_distinct") * 10, 9).astype(np.uint64)
    level = (mix(variety + np.uint64(1 << 22)) & mask).astype(np.int64)
    return (
        np.concatenate([text, np.arange(len(n))]),
        np.concatenate([feature, level]),
        np.concatenate([times / np.maximum(n, 1)[text], np.ones(len(n))]),
    )


def fit_scorer(
    rows: np.ndarray, features: np.ndarray, values: np.ndarray, target: np.ndarray
) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression with probabilities as labels (AdaGrad)."""
    weights, bias = np.zeros(FEATURES), 0.0
    square, bias_square = np.full(FEATURES, 1e-8), 1e-8
    for _ in range(_ROUNDS if len(target) else 0):
        margin = np.bincount(rows, values * weights[features], len(target)) + bias
        error = (1 / (1 + np.exp(-np.clip(margin, -50, 50))) - target) / len(target)
        gradient = np.bincount(features, values * error[rows], FEATURES) + 1e-6 * weights
        square += gradient**2
        weights -= 0.5 * gradient / np.sqrt(square)
        bias_square += error.sum() ** 2
        bias -= 0.5 * error.sum() / np.sqrt(bias_square)
    return weights, bias


_PLACES = 1 << 40


def train(
    docs: DataFrame,
    labellers: Sequence[Labeller] = LABELLERS,
    train_docs: int = TRAIN_DOCS,
) -> tuple[LabelModel, np.ndarray, float]:
    """Label model over all documents, scorer over a sample of about `train_docs` of them.

    Whether a row is in the sample depends on a hash of its doc_id and text alone, and the sample is
    sorted, so that the model is the same however the rows are partitioned.
    """
    counts = pattern_counts(docs, labellers)
    model = fit_labels(counts, len(labellers))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, j, part in slices(texts_of(batch.column(0))):
                text = Counts(part)
                code = votes(text, labellers)
                rows, feature, value = hashed(text)
                order = np.argsort(rows, kind="stable")
                cut = np.searchsorted(rows[order], np.arange(len(code) + 1))
                spans = [order[a:b] for a, b in zip(cut, cut[1:])]
                yield pa.record_batch(
                    [pa.array(code),
                     pa.array([feature[s].astype(np.int32).tobytes() for s in spans], pa.binary()),
                     pa.array([value[s].astype(np.float32).tobytes() for s in spans], pa.binary())],
                    names=["pattern", "features", "shares"],
                )

    fraction = min(1.0, train_docs / max(sum(counts.values()), 1))
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(_PLACES))
    sample = (
        docs.filter(place < F.lit(int(fraction * _PLACES)))
        .select("text")
        .mapInArrow(released(run), "pattern long, features binary, shares binary")
        .collect()
    )
    sample.sort()
    target = np.array([model.posterior[r["pattern"]] for r in sample])
    each = [np.frombuffer(r["features"], np.int32) for r in sample]
    rows = np.repeat(np.arange(len(sample)), [len(e) for e in each])
    features = np.concatenate(each) if each else np.empty(0, np.int32)
    shares = [np.frombuffer(r["shares"], np.float32) for r in sample]
    values = np.concatenate(shares).astype(float) if shares else np.empty(0)
    return model, *fit_scorer(rows, features, values, target)


def scored(
    docs: DataFrame,
    labellers: Sequence[Labeller] = LABELLERS,
    train_docs: int = TRAIN_DOCS,
    threshold: float = 0.5,
) -> DataFrame:
    """(doc_id, weak_label, score, kept) for each row of `docs` (doc_id, text, ...).

    `weak_label` is the probability by the votes, `score` that by the trained scorer, both to be
    good; `kept` is score >= threshold. A text without words (NULL, empty) has score 0. Repeated
    rows are scored alike; other columns are ignored; an empty table gives no rows.
    """
    model, weights, bias = train(docs, labellers, train_docs)
    posterior = model.posterior

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for i, j, part in slices(texts_of(batch.column(1))):
                counts = Counts(part)
                weak = [posterior.get(p, model.good) for p in votes(counts, labellers).tolist()]
                rows, feature, value = hashed(counts)
                margin = np.bincount(rows, value * weights[feature], j - i) + bias
                score = 1 / (1 + np.exp(-np.clip(margin, -50, 50)))
                score[counts["n_words"] == 0] = 0.0
                yield pa.record_batch(
                    [ids.slice(i, j - i), pa.array(weak, pa.float64()), pa.array(score),
                     pa.array(score >= threshold)],
                    names=["doc_id", "weak_label", "score", "kept"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(released(run), "doc_id long, weak_label double, score double, kept boolean")
