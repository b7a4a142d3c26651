"""Registered queries of this folder: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from skyledger.llm import (
    chat,
    decontaminate,
    divergence,
    licenses,
    main_text,
    neardup,
    packing,
    quality_rules,
    spans,
    spelling,
    token_counts,
    urls,
    weak_labels,
)
from skyledger.llm.labelled_urls import labelled_urls
from skyledger.llm.workers import let_workers_import
from skyledger.session import staged

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(build):
    QUERIES[build.__name__] = build
    return build


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return let_workers_import(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@_query
def op2_minhash_groups(spark, sf_dir):
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"), shingle_words=4)


@_query
def op1_token_counts(spark, sf_dir):
    histogram = token_counts.length_histogram(_table(spark, sf_dir, "documents"))
    return token_counts.suffix_totals(staged(histogram))


@_query
def op10_best_two_fit(spark, sf_dir):
    return packing.pack(_table(spark, sf_dir, "documents"))


@_query
def op9_rule_cascade(spark, sf_dir):
    return quality_rules.judged(_table(spark, sf_dir, "documents"))


@_query
def op5_pigeonhole_leaks(spark, sf_dir):
    return decontaminate.leaks(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )


@_query
def op8_sentence_spans(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return spans.without_repeats(docs, with_counts=True)


@_query
def op6_chat_segments(spark, sf_dir):
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = chat.extra_turns(turns, -7, [("user", said), ("assistant", said)])
    return chat.digests(chat.format_chats(turns.unionByName(extra)))


URL_RULES = (
    urls.Rule("org/", urls.ALLOW),
    urls.Rule("example.org/es/", urls.BLOCK),
    urls.Rule("example.org/en/1", urls.BLOCK),
    urls.Rule("com/fr/", urls.ALLOW),
    urls.Rule("com/de/", urls.BLOCK),
)


@_query
def op7_url_verdicts(spark, sf_dir):
    model = urls.train(labelled_urls(spark).filter("NOT held_out"))
    return urls.judge(_table(spark, sf_dir, "pages"), URL_RULES, model)


@_query
def op3_license_index(spark, sf_dir):
    return licenses.scan(_table(spark, sf_dir, "documents"))


@_query
def op4_weak_labels(spark, sf_dir):
    return weak_labels.scored(_table(spark, sf_dir, "documents"))


@_query
def op11_main_text(spark, sf_dir):
    return main_text.main_texts(_table(spark, sf_dir, "pages"))


@_query
def op12_source_divergence(spark, sf_dir):
    return divergence.audit(_table(spark, sf_dir, "documents"))


@_query
def op13_spelling_variants(spark, sf_dir):
    words = spelling.word_counts(_table(spark, sf_dir, "documents"), drop_every=31)
    return spelling.variants(staged(words))
