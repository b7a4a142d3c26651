import random
import re
from collections import Counter, defaultdict

from skyledger.llm import divergence
from tests.llm.samples import awkward, prose

SCHEMA = "doc_id long, text string, lang string, source string, n long, term string, shard int"


def frame(spark, rows):
    return spark.createDataFrame([(k, *r, 1, "x", 2) for k, r in enumerate(rows)], SCHEMA)


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)


def expected(rows, min_docs=3, top=200):
    count, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        count[lang, source].update(words(text))
        docs[lang].update(set(words(text)))
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        share = {}
        whole = Counter()
        for s in sources:
            whole.update({t: count[lang, s][t] for t in kept})
        for s, c in [*((s, count[lang, s]) for s in sources), (None, whole)]:
            n = sum(c[t] for t in kept)
            share[s] = {t: 1 + 10**9 * (c[t] + 1) // (n + len(kept)) for t in kept}
        for s in sources:
            pair = [(-sum((share[s][t] - share[o][t]) ** 2 // share[o][t] for t in kept), o)
                    for o in sources if o != s]
            term = [(-((share[s][t] - share[None][t]) ** 2 // share[None][t]), t) for t in kept
                    if count[lang, s][t] and share[s][t] > share[None][t]]
            for part, items in (("pair", sorted(pair)), ("term", sorted(term)[:top])):
                out |= {(lang, s, part, i, -v, k) for k, (v, i) in enumerate(items, 1)}
    return out


def corpus(seed, n=120):
    rng = random.Random(seed)
    return [(prose(rng.random(), rng.randint(0, 60), rng.choice([8, 60])), rng.choice(["en", "de"]),
             rng.choice(["a", "b", "b", "b", "ç", "d"])) for _ in range(n)]


def check(spark, rows, **options):
    result = divergence.audit(frame(spark, rows).repartition(5), **options)
    assert result.columns == ["lang", "source", "part", "item", "value", "rank"]
    found = [tuple(r) for r in result.collect()]
    assert len(found) == len(set(found))
    assert set(found) == expected(rows, **options)


def test_equals_plain_counting(spark, monkeypatch):
    check(spark, corpus(1))
    monkeypatch.setattr(divergence, "BLOCK_POSTINGS", 40)
    monkeypatch.setattr(divergence, "CHUNK", 3)
    monkeypatch.setattr(divergence, "OUT_ROWS", 7)
    monkeypatch.setattr(divergence, "MERGE_POSTINGS", 10)
    check(spark, corpus(2), top=5)


def test_awkward_rows(spark):
    odd = [(t, lang, s) for _, t in awkward()[:8] for lang, s in (("en", "a"), (None, None), ("", "b"), ("x", "only"))]
    check(spark, odd + odd + [(None, "fr", "q"), ("", "fr", "r"), ("é Éa\x00b 日本", "ja", "s")] * 3)
    check(spark, corpus(3, 30), min_docs=1)
    check(spark, corpus(3, 30), min_docs=1000)
    assert divergence.audit(frame(spark, corpus(1)[:1]).limit(0)).isEmpty()


def test_runs_merge_to_the_same_frequencies(spark, monkeypatch):
    docs = frame(spark, corpus(4))
    whole = {tuple(r) for r in divergence.frequencies(docs.coalesce(1), 1, shards=1).collect()}
    monkeypatch.setattr(divergence, "BLOCK_POSTINGS", 10)
    monkeypatch.setattr(divergence, "CHUNK", 2)
    monkeypatch.setattr(divergence, "MERGE_POSTINGS", 5)
    parts = [tuple(r) for r in divergence.frequencies(docs.repartition(7), 1, shards=5).collect()]
    assert set(parts) == whole and len(parts) == len(whole)


def test_counts_beyond_64_bits_stay_exact(spark):
    row = spark.range(1).selectExpr("cast(9000000000000000000 as long) as c", "cast(9000000000000000001 as long) as d")
    got = row.select(divergence._part("c", row["d"])).first()[0]
    assert got == 1 + 10**9 * 9000000000000000000 // 9000000000000000001
