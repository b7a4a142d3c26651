from pathlib import Path

import pytest

import __spark_entry__ as spark_entry
import corpus_pipeline
from skyledger.llm.oracle import ORACLE_SQL
from skyledger.llm.queries import QUERIES
from tests.llm.samples import awkward, frame, prose
from tests.llm.test_neardup import brute as grouped
from tests.llm.test_quality import counts_of
from tests.llm.test_spans import brute as cut
from tests.llm.test_tokens import exact  # noqa: F401

SMALL = Path("/root/testdata/sf0.001")


def test_registered():
    assert set(QUERIES) <= set(spark_entry.queries()) and "pipeline" in spark_entry.queries()
    assert set(ORACLE_SQL) <= set(QUERIES)
    assert sorted({int(n[2:].split("_")[0]) for n in QUERIES}) == list(range(1, 11))


@pytest.mark.skipif(not SMALL.exists(), reason="needs the test tables")
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    from checks.compare import compare, duckdb_connection

    query = QUERIES[name]
    assert compare(spark, duckdb_connection(str(SMALL)), query, ORACLE_SQL[name], str(SMALL)) == ""


def test_stages_equal_brute_force(spark, tmp_path, exact):  # noqa: F811
    shared = prose(70, 70)
    item = prose(80, 40, 5000)
    rows = awkward() + [
        (100, prose(1, 100)), (101, prose(1, 100)), (102, "spam " * 50), (103, prose(2, 90) + "\n" + shared),
        (104, prose(3, 90) + "\n" + shared), (105, f"{prose(4, 50)} {item} {prose(5, 9)}"), (106, prose(6, 3000)),
    ]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id LONG, text STRING").write.parquet(
        str(tmp_path / "benchmark.parquet")
    )
    good = [(i, t) for i, t in rows if counts_of(t)[-1]]
    one, seen = [], set()
    for (i, t), (_, _, _, kept) in zip(sorted(good, key=str), grouped(sorted(good, key=str), 5, 80)):
        if i is None or (kept and i not in seen):
            one.append((i, t))
            seen.add(i)
    whole = [(i, t) for i, t, _, _ in cut(one)]
    import tests.llm.test_decontaminate as d

    clean = []
    for i, t in whole:
        distance = d.least_distance(d.normal(item), d.normal(t)[:2500])
        if distance > len(d.normal(item)) * 8 // 100:
            clean.append((i, t))
    result = corpus_pipeline.run(spark, str(tmp_path)).collect()
    n_tokens = {}
    for r in result:
        n_tokens[r["doc_id"]] = n_tokens.get(r["doc_id"], 0) + r["length"]
    assert {i for i, _ in clean} == set(n_tokens)
    single = {i: t for i, t in clean if [j for j, _ in clean].count(i) == 1}
    assert all(n_tokens[i] == len(exact(t)) + 1 for i, t in single.items())
    assert 105 not in n_tokens and 102 not in n_tokens and 101 not in n_tokens and 104 in n_tokens


def test_stages_keep_the_columns(spark):
    docs = frame(spark, awkward())
    for _, stage in corpus_pipeline.STAGES[:3]:
        assert stage(spark, docs, "").columns == docs.columns


def test_workers_find_the_package_and_batches_stay_small(spark):
    from skyledger.llm.workers import BATCH_BYTES, let_workers_import

    before, environment = spark.conf.get(BATCH_BYTES), spark.sparkContext.environment
    try:
        spark.conf.set(BATCH_BYTES, "3m")
        let_workers_import(let_workers_import(spark))
        assert spark.conf.get(BATCH_BYTES) == "3m"
        root = str(Path(corpus_pipeline.__file__).resolve().parent)
        assert environment["PYTHONPATH"].split(":").count(root) == 1
        spark.conf.unset(BATCH_BYTES)
        let_workers_import(spark)
        assert spark.conf.get(BATCH_BYTES) == "8m"
    finally:
        spark.conf.set(BATCH_BYTES, before)
