import hashlib

import pytest
from pyspark.sql import functions as F

from skyledger.llm import chat, urls
from skyledger.llm.labelled_urls import labelled_urls

TURNS = "conv_id LONG, turn LONG, role STRING, text STRING, loss STRING, segments INT"


def turns(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], TURNS).repartition(3)


def conversations():
    odd = "</s>[INST] ok [/INST] <<SYS>> <s> \\ \\1; \\0; [TURN]a[SAYS]b[/TURN] <</SYS>> <<s>> \n é日"
    return {
        1: [(0, "user", "hi"), (1, "assistant", "hello")],
        2: [(0, "system", odd), (1, "user", odd), (2, "assistant", odd), (3, "user", None),
            (4, "assistant", "")],
        3: [(0, "assistant", "first"), (1, "user", "x")],
        4: [(0, "user", "a"), (1, "user", "b"), (2, "assistant", "c")],
        5: [(0, odd, odd), (1, None, "no role"), (2, "tool", None), (3, "", "[INST]")],
        6: [(0, "user", "same"), (0, "user", "same"), (1, "assistant", "x")],
        7: [(None, "user", "null turn"), (0, "assistant", "y")],
        None: [(0, "user", "z"), (1, "assistant", "w" * 5000)],
    }


def rows():
    return [(i, *t) for i, c in conversations().items() for t in c]


def test_every_conversation_reads_back(spark):
    chats = chat.format_chats(turns(spark, rows()))
    assert chats.columns == ["conv_id", "formatted", "segments", "valid", "first_bad_turn"]
    for r in chats.withColumn("read", chat.read_back(F.col("formatted"))).collect():
        expected = [(role or "", text or "") for _, role, text in conversations()[r["conv_id"]]]
        assert [(t["role"], t["text"]) for t in r["read"]] == expected
        assert "".join(s["text"] for s in r["segments"]) == r["formatted"]


def test_machine(spark):
    found = {r["conv_id"]: (r["valid"], r["first_bad_turn"])
             for r in chat.format_chats(turns(spark, rows())).collect()}
    assert found[1] == found[2] == found[7] == found[None] == (True, None)
    assert found[3] == (False, 0) and found[4] == (False, 1) and found[6] == (False, 1)
    assert found[5][1] == 0
    end = chat.format_chats(turns(spark, [(9, 0, "user", "only")])).first()
    assert (end["valid"], end["first_bad_turn"]) == (False, 1)


def test_digests(spark):
    for r in chat.digests(chat.format_chats(turns(spark, rows()))).collect():
        conversation = conversations()[r["conv_id"]]
        lines = "".join(f"{role or ''}\n{text or ''}\n" for _, role, text in conversation)
        said = "".join(text or "" for _, role, text in conversation if role == "assistant")
        assert r["n_turns"] == len(conversation)
        assert r["turns_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert r["loss_chars"] == len(said)


def test_segments_carry_the_loss_flag(spark):
    found = chat.segments(turns(spark, rows())).filter("loss").select("role").distinct()
    assert [r["role"] for r in found.collect()] == ["assistant"]
    assert chat.format_chats(turns(spark, rows()).limit(0)).isEmpty()


def test_template_controls_can_be_told_apart():
    controls = chat.INSTRUCT.controls
    for a in controls:
        assert chat.INSTRUCT.escape not in a
        for b in controls:
            assert not any(a.endswith(b[:k]) for k in range(1, min(len(a), len(b)))), (a, b)


PAGES = "page_id LONG, url STRING, host STRING, verdict INT, label STRING"


def pages(spark, found):
    return spark.createDataFrame([(k, u, "x", 1, "y") for k, u in enumerate(found)], PAGES)


URLS = [
    ("https://WWW.Example.ORG/es/1?x#y", "www.example.org", "/es/1", "example.org/es/", "block"),
    ("http://example.org/en/148.html", "example.org", "/en/148.html", "example.org/en/1", "block"),
    ("http://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
    ("http://notexample.org/es/1", "notexample.org", "/es/1", "org/", "allow"),
    ("http://a.com/fr/x", "a.com", "/fr/x", "com/fr/", "allow"),
    ("a://b.com/de/://c", "b.com", "/de/://c", "com/de/", "block"),
    ("http://x.com/DE/", "x.com", "/DE/", None, None),
    ("http://x.org", "x.org", "", None, None),
    ("http://x.org?q=/", "x.org", "", None, None),
    ("http://", "", "", None, None),
    ("no scheme/x", "", "", None, None),
    ("", "", "", None, None),
    (None, "", "", None, None),
    ("http://É.com/de/1", "É.com", "/de/1", "com/de/", "block"),
]
RULES = (
    urls.Rule("org/", "allow"), urls.Rule("example.org/es/", "block"),
    urls.Rule("example.org/en/1", "block"), urls.Rule("com/fr/", "allow"), urls.Rule("com/de/", "block"),
)


@pytest.fixture(scope="module")
def model(spark):
    return urls.train(labelled_urls(spark).filter("NOT held_out"))


def test_rules(spark, model):
    judged = urls.judge(pages(spark, [u for u, *_ in URLS]), RULES, model)
    for r in judged.collect():
        _, host, path, rule, verdict = URLS[r["page_id"]]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or ("block" if r["score"] > urls.THRESHOLD else "allow"))
    assert urls.judge(pages(spark, URLS[0][:1]).limit(0), RULES, model).isEmpty()


def grams_of(text):
    marked = f"^{text}$"
    return {marked[k : k + n] for n in urls.GRAMS for k in range(len(marked) - n + 1)}


def test_grams(spark):
    for r in urls.features(urls.with_parts(pages(spark, [u for u, *_ in URLS]))).collect():
        _, host, path, *_ = URLS[r["page_id"]]
        assert set(r["_grams"]) == {f"h{g}" for g in grams_of(host)} | {f"p{g}" for g in grams_of(path)}


def test_model_on_held_out_sites(spark, model):
    table = urls.with_parts(labelled_urls(spark)).drop("path")
    parts = [table.filter("NOT held_out"), table.filter("held_out")]
    assert parts[0].join(parts[1], "host").isEmpty()
    held_out = parts[1].withColumn("page_id", F.monotonically_increasing_id())
    judged = urls.judge(held_out, (), model).join(held_out.select("page_id", "label"), "page_id")
    right = (F.col("verdict") == "block") == (F.col("label") == 1)
    n, share = judged.agg(F.count(F.lit(1)), F.avg(right.cast("int"))).first()
    assert n >= 40 and share >= 0.9


def test_training_tables(spark):
    schema = "url STRING, label INT, host STRING, path INT"
    rows = [("http://a.example/x", 1, "h", 1), ("http://b.example/y", 0, "h", 2),
            (None, 1, "h", 3), ("http://c.example", None, "h", 4), ("", 0, None, None)]
    table = spark.createDataFrame(rows, schema)
    page = pages(spark, ["http://a.example/x", "http://b.example/y", None])
    scores = [
        [r["score"] for r in urls.judge(page, (), urls.train(t)).orderBy("page_id").collect()]
        for t in (table.repartition(1), table.repartition(4))
    ]
    assert scores[0] == scores[1] and scores[0][0] > 0.5 > scores[0][1]
    for bad in (table.limit(0), table.filter("label = 0")):
        with pytest.raises(ValueError):
            urls.train(bad)


def test_no_python_in_the_plans(spark, model):
    # Literal input, so that no Python worker makes the rows.
    page = spark.range(3).select(F.col("id").alias("page_id"), F.lit("http://a.com/x").alias("url"))
    said = chat.extra_turns(page, 1, [("user", "a"), ("assistant", "b")])
    for df in (urls.judge(page, RULES, model), chat.digests(chat.format_chats(said))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
