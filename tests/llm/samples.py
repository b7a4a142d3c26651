"""Small document tables with all awkward cases."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id LONG, text STRING, kept STRING, hub LONG, length STRING, n_chars LONG"


def prose(seed, n, vocabulary=400):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        word = f"w{rng.randrange(vocabulary)}"
        out.append(word.capitalize() + "." if rng.random() < 0.1 else word)
    return " ".join(out)


def frame(spark, rows):
    """(doc_id, text) rows with extra columns whose names the operators use themselves."""
    full = [(i, t, "extra", None, "x", len(t or "")) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3, F.xxhash64("text"))


def awkward():
    """NULL in both columns, blanks, one word, a very long text, repeated rows, equal ids."""
    long = prose(1, 40_000)
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (5, long), (6, "two words"),
        (None, "no id here at all today my friend"), (None, None), (7, "Ünïcode 日本語 \x00 x"),
        (8, prose(2, 60)), (8, prose(3, 60)), (9, prose(2, 60)),
    ]
