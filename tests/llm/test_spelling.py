import random
import re
import zlib
from collections import Counter, defaultdict

from skyledger.llm import spelling
from tests.llm.samples import awkward, frame


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def counted(rows, min_chars=7, min_count=2, drop_every=None):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = fold(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if drop_every and h % drop_every == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            if len(run) >= min_chars:
                n[run] += 1
    return {w: c for w, c in n.items() if c >= min_count}


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def grouped(words, ratio=10):
    links = defaultdict(list)
    for a in words:
        links[a] = [b for b in words if near(a, b)]
    form = {}
    for a, others in links.items():
        best = min(others, key=lambda b: (-words[b], b), default=None)
        form[a] = best if best is not None and words[best] >= ratio * words[a] else None
    out = set()
    for a in words:
        root = a
        while form[root] is not None:
            root = form[root]
        out.add((a, form[a], root, words[a], len(links[a]), form[a] and words[form[a]]))
    return out


def texts(seed, stems, edits):
    rng = random.Random(seed)
    letters = "abàÿé÷"
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(7, 12))) for _ in range(stems)]
    bag = []
    for word in words:
        bag += [word] * rng.choice([2, 30, 400])
        for _ in range(edits):
            k = rng.randrange(len(word) + 1)
            cut = rng.choice([0, 1])
            new = word[:k] + rng.choice(["", rng.choice(letters)]) + word[k + cut :]
            bag += [new] * rng.choice([1, 2, 3, 40])
            word = rng.choice([word, new])
    rng.shuffle(bag)
    return [(k % 90, " ".join(w.title() for w in bag[k::100])) for k in range(100)]


def check(spark, rows, monkeypatch=None, **options):
    words = spelling.word_counts(frame(spark, rows), **options)
    expected = counted(rows, **options)
    assert {(r["word"], r["n"]) for r in words.collect()} == set(expected.items())
    result = spelling.variants(words)
    assert result.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    found = [tuple(r) for r in result.collect()]
    assert len(found) == len(set(found)) == len(expected)
    assert set(found) == grouped(expected)
    return found


def test_words_and_neighbours_equal_a_plain_search(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HELD_WORDS", 50)
    found = check(spark, texts(1, 30, 12), drop_every=31)
    assert any(form for _, form, *_ in found)


def test_awkward_rows(spark):
    check(spark, awkward() + awkward(), drop_every=31)
    check(spark, awkward() + texts(2, 5, 5), min_chars=1, min_count=1)
    assert spelling.variants(spelling.word_counts(frame(spark, awkward()[:3]))).isEmpty()


def test_equal_letters_ties_and_long_words(spark):
    long = "ab" * 4000
    words = {"aaaaaaa": 3, "aaaaaaaa": 30, "aaaaaaab": 30, "aaaaaba": 2, "aaaaaca": 1, "aaaaada": 1,
             long: 500, long + "a": 2, long[:-1]: 50, long[:4000] + "z" + long[4001:]: 5}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    assert {tuple(r) for r in spelling.variants(table).collect()} == grouped(words)


def test_chains_lead_to_one_root(spark):
    words = {"abcdefg": 10**6, "abcdefgh": 10**5, "abcdefghi": 10**4, "abcdefghij": 10**3,
             "abcdefghijk": 100, "abcdefghijkl": 10, "abcdefghijklm": 1}
    table = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    found = {r["word"]: r for r in spelling.variants(table).collect()}
    assert all(r["root"] == "abcdefg" for r in found.values())
    assert found["abcdefghijklm"]["form"] == "abcdefghijkl" and found["abcdefg"]["form"] is None
