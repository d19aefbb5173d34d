import re
import zlib
from collections import Counter
from itertools import combinations

from hypothesis import given as cases, settings, strategies as st

from caseweave.llm import permuterm


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(words, ratio=5):
    beside = {w: [] for w in words}
    for a, b in combinations(words, 2):
        if near(a, b):
            beside[a].append(b)
            beside[b].append(a)
    form = {}
    for w, found in beside.items():
        best = min(found, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, words[w], len(beside[w]), words[form[w]] if form[w] else None))
    return out


def got(spark, words, **more):
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    return {tuple(r) for r in permuterm.variants(df, **more).collect()}


def test_edits_ties_and_chains(spark):
    words = {"running": 5, "runing": 25, "runnings": 125, "sunning": 125, "runningé": 5, "aaaaaa": 5, "aaaaaaa": 30, "baaaaaa": 30, "zebras": 9,
             "étoile": 5, "etoile": 100, "x" * 64: 5, "x" * 65: 30, "x" * 63 + "y": 5, "x" * 64 + "y": 5, "w" * 3000: 5, "w" * 2999 + "v": 30}
    assert got(spark, words) == brute(words)
    assert got(spark, {}) == set()


def test_random_words(spark):
    @settings(max_examples=4, deadline=None)
    @cases(st.dictionaries(st.text("abé", min_size=6, max_size=8), st.integers(5, 5000), min_size=60, max_size=150))
    def check(words):
        assert got(spark, words) == brute(words)
    check()


def count(rows, every=199):
    seen = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            seen[run] += 1
    return {w: n for w, n in seen.items() if len(w) >= 6 and n >= 5}


def test_counts(spark, docs):
    text = "Kelvin Kelvin İstanbul Études éTUDES naïveté straße123weiter a×b÷cdefg underscore_words x" + " Letter's" * 3
    rows = [(i, text) for i in range(40)] + [(None, text), (7, None), (8, ""), (9, "longest " * 40_000), (9, "longest again"), (10, "\n\t ")]
    assert {tuple(r) for r in permuterm.word_counts(docs(rows), slips=3).collect()} == set(count(rows, 3).items())
    assert permuterm.word_counts(docs(rows).limit(0)).count() == 0


def test_given_documents(spark, given):
    rows = [(r["doc_id"], r["text"]) for r in given("documents").select("doc_id", "text").collect()]
    words = count(rows)
    assert {tuple(r) for r in permuterm.variants(permuterm.word_counts(given("documents"), slips=199)).collect()} == brute(words)
