import random
from collections import Counter
from difflib import SequenceMatcher

import numpy as np
import pytest

from caseweave.llm import omh as O

rng = random.Random(4)
WORDS = [f"w{i}" for i in range(4000)]


def text(n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def edited(t, edits):
    words = t.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = rng.choice(WORDS)
    return " ".join(words)


def cut(t, k=5):
    words = t.split()
    return Counter(tuple(words[i:i + k]) for i in range(max(len(words) - k + 1, 1))) if words else Counter()


def similar(x, y):
    """Multiset shingle similarity; equal to the aligned one where the order of shared shingles is the same."""
    if not x or not y:
        return not x and not y
    small, large = sorted((x, y), key=len)
    both = sum(min(n, large[w]) for w, n in small.items() if w in large)
    return both >= 0.8 * (x.total() + y.total() - both)


def jaccard(a, b):
    x, y = cut(a), cut(b)
    return (x & y).total() / (x | y).total()


def brute_classes(rows):
    rows = sorted((i, t or "") for i, t in rows if i is not None)
    parent = {i: i for i, _ in rows}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    cuts = [(i, cut(t)) for i, t in rows]
    for n, (i, x) in enumerate(cuts):
        for j, y in cuts[:n]:
            if min(x.total(), y.total()) >= 0.8 * max(x.total(), y.total()) and similar(x, y):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: find(i) for i, _ in rows}


def test_alignment():
    a = text(200)
    x = O.labelled_shingles(a, 5)
    assert len(set(x.tolist())) == len(x) == 196
    assert O.aligned(x, x, 0.8) and not O.aligned(x, O.labelled_shingles(text(200), 5), 0.8)
    words = a.split()
    moved = O.labelled_shingles(" ".join(words[100:] + words[:100]), 5)
    assert not O.aligned(x, moved, 0.8)  # the same shingles in another order
    assert len(set(O.labelled_shingles("a " * 50, 5).tolist())) == 46
    empty = O.labelled_shingles(" ", 5)
    assert len(empty) == 0 and O.aligned(empty, empty, 0.8) and not O.aligned(empty, x, 0.8)
    for edits in (2, 4, 6, 8, 10):
        b = edited(a, edits)
        assert O.aligned(x, O.labelled_shingles(b, 5), 0.8) == (jaccard(a, b) >= 0.8)


def test_order_matters_in_sketches():
    x = O.labelled_shingles(text(60), 5)
    assert not (O.sketches(x, 24, 4) == O.sketches(x[::-1].copy(), 24, 4)).any()
    assert (O.sketches(x, 24, 4) == O.sketches(x.copy(), 24, 4)).all()
    h = np.random.default_rng(0).integers(0, 2**63, (9, 500), dtype=np.uint64) * np.uint64(2)
    assert (np.sort(O.smallest(h, 4), axis=1) == np.sort(np.argsort(h, axis=1)[:, :4], axis=1)).all()


def test_classes_against_brute_force(spark, docs):
    rows, n = [], 0
    for _ in range(12):
        base = text(rng.randint(30, 300))
        for edits in (0, 0, 1, 2, 4, 8, 20):
            rows.append((n, edited(base, edits)))
            n += 1
    chain = text(300)  # each like the one before it, the ends unlike
    for _ in range(8):
        rows.append((n, chain))
        chain, n = edited(chain, 4), n + 1
    passage = text(40)  # shared by texts that are not alike
    rows += [(n + i, passage + " " + text(60)) for i in range(30)]
    rows += [(2000, None), (2001, ""), (2002, " \n"), (2003, "a b"), (2004, "a  b"), (2005, "b a"), (None, "a b")]
    got = O.classes(docs(rows)).collect()
    assert len(got) == len(rows) and sum(r["class_id"] is None for r in got) == 1
    want = brute_classes(rows)
    assert {r["doc_id"]: r["class_id"] for r in got if r["doc_id"] is not None} == want
    sizes = Counter(want.values())
    assert all(r["class_size"] == sizes[r["class_id"]] for r in got if r["doc_id"] is not None)


def test_given_documents_against_brute_force(spark, given):
    rows = [(r["doc_id"], r["text"]) for r in given("documents").collect()]
    got = {r["doc_id"]: r["class_id"] for r in O.classes(given("documents")).collect()}
    assert got == brute_classes(rows)


def test_keep_one_and_edges(docs):
    rows = [(5, "a b c d e f"), (3, "a b c d e f"), (9, "x y"), (9, "x y"), (None, "a b c d e f"), (1, None), (2, "")]
    kept = O.keep_one(docs(rows))
    assert kept.columns == docs(rows).columns
    assert sorted(kept.select("doc_id").toPandas()["doc_id"].fillna(-1)) == [-1, 1, 3, 9]
    assert O.classes(docs([])).count() == 0 and O.keep_one(docs([])).count() == 0


def test_components(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 300), (200, 300)]
    nodes = spark.createDataFrame([(i,) for i in [*range(41), 100, 200, 300, 7777]], "node long")
    got = {r["node"]: r["comp"] for r in O.components(nodes, spark.createDataFrame(pairs, "a long, b long"), "t").collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 200: 100, 300: 100, 7777: 7777}


def test_different_texts_under_one_id(docs):
    """A text goes only if its own class has a smaller document, whatever else stands under its id."""
    a, b, c = (" ".join(f"{w}{i}" for i in range(60)) for w in "abc")
    rows = [(3, a), (9, a), (9, b), (9, b), (4, c), (11, c + " more"), (None, a), (12, a)]
    kept = sorted((tuple(r) for r in O.keep_one(docs(rows)).select("doc_id", "text").collect()), key=str)
    assert kept == sorted([(3, a), (9, b), (4, c), (None, a)], key=str)
    found = sorted((tuple(r) for r in O.classes(docs(rows)).collect()), key=str)
    assert found == sorted([(3, 3, 3), (9, 3, 3), (12, 3, 3), (9, 9, 1), (4, 4, 2), (11, 4, 2), (None, None, None)], key=str)
