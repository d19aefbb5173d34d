import hashlib
import math
from collections import defaultdict

import pytest

from caseweave.llm import mixing as M


def brute(rows, entropy, repetition, budget=None, seed=7):
    """The whole mix in plain Python, with a bisection of its own."""
    h = lambda *p: int(hashlib.md5(":".join([str(seed), *["" if x is None else str(x) for x in p]]).encode()).hexdigest()[:15], 16)
    by = defaultdict(list)
    for doc, text, source in rows:
        by[source or ""].append((h(doc), max(1, math.ceil(len((text or "").encode()) / 4)), doc))
    total = {s: sum(t for _, t, _ in v) for s, v in by.items()}
    share = {s: t / sum(total.values()) for s, t in total.items()}

    def fits(e):
        z = sum(x ** e for x in share.values())
        return -sum(x ** e / z * math.log(x ** e / z) for x in share.values()) >= entropy * math.log(len(share))

    def broken(e):
        return (max(share.values()) / min(share.values())) ** (1 - e) > repetition

    low, high = 0.0, 1.0
    for _ in range(60 if len(by) > 1 else 0):
        middle = (low + high) / 2
        low, high = (middle, high) if fits(middle) or broken(middle) else (low, middle)
    e = low if len(by) > 1 else 1.0
    w = {s: x ** e for s, x in share.items()}
    z = sum(w.values())
    budget = max(total[s] / w[s] for s in w) * z if budget is None else budget
    out = []
    for s, docs in by.items():
        epochs, left = divmod(int(w[s] / z * budget + 1e-2), total[s])
        out += [(d, e) for e in range(epochs) for _, _, d in docs]
        for _, _, t, d in sorted((h(s, epochs, x >> 52), x >> 52, t, (x, d)) for x, t, d in docs):
            pass
        run = 0
        for _, x, t, d in sorted((h(s, epochs, x >> 52), x, t, d) for x, t, d in docs):
            run += t
            if run <= left:
                out.append((d, epochs))
    return sorted(out, key=str), e


def rows_of(sizes):
    return [(10_000 * k + i, "x" * (1 + (i * 37) % 211), f"s{k}") for k, n in enumerate(sizes) for i in range(n)]


@pytest.mark.parametrize("entropy,repetition,budget", [(0.97, 2.0, None), (0.9, 100.0, None), (1.0, 3.5, None), (0.95, 5.0, 4000), (0.95, 5.0, 90_000)])
def test_against_brute_force(docs, entropy, repetition, budget):
    rows = rows_of([900, 120, 60, 300])
    got = M.mix(docs(rows), entropy, repetition, budget).select("doc_id", "_mix.epoch").collect()
    want, _ = brute(rows, entropy, repetition, budget)
    assert sorted((tuple(r) for r in got), key=str) == want


def test_nothing_lost_and_limit_kept(docs):
    rows = rows_of([2000, 30, 10])
    out = M.mix(docs(rows), 1.0, 2.0)
    assert out.drop("_mix").columns == [c for c in docs(rows).columns if c != "_mix"]
    counts = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert set(counts) == {r[0] for r in rows} and max(counts.values()) <= 2


def test_edges(docs):
    rows = [(1, None, None), (1, None, None), (2, "", "a"), (None, "abc", "a"), (3, "abcd" * 9, "b")]
    counts = {r["doc_id"]: r["count"] for r in M.mix(docs(rows), 0.9, 4.0).groupBy("doc_id").count().collect()}
    assert set(counts) == {1, 2, 3, None}
    assert M.mix(docs([])).count() == 0
    one = M.mix(docs(rows_of([50])))
    assert one.count() == 50


def test_plan_has_no_python(docs):
    plan = M.mix(docs(rows_of([50, 20])))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_epochs_are_permutations_of_their_own(docs):
    rows = rows_of([600, 40])
    mixed = M.mix(docs(rows), 1.0, 3.0)
    order = [tuple(r) for r in mixed.filter("source = 's1'").orderBy("_mix.epoch", "_mix.block", "_mix.turn").select("_mix.epoch", "doc_id").collect()]
    first, second = ([d for e, d in order if e == n] for n in (0, 1))
    assert sorted(first) == sorted(second) and first != second
    written = [r["doc_id"] for r in M.in_order(mixed).collect()]
    places = {}
    for place, doc in enumerate(written):
        places.setdefault(doc, []).append(place)
    apart = [b - a for p in places.values() for a, b in zip(p, p[1:])]
    assert apart and min(apart) > 1 and sorted(written) == sorted(r["doc_id"] for r in mixed.collect())
