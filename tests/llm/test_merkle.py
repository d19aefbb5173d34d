import hashlib
import zlib

import pytest

from caseweave.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(leaves):
    """(root, list of siblings per leaf) level by level."""
    nodes, under, proofs = list(leaves), [[i] for i in range(len(leaves))], [[] for _ in leaves]
    while len(nodes) > 1:
        up, below = [], []
        for i in range(0, len(nodes), 2):
            run, of = nodes[i:i + 2], under[i:i + 2]
            for side, members in enumerate(of):
                for m in members:
                    proofs[m].append((side, run[1 - side]) if len(run) == 2 else None)
            up.append(digest(*run))
            below.append(sum(of, []))
        nodes, under = up, below
    return nodes[0], proofs


def brute(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    grouped = {g: sorted((r for r in rows if r[2] == g), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r))) for g in langs}
    trees = {g: tree([leaf_of(r) for r in grouped[g]]) for g in langs}
    root, above = tree([trees[g][0] for g in langs])
    out = []
    for g, upper in zip(langs, above):
        for row, proof in zip(grouped[g], trees[g][1]):
            proof = proof + upper
            changed = row[0] is not None and row[3] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            fold = leaf_of((*row[:3], row[3] + 1, row[4])) if changed else leaf_of(row)
            for step in proof:
                fold = digest(fold) if step is None else digest(fold, step[1]) if step[0] == 0 else digest(step[1], fold)
            out.append((row[0], leaf_of(row), trees[g][0], root, digest(*[s[1] for s in proof if s]), fold, fold == root))
    return sorted(out, key=str)


def got(spark, rows, block=12):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS idx", "'x' AS tree", "2 AS n", "3 AS seg", "4 AS key", "5 AS leaf", "6 AS root")
    return sorted((tuple(r) for r in merkle.audit(df, block=block).collect()), key=str)


@pytest.mark.parametrize("block", [12, 2])
def test_against_brute_force(spark, block):
    rows = [(i * 3, f"s{i % 5}", ["en", "de", "fr", "é", "z"][i % 5] if i % 2 else "en", i, f"text {i}") for i in range(77)]
    rows += [(500, None, None, None, None), (501, "", "", 0, ""), (None, "a", "en", 3, "no id"), (502, "s", "lonely", 9, "x" * 200_000)]
    rows += [(7, "s", "en", 1, "same")] * 5 + [(7, "s", "en", 1, "other text, same id"), (7, "s", "en", None, None)]
    assert got(spark, rows, block) == brute(rows)


@pytest.mark.parametrize("n", [1, 2, 9])
def test_sizes(spark, n):
    rows = [(i, "s", "en", i, "t") for i in range(n)]
    assert got(spark, rows) == brute(rows)


def test_empty(spark):
    df = merkle.audit(spark.createDataFrame([], SCHEMA))
    assert df.count() == 0 and df.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_only_altered_rows_fail(spark, given):
    found = {r["doc_id"]: r["verified"] for r in merkle.audit(given("documents")).collect()}
    assert {i for i, ok in found.items() if not ok} == {i for i in found if zlib.crc32(str(i).encode()) % 7 == 0}


def test_trees_are_built_without_python_workers(spark):
    leaves = spark.createDataFrame([(0, 0, 3, "a"), (0, 1, 3, "b"), (0, 2, 3, "c")], "tree long, idx long, n long, digest string")
    nodes = merkle.grown(leaves.withColumn("level", merkle.F.lit(0)), 12)
    assert "Python" not in (plan := nodes._jdf.queryExecution().executedPlan().toString()) and "Pandas" not in plan
    ab, cc = digest("a", "b"), digest("c")
    assert sorted((r["level"], r["idx"], r["digest"], r["seg"]) for r in nodes.collect()) == [
        (0, 0, "a", ["Rb"]), (0, 1, "b", ["La"]), (0, 2, "c", [""]), (1, 0, ab, ["R" + cc]), (1, 1, cc, ["L" + ab]), (2, 0, digest(ab, cc), None)]
