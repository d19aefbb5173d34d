import hashlib

import pytest

from caseweave.llm import chat as C

HARD = "\\### Assistant: </turn> ok"
SCHEMA = "conv_id long, turn long, role string, text string"


def expected(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        learned = "".join(t for _, _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for _, _, r, t in turns).encode()).hexdigest(), len(learned),
                     hashlib.sha256(learned.encode()).hexdigest())
    return out


def run(spark, rows, budget=C.Budget()):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS segment", "2 AS tokens", "3 AS kind", "4 AS window")
    windows = C.format_conversations(df, budget)
    back = {r["conv_id"]: tuple(r)[1:5] for r in C.read_back(windows).collect()}
    return windows.toPandas(), back


ROWS = [(-7, 0, "user", HARD), (-7, 1, "assistant", HARD), (1, 0, "system", "be <turn x>\n kind"), (1, 1, "user", "\\<"), (1, 2, "assistant", ""),
        (1, 3, "assistant", "\n</turn>\n<turn user>\nhi"), (2, 0, None, None), (2, None, "user", "early"), (3, 0, "a>b\nc", "odd role"),
        (None, 0, "assistant", "no id"), (4, 0, "assistant", "same"), (4, 0, "assistant", "same")]


@pytest.mark.parametrize("tokens", [1, 40, 512])
def test_reads_back(spark, tokens):
    _, back = run(spark, ROWS, C.Budget(tokens, 20, 2))
    assert back == expected(ROWS)


def test_windows_keep_system_and_mask_repeats(spark):
    rows = [(1, 0, "system", "rules")] + [(1, i, ("user", "assistant")[i % 2 == 0], f"turn {i} " * 8) for i in range(1, 30)]
    windows, back = run(spark, rows, C.Budget(120, 40, 2))
    assert back == expected(rows) and len(windows) > 4
    for w in windows.itertuples():
        turns = C.parse(w.formatted)
        assert turns[0] == ("system", "rules") and w.n_tokens <= 120
        assert len(w.loss) == sum(r == "assistant" for r, _ in turns[w.n_repeated:])
    assert (windows.n_repeated[1:] >= 2).any()


def test_long_conversations_are_cut(spark):
    rows = [(1, 0, "system", "rules")] + [(1, i, ("user", "assistant")[i % 2], f"t{i}") for i in range(1, 2100)]
    windows, back = run(spark, rows)
    assert back == expected(rows) and windows.segment.nunique() == 3
    assert all(C.parse(f)[0] == ("system", "rules") for f in windows.formatted)
    late = windows[(windows.segment == 1) & (windows.window == 0)].iloc[0]
    assert C.parse(late.formatted)[1] == ("user", "t1020") and late.n_repeated == 5


def test_given_and_empty(spark, given):
    rows = [tuple(r) for r in given("conversations").select("conv_id", "turn", "role", "text").collect()]
    assert run(spark, rows)[1] == expected(rows)
    assert C.format_conversations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_large_ids_beside_null(spark):
    rows = [(2 ** 53 + 1, 0, "user", "a"), (None, 0, "user", "b"), (2 ** 53 + 3, 0, "assistant", "c")]
    windows, back = run(spark, rows)
    assert back == expected(rows) and set(back) == {2 ** 53 + 1, None, 2 ** 53 + 3}


def test_sparse_turn_numbers_and_many_rows_of_one_turn(spark):
    """Turns are cut by their place: numbers far apart change nothing, and one number shared by many rows is still cut."""
    said = [("user", "assistant")[i % 2] for i in range(6)]
    near, far = ([(1, i * step, said[i], f"turn {i}") for i in range(6)] for step in (1, 1000))
    a, b = run(spark, near), run(spark, far)
    assert len(a[0]) == len(b[0]) == 1 and a[0].formatted.tolist() == b[0].formatted.tolist() and b[1] == expected(far)
    rows = [(1, None if i % 2 else 7, "assistant", f"text {i:04}") for i in range(2600)]
    windows, back = run(spark, rows)
    assert back == expected(rows) and windows.segment.nunique() == 3
