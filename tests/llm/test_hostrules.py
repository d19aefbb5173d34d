import re

from caseweave.llm import hostrules as H

LONG = " ".join(f"w{i}" for i in range(60))


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    again = {w for w in windows if windows.count(w) > 1}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    covered = {i + k for i, w in enumerate(windows) if w in again for k in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), len(lines))


def test_statistics(given):
    texts = ["", " ", "a", "a b c a b c", "x\n\nx\n \nx", "a b c\x1c d", "a b a b a b a", "é|é|<#>\r\nb\x0b", "a a a a"]
    texts += [r["text"] for r in given("documents").limit(60).collect() if len(r["text"]) < 4_000]
    for t in texts:
        assert H.text_statistics(t) == brute(t), t[:80]


def test_host_rates_shrink_and_reject(docs):
    rows = [(i, LONG, "https://user@Good.example/x") for i in range(40)] + [(100 + i, "short", "bad.example") for i in range(40)]
    rows += [(200, LONG, "bad.example:80/y"), (300, "short", "tiny.example"), (301, LONG, "tiny.example"), (302, LONG, "tiny.example"), (400, LONG, None)]
    out = {r["doc_id"]: r for r in H.judge(docs(rows)).collect()}
    assert out[0]["host"] == "good.example" and out[0]["kept"]
    assert not out[200]["base_failed"] and not out[200]["kept"]  # its host fails
    assert out[301]["kept"] and 0 < out[301]["host_rate"] < 0.5
    assert out[300]["base_failed"] and not out[300]["kept"]
    assert out[400]["host"] == ""
    kept = H.keep(docs(rows))
    assert kept.columns == docs(rows).columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in out.items() if r["kept"]}


def test_edges(docs):
    rows = [(1, None, "a"), (2, "", "a"), (None, LONG, "a"), (3, LONG, "a"), (3, LONG, "a"), (4, "x# " * 60, "b"), (5, "\n".join([LONG[:40]] * 9), "b")]
    out = H.judge(docs(rows)).collect()
    assert len(out) == len(rows)
    first = {r["doc_id"]: r for r in out}
    assert first[1]["n_words"] == 0 and first[1]["base_failed"] and first[None]["kept"] in (True, False)
    assert set(first[4]["failed_rules"]) == {"repetitive", "symbols"} and "dup_lines" in first[5]["failed_rules"]
    assert H.judge(docs([])).count() == 0 and H.keep(docs([])).count() == 0
