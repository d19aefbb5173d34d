import hashlib
import random
import re

from caseweave.llm import secrets
from caseweave.llm.common import bpe_encoder

rng = random.Random(5)
KEY = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(36))


def plain(text):
    """The base patterns as the contract words them."""
    text, spans = text or "", []
    for kind, pattern, group, least in (
            ("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
            ("access", r"AKIA[A-Z0-9]+", 0, 20), ("hex", r"[0-9a-f]+", 0, 24)):
        spans += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text, re.A) if len(m.group(group)) >= least]
    spans.sort(key=lambda s: (s[0], ("assign", "access", "hex").index(s[1])))
    return ",".join(f"{k}:{s}:{e}" for s, k, e in spans)


def test_base_spans_of_given_documents(given):
    texts = {r["doc_id"]: r["text"] for r in given("documents").collect()}
    rows = secrets.scan(given("documents")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(r["spans"].split(","))
        assert r["n_assign"] == base.count("assign:") and r["n_access"] == base.count("access:") and r["n_hex"] == base.count("hex:")


def test_clean_documents_have_no_random_spans(given):
    assert secrets.scan(given("documents")).filter("n_random > 0").count() == 0


def test_cases():
    enc = bpe_encoder()
    spans = lambda t: secrets.written(secrets.find(t, enc)[1])
    assert spans("") == ""
    assert spans("token:token:abcdefg") == ""  # the first match fails and has used up the second keyword
    assert spans("é PASSWORD = 'abc123'") == "assign:2:20"  # up to the closing quote
    assert spans("token=abc") == "" and spans("paſſword=abcdef") == ""
    assert spans("x=" + "a1" * 12) == "hex:2:26"
    assert spans(f"use {KEY} now") == f"random:4:{4 + len(KEY)}"
    assert spans(f"sha256: {KEY}") == "" and spans(f"https://a.example/{KEY}") == ""
    assert spans("id 123e4567-e89b-12d3-a456-426614174000 and D41D8CD98F00B204E9800998ECF8427E") == ""
    assert spans("call 0049-170-1234567890-12, 2024-01-02T00_00") == ""
    assert spans("internationalization2internationalization") == ""
    assert spans("AKIA" + "Z" * 15) == "" and spans("AKIA" + "Z" * 16) == "access:0:20"


def test_addresses_before_a_secret():
    enc = bpe_encoder()
    key = "q7RzP4kX9vLm2TnB8wYc"

    def found(text):
        return [text[s:e] for s, _, e in secrets.find(text, enc)[1]]

    for text in ('{"url":"https://api.example.com","key":"%s"}', "https://host/services/T0A1?sig=%s", "https://host/a?x=1&sig=%s&y=2",
                 "2024/01/02,https://a.example/b,%s,x", "https://user:%s@host.example/a", "https://%s@host.example/a", "<a href=/x/y>%s</a>"):
        assert [f.lstrip("/") for f in found(text % key)] == [key], text
    for text in ("https://a.example/b.c/%s", "http://localhost:8080/%s", "www.a.example/%s", "mail %s@a.example"):
        assert found(text % key) == [], text
    assert found("https://a.example/x?id=123e4567-e89b-12d3-a456-426614174000&etag=D41D8CD98F00B204E9800998ECF8427E") == []
    late = "qRzPkXvLmTnBwYcGhJdKsWqZxCvBnMtYrEwQaSdFgHjKlPq7" + key  # the first digit comes late
    assert found(f"use {late} now") == [late]


def test_edges(docs, spark):
    rows = {r["doc_id"]: r for r in secrets.scan(docs([(1, None), (2, ""), (None, "token=abcdef"), (3, "word " * 200_000 + "token=abcdef")])).collect()}
    assert rows[1]["spans"] == rows[2]["spans"] == "" and rows[None]["n_assign"] == 1
    assert rows[3]["spans"] == "assign:1000000:1000012"
    assert secrets.scan(docs([])).count() == 0


def test_redact(docs):
    given = docs([(1, f"a token=abcdef b {KEY}"), (2, "clean"), (3, None), (4, "secret:" + "0a" * 15)])
    out = {r["doc_id"]: r for r in secrets.redact(given).collect()}
    assert secrets.redact(given).columns == given.columns
    assert out[1]["text"] == "a [SECRET] b [SECRET]" and out[1]["n_chars"] == 21
    assert out[2]["text"] == "clean" and out[3]["text"] is None and out[4]["text"] == "[SECRET]"


def test_context_of_any_length():
    """A path is one, however long; the name of a digest is a word of its own with a sign behind it; letters alone are enough."""
    enc = bpe_encoder()
    key = "q7RzP4kX9vLm2TnB8wYc"
    letters = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz") for _ in range(40))

    def found(text):
        return [text[s:e] for s, _, e in secrets.find(text, enc)[1]]

    for n in (1, 150, 199, 200, 201, 5000):
        assert found("https://a.example/" + "part.of~" * n + "/" + key) == []
        assert found("/" + "part.of~" * n + key) == [] and found("part.of~" * n + key) == [key]
        assert found("commit:" + " " * n + key) == [] and found("x" + " " * n + key) == [key]
        assert found("https://" + "some.user." * n + ":" + key + "@host") == [key]
    for text in ("the prev %s", "we rehash %s", "commit %s", "hash of %s", "prehash: %s"):
        assert found(text % key) == [key], text
    for text in ("commit: %s", 'integrity="%s"', "sha256-%s", "file_hash = '%s'", "path /x/%s", "md5=%s"):
        assert found(text % key) == [], text
    assert found(f"use {letters} now") == [letters]
    low = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(40))
    assert found(low) == [low] and found(low[:31]) == [] and found(low[:20] + "-" + low[20:]) == []  # shorter ones pass for words
    assert found("Rechtsschutzversicherungsgesellschaften " + "-=" * 30 + " electroencefalografista") == []


def brute_path(text, place):
    return bool(re.search(r"(?:www\.|/)[\w./~%@+$-]*$", text[:place], re.I))


def test_paths_against_a_search_of_the_whole_text():
    for _ in range(300):
        text = "".join(rng.choice(["a", ".", "/", " ", "w", "www.", ":", "=", "-", "é"]) for _ in range(60))
        paths = secrets.Paths(text)
        for place in sorted(rng.sample(range(len(text) + 1), 12)):
            assert paths.goes_on(place) == brute_path(text, place), (text, place)
