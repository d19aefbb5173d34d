import random

import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from caseweave.llm import unigram as U


@pytest.fixture(scope="module")
def tokenizer():
    v = U.vocabulary()
    t = Tokenizer(models.Unigram(v.pieces, v.unknown, byte_fallback=True))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement=U.SPACE, prepend_scheme="always", split=True)
    return t


def test_equals_the_tokenizer(tokenizer, given):
    rng, counter = random.Random(0), U.Counter(U.vocabulary())
    texts = ["", " ", "  a", "a ", U.SPACE, "<s>", "<0x0A>", "<unk>", "漢字" * 30, "a" * 3000, "x\n\ny\t", "😀é"]
    texts += ["".join(rng.choice("ab  ▁é\n<s>x0A漢😀\t.") for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    texts += [r["text"] for r in given("documents").limit(80).collect()]
    assert [counter.text(t) for t in texts] == [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]


def test_ties_and_unknowns():
    v = U.Vocabulary([("<unk>", 0.0), (U.SPACE, -1.0), ("a", -1.0), ("aa", -2.0), ("b", -9.0)], 0)
    t = Tokenizer(models.Unigram(v.pieces, 0))
    c = U.Counter(v)
    for word in ("aa", "aaa", "aaaa", "ab", "ba", U.SPACE + "aa"):
        assert c.word(word) == len(t.encode(word).ids), word
    assert c.word("é") == 2  # by its bytes


def test_edges(docs):
    out = [tuple(r) for r in U.count(docs([(1, None), (2, ""), (None, "a b"), (3, "a b"), (3, "a b")])).orderBy("doc_id").collect()]
    assert out == [(None, 2, 3), (1, 0, 0), (2, 0, 0), (3, 2, 3), (3, 2, 3)]
    assert U.count(docs([])).count() == 0
