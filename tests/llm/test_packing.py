import zlib

import numpy as np
import pandas as pd
import public_tokenizers
from tokenizers import Tokenizer

from caseweave.llm import packing as P


def check(pieces: pd.DataFrame, texts: dict, capacity=2048):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for doc, own in pieces.groupby("doc_id"):
        ids = np.array(t.encode(texts[doc], add_special_tokens=False).ids + [1], "<u4")
        own = own.sort_values("start")
        assert (own.doc_tokens == len(ids)).all()
        assert own.start.tolist() == [0, *own.length.cumsum()[:-1]] and own.length.sum() == len(ids)
        assert [zlib.crc32(ids[s:s + n].tobytes()) for s, n in zip(own.start, own.length)] == own.ids_crc32.tolist()
    for _, s in pieces.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert s.offset.tolist() == [0, *s.length.cumsum()[:-1]] and s.length.sum() <= capacity


def test_given_documents(given):
    pieces = P.pack(given("documents")).toPandas()
    texts = {r["doc_id"]: r["text"] for r in given("documents").collect()}
    assert set(pieces.doc_id) == set(texts)
    check(pieces, texts)
    assert pieces.length.sum() / (2048 * pieces.sequence_id.nunique()) > 0.98


def test_edges(docs):
    rows = [(1, None), (2, ""), (3, "<|endoftext|> a"), (4, "word " * 50_000)]
    pieces = P.pack(docs(rows).repartition(1)).toPandas()
    check(pieces, {1: "", 2: "", 3: rows[2][1], 4: rows[3][1]})
    twice = P.pack(docs([(5, "a b"), (5, "a b"), (None, "a")])).toPandas()
    assert len(twice) == 3 and twice.doc_id.isna().sum() == 1
    assert P.pack(docs([])).count() == 0


def test_large_ids_beside_null(docs):
    big = 2 ** 53 + 1
    pieces = P.pack(docs([(big, "a b"), (None, "c"), (big + 2, None)]).repartition(1)).collect()
    assert {r["doc_id"] for r in pieces} == {big, None, big + 2}


def test_balance():
    rng = np.random.default_rng(3)
    lengths = [int(x) for x in rng.integers(1, 2048, 3000)]
    placed = P.balance(lengths, 2048, 1.0, 1 / 1024)
    bins = pd.DataFrame(placed, columns=["item", "start", "length", "bin", "offset"])
    assert bins.groupby("item").length.sum().tolist() == lengths
    loads = bins.groupby("bin").length.sum()
    assert loads.max() <= 2048 and len(loads) == -(-sum(lengths) // 2048)
    cost = bins.assign(cost=bins.length + bins.length ** 2 / 1024).groupby("bin").cost.sum()
    in_order = pd.Series(lengths).cumsum() // 2048
    plain = pd.DataFrame({"bin": in_order, "cost": pd.Series(lengths) + pd.Series(lengths) ** 2 / 1024}).groupby("bin").cost.sum()
    assert cost.std() < plain.std()  # against filling in the given order
    assert P.balance([], 2048, 1, 1) == [] and P.balance([5, 5], 8, 1, 1) == [(0, 0, 5, 0, 0), (1, 0, 5, 1, 0)]
