"""Cost-balanced packing of token ids into fixed-length training sequences."""

from __future__ import annotations

import functools
import zlib

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import bpe_encoder, documents, vocabulary_file

END_ID = 1
SPECIAL = "<|endoftext|>"
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "cost double")


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str | None):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path or vocabulary_file("byte_bpe_50k.json"))


def document_ids(text: str, ranks: str | None = None, tokenizer: str | None = None) -> np.ndarray:
    """The ids of a text, with the closing id. A text that names a special token goes to the full tokenizer,
    which knows it; all others take the faster encoder of the same vocabulary, with the same ids."""
    if SPECIAL in text:
        ids = np.array(_tokenizer(tokenizer).encode(text, add_special_tokens=False).ids, "<u4")
    else:
        ids = bpe_encoder(ranks).encode_to_numpy(text, allowed_special=set(), disallowed_special=())
    return np.append(ids, END_ID).astype("<u4")


def balance(lengths: list[int], capacity: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """(item, start, length, bin, offset) for items shorter than `capacity`.

    As few bins as the sum allows. Items go in descending length (ties: first come) to the bin of lowest cost
    that still has room (ties: lower bin). What fits nowhere is cut over the bins with the most room left.
    """
    n = -(-sum(lengths) // capacity)
    room, cost, out, rest = np.full(n, capacity), np.zeros(n), [], []

    def put(item, start, length, b):
        out.append((item, start, length, int(b), int(capacity - room[b])))
        room[b] -= length
        cost[b] += linear * length + quadratic * length * length

    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        b = int(np.argmin(np.where(room >= lengths[item], cost, np.inf)))
        if room[b] >= lengths[item]:
            put(item, 0, lengths[item], b)
        else:
            rest.append(item)
    for item in rest:
        start = 0
        while start < lengths[item]:
            b = int(np.argmax(room))
            length = int(min(room[b], lengths[item] - start))
            put(item, start, length, b)
            start += length
    return out


def pack(docs: DataFrame, capacity: int = 2048, window: int = 4096, linear: float = 1.0,
         quadratic: float = 1 / 1024, ranks: str | None = None, tokenizer: str | None = None) -> DataFrame:
    """Pieces of documents in sequences of at most `capacity` tokens.

    A task reads its rows once. A document's full stretches of `capacity` ids are sequences of their own. The
    remainders wait in a buffer of `window` documents; then `balance` spreads them, with an estimated cost of
    linear * n + quadratic * n^2 for a piece of n tokens (attention stays inside a piece). All of a window's
    sequences but the last few are full, so padding is less than one sequence per window and task. No shuffle;
    memory is one batch and one window of ids. sequence_id holds the task's partition in its high bits.

    Null or empty text: only the closing id. Null doc_id: packed, with a null id. Repeated rows: packed each.
    Empty table: no rows. Other columns are ignored.
    """
    def run(batches):
        first = TaskContext.get().partitionId() << 40
        made = 0
        waiting, rows = [], []

        def flush():
            nonlocal made
            for item, cut, length, b, offset in balance([len(w[2]) for w in waiting], capacity, linear, quadratic):
                doc, start, ids, total = waiting[item]
                rows.append((doc, start + cut, length, zlib.crc32(ids[cut:cut + length].tobytes()), total,
                             first + made + b, offset, linear * length + quadratic * length * length))
            made += -(-sum(len(w[2]) for w in waiting) // capacity)
            waiting.clear()

        def frame():
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in PIECES.split(", ")])
            rows.clear()
            return out

        for batch in batches:
            for doc, text in zip(batch["doc_id"], batch["text"]):
                ids = document_ids(text, ranks, tokenizer)
                total = len(ids)
                full = total - total % capacity
                for start in range(0, full, capacity):
                    rows.append((doc, start, capacity, zlib.crc32(ids[start:start + capacity].tobytes()), total,
                                 first + made, 0, linear * capacity + quadratic * capacity * capacity))
                    made += 1
                if full < total:
                    waiting.append((doc, full, ids[full:].copy(), total))
                if len(waiting) >= window:
                    flush()
            yield frame()
        flush()
        yield frame()

    # Ids travel as text: pandas would make a column of longs with a null one of doubles.
    rows = documents(docs).withColumn("doc_id", F.col("doc_id").cast("string"))
    return rows.mapInPandas(run, PIECES.replace("doc_id long", "doc_id string")).withColumn("doc_id", F.col("doc_id").cast("long"))
