"""Token counts of a unigram tokenizer, without making the tokens."""

from __future__ import annotations

import functools
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import documents, vocabulary_file

SPACE = "\u2581"
UNKNOWN_PENALTY = 10.0  # fixed value of unigram tokenizers: an unknown character scores this much below the least piece
MEMO = 400_000
LONG = 200  # longer words are not remembered


class Vocabulary(NamedTuple):
    pieces: list[tuple[str, float]]
    unknown: int


@functools.lru_cache(maxsize=2)
def vocabulary(path: str | None = None) -> Vocabulary:
    """Pieces and scores of a public model file (default piece_bpe_32k), by id."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path or vocabulary_file("piece_bpe_32k.model"))
    return Vocabulary([(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())], model.unk_id())


class Counter:
    """Counts the pieces of the best path: the highest sum of scores; of equal sums at an end, the piece with the
    earliest start. An unknown character costs as many pieces as it has UTF-8 bytes (byte fallback)."""

    def __init__(self, v: Vocabulary):
        import ahocorasick

        self.found = ahocorasick.Automaton()
        for piece, score in v.pieces:
            if piece:
                self.found.add_word(piece, (len(piece), score))
        self.found.make_automaton()
        self.single = {piece for piece, _ in v.pieces if len(piece) == 1}
        self.unknown = min(score for _, score in v.pieces) - UNKNOWN_PENALTY
        self.memo: dict[str, int] = {}

    def word(self, word: str) -> int:
        """Matches come by rising end and, at one end, from the longest to the shortest; only a strictly better
        sum replaces an earlier one, so ties stay with the earliest start."""
        n, unknown = len(word), self.unknown
        best, pieces, at = [0.0] * (n + 1), [0] * (n + 1), 0

        def unseen(end: int, have: bool) -> None:
            """The last character as unknown, if it is no piece by itself: it starts last, so it wins no tie."""
            c = word[end - 1]
            if c not in self.single and (not have or best[end - 1] + unknown > best[end]):
                best[end], pieces[end] = best[end - 1] + unknown, pieces[end - 1] + len(c.encode("utf-8", "surrogatepass"))

        have = False
        for last, (length, score) in self.found.iter(word):
            end = last + 1
            if end != at:
                if at:
                    unseen(at, have)
                for gap in range(at + 1, end):
                    unseen(gap, False)
                at, have = end, False
            total = best[end - length] + score
            if not have or total > best[end]:
                best[end], pieces[end], have = total, pieces[end - length] + 1, True
        if at:
            unseen(at, have)
        for gap in range(at + 1, n + 1):
            unseen(gap, False)
        return pieces[n]

    def text(self, text: str) -> int:
        """Spaces become the space mark, one is put in front if there is none, and every mark starts a word."""
        if not text:
            return 0
        marked = text.replace(" ", SPACE)
        words = (marked[1:] if marked[0] == SPACE else marked).split(SPACE)
        memo = self.memo
        try:
            return sum([memo[w] for w in words])
        except KeyError:
            pass
        if len(memo) > MEMO:
            memo.clear()
        total = 0
        for w in words:
            n = memo.get(w)
            if n is None:
                n = self.word(SPACE + w)
                if len(w) <= LONG:
                    memo[w] = n
            total += n
        return total


@functools.lru_cache(maxsize=2)
def counter(path: str | None = None) -> Counter:
    return Counter(vocabulary(path))


def count(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, n_chars for every row of `docs`.

    The count is the number of ids that a unigram tokenizer over the same pieces and scores gives with words split
    at spaces and byte fallback. Matches of all pieces are enumerated by one automaton; a dynamic programme over
    ends carries the best sum and its number of pieces. Words seen before in a worker are looked up. Row by row: no shuffle.

    Null or empty text: 0 tokens. Null doc_id: counted, id null. Repeated rows are counted each. A text of one
    endless word takes time and memory in proportion to its length. Other columns are ignored.
    """
    @F.pandas_udf("long")
    def tokens(texts: pd.Series) -> pd.Series:
        c = counter(path)
        return pd.Series([c.text(t) for t in texts], dtype="int64")

    return documents(docs).select("doc_id", tokens("text").alias("n_tokens"), F.char_length("text").cast("long").alias("n_chars"))
