"""TF-IDF as tables: (document, term, weight) rows instead of a matrix.

Texts are spread by document id once, after they are cut into tokens and before these are combined
to n-grams. Counting terms, weighting and normalising then happen inside that partitioning: only the
tokens cross the network, never the much larger n-gram rows.

Where all terms of a corpus are counted or weighted (`corpus_vocabulary`, `corpus_weights`), texts are dealt to parts and a part's
n-grams are numbers. What leaves a part is one row for each of its different terms, and only terms of several parts come back.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions import accents
from ..functions import text as X
from ..session import is_small, lookup_join, measured, size_measures


@dataclass(frozen=True)
class Analyzer:
    """How a text becomes terms."""

    kind: str = "word"  # or "char_wb"
    low: int = 1
    high: int = 1
    strip_accents: bool = True
    pattern: str = X.TOKEN
    max_features: int | None = None

    def prepare(self, c: Column) -> Column:
        """What is worth moving: the tokens, or for character n-grams the text."""
        return self.cut(self.fold(c))

    def fold(self, c: Column) -> Column:
        if self.kind == "char_wb":
            return c
        lowered = F.lower(c)
        return accents.strip_accents(lowered) if self.strip_accents else lowered

    def cut(self, folded: Column) -> Column:
        return folded if self.kind == "char_wb" else F.regexp_extract_all(folded, F.lit(self.pattern), F.lit(0))

    def terms(self, prepared: Column) -> Column:
        if self.kind == "char_wb":
            return X.char_wb_ngrams(prepared, self.low, self.high)
        return X.word_ngrams(prepared, self.low, self.high)


TASK_BYTES = 16 * 1024 * 1024
LEAST_BYTES = 1024 * 1024  # of text in a part, unless there is less


def term_counts(docs: DataFrame, doc: str, text: str, analyzer: Analyzer, tasks: int | None = None) -> DataFrame:
    """(doc, term, tf). A text without terms keeps one row with a null term.

    `tasks` is the number of parts that the texts are dealt to; by default one for every 16 MB of text, and no
    fewer than the session's shuffle partitions. It is explicit, or the small rows would be put back together before they grow.
    """
    if tasks is None:
        size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
        tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // TASK_BYTES))
    spread = docs.select(doc, analyzer.prepare(F.col(text)).alias("prepared")).repartition(tasks, doc)
    terms = spread.select(doc, F.explode_outer(analyzer.terms(F.col("prepared"))).alias("term"))
    return terms.groupBy(doc, "term").agg(F.count(F.lit(1)).alias("tf"))


def dealt(docs: DataFrame, doc: str, text: str, analyzer: Analyzer) -> tuple[DataFrame, int, tuple[int, int]]:
    """(part, doc, tokens), in as many partitions as parts, their number, and the n-gram sizes to make of the tokens.

    Rows of one document go to one part: 16 MB of text on average, or less where that would leave cores idle. Texts are folded before
    they move, which may take Python, and cut after: so nothing else moves until the parts are read.
    """
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    cores = docs.sparkSession.sparkContext.defaultParallelism
    parts = max(1, -(-size // TASK_BYTES), min(2 * cores, size // LEAST_BYTES))
    moved = docs.select(F.pmod(F.xxhash64(doc), F.lit(parts)).cast("int").alias("part"), F.col(doc).alias("doc"),
                        analyzer.fold(F.col(text)).alias("folded"))
    tokens = moved.repartition(parts, "part").select("part", "doc", analyzer.cut(F.col("folded")).alias("tokens"))
    if analyzer.kind == "word" and analyzer.pattern in (X.TOKEN, X.TOKEN_PLAIN):  # no token holds a space
        return tokens, parts, (analyzer.low, analyzer.high)
    return tokens.withColumn("tokens", analyzer.terms(F.col("tokens"))), parts, (1, 1)


def gram_functions(low: int, high: int):
    """What tasks do with the rows of a part; built inside a function, so that it travels to the executors by value."""
    def grams(rows):
        """For each size of n-grams its different terms, and (document, term, tf) as numbers; the documents."""
        lists = rows["tokens"]
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
        flat = pc.list_flatten(lists).combine_chunks().dictionary_encode()
        order = pc.sort_indices(flat.dictionary).to_numpy()  # neighbours begin alike, which is packed well
        words, place = flat.dictionary.take(pa.array(order)), np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        codes = place[flat.indices.to_numpy()]
        documents = rows["doc"].combine_chunks().dictionary_encode(null_encoding="encode")
        doc_of = np.repeat(documents.indices.to_numpy().astype(np.int64), sizes)
        left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(codes))  # tokens to the end of the row
        terms, at, out = words, codes, []
        for n in range(1, high + 1):
            if n > 1:
                begin = np.flatnonzero(left >= n)
                different, number = np.unique(at[begin] * len(words) + codes[begin + n - 1], return_inverse=True)
                terms = pc.binary_join_element_wise(terms.take(pa.array(different // max(1, len(words)))),
                                                    words.take(pa.array(different % max(1, len(words)))), " ")
                at = np.zeros(len(codes), dtype=np.int64)
                at[begin] = number
            if n >= low:
                begin = np.flatnonzero(left >= n)
                pairs, tf = np.unique(doc_of[begin] * max(1, len(terms)) + at[begin], return_counts=True)
                out.append((terms, pairs // max(1, len(terms)), pairs % max(1, len(terms)), tf))
        return out, documents.dictionary

    def stacked(columns):
        tables = pa.concat_tables([pa.table(c) for c in columns])
        return pa.Table.from_batches(tables.to_batches(max_chunksize=100_000), tables.schema)

    return grams, stacked


def term_parts(tokens: DataFrame, low: int, high: int) -> DataFrame:
    """(part, term, n, df): the different terms of every part, with their occurrences and documents there."""
    grams, stacked = gram_functions(low, high)

    def count(rows):
        found, _ = grams(rows)
        return stacked([{"part": pa.array(np.full(len(terms), rows["part"][0].as_py(), dtype=np.int32)), "term": terms,
                         "n": pa.array(np.bincount(term, tf, len(terms)).astype(np.int64)),
                         "df": pa.array(np.bincount(term, minlength=len(terms)).astype(np.int64))} for terms, _, term, tf in found])

    return tokens.groupBy("part").applyInArrow(count, "part int, term string, n long, df long")


def corpus_vocabulary(docs: DataFrame, doc: str, text: str, analyzer: Analyzer) -> DataFrame:
    """`vocabulary` of all terms of the documents: (term, n, df)."""
    tokens, _, sizes = dealt(docs, doc, text, analyzer)
    terms = term_parts(tokens, *sizes).groupBy("term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    return most_frequent(terms, analyzer.max_features)


def corpus_weights(docs: DataFrame, doc: str, text: str, analyzer: Analyzer, documents: int) -> DataFrame:
    """(doc, term, weight): `tfidf_weights` under the idf of all terms of the documents themselves.

    A part knows the frequency of a term that no other part has; of the others it is told.
    """
    tokens, parts, (low, high) = dealt(docs, doc, text, analyzer)
    everywhere = Window.partitionBy("term")
    shared = term_parts(tokens, low, high).select("part", "term", F.sum("df").over(everywhere).alias("df"), F.count(F.lit(1)).over(everywhere).alias("parts"))
    shared = shared.filter(F.col("parts") > 1).select("part", "term", "df").repartition(parts, "part")

    grams, stacked = gram_functions(low, high)

    def weigh(rows, told):
        found, names = grams(rows)
        square, parts_of = np.zeros(len(names)), []
        other, df_there = told["term"].combine_chunks(), told["df"].to_numpy()
        for terms, document, term, tf in found:
            df = np.bincount(term, minlength=len(terms))
            at = pc.index_in(terms, value_set=other)
            known = at.is_valid().to_numpy(zero_copy_only=False)
            df[known] = df_there[at.drop_null().to_numpy()]
            raw = (np.log(tf.astype(float)) + 1.0) * (np.log((documents + 1.0) / (df + 1.0)) + 1.0)[term]
            square += np.bincount(document, raw * raw, len(names))
            parts_of.append((terms, document, term, raw))
        return stacked([{"doc": names.take(pa.array(document)), "term": terms.take(pa.array(term)),
                         "weight": pa.array(raw / np.sqrt(square[document]))} for terms, document, term, raw in parts_of])

    schema = T.StructType([T.StructField("doc", docs.schema[doc].dataType), T.StructField("term", T.StringType()), T.StructField("weight", T.DoubleType())])
    return tokens.groupBy("part").cogroup(shared.groupBy("part")).applyInArrow(weigh, schema).withColumnRenamed("doc", doc)


def vocabulary(counts: DataFrame, max_features: int | None) -> DataFrame:
    """(term, n, df): the most frequent terms of the corpus; ties go to the smaller term."""
    terms = (counts.filter(F.col("term").isNotNull()).groupBy("term")
             .agg(F.sum("tf").alias("n"), F.count(F.lit(1)).alias("df")))
    return most_frequent(terms, max_features)


def most_frequent(terms: DataFrame, max_features: int | None) -> DataFrame:
    return terms if max_features is None else terms.orderBy(F.desc("n"), "term").limit(max_features)


def idf(vocab: DataFrame, documents: int) -> DataFrame:
    """Smoothed inverse document frequency."""
    return vocab.withColumn("idf", F.log((F.lit(documents) + 1.0) / (F.col("df") + 1.0)) + 1.0)


def fit_idf(counts: DataFrame, max_features: int | None, documents: int) -> tuple[DataFrame, bool]:
    """The idf table (term, idf), written once, and whether it may be broadcast."""
    table = idf(vocabulary(counts, max_features), documents).select("term", "idf")
    table, sizes = measured(table, "idf", **size_measures(table))
    return table, is_small(sizes)


def number_terms(vocab: DataFrame) -> DataFrame:
    """Give every term of a size-limited vocabulary a feature number, in term order."""
    return vocab.withColumn("feature", F.row_number().over(Window.orderBy("term")) - 1)


def raw_weights(counts: DataFrame, idf_table: DataFrame, how: str = "inner", small: bool | None = None) -> DataFrame:
    """Sublinear tf times idf. Terms outside the vocabulary drop out (or stay as nulls with 'left').

    A term has one row for each document at most, which is little beside all rows: so the lookup is not repeated for salts."""
    joined = lookup_join(counts, idf_table, "term", how, salts=1, small=small)
    return joined.withColumn("raw", (F.log(F.col("tf").cast("double")) + 1.0) * F.col("idf"))


def tfidf_weights(counts: DataFrame, idf_table: DataFrame, doc: str, small: bool | None = None) -> DataFrame:
    """(doc, term, weight) with rows of unit length."""
    raw = raw_weights(counts, idf_table, small=small)
    length = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(doc)))
    return raw.select(doc, "term", (F.col("raw") / length).alias("weight"))


def feature_union(blocks: list[tuple[str, DataFrame]]) -> DataFrame:
    """Stack feature blocks; each is already of unit length per document and stays so."""
    union = None
    for name, block in blocks:
        part = block.withColumn("block", F.lit(name))
        union = part if union is None else union.unionByName(part)
    return union
