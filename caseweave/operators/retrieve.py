"""Historical cases and the nearest ones for every message.

The index is a set of tables: cases, their vectors, terms with their idf, and postings. Cases stand in blocks, by the length of their
vectors, and a posting row holds a term's weights in one block with the largest of them. A search is a chain of joins on terms that stays exact
without meeting every case: the largest weights bound what a block can score, and only the blocks that can still hold one of
the k best are opened. Where there are many blocks, blocks of blocks are bounded first.

That chain shuffles a row for every posting a query meets, which grows with queries x cases. Beyond `JOIN_ENTRIES` of them the search
multiplies parts of the queries by parts of the cases instead, and only k rows a query leave each product. It needs no postings: an index
that is not stored makes them when a search by joins asks for them first.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .. import values as V
from ..functions import text as X
from ..session import fits_broadcast, fresh_path, is_small, lookup_join, materialize, measured, size_measures
from . import labels
from .features import Analyzer, idf, raw_weights, term_counts, vocabulary

RETRIEVAL = Analyzer("word", 1, 3, True, X.TOKEN, None)
SLOT = 64  # cases in one block
FAN = 64  # blocks under one node of the next level
PROBE = 2  # the best blocks of a query, opened first for a lower bound
DIGITS = 6  # similarities are ranked by so many digits
SLACK = 1e-9  # more than the order of a sum can change
JOIN_ENTRIES = 20_000_000  # posting entries that a search may meet by joins
PART_CASES, PART_QUERIES = 16_384, 65_536  # most that one product holds of each, on average
CELLS = 2_000_000  # scores held at once while a product is made

CASE_COLUMNS = ["case_order", "case_id", "customer_issue", "brand_resolution", "conversation_context", "intent",
                "turn_count"]


@dataclass
class CaseIndex:
    """cases, idf (term, n, df, idf, number) and postings (term, block, intent, top, first, entries): the weights of a term in the cases of
    a block that have one intent, their largest, and the first case. `upper` has the same bounds for blocks of blocks. `vectors`
    (case_order, intent, block, entries) are the cases with the terms, their numbers and weights; postings are made of them."""

    cases: DataFrame
    idf: DataFrame
    analyzer: Analyzer
    small_cases: bool  # measured: may the table be broadcast
    small_idf: bool
    fan: int = FAN
    vectors: DataFrame | None = None  # not in indexes stored before there were any: these are searched by joins only
    blocks: tuple[DataFrame, list[DataFrame]] | None = None  # postings and upper, once they are made

    def _blocks(self) -> tuple[DataFrame, list[DataFrame]]:
        if self.blocks is None:
            self.blocks = block_tables(self.vectors, fresh_path(self.cases.sparkSession, "postings"), self.fan)
        return self.blocks

    @property
    def postings(self) -> DataFrame:
        return self._blocks()[0]

    @property
    def upper(self) -> list[DataFrame]:
        return self._blocks()[1]


def build_cases(threads: DataFrame, held_out: DataFrame | None, dictionary=V.CORE_KEYWORDS,
                max_cases: int | None = None, default: str = V.DEFAULT_INTENT) -> DataFrame:
    """Issue and first reply of every usable thread, held-out conversations excluded.

    Both texts need three words. All are kept, or the first `max_cases` in thread order if a number is given.
    """
    pool = threads
    if held_out is not None:
        pool = pool.join(held_out.select("conversation_id").distinct(), "conversation_id", "left_anti")
    usable = labels.min_words(labels.min_words(pool, "customer_cleaned_issue"), "brand_first_response")
    usable = labels.drop_acknowledgements(usable, "customer_cleaned_issue")
    if max_cases is not None:
        usable = usable.orderBy("root_tweet_id").limit(max_cases)
    return labels.label_first_match(usable, "customer_cleaned_issue", dictionary, default).select(
        F.col("root_tweet_id").alias("case_order"), F.col("conversation_id").alias("case_id"),
        F.col("customer_cleaned_issue").alias("customer_issue"),
        F.col("brand_first_response").alias("brand_resolution"),
        F.col("customer_cleaned_issue").alias("conversation_context"), "intent", "turn_count")


def build_index(cases: DataFrame, path: str | None = None, analyzer: Analyzer = RETRIEVAL, slot: int = SLOT, fan: int = FAN) -> CaseIndex:
    """Write cases, idf, vectors and, under a given path, postings as Parquet tables and return them. N-grams are cut and counted once.

    All terms are kept unless the analyzer has `max_features`. `slot` cases of about one vector length, and so of about equal weights, form
    a block. A row of postings holds `slot` entries at most, however frequent its term is.
    """
    folder = path or fresh_path(cases.sparkSession, "index")
    cases, sizes = measured(cases, "cases", f"{folder}/cases", **size_measures(cases))
    counts = materialize(term_counts(cases, "case_order", "customer_issue", analyzer), "casecounts")
    return _index_of(cases, sizes, counts, folder, analyzer, slot, fan, stored=path is not None)


def index_from_counts(cases: DataFrame, counts: DataFrame, path: str | None = None, analyzer: Analyzer = RETRIEVAL, slot: int = SLOT,
                      fan: int = FAN) -> CaseIndex:
    """`build_index` from term counts (case_order, term, tf) that are there already; a case without terms may have a null one."""
    folder = path or fresh_path(cases.sparkSession, "index")
    cases, sizes = measured(cases, "cases", f"{folder}/cases", **size_measures(cases))
    return _index_of(cases, sizes, counts, folder, analyzer, slot, fan, stored=path is not None)


def unit_entries(raw: DataFrame, key: str) -> DataFrame:
    """(key, length, entries): the terms of a row with their numbers and weights, as a vector of unit length; equal weights stand together."""
    length = F.sqrt(F.sum(F.col("raw") * F.col("raw")))
    rows = raw.groupBy(key).agg(length.alias("length"), F.array_sort(F.collect_list(F.struct("raw", "number", "term"))).alias("e"))
    return rows.select(key, "length", F.transform("e", lambda e: F.struct(
        e["term"].alias("term"), e["number"].alias("number"), (e["raw"] / F.col("length")).alias("weight"))).alias("entries"))


def _index_of(cases: DataFrame, case_sizes: dict, counts: DataFrame, path: str, analyzer: Analyzer, slot: int, fan: int, stored: bool) -> CaseIndex:
    table = idf(vocabulary(counts, analyzer.max_features), case_sizes["rows"]).withColumn("number", F.monotonically_increasing_id())
    table, sizes = measured(table, "idf", f"{path}/idf", **size_measures(table))
    raw = raw_weights(counts, table.select("term", "idf", "number"), small=is_small(sizes))
    weighted = materialize(unit_entries(raw, "case_order"), "caseweights")
    placed = weighted.select("case_order", "length").join(cases.select("case_order", "intent"), "case_order")
    order = ["intent", F.round("length", 2), "case_order"]
    placed = placed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    placed = materialize(placed.select("case_order", "intent", F.floor(F.col("at") / slot).alias("block")), "placed")
    vectors, _ = measured(weighted.join(placed, "case_order").select("case_order", "intent", "block", "entries"), "vectors", f"{path}/vectors")
    blocks = block_tables(vectors, path, fan) if stored else None
    return CaseIndex(cases, table, analyzer, is_small(case_sizes), is_small(sizes), fan, vectors, blocks)


def block_tables(vectors: DataFrame, path: str, fan: int) -> tuple[DataFrame, list[DataFrame]]:
    """(postings, upper), written below `path`. Vectors are dealt by block, and their terms are taken together where they lie."""
    rows = vectors.repartition("block").select("case_order", "intent", "block", F.explode("entries").alias("e"))
    rows = rows.select("case_order", "intent", "block", "e.term", "e.weight")
    postings = rows.groupBy("term", "block", "intent").agg(F.max("weight").alias("top"), F.min("case_order").alias("first"),
                                                           F.collect_list(F.struct("case_order", "weight")).alias("entries"))
    postings, seen = measured(postings, "postings", f"{path}/postings", blocks=F.approx_count_distinct("block"))
    upper, level, blocks = [], postings.drop("entries"), seen["blocks"]
    while blocks > fan:
        level = level.withColumn("block", F.floor(F.col("block") / fan)).groupBy("term", "block", "intent").agg(
            F.max("top").alias("top"), F.min("first").alias("first"))
        level, seen = measured(level, "upper", f"{path}/upper{len(upper)}", blocks=F.approx_count_distinct("block"))
        upper.append(level)
        if seen["blocks"] >= blocks:  # as many parts as blocks: nothing is gained by going on
            break
        blocks = seen["blocks"]
    return postings, upper


def load_index(spark: SparkSession, path: str, analyzer: Analyzer = RETRIEVAL, fan: int = FAN) -> CaseIndex:
    cases, table, postings = [spark.read.parquet(f"{path}/{name}") for name in ("cases", "idf", "postings")]
    upper: list[DataFrame] = []
    while table_exists(spark, f"{path}/upper{len(upper)}"):
        upper.append(spark.read.parquet(f"{path}/upper{len(upper)}"))
    vectors = spark.read.parquet(f"{path}/vectors") if table_exists(spark, f"{path}/vectors") else None
    if vectors is None:
        table = table.withColumn("number", F.lit(0).cast("long"))
    return CaseIndex(cases, table, analyzer, fits_broadcast(cases), fits_broadcast(table), fan, vectors, (postings, upper))


def table_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def index_exists(spark: SparkSession, path: str) -> bool:
    return table_exists(spark, f"{path}/postings")


def load_or_build_index(spark: SparkSession, path: str, make_cases) -> CaseIndex:
    """Read the index at `path`; build it from `make_cases()` when it is not there."""
    return load_index(spark, path) if index_exists(spark, path) else build_index(make_cases(), path)


def postings_long(index: CaseIndex) -> DataFrame:
    """The index as (case_order, term, weight) rows."""
    if index.vectors is None:
        return index.postings.select("term", F.explode("entries").alias("e")).select("e.case_order", "term", "e.weight")
    return index.vectors.select("case_order", F.explode("entries").alias("e")).select("case_order", "e.term", "e.weight")


def query_weights(queries: DataFrame, index: CaseIndex, query_id: str, text: str) -> DataFrame:
    """(query, term, tf, idf, number, df, raw) of the non-blank queries under the idf of the index. Terms that the index does not know drop out."""
    asked = queries.filter(~X.is_blank(F.col(text)))
    table = index.idf.select("term", "idf", "number", "df")
    return raw_weights(term_counts(asked, query_id, text, index.analyzer), table, small=index.small_idf)


def query_vectors(queries: DataFrame, index: CaseIndex, query_id: str, text: str, asked: DataFrame) -> DataFrame:
    """(query, wanted, numbers, weights, met): unit-length vectors of the queries, their terms as numbers, and how many posting entries
    these have in the index. An id that `asked` has more than once counts as often."""
    raw = query_weights(queries, index, query_id, text)
    met = raw.groupBy(query_id).agg(F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("length"), F.sum("df").alias("met"),
                                    F.array_sort(F.collect_list(F.struct("raw", "number"))).alias("e"))
    often = asked.groupBy(query_id, "wanted").agg(F.count(F.lit(1)).cast("int").alias("copies"))
    each = lambda values: F.when(F.col("copies") > 1, F.flatten(F.array_repeat(values, F.col("copies")))).otherwise(values)
    return met.join(often, query_id).select(
        query_id, "wanted", each(F.col("e.number")).alias("numbers"),
        each(F.transform("e", lambda e: e["raw"] / F.col("length"))).alias("weights"), (F.col("met") * F.col("copies")).alias("met"))


def query_terms(queries: DataFrame, index: CaseIndex, query_id: str, text: str) -> DataFrame:
    """(query, term, number, weight): the unit-length vectors as rows, by the terms alone."""
    raw = query_weights(queries, index, query_id, text)
    return unit_entries(raw, query_id).select(query_id, F.explode("entries").alias("e")).select(query_id, "e.term", "e.number", "e.weight")


def named_terms(vectors: DataFrame, index: CaseIndex, query_id: str) -> DataFrame:
    """(query, wanted, term, weight): the rows of `query_vectors` with the terms of their numbers."""
    rows = vectors.select(query_id, "wanted", F.explode(F.arrays_zip("numbers", "weights")).alias("e"))
    rows = rows.select(query_id, "wanted", F.col("e.numbers").alias("number"), F.col("e.weights").alias("weight"))
    return lookup_join(rows, index.idf.select("number", "term"), "number", salts=1, small=index.small_idf).drop("number")


def wanted_intents(queries: DataFrame, index: CaseIndex, query_id: str, intent: str | None) -> DataFrame:
    """(query, wanted): the intent that a query is held to; null where any case counts."""
    if intent is None:
        return queries.select(query_id, F.lit(None).cast("string").alias("wanted"))
    open_case = index.cases.agg(F.coalesce(F.max(F.col("intent").isNull()), F.lit(False))).scalar()
    served = index.cases.select(F.col("intent").alias("wanted"), F.lit(True).alias("served")).distinct()
    asked = queries.select(query_id, F.nullif(F.col(intent), F.lit("")).alias("wanted"))
    return lookup_join(asked, served.filter(F.col("wanted").isNotNull()), "wanted", "left").select(
        query_id, F.when(F.col("served") | open_case, F.col("wanted")).alias("wanted"))


def allowed() -> Column:
    return F.col("wanted").isNull() | F.col("intent").isNull() | (F.col("intent") == F.col("wanted"))


def bounds(terms: DataFrame, level: DataFrame, query_id: str, parents: DataFrame | None = None, fan: int = FAN) -> DataFrame:
    """(query, block, reach, first): what the cases of a block can score at most, for the blocks of a level that share a term with
    the query; with `parents` (query, up) only for those below them."""
    asked = terms.select(query_id, "wanted", "term", F.col("weight").alias("own"))
    rows = level.select("term", "block", "intent", "top", "first")
    if parents is None:
        met = asked.join(rows, "term")
    else:
        met = asked.join(parents, query_id).join(rows.withColumn("up", F.floor(F.col("block") / fan)), ["term", "up"])
    met = met.filter(allowed()).groupBy(query_id, "block", "term").agg(F.max(F.col("own") * F.col("top")).alias("part"), F.min("first").alias("first"))
    return met.groupBy(query_id, "block").agg(F.sum("part").alias("reach"), F.min("first").alias("first"))


def descend(terms: DataFrame, index: CaseIndex, query_id: str, keep) -> DataFrame:
    """(query, block): from the top level down, the blocks that `keep` leaves of each level."""
    parents = None
    for level in [*reversed(index.upper), index.postings]:
        kept = keep(bounds(terms, level, query_id, parents, index.fan))
        parents = kept.select(query_id, F.col("block").alias("up"))
    return kept.select(query_id, "block")


def scores(terms: DataFrame, blocks: DataFrame, index: CaseIndex, query_id: str) -> DataFrame:
    """(query, case_order, similarity): the whole score of every allowed case of the blocks that shares a term with the query."""
    asked = terms.select(query_id, "wanted", "term", F.col("weight").alias("own")).join(blocks, query_id)
    met = asked.join(index.postings.select("term", "block", "intent", "entries"), ["term", "block"]).filter(allowed())
    met = met.select(query_id, "own", F.explode("entries").alias("e"))
    return met.groupBy(query_id, F.col("e.case_order").alias("case_order")).agg(F.sum(F.col("own") * F.col("e.weight")).alias("similarity"))


def products(vectors: DataFrame, index: CaseIndex, query_id: str, k: int, part_cases: int = PART_CASES, part_queries: int = PART_QUERIES) -> DataFrame:
    """(query, case_order, similarity): of each part of the cases the k best allowed ones that share a term with the query (`query_vectors`).

    Cases and queries are dealt to parts by their numbers; a task multiplies one part of each. The shuffles carry every query once for each part
    of the cases and the other way round, and no row for a pair.
    """
    spark, asked = vectors.sparkSession, vectors.count()
    parts = max(1, -(-index.cases.count() // part_cases))
    groups = max(1, -(-asked // part_queries), min(-(-2 * spark.sparkContext.defaultParallelism // parts), asked // 256))
    dealt = lambda c, n: F.pmod(F.xxhash64(F.lit("part"), c), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    kind = dict(vectors.dtypes)[query_id]
    left = vectors.drop("met").withColumn("group", dealt(query_id, groups)).withColumn("part", each(parts)).withColumnRenamed(query_id, "query")
    right = index.vectors.select("case_order", "intent", F.col("entries.number").alias("numbers"), F.col("entries.weight").alias("weights"))
    right = right.withColumn("part", dealt("case_order", parts)).withColumn("group", each(groups))

    def flat(rows: pd.DataFrame):
        sizes = rows["numbers"].map(len).to_numpy()
        return sizes, np.concatenate(rows["numbers"].to_list()), np.concatenate(rows["weights"].to_list())

    def score(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query": [], "case_order": [], "similarity": []})
        if not len(queries) or not len(rows):
            return empty
        cases, column = np.unique(rows["case_order"].to_numpy(), return_inverse=True)
        sizes, numbers, weights = flat(rows)
        numbers, code, counts = np.unique(numbers, return_inverse=True, return_counts=True)
        by_term = np.argsort(code, kind="stable")
        weights, begin = weights[by_term], np.cumsum(counts) - counts
        column_of = np.repeat(column, sizes)[by_term]
        n, width = len(cases), -(-len(cases) // SLOT) * SLOT
        hot = np.argsort(-counts, kind="stable")[:512]  # of these terms, those that are dense enough stand in a matrix
        hot = hot[counts[hot] > max(SLOT, n / 16)]
        dense, hot_at = np.zeros((len(hot), width)), np.full(len(numbers), -1)
        hot_at[hot] = np.arange(len(hot))
        for i, t in enumerate(hot):
            np.add.at(dense[i], column_of[begin[t]:begin[t] + counts[t]], weights[begin[t]:begin[t] + counts[t]])
        intents, shut = rows["intent"], {}
        for want in queries["wanted"].dropna().unique():
            shut[want] = np.ones(width, dtype=bool)
            shut[want][column[(intents.isna() | (intents == want)).to_numpy(dtype=bool)]] = False
        own_sizes, term, own = flat(queries)
        row_of, at = np.repeat(np.arange(len(queries)), own_sizes), np.searchsorted(numbers, term)
        at[at == len(numbers)] = 0
        known = numbers[at] == term
        row_of, term, own = row_of[known], at[known], own[known]
        wanted, out, step = queries["wanted"].to_numpy(), [empty], max(1, min(4096, CELLS // width))
        for low in range(0, len(queries), step):
            high = min(low + step, len(queries))
            some = slice(*np.searchsorted(row_of, [low, high]))
            r, t, w = row_of[some] - low, term[some], own[some]
            much = hot_at[t] >= 0
            a = np.zeros((high - low, len(hot)))
            np.add.at(a, (r[much], hot_at[t[much]]), w[much])
            s = a @ dense
            r, t, w = r[~much], t[~much], w[~much]
            ends = np.cumsum(counts[t])
            for c in range(-(-int(ends[-1]) // (4 * CELLS)) if len(ends) else 0):  # no more entries at once than these
                x = slice(*np.searchsorted(ends, [c * 4 * CELLS, (c + 1) * 4 * CELLS], side="right"))
                m = counts[t[x]]
                if not len(m):
                    continue
                entry = np.arange(m.sum()) + np.repeat(begin[t[x]] - (np.cumsum(m) - m), m)
                s += np.bincount(np.repeat(r[x] * width, m) + column_of[entry], np.repeat(w[x], m) * weights[entry], s.size).reshape(s.shape)
            for want in shut:
                s[np.ix_(wanted[low:high] == want, shut[want])] = 0.0
            highest = s.reshape(len(s), -1, SLOT).max(axis=2)  # k of these are k different cases
            least = np.partition(highest, -k, axis=1)[:, -k] if highest.shape[1] >= k else np.zeros(len(s))
            i, j = np.nonzero(s >= np.maximum(least - 2 * 10.0 ** -DIGITS, 1e-300)[:, None])
            found = s[i, j]
            order = np.lexsort((j, -np.floor(found * 10.0 ** DIGITS + 0.5), i))
            i, j, found = i[order], j[order], found[order]
            best = np.arange(len(i)) - np.searchsorted(i, i) < k
            out.append(pd.DataFrame({"query": queries["query"].to_numpy()[low + i[best]], "case_order": cases[j[best]], "similarity": found[best]}))
        return pd.concat(out[1:]) if len(out) > 1 else empty

    place, tasks = ["part", "group"], max(parts * groups, int(spark.conf.get("spark.sql.shuffle.partitions")))  # explicit, or they would be put back together
    left, right = left.repartition(tasks, *place), right.repartition(tasks, *place)
    found = left.groupBy(*place).cogroup(right.groupBy(*place)).applyInPandas(score, f"query {kind}, case_order long, similarity double")
    return found.withColumnRenamed("query", query_id)


def first_cases(rows: DataFrame, k: int) -> Column:
    """The first k case numbers of a table as an array."""
    found = [r[0] for r in rows.orderBy("case_order").limit(k).select("case_order").collect()]  # k rows
    return F.array(*[F.lit(c) for c in found]).cast("array<bigint>")


def first_cases_by_intent(index: CaseIndex, free: Column, k: int) -> DataFrame:
    """(wanted, own): for every intent its first k cases, together with those of no intent (`free`)."""
    place = F.row_number().over(Window.partitionBy("intent").orderBy("case_order"))
    own = index.cases.filter("intent is not null").select("intent", "case_order", place.alias("place")).filter(F.col("place") <= k)
    own = own.groupBy(F.col("intent").alias("wanted")).agg(F.collect_list("case_order").alias("own"))  # k entries
    return own.select("wanted", F.slice(F.array_sort(F.concat("own", free)), 1, k).alias("own"))


def by_joins(terms: DataFrame, index: CaseIndex, query_id: str, k: int, ranked, probe: int) -> DataFrame:
    """(query, case_order, similarity, rank): the k best cases of every query that share a term with it.

    The `probe` blocks with the highest bounds give the k-th best score so far; of the others those are opened whose bound is above
    it, or equal with a case that comes first.
    """
    highest = Window.partitionBy(query_id).orderBy(F.desc("reach"), "first", "block")
    first = lambda nodes: nodes.withColumn("n", F.row_number().over(highest)).filter(F.col("n") <= probe)
    seeds = materialize(descend(terms, index, query_id, first), "seeds")
    best = materialize(ranked(scores(terms, seeds, index, query_id)), "best")
    floors = best.filter(F.col("rank") == k).select(query_id, F.round("similarity", DIGITS).alias("floor"), F.col("case_order").alias("last"))

    def open_(nodes: DataFrame) -> DataFrame:
        most = F.round(F.col("reach") + SLACK, DIGITS)
        return nodes.join(floors, query_id, "left").filter(
            F.col("floor").isNull() | (most > F.col("floor")) | ((most == F.col("floor")) & (F.col("first") < F.col("last"))))

    others = descend(terms, index, query_id, open_).join(seeds, [query_id, "block"], "left_anti")
    others, seen = measured(others, "blocks", blocks=F.count(F.lit(1)))
    if seen["blocks"]:
        best = materialize(ranked(best.drop("rank").unionByName(scores(terms, others, index, query_id))), "best")
    return best


def top_cases(queries: DataFrame, index: CaseIndex, query_id: str, text: str, k: int = 3, intent: str | None = None,
              min_similarity: float = 0.0, probe: int = PROBE) -> DataFrame:
    """(query, rank, case_order, similarity): the k most similar cases of every non-blank query.

    Order: similarity (6 decimals) descending, then case order; cases without any common term fill
    up to k. With `intent` (a column of the queries) only cases of that intent, or of none, count,
    unless no case qualifies. `min_similarity` applies after the cut to k; ranks are then closed up.

    The result is exact, by joins or by products, as the number of posting entries met by the queries says.
    """
    asked = materialize(wanted_intents(queries.filter(~X.is_blank(F.col(text))), index, query_id, intent), "asked")
    place = Window.partitionBy(query_id).orderBy(F.desc(F.round("similarity", DIGITS)), "case_order")
    ranked = lambda found: found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
    if index.vectors is None:
        met, terms = 0, query_terms(queries, index, query_id, text).join(asked, query_id)
    else:
        vectors, seen = measured(query_vectors(queries, index, query_id, text, asked), "queryvectors", met=F.sum("met"))
        met, terms = seen["met"] or 0, named_terms(vectors, index, query_id)
    if met > JOIN_ENTRIES:
        best = materialize(ranked(products(vectors, index, query_id, k)), "best")
    else:
        best = by_joins(materialize(terms, "queryterms"), index, query_id, k, ranked, probe)
    few = asked.join(best.groupBy(query_id).agg(F.count(F.lit(1)).alias("n")), query_id, "left").filter(F.coalesce("n", F.lit(0)) < k)
    fill = first_cases(index.cases, k)
    if intent is not None:
        free = first_cases(index.cases.filter("intent is null"), k)
        few = lookup_join(few, first_cases_by_intent(index, free, k), "wanted", "left")
        fill = F.when(F.col("wanted").isNull(), fill).otherwise(F.coalesce("own", free))
    filled = few.select(query_id, F.explode(fill).alias("case_order")).join(best, [query_id, "case_order"], "left_anti")
    everything = best.drop("rank").unionByName(filled.withColumn("similarity", F.lit(0.0)).select(query_id, "case_order", "similarity"))
    best = everything.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
    if min_similarity > 0:
        best = (best.filter(F.col("similarity") >= min_similarity)
                .withColumn("rank", F.row_number().over(Window.partitionBy(query_id).orderBy("rank"))))
    return best.select(query_id, "rank", "case_order", "similarity")


def search_topk(queries: DataFrame, index: CaseIndex, query_id: str, text: str, k: int = 3,
                intent: str | None = None, min_similarity: float = 0.0) -> DataFrame:
    """The ranked cases with their texts; similarity with 4 decimals."""
    best = top_cases(queries, index, query_id, text, k, intent, min_similarity)
    cases = index.cases.withColumnRenamed("intent", "case_intent").drop("turn_count")
    return lookup_join(best, cases, "case_order", small=index.small_cases).select(
        query_id, "rank", F.round("similarity", 4).alias("similarity_score"), "case_order", "case_id",
        "customer_issue", "brand_resolution", "conversation_context", "case_intent")


def evidence_array(results: DataFrame, query_id: str) -> DataFrame:
    """The ranked cases of a query as one array (at most k entries)."""
    entry = F.struct("rank", "case_id", "similarity_score", "customer_issue", "brand_resolution",
                     "conversation_context", F.col("case_intent").alias("intent"))
    return results.groupBy(query_id).agg(F.array_sort(F.collect_list(entry)).alias("evidence"))
