"""Order MinHash near-duplicate classes, candidates verified by banded alignment."""

from __future__ import annotations

from bisect import bisect_left
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .common import documents, is_small, join_lookup, lookup_join, materialize, measured, size_measures, text_of

MIX1, MIX2, STEP = (np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15))


class Settings(NamedTuple):
    """k words a shingle; the least similarity; `tables` sketches of `order` shingles each.

    A pair of similarity s agrees in one sketch with probability about s^order, so at 0.8 all 24 sketches of a
    pair differ with probability (1 - 0.8^4)^24 = 3e-6. Sampling without return lowers that for short texts, so
    those of up to `short` shingles have as many sketches of `short_order` besides.
    """

    k: int = 5
    similarity: float = 0.8
    tables: int = 24
    order: int = 4
    short: int = 12
    short_order: int = 2


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


def word_codes(words: list[bytes]) -> np.ndarray:
    """64 bits for every word, from its bytes only, so that all tasks agree; each different word is hashed once."""
    import xxhash

    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    return np.fromiter(map(xxhash.xxh3_64_intdigest, known), np.uint64, len(known))[ids]


def labelled_shingles(text: str, k: int) -> np.ndarray:
    """The text's k-word shingles in order, each hashed with the number of its earlier occurrences, so all differ.
    A text of 1 to k-1 words is one shingle; one without words has none."""
    words = text.encode("utf-8", "surrogatepass").split()
    if not words:
        return np.empty(0, np.uint64)
    codes = word_codes(words)
    n = max(len(words) - k + 1, 1)
    x = np.full(n, len(words) if len(words) < k else 0, np.uint64)
    for j in range(min(k, len(words))):
        x = mixed(x + STEP + codes[j:j + n])
    by_value = np.argsort(x, kind="stable")
    ordered = x[by_value]
    first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    if len(first) < n:
        earlier = np.arange(n) - np.repeat(first, np.diff(np.append(first, n)))
        x[by_value] = mixed(ordered + earlier.astype(np.uint64) * STEP)
    return x


def sketches(shingles: np.ndarray, tables: int, order: int) -> np.ndarray:
    """One number for each table: the `order` shingles with the smallest hashes there, in text order."""
    n, width = len(shingles), min(order, len(shingles))
    salts = mixed(np.arange(2, 2 * tables + 2, dtype=np.uint64) * STEP).reshape(2, tables, 1)
    low = np.empty((tables, width), np.int64)
    for part in range(0, tables, max(1, 2_000_000 // max(n, 1))):
        rows = slice(part, min(tables, part + max(1, 2_000_000 // max(n, 1))))
        h = (shingles ^ salts[0, rows]) * (salts[1, rows] | np.uint64(1))
        low[rows] = smallest(h, width)
    chosen = shingles[np.sort(low, axis=1)]
    key = np.arange(tables, dtype=np.uint64) + np.uint64(tables * order)
    for place in range(width):
        key = mixed(key * MIX1 + STEP + chosen[:, place])
    return key.view(np.int64)


def smallest(h: np.ndarray, width: int) -> np.ndarray:
    """The places of the `width` smallest values of each row. Most rows have enough values below a low bound, and
    only those are sorted."""
    n = h.shape[1]
    if n > 16 * width:
        r, c = np.nonzero(h < np.uint64(int(2 ** 64 * 4 * width / n)))
        first = np.searchsorted(r, np.arange(len(h) + 1))
        if (np.diff(first) >= width).all():
            by_value = np.lexsort((h[r, c], r))
            return c[by_value[first[:-1, None] + np.arange(width)]]
    return np.argpartition(h, width - 1, axis=1)[:, :width] if width < n else np.tile(np.arange(n), (len(h), 1))


def aligned(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether the shingles that a and b share in the same order, against all shingles of both, reach `similarity`.

    Labelled shingles are all different, so the best alignment is the longest rising run of positions in b over
    the shared ones by position in a. A pair that passes has at most (|a| + |b|)(1 - s)/(1 + s) shingles outside
    the alignment, and an aligned one is shifted by no more than that: the band.
    """
    if len(a) == 0 or len(b) == 0:
        return len(a) == len(b)
    need = similarity * (len(a) + len(b)) / (1 + similarity) - 1e-9
    if min(len(a), len(b)) < need:
        return False
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    band = len(a) + len(b) - 2 * need
    near = np.abs(i - j) <= band
    i, j = i[near], j[near]
    if len(i) < need:
        return False
    run = j[np.argsort(i)]
    if not (run[1:] > run[:-1]).all():
        tails: list[int] = []
        for x in run.tolist():
            at = bisect_left(tails, x)
            tails[at:at + 1] = [x]
        return len(tails) >= need
    return True


def signatures(docs: DataFrame, s: Settings) -> DataFrame:
    """doc_id, digest of the words, n (shingles), keys."""
    @F.pandas_udf("digest string, n int, keys array<long>")
    def sign(texts: pd.Series) -> pd.DataFrame:
        import xxhash

        rows = []
        for text in texts:
            shingles = labelled_shingles(text, s.k)
            digest = xxhash.xxh3_128_hexdigest(b" ".join(text.encode("utf-8", "surrogatepass").split()))
            keys = [sketches(shingles, s.tables, s.order)] if len(shingles) else []
            if 0 < len(shingles) <= s.short:
                keys.append(sketches(shingles, s.tables, s.short_order))
            rows.append((digest, len(shingles), np.concatenate(keys) if keys else []))
        return pd.DataFrame(rows, columns=["digest", "n", "keys"])

    return documents(docs).filter("doc_id is not null").withColumn("_s", sign("text")).select("doc_id", "_s.*")


def components(nodes: DataFrame, edges: DataFrame, name: str) -> DataFrame:
    """node, comp (the smallest node reached) for edges (a, b) over nodes (node). Each round every node takes the
    smallest label among its neighbours', then its label's label; rounds grow with the logarithm of a path's
    length and each is written, so a lost executor costs one round at most."""
    both = materialize(edges.select("a", "b").union(edges.select("b", "a")).distinct(), name + "edges")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("comp")), name)
    while True:
        seen = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("low"))
        step = labels.join(seen, "node").select("node", "comp", F.least("comp", "low").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("comp").alias("far"))
        new = materialize(step.join(jump, "low", "left").select("node", F.least("low", F.coalesce("far", "low")).alias("comp"),
                                                                 F.col("comp").alias("old")), name)
        if new.filter("comp <> old").isEmpty():
            break
        labels = new.drop("old")
    return nodes.join(labels, "node", "left").select("node", F.coalesce("comp", "node").alias("comp"))


def cut_texts(docs: DataFrame, wanted: DataFrame, s: Settings) -> DataFrame:
    """node, shingles (bytes) of the texts named in `wanted` (node); its ids are broadcast only if they are few."""
    wanted, sizes = measured(wanted, "wanted", **size_measures(wanted))

    @F.pandas_udf("binary")
    def cut(texts: pd.Series) -> pd.Series:
        return pd.Series([labelled_shingles(t, s.k).tobytes() for t in texts], dtype=object)

    texts = documents(docs).withColumnRenamed("doc_id", "node")
    texts = texts.join(F.broadcast(wanted) if is_small(sizes) else wanted, "node", "left_semi")
    return materialize(texts.select("node", cut("text").alias("shingles")).dropDuplicates(["node"]), "shingles")


def verified(pairs: DataFrame, shingles: DataFrame, s: Settings) -> DataFrame:
    """The pairs (a, b) of nodes whose shingles align."""
    @F.pandas_udf("boolean")
    def test(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([aligned(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), s.similarity) for x, y in zip(a, b)], dtype=bool)

    left = shingles.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = shingles.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    return materialize(pairs.join(left, "a").join(right, "b").filter(test("sa", "sb")).select("a", "b"), "links")


def rare_pairs(open_: DataFrame, shingles: DataFrame, s: Settings) -> DataFrame:
    """All pairs (a, b) of different classes among `open_` (node, comp, n) that can be similar.

    Shingles are put in one order, from the rarest to the most frequent among the open texts. Two texts of
    similarity s share at least s / (1 + s) * (n + m) shingles, so they meet in one of the first n - that + 1 of
    either, and are paired there only. What many texts share (a common passage, the unchanged part of many near
    copies) comes last and pairs nobody.
    """
    @F.pandas_udf("array<long>")
    def numbers(values: pd.Series) -> pd.Series:
        return pd.Series([np.frombuffer(x, np.int64) for x in values], dtype=object)

    rows = shingles.join(open_, "node").select("node", F.explode(numbers("shingles")).alias("shingle"))
    rows = materialize(rows, "openshingles")
    often = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    shared = rows.join(often, "shingle")
    place = F.row_number().over(Window.partitionBy("node").orderBy("df", "shingle"))
    many = F.count(F.lit(1)).over(Window.partitionBy("node"))
    placed = shared.select("node", "shingle", place.alias("place"), many.alias("many")).join(open_, "node")
    placed = placed.withColumn("place", F.col("n") - F.col("many") + F.col("place"))  # those that one text has come first
    prefix = placed.filter(F.col("place") <= F.col("n") - F.ceil(F.lit(s.similarity) * F.col("n") - F.lit(1e-9)) + 1)
    prefix = materialize(prefix.select("shingle", "node", "comp", "n", "place"), "prefixes")
    undecided = prefix.groupBy("shingle").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low < high").select("shingle")
    prefix = materialize(prefix.join(undecided, "shingle"), "undecided")
    other = prefix.select("shingle", F.col("node").alias("b"), F.col("n").alias("m"), F.col("comp").alias("other"), F.col("place").alias("there"))
    need = F.ceil(F.lit(s.similarity / (1 + s.similarity)) * (F.col("n") + F.col("m")) - F.lit(1e-9))
    in_reach = (F.col("place") <= F.col("n") - need + 1) & (F.col("there") <= F.col("m") - need + 1)
    pairs = prefix.withColumnRenamed("node", "a").join(other, "shingle").filter("comp <> other and a < b").filter(alike(s) & in_reach)
    return materialize(pairs.select("a", "b").distinct(), "pairs")


def alike(s: Settings):
    """n and m shingles can reach the similarity."""
    return F.least("n", "m") >= F.lit(s.similarity) * F.greatest("n", "m")


def separated(docs: DataFrame) -> tuple[DataFrame, bool]:
    """The rows with _own, an id for every different text, and whether any doc_id has several: then these texts have a 64-bit hash
    of id and text as _own; all others have the doc_id."""
    key, text = F.col("doc_id").cast("long"), F.xxhash64(text_of())
    several = docs.filter("doc_id is not null").groupBy(key.alias("_id")).agg(F.min(text).alias("low"), F.max(text).alias("high"))
    several, sizes = measured(several.filter("low <> high").select("_id", F.lit(True).alias("_several")), "several", rows=F.count(F.lit(1)), bytes=F.lit(0))
    if not sizes["rows"]:
        return docs.withColumn("_own", key), False
    marked = lookup_join(docs.withColumn("_id", key), several, "_id", "left", small=sizes["rows"] < 1_000_000)
    return marked.withColumn("_own", F.when(F.col("_several"), F.xxhash64("_id", text_of())).otherwise(F.col("_id"))).drop("_id", "_several"), True


def classes(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """doc_id, class_id, class_size for every document: class_id is the smallest doc_id of its class, as `classes_of` finds them.

    Null doc_id: class and size null. Repeated rows give one row; different texts under one doc_id are documents of their
    own, with a row each. Empty table: no rows. Other columns are ignored.
    """
    docs, several = separated(docs)
    if not several:
        return classes_of(docs, s)
    named = docs.select(F.col("doc_id").cast("long").alias("_id"), "_own")
    found = materialize(classes_of(docs.select(F.col("_own").alias("doc_id"), "text"), s), "classes")
    found = found.filter("doc_id is not null").join(named.distinct(), F.col("doc_id") == F.col("_own"))
    lowest = found.groupBy("class_id").agg(F.min("_id").alias("lowest"))
    found = join_lookup(found, lowest, "class_id", "inner").select(F.col("_id").alias("doc_id"), F.col("lowest").alias("class_id"), "class_size")
    missing = named.filter("_id is null").select(*[F.lit(None).cast("long").alias(c) for c in found.columns])
    return found.unionByName(missing)


def classes_of(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """doc_id, class_id, class_size for every document, where a doc_id has one text: the classes of `members_of`.

    Sizes are looked up only for classes of several documents, so the lookup does not grow with the documents that have no copy.
    """
    members = members_of(docs, s)
    sizes = members.groupBy("class_id").agg(F.count(F.lit(1)).alias("class_size")).filter("class_size > 1")
    named = join_lookup(members, sizes, "class_id").select("doc_id", "class_id", F.coalesce("class_size", F.lit(1)).alias("class_size"))
    missing = docs.filter("doc_id is null").select(*[F.lit(None).cast("long").alias(c) for c in named.columns])
    return named.unionByName(missing)


def members_of(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """doc_id, class_id for every doc_id but null, where a doc_id has one text.

    Two texts are linked when their words agree, or when the share of their five-word shingles (counted with
    repetition) that a common order can align is at least `similarity`; classes are the connected groups. Exact
    copies are reduced to one representative first.

    Candidates share a sketch: the ordered shingles with the least hashes in one of `tables` orders. First every
    text is aligned with the hub of each of its buckets, the text there that meets the most others (the least changed
    of a family of copies); that joins the bulk of every group by few pairs. Texts whose buckets then still hold several classes are compared across classes by `rare_pairs`, which leaves
    out no pair that can reach the similarity and makes none inside a known class. All pairs are rows of
    joins that Spark splits; nothing is gathered by bucket or class.

    Null and empty texts have no words and are copies of each other.
    """
    signed = materialize(signatures(docs, s), "signed")
    copies = materialize(signed.groupBy("doc_id").agg(F.min_by(F.struct("digest", "n"), "digest").alias("t")).select("doc_id", "t.*"), "texts")
    reps = materialize(copies.groupBy("digest").agg(F.min("doc_id").alias("node"), F.first("n").alias("n")), "reps")
    nodes = reps.select("node")
    keyed = signed.join(reps.select(F.col("node").alias("doc_id"), "digest"), ["doc_id", "digest"], "left_semi").dropDuplicates(["doc_id"])
    keyed = materialize(keyed.select(F.col("doc_id").alias("node"), "n", F.explode("keys").alias("key")), "keys")
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    keyed = materialize(keyed.join(sizes, "key"), "shared")
    central = keyed.groupBy("node").agg(F.sum("size").alias("met"))
    keyed = keyed.drop("size").join(central, "node")
    first = F.struct(F.col("met"), -F.col("node"))
    hubs = keyed.groupBy("key").agg(F.max_by(F.struct(F.col("node").alias("hub"), F.col("n").alias("m")), first).alias("h"))
    keyed = materialize(keyed.join(hubs.select("key", "h.*"), "key").drop("met"), "buckets")
    shingles = cut_texts(docs, keyed.select("node").distinct(), s)
    stars = materialize(keyed.filter("node <> hub").filter(alike(s)).select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")).distinct(), "stars")
    links = verified(stars, shingles, s)
    known = materialize(keyed.select("key", "node", "n").join(components(nodes, links, "firstclasses"), "node"), "known")
    several = known.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low < high").select("key")
    open_ = materialize(known.join(several, "key", "left_semi").select("node", "comp", "n").distinct(), "open")
    pairs = rare_pairs(open_, shingles, s).join(stars, ["a", "b"], "left_anti")
    links = links.union(verified(pairs, shingles, s))
    found = components(nodes, links, "classes").withColumnRenamed("comp", "class_id")
    return copies.join(reps.select("node", "digest"), "digest").join(found, "node").select("doc_id", "class_id")


def keep_one(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The rows of `docs` with one document of each class: the one with the smallest doc_id.

    Rows without a doc_id stay. Of rows with equal doc_id and text one stays; another text under the same doc_id goes only if
    its own class has a smaller document. Empty table: no rows. Columns as given.
    """
    columns = docs.columns
    docs, several = separated(docs)
    if several:
        docs = materialize(docs, "separated")
        ids = docs.select("_own", F.col("doc_id").cast("long").alias("_id")).filter("_own is not null").distinct()
        found = members_of(docs.select(F.col("_own").alias("doc_id"), "text"), s).join(ids, F.col("doc_id") == F.col("_own"))
        stay = found.groupBy("class_id").agg(F.min_by("_own", F.struct("_id", "_own")).alias("_keep")).select("_keep")
    else:
        stay = members_of(docs, s).filter("doc_id = class_id").select(F.col("doc_id").alias("_keep"))
    one = docs.join(stay, F.col("_own") == F.col("_keep"), "left_semi").dropDuplicates(["_own"])
    return one.select(*columns).unionByName(docs.filter("doc_id is null").select(*columns))
