"""A Merkle manifest over a table: leaves, one tree per group, one tree over the groups, and every row's proof.

The trees are built bottom-up in blocks of consecutive nodes. The proofs come from pointer jumping: a node holds the siblings
on its way to an ancestor, and self-joins with these ancestors double that way each round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import small_side
from .common import fold_of, join_lookup, materialize, measured

BLOCK = 12  # levels that one task builds at a time: 4,096 nodes
PART = (1 << 33) - 1  # monotonically_increasing_id: the row's number in its part stands in the low 33 bits


def encoded(value: Column) -> Column:
    """`-` for null, else UTF-8 byte count, a colon and the value."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(values: list[Column]) -> Column:
    return F.sha2(F.concat(*[encoded(c) for c in values]), 256)


def numbered(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """The rows with idx (0, 1, ... in each group by `order`, nulls first) and n (the rows of the group).

    Rows are dealt and sorted by range, with a running number that makes equal rows differ, so neither a large group nor a
    repeated key is one task's work. Joined to them is one count for each part and group.
    """
    keys = [F.col(c).asc_nulls_first() for c in [group, *order, "_row"]]
    rows = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), name)
    at = F.monotonically_increasing_id()
    rows = materialize(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_row").withColumn("_at", at), name)
    rows = rows.withColumn("_key", F.struct(F.shiftright("_at", 33).alias("part"), group))
    counts = materialize(rows.groupBy("_key").agg(F.count(F.lit(1)).alias("here"), F.min("_at").alias("_from")), "counts")
    other = counts.select(F.col("_key." + group).alias("_group"), F.col("_key.part").alias("_part"), "here")
    total = other.groupBy("_group").agg(F.sum("here").alias("n"), F.sort_array(F.collect_list(F.struct("_part", "here"))).alias("parts"))
    ahead = F.aggregate(F.filter("parts", lambda p: p["_part"] < F.col("_key.part")), F.lit(0).cast("long"), lambda a, p: a + p["here"])
    counts = counts.join(total, F.col("_key." + group) == F.col("_group")).select("_key", "_from", "n", ahead.alias("_ahead"))
    return join_lookup(rows, counts, "_key", "inner").withColumn("idx", F.col("_ahead") + F.col("_at") - F.col("_from")).drop(
        "_key", "_from", "_ahead", "_at")


def height() -> Column:
    return F.when(F.col("n") > 1, F.length(F.bin(F.col("n") - 1))).otherwise(0)


def grown(base: DataFrame, block: int) -> DataFrame:
    """Base nodes (tree, level, idx, n, digest) with the levels above them, up to `block` or the root; the last one is without siblings.

    Each 2^block consecutive nodes are one array, from which the next level's is made, and so on.
    """
    pieces = base.groupBy("tree", "level", "n", F.shiftright("idx", block).alias("block")).agg(
        F.min("idx").alias("first"), F.transform(F.array_sort(F.collect_list(F.struct("idx", "digest"))), lambda x: x["digest"]).alias("digests"))
    pieces = pieces.withColumn("steps", F.least(F.lit(block), height() - F.col("level")))
    at = lambda nodes, i: F.coalesce(F.get(nodes, i), F.lit(""))

    def listed(nodes: Column, step: Column, siblings: bool) -> Column:
        beside = lambda i: F.when(i % 2 == 1, F.concat(F.lit("L"), at(nodes, i - 1))).when(
            i + 1 < F.size(nodes), F.concat(F.lit("R"), at(nodes, i + 1))).otherwise("")
        return F.transform(nodes, lambda x, i: F.struct(
            (F.col("level") + step).cast("int").alias("level"), (F.call_function("shiftright", F.col("first"), step) + i).alias("idx"), x.alias("digest"),
            (F.array(beside(i)) if siblings else F.lit(None).cast("array<string>")).alias("seg")))

    def up(done: Column, step: Column) -> Column:
        last = done["last"]
        above = F.transform(F.sequence(F.lit(0), F.shiftright(F.size(last) - 1, 1)), lambda i: F.sha2(F.concat(at(last, 2 * i), at(last, 2 * i + 1)), 256))
        return F.struct(F.concat(done["nodes"], listed(last, step, True)).alias("nodes"), above.alias("last"))

    start = F.struct(F.array().cast("array<struct<level:int,idx:bigint,digest:string,seg:array<string>>>").alias("nodes"), F.col("digests").alias("last"))
    steps = F.when(F.col("steps") > 0, F.sequence(F.lit(0), F.col("steps") - 1)).otherwise(F.array().cast("array<int>"))
    built = pieces.select("tree", "n", "level", "first", "steps", F.aggregate(steps, start, up).alias("built"))
    return built.select("tree", "n", F.explode(F.concat("built.nodes", listed(F.col("built.last"), F.col("steps"), False))).alias("e")).select(
        "tree", "e.level", "e.idx", "n", "e.digest", "e.seg")


def forest(leaves: DataFrame, block: int = BLOCK) -> DataFrame:
    """Nodes (tree, level, idx, n, digest, seg) of the trees over leaves (tree, idx, n, digest).

    seg holds the sibling, L or R for its side before its digest, or an empty text where the node has none; null at a root.
    A task builds blocks of 2^block nodes, whatever the size of the tree; a round adds `block` levels to all trees.
    """
    base, done = leaves.select("tree", F.lit(0).alias("level"), "idx", "n", "digest"), None
    while True:
        nodes, seen = measured(grown(base, block), "nodes", open=F.count_if(F.col("seg").isNull() & (F.col("level") < height())))
        closed = nodes.filter(F.col("seg").isNotNull() | (F.col("level") == height()))
        done = closed if done is None else done.unionByName(closed)
        if not seen["open"]:
            return done
        base = nodes.filter(F.col("seg").isNull() & (F.col("level") < height())).drop("seg")


def ways(leaves: DataFrame, nodes: DataFrame) -> DataFrame:
    """leaves (tree, idx, more columns) with seg: the siblings from the leaf to its root.

    Round k has ways of 2^k levels. A node keeps its way only while its level is a multiple of 2^k: no other node is met
    again. Its way is joined with that of the ancestor it ends at, so the ancestors are a fast shrinking part of the nodes.
    """
    own = nodes.filter("level = 0").select("tree", "idx", F.coalesce("seg", F.array().cast("array<string>")).alias("seg"))
    way = leaves.join(own, ["tree", "idx"])
    inner = nodes.filter("level > 0 and seg is not null").select("tree", "level", "idx", "seg")
    top = inner.agg(F.coalesce(F.max("level"), F.lit(0))).first()[0]
    joined = F.concat("seg", F.coalesce("more", F.array().cast("array<string>"))).alias("seg")
    step = 1
    while step <= top:
        ends = inner.filter(F.col("level") % (2 * step) == step)
        of_leaves = small_side(ends.filter(F.col("level") == step).select("tree", F.col("idx").alias("up"), F.col("seg").alias("more")), "ends")
        way = way.withColumn("up", F.shiftright("idx", step)).join(of_leaves, ["tree", "up"], "left").select(*[c for c in way.columns if c != "seg"], joined)
        ends = ends.select("tree", F.col("level").alias("at"), F.col("idx").alias("up"), F.col("seg").alias("more"))
        rest = inner.filter(F.col("level") % (2 * step) == 0).withColumns({"at": F.col("level") + step, "up": F.shiftright("idx", step)})
        inner = materialize(rest.join(ends, ["tree", "at", "up"], "left").select("tree", "level", "idx", joined), "ways")
        step *= 2
    return way


def folded(leaf: Column, way: Column) -> Column:
    """The root that a leaf and the siblings on its way give."""
    def up(node, sibling):
        digest = F.substring(sibling, 2, 64)
        return F.sha2(F.when(sibling == "", node).when(sibling.startswith("L"), F.concat(digest, node)).otherwise(F.concat(node, digest)), 256)
    return F.aggregate(way, leaf, up)


def proof_digest(way: Column) -> Column:
    return F.sha2(F.array_join(F.transform(F.filter(way, lambda s: s != ""), lambda s: F.substring(s, 2, 64)), ""), 256)


def manifest(rows: DataFrame, columns: list[str], key: str = "doc_id", group: str = "lang",
             altered: dict[str, Column] | None = None, block: int = BLOCK) -> DataFrame:
    """key, leaf, subroot, root, way, given_leaf: one row for every row of the table.

    A leaf is the SHA-256 of the named columns. The leaves of a group ascend by key (nulls first; equal keys by leaf) and each two
    consecutive nodes, or a last one alone, become their digest until one remains, the subroot; the subroots, ordered by
    group (null first, bytewise), likewise give the root. `way` holds the siblings up to the root; `given_leaf` is the leaf
    of the row as `altered` gives it (column name -> expression), to be folded with the untouched siblings.

    Nulls are encoded, so a null and an empty text differ. Equal rows are leaves of their own, next to each other. A group
    of one row has its leaf as subroot, and a single group's subroot is the root. Texts are hashed whole. Columns that are
    not named take no part, whatever they are called. Empty table: no rows.
    """
    given = leaf_digest([(altered or {}).get(c, F.col(c)) for c in columns])
    leaves = rows.select(F.col(key).alias("key"), F.col(group).cast("string").alias("of"), leaf_digest([F.col(c) for c in columns]).alias("digest"),
                         given.alias("given")).withColumn("given", F.nullif("given", "digest"))
    leaves = materialize(leaves, "leaves").withColumn("of", F.concat(F.lit("="), "of"))  # marked, so that null can be an empty text
    leaves = leaves.withColumn("of", F.coalesce("of", F.lit("")))
    groups = leaves.select("of").distinct().withColumn("all", F.lit(0))
    groups = materialize(numbered(groups, "all", ["of"], "groups").select("of", F.col("idx").alias("tree"), F.col("n").alias("groups")), "groups")
    leaves = join_lookup(leaves, groups.select("of", "tree"), "of", "inner").drop("of")
    leaves = materialize(numbered(leaves, "tree", ["key", "digest"], "numbered"), "numbered")
    nodes = forest(leaves, block)
    roots = nodes.filter(F.col("level") == height()).select("tree", F.col("digest").alias("subroot"))
    above = materialize(roots.join(groups, "tree").select(F.lit(-1).cast("long").alias("tree"), F.col("tree").alias("idx"), F.col("groups").alias("n"),
                                                         F.col("subroot").alias("digest")), "subroots")
    upper = forest(above, block)
    root = upper.filter(F.col("level") == height()).select("digest").first()  # one row
    above = ways(above, upper).select(F.col("idx").alias("tree"), F.col("digest").alias("subroot"), F.col("seg").alias("above"))
    found = join_lookup(ways(leaves.drop("n"), nodes), above, "tree", "inner")
    return found.select(F.col("key").alias(key), F.col("digest").alias("leaf"), "subroot", F.lit(root[0] if root else None).cast("string").alias("root"),
                        F.concat("seg", "above").alias("way"), F.coalesce("given", "digest").alias("given_leaf"))


def verified(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, leaf, subroot, root, proof_sha256, folded_root, verified: whether each given leaf folds to the root."""
    out = found.withColumns({"folded_root": folded(F.col("given_leaf"), F.col("way")), "proof_sha256": proof_digest(F.col("way"))})
    return out.select(key, "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def audit(docs: DataFrame, every: int = 7, block: int = BLOCK) -> DataFrame:
    """Proofs of all documents, of which those whose crc32 of the id is divisible by `every` come back with n_chars raised by one.

    A null id or a null n_chars is never altered; the largest long becomes null when raised.
    """
    raised = F.when(fold_of("doc_id", every) == 0, F.try_add("n_chars", F.lit(1).cast("long"))).otherwise(F.col("n_chars"))
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    return verified(manifest(docs, columns, altered={"n_chars": raised}, block=block))
