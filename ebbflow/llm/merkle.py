"""Merkle manifest of a dataset: a digest per row, a tree per group, a tree over the groups, and proofs.

Leaves of a group are numbered from 0 in the order of their key. On every level a node computes the indices of its
siblings, the other members of its run of ``arity`` nodes (index XOR 1 where the arity is 2, slot offsets
otherwise), and finds each by an equijoin of the level with itself on (tree, index); the rows at slot zero then hold
their whole run and emit the parents. Keys are unique, so no join has a hot key, whatever the size of a group. A
level is written once: its siblings make the parents on the way up and the proofs on the way down.

On the way down each node adds its step (the digests before it in its run and those after it) to its parent's path,
so a leaf ends up with the path to the root; a level is half as large as the one below, and the paths shuffled are
twice those of the leaves. Everything is built-in expressions.

Defined cases: a null in a column is encoded as ``-``; rows of a null group are a group of their own, first of all;
rows of a null key come first in their group; rows of one key are ordered by their digests, and rows that agree in
all manifest columns are interchangeable. An empty table has no root and no rows. Other columns are never read.
Digests are 32 bytes inside and lower-case hex at the edges; a node hashes its members' hex texts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbflow.llm.common import materialized
from ebbflow.llm.workspace import Workspace

#: Levels whose joins are planned as one job on the way down, before their paths are written.
LEVELS_A_JOB = 6

_STEP = "array<struct<before: binary, after: binary>>"


def encoded(column: Column) -> Column:
    """A value as its UTF-8 byte count, a colon and itself; a null as ``-``."""
    text = column.cast("string")
    sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.when(column.isNull(), F.lit("-")).otherwise(sized)


def leaf_digest(columns: Sequence[Column]) -> Column:
    """The digest of a row, as hex."""
    return F.sha2(F.concat(*[encoded(c) for c in columns]), 256)


def to_hex(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def _node(members: Column) -> Column:
    """The digest of a run of members put together."""
    return F.unhex(F.sha2(to_hex(members), 256))


def numbered(leaves: DataFrame, order: Sequence[str], work: Workspace) -> DataFrame:
    """``idx`` of each row in its ``tree`` from 0, and the tree's size ``n``. ``order`` starts with what decides the tree.

    Rows are range partitioned, sorted and written; an index is the place in the partition plus the sizes of the
    same tree in the partitions before. Those sizes are a row for each partition and tree in it.
    """
    keys = [F.asc_nulls_first(name) for name in order]
    written = work.keep(
        leaves.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_slot", F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftright("_slot", 33))
    sizes = written.groupBy("tree", "_part").agg(F.count(F.lit(1)).alias("_size"), F.min("_slot").alias("_first"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        "tree",
        "_part",
        (F.coalesce(F.sum("_size").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_size").over(whole).alias("n"),
    )
    joined = written.join(sizes, ["tree", "_part"])
    return joined.withColumn("idx", F.col("_slot") + F.col("_shift")).drop("_slot", "_part", "_shift")


def with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """``before`` and ``after``: digests of the other members of each node's run, put together in order."""
    slot, none = F.pmod("idx", F.lit(arity)), F.lit(b"")
    joined, found = nodes, []
    for offset in range(1, arity):
        sibling = f"_sibling{offset}"
        index = F.col("idx").bitwiseXOR(1) if arity == 2 else F.col("idx") - slot + F.pmod(slot + offset, F.lit(arity))
        others = nodes.select("tree", F.col("idx").alias("_at"), F.col("digest").alias(sibling))
        joined = joined.withColumn("_at", index).join(others, ["tree", "_at"], "left").drop("_at")
        found.append(F.coalesce(sibling, none))
    members = F.array(*found)

    def at(place: int) -> Column:
        return F.get(members, F.pmod(F.lit(place) - slot, F.lit(arity)).cast("int") - 1)

    before = F.concat(*[F.when(slot > place, at(place)).otherwise(none) for place in range(arity - 1)])
    after = F.concat(*[F.when(slot < place, at(place)).otherwise(none) for place in range(1, arity)])
    return joined.select(*nodes.columns, before.alias("before"), after.alias("after"))


@dataclass
class Trees:
    """``levels``: nodes with their siblings, leaves first, of the trees that go on; ``tops``: tree, digest, height."""

    arity: int
    levels: list[DataFrame]
    tops: DataFrame


def climb(leaves: DataFrame, arity: int, work: Workspace) -> Trees:
    """All levels over leaves with ``tree``, ``idx``, ``n`` and ``digest``; other columns stay with the leaves."""
    if arity < 2:
        raise ValueError("a run has two nodes or more")
    largest = leaves.agg(F.max("n")).first()[0] or 0
    levels: list[DataFrame] = []
    tops = [_tops(leaves, 0)]
    nodes = leaves
    while largest > 1:
        level = work.keep(with_siblings(nodes.filter("n > 1"), arity))
        levels.append(level)
        nodes = level.filter(F.pmod("idx", F.lit(arity)) == 0).select(
            "tree",
            (F.col("idx") / arity).cast("long").alias("idx"),
            F.ceil(F.col("n") / arity).cast("long").alias("n"),
            _node(F.concat("digest", "after")).alias("digest"),
        )
        tops.append(_tops(nodes, len(levels)))
        largest = -(-largest // arity)
    return Trees(arity, levels, reduce(DataFrame.unionByName, tops))


def _tops(nodes: DataFrame, height: int) -> DataFrame:
    return nodes.filter("n = 1").select("tree", "digest", F.lit(height).alias("height"))


def paths(trees: Trees, ends: DataFrame, leaves: DataFrame, work: Workspace) -> DataFrame:
    """The leaves with their ``path`` and the columns that ``ends`` has for their tree.

    ``ends`` has a row per tree: tree, height, the ``path`` from its top upwards, and what every leaf is to carry.
    """
    carried = [c for c in ends.columns if c not in ("tree", "height", "path")]
    own = ["tree", "idx", "path", *carried]
    down = None
    for height in range(len(trees.levels), 0, -1):
        parents = ends.filter(F.col("height") == height).withColumn("idx", F.lit(0).cast("long")).select(*own)
        if down is not None:
            parents = parents.unionByName(down.select(*own))
        level = trees.levels[height - 1]
        step = F.array(F.struct("before", "after")).cast(_STEP)
        keyed = level.withColumn("_parent", (F.col("idx") / trees.arity).cast("long"))
        down = keyed.join(parents.withColumnRenamed("idx", "_parent"), ["tree", "_parent"])
        down = down.withColumn("path", F.concat(step, "path")).drop("_parent", "before", "after")
        if height > 1 and height % LEVELS_A_JOB == 0:
            down = work.keep(down)
    alone = leaves.filter("n = 1").join(ends.drop("height"), "tree")
    return alone if down is None else down.unionByName(alone.select(*down.columns))


def folded(digest: Column, path: Column) -> Column:
    """The root that a leaf's hex digest and its path lead to, as hex."""
    return F.aggregate(
        path, digest, lambda so_far, step: F.sha2(F.concat(to_hex(step["before"]), so_far, to_hex(step["after"])), 256)
    )


def proof_digest(path: Column) -> Column:
    """One digest over all siblings of a path, from the leaf to the root, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: to_hex(F.concat(s["before"], s["after"]))), ""), 256)


def proofs(leaves: DataFrame, group: str, key: str, arity: int, work: Workspace) -> DataFrame:
    """Rows with ``digest`` (hex), ``group`` and ``key``: ``subroot`` and ``root`` (hex) and ``path`` beside each.

    The result is planned on tables of ``work``: write it before the workspace closes.
    """
    named = leaves.withColumns(
        {"digest": F.unhex("digest"), "tree": encoded(F.col(group)), "_row": F.monotonically_increasing_id()}
    )
    named = work.keep(named)  # numbered() reads it twice: for the bounds of its ranges, and for the rows
    placed = work.keep(numbered(named, [group, key, "digest", "_row"], work).drop("_row"))
    trees = climb(placed, arity, work)

    groups = placed.select("tree", F.col(group).alias("group")).distinct()
    subroots = work.keep(trees.tops.join(groups, "tree"))
    over = subroots.select(F.lit("").alias("tree"), "group", "digest", F.col("tree").alias("below"), "height")
    over = work.keep(numbered(over, ["group"], work).drop("group"))
    top = climb(over.withColumnRenamed("height", "height_below"), arity, work)
    root = top.tops.select(
        "tree", "height", F.array().cast(_STEP).alias("path"), to_hex(F.col("digest")).alias("root")
    )
    upper = paths(top, root, over.withColumnRenamed("height", "height_below"), work)
    ends = work.keep(
        upper.select(
            F.col("below").alias("tree"),
            F.col("height_below").alias("height"),
            "path",
            to_hex(F.col("digest")).alias("subroot"),
            "root",
        )
    )
    found = paths(trees, ends, placed, work)
    return found.withColumn("digest", to_hex(F.col("digest"))).drop("tree", "idx", "n")


def manifest(
    docs: DataFrame,
    columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    group: str = "lang",
    key: str = "doc_id",
    arity: int = 2,
    tampered: Column | None = None,
) -> DataFrame:
    """key, leaf, subroot, root, proof_sha256, folded_root, verified of every row, all digests as hex.

    ``tampered`` is the digest of a row as somebody claims it to be, null where it is not in doubt: folded_root is
    recomputed from it and the siblings, and verified tells whether that is the root. Without it the rows vouch for
    themselves.
    """
    claim = F.lit(None).cast("string") if tampered is None else tampered
    leaves = docs.select(group, key, leaf_digest([F.col(c) for c in columns]).alias("digest"), claim.alias("claim"))
    with Workspace(docs.sparkSession, "merkle") as work:
        found = proofs(leaves, group, key, arity, work)
        start = F.coalesce("claim", "digest")
        return materialized(
            found.select(
                key,
                F.col("digest").alias("leaf"),
                "subroot",
                "root",
                proof_digest(F.col("path")).alias("proof_sha256"),
                folded(start, F.col("path")).alias("folded_root"),
            ).withColumn("verified", F.col("folded_root") == F.col("root"))
        )
