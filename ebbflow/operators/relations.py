"""Relationships: references resolved, edges grouped and stored, inverses derived.

A to-many is an edge table ``(src_uid, dst_entity, dst_uid)``. Where members are put together into one
value, a large group becomes several pages of a bounded size instead of one huge row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbflow.functions.refs import clean_references, reference
from ebbflow.model import Status
from ebbflow.operators.joins import join_unique

PAGE_SIZE = 1000


def _populated(targets: DataFrame) -> DataFrame:
    return targets.filter((F.col("status") == int(Status.POPULATED)) & F.col("uid").isNotNull())


def resolve_to_one(rows: DataFrame, ref: str, targets: DataFrame, few: bool = False) -> DataFrame:
    """Keep a reference only if its target is populated, else null; the row stays.

    The reference names the target's own entity, which may be below the declared one. ``few`` says that
    the rows are a page, too few for a hot key to matter.
    """
    live = _populated(targets).select(F.col("uid").alias("_uid"), F.col("entity").alias("_entity"))
    keyed = rows.withColumn("_uid", F.col(f"{ref}.uid"))
    if few:
        joined = keyed.join(live, "_uid", "left")
    else:
        joined = join_unique(keyed, live, "_uid", "left", spread_by="uid")
    resolved = F.when(F.col("_entity").isNotNull(), reference(F.col("_entity"), F.col("_uid")))
    return joined.withColumn(ref, resolved).drop("_uid", "_entity")


def resolve_to_many(edges: DataFrame, targets: DataFrame) -> DataFrame:
    """Edges to populated targets only, each once, under the target's own entity."""
    live = _populated(targets).select(F.col("uid").alias("dst_uid"), F.col("entity").alias("_entity"))
    joined = join_unique(edges.select("src_uid", "dst_uid"), live, "dst_uid", "inner", spread_by="src_uid")
    return joined.select("src_uid", F.col("_entity").alias("dst_entity"), "dst_uid").distinct()


def paged(
    edges: DataFrame, group: Sequence[str], member: str, page_size: int = PAGE_SIZE, force_salting: bool = False
) -> DataFrame:
    """Add ``page``, which splits groups above ``page_size``, and ``n``, the size of such a group, null for others.

    A group of n members gets 16**d pages, d hex digits of the member's digest, the fewest that bring the
    expected page to ``page_size`` or below. A small group is one page, named by the empty text. Only the oversized
    groups are joined to their members, which are spread; the others' members stay where they are.
    """
    counts = edges.groupBy(*group).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > page_size)
    joined = join_unique(edges, counts, group, "left", spread_by=member, force_salting=force_salting)
    excess = F.floor((F.col("n") - 1) / F.lit(page_size)).cast("bigint")
    page = F.when(F.col("n").isNull(), F.lit("")).otherwise(F.substring(F.md5(F.col(member)), F.lit(1), F.length(F.hex(excess))))
    return joined.withColumn("page", page)


def group_size() -> Column:
    """The size of a group beside its page: that of a small group is its one page's."""
    return F.coalesce(F.first("n"), F.count(F.lit(1))).alias("n")


def member_pages(edges: DataFrame, page_size: int = PAGE_SIZE, **options) -> DataFrame:
    """Members of each to-many by target entity: ``(src_uid, dst_entity, page, n, members)``."""
    pages = paged(edges, ["src_uid", "dst_entity"], "dst_uid", page_size, **options)
    return pages.groupBy("src_uid", "dst_entity", "page").agg(
        group_size(), F.array_sort(F.collect_list("dst_uid")).alias("members")
    )


def member_maps(sources: DataFrame, edges: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """``{entity: [uid, ...]}`` per source and page; a source without members has one empty map.

    The pages of one source with very many members are as many rows, and spread like any hot key.
    """
    pages = member_pages(edges, page_size).groupBy("src_uid", "page").agg(
        F.map_from_entries(F.collect_list(F.struct("dst_entity", "members"))).alias("members")
    )
    empty = F.create_map().cast("map<string,array<string>>")
    held = join_unique(pages, sources.select(F.col("uid").alias("src_uid")), "src_uid", "left_semi", spread_by="page")
    without = sources.select(F.col("uid").alias("src_uid")).join(edges.select("src_uid"), "src_uid", "left_anti")
    bare = without.select("src_uid", F.lit("").alias("page"), empty.alias("members"))
    return held.select("src_uid", "page", "members").unionByName(bare).withColumnRenamed("src_uid", "uid")


def inverse_of_to_one(rows: DataFrame, ref: str) -> DataFrame:
    """The to-many side of a stored to-one, as edges; a projection, no shuffle."""
    return rows.filter(F.col(f"{ref}.uid").isNotNull()).select(
        F.col(f"{ref}.uid").alias("src_uid"), F.col("entity").alias("dst_entity"), F.col("uid").alias("dst_uid")
    )


def edges_of_array(rows: DataFrame, refs: str) -> DataFrame:
    """An array of references as edges from its row, cleaned."""
    members = rows.select("uid", "entity", F.explode(clean_references(F.col(refs))).alias("_ref"))
    return members.select(
        F.col("uid").alias("src_uid"),
        F.col("_ref.entity").alias("dst_entity"),
        F.col("_ref.uid").alias("dst_uid"),
        F.col("entity").alias("src_entity"),
    )


def inverse_of_array(rows: DataFrame, refs: str) -> DataFrame:
    """The other side of a to-many that is stored as an array, as edges; no shuffle."""
    return edges_of_array(rows, refs).select(
        F.col("dst_uid").alias("src_uid"), F.col("src_entity").alias("dst_entity"), F.col("src_uid").alias("dst_uid")
    )


def relationship_count(sources: DataFrame, edges: DataFrame) -> DataFrame:
    """Number of members for each source, zero when none; counted before the join."""
    counts = edges.groupBy(F.col("src_uid").alias("uid")).agg(F.count(F.lit(1)).alias("_n"))
    joined = sources.select("uid").join(counts, "uid", "left")
    return joined.select("uid", F.coalesce("_n", F.lit(0)).cast("bigint").alias("n"))


def encode_array(edges: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """Edges in the stored form of an array: ``(src_uid, page, n, refs)``.

    A source within the page size is one array, as a row of the remote holds it.
    """
    pages = paged(edges, ["src_uid"], "dst_uid", page_size)
    return pages.groupBy("src_uid", "page").agg(
        group_size(),
        F.array_sort(
            F.collect_list(F.struct(F.col("dst_entity").alias("entity"), F.col("dst_uid").alias("uid")))
        ).alias("refs"),
    )


def replace_edges(edges: DataFrame, new_edges: DataFrame, sources: DataFrame) -> DataFrame:
    """Replace all edges of the given sources by the new ones; others stay."""
    replaced = sources.select("src_uid").distinct()
    kept = join_unique(edges, replaced, "src_uid", "left_anti", spread_by="dst_uid")
    return kept.unionByName(new_edges)


def scan_with_related(scan: DataFrame, ref: str, targets: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with columns of their to-one target beside them, in one join."""
    wanted = targets.select(F.col("uid").alias("_uid"), *[F.col(c).alias(f"{ref}_{c}") for c in columns])
    keyed = scan.withColumn("_uid", F.col(f"{ref}.uid"))
    return join_unique(keyed, wanted, "_uid", "left", spread_by="uid").drop("_uid")


def clear_references(rows: DataFrame, ref: str, gone: DataFrame) -> DataFrame:
    """Null a to-one whose target is among ``gone``; ``_cleared`` marks the rows it happened to."""
    targets = gone.select(F.col("uid").alias("_uid")).distinct().withColumn("_gone", F.lit(True))
    joined = join_unique(rows.withColumn("_uid", F.col(f"{ref}.uid")), targets, "_uid", "left", spread_by="uid")
    cleared = F.coalesce(F.col("_gone"), F.lit(False))
    return (
        joined.withColumn("_cleared", cleared)
        .withColumn(ref, F.when(~F.col("_cleared"), F.col(ref)))
        .drop("_uid", "_gone")
    )


def remove_from_arrays(rows: DataFrame, refs: str, gone: DataFrame) -> DataFrame:
    """Take references to ``gone`` out of an array column; ``_cleared`` marks the rows it happened to.

    What is collected per row is part of that row's own array.
    """
    targets = gone.select(F.col("uid").alias("dst_uid")).distinct()
    hits = join_unique(
        edges_of_array(rows, refs).select("src_uid", "dst_uid"), targets, "dst_uid", "left_semi", spread_by="src_uid"
    )
    lost = hits.groupBy(F.col("src_uid").alias("uid")).agg(F.collect_set("dst_uid").alias("_lost"))
    joined = rows.join(lost, "uid", "left")
    kept = F.filter(F.col(refs), lambda r: ~F.array_contains(F.col("_lost"), r["uid"]))
    return (
        joined.withColumn("_cleared", F.col("_lost").isNotNull())
        .withColumn(refs, F.when(F.col("_cleared"), kept).otherwise(F.col(refs)))
        .drop("_lost")
    )
