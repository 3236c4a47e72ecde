"""Fetches: an entity's visible rows, filtered, sorted, cut, counted or projected."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbflow.functions.predicates import is_visible
from ebbflow.model import PRIVATE, EntityModel, Status
from ebbflow.operators.joins import join_unique
from ebbflow.operators.relations import PAGE_SIZE, member_maps, resolve_to_many, resolve_to_one
from ebbflow.session import materialized


# Up to this limit the references of a page are sent to the scan of their targets.
BROADCAST_PAGE = 10_000


@dataclass(frozen=True)
class Order:
    """A sort key. Nulls come first ascending and last descending."""

    column: str
    descending: bool = False

    @property
    def key(self) -> Column:
        return F.col(self.column).desc_nulls_last() if self.descending else F.col(self.column).asc_nulls_first()


def total_order(order: Sequence[Order]) -> list[Column]:
    """The sort keys with the uid last, so that pages never overlap."""
    return [*(o.key for o in order), F.col("uid").asc()]


def of_entity(table: DataFrame, model: EntityModel, entity: str, subentities: bool = True) -> DataFrame:
    """Rows of an entity in its root's table, with or without those of its sub-entities."""
    names = model.family(entity) if subentities else [entity]
    if subentities and model[entity].parent is None:
        return table
    return table.filter(F.col("entity").isin(names))


def visible(table: DataFrame) -> DataFrame:
    return table.filter(is_visible())


def select_rows(
    table: DataFrame, model: EntityModel, entity: str, where: Column | None = None, subentities: bool = True
) -> DataFrame:
    """The rows every kind of fetch starts from."""
    rows = visible(of_entity(table, model, entity, subentities))
    return rows if where is None else rows.filter(where)


def cut(rows: DataFrame, order: Sequence[Order], limit: int | None, offset: int = 0) -> DataFrame:
    """Sort, skip and limit. With a limit each task keeps at most ``offset + limit`` rows."""
    if order or limit is not None or offset:
        rows = rows.orderBy(*total_order(order))
    if offset:
        rows = rows.offset(offset)
    return rows if limit is None else rows.limit(limit)


def public(rows: DataFrame) -> DataFrame:
    """Without the private control columns."""
    return rows.drop(*PRIVATE)


def fetch_objects(
    table: DataFrame,
    model: EntityModel,
    entity: str,
    where: Column | None = None,
    order: Sequence[Order] = (),
    limit: int | None = None,
    offset: int = 0,
    targets: Mapping[str, DataFrame] | None = None,
    subentities: bool = True,
) -> DataFrame:
    """Public rows with their to-one references resolved against ``targets``, by reference column.

    The rows are cut before the joins, so a page of fifty looks for fifty targets at most.
    """
    rows = cut(select_rows(table, model, entity, where, subentities), order, limit, offset)
    for ref, target in (targets or {}).items():
        if limit is not None and limit <= BROADCAST_PAGE:
            wanted = rows.select(F.col(f"{ref}.uid").alias("uid")).distinct()
            target = target.join(F.broadcast(wanted), "uid", "left_semi")
            rows = resolve_to_one(rows, ref, target, few=True)
        else:
            rows = resolve_to_one(rows, ref, target)
    rows = public(rows)
    return rows.orderBy(*total_order(order)) if order else rows


def fetch_members(
    rows: DataFrame, edges: DataFrame, targets: DataFrame, limit: int | None = None, page_size: int = PAGE_SIZE
) -> DataFrame:
    """The members of a to-many for fetched rows: ``(uid, page, members)``, members as ``{entity: [uid, ...]}``.

    Only populated targets are members, each once; a row without one has one empty map. Repeated rows count once. A
    to-many above ``page_size`` comes as several pages, so no value is unbounded. Where ``limit`` says that the rows
    are a page, its uids are sent to the scan of the edges, and the uids of its edges' targets cut the targets.
    """
    own = rows.select("uid").distinct()
    if limit is not None and limit <= BROADCAST_PAGE:
        own = materialized(own)  # the page is found once, not for each of its uses
        held = edges.join(F.broadcast(own.withColumnRenamed("uid", "src_uid")), "src_uid", "left_semi")
        targets = targets.join(held.select(F.col("dst_uid").alias("uid")).distinct(), "uid", "left_semi")
    else:
        held = join_unique(edges, own.withColumnRenamed("uid", "src_uid"), "src_uid", "left_semi", spread_by="dst_uid")
    return member_maps(own, resolve_to_many(held, targets), page_size)


def fetch_ids(table: DataFrame, model: EntityModel, entity: str, where: Column | None = None, **cuts) -> DataFrame:
    order, limit, offset = cuts.get("order", ()), cuts.get("limit"), cuts.get("offset", 0)
    return cut(select_rows(table, model, entity, where), order, limit, offset).select("entity", "uid")


def fetch_count(table: DataFrame, model: EntityModel, entity: str, where: Column | None = None) -> DataFrame:
    return select_rows(table, model, entity, where).agg(F.count(F.lit(1)).alias("n"))


def fetch_dictionaries(
    table: DataFrame,
    model: EntityModel,
    entity: str,
    columns: Sequence[str | Column],
    where: Column | None = None,
    distinct: bool = False,
    aggregates: Sequence[Column] = (),
    having: Column | None = None,
) -> DataFrame:
    """Plain values: chosen columns, distinct or grouped, with a condition on the groups."""
    rows = select_rows(table, model, entity, where)
    if aggregates:
        rows = rows.groupBy(*columns).agg(*aggregates)
        return rows if having is None else rows.filter(having)
    rows = rows.select(*columns)
    return rows.distinct() if distinct else rows


def with_position(rows: DataFrame, order: Sequence[Order]) -> DataFrame:
    """Each row's place in the whole sorted result, from 1, without a single-task window.

    Range partitions are sorted and written once; a row's place is its place in the partition plus the
    sizes of the partitions before it, one number per partition.
    """
    keys = total_order(order)
    numbered = (
        rows.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    numbered = materialized(numbered).withColumns(
        {"_part": F.shiftright("_slot", 33), "_slot": F.col("_slot").bitwiseAND((1 << 33) - 1)}
    )
    sizes = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    return (
        numbered.join(F.broadcast(starts), "_part")
        .withColumn("position", F.col("_start") + F.col("_slot") + 1)
        .drop("_part", "_slot", "_start")
    )


def lookup(table: DataFrame, keys: DataFrame) -> DataFrame:
    """Populated rows by uid. Only the status is asked, which is weaker than what a fetch asks."""
    populated = table.filter(F.col("status") == int(Status.POPULATED))
    return populated.join(keys.select("uid"), "uid", "left_semi")


def lookup_one(table: DataFrame, uid: str) -> DataFrame:
    return table.filter((F.col("status") == int(Status.POPULATED)) & (F.col("uid") == uid))


def in_objects(rows: DataFrame, ref: str, objects: DataFrame) -> DataFrame:
    """Rows whose to-one is among the given objects, of any number."""
    wanted = objects.select(F.col("uid").alias("_target")).distinct()
    keyed = rows.withColumn("_target", F.col(f"{ref}.uid"))
    return join_unique(keyed, wanted, "_target", "left_semi", spread_by="uid").drop("_target")


def any_in_objects(rows: DataFrame, edges: DataFrame, objects: DataFrame) -> DataFrame:
    """Rows with at least one member of a to-many among the given objects, each row once."""
    wanted = objects.select(F.col("uid").alias("dst_uid")).distinct()
    hits = join_unique(edges.select("src_uid", "dst_uid"), wanted, "dst_uid", "left_semi", spread_by="src_uid")
    return rows.join(hits.select(F.col("src_uid").alias("uid")).distinct(), "uid", "left_semi")
