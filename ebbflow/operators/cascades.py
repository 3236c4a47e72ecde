"""What goes when rows are deleted: the model's delete rules followed over any graph of relationships.

Every stored form of a relationship is a set of edges from a row to the rows it takes along: a pointer, an array, an
edge table, or one of these read backwards where the other side holds them. A frontier of newly found rows is joined
with the edges of its own roots, what is found and was not gone before is the next frontier, and the walk ends when
nothing new is found. So rules may come back to where they began, and rows may refer to each other in circles; the
number of rounds is the longest chain of the data. Each frontier is written once: it cuts the lineage, and its size
is known to the joins. What is found is dealt over partitions in proportion to the edges, so that a task holds no more
of a larger graph.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbflow.model import DeleteRule, EntityModel, Relationship, Stored
from ebbflow.operators.joins import join_unique, spread
from ebbflow.operators.relations import edges_of_array
from ebbflow.session import materialized, materialized_parts

Tables = Mapping[str, DataFrame]

#: Frontiers of one root that are read separately; then they are put together in one table.
PARTS = 16


def edge_name(entity: str, relationship: Relationship) -> str:
    """The name of the table that holds a relationship stored as a relation."""
    return f"{entity}.{relationship.name}"


def definer(model: EntityModel, entity: str, name: str) -> str:
    """The entity of the lineage that declares a relationship."""
    for step in model.lineage(entity):
        if any(r.name == name for r in model[step].relationships):
            return step
    raise KeyError(f"entity {entity!r} has no relationship {name!r}")


@dataclass(frozen=True)
class Way:
    """A cascading relationship as edges from rows of one root to rows of another."""

    name: str
    source: str
    target: str
    edges: DataFrame  # _from, _to
    checked: bool  # whether every _to is known to be a row


def _stored_edges(
    model: EntityModel, entity: str, relationship: Relationship, tables: Tables, edges: Tables
) -> DataFrame | None:
    """(holder, held) uids of a relationship in its stored form; None where its table is not there."""
    if relationship.stored is Stored.RELATION:
        table = edges.get(edge_name(entity, relationship))
        return None if table is None else table.select(F.col("src_uid").alias("holder"), F.col("dst_uid").alias("held"))
    table = tables.get(model.root_of(entity))
    if table is None or relationship.name not in table.columns:
        return None
    if relationship.stored is Stored.ARRAY:
        return edges_of_array(table, relationship.name).select(F.col("src_uid").alias("holder"), F.col("dst_uid").alias("held"))
    held = table.select(F.col("uid").alias("holder"), F.col(f"{relationship.name}.uid").alias("held"))
    return held.filter("held is not null")


def cascading(model: EntityModel, tables: Tables, edges: Tables) -> Iterator[Way]:
    """All ways of the model by which a deleted row takes others along."""
    for entity in model.names:
        for relationship in model[entity].relationships:
            if relationship.delete_rule is not DeleteRule.CASCADE:
                continue
            source, target = model.root_of(entity), model.root_of(relationship.target)
            name = edge_name(entity, relationship)
            if relationship.stored is not Stored.DERIVED:
                stored = _stored_edges(model, entity, relationship, tables, edges)
                if stored is not None:
                    yield Way(name, source, target, stored.select(F.col("holder").alias("_from"), F.col("held").alias("_to")), False)
                continue
            inverse = model.inverse_of(relationship)
            if inverse is None or inverse.stored is Stored.DERIVED:
                raise ValueError(f"{name} cascades, but neither side stores it")
            holder = definer(model, relationship.target, inverse.name)
            stored = _stored_edges(model, holder, inverse, tables, edges)
            if stored is not None:
                by_rows = inverse.stored is not Stored.RELATION
                yield Way(name, source, target, stored.select(F.col("held").alias("_from"), F.col("holder").alias("_to")), by_rows)


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def _written(parts: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Keys by root in one write; roots without any are left out."""
    if not parts:
        return {}
    return materialized_parts(_union([p.select("uid").withColumn("root", F.lit(r)) for r, p in parts.items()]), "root")


def taken_along(
    model: EntityModel, tables: Tables, keys: Mapping[str, DataFrame], edges: Tables | None = None
) -> dict[str, DataFrame]:
    """Uids by root, each once, that go when the given uids, by entity, are deleted: those and all they take along.

    ``edges`` has the tables of relationships stored as relations, by ``Entity.relationship``. References to rows
    that are not there take nothing along.
    """
    ways = list(cascading(model, tables, edges or {}))
    own: dict[str, list[DataFrame]] = {}
    for entity, rows in keys.items():
        own.setdefault(model.root_of(entity), []).append(rows.select("uid"))
    frontier = _written({root: _union(parts).filter("uid is not null").distinct() for root, parts in own.items()})
    gone: dict[str, list[DataFrame]] = {root: [own[root][0].select("uid").limit(0)] for root in own if root not in frontier}
    walked: dict[str, int] = {}
    while frontier:
        for root, rows in frontier.items():
            parts = [*gone.get(root, []), rows]
            gone[root] = [materialized(_union(parts))] if len(parts) > PARTS else parts
        found: dict[str, list[DataFrame]] = {}
        for i, way in enumerate(ways):
            if way.source not in frontier:
                continue
            walked[way.name] = walked.get(way.name, 0) + 1
            if walked[way.name] == 2:  # walked again and again: its two columns are read from a table of their own
                way = ways[i] = Way(way.name, way.source, way.target, materialized(way.edges), way.checked)
            sources = frontier[way.source].withColumnRenamed("uid", "_from")
            hit = join_unique(way.edges, sources, "_from", "left_semi", spread_by="_to", sized=True)
            hit = hit.select(F.col("_to").alias("uid"))
            if not way.checked:
                table = tables.get(way.target)
                hit = hit.limit(0) if table is None else hit.distinct().join(table.select("uid"), "uid", "left_semi")
            found.setdefault(way.target, []).append(hit)
        fresh = {}
        for root, parts in found.items():
            rows = spread(_union(parts), "uid").distinct()
            fresh[root] = rows.join(_union(gone[root]), "uid", "left_anti") if root in gone else rows
        frontier = _written(fresh)
    return {root: _union(parts) for root, parts in gone.items()}


def ends(model: EntityModel, name: str) -> tuple[str, str]:
    """The roots of an edge table's sources and targets."""
    entity, relationship = name.split(".")
    return model.root_of(entity), model.root_of(model.relationship(entity, relationship).target)


def edges_without(model: EntityModel, name: str, edges: DataFrame, gone: Tables) -> DataFrame:
    """Edges of one relationship with neither end among the gone rows of that end's root: a uid is unique within
    its root only."""
    source, target = ends(model, name)
    for end, root, other in (("src_uid", source, "dst_uid"), ("dst_uid", target, "src_uid")):
        if root in gone:
            lost = gone[root].select(F.col("uid").alias(end))
            edges = join_unique(edges, lost, end, "left_anti", spread_by=other).select(*edges.columns)
    return edges


def sources_of_lost_edges(model: EntityModel, edges: Tables, gone: Tables) -> dict[str, DataFrame]:
    """Uids by root of rows that lose a member because it is gone, each once."""
    lost: dict[str, list[DataFrame]] = {}
    for name, table in edges.items():
        source, target = ends(model, name)
        if target in gone:
            targets = gone[target].select(F.col("uid").alias("dst_uid"))
            hit = join_unique(table.select("src_uid", "dst_uid"), targets, "dst_uid", "left_semi", spread_by="src_uid")
            lost.setdefault(source, []).append(hit.select(F.col("src_uid").alias("uid")))
    return {root: _union(parts).distinct() for root, parts in lost.items()}
