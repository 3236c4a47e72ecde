"""Saves: inserted, updated and deleted rows of a batch, each as one join with the table.

A batch holds every uid once. ``present`` (array of column names) tells an absent value from a null one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbflow.model import (
    KEY,
    LOCAL_CONTROL,
    DeleteRule,
    EntityModel,
    Relationship,
    Status,
    Stored,
    user_columns,
)
from ebbflow.operators.cascades import edges_without, ends, sources_of_lost_edges, taken_along
from ebbflow.operators.joins import join_unique, side_by_side
from ebbflow.operators.relations import clear_references, remove_from_arrays, replace_edges

_CONTROL_TYPES = {name: dtype for name, dtype, *_ in LOCAL_CONTROL}


def _given(column: str, has_present: bool, present: str) -> Column:
    return F.array_contains(F.col(present), column) if has_present else F.lit(True)


def _status(value: Status) -> Column:
    return F.lit(int(value)).cast("short")


def insert_rows(table: DataFrame, batch: DataFrame) -> DataFrame:
    """Insert rows; a uid that is there already, a placeholder as a rule, is filled instead."""
    has_present = "present" in batch.columns
    both = side_by_side(table, batch, KEY)
    given = [c for c in user_columns(batch.columns) if c != "present"]
    columns = {}
    for name in dict.fromkeys([*user_columns(table.columns), *given]):
        if name not in given:
            columns[name] = F.col(name)
            continue
        new = F.col(f"_new_{name}")
        if name not in table.columns:
            columns[name] = new
            continue
        takes_new = F.col("_new") & (~F.col("_old") | _given(name, has_present, "_new_present"))
        columns[name] = F.when(takes_new, new).otherwise(F.col(name))
    saved = {
        "status": F.when(F.col("_new"), _status(Status.POPULATED)).otherwise(F.col("status")),
        "last_modified": F.col("last_modified"),
        "is_dirty": F.col("_new") | F.col("is_dirty"),
        "created_remotely": ~F.col("_new") & F.col("created_remotely"),
    }
    return both.select(*KEY, *[c.alias(n) for n, c in {**saved, **columns}.items()])


def update_rows(table: DataFrame, batch: DataFrame) -> DataFrame:
    """Partial update: an absent column keeps, a null clears, a value sets; the row becomes dirty."""
    has_present = "present" in batch.columns
    given = [c for c in user_columns(batch.columns) if c != "present"]
    new = batch.select(
        *KEY,
        *[F.col(c).alias(f"_new_{c}") for c in given],
        *([F.col("present").alias("_present")] if has_present else []),
        F.lit(True).alias("_new"),
    )
    joined = table.join(new, list(KEY), "left").withColumn("_new", F.coalesce("_new", F.lit(False)))
    changed = {
        name: F.when(F.col("_new") & _given(name, has_present, "_present"), F.col(f"_new_{name}")).otherwise(
            F.col(name)
        )
        for name in given
        if name in table.columns
    }
    changed["is_dirty"] = F.col("_new") | F.col("is_dirty")
    return joined.withColumns(changed).select(*table.columns)


def soft_delete(table: DataFrame, keys: DataFrame) -> DataFrame:
    """Mark rows as deleted and dirty; their values stay."""
    gone = keys.select("uid").distinct().withColumn("_gone", F.lit(True))
    joined = table.join(gone, "uid", "left").withColumn("_gone", F.coalesce("_gone", F.lit(False)))
    return joined.withColumns(
        {
            "status": F.when(F.col("_gone"), _status(Status.DELETED)).otherwise(F.col("status")),
            "is_dirty": F.col("_gone") | F.col("is_dirty"),
        }
    ).select(*table.columns)


def placeholders(references: DataFrame, existing: DataFrame, created_remotely: bool) -> DataFrame:
    """Rows for referenced ``(entity, uid)`` that have none yet; each once, however often referenced."""
    wanted = references.filter(F.col("uid").isNotNull()).select(*KEY).distinct()
    missing = wanted.join(existing.select("uid"), "uid", "left_anti")
    values = {
        "status": _status(Status.PLACEHOLDER),
        "last_modified": F.lit(None),
        "is_dirty": F.lit(False),
        "created_remotely": F.lit(created_remotely),
    }
    return missing.select(*KEY, *[v.cast(_CONTROL_TYPES[n]).alias(n) for n, v in values.items()])


def batch_sizes(*batches: DataFrame) -> DataFrame:
    """Rows of a mixed batch by entity."""
    rows = reduce(lambda a, b: a.unionByName(b), [b.select("entity") for b in batches])
    return rows.groupBy("entity").agg(F.count(F.lit(1)).alias("n"))


def references_of(rows: DataFrame, relationships: Sequence[Relationship]) -> DataFrame | None:
    """All references that rows hold, as ``(entity, uid)``; None when there is no such column."""
    parts = []
    for relationship in relationships:
        if relationship.name not in rows.columns:
            continue
        column = F.col(relationship.name)
        if relationship.stored is Stored.POINTER:
            parts.append(rows.select(column["entity"].alias("entity"), column["uid"].alias("uid")))
        elif relationship.stored is Stored.ARRAY:
            parts.append(rows.select(F.explode(column).alias("_ref")).select("_ref.entity", "_ref.uid"))
    return reduce(DataFrame.unionByName, parts) if parts else None


@dataclass
class SaveResult:
    """Root tables and edge tables after a batch."""

    tables: dict[str, DataFrame]
    edges: dict[str, DataFrame] = field(default_factory=dict)


@dataclass
class Members:
    """New members of a to-many stored as a relation: ``sources`` has the ``uid`` of every row whose members are
    given, ``edges`` its members (src_uid, dst_entity, dst_uid); a source without an edge has none any more."""

    sources: DataFrame
    edges: DataFrame


def save(
    model: EntityModel,
    tables: Mapping[str, DataFrame],
    inserts: Mapping[str, DataFrame] | None = None,
    updates: Mapping[str, DataFrame] | None = None,
    deletes: Mapping[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """Tables by root after a batch that touches no edge table; see ``save_batch``."""
    return save_batch(model, tables, inserts, updates, deletes).tables


def save_batch(
    model: EntityModel,
    tables: Mapping[str, DataFrame],
    inserts: Mapping[str, DataFrame] | None = None,
    updates: Mapping[str, DataFrame] | None = None,
    deletes: Mapping[str, DataFrame] | None = None,
    edges: Mapping[str, DataFrame] | None = None,
    members: Mapping[str, Members] | None = None,
) -> SaveResult:
    """Tables by root and edge tables after a batch: inserts and updates by root, deletes by entity as keys, edges
    and members by ``Entity.relationship``.

    Rows that inserted and updated rows and new edges refer to and that do not exist get placeholders. Given members
    replace those a row had, and make it dirty. Deletes come last: they take along what the rules say over the
    edges as they are then, and edges with a gone end go too.
    """
    after, kept = dict(tables), dict(edges or {})
    references = []
    for batches, write in ((inserts, insert_rows), (updates, update_rows)):
        for root, batch in (batches or {}).items():
            after[root] = write(after[root], batch)
            references.append(references_of(batch, relationships_of(model, root)))
    for name, given in (members or {}).items():
        if name not in kept:
            kept[name] = given.edges.limit(0)
        sources = given.sources.select(F.col("uid").alias("src_uid")).distinct()
        kept[name] = replace_edges(kept[name], given.edges.join(sources, "src_uid", "left_semi").select(*kept[name].columns), sources)
        root = ends(model, name)[0]
        after[root] = mark_dirty(after[root], given.sources)
        references.append(given.edges.select(F.col("dst_entity").alias("entity"), F.col("dst_uid").alias("uid")))
    if deletes:
        gone = gone_keys(model, after, deletes, kept)
        after = apply_gone(model, after, gone, edges=kept)
        kept = {name: edges_without(model, name, table, gone) for name, table in kept.items()}
    held = [refs for refs in references if refs is not None]
    if held:
        wanted = reduce(DataFrame.unionByName, held)
        for root in after:
            if any(model.root_of(r.target) == root for r in _all_relationships(model)):
                mine = wanted.filter(F.col("entity").isin(model.family(root)))
                fresh = placeholders(mine, after[root], created_remotely=False)
                after[root] = after[root].unionByName(fresh, allowMissingColumns=True)
    return SaveResult(after, kept)


def mark_dirty(table: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of some uids are to be pushed."""
    marked = keys.select("uid").distinct().withColumn("_mark", F.lit(True))
    joined = table.join(marked, "uid", "left")
    return joined.withColumn("is_dirty", F.coalesce("_mark", F.lit(False)) | F.col("is_dirty")).select(*table.columns)


# Deletes with the model's rules


def _all_relationships(model: EntityModel) -> list[Relationship]:
    return [r for root in model.roots for r in relationships_of(model, root)]


def relationships_of(model: EntityModel, name: str) -> list[Relationship]:
    """Relationships of an entity and of those below it, each once."""
    seen: dict[str, Relationship] = {}
    for member in model.family(name):
        for relationship in model.relationships(member):
            seen.setdefault(relationship.name, relationship)
    return list(seen.values())


@dataclass
class DeleteResult:
    """Tables and edge tables after a delete, and the deleted uids by root."""

    tables: dict[str, DataFrame]
    gone: dict[str, DataFrame] = field(default_factory=dict)
    edges: dict[str, DataFrame] = field(default_factory=dict)


def delete_rows(
    model: EntityModel,
    tables: Mapping[str, DataFrame],
    entity: str,
    keys: DataFrame,
    remove: bool = False,
    edges: Mapping[str, DataFrame] | None = None,
) -> DeleteResult:
    """Delete rows with the model's rules: cascades follow, references of other rows to them are cleared.

    By default the rows become tombstones to be pushed, rows that lose a reference or a member become dirty, and a
    tombstone lets go of owners that live on. ``remove`` takes the rows away as a pull does and leaves
    the dirty flags alone. ``edges`` has the tables of relationships stored as relations.
    """
    gone = gone_keys(model, tables, {entity: keys}, edges)
    kept = {name: edges_without(model, name, table, gone) for name, table in (edges or {}).items()}
    return DeleteResult(apply_gone(model, tables, gone, remove, edges), gone, kept)


def gone_keys(
    model: EntityModel,
    tables: Mapping[str, DataFrame],
    keys: Mapping[str, DataFrame],
    edges: Mapping[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """Uids by root, each once, that go when the given uids, by entity, are deleted: those and their cascades."""
    return taken_along(model, tables, keys, edges)


def bereft_keys(
    model: EntityModel, tables: Mapping[str, DataFrame], gone: Mapping[str, DataFrame]
) -> DataFrame | None:
    """Keys of rows that stay and lose a reference to a gone row, each once; None where no column can refer to one."""
    parts = []
    for root, table in tables.items():
        for relationship in relationships_of(model, root):
            lost, name = gone.get(model.root_of(relationship.target)), relationship.name
            if lost is None or name not in table.columns:
                continue
            held = F.col(name) if relationship.stored is Stored.ARRAY else F.array(name)
            held = table.select(*KEY, F.explode(held).alias("_ref")).select(*KEY, F.col("_ref.uid").alias("_lost"))
            lost = lost.select(F.col("uid").alias("_lost"))
            hit = join_unique(held.filter("_lost is not null"), lost, "_lost", "left_semi", spread_by="uid").select(*KEY)
            parts.append(hit.join(gone[root], "uid", "left_anti").select(*KEY) if root in gone else hit)
    return reduce(lambda a, b: a.unionByName(b), parts).distinct() if parts else None


def apply_gone(
    model: EntityModel,
    tables: Mapping[str, DataFrame],
    gone: Mapping[str, DataFrame],
    remove: bool = False,
    edges: Mapping[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """Tables after the rows of ``gone`` were deleted and references to them cleared. ``edges`` are those before."""
    after = {root: _after_delete(model, root, table, gone, remove) for root, table in tables.items()}
    if not remove:
        for root, rows in sources_of_lost_edges(model, edges or {}, gone).items():
            if root in after:
                after[root] = mark_dirty(after[root], rows)
    return after


def _after_delete(
    model: EntityModel, root: str, table: DataFrame, gone: Mapping[str, DataFrame], remove: bool
) -> DataFrame:
    columns = table.columns
    if root in gone:
        table = table.join(gone[root].withColumn("_own", F.lit(True)), "uid", "left")
        table = table.withColumn("_own", F.coalesce("_own", F.lit(False)))
    else:
        table = table.withColumn("_own", F.lit(False))
    table = table.withColumn("_bereft", F.lit(False))

    for relationship in relationships_of(model, root):
        name, target_root = relationship.name, model.root_of(relationship.target)
        if name not in columns or (target_root not in gone and root not in gone):
            continue
        if relationship.stored is Stored.POINTER:
            before = table.withColumn("_before", F.col(name))
            if target_root in gone:
                before = clear_references(before, name, gone[target_root])
            else:
                before = before.withColumn("_cleared", F.lit(False))
            lets_go = F.lit(relationship.delete_rule is DeleteRule.NULLIFY) & ~F.col("_cleared")
            cleared = F.when(F.col("_own"), lets_go).otherwise(F.col("_cleared"))
            table = before.withColumns(
                {"_bereft": F.col("_bereft") | F.col("_cleared"), name: F.when(~cleared, F.col("_before"))}
            ).drop("_before", "_cleared")
        elif target_root in gone:
            table = remove_from_arrays(table, name, gone[target_root])
            table = table.withColumn("_bereft", F.col("_bereft") | F.col("_cleared")).drop("_cleared")

    if remove:
        return table.filter(~F.col("_own")).select(*columns)
    return table.withColumns(
        {
            "status": F.when(F.col("_own"), _status(Status.DELETED)).otherwise(F.col("status")),
            "is_dirty": F.col("_own") | F.col("_bereft") | F.col("is_dirty"),
        }
    ).select(*columns)
