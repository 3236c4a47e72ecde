"""A sync of two stores as a delta: only rows that something can happen to are read, only buckets that change written.

The rows a sync can touch are found first, as keys by root: dirty rows here, the increment there, what either refers
to, and, where rows go, what the delete rules take along and who refers to it. Both sides are read at those keys
alone, and the sync of ``operators.sync`` runs over these small tables: every decision in it is made by key, so it
does to them what it would do to the whole. Before and after are then joined by key to the change sets, one for each
side, rows that stay as they were left out, and each store merges its own by copy on write.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbflow.model import EntityModel, Status, Stored
from ebbflow.operators import pull, push
from ebbflow.operators.cascades import ends, sources_of_lost_edges, taken_along
from ebbflow.operators.save import bereft_keys, references_of, relationships_of
from ebbflow.operators.sync import sync
from ebbflow.session import materialized, materialized_all, materialized_parts, together
from ebbflow.sources.snapshots import SnapshotStore

INSERTED, UPDATED, DELETED = "inserted", "updated", "deleted"


@dataclass
class SyncCommit:
    """What a delta sync did. Versions are those that hold now; change sets are by table, of changed keys only."""

    local_version: int
    remote_version: int
    change_log: DataFrame | None
    counters: DataFrame | None
    errors: DataFrame | None
    local_changes: dict[str, DataFrame] = field(default_factory=dict)
    remote_changes: dict[str, DataFrame] = field(default_factory=dict)


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def _packed(rows: DataFrame, key: str, name: str) -> DataFrame:
    """Key, and the rest of the row as a struct."""
    return rows.select(F.col(key).alias("uid"), F.struct(*[c for c in rows.columns if c != key]).alias(name))


def _whole(rows: DataFrame, key: str, name: str) -> Column:
    """The row that ``_packed`` put under ``name``, its key in its place again; null where there is none."""
    fields = [F.col("uid").alias(c) if c == key else F.col(name)[c].alias(c) for c in rows.columns]
    return F.when(F.col(name).isNotNull(), F.struct(*fields)).alias(name)


def _comparable(rows: DataFrame, key: str, name: str) -> Column:
    """What ``_packed`` put under ``name`` in a form that can be compared: maps as their sorted entries."""
    kinds = {c: rows.schema[c].dataType for c in rows.columns if c != key}
    if not any(isinstance(kind, T.MapType) for kind in kinds.values()):
        return F.col(name)
    row = F.col(name)
    fields = [(F.array_sort(F.map_entries(row[c])) if isinstance(k, T.MapType) else row[c]).alias(c) for c, k in kinds.items()]
    return F.when(row.isNotNull(), F.struct(*fields))


def change_set(before: DataFrame, after: DataFrame, key: str = "uid") -> DataFrame:
    """uid, change, before, after of every key whose row differs; a side without the row is null.

    A row comes to the join once, without its key; what it is compared by is made there.
    """
    after = after.select(*before.columns)
    both = _packed(before, key, "before").join(_packed(after, key, "after"), "uid", "full")
    differs = both.filter(~_comparable(before, key, "before").eqNullSafe(_comparable(after, key, "after")))
    change = F.when(F.col("before").isNull(), INSERTED).when(F.col("after").isNull(), DELETED).otherwise(UPDATED)
    return differs.select("uid", change.alias("change"), _whole(before, key, "before"), _whole(after, key, "after"))


def edge_change_set(before: DataFrame, after: DataFrame) -> DataFrame:
    """uid, change, before, after of every source whose members differ, members as a sorted array.

    A source's members are put together in one value: those of changed sources only, as its row sends them.
    """

    def members(edges: DataFrame, name: str) -> DataFrame:
        together = F.array_sort(F.collect_set(F.struct("dst_entity", "dst_uid")))
        return edges.groupBy(F.col("src_uid").alias("uid")).agg(together.alias(name))

    both = members(before, "before").join(members(after, "after"), "uid", "full")
    differs = both.filter(~F.col("before").eqNullSafe(F.col("after")))
    change = F.when(F.col("before").isNull(), INSERTED).when(F.col("after").isNull(), DELETED).otherwise(UPDATED)
    return differs.select("uid", change.alias("change"), "before", "after")


class _Keys:
    """Uids by root, gathered piece by piece and written together."""

    def __init__(self) -> None:
        self._parts: dict[str, list[DataFrame]] = {}

    def add(self, root: str, rows: DataFrame) -> None:
        self._parts.setdefault(root, []).append(rows.select("uid"))

    def add_references(self, model: EntityModel, roots: list[str], refs: DataFrame | None) -> None:
        if refs is not None:
            for root in roots:
                self.add(root, refs.filter(F.col("entity").isin(model.family(root))))

    def written(self) -> dict[str, DataFrame]:
        """Each uid once; roots without any are left out."""
        if not self._parts:
            return {}
        rows = _union([_union(parts).withColumn("root", F.lit(root)) for root, parts in self._parts.items()])
        return materialized_parts(rows.filter("uid is not null").distinct(), "root")


def _at(store: SnapshotStore, names: list[str], keys: Mapping[str, DataFrame], model: EntityModel) -> dict[str, DataFrame]:
    """The store's rows, and edges, at the given keys."""
    root_of = {name: ends(model, name)[0] if store.is_edges(name) else name for name in names}
    found = store.lookup_all({name: keys[root] for name, root in root_of.items() if root in keys})
    return {name: found[name] if name in found else store.read(name, []) for name in names}


def _written(here: dict[str, DataFrame], there: dict[str, DataFrame]) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Both sides written as small tables, side by side."""
    both = materialized_all({f"here {n}": t for n, t in here.items()} | {f"there {n}": t for n, t in there.items()})
    return {n: both[f"here {n}"] for n in here}, {n: both[f"there {n}"] for n in there}


def _relationships(model: EntityModel, root: str):
    return [r for r in relationships_of(model, root) if r.stored in (Stored.POINTER, Stored.ARRAY)]


def _edge_references(edges: list[DataFrame]) -> list[DataFrame]:
    return [e.select(F.col("dst_entity").alias("entity"), F.col("dst_uid").alias("uid")) for e in edges]


def sync_stores(
    local: SnapshotStore,
    remote: SnapshotStore,
    *,
    push_time: datetime,
    now: datetime,
    policy: push.Policy = push.Policy.SERVER_WINS,
    full: bool = False,
    on_error: str = "fail",
) -> SyncCommit:
    """Push this store's dirty rows, pull the other's increment, and commit both; see ``sync`` for the rules.

    The remote is committed first. Were the run lost between the two commits, the next one pushes again by key and
    makes no second row. Errors with ``on_error="fail"`` end the sync before either store is written. A sync that
    finds nothing to do makes no version.
    """
    model, roots = local.model, local.model.roots
    marks = local.manifest().watermarks
    names = local.edge_names()

    dirty = {root: local.dirty_rows(root) for root in roots}
    changed = {root: remote.changed_rows(root, marks, now, full) for root in roots}
    first = _Keys()
    for root in roots:
        first.add(root, dirty[root])
        first.add(root, changed[root])
    keys = first.written()
    nameless = {root: changed[root].filter("uid is null") for root in roots}
    there_are = together({root: (lambda rows=rows: bool(rows.limit(1).collect())) for root, rows in nameless.items()})
    unnamed = {root: rows for root, rows in nameless.items() if there_are[root]}
    if not keys and not unnamed:
        return SyncCommit(local.manifest().number, remote.manifest().number, None, None, None)

    here, there = _at(local, [*roots, *names], keys, model), _at(remote, [*roots, *names], keys, model)
    wanted = _Keys()
    for root, rows in keys.items():
        wanted.add(root, rows)
        wanted.add_references(model, roots, references_of(here[root], _relationships(model, root)))
        incoming = pull.decode_rows(there[root], model, root)
        wanted.add_references(model, roots, references_of(incoming, _relationships(model, root)))
    for refs in _edge_references([side[name] for side in (here, there) for name in names]):
        wanted.add_references(model, roots, refs)
    for root, rows in _lost(local, keys, here, there).items():
        wanted.add(root, rows)
    wanted_keys = wanted.written()

    there = _at(remote, [*roots, *names], wanted_keys, model)
    there = {name: rows.unionByName(unnamed[name]) if name in unnamed else rows for name, rows in there.items()}
    here, there = _written(_at(local, [*roots, *names], wanted_keys, model), there)
    edges_here, edges_there = ({name: side.pop(name) for name in names} for side in (here, there))
    result = sync(
        model,
        here,
        there,
        policy=policy,
        push_time=push_time,
        now=now,
        watermarks=marks,
        full=full,
        on_error=on_error,
        local_edges=edges_here,
        remote_edges=edges_there,
        written=True,
    )

    def changes(before: dict, after: dict, before_edges: dict, after_edges: dict) -> dict[str, DataFrame]:
        sets = {root: change_set(before[root].filter("uid is not null"), after[root].filter("uid is not null")) for root in roots}
        sets |= {name: edge_change_set(before_edges[name], after_edges[name]) for name in names if name in after_edges}
        return sets

    own = {"log": result.change_log, "errors": result.errors, "marks": result.watermarks}
    here_sets = changes(here, result.local, edges_here, result.local_edges)
    there_sets = changes(there, result.remote, edges_there, result.remote_edges)
    local_changes, remote_changes = _written(here_sets, there_sets | own)
    log, errors, marked = (remote_changes.pop(name) for name in own)
    raised = pull.collect_watermarks(marked, model)
    remote_version = _merged(remote, remote_changes)
    local_version = _merged(local, local_changes, raised if raised != marks else None)
    return SyncCommit(local_version, remote_version, log, result.counters, errors, local_changes, remote_changes)


def _merged(store: SnapshotStore, changes: dict[str, DataFrame], watermarks: dict[str, datetime] | None = None) -> int:
    there_are = together({name: (lambda rows=rows: bool(rows.limit(1).collect())) for name, rows in changes.items()})
    held = {name: rows.select("uid", "after") for name, rows in changes.items() if there_are[name]}
    if not held and not watermarks:
        return store.manifest().number
    return store.merge(held, watermarks=watermarks)


def _lost(
    store: SnapshotStore, keys: Mapping[str, DataFrame], here: Mapping[str, DataFrame], there: Mapping[str, DataFrame]
) -> dict[str, DataFrame]:
    """Uids by root of local rows that may go with deleted ones, and of rows that refer to one that goes.

    More may be found than goes in the end: the walk sees references as they are and as they arrive. It reads the
    reference columns and edges of the whole store, and only where something is deleted at all.
    """
    model = store.model
    removed, dropped = {}, {}
    for root in keys:
        deleted = there[root].filter(F.col("status") == int(Status.DELETED)).select("uid")
        removed[root] = here[root].join(deleted, "uid", "left_semi").select("uid")
        own = here[root].filter(F.col("is_dirty") & ~F.col("created_remotely") & (F.col("status") == int(Status.DELETED)))
        dropped[root] = own.select("uid")
    jobs = {f"{kind} {root}": rows for kind, side in (("removed", removed), ("dropped", dropped)) for root, rows in side.items()}
    there_are = together({name: (lambda rows=rows: bool(rows.limit(1).collect())) for name, rows in jobs.items()})
    removed = {root: rows for root, rows in removed.items() if there_are[f"removed {root}"]}
    dropped = {root: rows for root, rows in dropped.items() if there_are[f"dropped {root}"]}
    if not removed and not dropped:
        return {}
    tables = {root: store.read(root) for root in model.roots}
    edges = {name: store.read(name) for name in store.edge_names()}
    found: dict[str, list[DataFrame]] = {}
    gone = {root: [rows] for root, rows in dropped.items()}
    if removed:
        walked = {}
        for root, table in tables.items():
            arriving = pull.decode_rows(there[root], model, root) if root in keys else None
            walked[root] = table if arriving is None else table.unionByName(arriving, allowMissingColumns=True)
        for root, rows in taken_along(model, walked, removed, edges).items():
            found.setdefault(root, []).append(rows)
            gone.setdefault(root, []).append(rows)
    lost = materialized_all({root: _union(parts).distinct() for root, parts in gone.items()})
    bereft = bereft_keys(model, tables, lost)
    if bereft is not None:
        bereft = materialized(bereft)
        for root in model.roots:
            found.setdefault(root, []).append(bereft.filter(F.col("entity").isin(model.family(root))).select("uid"))
    for root, rows in sources_of_lost_edges(model, edges, lost).items():
        found.setdefault(root, []).append(rows)
    return {root: _union(parts) for root, parts in found.items()}
