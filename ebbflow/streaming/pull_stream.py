"""Continuous pull: a change feed applied to a snapshot store, one commit per micro-batch.

A micro-batch may be delivered twice. Its number is stored, by root and stream, with the version it made, so the
second delivery is passed over; were it not, applying the same rows again would change nothing. A stream is known
by the id in its checkpoint: a new checkpoint is another stream, and starts with its first batch.

Every row is a register whose last writer wins. The clock of a version is its time, then the tie break, then a digest
of the row, so that no two different versions are equal; it is stored with the row, or with the key of a deleted
one. A version is applied if its clock is above the one held, whatever came before it, so the store ends the same
however the feed is cut and in whatever order its parts come. A row that another writer put there has a time only:
versions of that very time are taken for the same one.

Keys of deleted rows are kept for ever, or, with ``keep_deleted``, till the slowest stream of the root has passed
them by that long. A version older than that is late unless its row is there: its deletion may be forgotten.

Older versions go to ``<store>/late``. Rows that no table can take go to ``<store>/errors`` with the reason: a
mandatory value is missing, the entity is not one of the root's, a reference lacks a part, or it names an entity
that the model does not have.

A relationship stored as a relation has a feed of its own: (src_uid, updated_at, members), all members that the
version of that time has. Members wait beside their table until the row of that very version is there, members of
an older version than the row's are late, and a row that comes takes what waits for it. So rows and members may come
in any order, and the store never shows a row with the members of another of its versions.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ebbflow.functions.refs import clean_references, has_malformed
from ebbflow.model import KEY, EntityModel, Relationship, Status, Stored
from ebbflow.operators import pull
from ebbflow.operators.cascades import edges_without, ends
from ebbflow.operators.joins import join_unique
from ebbflow.operators.save import apply_gone, bereft_keys, gone_keys, placeholders, references_of, relationships_of
from ebbflow.operators.relations import replace_edges
from ebbflow.session import materialized
from ebbflow.sources.snapshots import CLOCK, GONE, MEMBERS, WAITING, Manifest, SnapshotStore


def start_pull(
    feed: DataFrame,
    store: SnapshotStore,
    root: str,
    checkpoint: str,
    tie_break: str | None = None,
    trigger: dict | None = None,
    keep_deleted: timedelta | None = None,
) -> StreamingQuery:
    """Follow the change feed of one root table. Stop and start again with the same ``checkpoint``."""

    def apply(batch: DataFrame, number: int) -> None:
        apply_batch(store, root, batch, number, tie_break, _stream_id(store, checkpoint), keep_deleted)

    writer = feed.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def _stream_id(store: SnapshotStore, checkpoint: str) -> str:
    """The id that a query keeps in its checkpoint."""
    path = store.spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/metadata")
    opened = path.getFileSystem(store.spark._jsc.hadoopConfiguration()).open(path)
    try:
        return json.loads(store.spark._jvm.org.apache.commons.io.IOUtils.toString(opened, "UTF-8"))["id"]
    finally:
        opened.close()


def with_clock(feed: DataFrame, tie_break: str | None = None) -> DataFrame:
    """The columns of a version's clock beside ``updated_at``: the tie break, as a number or a text, and a digest."""
    number, text = F.lit(None), F.lit(None)
    if tie_break is not None:
        if isinstance(feed.schema[tie_break].dataType, T.NumericType):
            number = F.col(tie_break)
        else:
            text = F.col(tie_break)
    row = F.to_json(F.struct(*sorted(feed.columns)))
    values = {"_tie_number": number, "_tie_text": text, "_digest": F.sha2(row, 256)}
    return feed.withColumns({f.name: values[f.name].cast(f.dataType) for f in CLOCK})


def _clock(time: str) -> Column:
    return F.struct(F.col(time).alias("time"), *[f.name for f in CLOCK])


def apply_batch(
    store: SnapshotStore,
    root: str,
    batch: DataFrame,
    number: int,
    tie_break: str | None = None,
    stream: str = "",
    keep_deleted: timedelta | None = None,
) -> bool:
    """Apply one micro-batch and commit it; False when it had been committed before."""
    current = store.manifest()
    delivery = f"{root}/{stream}"
    if number <= current.batches.get(delivery, -1):
        return False
    model = store.model
    folder = f"{root}/stream={stream}/batch={number}"
    judged = batch.withColumn("_fault", pull.row_fault(batch, model, root))
    faulty = judged.filter(F.col("_fault").isNotNull()).withColumnRenamed("_fault", "fault")
    faulty.write.mode("overwrite").parquet(f"{store.path}/errors/{folder}")

    clocked = with_clock(judged.filter(F.col("_fault").isNull()).drop("_fault"), tie_break)
    rest = [c for c in clocked.columns if c not in KEY]
    newest = clocked.groupBy(*KEY).agg(F.max_by(F.struct(*rest), _clock("updated_at")).alias("_row"))
    versions = materialized(newest.select(*KEY, "_row.*"))
    position = versions.agg(F.max("updated_at")).first()[0]
    buckets = store.touched(versions)
    before = store.read(root, buckets, clock=True)
    tombstones = store.read(root + GONE, buckets, clock=True)
    held = before.select(*KEY, _clock("last_modified").alias("_held"), F.lit(True).alias("_there")).unionByName(
        tombstones.select(*KEY, _clock("last_modified").alias("_held"), F.lit(False).alias("_there"))
    )
    held = held.groupBy(*KEY).agg(F.max("_held").alias("_held"), F.max("_there").alias("_there"))
    forgotten = _forgotten_before(current, root, keep_deleted)
    aged = materialized(_aged(versions.join(held, list(KEY), "left"), forgotten))
    extra = [c for c in aged.columns if c not in batch.columns]
    aged.filter("_age = 'late'").drop(*extra).write.mode("overwrite").parquet(f"{store.path}/late/{folder}")
    fresh = aged.filter("_age = 'new'")
    marks = _raised(current.watermarks, pull.collect_watermarks(pull.advance(None, fresh), model))

    kinds = [f.name for f in CLOCK]
    schema = store.schema(root).names
    incoming = pull.decode_rows(fresh.drop("_held", "_age", *kinds), model, root)
    wanted = [c for c in incoming.columns if c in schema]
    incoming = materialized(incoming.select(*wanted).join(fresh.select(*KEY, "_there", *kinds), list(KEY)))
    deleted = F.col("status") == int(Status.DELETED)
    removed = incoming.filter(deleted & F.col("_there")).select("uid")
    arrived = incoming.filter(~deleted).drop("_there")

    touched: dict[str, set[int]] = {root: store.touched(incoming)}
    removes = _is_related(model, root) and bool(removed.limit(1).collect())
    if removes:
        for other, keys in _affected(store, root, removed, arrived.drop(*kinds)).items():
            touched[other] = touched.get(other, set()) | store.touched(keys)

    missing: dict[str, DataFrame] = {}
    refs = references_of(arrived, _relationships(model, root))
    if refs is not None:
        for target in {model.root_of(r.target) for r in _relationships(model, root)}:
            named = materialized(refs.filter(F.col("entity").isin(model.family(target)) & F.col("uid").isNotNull()).distinct())
            there = store.lookup(target, named).select("uid")
            if target == root:
                there = there.unionByName(arrived.select("uid"))
            missing[target] = materialized(placeholders(named, there, created_remotely=True))
            touched[target] = touched.get(target, set()) | store.touched(missing[target])

    edges = {name: store.read(name) for name in store.edge_names() if name in current.roots}
    tables = {name: store.read(name, at, clock=not store.is_edges(name)) for name, at in touched.items()}
    old = tables[root]
    tables[root] = _written_over(old, arrived, incoming)
    if removes:
        rows = {name: table for name, table in tables.items() if not store.is_edges(name)}
        walked = rows | {root: rows[root].unionByName(old.join(removed, "uid", "left_semi"))}
        gone = gone_keys(model, walked, {root: removed}, edges)
        tables |= apply_gone(model, rows, gone, remove=True)
        for name in tables:
            if store.is_edges(name):
                tables[name] = edges_without(model, name, tables[name], gone)
    settled = _settled_members(store, root, incoming)
    for name, members in settled.items():
        waiting = name + WAITING
        touched[name] = touched.get(name, set()) | members.buckets
        touched[waiting] = members.buckets
        edges_now = store.read(name, touched[name])
        edges_now = edges_without(model, name, edges_now, gone) if removes else edges_now
        tables[name] = replace_edges(edges_now, members.edges, members.sources)
        tables[waiting] = members.waiting
        for target, rows in _missing_members(store, name, members.edges, arrived if ends(model, name)[1] == root else None).items():
            missing[target] = rows if target not in missing else missing[target].unionByName(rows).dropDuplicates(["uid"])
            more = store.touched(rows)
            fresh_buckets = more - touched.get(target, set())
            if target not in tables:
                tables[target] = store.read(target, more, clock=True)
            elif fresh_buckets:
                tables[target] = tables[target].unionByName(store.read(target, fresh_buckets, clock=True))
            touched[target] = touched.get(target, set()) | more
    for target, rows in missing.items():
        tables[target] = tables[target].unionByName(rows, allowMissingColumns=True)
    kept = store.read(root + GONE, touched[root], clock=True).join(incoming.select(*KEY), list(KEY), "left_anti")
    if forgotten is not None:
        kept = kept.filter(F.col("last_modified") >= pull.ntz(forgotten))
    gone_now = incoming.filter(deleted).select(*KEY, "last_modified", *kinds)
    tables[root + GONE] = kept.unionByName(gone_now, allowMissingColumns=True)
    touched[root + GONE] = touched[root]
    positions = {} if position is None else {delivery: max(position, current.positions.get(delivery, position))}
    store.commit(tables, touched, watermarks=marks, batches={delivery: number}, positions=positions)
    return True


@dataclass
class _Members:
    """Members whose source's version is there: their sources and edges, what waits on, and the buckets of all."""

    sources: DataFrame
    edges: DataFrame
    waiting: DataFrame
    buckets: set[int]


def _as_edges(members: DataFrame) -> DataFrame:
    edges = members.select("src_uid", F.explode(clean_references(F.col("members"))).alias("_ref"))
    return edges.select("src_uid", F.col("_ref.entity").alias("dst_entity"), F.col("_ref.uid").alias("dst_uid")).distinct()


def _settled_members(store: SnapshotStore, root: str, incoming: DataFrame) -> dict[str, _Members]:
    """By edge table of a root's relations: what waited for the versions that have arrived; what waited for versions
    that these have passed by is dropped."""
    found, there = {}, store.manifest().roots
    for name in store.edge_names():
        if ends(store.model, name)[0] != root or not there.get(name + WAITING):
            continue
        there_now = F.col("status") != int(Status.DELETED)
        rows = materialized(incoming.select(F.col("uid").alias("src_uid"), F.col("last_modified").alias("_at"), there_now.alias("_is")))
        buckets = store.touched(rows.select(F.col("src_uid").alias("uid")))
        waiting = store.read(name + WAITING, buckets).join(rows, "src_uid", "left")
        ready = materialized(waiting.filter((F.col("updated_at") == F.col("_at")) & F.col("_is")).select("src_uid", "members"))
        on = waiting.filter(F.col("_at").isNull() | (F.col("updated_at") > F.col("_at"))).select(*MEMBERS.names)
        found[name] = _Members(ready.select("src_uid"), _as_edges(ready), on, buckets)
    return found


def _missing_members(store: SnapshotStore, name: str, edges: DataFrame, arrived: DataFrame | None) -> dict[str, DataFrame]:
    """Placeholders, by root, for targets of new edges that are not there."""
    target = ends(store.model, name)[1]
    named = edges.select(F.col("dst_entity").alias("entity"), F.col("dst_uid").alias("uid"))
    named = materialized(named.filter(F.col("entity").isin(store.model.family(target))).distinct())
    there = store.lookup(target, named).select("uid")
    if arrived is not None:
        there = there.unionByName(arrived.select("uid"))
    rows = materialized(placeholders(named, there, created_remotely=True))
    return {} if rows.isEmpty() else {target: rows}


def start_pull_members(
    feed: DataFrame, store: SnapshotStore, name: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Follow the feed of members of one relationship stored as a relation, ``Entity.relationship``."""

    def apply(batch: DataFrame, number: int) -> None:
        apply_members(store, name, batch, number, _stream_id(store, checkpoint))

    writer = feed.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def apply_members(store: SnapshotStore, name: str, batch: DataFrame, number: int, stream: str = "") -> bool:
    """Apply one micro-batch of members (src_uid, updated_at, members); False when it had been committed before.

    Of two records for one version the one with the greater members, as sorted arrays, counts. Records without a
    source or a time, or with a member that lacks a part, go to ``<store>/errors``.
    """
    current = store.manifest()
    delivery = f"{name}/{stream}"
    if number <= current.batches.get(delivery, -1):
        return False
    folder = f"{name}/stream={stream}/batch={number}"
    root, target = ends(store.model, name)
    sound = F.col("src_uid").isNotNull() & F.col("updated_at").isNotNull() & ~has_malformed(F.col("members"))
    sound = sound & ~F.coalesce(F.exists("members", lambda r: ~r["entity"].isin(store.model.family(target))), F.lit(False))
    batch.filter(~sound).write.mode("overwrite").parquet(f"{store.path}/errors/{folder}")
    tidy = F.coalesce(F.array_sort(F.array_distinct(clean_references(F.col("members")))), F.array().cast(MEMBERS["members"].dataType))
    given = batch.filter(sound).select("src_uid", "updated_at", tidy.alias("members"))
    keys = materialized(given.select(F.col("src_uid").alias("uid")).distinct())
    buckets = store.touched(keys)
    known = given.unionByName(store.read(name + WAITING, buckets))
    known = known.groupBy("src_uid", "updated_at").agg(F.max("members").alias("members"))
    rows = store.lookup(root, keys).select(F.col("uid").alias("src_uid"), F.col("last_modified").alias("_at"))
    judged = materialized(known.join(rows, "src_uid", "left"))
    late = F.col("updated_at") < F.col("_at")
    judged.filter(late).drop("_at").write.mode("overwrite").parquet(f"{store.path}/late/{folder}")
    ready = materialized(judged.filter(F.col("updated_at") == F.col("_at")).select("src_uid", "members"))
    waiting = judged.filter(F.col("_at").isNull() | (F.col("updated_at") > F.col("_at"))).select(*MEMBERS.names)
    new = _as_edges(ready)
    tables = {
        name: replace_edges(store.read(name, buckets), new, ready.select("src_uid")),
        name + WAITING: waiting,
    }
    touched = {name: buckets, name + WAITING: buckets}
    for root_of_target, missing in _missing_members(store, name, new, None).items():
        touched[root_of_target] = store.touched(missing)
        held = store.read(root_of_target, touched[root_of_target], clock=True)
        tables[root_of_target] = held.unionByName(missing, allowMissingColumns=True)
    store.commit(tables, touched, batches={delivery: number})
    return True


def _aged(versions: DataFrame, forgotten: datetime | None) -> DataFrame:
    """``_age`` of each version beside the clock held: new, late, or again for one that is there already."""
    clock, held = _clock("updated_at"), F.col("_held")
    unclocked = held["_digest"].isNull() & (held["time"] == F.col("updated_at"))
    age = F.when(held.isNotNull() & F.coalesce(unclocked, F.lit(False)), F.lit("again"))
    age = age.when(held.isNotNull() & (clock < held), F.lit("late")).when(clock.eqNullSafe(held), F.lit("again"))
    there = F.coalesce("_there", F.lit(False))
    if forgotten is not None:
        age = age.when(~there & (F.col("updated_at") < pull.ntz(forgotten)), F.lit("late"))
    return versions.withColumns({"_age": age.otherwise(F.lit("new")), "_there": there})


def _forgotten_before(manifest: Manifest, root: str, keep_deleted: timedelta | None) -> datetime | None:
    """The low-water mark of a root: what every stream of it has passed, less the time that deletions are kept."""
    passed = [at for delivery, at in manifest.positions.items() if delivery.startswith(f"{root}/")]
    return None if keep_deleted is None or not passed else min(passed) - keep_deleted


def _written_over(table: DataFrame, arrived: DataFrame, incoming: DataFrame) -> DataFrame:
    """The table with arrived rows written over it and other rows of ``incoming`` taken out.

    Given columns overwrite and the dirty flag is left alone; a new row is known to the remote.
    """
    old = table.join(incoming.select(*KEY), list(KEY), "left_anti")
    kept = table.select(*KEY, *[c for c in table.columns if c not in KEY and c not in arrived.columns])
    merged = arrived.join(kept.withColumn("_old", F.lit(True)), list(KEY), "left")
    merged = merged.withColumns(
        {
            "is_dirty": F.coalesce("is_dirty", F.lit(False)),
            "created_remotely": F.when(F.col("_old"), F.col("created_remotely")).otherwise(F.lit(True)),
        }
    )
    return old.unionByName(merged.select(*table.columns))


def _raised(old: Mapping[str, datetime], new: Mapping[str, datetime]) -> dict[str, datetime]:
    """Watermarks never fall back."""
    return {entity: max(at, old.get(entity, at)) for entity, at in new.items()}


def _relationships(model: EntityModel, root: str) -> list[Relationship]:
    """Those that a row holds itself."""
    return [r for r in relationships_of(model, root) if r.stored in (Stored.POINTER, Stored.ARRAY)]


def _is_related(model: EntityModel, root: str) -> bool:
    """Whether rows of a root refer to others, or others to them."""
    own = any(relationships_of(model, root))
    return own or any(model.root_of(r.target) == root for other in model.roots for r in relationships_of(model, other))


def _affected(store: SnapshotStore, root: str, removed: DataFrame, arrived: DataFrame) -> dict[str, DataFrame]:
    """Keys, by table, of rows that a removal can take along or that can lose a reference or an edge by it, as the
    store is or as it will be."""
    model, tables = store.model, store.tables()
    edges = {name: store.read(name) for name in store.edge_names()}
    walked = tables | {root: tables[root].unionByName(arrived, allowMissingColumns=True)}
    gone = gone_keys(model, walked, {root: removed}, edges)
    affected: dict[str, DataFrame] = dict(gone)
    bereft = bereft_keys(model, walked, gone)
    if bereft is not None:
        for other in model.roots:
            keys = bereft.filter(F.col("entity").isin(model.family(other))).select("uid")
            affected[other] = affected[other].unionByName(keys) if other in affected else keys
    for name, table in edges.items():
        source, target = ends(model, name)
        for end, at in (("src_uid", source), ("dst_uid", target)):
            if at in gone:
                lost = gone[at].select(F.col("uid").alias(end))
                keys = join_unique(table, lost, end, "left_semi", spread_by="dst_uid").select(F.col("src_uid").alias("uid"))
                affected[name] = affected[name].unionByName(keys) if name in affected else keys
    return affected
