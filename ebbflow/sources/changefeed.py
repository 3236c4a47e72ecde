"""What changed in a store between two of its versions, from the buckets whose generation differs.

Versions in between need not be there any more. Changes are net: a row that came and went is not told, one that came
and was changed is inserted, one that was changed and went is deleted, and one that went and came back, say as a
placeholder, is updated, where the log of a sync has the first of its changes. ``composed`` puts the logs of single steps
together by the same rules.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbflow.model import KEY
from ebbflow.operators.changes import DELETED, INSERTED, UPDATED
from ebbflow.operators.delta import change_set, edge_change_set
from ebbflow.sources.snapshots import SnapshotStore

#: A clean row that the remote now knows of; nothing of what a user sees changed.
ANNOUNCED = "announced"


def _differing(store: SnapshotStore, name: str, older: int, newer: int) -> set[int]:
    """Buckets of a table that a commit between the versions wrote or emptied; manifests only."""
    before, after = (store.manifest(n).roots.get(name, {}) for n in (older, newer))
    return {bucket for bucket in {*before, *after} if before.get(bucket) != after.get(bucket)}


def row_changes(store: SnapshotStore, root: str, older: int, newer: int) -> DataFrame:
    """uid, change, before, after of a root's rows, whole rows as structs."""
    buckets = _differing(store, root, older, newer)
    changes = change_set(store.read(root, buckets, older), store.read(root, buckets, newer))
    return changes.withColumn("change", _told(F.col("change"))) if store.side == "local" else changes


def _told(change: Column) -> Column:
    before, after = F.col("before"), F.col("after")
    announced = (
        (change == UPDATED)
        & ~before["created_remotely"]
        & after["created_remotely"]
        & (before["is_dirty"] == after["is_dirty"])
        & (before["status"] == after["status"])
    )
    return F.when(announced, F.lit(ANNOUNCED)).otherwise(change)


def edge_changes(store: SnapshotStore, name: str, older: int, newer: int) -> DataFrame:
    """uid, change, before, after of the members of each source in an edge table."""
    buckets = _differing(store, name, older, newer)
    return edge_change_set(store.read(name, buckets, older), store.read(name, buckets, newer))


def changes_between(store: SnapshotStore, older: int, newer: int) -> DataFrame:
    """entity, change, uid of all root tables, as a sync's log has them."""
    logs = []
    for root in store.model.roots:
        changes = row_changes(store, root, older, newer).filter(F.col("change") != ANNOUNCED)
        logs.append(changes.select(F.coalesce("after.entity", "before.entity").alias("entity"), "change", "uid"))
    return reduce(DataFrame.unionByName, logs)


def write_changes(store: SnapshotStore, older: int, newer: int, path: str) -> DataFrame:
    """Write the feed of two versions by kind of change and root, uids with whole rows before and after as JSON; the
    feed is read back. A reader of one kind opens its folders only."""
    parts = []
    for root in store.model.roots:
        changes = row_changes(store, root, older, newer)
        parts.append(
            changes.select(
                F.coalesce("after.entity", "before.entity").alias("entity"),
                "uid",
                F.to_json("before").alias("before"),
                F.to_json("after").alias("after"),
                "change",
                F.lit(root).alias("root"),
            )
        )
    feed = reduce(DataFrame.unionByName, parts)
    feed.write.partitionBy("change", "root").parquet(path)
    return store.spark.read.schema(feed.schema).parquet(path)


def composed(logs: list[DataFrame]) -> DataFrame:
    """Logs of steps that follow each other as one: entity, change, uid, net of what came and went again."""
    steps = [log.select(*KEY, "change", F.lit(i).alias("step")) for i, log in enumerate(logs)]
    spans = reduce(DataFrame.unionByName, steps).groupBy(*KEY).agg(
        F.min_by("change", "step").alias("first"), F.max_by("change", "step").alias("last")
    )
    came, gone = F.col("first") == INSERTED, F.col("last") == DELETED
    net = F.when(came & gone, F.lit(None)).when(came, F.lit(INSERTED)).when(gone, F.lit(DELETED)).otherwise(F.lit(UPDATED))
    return spans.select("entity", net.alias("change"), "uid").filter("change is not null")
