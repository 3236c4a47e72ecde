"""Pull: a bounded increment of the remote applied to the local table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbflow.functions.refs import clean_references, has_malformed, is_malformed
from ebbflow.model import KEY, EntityModel, Status, Stored, user_columns
from ebbflow.operators import push
from ebbflow.operators.joins import narrowed, side_by_side

SKIP = "skip"
IGNORE = "ignore"
INSERT = "insert"
UPDATE = "update"
DELETE_LOCAL = "delete_local"

MISSING_VALUE = "error_missing_value"
UNKNOWN_ENTITY = "error_unknown_entity"
MALFORMED_REFERENCE = "error_malformed_reference"
UNKNOWN_TARGET = "error_unknown_target"

CHANGES = (INSERT, UPDATE, DELETE_LOCAL)

PAGE_SIZE = 100


def ntz(instant: Column | datetime) -> Column:
    """An instant without a zone, to the microsecond, as the tables keep it."""
    if isinstance(instant, Column):
        return instant
    return F.lit(instant.isoformat(sep=" ", timespec="microseconds")).cast("timestamp_ntz")


# What is read


def change_scan(
    remote: DataFrame, entity: str | None = None, after: Column | None = None, before: Column | None = None
) -> DataFrame:
    """Remote rows of one entity with ``updated_at`` strictly between the bounds, either may be missing."""
    rows = remote
    if entity is not None:
        rows = rows.filter(F.col("entity") == entity)
    if after is not None:
        rows = rows.filter(F.col("updated_at") > after)
    if before is not None:
        rows = rows.filter(F.col("updated_at") < before)
    return rows


def change_page(scan: DataFrame, number: int, size: int = PAGE_SIZE) -> DataFrame:
    """One page for a user to look at; a sync reads the scan as a whole."""
    return scan.orderBy("updated_at", "uid").offset(number * size).limit(size)


def change_page_after(scan: DataFrame, updated_at: Column, uid: Column, size: int = PAGE_SIZE) -> DataFrame:
    """The page that follows a known last row; its cost does not grow with the page's number."""
    later = (F.col("updated_at") > updated_at) | ((F.col("updated_at") == updated_at) & (F.col("uid") > uid))
    return scan.filter(later).orderBy("updated_at", "uid").limit(size)


Watermarks = Mapping[str, datetime]


def _above(watermarks: Watermarks) -> Column:
    """Rows above their entity's watermark; literals, so that the scan can skip row groups."""
    above = ~F.col("entity").isin(list(watermarks)) if watermarks else F.lit(True)
    for entity, instant in watermarks.items():
        above = above | ((F.col("entity") == entity) & (F.col("updated_at") > ntz(instant)))
    return above


def increment(
    remote: DataFrame,
    watermarks: Watermarks | None,
    now: Column | datetime,
    full: bool = False,
    entities: Sequence[str] | None = None,
) -> DataFrame:
    """Rows above their entity's watermark and below ``now``, both strict; one bound for all entities.

    With ``entities``, all that the table holds, the lowest watermark is a bound of its own, by which the
    scan skips row groups even where entities are mixed.
    """
    rows = remote.filter(F.col("updated_at") < ntz(now))
    if full or not watermarks:
        return rows
    if entities and all(entity in watermarks for entity in entities):
        rows = rows.filter(F.col("updated_at") > ntz(min(watermarks[entity] for entity in entities)))
    return rows.filter(_above(watermarks))


def late_rows(feed: DataFrame, watermarks: Watermarks) -> DataFrame:
    """Rows at or below their entity's watermark: no increment reads them, only a full pull does."""
    return feed.filter(~_above(watermarks))


def latest_version(feed: DataFrame, tie_break: str | None = None) -> DataFrame:
    """The newest row of each key in a feed with several versions.

    An aggregate, not a window: versions of a busy key are reduced in each task before the shuffle.
    """
    rest = [c for c in feed.columns if c not in KEY]
    rank = F.struct("updated_at", tie_break) if tie_break else F.col("updated_at")
    newest = feed.groupBy(*KEY).agg(F.max_by(F.struct(*rest), rank).alias("_row"))
    return newest.select(*KEY, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*feed.columns)


def row_fault(rows: DataFrame, model: EntityModel, root: str) -> Column:
    """Why no table can take a remote row, null where one can; the first reason of several."""
    malformed, unknown = F.lit(False), F.lit(False)
    for relationship in {r.name: r for name in model.family(root) for r in model.relationships(name)}.values():
        if relationship.name not in rows.columns:
            continue
        if relationship.stored is Stored.POINTER:
            held = F.col(relationship.name)
            malformed = malformed | F.coalesce(is_malformed(held), F.lit(False))
            unknown = unknown | F.coalesce(~held["entity"].isin(model.names), F.lit(False))
        elif relationship.stored is Stored.ARRAY:
            held = F.col(relationship.name)
            malformed = malformed | F.coalesce(has_malformed(held), F.lit(False))
            unknown = unknown | F.coalesce(F.exists(held, lambda r: ~r["entity"].isin(model.names)), F.lit(False))
    missing = F.col("uid").isNull() | F.col("entity").isNull() | F.col("updated_at").isNull() | F.col("status").isNull()
    return (
        F.when(missing, F.lit(MISSING_VALUE))
        .when(~F.col("entity").isin(model.family(root)), F.lit(UNKNOWN_ENTITY))
        .when(malformed, F.lit(MALFORMED_REFERENCE))
        .when(unknown, F.lit(UNKNOWN_TARGET))
    )


def pull_errors(rows: DataFrame, model: EntityModel, root: str, remote: DataFrame | None = None) -> DataFrame:
    """entity, uid, action, code, remote_rows of remote rows that a pull cannot take, in the form of push errors:
    without a mandatory value, of an entity the root's table does not hold, with a reference that lacks a part or
    names an entity outside the model, or with a key that comes more than once: among the rows, or, where ``remote`` is given, in the whole remote table.
    Counted on keys, before the shuffle."""
    faulty = rows.withColumn("action", row_fault(rows, model, root)).filter(F.col("action").isNotNull())
    faulty = faulty.select(*KEY, "action").withColumn("remote_rows", F.lit(1).cast("long"))
    counted = rows.select(*KEY)
    if remote is not None:
        counted = narrowed(remote.select(*KEY), counted, KEY).join(counted.distinct(), list(KEY), "left_semi")
    twice = counted.groupBy(*KEY).agg(F.count(F.lit(1)).alias("remote_rows")).filter("remote_rows > 1")
    twice = twice.filter("uid is not null and entity is not null").withColumn("action", F.lit(push.DUPLICATE_UID))
    code = F.when(F.col("action") == push.DUPLICATE_UID, F.lit(push.ERROR_DUPLICATE_UID)).when(
        F.col("action") == MALFORMED_REFERENCE, F.lit(push.ERROR_MALFORMED_REFERENCE)
    )
    return faulty.unionByName(twice).select(*KEY, "action", code.alias("code"), "remote_rows")


def without_errors(rows: DataFrame, model: EntityModel, root: str) -> DataFrame:
    """The rows without a fault of their own; those whose key comes twice are still there."""
    return rows.filter(row_fault(rows, model, root).isNull())


def decode_rows(remote: DataFrame, model: EntityModel | None = None, root: str | None = None) -> DataFrame:
    """Remote rows as the local table takes them: ``last_modified`` is ``updated_at``, arrays are cleaned,
    access entries and to-many columns that another side owns are left out; the status comes along."""
    drop = {"acl"}
    arrays: set[str] = set()
    if model is not None and root is not None:
        for name in model.family(root):
            for relationship in model.relationships(name):
                if relationship.stored is Stored.ARRAY:
                    arrays.add(relationship.name)
                elif not model.read_from_remote(name, relationship):
                    drop.add(relationship.name)
    columns = [
        (clean_references(F.col(c)) if c in arrays else F.col(c)).alias(c)
        for c in user_columns(remote.columns)
        if c not in drop
    ]
    return remote.select(
        *KEY, F.col("status").cast("short").alias("status"), F.col("updated_at").alias("last_modified"), *columns
    )


# What is done with it


def pull_action() -> Column:
    """The action for an incoming row (``_new_`` columns) beside the local one."""
    known = F.col("_old")
    deleted = F.col("_new_status") == int(Status.DELETED)
    same = F.coalesce(F.col("last_modified") == F.col("_new_last_modified"), F.lit(False))
    return (
        F.when(known & same, F.lit(SKIP))
        .when(~known & deleted, F.lit(IGNORE))
        .when(~known, F.lit(INSERT))
        .when(deleted, F.lit(DELETE_LOCAL))
        .otherwise(F.lit(UPDATE))
    )


def pull_plan(local: DataFrame, incoming: DataFrame) -> DataFrame:
    """One narrow row per incoming row: key, its time and the action. ``incoming`` is decoded."""
    new = incoming.select(*KEY, F.col("last_modified").alias("_new_last_modified"), F.col("status").alias("_new_status"))
    old = narrowed(local.select(*KEY, "last_modified"), incoming, KEY).withColumn("_old", F.lit(True))
    joined = new.join(old, list(KEY), "left").withColumn("_old", F.coalesce("_old", F.lit(False)))
    return joined.select(*KEY, F.col("_new_last_modified").alias("updated_at"), pull_action().alias("action"))


@dataclass
class PullResult:
    """The local table after a pull, and the uids to be removed under the model's delete rules."""

    local: DataFrame
    removed: DataFrame


def apply_pull(local: DataFrame, incoming: DataFrame) -> PullResult:
    """Inserts and updates written over the local table; deleted rows are taken out.

    Given columns overwrite and the dirty flag is left alone; a new row is known to the remote. A column
    that the incoming rows lack keeps its local value.
    """
    both = side_by_side(local, incoming, KEY)
    both = both.withColumn("_action", F.when(F.col("_new"), pull_action()).otherwise(F.lit("none")))
    takes = F.col("_action").isin(INSERT, UPDATE)
    columns = []
    for name in local.columns:
        if name in KEY:
            columns.append(F.col(name))
        elif name == "is_dirty":
            columns.append(F.coalesce(F.col(name), F.lit(False)).alias(name))
        elif name == "created_remotely":
            columns.append(F.when(F.col("_old"), F.col(name)).otherwise(F.lit(True)).alias(name))
        elif name in incoming.columns:
            columns.append(F.when(takes, F.col(f"_new_{name}")).otherwise(F.col(name)).alias(name))
        else:
            columns.append(F.col(name))
    after = both.filter(~F.col("_action").isin(IGNORE, DELETE_LOCAL)).select(*columns)
    removed = pull_plan(local, incoming).filter(F.col("action") == DELETE_LOCAL).select(*KEY)
    return PullResult(after, removed)


def advance(watermarks: DataFrame | None, pulled: DataFrame) -> DataFrame:
    """Greatest ``updated_at`` per entity over old watermarks and all pulled rows, skipped ones included."""
    seen = pulled.groupBy("entity").agg(F.max("updated_at").alias("_seen"))
    if watermarks is None:
        return seen.select("entity", F.col("_seen").alias("watermark"))
    joined = watermarks.select("entity", "watermark").join(seen, "entity", "full")
    return joined.select("entity", F.greatest("watermark", "_seen").alias("watermark"))


def collect_watermarks(watermarks: DataFrame, model: EntityModel) -> dict[str, datetime]:
    """Watermarks on the driver: one per entity of the model, no more."""
    rows = watermarks.filter(F.col("entity").isin(model.names)).groupBy("entity").agg(F.max("watermark").alias("at"))
    return {row["entity"]: row["at"] for row in rows.collect()}
