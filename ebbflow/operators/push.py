"""Push: local dirty rows against the remote, one action per row, then both sides after it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from enum import Enum

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbflow.functions.acl import merge_maps
from ebbflow.model import KEY, Status, user_columns
from ebbflow.operators.joins import join_unique, narrowed, prefixed, side_by_side


class Policy(Enum):
    """Who wins when both sides changed a row."""

    SERVER_WINS = "server_wins"
    CLIENT_WINS = "client_wins"


# Error codes that callers may test for.
ERROR_MALFORMED_REFERENCE = 3
ERROR_DUPLICATE_UID = 200
ERROR_NOT_FOUND = 201

DROP_LOCAL = "drop_local"
INSERT_REMOTE = "insert_remote"
UPDATE_REMOTE = "update_remote"
UPDATE_REMOTE_DROP_LOCAL = "update_remote_drop_local"
OVERWRITE_LOCAL = "overwrite_local"
NOT_FOUND = "error_not_found"
DUPLICATE_UID = "error_duplicate_uid"

SENDS = (INSERT_REMOTE, UPDATE_REMOTE, UPDATE_REMOTE_DROP_LOCAL)
REMOVES = (DROP_LOCAL, UPDATE_REMOTE_DROP_LOCAL)
ERRORS = {NOT_FOUND: ERROR_NOT_FOUND, DUPLICATE_UID: ERROR_DUPLICATE_UID}


def dirty(table: DataFrame) -> DataFrame:
    """Rows with changes to push, each under its own entity."""
    return table.filter(F.col("is_dirty"))


def remote_facts(remote: DataFrame) -> DataFrame:
    """What a plan needs of the remote: rows per key and their time. Combined before the shuffle."""
    return remote.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("remote_rows"), F.max("updated_at").alias("remote_updated_at")
    )


def in_conflict() -> Column:
    """The remote changed since this row was last read: any other time counts, older or newer."""
    return F.col("last_modified").isNotNull() & (F.col("last_modified") != F.col("remote_updated_at"))


def push_action(policy: Policy) -> Column:
    """The action of a dirty row beside its ``remote_facts``; the order of the cases matters."""
    deleted = F.col("status") == int(Status.DELETED)
    if policy is Policy.CLIENT_WINS:
        on_conflict = F.when(deleted, F.lit(UPDATE_REMOTE_DROP_LOCAL)).otherwise(F.lit(UPDATE_REMOTE))
    else:
        on_conflict = F.lit(OVERWRITE_LOCAL)
    return (
        F.when(~F.col("created_remotely") & deleted, F.lit(DROP_LOCAL))
        .when(~F.col("created_remotely"), F.lit(INSERT_REMOTE))
        .when(F.col("remote_rows").isNull(), F.lit(NOT_FOUND))
        .when(F.col("remote_rows") > 1, F.lit(DUPLICATE_UID))
        .when(in_conflict(), on_conflict)
        .otherwise(F.lit(UPDATE_REMOTE))
    )


def push_plan(local: DataFrame, remote: DataFrame, policy: Policy) -> DataFrame:
    """One narrow row per dirty row: its key, what was compared, and the action."""
    narrow = dirty(local).select(*KEY, "status", "last_modified", "created_remotely")
    facts = remote_facts(narrowed(remote.select(*KEY, "updated_at"), narrow, KEY))
    joined = narrow.join(facts, list(KEY), "left")
    return joined.withColumn("action", push_action(policy))


def push_errors(plan: DataFrame) -> DataFrame:
    """Rows of a plan that cannot be pushed, with their error code and how many rows the remote has."""
    code = F.create_map(*[F.lit(v) for pair in ERRORS.items() for v in pair])[F.col("action")]
    return plan.filter(F.col("action").isin(list(ERRORS))).select(*KEY, "action", code.alias("code"), "remote_rows")


def encode_rows(rows: DataFrame) -> DataFrame:
    """Local rows as the remote keeps them: key, status and user columns; nulls stay nulls.

    The local status travels along, which is how a delete reaches the remote.
    """
    return rows.select(*KEY, F.col("status").cast("short").alias("status"), *user_columns(rows.columns))


def placeholders_to_push(references: DataFrame, local: DataFrame, plan: DataFrame) -> DataFrame:
    """Keys of referenced rows the remote has not heard of and which are not pushed by themselves.

    A row deleted before it was ever pushed is no longer there to refer to.
    """
    wanted = references.filter(F.col("uid").isNotNull()).select(*KEY).distinct()
    unknown = local.filter(~F.col("created_remotely")).select(*KEY)
    pushed = plan.filter(F.col("action").isin(*SENDS, DROP_LOCAL)).select(*KEY)
    return wanted.join(unknown, list(KEY), "left_semi").join(pushed, list(KEY), "left_anti")


@dataclass
class PushResult:
    local: DataFrame
    remote: DataFrame
    plan: DataFrame
    placeholders: DataFrame | None = None


def outgoing_rows(local: DataFrame, plan: DataFrame) -> DataFrame:
    """The rows a plan sends, encoded."""
    sent = plan.filter(F.col("action").isin(*SENDS)).select(*KEY)
    return encode_rows(local.join(sent, list(KEY), "left_semi"))


def winning_rows(remote: DataFrame, plan: DataFrame) -> DataFrame:
    """The remote rows a plan overwrites local ones with."""
    overwritten = plan.filter(F.col("action") == OVERWRITE_LOCAL).select(*KEY)
    return narrowed(remote, overwritten, KEY).join(overwritten, list(KEY), "left_semi")


def apply_push(
    local: DataFrame,
    remote: DataFrame,
    plan: DataFrame,
    push_time: Column,
    placeholder_keys: DataFrame | None = None,
    outgoing: DataFrame | None = None,
    winners: DataFrame | None = None,
) -> PushResult:
    """Both sides after a push; rows in error stay as they are, dirty.

    A row is written to the remote under its key, so pushing the same row again, after an interruption,
    does not make a second one. A caller that has ``outgoing_rows`` or ``winning_rows`` written passes
    them, since joins with tables of a known, small size leave the large ones unshuffled.
    """
    actions = plan.select(*KEY, "action", "remote_updated_at")
    remote_after = write_remote(remote, outgoing_rows(local, plan) if outgoing is None else outgoing, push_time)
    local_after = write_local(local, winning_rows(remote, plan) if winners is None else winners, actions, push_time)
    if placeholder_keys is not None:
        fresh = placeholder_keys.withColumn("status", F.lit(int(Status.PLACEHOLDER)).cast("short"))
        remote_after = write_remote(remote_after, fresh, push_time, keep_existing=True)
        marked = placeholder_keys.withColumn("_known", F.lit(True))
        known = F.coalesce(F.col("_known"), F.lit(False))
        local_after = local_after.join(marked, list(KEY), "left").withColumns(
            {
                "last_modified": F.when(known, push_time).otherwise(F.col("last_modified")),
                "created_remotely": known | F.col("created_remotely"),
            }
        ).select(*local_after.columns)
    return PushResult(local_after, remote_after, plan, placeholder_keys)


def write_remote(
    remote: DataFrame, outgoing: DataFrame, push_time: Column, keep_existing: bool = False
) -> DataFrame:
    """The remote after rows were written to it; access entries are merged, all else is replaced."""
    both = side_by_side(remote, outgoing, KEY)
    takes = F.col("_new") & ~F.col("_old") if keep_existing else F.col("_new")
    columns = []
    for name in remote.columns:
        if name in KEY:
            columns.append(F.col(name))
        elif name == "updated_at":
            columns.append(F.when(takes, push_time).otherwise(F.col(name)).alias(name))
        elif name not in outgoing.columns:
            columns.append(F.col(name))
        elif name == "acl":
            columns.append(F.when(takes, merge_maps(F.col(name), F.col("_new_acl"))).otherwise(F.col(name)).alias(name))
        else:
            columns.append(F.when(takes, F.col(f"_new_{name}")).otherwise(F.col(name)).alias(name))
    return both.select(*columns)


def write_local(local: DataFrame, winners: DataFrame, actions: DataFrame, push_time: Column) -> DataFrame:
    """The local table after a push; ``actions`` is a push plan, ``winners`` are remote rows.

    Two joins on the same key, so that large inputs share one shuffle of the table.
    """
    shared = [c for c in ("status", *user_columns(local.columns)) if c in winners.columns and c != "acl"]
    action = F.coalesce(F.col("action"), F.lit("none"))
    sent = action.isin(INSERT_REMOTE, UPDATE_REMOTE)
    won = action == OVERWRITE_LOCAL
    after = (
        local.join(actions, list(KEY), "left")
        .filter(~action.isin(*REMOVES))
        .join(prefixed(winners.select(*KEY, *shared), "_remote_", KEY), list(KEY), "left")
    )
    columns = {name: F.when(won, F.col(f"_remote_{name}")).otherwise(F.col(name)) for name in shared}
    columns["last_modified"] = (
        F.when(sent, push_time).when(won, F.col("remote_updated_at")).otherwise(F.col("last_modified"))
    )
    columns["is_dirty"] = F.col("is_dirty") & ~(sent | won)
    columns["created_remotely"] = (action == INSERT_REMOTE) | F.col("created_remotely")
    return after.withColumns(columns).select(*local.columns)


def without_dropped(rows: DataFrame, refs: Sequence[str], dropped: DataFrame) -> DataFrame:
    """References to rows that were dropped before they ever reached the remote become null."""
    for ref in refs:
        targets = dropped.select(F.col("uid").alias("_uid"), F.lit(True).alias("_dropped"))
        keyed = rows.withColumn("_uid", F.col(f"{ref}.uid"))
        joined = join_unique(keyed, targets, "_uid", "left", spread_by="uid")
        rows = joined.withColumn(ref, F.when(F.col("_dropped").isNull(), F.col(ref))).drop("_uid", "_dropped")
    return rows
