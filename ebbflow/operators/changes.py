"""What a sync did and what is left to do: change log, counters, pending counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbflow.model import KEY
from ebbflow.operators import pull, push
from ebbflow.operators.relations import PAGE_SIZE, group_size, paged

INSERTED = "inserted"
UPDATED = "updated"
DELETED = "deleted"

# How each action shows up locally. Actions not listed change nothing there.
LOCAL_CHANGE = {
    push.DROP_LOCAL: DELETED,
    push.INSERT_REMOTE: UPDATED,
    push.UPDATE_REMOTE: UPDATED,
    push.UPDATE_REMOTE_DROP_LOCAL: DELETED,
    push.OVERWRITE_LOCAL: UPDATED,
    pull.INSERT: INSERTED,
    pull.UPDATE: UPDATED,
    pull.DELETE_LOCAL: DELETED,
}


def _change() -> Column:
    return F.create_map(*[F.lit(v) for pair in LOCAL_CHANGE.items() for v in pair])[F.col("action")]


def steps(plan: DataFrame, order: int) -> DataFrame:
    """A plan's changes as ``(entity, uid, change, step)``."""
    changed = plan.select(*KEY, _change().alias("change"), F.lit(order).alias("step"))
    return changed.filter(F.col("change").isNotNull())


def change_log(
    push_plan: DataFrame | None,
    pull_plan: DataFrame,
    added: DataFrame | None = None,
    cascaded: DataFrame | None = None,
    cleared: DataFrame | None = None,
) -> DataFrame:
    """``(entity, change, uid)``, each uid once per entity with its first change.

    Further changes are given by their keys: ``cascaded`` rows went with a deleted one, ``cleared`` rows lost a
    reference and count as updated, ``added`` are placeholders and count as inserted.
    """
    all_steps = steps(pull_plan, 1)
    if push_plan is not None:
        all_steps = all_steps.unionByName(steps(push_plan, 0))
    for step, (keys, change) in enumerate(((cascaded, DELETED), (cleared, UPDATED), (added, INSERTED)), 2):
        if keys is not None:
            all_steps = all_steps.unionByName(keys.select(*KEY, F.lit(change).alias("change"), F.lit(step).alias("step")))
    first = all_steps.groupBy(*KEY).agg(F.min_by("change", "step").alias("change"))
    return first.select("entity", "change", "uid")


def by_kind(log: DataFrame) -> DataFrame:
    """The log over all entities by kind of change: how many, and the range of uids."""
    return log.groupBy("change").agg(
        F.count(F.lit(1)).alias("n"), F.min("uid").alias("least_uid"), F.max("uid").alias("greatest_uid")
    )


def uids_by_kind(log: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """The uids of each entity and kind of change, in pages of about ``page_size``: ``(entity, change, page, n, uids)``.

    A kind with few uids is one page; of a large one no task or value holds more than a page.
    """
    pages = paged(log, ["entity", "change"], "uid", page_size).groupBy("entity", "change", "page")
    return pages.agg(group_size(), F.array_sort(F.collect_list("uid")).alias("uids"))


def sync_counters(push_plan: DataFrame, pull_plan: DataFrame) -> DataFrame:
    """Rows synced by side and entity; rows in error and rows skipped are not counted."""
    sent = push_plan.filter(~F.col("action").isin(list(push.ERRORS))).select(F.lit("local").alias("side"), "entity")
    read = pull_plan.filter(F.col("action") != pull.SKIP).select(F.lit("remote").alias("side"), "entity")
    return sent.unionByName(read).groupBy("side", "entity").agg(F.count(F.lit(1)).alias("n"))


def pending_counts(local: DataFrame, incoming: DataFrame) -> DataFrame:
    """Rows still to be synced by side and entity; ``incoming`` is the remote's increment."""
    out = push.dirty(local).select(F.lit("local").alias("side"), "entity")
    into = incoming.select(F.lit("remote").alias("side"), "entity")
    return out.unionByName(into).groupBy("side", "entity").agg(F.count(F.lit(1)).alias("n"))
