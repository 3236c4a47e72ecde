"""A whole sync over all roots of a model: push, then pull, as joins; only a commit has effects."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ebbflow.model import KEY, EntityModel, Relationship, Stored, relaxed
from ebbflow.operators import changes, pull, push
from ebbflow.operators.cascades import edges_without
from ebbflow.operators.joins import join_unique
from ebbflow.operators.relations import remove_from_arrays, replace_edges
from ebbflow.operators.save import (
    apply_gone,
    bereft_keys,
    gone_keys,
    placeholders,
    references_of,
    relationships_of,
)
from ebbflow.session import materialized, materialized_all

Tables = Mapping[str, DataFrame]

PUSH_ACTIONS = (*push.SENDS, push.DROP_LOCAL, push.OVERWRITE_LOCAL, *push.ERRORS)
PULL_ACTIONS = (pull.SKIP, pull.IGNORE, *pull.CHANGES)
FAULTS = (pull.MISSING_VALUE, pull.UNKNOWN_ENTITY, pull.MALFORMED_REFERENCE, pull.UNKNOWN_TARGET, push.DUPLICATE_UID)


class SyncError(RuntimeError):
    """A row that cannot be pushed or pulled; ``code`` is one of the codes of ``operators.push``, or None."""

    def __init__(self, code: int | None, uid: str | None, action: str) -> None:
        super().__init__(f"sync stopped with {action} ({code}) at {uid}")
        self.code = code
        self.uid = uid


@dataclass
class SyncResult:
    local: dict[str, DataFrame]
    remote: dict[str, DataFrame]
    watermarks: DataFrame
    change_log: DataFrame
    errors: DataFrame
    counters: DataFrame
    local_edges: dict[str, DataFrame]
    remote_edges: dict[str, DataFrame]


def _edges_of(model: EntityModel, root: str, edges: Tables | None) -> list[str]:
    """Names, as ``Entity.relationship``, of the edge tables whose sources are rows of a root."""
    names = {
        f"{entity}.{r.name}"
        for entity in model.family(root)
        for r in model[entity].relationships
        if r.stored is Stored.RELATION
    }
    return sorted(names & set(edges or {}))


def _edges_from(edges: DataFrame, keys: DataFrame) -> DataFrame:
    """Edges of the given source rows."""
    sources = keys.select(F.col("uid").alias("src_uid"))
    return join_unique(edges, sources, "src_uid", "left_semi", spread_by="dst_uid")


def _edge_references(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("dst_entity").alias("entity"), F.col("dst_uid").alias("uid"))


def _take_edges(
    model: EntityModel,
    root: str,
    keys: DataFrame,
    remote_edges: Tables | None,
    edges_here: dict[str, DataFrame],
    arriving: list[DataFrame | None],
) -> None:
    """Replace the local edges of rows taken from the remote by its own, where this side reads them."""
    for name in _edges_of(model, root, remote_edges):
        entity, relationship = name.split(".")
        if not model.read_from_remote(entity, model.relationship(entity, relationship)):
            continue
        read = _edges_from(remote_edges[name], keys)
        arriving.append(_edge_references(read))
        sources = keys.select(F.col("uid").alias("src_uid"))
        edges_here[name] = replace_edges(edges_here.get(name, read.limit(0)), read, sources)


def _stored_as(model: EntityModel, root: str, table: DataFrame, stored: Stored) -> list[Relationship]:
    return [r for r in relationships_of(model, root) if r.stored is stored and r.name in table.columns]


def _with_all_roots(tables: Tables, others: Tables, model: EntityModel, schema) -> dict[str, DataFrame]:
    """The tables, and an empty one for each root that only the other side has."""
    spark = next(iter({**tables, **others}.values())).sparkSession
    missing = [root for root in model.roots if root in others and root not in tables]
    return {**tables, **{root: spark.createDataFrame([], relaxed(schema(root))) for root in missing}}


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def _written_by_root(
    parts: Mapping[str, DataFrame], kinds: tuple[str, ...] = (), model: EntityModel | None = None
) -> tuple[dict[str, DataFrame], dict[str, Counter]]:
    """One write, and so one job, for tables of the same columns; each is read back by its folder.

    Also tells how often each of the actions ``kinds`` occurs in each table, which leaves out joins that would change
    nothing, or, with the model, each pair of entity and action; without ``kinds``, rows. The write itself counts
    them: no row is read again for that.
    """
    if not parts:
        return {}, {}
    together = _union([part.withColumn("root", F.lit(root)) for root, part in parts.items()])
    of = {root: [*model.family(root), None] if model is not None else [None] for root in parts}
    wanted = {f"n{i}": key for i, key in enumerate((r, e, k) for r in parts for e in of[r] for k in kinds or ("row",))}
    counts = []
    for name, (root, entity, kind) in wanted.items():
        hit = F.col("root") == root
        if kinds:
            hit = hit & (F.col("action") == kind)
        if entity is not None:
            hit = hit & (F.col("entity") == entity)
        elif model is not None:
            hit = hit & ~F.coalesce(F.col("entity").isin(model.family(root)), F.lit(False))
        counts.append(F.count_if(hit).alias(name))
    seen = Observation()
    written = materialized(together.observe(seen, *counts), partition_by="root")
    told: dict[str, Counter] = {root: Counter() for root in parts}
    for name, n in seen.get.items():
        root, entity, kind = wanted[name]
        if n:
            told[root][kind if model is None else (entity, kind)] += n
    return {root: written.filter(F.col("root") == root).drop("root") for root in parts}, told


def _by_action(counts: Mapping[str, Counter]) -> dict[str, set[str]]:
    return {root: {kind for _, kind in found} for root, found in counts.items()}


def _counters(spark: SparkSession, pushed: Mapping[str, Counter], pulled: Mapping[str, Counter]) -> DataFrame:
    """Rows synced by side and entity, from what the writes of the plans counted; see ``changes.sync_counters``."""
    total: Counter = Counter()
    for side, plans, left_out in (("local", pushed, set(push.ERRORS)), ("remote", pulled, {pull.SKIP})):
        for found in plans.values():
            for (entity, kind), n in found.items():
                if kind not in left_out:
                    total[side, entity] += n
    return spark.createDataFrame([(*key, n) for key, n in sorted(total.items(), key=str)], "side string, entity string, n long")


def _references_into(model: EntityModel, root: str, parts: list[DataFrame | None]) -> DataFrame | None:
    """References to rows of one root, or None when nothing that was read holds any."""
    held = [part for part in parts if part is not None]
    if not held:
        return None
    return _union(held).filter(F.col("entity").isin(model.family(root)))


def sync(
    model: EntityModel,
    local: Tables,
    remote: Tables,
    *,
    policy: push.Policy = push.Policy.SERVER_WINS,
    push_time: datetime,
    now: datetime,
    watermarks: pull.Watermarks | None = None,
    full: bool = False,
    on_error: str = "fail",
    local_edges: Tables | None = None,
    remote_edges: Tables | None = None,
    written: bool = False,
) -> SyncResult:
    """Push dirty rows, then pull what changed, over tables by root entity.

    ``push_time`` is the remote's time for written rows, ``now`` the upper bound of the pull; both are
    given so that a repeated run does the same. Errors of the push, and remote rows that no table can take,
    end the sync before anything is written (``on_error="fail"``) or come back as rows while the rest goes on
    (``"quarantine"``). A root that one side has only is empty on the other.

    A to-many that is stored as a relation has an edge table on each side, by ``Entity.relationship``. A row
    that is written takes its edges along, and they replace those it had.

    ``written`` says that the tables are small and stand in files: their parts are then not written again.

    Dirty rows, increments and plans are written once and feed everything else; none is larger than what
    changed. Roots, and joins, that nothing happens in are left out.
    """
    if on_error not in ("fail", "quarantine"):
        raise ValueError("on_error is 'fail' or 'quarantine'")
    local, remote = (
        _with_all_roots(local, remote, model, model.local_schema),
        _with_all_roots(remote, local, model, model.remote_schema),
    )
    roots = [root for root in model.roots if root in local]
    at = pull.ntz(push_time)

    # Dirty rows are written first: few as a rule, and then known to be, so that the joins with them leave
    # the large tables where they are.
    pending = {root: push.dirty(local[root]) for root in roots}
    if not written:
        pending = materialized_all(pending)
    plans, pushed_rows = _written_by_root(
        {
            root: push.push_plan(rows, remote[root] if rows.limit(1).collect() else remote[root].limit(0), policy)
            for root, rows in pending.items()
        },
        PUSH_ACTIONS,
        model,
    )
    to_push = _by_action(pushed_rows)
    errors = _union([push.push_errors(plan) for plan in plans.values()])
    if on_error == "fail" and any(kinds & set(push.ERRORS) for kinds in to_push.values()):
        first = errors.orderBy("entity", "uid").limit(1).collect()[0]
        raise SyncError(first["code"], first["uid"], first["action"])

    # A row that was deleted before the remote heard of it cannot be referred to any more.
    dropped = {
        root: plans[root].filter(F.col("action") == push.DROP_LOCAL).select("uid")
        for root in roots
        if push.DROP_LOCAL in to_push[root]
    }
    tables = dict(local)
    for root in roots:
        for pointer in _stored_as(model, root, local[root], Stored.POINTER):
            gone = dropped.get(model.root_of(pointer.target))
            if gone is not None:
                tables[root] = push.without_dropped(tables[root], [pointer.name], gone)
                pending[root] = push.without_dropped(pending[root], [pointer.name], gone)
        for array in _stored_as(model, root, local[root], Stored.ARRAY):
            gone = dropped.get(model.root_of(array.target))
            if gone is not None:
                tables[root] = remove_from_arrays(tables[root], array.name, gone).select(*tables[root].columns)
                pending[root] = remove_from_arrays(pending[root], array.name, gone).select(*pending[root].columns)

    let_go = bereft_keys(model, local, dropped) if dropped else None

    sent = {
        root: plans[root].filter(F.col("action").isin(*push.SENDS)).select(*KEY)
        for root in roots
        if to_push[root] & set(push.SENDS)
    }
    outgoing = {root: push.outgoing_rows(pending[root], plans[root]) for root in roots}
    leaving = [references_of(outgoing[root], relationships_of(model, root)) for root in sent]
    edges_here, edges_there = dict(local_edges or {}), dict(remote_edges or {})
    for name in edges_here:
        edges_here[name] = edges_without(model, name, edges_here[name], dropped)
    for root, keys in sent.items():
        for name in _edges_of(model, root, edges_here):
            written_edges = _edges_from(edges_here[name], keys)
            leaving.append(_edge_references(written_edges))
            sources = keys.select(F.col("uid").alias("src_uid"))
            old = edges_there.get(name, written_edges.limit(0))
            edges_there[name] = replace_edges(old, written_edges, sources)
    unknown, found = _written_by_root(
        {
            root: push.placeholders_to_push(refs, local[root], plans[root])
            for root in roots
            if (refs := _references_into(model, root, leaving)) is not None
        }
    )
    unknown = {root: keys for root, keys in unknown.items() if found[root]}

    after_push, remote_after, won = dict(tables), dict(remote), {}
    for root in roots:
        if to_push[root] - set(push.ERRORS) or root in unknown:
            winners = remote[root].limit(0)
            if push.OVERWRITE_LOCAL in to_push[root]:
                won[root] = winners = materialized(push.winning_rows(remote[root], plans[root]))
            result = push.apply_push(
                tables[root], remote[root], plans[root], at, unknown.get(root), outgoing[root], winners
            )
            after_push[root], remote_after[root] = result.local, result.remote
    told = {
        root: _union([keys[root] for keys in (sent, unknown) if root in keys])
        for root in roots
        if root in sent or root in unknown
    }

    # Rows just written are known here and rows in error stay as they are; all others come from the
    # remote as it was, so that the bounds reach its scan.
    incoming, faults = {}, {}
    for root in roots:
        rows = pull.increment(remote[root], watermarks, now, full, model.family(root))
        settled = [told[root]] if root in told else []
        if to_push[root] & set(push.ERRORS):
            settled.append(push.push_errors(plans[root]).select(*KEY))
        if settled:
            rows = rows.join(_union(settled), list(KEY), "left_anti")
        incoming[root] = rows
    if watermarks and not full and not written:
        incoming = materialized_all(incoming)
    for root, rows in incoming.items():
        untimed = remote[root].filter(F.col("updated_at").isNull())
        # A key may come twice with one of its rows below the watermark: all rows of the increment's keys count.
        whole = remote[root] if watermarks and not full else None
        faults[root] = pull.pull_errors(rows.unionByName(untimed), model, root, whole)
    faults, wrong = _written_by_root(faults, FAULTS)
    if any(wrong.values()):
        errors = errors.unionByName(_union(list(faults.values())))
        if on_error == "fail":
            first = errors.orderBy("entity", "uid", "action").limit(1).collect()[0]
            raise SyncError(first["code"], first["uid"], first["action"])
    for root, rows in incoming.items():
        if wrong[root]:
            rows = pull.without_errors(rows, model, root)
        if push.DUPLICATE_UID in wrong[root]:
            twice = faults[root].filter(F.col("action") == push.DUPLICATE_UID).select(*KEY)
            rows = rows.join(twice, list(KEY), "left_anti")
        incoming[root] = pull.decode_rows(rows, model, root)
    pull_plans, pulled_rows = _written_by_root(
        {root: pull.pull_plan(after_push[root], incoming[root]) for root in roots}, PULL_ACTIONS, model
    )
    to_pull = _by_action(pulled_rows)

    after_pull = {
        root: pull.apply_pull(table, incoming[root]).local if to_pull[root] & set(pull.CHANGES) else table
        for root, table in after_push.items()
    }
    removed = {
        root: pull_plans[root].filter(F.col("action") == pull.DELETE_LOCAL).select("uid")
        for root in roots
        if pull.DELETE_LOCAL in to_pull[root]
    }
    cascaded, cleared = None, let_go
    if removed:
        # What a removed row held, and not only who holds it, takes part in the walk.
        walked = {
            root: table.unionByName(after_push[root].join(removed[root], "uid", "left_semi")) if root in removed else table
            for root, table in after_pull.items()
        }
        gone, _ = _written_by_root(gone_keys(model, walked, removed, edges_here))
        # The deleted rows themselves are out already: what is found here went with them.
        cascaded = materialized(
            _union([after_pull[root].select(*KEY).join(keys, "uid", "left_semi") for root, keys in gone.items()])
        )
        bereft = [keys for keys in (cleared, bereft_keys(model, after_pull, gone)) if keys is not None]
        cleared = _union(bereft) if bereft else None
        after_pull = apply_gone(model, after_pull, gone, remove=True)
        edges_here = {name: edges_without(model, name, edges, gone) for name, edges in edges_here.items()}

    arriving = []
    for root in roots:
        if push.OVERWRITE_LOCAL in to_push[root]:
            overwritten = plans[root].filter(F.col("action") == push.OVERWRITE_LOCAL).select(*KEY)
            _take_edges(model, root, overwritten, remote_edges, edges_here, arriving)
            arriving.append(references_of(pull.decode_rows(won[root], model, root), relationships_of(model, root)))
        if to_pull[root] & {pull.INSERT, pull.UPDATE}:
            applied = pull_plans[root].filter(F.col("action").isin(pull.INSERT, pull.UPDATE)).select(*KEY)
            _take_edges(model, root, applied, remote_edges, edges_here, arriving)
            arriving.append(
                references_of(incoming[root].join(applied, list(KEY), "left_semi"), relationships_of(model, root))
            )
    missing, found = _written_by_root(
        {
            root: placeholders(refs, after_pull[root], created_remotely=True)
            for root in roots
            if (refs := _references_into(model, root, arriving)) is not None
        }
    )
    missing = {root: rows for root, rows in missing.items() if found[root]}
    for root, rows in missing.items():
        after_pull[root] = after_pull[root].unionByName(rows, allowMissingColumns=True)
    added = [rows.select(*KEY) for rows in missing.values()]

    pushed = _union([plan.select(*KEY, "action") for plan in plans.values()])
    pulled = _union([plan.select(*KEY, "updated_at", "action") for plan in pull_plans.values()])
    spark = pulled.sparkSession
    # Own writes at or above the bound of this pull must not lift a watermark over rows it did not read.
    own = [keys.select("entity", at.alias("updated_at")) for keys in told.values()] if push_time < now else []
    seen = _union([pulled.select("entity", "updated_at"), *own])
    old = None
    if watermarks:
        old = spark.createDataFrame(list(watermarks.items()), "entity string, watermark timestamp_ntz")
    return SyncResult(
        local=after_pull,
        remote=remote_after,
        watermarks=pull.advance(old, seen),
        change_log=changes.change_log(pushed, pulled, _union(added) if added else None, cascaded, cleared),
        errors=errors,
        counters=_counters(spark, pushed_rows, pulled_rows),
        local_edges=edges_here,
        remote_edges=edges_there,
    )
