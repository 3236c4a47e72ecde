"""Queries of push, pull, change log and counters."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbflow.functions.acl import explode_acl, merge_entries, parse_acl
from ebbflow.operators import changes, pull, push, save
from ebbflow.operators.push import Policy
from ebbflow.operators.sync import sync
from ebbflow.plans.registry import query
from ebbflow.plans.shapes import (
    CUST,
    FAR,
    FEED,
    FEED_TO,
    FEED_WATERMARKS,
    LOC,
    MODEL,
    PUSH_TIME,
    REM,
    SCAN_FROM,
    cust,
    cust_remote,
    feed,
    instant,
    lines,
    loc,
    rem,
    table,
    with_ctes,
)


def _int_status(df: DataFrame) -> DataFrame:
    return df.withColumn("status", F.col("status").cast("int"))


def _action_sql(policy: Policy) -> str:
    if policy is Policy.CLIENT_WINS:
        conflict = "CASE WHEN l.status = 3 THEN 'update_remote_drop_local' ELSE 'update_remote' END"
    else:
        conflict = "'overwrite_local'"
    return f"""CASE WHEN NOT l.created_remotely AND l.status = 3 THEN 'drop_local'
    WHEN NOT l.created_remotely THEN 'insert_remote'
    WHEN r.uid IS NULL THEN 'error_not_found'
    WHEN l.last_modified IS NOT NULL AND l.last_modified <> r.updated_at THEN {conflict}
    ELSE 'update_remote' END"""


def _plan_cte(policy: Policy) -> str:
    return f"""plan AS (SELECT l.uid, l.entity, {_action_sql(policy)} AS action, l.last_modified, r.updated_at,
    l.created_remotely FROM loc l LEFT JOIN rem r ON r.uid = l.uid WHERE l.is_dirty)"""


_SENDS = "('insert_remote', 'update_remote', 'update_remote_drop_local')"
_LOCAL_AFTER = f"""loc_after AS (SELECT l.uid, l.entity, l.key,
    CASE WHEN p.action = 'overwrite_local' THEN r.status ELSE l.status END AS status,
    CASE WHEN p.action = 'overwrite_local' THEN r.price ELSE l.price END AS price,
    CASE WHEN p.action IN ('insert_remote', 'update_remote') THEN {instant(PUSH_TIME)}
      WHEN p.action = 'overwrite_local' THEN r.updated_at ELSE l.last_modified END AS last_modified,
    l.is_dirty AND NOT coalesce(p.action IN ('insert_remote', 'update_remote', 'overwrite_local'), FALSE) AS is_dirty,
    l.created_remotely OR coalesce(p.action = 'insert_remote', FALSE) AS created_remotely, l.author_uid
  FROM loc l LEFT JOIN plan p ON p.uid = l.uid LEFT JOIN rem r ON r.uid = l.uid
  WHERE coalesce(p.action, '') NOT IN ('drop_local', 'update_remote_drop_local'))"""
_REMOTE_AFTER = f"""sent AS (SELECT l.* FROM loc l JOIN plan p ON p.uid = l.uid WHERE p.action IN {_SENDS}),
rem_after AS (SELECT coalesce(r.uid, s.uid) AS uid, coalesce(r.entity, s.entity) AS entity,
    coalesce(s.status, r.status) AS status, CASE WHEN s.uid IS NULL THEN r.price ELSE s.price END AS price,
    CASE WHEN s.uid IS NULL THEN r.updated_at ELSE {instant(PUSH_TIME)} END AS updated_at,
    coalesce(s.author_uid, r.author_uid) AS author_uid
  FROM rem r FULL JOIN sent s ON r.uid = s.uid)"""


def _plan(spark: SparkSession, sf_dir: str, policy: Policy) -> DataFrame:
    return push.push_plan(loc(spark, sf_dir), rem(spark, sf_dir), policy)


def _pushed(spark: SparkSession, sf_dir: str, policy: Policy) -> push.PushResult:
    local, remote = loc(spark, sf_dir), rem(spark, sf_dir)
    return push.apply_push(local, remote, push.push_plan(local, remote, policy), pull.ntz(PUSH_TIME))


# Push


@query(
    with_ctes(
        LOC,
        REM,
        body=" UNION ALL ".join(
            f"""SELECT '{policy.value}' AS policy, l.uid, {_action_sql(policy)} AS action
FROM loc l LEFT JOIN rem r ON r.uid = l.uid WHERE l.is_dirty"""
            for policy in Policy
        ),
    )
)
def push_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = push.dirty(loc(spark, sf_dir)).join(push.remote_facts(rem(spark, sf_dir)), ["entity", "uid"], "left")
    runs = F.explode(
        F.array(
            *[F.struct(F.lit(p.value).alias("policy"), push.push_action(p).alias("action")) for p in Policy]
        )
    )
    return facts.select("uid", runs.alias("_run")).select("_run.policy", "uid", "_run.action")


@query(with_ctes(LOC, body="SELECT uid FROM loc WHERE is_dirty AND NOT created_remotely AND status = 3"))
def push_drop_local(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = loc(spark, sf_dir).select("uid")
    return before.join(_pushed(spark, sf_dir, Policy.SERVER_WINS).local.select("uid"), "uid", "left_anti")


@query(
    with_ctes(
        LOC,
        body=f"""SELECT uid, status, price, {instant(PUSH_TIME)} AS updated_at, {instant(PUSH_TIME)} AS last_modified,
    TRUE AS created_remotely, FALSE AS is_dirty
FROM loc WHERE is_dirty AND NOT created_remotely AND status <> 3""",
    )
)
def push_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = _pushed(spark, sf_dir, Policy.SERVER_WINS)
    inserted = result.plan.filter(F.col("action") == push.INSERT_REMOTE).select("entity", "uid")
    there = result.remote.join(inserted, ["entity", "uid"], "left_semi").select("uid", "status", "price", "updated_at")
    here = result.local.select("uid", "last_modified", "created_remotely", "is_dirty")
    return _int_status(there.join(here, "uid"))


@query(
    with_ctes(
        LOC,
        REM,
        body="""SELECT uid, 201 AS code FROM loc
WHERE is_dirty AND created_remotely AND uid NOT IN (SELECT uid FROM rem)""",
    )
)
def push_not_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return push.push_errors(_plan(spark, sf_dir, Policy.SERVER_WINS)).select("uid", "code")


@query(
    """WITH keyed AS (SELECT 'l' || l_orderkey || '-' || l_linenumber AS uid, (l_orderkey + l_linenumber) AS key,
    count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
SELECT uid, n AS remote_rows, 200 AS code FROM keyed WHERE n > 1 AND key % 4 < 2 AND key % 3 <> 0"""
)
def push_duplicate_uid(spark: SparkSession, sf_dir: str) -> DataFrame:
    remote = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("l"), F.col("l_orderkey"), F.lit("-"), F.col("l_linenumber")).alias("uid"),
        F.lit("Line").alias("entity"),
        F.lit(2).alias("status"),
        F.col("l_shipdate").alias("updated_at"),
    )
    plan = push.push_plan(lines(spark, sf_dir), remote, Policy.SERVER_WINS)
    errors = push.push_errors(plan).filter(F.col("code") == push.ERROR_DUPLICATE_UID)
    return errors.select("uid", "remote_rows", "code")


@query(
    with_ctes(
        LOC,
        REM,
        body="""SELECT l.uid, l.last_modified, r.updated_at FROM loc l JOIN rem r ON r.uid = l.uid
WHERE l.is_dirty AND l.created_remotely AND l.last_modified <> r.updated_at""",
    )
)
def push_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = _plan(spark, sf_dir, Policy.SERVER_WINS)
    found = plan.filter(F.col("created_remotely") & (F.col("remote_rows") == 1) & push.in_conflict())
    return found.select("uid", "last_modified", F.col("remote_updated_at").alias("updated_at"))


def _both_sides(result: push.PushResult) -> DataFrame:
    columns = ["uid", "status", "price", "at"]
    here = result.local.withColumnRenamed("last_modified", "at").select(F.lit("local").alias("side"), *columns)
    there = result.remote.withColumnRenamed("updated_at", "at").select(F.lit("remote").alias("side"), *columns)
    return _int_status(here.unionByName(there))


def _both_sides_sql(policy: Policy) -> str:
    return with_ctes(
        LOC,
        REM,
        _plan_cte(policy),
        _LOCAL_AFTER,
        _REMOTE_AFTER,
        body="""SELECT 'local' AS side, uid, status, price, last_modified AS at FROM loc_after
UNION ALL SELECT 'remote', uid, status, price, updated_at FROM rem_after""",
    )


@query(_both_sides_sql(Policy.CLIENT_WINS))
def push_client_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _both_sides(_pushed(spark, sf_dir, Policy.CLIENT_WINS))


@query(_both_sides_sql(Policy.SERVER_WINS))
def push_server_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _both_sides(_pushed(spark, sf_dir, Policy.SERVER_WINS))


@query(
    with_ctes(
        LOC,
        CUST,
        REM,
        _plan_cte(Policy.SERVER_WINS),
        body=f"""SELECT DISTINCT c.entity, c.uid, 1 AS status FROM loc l
JOIN plan p ON p.uid = l.uid AND p.action IN {_SENDS}
JOIN cust c ON c.uid = l.author_uid WHERE NOT c.created_remotely AND NOT c.is_dirty""",
    )
)
def push_placeholders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customers, known = loc(spark, sf_dir), cust(spark, sf_dir), cust_remote(spark, sf_dir)
    sent = _plan(spark, sf_dir, Policy.SERVER_WINS).filter(F.col("action").isin(*push.SENDS)).select("entity", "uid")
    refs = save.references_of(orders.join(sent, ["entity", "uid"], "left_semi"), MODEL.relationships("Order"))
    keys = push.placeholders_to_push(refs, customers, push.push_plan(customers, known, Policy.SERVER_WINS))
    fresh = keys.withColumn("status", F.lit(1).cast("short"))
    written = push.write_remote(known, fresh, pull.ntz(PUSH_TIME), keep_existing=True)
    return _int_status(written.filter("status = 1")).select("entity", "uid", "status")


@query(with_ctes(LOC, body="SELECT uid, entity, status, price, priority, author_uid FROM loc WHERE is_dirty"))
def encode_remote_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _int_status(push.encode_rows(push.dirty(loc(spark, sf_dir))))
    return rows.select("uid", "entity", "status", "price", "priority", F.col("author.uid").alias("author_uid"))


def _acl_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    user = F.concat(
        F.lit('"u'), key, F.lit('": {"read": "true", "write": "'), (key % 2 == 0).cast("string"), F.lit('"}')
    )
    role = F.concat(F.lit('"role:'), F.col("c_mktsegment"), F.lit('": {"write": true}'))
    text = F.concat(F.lit("{"), user, F.lit(", "), role, F.lit("}"))
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("c"), key).alias("uid"), key.alias("key"), parse_acl(text).alias("acl")
    )


_ACL = """entries AS (SELECT 'c' || c_custkey AS uid, c_custkey AS key, 'user' AS kind, 'u' || c_custkey AS who,
    TRUE AS read, c_custkey % 2 = 0 AS write FROM customer
  UNION ALL SELECT 'c' || c_custkey, c_custkey, 'role', c_mktsegment, NULL, TRUE FROM customer)"""


@query(with_ctes(_ACL, body="SELECT uid, kind, who, read, write FROM entries"))
def acl_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_acl(_acl_rows(spark, sf_dir))


@query(
    with_ctes(
        _ACL,
        body="""SELECT uid, kind, who, read, CASE WHEN kind = 'user' AND key % 3 = 0 THEN FALSE ELSE write END AS write
FROM entries
UNION ALL SELECT 'c' || c_custkey, 'role', 'Auditors', TRUE, NULL FROM customer WHERE c_custkey % 3 = 0""",
    )
)
def acl_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _acl_rows(spark, sf_dir)
    text = F.concat(
        F.lit('{"u'), F.col("key"), F.lit('": {"write": "false"}, "role:Auditors": {"read": "true"}}')
    )
    given = rows.filter("key % 3 = 0").select("uid", parse_acl(text).alias("acl"))
    return merge_entries(explode_acl(rows), explode_acl(given))


# Pull


def _above_sql(watermarks: dict[str, datetime]) -> str:
    cases = " ".join(f"WHEN '{entity}' THEN {instant(at)}" for entity, at in watermarks.items())
    mark = f"CASE entity {cases} END"
    return f"({mark} IS NULL OR updated_at > {mark})"


_FEED_INCREMENT = f"updated_at < {instant(FEED_TO)} AND {_above_sql(FEED_WATERMARKS)}"


@query(with_ctes(FEED, body=f"SELECT event_id, uid, updated_at FROM feed WHERE {_FEED_INCREMENT}"))
def pull_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pull.increment(feed(spark, sf_dir), FEED_WATERMARKS, FEED_TO).select("event_id", "uid", "updated_at")


_OLD_MARKS = " UNION ALL ".join(f"SELECT '{e}' AS entity, {instant(at)} AS watermark" for e, at in FEED_WATERMARKS.items())


@query(
    with_ctes(
        FEED,
        f"old AS ({_OLD_MARKS})",
        f"seen AS (SELECT entity, max(updated_at) AS watermark FROM feed WHERE {_FEED_INCREMENT} GROUP BY entity)",
        body="""SELECT entity, max(watermark) AS watermark
FROM (SELECT * FROM old UNION ALL SELECT * FROM seen) GROUP BY entity""",
    )
)
def pull_watermarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = spark.createDataFrame(list(FEED_WATERMARKS.items()), "entity string, watermark timestamp_ntz")
    return pull.advance(old, pull.increment(feed(spark, sf_dir), FEED_WATERMARKS, FEED_TO))


_PULL_ACTION = """CASE WHEN l.uid IS NOT NULL AND l.last_modified = r.updated_at THEN 'skip'
    WHEN l.uid IS NULL AND r.status = 3 THEN 'ignore'
    WHEN l.uid IS NULL THEN 'insert'
    WHEN r.status = 3 THEN 'delete_local' ELSE 'update' END"""
_PULL_PLAN = f"pulled AS (SELECT r.*, {_PULL_ACTION} AS action FROM rem r LEFT JOIN loc l ON l.uid = r.uid)"


def _incoming(spark: SparkSession, sf_dir: str, after: datetime | None = None, full: bool = False) -> DataFrame:
    watermarks = {"Order": after} if after else None
    return pull.decode_rows(pull.increment(rem(spark, sf_dir), watermarks, FAR, full), MODEL, "Order")


@query(with_ctes(LOC, REM, _PULL_PLAN, body="SELECT uid FROM pulled WHERE action = 'skip'"))
def pull_skip_unchanged(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = pull.pull_plan(loc(spark, sf_dir), _incoming(spark, sf_dir))
    return plan.filter(F.col("action") == pull.SKIP).select("uid")


@query(
    with_ctes(
        LOC, REM, _PULL_PLAN, body=f"SELECT uid, updated_at, action FROM pulled WHERE updated_at > {instant(SCAN_FROM)}"
    )
)
def pull_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = pull.pull_plan(loc(spark, sf_dir), _incoming(spark, sf_dir, SCAN_FROM))
    return plan.select("uid", "updated_at", "action")


@query(
    with_ctes(
        LOC,
        REM,
        _PULL_PLAN,
        body="""SELECT coalesce(l.uid, p.uid) AS uid,
    CASE WHEN p.action IN ('insert', 'update') THEN p.status ELSE l.status END AS status,
    CASE WHEN p.action IN ('insert', 'update') THEN p.updated_at ELSE l.last_modified END AS last_modified,
    CASE WHEN p.action IN ('insert', 'update') THEN p.price ELSE l.price END AS price,
    coalesce(l.created_remotely, TRUE) AS created_remotely, coalesce(l.is_dirty, FALSE) AS is_dirty
FROM loc l FULL JOIN pulled p ON p.uid = l.uid
WHERE coalesce(p.action, '') NOT IN ('ignore', 'delete_local')""",
    )
)
def pull_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pull.apply_pull(loc(spark, sf_dir), _incoming(spark, sf_dir)).local
    return _int_status(rows).select("uid", "status", "last_modified", "price", "created_remotely", "is_dirty")


@query(with_ctes(LOC, REM, _PULL_PLAN, body="SELECT action, count(*) AS n FROM pulled GROUP BY action"))
def pull_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    incoming = _incoming(spark, sf_dir, SCAN_FROM, full=True)
    return pull.pull_plan(loc(spark, sf_dir), incoming).groupBy("action").agg(F.count(F.lit(1)).alias("n"))


@query(with_ctes(REM, body="SELECT uid, entity, status, updated_at AS last_modified, price, author_uid FROM rem"))
def decode_remote_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _int_status(pull.decode_rows(rem(spark, sf_dir), MODEL, "Order"))
    return rows.select("uid", "entity", "status", "last_modified", "price", F.col("author.uid").alias("author_uid"))


@query(
    with_ctes(
        FEED,
        body="""SELECT uid, entity, updated_at, event_id, value FROM feed
QUALIFY row_number() OVER (PARTITION BY entity, uid ORDER BY updated_at DESC, event_id DESC) = 1""",
    )
)
def latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pull.latest_version(feed(spark, sf_dir), tie_break="event_id")
    return rows.select("uid", "entity", "updated_at", "event_id", "value")


@query(with_ctes(FEED, body=f"SELECT event_id, entity FROM feed WHERE NOT {_above_sql(FEED_WATERMARKS)}"))
def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pull.late_rows(feed(spark, sf_dir), FEED_WATERMARKS).select("event_id", "entity")


# Both


_AFTER_PUSH = (LOC, REM, _plan_cte(Policy.SERVER_WINS), _LOCAL_AFTER, _REMOTE_AFTER)
_PULL_AFTER_PUSH = f"""settled AS (SELECT r.*, {_PULL_ACTION} AS action FROM rem_after r
    LEFT JOIN loc_after l ON l.uid = r.uid WHERE r.uid NOT IN (SELECT uid FROM sent))"""
_LOG = """steps AS (SELECT uid, entity, 0 AS step, CASE action WHEN 'drop_local' THEN 'deleted'
      WHEN 'update_remote_drop_local' THEN 'deleted' ELSE 'updated' END AS change
    FROM plan WHERE action <> 'error_not_found'
  UNION ALL SELECT uid, entity, 1, CASE action WHEN 'insert' THEN 'inserted' WHEN 'update' THEN 'updated'
      ELSE 'deleted' END FROM settled WHERE action IN ('insert', 'update', 'delete_local')),
log AS (SELECT entity, uid, arg_min(change, step) AS change FROM steps GROUP BY entity, uid)"""


def _sync_plans(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The push plan, and the pull plan of what is left after it."""
    result = _pushed(spark, sf_dir, Policy.SERVER_WINS)
    sent = result.plan.filter(F.col("action").isin(*push.SENDS)).select("entity", "uid")
    incoming = _incoming(spark, sf_dir).join(sent, ["entity", "uid"], "left_anti")
    return result.plan, pull.pull_plan(result.local, incoming)


@query(with_ctes(*_AFTER_PUSH, _PULL_AFTER_PUSH, _LOG, body="SELECT entity, change, uid FROM log"))
def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.change_log(*_sync_plans(spark, sf_dir))


@query(
    with_ctes(
        *_AFTER_PUSH,
        _PULL_AFTER_PUSH,
        _LOG,
        body="""SELECT change, count(*) AS n, min(uid) AS least_uid, max(uid) AS greatest_uid FROM log
GROUP BY change""",
    )
)
def change_log_by_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.by_kind(changes.change_log(*_sync_plans(spark, sf_dir)))


@query(
    with_ctes(
        *_AFTER_PUSH,
        _PULL_AFTER_PUSH,
        _LOG,
        """paged AS (SELECT *, (count(*) OVER (PARTITION BY entity, change) - 1) // 1000 AS excess,
    count(*) OVER (PARTITION BY entity, change) AS n FROM log)""",
        body="""SELECT entity, change, page, n, string_agg(uid, ',' ORDER BY uid) AS uids FROM (
    SELECT *, CASE WHEN excess = 0 THEN '' ELSE substr(md5(uid), 1, length(printf('%x', excess))) END AS page FROM paged)
GROUP BY entity, change, page, n""",
    )
)
def change_log_uids(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = changes.uids_by_kind(changes.change_log(*_sync_plans(spark, sf_dir)))
    return pages.withColumn("uids", F.array_join("uids", ","))


@query(
    with_ctes(
        *_AFTER_PUSH,
        _PULL_AFTER_PUSH,
        body="""SELECT 'local' AS side, entity, count(*) AS n FROM plan WHERE action <> 'error_not_found' GROUP BY entity
UNION ALL SELECT 'remote', entity, count(*) FROM settled WHERE action <> 'skip' GROUP BY entity""",
    )
)
def sync_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.sync_counters(*_sync_plans(spark, sf_dir))


@query(
    with_ctes(
        LOC,
        REM,
        body=f"""SELECT 'local' AS side, entity, count(*) AS n FROM loc WHERE is_dirty GROUP BY entity
UNION ALL SELECT 'remote', entity, count(*) FROM rem WHERE updated_at > {instant(SCAN_FROM)} GROUP BY entity""",
    )
)
def pending_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.pending_counts(loc(spark, sf_dir), pull.increment(rem(spark, sf_dir), {"Order": SCAN_FROM}, FAR))


@query(
    with_ctes(
        *_AFTER_PUSH,
        f"""settled AS (SELECT r.*, {_PULL_ACTION} AS action FROM rem_after r LEFT JOIN loc_after l ON l.uid = r.uid
    WHERE r.uid NOT IN (SELECT uid FROM sent) AND r.uid NOT IN (SELECT uid FROM plan WHERE action = 'error_not_found'))""",
        body="""SELECT 'remote' AS side, uid, status, price, updated_at AS at, author_uid, FALSE AS is_dirty FROM rem_after
UNION ALL SELECT 'local', coalesce(l.uid, s.uid),
    CASE WHEN s.action IN ('insert', 'update') THEN s.status ELSE l.status END,
    CASE WHEN s.action IN ('insert', 'update') THEN s.price ELSE l.price END,
    CASE WHEN s.action IN ('insert', 'update') THEN s.updated_at ELSE l.last_modified END,
    coalesce(s.author_uid, l.author_uid), coalesce(l.is_dirty, FALSE)
FROM loc_after l FULL JOIN settled s ON s.uid = l.uid
WHERE coalesce(s.action, '') NOT IN ('ignore', 'delete_local')""",
    )
)
def two_way_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = sync(
        MODEL,
        {"Order": loc(spark, sf_dir)},
        {"Order": rem(spark, sf_dir)},
        push_time=PUSH_TIME,
        now=FAR,
        on_error="quarantine",
    )
    columns = ["uid", "status", "price", "at", F.col("author.uid").alias("author_uid"), "is_dirty"]
    there = result.remote["Order"].withColumnsRenamed({"updated_at": "at"}).withColumn("is_dirty", F.lit(False))
    here = result.local["Order"].withColumnsRenamed({"last_modified": "at"})
    rows = there.select(F.lit("remote").alias("side"), *columns).unionByName(
        here.select(F.lit("local").alias("side"), *columns)
    )
    return _int_status(rows)
