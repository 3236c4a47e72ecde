"""Queries of stores: a sync committed as a delta, what changed between versions, and deletes over a graph."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbflow.functions.refs import reference
from ebbflow.model import Attribute, DeleteRule, Entity, EntityModel, Relationship, Stored
from ebbflow.operators import save
from ebbflow.operators.delta import sync_stores
from ebbflow.operators.joins import spread
from ebbflow.operators.pull import ntz
from ebbflow.plans.registry import query
from ebbflow.plans.shapes import (
    _DOUBLE,
    _LONG,
    _TEXT,
    CUST,
    CUSTOMER_READ,
    FAR,
    LOC,
    PARTS,
    PUSH_TIME,
    REM,
    SCAN_FROM,
    cust,
    cust_remote,
    edges,
    instant,
    loc,
    parts,
    rem,
    suppliers,
    table,
    with_ctes,
)
from ebbflow.session import shared_dir
from ebbflow.sources.changefeed import changes_between
from ebbflow.sources.snapshots import SnapshotStore

# Deletes over a graph

GRAPH_MODEL = EntityModel(
    (
        Entity("Supplier", relationships=(Relationship("parts", "Part", True, "suppliers", DeleteRule.CASCADE, Stored.DERIVED),)),
        Entity(
            "Part",
            relationships=(
                Relationship("suppliers", "Supplier", True, "parts", stored=Stored.RELATION),
                Relationship("lines", "Line", True, "part", DeleteRule.CASCADE, Stored.DERIVED),
            ),
        ),
        Entity(
            "Line",
            relationships=(Relationship("part", "Part", inverse="lines"), Relationship("order", "Order", inverse="lines")),
        ),
        Entity(
            "Order",
            relationships=(
                Relationship("lines", "Line", True, "order", DeleteRule.CASCADE, Stored.DERIVED),
                Relationship("follows", "Order", inverse="followers"),
                Relationship("followers", "Order", True, "follows", DeleteRule.CASCADE, Stored.DERIVED),
            ),
        ),
    )
)


def _graph(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Suppliers, parts, lines, and orders that follow the one before of the same customer and priority."""

    def entity(name: str) -> Column:
        return F.lit(name).alias("entity")

    numbered = spread(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), "l_orderkey", "l_linenumber")
    lineitem = numbered.groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("part"))
    before = Window.partitionBy("o_custkey", "o_orderpriority").orderBy("o_orderdate", "o_orderkey")
    placed = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
    orders = spread(placed, "o_custkey", "o_orderpriority").withColumn("before", F.lag("o_orderkey").over(before))
    return {
        "Supplier": suppliers(spark, sf_dir).select("uid", "entity"),
        "Part": parts(spark, sf_dir).select("uid", entity("Part")),
        "Line": lineitem.select(
            F.concat(F.lit("l"), F.col("l_orderkey"), F.lit("-"), F.col("l_linenumber")).alias("uid"),
            entity("Line"),
            reference("Part", F.concat(F.lit("p"), F.col("part"))).alias("part"),
            reference("Order", F.concat(F.lit("o"), F.col("l_orderkey"))).alias("order"),
        ),
        "Order": orders.select(
            F.concat(F.lit("o"), F.col("o_orderkey")).alias("uid"),
            entity("Order"),
            reference("Order", F.concat(F.lit("o"), F.col("before"))).alias("follows"),
        ),
    }


@query(
    """
    WITH RECURSIVE ways AS (
        SELECT DISTINCT 'Supplier' AS f_kind, 's' || l_suppkey AS f, 'Part' AS t_kind, 'p' || l_partkey AS t
        FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part)
        UNION ALL
        SELECT 'Part', 'p' || min(l_partkey), 'Line', 'l' || l_orderkey || '-' || l_linenumber
        FROM lineitem GROUP BY l_orderkey, l_linenumber
        UNION ALL
        SELECT DISTINCT 'Order', 'o' || l_orderkey, 'Line', 'l' || l_orderkey || '-' || l_linenumber FROM lineitem
        UNION ALL
        SELECT 'Order', 'o' || before, 'Order', 'o' || o_orderkey
        FROM (SELECT o_orderkey, lag(o_orderkey) OVER (PARTITION BY o_custkey, o_orderpriority
                                                       ORDER BY o_orderdate, o_orderkey) AS before FROM orders)
        WHERE before IS NOT NULL
    ), gone AS (
        SELECT * FROM (SELECT 'Supplier' AS entity, 's' || s_suppkey AS uid FROM supplier WHERE s_acctbal < 0
                       UNION ALL SELECT 'Order', 'o' || o_orderkey FROM orders WHERE o_totalprice > 400000)
        UNION
        SELECT t_kind, t FROM gone JOIN ways ON f_kind = entity AND f = uid
    )
    SELECT entity, uid FROM gone
    """
)
def cascade_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What goes with suppliers in debt, over the edges of their parts, and with dear orders, over those that follow."""
    owing = table(spark, sf_dir, "supplier").filter("s_acctbal < 0")
    dear = table(spark, sf_dir, "orders").filter("o_totalprice > 400000")
    keys = {
        "Supplier": owing.select(F.concat(F.lit("s"), F.col("s_suppkey")).alias("uid")),
        "Order": dear.select(F.concat(F.lit("o"), F.col("o_orderkey")).alias("uid")),
    }
    found = save.gone_keys(GRAPH_MODEL, _graph(spark, sf_dir), keys, {"Part.suppliers": edges(spark, sf_dir)})
    kinds = [rows.select(F.lit(root).alias("entity"), "uid") for root, rows in found.items()]
    together = kinds[0]
    for rows in kinds[1:]:
        together = together.unionByName(rows)
    return together


# A sync of stores

STORE_MODEL = EntityModel(
    (
        Entity(
            "Customer",
            attributes=(Attribute("key", _LONG), Attribute("name", _TEXT)),
            relationships=(Relationship("orders", "Order", True, "author", stored=Stored.DERIVED),),
        ),
        Entity(
            "Order",
            attributes=(Attribute("key", _LONG), Attribute("price", _DOUBLE)),
            relationships=(Relationship("author", "Customer", inverse="orders"),),
        ),
        Entity(
            "Part",
            attributes=(Attribute("key", _LONG), Attribute("name", _TEXT)),
            relationships=(Relationship("suppliers", "Supplier", True, stored=Stored.RELATION),),
        ),
        Entity("Supplier"),
    )
)
STORE_MARKS = {"Customer": CUSTOMER_READ, "Order": SCAN_FROM, "Part": CUSTOMER_READ, "Supplier": CUSTOMER_READ}
_SUPPLIERS = "Part.suppliers"


def _part_edges(spark: SparkSession, sf_dir: str, without: str) -> DataFrame:
    """Pairs of part and supplier with a line of another flag than the given one."""
    lines = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") != without)
    pairs = lines.select("l_partkey", "l_suppkey").distinct()  # as numbers, which are shorter than the names made of them
    return pairs.select(
        F.concat(F.lit("p"), F.col("l_partkey")).alias("src_uid"),
        F.lit("Supplier").alias("dst_entity"),
        F.concat(F.lit("s"), F.col("l_suppkey")).alias("dst_uid"),
    )


def _stores(spark: SparkSession, sf_dir: str) -> tuple[SnapshotStore, SnapshotStore]:
    """Both sides with what they hold before the sync; files small enough that facts tell them apart."""
    home = f"{shared_dir(spark)}/stores-{uuid.uuid4().hex}"
    local = SnapshotStore(spark, f"{home}/local", STORE_MODEL, buckets=8)
    remote = SnapshotStore(spark, f"{home}/remote", STORE_MODEL, buckets=8, side="remote", records_per_file=50_000)
    own_parts = parts(spark, sf_dir).withColumn("entity", F.lit("Part"))
    known = own_parts.filter("created_remotely")
    later = ntz(CUSTOMER_READ) + F.expr("INTERVAL 1 DAY")
    remote_parts = known.select(
        "uid",
        "entity",
        F.when(F.col("key") % 13 == 0, 3).otherwise(2).cast("short").alias("status"),
        F.when(F.col("key") % 5 == 0, later).otherwise(ntz(CUSTOMER_READ)).alias("updated_at"),
        "key",
        F.upper("name").alias("name"),
    )
    held = suppliers(spark, sf_dir).filter("s_nationkey > 4").select(
        "uid",
        "entity",
        F.lit(2).cast("short").alias("status"),
        ntz(CUSTOMER_READ).alias("last_modified"),
        F.lit(False).alias("is_dirty"),
        F.lit(True).alias("created_remotely"),
    )
    there = suppliers(spark, sf_dir).select(
        "uid", "entity", F.lit(2).cast("short").alias("status"), ntz(CUSTOMER_READ).alias("updated_at")
    )
    orders = [c for c in loc(spark, sf_dir).columns if c not in ("priority", "order_status")]
    local.commit(
        {
            "Customer": cust(spark, sf_dir).drop("segment"),
            "Order": loc(spark, sf_dir).select(*orders),
            "Part": own_parts,
            "Supplier": held,
            _SUPPLIERS: _part_edges(spark, sf_dir, "R"),
        },
        watermarks=STORE_MARKS,
    )
    remote.commit(
        {
            "Customer": cust_remote(spark, sf_dir).drop("segment"),
            "Order": rem(spark, sf_dir).drop("priority", "order_status"),
            "Part": remote_parts,
            "Supplier": there,
            _SUPPLIERS: _part_edges(spark, sf_dir, "A"),
        }
    )
    return local, remote


def _root_sql(root: str, here: str, there: str) -> str:
    """The sync of one root as tables: plan, sent, pushed (local after the push), pulled, local and remote after."""
    n = root.lower()
    return f"""{n}_plan AS (SELECT l.uid, CASE WHEN NOT l.created_remotely AND l.status = 3 THEN 'drop_local'
      WHEN NOT l.created_remotely THEN 'insert_remote' WHEN r.uid IS NULL THEN 'error_not_found'
      WHEN l.last_modified IS NOT NULL AND l.last_modified <> r.updated_at THEN 'overwrite_local'
      ELSE 'update_remote' END AS action
    FROM {here} l LEFT JOIN {there} r ON r.uid = l.uid WHERE l.is_dirty),
{n}_sent AS (SELECT uid FROM {n}_plan WHERE action IN ('insert_remote', 'update_remote')),
{n}_pushed AS (SELECT l.uid, CASE WHEN p.action = 'overwrite_local' THEN r.status ELSE l.status END AS status,
      CASE WHEN p.action IN ('insert_remote', 'update_remote') THEN {instant(PUSH_TIME)}
        WHEN p.action = 'overwrite_local' THEN r.updated_at ELSE l.last_modified END AS moment,
      l.is_dirty AND coalesce(p.action, '') NOT IN ('insert_remote', 'update_remote', 'overwrite_local') AS is_dirty,
      CASE WHEN p.action = 'overwrite_local' THEN r.value ELSE l.value END AS value,
      CASE WHEN p.action = 'overwrite_local' THEN r.ref ELSE l.ref END AS ref
    FROM {here} l LEFT JOIN {n}_plan p ON p.uid = l.uid LEFT JOIN {there} r ON r.uid = l.uid
    WHERE coalesce(p.action, '') <> 'drop_local'),
{n}_pulled AS (SELECT r.*, CASE WHEN l.uid IS NOT NULL AND l.moment = r.updated_at THEN 'skip'
      WHEN l.uid IS NULL AND r.status = 3 THEN 'ignore' WHEN l.uid IS NULL THEN 'insert'
      WHEN r.status = 3 THEN 'delete_local' ELSE 'update' END AS action
    FROM {there} r LEFT JOIN {n}_pushed l ON l.uid = r.uid
    WHERE r.updated_at > {instant(STORE_MARKS[root])} AND r.uid NOT IN (SELECT uid FROM {n}_sent)),
{n}_taken AS (SELECT uid FROM {n}_pulled WHERE action IN ('insert', 'update')
    UNION SELECT uid FROM {n}_plan WHERE action = 'overwrite_local'),
{n}_local AS (SELECT coalesce(l.uid, p.uid) AS uid,
      CASE WHEN p.action IN ('insert', 'update') THEN p.status ELSE l.status END AS status,
      CASE WHEN p.action IN ('insert', 'update') THEN p.updated_at ELSE l.moment END AS moment,
      coalesce(l.is_dirty, FALSE) AS is_dirty,
      CASE WHEN p.action IN ('insert', 'update') THEN p.value ELSE l.value END AS value,
      CASE WHEN p.action IN ('insert', 'update') THEN p.ref ELSE l.ref END AS ref
    FROM {n}_pushed l FULL JOIN {n}_pulled p ON p.uid = l.uid
    WHERE coalesce(p.action, '') NOT IN ('ignore', 'delete_local')),
{n}_remote AS (SELECT coalesce(r.uid, s.uid) AS uid, coalesce(s.status, r.status) AS status,
      CASE WHEN s.uid IS NULL THEN r.updated_at ELSE {instant(PUSH_TIME)} END AS moment,
      CASE WHEN s.uid IS NULL THEN r.value ELSE s.value END AS value,
      CASE WHEN s.uid IS NULL THEN r.ref ELSE s.ref END AS ref
    FROM {there} r FULL JOIN (SELECT l.* FROM {here} l WHERE l.uid IN (SELECT uid FROM {n}_sent)) s ON s.uid = r.uid)"""


_NONE = "CAST(NULL AS VARCHAR)"
_STORE_CTES = (
    LOC,
    REM,
    CUST,
    PARTS,
    f"""c_here AS (SELECT uid, status, last_modified, is_dirty, created_remotely, name AS value, {_NONE} AS ref FROM cust)""",
    f"""c_there AS (SELECT uid, 2 AS status, {instant(CUSTOMER_READ)} AS updated_at, name AS value, {_NONE} AS ref
    FROM cust WHERE created_remotely)""",
    f"""p_here AS (SELECT uid, status, last_modified, is_dirty, created_remotely, name AS value, {_NONE} AS ref FROM parts)""",
    f"""p_there AS (SELECT uid, CASE WHEN key % 13 = 0 THEN 3 ELSE 2 END AS status,
    CASE WHEN key % 5 = 0 THEN {instant(CUSTOMER_READ)} + INTERVAL 1 DAY ELSE {instant(CUSTOMER_READ)} END AS updated_at,
    upper(name) AS value, {_NONE} AS ref FROM parts WHERE created_remotely)""",
    _root_sql("Customer", "c_here", "c_there"),
    _root_sql("Part", "p_here", "p_there"),
    # An order lets go of a customer that was deleted before the remote heard of them.
    """o_here AS (SELECT uid, status, last_modified, is_dirty, created_remotely, CAST(price AS VARCHAR) AS value,
    CASE WHEN author_uid NOT IN (SELECT uid FROM customer_plan WHERE action = 'drop_local') THEN author_uid END AS ref
    FROM loc)""",
    "o_there AS (SELECT uid, status, updated_at, CAST(price AS VARCHAR) AS value, author_uid AS ref FROM rem)",
    _root_sql("Order", "o_here", "o_there"),
    """unheard AS (SELECT DISTINCT c.uid FROM c_here c JOIN o_here o ON o.ref = c.uid
    WHERE o.uid IN (SELECT uid FROM order_sent) AND NOT c.created_remotely
      AND c.uid NOT IN (SELECT uid FROM customer_plan))""",
    """wanted AS (SELECT DISTINCT r.ref AS uid FROM o_there r
    WHERE r.uid IN (SELECT uid FROM order_taken) AND r.ref NOT IN (SELECT uid FROM customer_local))""",
    """e_here AS (SELECT DISTINCT 'p' || l_partkey AS src, 's' || l_suppkey AS dst FROM lineitem
    WHERE l_returnflag <> 'R'),
e_there AS (SELECT DISTINCT 'p' || l_partkey AS src, 's' || l_suppkey AS dst FROM lineitem WHERE l_returnflag <> 'A'),
e_local AS (SELECT * FROM e_here WHERE src NOT IN (SELECT uid FROM part_taken)
      AND src NOT IN (SELECT uid FROM part_plan WHERE action = 'drop_local')
      AND src NOT IN (SELECT uid FROM part_pulled WHERE action = 'delete_local')
    UNION ALL SELECT * FROM e_there WHERE src IN (SELECT uid FROM part_taken)),
e_remote AS (SELECT * FROM e_there WHERE src NOT IN (SELECT uid FROM part_sent)
    UNION ALL SELECT * FROM e_here WHERE src IN (SELECT uid FROM part_sent)),
s_all AS (SELECT 's' || s_suppkey AS uid, s_nationkey FROM supplier),
s_new AS (SELECT DISTINCT dst AS uid FROM e_there
    WHERE src IN (SELECT uid FROM part_taken) AND dst NOT IN (SELECT uid FROM s_all WHERE s_nationkey > 4))""",
)
_STORE_SQL = with_ctes(
    *_STORE_CTES,
    body=f"""SELECT 'local' AS side, 'Order' AS root, uid, status, moment, is_dirty, value, ref FROM order_local
UNION ALL SELECT 'remote', 'Order', uid, status, moment, FALSE, value, ref FROM order_remote
UNION ALL SELECT 'local', 'Part', uid, status, moment, is_dirty, value, ref FROM part_local
UNION ALL SELECT 'remote', 'Part', uid, status, moment, FALSE, value, ref FROM part_remote
UNION ALL SELECT 'local', 'Customer', uid, status, CASE WHEN uid IN (SELECT uid FROM unheard) THEN {instant(PUSH_TIME)}
    ELSE moment END, is_dirty, value, ref FROM customer_local
UNION ALL SELECT 'local', 'Customer', uid, 1, NULL, FALSE, NULL, NULL FROM wanted
UNION ALL SELECT 'remote', 'Customer', uid, status, moment, FALSE, value, ref FROM customer_remote
UNION ALL SELECT 'remote', 'Customer', uid, 1, {instant(PUSH_TIME)}, FALSE, NULL, NULL FROM unheard
UNION ALL SELECT 'local', 'Supplier', uid, 2, {instant(CUSTOMER_READ)}, FALSE, NULL, NULL FROM s_all WHERE s_nationkey > 4
UNION ALL SELECT 'local', 'Supplier', uid, 1, NULL, FALSE, NULL, NULL FROM s_new
UNION ALL SELECT 'remote', 'Supplier', uid, 2, {instant(CUSTOMER_READ)}, FALSE, NULL, NULL FROM s_all
UNION ALL SELECT 'local', 'Part.suppliers', src, NULL, NULL, NULL, NULL, dst FROM e_local
UNION ALL SELECT 'remote', 'Part.suppliers', src, NULL, NULL, NULL, NULL, dst FROM e_remote""",
)


def _content(store: SnapshotStore) -> DataFrame:
    """All rows and edges of a store in one shape."""
    none = F.lit(None).cast("string")
    values = {"Order": F.col("price").cast("string"), "Part": F.col("name"), "Customer": F.col("name"), "Supplier": none}
    at = "updated_at" if store.side == "remote" else "last_modified"
    dirty = F.lit(False) if store.side == "remote" else F.col("is_dirty")
    links = store.read(_SUPPLIERS).select(
        F.lit(store.side).alias("side"),
        F.lit(_SUPPLIERS).alias("root"),
        F.col("src_uid").alias("uid"),
        F.lit(None).cast("int").alias("status"),
        F.lit(None).cast("timestamp_ntz").alias("moment"),
        F.lit(None).cast("boolean").alias("is_dirty"),
        none.alias("value"),
        F.col("dst_uid").alias("ref"),
    )
    for root, value in values.items():
        rows = store.read(root)
        ref = F.col("author.uid") if root == "Order" else none
        links = links.unionByName(
            rows.select(
                F.lit(store.side).alias("side"),
                F.lit(root).alias("root"),
                "uid",
                F.col("status").cast("int").alias("status"),
                F.col(at).alias("moment"),
                dirty.alias("is_dirty"),
                value.alias("value"),
                ref.alias("ref"),
            )
        )
    return links


@query(_STORE_SQL)
def sync_commit_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both stores after an increment was pushed and pulled as a delta: four roots and an edge table."""
    local, remote = _stores(spark, sf_dir)
    sync_stores(local, remote, push_time=PUSH_TIME, now=FAR, on_error="quarantine")
    return _content(local).unionByName(_content(remote))


@query(
    with_ctes(
        *_STORE_CTES,
        """before AS (SELECT 'Order' AS entity, uid, status, last_modified AS moment, is_dirty, CAST(price AS VARCHAR) AS value,
    author_uid AS ref FROM loc
  UNION ALL SELECT 'Part', uid, status, last_modified, is_dirty, value, ref FROM p_here
  UNION ALL SELECT 'Customer', uid, status, last_modified, is_dirty, value, ref FROM c_here)""",
        """after AS (SELECT 'Order' AS entity, uid, status, moment, is_dirty, value, ref FROM order_local
  UNION ALL SELECT 'Part', uid, status, moment, is_dirty, value, ref FROM part_local
  UNION ALL SELECT 'Customer', uid, status, moment, is_dirty, value, ref FROM customer_local
  UNION ALL SELECT 'Customer', uid, 1, NULL, FALSE, NULL, NULL FROM wanted
  UNION ALL SELECT 'Supplier', uid, 1, NULL, FALSE, NULL, NULL FROM s_new)""",
        body="""SELECT entity, change, uid FROM (
    SELECT coalesce(a.entity, b.entity) AS entity, coalesce(a.uid, b.uid) AS uid,
      CASE WHEN b.uid IS NULL THEN 'inserted' WHEN a.uid IS NULL THEN 'deleted'
        WHEN (a.status, a.moment, a.is_dirty, a.value, a.ref) IS DISTINCT FROM (b.status, b.moment, b.is_dirty, b.value, b.ref)
        THEN 'updated' END AS change
    FROM before b FULL JOIN after a ON a.uid = b.uid AND a.entity = b.entity)
WHERE change IS NOT NULL""",
    )
)
def store_changes_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the local store's rows went through between the versions before and after a delta sync."""
    local, remote = _stores(spark, sf_dir)
    older = local.manifest().number
    done = sync_stores(local, remote, push_time=PUSH_TIME, now=FAR, on_error="quarantine")
    return changes_between(local, older, done.local_version)
