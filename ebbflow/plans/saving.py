"""Queries of saves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbflow.functions.refs import reference
from ebbflow.operators import save
from ebbflow.plans.registry import query
from ebbflow.plans.shapes import (
    CUST,
    LINES,
    LOC,
    MODEL,
    NULLIFYING_MODEL,
    PARTS,
    cust,
    lines,
    loc,
    parts,
    table,
    with_ctes,
)


def _int_status(df: DataFrame) -> DataFrame:
    return df.withColumn("status", F.col("status").cast("int"))


_INSERTED = """batch AS (SELECT 'o' || o_orderkey AS uid, o_totalprice + 1 AS price FROM orders
    WHERE o_orderkey % 19 = 0 OR o_orderkey % 23 = 0)"""


@query(
    with_ctes(
        LOC,
        _INSERTED,
        body="""SELECT coalesce(l.uid, b.uid) AS uid, CASE WHEN b.uid IS NULL THEN l.status ELSE 2 END AS status,
    b.uid IS NOT NULL OR l.is_dirty AS is_dirty, b.uid IS NULL AND l.created_remotely AS created_remotely,
    l.last_modified, coalesce(b.price, l.price) AS price
FROM loc l FULL JOIN batch b ON l.uid = b.uid""",
    )
)
def save_insert_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    batch = (
        table(spark, sf_dir, "orders")
        .filter((key % 19 == 0) | (key % 23 == 0))
        .select(
            F.concat(F.lit("o"), key).alias("uid"),
            F.lit("Order").alias("entity"),
            key.alias("key"),
            (F.col("o_totalprice") + 1).alias("price"),
            F.col("o_orderpriority").alias("priority"),
            F.col("o_orderstatus").alias("order_status"),
            reference("Customer", F.concat(F.lit("c"), F.col("o_custkey"))).alias("author"),
        )
    )
    rows = _int_status(save.insert_rows(loc(spark, sf_dir), batch))
    return rows.select("uid", "status", "is_dirty", "created_remotely", "last_modified", "price")


@query(
    with_ctes(
        LOC,
        body="""SELECT uid, CASE WHEN key % 24 = 0 THEN NULL WHEN key % 8 = 0 THEN price + 5 ELSE price END AS price,
    CASE WHEN key % 8 = 0 AND key % 16 <> 0 THEN 'CHANGED' ELSE priority END AS priority,
    key % 8 = 0 OR is_dirty AS is_dirty, status
FROM loc""",
    )
)
def save_partial_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = loc(spark, sf_dir)
    key = F.col("key")
    batch = orders.filter(key % 8 == 0).select(
        "uid",
        "entity",
        F.when(key % 24 != 0, F.col("price") + 5).alias("price"),
        F.lit("CHANGED").alias("priority"),
        F.when(key % 16 == 0, F.array(F.lit("price")))
        .otherwise(F.array(F.lit("price"), F.lit("priority")))
        .alias("present"),
    )
    rows = _int_status(save.update_rows(orders, batch))
    return rows.select("uid", "price", "priority", "is_dirty", "status")


@query(
    with_ctes(
        LOC,
        body="""SELECT uid, CASE WHEN key % 29 = 0 THEN 3 ELSE status END AS status,
    key % 29 = 0 OR is_dirty AS is_dirty, price
FROM loc""",
    )
)
def save_soft_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = loc(spark, sf_dir)
    rows = save.soft_delete(orders, orders.filter("key % 29 = 0").select("uid"))
    return _int_status(rows).select("uid", "status", "is_dirty", "price")


@query(
    with_ctes(
        LOC,
        body="""SELECT DISTINCT 'Customer' AS entity, author_uid AS uid, 1 AS status, TRUE AS created_remotely FROM loc
WHERE author_uid NOT IN (SELECT 'c' || c_custkey FROM customer WHERE c_custkey % 7 <> 0)""",
    )
)
def placeholders_from_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs = save.references_of(loc(spark, sf_dir), MODEL.relationships("Order"))
    existing = cust(spark, sf_dir).filter("key % 7 <> 0")
    rows = save.placeholders(refs, existing, created_remotely=True)
    return _int_status(rows).select("entity", "uid", "status", "created_remotely")


@query(
    with_ctes(
        LOC,
        PARTS,
        body="""SELECT entity, count(*) AS n FROM (SELECT entity FROM loc UNION ALL SELECT entity FROM parts)
GROUP BY entity""",
    )
)
def batch_by_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return save.batch_sizes(loc(spark, sf_dir), parts(spark, sf_dir))


_GONE_CUSTOMERS = "gone AS (SELECT uid FROM cust WHERE key % 10 = 3)"


@query(
    with_ctes(
        CUST,
        LOC,
        LINES,
        _GONE_CUSTOMERS,
        "gone_orders AS (SELECT uid FROM loc WHERE author_uid IN (SELECT uid FROM gone))",
        body="""SELECT 'Customer' AS entity, uid FROM gone
UNION ALL SELECT 'Order', uid FROM gone_orders
UNION ALL SELECT 'Line', uid FROM lines WHERE order_uid IN (SELECT uid FROM gone_orders)""",
    )
)
def cascade_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {"Customer": cust(spark, sf_dir), "Order": loc(spark, sf_dir), "Line": lines(spark, sf_dir)}
    keys = tables["Customer"].filter("key % 10 = 3")
    gone = save.gone_keys(MODEL, tables, {"Customer": keys})
    levels = [rows.select(F.lit(root).alias("entity"), "uid") for root, rows in gone.items()]
    return levels[0].unionByName(levels[1]).unionByName(levels[2])


@query(
    with_ctes(
        CUST,
        LOC,
        _GONE_CUSTOMERS,
        body="""SELECT c.uid, CASE WHEN g.uid IS NULL THEN c.status ELSE 3 END AS status,
    g.uid IS NOT NULL OR c.is_dirty AS is_dirty, NULL AS author_uid
FROM cust c LEFT JOIN gone g ON g.uid = c.uid
UNION ALL SELECT l.uid, l.status, g.uid IS NOT NULL OR l.is_dirty,
    CASE WHEN g.uid IS NULL THEN l.author_uid END
FROM loc l LEFT JOIN gone g ON g.uid = l.author_uid""",
    )
)
def nullify_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {"Customer": cust(spark, sf_dir), "Order": loc(spark, sf_dir)}
    keys = tables["Customer"].filter("key % 10 = 3")
    after = save.delete_rows(NULLIFYING_MODEL, tables, "Customer", keys).tables
    customers = after["Customer"].select("uid", "status", "is_dirty", F.lit(None).cast("string").alias("author_uid"))
    orders = after["Order"].select("uid", "status", "is_dirty", F.col("author.uid").alias("author_uid"))
    return _int_status(customers.unionByName(orders))
