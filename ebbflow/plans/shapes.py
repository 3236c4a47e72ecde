"""The driver's tables in the roles of local table, remote table, edges and feed.

Each shape exists twice: as a DataFrame and as the SQL of a common table expression with the same rules.
The moduli have no common factor, so every case of the decision tables occurs.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbflow.functions.refs import reference
from ebbflow.model import Attribute, DeleteRule, Entity, EntityModel, Relationship, Stored
from ebbflow.operators.joins import spread
from ebbflow.operators.pull import ntz

_TEXT, _LONG, _DOUBLE = T.StringType(), T.LongType(), T.DoubleType()


def _model(on_customer: DeleteRule) -> EntityModel:
    return EntityModel(
        (
            Entity(
                "Customer",
                attributes=(Attribute("key", _LONG), Attribute("name", _TEXT), Attribute("segment", _TEXT)),
                relationships=(Relationship("orders", "Order", True, "author", on_customer, Stored.DERIVED),),
            ),
            Entity(
                "Order",
                attributes=(
                    Attribute("key", _LONG),
                    Attribute("price", _DOUBLE),
                    Attribute("priority", _TEXT),
                    Attribute("order_status", _TEXT),
                ),
                relationships=(
                    Relationship("author", "Customer", inverse="orders"),
                    Relationship("lines", "Line", True, "order", DeleteRule.CASCADE, Stored.DERIVED),
                ),
            ),
            Entity("Line", relationships=(Relationship("order", "Order", inverse="lines"),)),
            Entity(
                "Part",
                attributes=(Attribute("key", _LONG), Attribute("name", _TEXT)),
                relationships=(Relationship("suppliers", "Supplier", True, "parts", stored=Stored.ARRAY),),
            ),
            Entity("Sized", parent="Part"),
            *[Entity(size, parent="Sized") for size in ("SMALL", "MEDIUM", "LARGE")],
            *[Entity(line, parent="Part") for line in ("ECONOMY", "PROMO", "STANDARD")],
            Entity(
                "Supplier",
                attributes=(Attribute("key", _LONG), Attribute("name", _TEXT)),
                relationships=(Relationship("parts", "Part", True, "suppliers", stored=Stored.DERIVED),),
            ),
        )
    )


MODEL = _model(DeleteRule.CASCADE)
NULLIFYING_MODEL = _model(DeleteRule.NULLIFY)

# Instants the queries use.
SCAN_FROM, SCAN_TO = datetime(1997, 1, 1), datetime(1999, 1, 1)
FAR = datetime(2100, 1, 1)
PUSH_TIME = datetime(2030, 1, 1, 12, 30, 0, 250_000)
FEED_TO = datetime(2024, 1, 20)
FEED_WATERMARKS = {"click": datetime(2024, 1, 10), "view": datetime(2024, 1, 12), "error": datetime(2024, 1, 25)}
CUSTOMER_READ = datetime(1996, 1, 1)


def instant(value: datetime) -> str:
    """The SQL literal of an instant."""
    return f"TIMESTAMP '{value.isoformat(sep=' ')}'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text_uid(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), key.cast("string"))


def control(key: Column, last_modified: Column) -> dict[str, Column]:
    """Control columns from a row's key."""
    status = F.when(key % 10 == 0, 3).when(key % 10 == 1, 1).otherwise(2)
    return {
        "status": status.cast("short"),
        "last_modified": F.when(key % 7 != 0, last_modified),
        "is_dirty": key % 4 < 2,
        "created_remotely": key % 3 != 0,
    }


def _control_sql(key: str, last_modified: str) -> str:
    return f"""CASE WHEN {key} % 10 = 0 THEN 3 WHEN {key} % 10 = 1 THEN 1 ELSE 2 END AS status,
    CASE WHEN {key} % 7 <> 0 THEN {last_modified} END AS last_modified,
    {key} % 4 < 2 AS is_dirty, {key} % 3 <> 0 AS created_remotely"""


def _order_columns() -> list[Column]:
    return [
        F.col("o_orderkey").alias("key"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderstatus").alias("order_status"),
        reference("Customer", _text_uid("c", F.col("o_custkey"))).alias("author"),
    ]


_ORDER_SQL = """o_orderkey AS key, 'o' || o_orderkey AS uid, 'Order' AS entity,
    o_orderpriority AS priority, o_orderstatus AS order_status, 'c' || o_custkey AS author_uid"""


def loc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Local orders."""
    orders = table(spark, sf_dir, "orders").filter(F.col("o_orderkey") % 19 != 0)
    key = F.col("o_orderkey")
    return orders.select(
        _text_uid("o", key).alias("uid"),
        F.lit("Order").alias("entity"),
        *[c.alias(n) for n, c in control(key, F.col("o_orderdate")).items()],
        F.col("o_totalprice").alias("price"),
        *_order_columns(),
    )


LOC = f"""loc AS (SELECT {_ORDER_SQL}, o_totalprice AS price,
    {_control_sql("o_orderkey", "o_orderdate")}
  FROM orders WHERE o_orderkey % 19 <> 0)"""


def rem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remote orders."""
    orders = table(spark, sf_dir, "orders").filter(F.col("o_orderkey") % 11 != 0)
    key = F.col("o_orderkey")
    changed = key % 17 < 3
    return orders.select(
        _text_uid("o", key).alias("uid"),
        F.lit("Order").alias("entity"),
        F.when(key % 13 == 0, 3).otherwise(2).cast("short").alias("status"),
        F.when(changed, F.col("o_orderdate") + F.expr("INTERVAL 1 DAY"))
        .otherwise(F.col("o_orderdate"))
        .alias("updated_at"),
        F.when(changed, F.col("o_totalprice") + 1000).otherwise(F.col("o_totalprice")).alias("price"),
        *_order_columns(),
    )


REM = f"""rem AS (SELECT {_ORDER_SQL},
    CASE WHEN o_orderkey % 13 = 0 THEN 3 ELSE 2 END AS status,
    CASE WHEN o_orderkey % 17 < 3 THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END AS updated_at,
    CASE WHEN o_orderkey % 17 < 3 THEN o_totalprice + 1000 ELSE o_totalprice END AS price
  FROM orders WHERE o_orderkey % 11 <> 0)"""


def cust(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Local customers."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        _text_uid("c", key).alias("uid"),
        F.lit("Customer").alias("entity"),
        *[c.alias(n) for n, c in control(key, ntz(CUSTOMER_READ)).items()],
        key.alias("key"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
    )


CUST = f"""cust AS (SELECT c_custkey AS key, 'c' || c_custkey AS uid, 'Customer' AS entity,
    {_control_sql("c_custkey", instant(CUSTOMER_READ))}, c_name AS name, c_mktsegment AS segment
  FROM customer)"""


def cust_remote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remote customers: those the local table says the remote knows."""
    known = cust(spark, sf_dir).filter("created_remotely")
    return known.select(
        "uid", "entity", F.lit(2).cast("short").alias("status"), ntz(CUSTOMER_READ).alias("updated_at"), "key", "name",
        "segment",
    )


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Local parts, a root with sub-entities two levels deep."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        _text_uid("p", key).alias("uid"),
        F.col("p_type").alias("entity"),
        *[c.alias(n) for n, c in control(key, ntz(CUSTOMER_READ)).items()],
        key.alias("key"),
        F.col("p_name").alias("name"),
    )


PARTS = f"""parts AS (SELECT p_partkey AS key, 'p' || p_partkey AS uid, p_type AS entity,
    {_control_sql("p_partkey", instant(CUSTOMER_READ))}, p_name AS name
  FROM part)"""


def all_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts and their suppliers, a pair as often as it was ordered."""
    return _as_edges(table(spark, sf_dir, "lineitem"))


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts and their suppliers, each pair once; the numbers are compared, not the texts made of them."""
    return _as_edges(spread(table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey"), "l_partkey", "l_suppkey").distinct())


def _as_edges(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        _text_uid("p", F.col("l_partkey")).alias("src_uid"),
        F.lit("Supplier").alias("dst_entity"),
        _text_uid("s", F.col("l_suppkey")).alias("dst_uid"),
    )


EDGES = """edges AS (SELECT DISTINCT 'p' || l_partkey AS src_uid, 's' || l_suppkey AS dst_uid FROM lineitem)"""


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        _text_uid("s", F.col("s_suppkey")).alias("uid"), F.lit("Supplier").alias("entity"), "s_nationkey"
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Local order lines, each key once."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    key = F.col("l_orderkey") + F.col("l_linenumber")
    return rows.select(
        F.concat(F.lit("l"), F.col("l_orderkey"), F.lit("-"), F.col("l_linenumber")).alias("uid"),
        F.lit("Line").alias("entity"),
        *[c.alias(n) for n, c in control(key, ntz(CUSTOMER_READ)).items()],
        reference("Order", _text_uid("o", F.col("l_orderkey"))).alias("order"),
    )


LINES = f"""lines AS (SELECT 'l' || l_orderkey || '-' || l_linenumber AS uid, 'Line' AS entity,
    {_control_sql("(l_orderkey + l_linenumber)", instant(CUSTOMER_READ))}, 'o' || l_orderkey AS order_uid
  FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))"""


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change feed with several versions per uid."""
    return as_feed(table(spark, sf_dir, "events"))


def as_feed(events: DataFrame) -> DataFrame:
    return events.select(
        _text_uid("u", F.col("user_id")).alias("uid"),
        F.col("event_type").alias("entity"),
        F.when(F.col("event_id") % 13 == 0, 3).otherwise(2).cast("short").alias("status"),
        F.col("ts").alias("updated_at"),
        "event_id",
        "value",
    )


FEED = """feed AS (SELECT 'u' || user_id AS uid, event_type AS entity,
    CASE WHEN event_id % 13 = 0 THEN 3 ELSE 2 END AS status, ts AS updated_at, event_id, value
  FROM events)"""

VISIBLE = "status = 2 AND (last_modified IS NOT NULL OR (last_modified IS NULL AND NOT created_remotely))"


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


# Events as one root with an entity per kind, for the stream.
FEED_MODEL = EntityModel(
    (
        Entity("Event", attributes=(Attribute("event_id", _LONG), Attribute("value", _DOUBLE))),
        *[Entity(kind, parent="Event") for kind in ("click", "error", "purchase", "signup", "view")],
        Entity("Buyer", attributes=(Attribute("order_key", _LONG), Attribute("price", _DOUBLE))),
    )
)


def as_buyers(orders: DataFrame) -> DataFrame:
    """A change feed of customers, a version per order; orders of one day tie."""
    return orders.select(
        _text_uid("c", F.col("o_custkey")).alias("uid"),
        F.lit("Buyer").alias("entity"),
        F.when(F.col("o_orderstatus") == "P", 3).otherwise(2).cast("short").alias("status"),
        F.col("o_orderdate").alias("updated_at"),
        F.col("o_orderkey").alias("order_key"),
        F.col("o_totalprice").alias("price"),
    )


BUYERS = """buyers AS (SELECT 'c' || o_custkey AS uid, 'Buyer' AS entity,
    CASE WHEN o_orderstatus = 'P' THEN 3 ELSE 2 END AS status, o_orderdate AS updated_at, o_orderkey AS order_key,
    o_totalprice AS price
  FROM orders)"""
