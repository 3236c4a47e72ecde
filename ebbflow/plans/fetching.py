"""Queries of sources, schema and fetch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbflow.functions.predicates import compare, refers_to
from ebbflow.functions.uids import assign_uid as give_uid
from ebbflow.model import open_evolved, with_control
from ebbflow.operators import fetch, pull, push
from ebbflow.operators.fetch import Order
from ebbflow.plans.registry import query
from ebbflow.plans.shapes import (
    CUST,
    EDGES,
    FAR,
    LOC,
    MODEL,
    PARTS,
    REM,
    SCAN_FROM,
    SCAN_TO,
    VISIBLE,
    all_edges,
    cust,
    instant,
    loc,
    parts,
    rem,
    suppliers,
    table,
    with_ctes,
)
from ebbflow.sources.scope import owned

_PAGE = f"""page AS (SELECT * FROM loc WHERE {VISIBLE} AND price > 300000 ORDER BY price DESC, uid LIMIT 50)"""


@query(
    with_ctes(
        LOC,
        CUST,
        _PAGE,
        body="""SELECT p.uid, p.entity, p.price, c.uid AS author_uid
FROM page p LEFT JOIN cust c ON c.uid = p.author_uid AND c.status = 2""",
    )
)
def object_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fetch.fetch_objects(
        loc(spark, sf_dir),
        MODEL,
        "Order",
        where=F.col("price") > 300000,
        order=[Order("price", descending=True)],
        limit=50,
        targets={"author": cust(spark, sf_dir)},
    )
    return rows.select("uid", "entity", "price", F.col("author.uid").alias("author_uid"))


_SCAN = f"updated_at > {instant(SCAN_FROM)} AND updated_at < {instant(SCAN_TO)}"


def _scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pull.change_scan(rem(spark, sf_dir), "Order", pull.ntz(SCAN_FROM), pull.ntz(SCAN_TO))


@query(with_ctes(REM, body=f"SELECT uid, updated_at FROM rem WHERE {_SCAN}"))
def remote_change_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scan(spark, sf_dir).orderBy("updated_at", "uid").select("uid", "updated_at")


@query(
    with_ctes(
        REM, body=f"SELECT uid, updated_at FROM rem WHERE {_SCAN} ORDER BY updated_at, uid LIMIT 100 OFFSET 200"
    )
)
def remote_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pull.change_page(_scan(spark, sf_dir), number=2).select("uid", "updated_at")


@query(
    """SELECT o_orderkey AS key, o_orderstatus AS order_status,
    CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS priority
FROM orders"""
)
def schema_evolution_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("key"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderpriority").alias("priority"),
    )
    older = orders.filter("key % 2 <> 0").drop("priority")
    return open_evolved([older, orders.filter("key % 2 = 0")]).select("key", "order_status", "priority")


@query(with_ctes(CUST, body=f"SELECT uid, name FROM cust WHERE segment = 'MACHINERY' AND {VISIBLE}"))
def user_scope_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = cust(spark, sf_dir).withColumnRenamed("segment", "owner")
    return fetch.select_rows(owned(customers, "MACHINERY"), MODEL, "Customer").select("uid", "name")


@query(with_ctes(REM, body="SELECT uid, status, updated_at AS last_modified FROM rem WHERE status <> 3"))
def reset_then_full_pull(spark: SparkSession, sf_dir: str) -> DataFrame:
    emptied = spark.createDataFrame([], MODEL.local_schema("Order"))
    incoming = pull.decode_rows(pull.increment(rem(spark, sf_dir), None, FAR, full=True), MODEL, "Order")
    rows = pull.apply_pull(emptied, incoming).local
    return rows.select("uid", F.col("status").cast("int").alias("status"), "last_modified")


@query(with_ctes(LOC, PARTS, body="""SELECT entity, uid FROM loc WHERE is_dirty
UNION ALL SELECT entity, uid FROM parts WHERE is_dirty"""))
def dirty_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [push.dirty(t).select("entity", "uid") for t in (loc(spark, sf_dir), parts(spark, sf_dir))]
    return rows[0].unionByName(rows[1])


@query(with_ctes(LOC, body="SELECT uid, price FROM loc WHERE key % 97 = 0 AND status = 2"))
def lookup_by_uid(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "orders").filter("o_orderkey % 97 = 0")
    keys = keys.select(F.concat(F.lit("o"), F.col("o_orderkey")).alias("uid"))
    return fetch.lookup(loc(spark, sf_dir), keys).select("uid", "price")


@query(
    """SELECT 'c' || c_custkey AS uid, 'Customer' AS entity, 1 AS status, CAST(NULL AS TIMESTAMP) AS last_modified,
    FALSE AS is_dirty, FALSE AS created_remotely
FROM customer"""
)
def control_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), F.col("c_custkey")).alias("uid"))
    rows = with_control(rows, "Customer")
    return rows.withColumn("status", F.col("status").cast("int"))


@query("SELECT DISTINCT p_type AS entity, 'Part' AS root FROM part")
def root_entity_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = parts(spark, sf_dir).select("entity").distinct()
    return rows.select("entity", MODEL.root_column(F.col("entity")).alias("root"))


@query(
    with_ctes(
        LOC,
        CUST,
        body=f"""SELECT l.uid, l.entity, l.price, l.priority, c.uid AS author_uid
FROM (SELECT * FROM loc WHERE {VISIBLE}) l LEFT JOIN cust c ON c.uid = l.author_uid AND c.status = 2""",
    )
)
def public_representation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fetch.fetch_objects(loc(spark, sf_dir), MODEL, "Order", targets={"author": cust(spark, sf_dir)})
    return rows.select("uid", "entity", "price", "priority", F.col("author.uid").alias("author_uid"))


def _supplier_rows(spark: SparkSession, sf_dir: str):
    """Suppliers of which those of some nations are placeholders still."""
    return suppliers(spark, sf_dir).withColumn("status", F.when(F.col("s_nationkey") % 7 == 0, 1).otherwise(2))


_MEMBERS = """live AS (SELECT src_uid, string_agg(dst_uid, ',' ORDER BY dst_uid) AS members
  FROM edges JOIN supplier ON dst_uid = 's' || s_suppkey WHERE s_nationkey % 7 <> 0 GROUP BY src_uid)"""


@query(
    with_ctes(
        PARTS,
        EDGES,
        _MEMBERS,
        body=f"""SELECT uid, coalesce(members, '') AS suppliers FROM parts LEFT JOIN live ON src_uid = uid
WHERE entity IN ('SMALL', 'MEDIUM', 'LARGE') AND {VISIBLE}""",
    )
)
def members_of_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fetch.select_rows(parts(spark, sf_dir), MODEL, "Sized")
    found = fetch.fetch_members(rows, all_edges(spark, sf_dir), _supplier_rows(spark, sf_dir))
    return found.select("uid", F.coalesce(F.array_join(F.col("members")["Supplier"], ","), F.lit("")).alias("suppliers"))


@query(
    with_ctes(
        PARTS,
        EDGES,
        _MEMBERS,
        f"page AS (SELECT * FROM parts WHERE {VISIBLE} ORDER BY name DESC, uid LIMIT 50)",
        body="SELECT uid, coalesce(members, '') AS suppliers FROM page LEFT JOIN live ON src_uid = uid",
    )
)
def members_of_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fetch.cut(fetch.visible(parts(spark, sf_dir)), [Order("name", descending=True)], 50)
    found = fetch.fetch_members(rows, all_edges(spark, sf_dir), _supplier_rows(spark, sf_dir), limit=50)
    return found.select("uid", F.coalesce(F.array_join(F.col("members")["Supplier"], ","), F.lit("")).alias("suppliers"))


@query(
    """SELECT c_custkey AS key, CASE WHEN c_custkey % 5 = 0 THEN 'c' || c_custkey ELSE upper(concat_ws('-',
    substr(d, 1, 8), substr(d, 9, 4), substr(d, 13, 4), substr(d, 17, 4), substr(d, 21, 12))) END AS uid
FROM (SELECT c_custkey, md5('Customer:' || c_custkey) AS d FROM customer)"""
)
def assign_uid(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(
        key.alias("key"), F.when(key % 5 == 0, F.concat(F.lit("c"), key)).alias("uid")
    )
    return give_uid(rows, natural_key=("key",), entity="Customer")


@query(with_ctes(PARTS, body=f"SELECT key, entity FROM parts WHERE entity IN ('SMALL', 'MEDIUM', 'LARGE') AND {VISIBLE}"))
def fetch_with_subentities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fetch.select_rows(parts(spark, sf_dir), MODEL, "Sized").select("key", "entity")


@query(with_ctes(PARTS, body=f"SELECT key, entity FROM parts WHERE entity = 'PROMO' AND {VISIBLE}"))
def fetch_exact_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fetch.select_rows(parts(spark, sf_dir), MODEL, "PROMO", subentities=False).select("key", "entity")


@query(with_ctes(LOC, body=f"SELECT uid FROM loc WHERE {VISIBLE}"))
def visibility_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fetch.visible(loc(spark, sf_dir)).select("uid")


@query(with_ctes(LOC, body=f"SELECT uid FROM loc WHERE {VISIBLE} AND price >= 250000 AND priority = '1-URGENT'"))
def predicate_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = compare(F.col("price"), ">=", 250000) & compare(F.col("priority"), "==", "1-URGENT")
    return fetch.select_rows(loc(spark, sf_dir), MODEL, "Order", where).select("uid")


@query(
    with_ctes(
        CUST,
        body=f"""SELECT uid FROM cust WHERE {VISIBLE} AND (lower(name) = 'customer#000000012' OR
    (lower(segment) LIKE 'b%' AND name LIKE '%7_') OR name BETWEEN 'Customer#000000100' AND 'Customer#000000110')""",
    )
)
def predicate_text_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, segment = F.col("name"), F.col("segment")
    where = (
        compare(name, "==", "CUSTOMER#000000012", "cd")
        | (compare(segment, "BEGINSWITH", "b", "c") & compare(name, "LIKE", "*7?"))
        | compare(name, "BETWEEN", ("Customer#000000100", "Customer#000000110"))
    )
    return fetch.select_rows(cust(spark, sf_dir), MODEL, "Customer", where).select("uid")


@query(
    with_ctes(
        LOC,
        body=f"""SELECT uid FROM loc WHERE {VISIBLE} AND
    ((price > 200000 AND NOT (priority = '5-LOW')) OR order_status = 'P')""",
    )
)
def predicate_compound(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = ((F.col("price") > 200000) & ~(F.col("priority") == "5-LOW")) | (F.col("order_status") == "P")
    return fetch.select_rows(loc(spark, sf_dir), MODEL, "Order", where).select("uid")


@query(with_ctes(LOC, body=f"SELECT uid FROM loc WHERE {VISIBLE} AND author_uid = 'c17'"))
def predicate_object_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fetch.select_rows(loc(spark, sf_dir), MODEL, "Order", refers_to("author", "c17")).select("uid")


@query(
    with_ctes(
        LOC,
        body=f"""SELECT uid FROM loc WHERE {VISIBLE} AND author_uid IN
    (SELECT 'c' || c_custkey FROM customer WHERE c_nationkey = 7)""",
    )
)
def predicate_in_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "customer").filter("c_nationkey = 7")
    objects = nation.select(F.concat(F.lit("c"), F.col("c_custkey")).alias("uid"))
    rows = fetch.select_rows(loc(spark, sf_dir), MODEL, "Order")
    return fetch.in_objects(rows, "author", objects).select("uid")


@query(
    with_ctes(
        PARTS,
        EDGES,
        body=f"""SELECT key FROM parts WHERE {VISIBLE} AND uid IN (SELECT e.src_uid FROM edges e
    JOIN supplier s ON e.dst_uid = 's' || s.s_suppkey WHERE s.s_nationkey = 5)""",
    )
)
def predicate_any_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fetch.select_rows(parts(spark, sf_dir), MODEL, "Part")
    wanted = suppliers(spark, sf_dir).filter("s_nationkey = 5")
    return fetch.any_in_objects(rows, all_edges(spark, sf_dir), wanted).select("key")


@query(
    with_ctes(
        LOC,
        body=f"""SELECT uid, last_modified IS NULL AS is_new FROM loc
WHERE {VISIBLE} AND (last_modified IS NULL OR priority IS NULL)
UNION ALL SELECT 'others: ' || count(*), FALSE FROM loc
WHERE {VISIBLE} AND last_modified IS NOT NULL AND priority IS NOT NULL""",
    )
)
def predicate_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fetch.select_rows(loc(spark, sf_dir), MODEL, "Order")
    modified, priority = F.col("last_modified"), F.col("priority")
    some = rows.filter(compare(modified, "==", None) | compare(priority, "==", None))
    others = rows.filter(compare(modified, "!=", None) & compare(priority, "!=", None)).agg(F.count(F.lit(1)).alias("n"))
    return some.select("uid", modified.isNull().alias("is_new")).unionByName(
        others.select(F.concat(F.lit("others: "), F.col("n")).alias("uid"), F.lit(False).alias("is_new"))
    )


@query(
    with_ctes(
        LOC,
        body=f"""SELECT uid, priority, price, row_number() OVER (ORDER BY priority, price DESC, uid) AS position
FROM loc WHERE {VISIBLE}""",
    )
)
def sorted_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fetch.select_rows(loc(spark, sf_dir), MODEL, "Order").select("uid", "priority", "price")
    return fetch.with_position(rows, [Order("priority"), Order("price", descending=True)])


@query(
    with_ctes(LOC, body=f"SELECT uid, price FROM loc WHERE {VISIBLE} ORDER BY price, uid LIMIT 10 OFFSET 20")
)
def limit_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fetch.select_rows(loc(spark, sf_dir), MODEL, "Order").select("uid", "price")
    return fetch.cut(rows, [Order("price")], limit=10, offset=20)


@query(with_ctes(LOC, body=f"SELECT count(*) AS n FROM loc WHERE {VISIBLE} AND order_status = 'F'"))
def count_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fetch.fetch_count(loc(spark, sf_dir), MODEL, "Order", F.col("order_status") == "F")


@query(with_ctes(LOC, body=f"SELECT entity, uid FROM loc WHERE {VISIBLE} AND order_status = 'O'"))
def id_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fetch.fetch_ids(loc(spark, sf_dir), MODEL, "Order", F.col("order_status") == "O")


@query(with_ctes(LOC, body=f"SELECT DISTINCT priority, order_status FROM loc WHERE {VISIBLE}"))
def dict_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fetch.fetch_dictionaries(loc(spark, sf_dir), MODEL, "Order", ["priority", "order_status"], distinct=True)


@query(
    with_ctes(
        LOC,
        body=f"""SELECT priority, order_status, count(*) AS n, max(price) AS highest FROM loc WHERE {VISIBLE}
GROUP BY priority, order_status HAVING count(*) > 20 AND max(price) > 400000""",
    )
)
def dict_group_having(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fetch.fetch_dictionaries(
        loc(spark, sf_dir),
        MODEL,
        "Order",
        ["priority", "order_status"],
        aggregates=[F.count(F.lit(1)).alias("n"), F.max("price").alias("highest")],
        having=(F.col("n") > 20) & (F.col("highest") > 400000),
    )
