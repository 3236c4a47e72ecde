"""Queries of relationships."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbflow.functions.refs import reference
from ebbflow.operators import fetch, pull, relations
from ebbflow.plans.registry import query
from ebbflow.plans.shapes import (
    CUST,
    EDGES,
    LOC,
    REM,
    SCAN_FROM,
    SCAN_TO,
    VISIBLE,
    cust,
    edges,
    instant,
    loc,
    parts,
    rem,
    table,
    with_ctes,
)

# Small pages, so that the driver's tables fill several.
_PAGE = 8


def page_sql(size: int, member: str = "dst_uid") -> str:
    """The page of a member in a group of ``n``."""
    excess = f"((n - 1) // {size})"
    return f"CASE WHEN n <= {size} THEN '' ELSE substr(md5({member}), 1, length(hex({excess}))) END"


@query(
    with_ctes(
        LOC,
        CUST,
        body="SELECT l.uid, c.uid AS author_uid FROM loc l LEFT JOIN cust c ON c.uid = l.author_uid AND c.status = 2",
    )
)
def to_one_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = relations.resolve_to_one(loc(spark, sf_dir), "author", cust(spark, sf_dir))
    return rows.select("uid", F.col("author.uid").alias("author_uid"))


@query(
    with_ctes(
        LOC,
        "live AS (SELECT author_uid AS src_uid, entity AS dst_entity, uid AS dst_uid FROM loc WHERE status = 2)",
        "sized AS (SELECT *, count(*) OVER (PARTITION BY src_uid, dst_entity) AS n FROM live)",
        body=f"""SELECT src_uid, dst_entity, page, n, string_agg(dst_uid, ',' ORDER BY dst_uid) AS members
FROM (SELECT *, {page_sql(_PAGE)} AS page FROM sized) GROUP BY src_uid, dst_entity, page, n""",
    )
)
def to_many_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = loc(spark, sf_dir)
    live = relations.resolve_to_many(relations.inverse_of_to_one(orders, "author"), orders)
    pages = relations.member_pages(live, _PAGE)
    return pages.withColumn("members", F.array_join("members", ","))


@query(with_ctes(LOC, body="SELECT author_uid AS customer, uid AS member FROM loc"))
def inverse_from_to_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = relations.inverse_of_to_one(loc(spark, sf_dir), "author")
    return rows.select(F.col("src_uid").alias("customer"), F.col("dst_uid").alias("member"))


@query(with_ctes(EDGES, body="SELECT dst_uid AS supplier, src_uid AS part FROM edges"))
def inverse_from_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = relations.encode_array(edges(spark, sf_dir), _PAGE)
    rows = stored.select(F.col("src_uid").alias("uid"), F.lit("Part").alias("entity"), "refs")
    rows = relations.inverse_of_array(rows, "refs")
    return rows.select(F.col("src_uid").alias("supplier"), F.col("dst_uid").alias("part"))


@query(
    with_ctes(
        LOC,
        CUST,
        body=f"""SELECT c.uid, count(l.uid) AS n FROM cust c
LEFT JOIN (SELECT * FROM loc WHERE {VISIBLE}) l ON l.author_uid = c.uid GROUP BY c.uid""",
    )
)
def relationship_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = relations.inverse_of_to_one(fetch.visible(loc(spark, sf_dir)), "author")
    return relations.relationship_count(cust(spark, sf_dir), members)


@query(
    with_ctes(
        EDGES,
        "sized AS (SELECT *, count(*) OVER (PARTITION BY src_uid) AS n FROM edges)",
        body=f"""SELECT src_uid AS part, page, n, string_agg('Supplier/' || dst_uid, ',' ORDER BY dst_uid) AS refs
FROM (SELECT *, {page_sql(_PAGE)} AS page FROM sized) GROUP BY src_uid, page, n""",
    )
)
def encode_array_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = relations.encode_array(edges(spark, sf_dir), _PAGE)
    text = F.transform("refs", lambda r: F.concat(r["entity"], F.lit("/"), r["uid"]))
    return stored.select(F.col("src_uid").alias("part"), "page", "n", F.array_join(text, ",").alias("refs"))


@query(
    with_ctes(
        EDGES,
        body="""SELECT src_uid, dst_uid FROM edges WHERE CAST(substr(src_uid, 2) AS BIGINT) % 5 <> 0
UNION ALL SELECT 'p' || p_partkey, 's' || (p_partkey % 97) FROM part WHERE p_partkey % 5 = 0""",
    )
)
def replace_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = parts(spark, sf_dir).filter("key % 5 = 0")
    new = chosen.select(
        F.col("uid").alias("src_uid"),
        F.lit("Supplier").alias("dst_entity"),
        F.concat(F.lit("s"), F.col("key") % 97).alias("dst_uid"),
    )
    rows = relations.replace_edges(edges(spark, sf_dir), new, new.select("src_uid"))
    return rows.select("src_uid", "dst_uid")


def holders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines that hold an array of two references, some of them null or incomplete."""
    number = F.col("l_linenumber")
    supplier = reference("Supplier", F.concat(F.lit("s"), F.col("l_suppkey")))
    part = reference("Part", F.concat(F.lit("p"), F.col("l_partkey")))
    nameless = F.struct(F.lit(None).cast("string").alias("entity"), F.concat(F.lit("p"), F.col("l_partkey")).alias("uid"))
    second = F.when(number % 3 == 0, F.lit(None)).when(number % 5 == 0, nameless).otherwise(part)
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("l"), F.col("l_orderkey"), F.lit("-"), number).alias("uid"),
        F.lit("Line").alias("entity"),
        F.array(supplier, second).alias("refs"),
        F.when(number == 7, F.struct(F.lit("Order").alias("entity"), F.lit(None).cast("string").alias("uid")))
        .otherwise(reference("Order", F.concat(F.lit("o"), F.col("l_orderkey"))))
        .alias("order"),
    )


@query(
    """SELECT 'l' || l_orderkey || '-' || l_linenumber AS uid, 'Supplier' AS dst_entity, 's' || l_suppkey AS dst_uid
FROM lineitem
UNION ALL SELECT 'l' || l_orderkey || '-' || l_linenumber, CASE WHEN l_linenumber % 5 <> 0 THEN 'Part' END,
    'p' || l_partkey FROM lineitem WHERE l_linenumber % 3 <> 0"""
)
def array_ref_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = relations.edges_of_array(holders(spark, sf_dir), "refs")
    return rows.select(F.col("src_uid").alias("uid"), "dst_entity", "dst_uid")


@query(
    with_ctes(
        REM,
        CUST,
        body=f"""SELECT r.uid, r.updated_at, c.name AS author_name, c.segment AS author_segment
FROM rem r LEFT JOIN cust c ON c.uid = r.author_uid
WHERE r.updated_at > {instant(SCAN_FROM)} AND r.updated_at < {instant(SCAN_TO)}""",
    )
)
def scan_with_related(spark: SparkSession, sf_dir: str) -> DataFrame:
    scan = pull.change_scan(rem(spark, sf_dir), "Order", pull.ntz(SCAN_FROM), pull.ntz(SCAN_TO))
    rows = relations.scan_with_related(scan, "author", cust(spark, sf_dir), ["name", "segment"])
    return rows.select("uid", "updated_at", "author_name", "author_segment")


