"""Queries of the integrity checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbflow.operators import checks
from ebbflow.plans.registry import query
from ebbflow.plans.relating import holders
from ebbflow.plans.shapes import REM, parts, rem, table, with_ctes


@query(
    """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""
)
def check_duplicate_uid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    with_ctes(
        REM,
        body="""SELECT key, 'uid' AS missing FROM rem WHERE key % 31 = 0
UNION ALL SELECT key, 'entity' FROM rem WHERE key % 37 = 0
UNION ALL SELECT key, 'updated_at' FROM rem WHERE key % 41 = 0
UNION ALL SELECT key, 'status' FROM rem WHERE key % 43 = 0""",
    )
)
def check_mandatory(spark: SparkSession, sf_dir: str) -> DataFrame:
    holes = {"uid": 31, "entity": 37, "updated_at": 41, "status": 43}
    remote = rem(spark, sf_dir)
    damaged = remote.withColumns({c: F.when(F.col("key") % m != 0, F.col(c)) for c, m in holes.items()})
    return checks.missing_mandatory(damaged).select("key", "missing")


@query(
    """SELECT 'l' || l_orderkey || '-' || l_linenumber AS uid, 'refs' AS "column", 3 AS code
FROM lineitem WHERE l_linenumber % 3 <> 0 AND l_linenumber % 5 = 0
UNION ALL SELECT 'l' || l_orderkey || '-' || l_linenumber, 'order', 3 FROM lineitem WHERE l_linenumber = 7"""
)
def check_reference_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = checks.malformed_references(holders(spark, sf_dir), to_one=["order"], arrays=["refs"])
    return rows.select("uid", "column", "code")


@query("SELECT p_type AS entity, count(*) AS n FROM part WHERE p_type IN ('PROMO', 'STANDARD') GROUP BY p_type")
def check_unknown_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = ["Part", "Sized", "SMALL", "MEDIUM", "LARGE", "ECONOMY"]
    return checks.unknown_entities(parts(spark, sf_dir).select("entity", "uid"), known)
