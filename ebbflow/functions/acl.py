"""Access entries: JSON text to a map, a flat table, and merges of both."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: how a role is told apart from a user.
ROLE_PREFIX = "role:"


def _granted(text: Column) -> Column:
    """True for "true", false for any other value, null where the right is not given."""
    return F.when(text.isNotNull(), text == "true")


def parse_acl(text: Column) -> Column:
    """``{who: {read, write}}`` as a map; rights may be JSON booleans or the strings "true" and "false"."""
    raw = F.from_json(text.cast("string"), "map<string,struct<read:string,write:string>>")
    return F.transform_values(
        raw, lambda _, r: F.struct(_granted(r["read"]).alias("read"), _granted(r["write"]).alias("write"))
    )


def format_acl(acl: Column) -> Column:
    """The JSON text of an access map, with rights as strings."""
    as_text = F.transform_values(
        acl, lambda _, r: F.struct(r["read"].cast("string").alias("read"), r["write"].cast("string").alias("write"))
    )
    return F.to_json(as_text)


def explode_acl(df: DataFrame, acl: str = "acl", key: tuple[str, ...] = ("uid",)) -> DataFrame:
    """One row per entry: key, who it is for, whether a role or a user, and the two rights."""
    entries = df.select(*key, F.explode(F.col(acl)).alias("_who", "_rights"))
    is_role = F.col("_who").startswith(ROLE_PREFIX)
    return entries.select(
        *key,
        F.when(is_role, F.lit("role")).otherwise(F.lit("user")).alias("kind"),
        F.when(is_role, F.replace("_who", F.lit(ROLE_PREFIX), F.lit(""))).otherwise(F.col("_who")).alias("who"),
        F.col("_rights.read").alias("read"),
        F.col("_rights.write").alias("write"),
    )


def merge_entries(current: DataFrame, given: DataFrame, key: tuple[str, ...] = ("uid", "kind", "who")) -> DataFrame:
    """Flat entries after a merge: given rights replace, rights not given stay, others are untouched."""
    new = given.select(*key, F.col("read").alias("_read"), F.col("write").alias("_write"))
    return current.join(new, list(key), "full").select(
        *key, F.coalesce("_read", "read").alias("read"), F.coalesce("_write", "write").alias("write")
    )


def merge_maps(current: Column, given: Column) -> Column:
    """The same merge on the map columns of one row."""
    merged = F.map_zip_with(
        F.coalesce(current, F.create_map().cast("map<string,struct<read:boolean,write:boolean>>")),
        given,
        lambda _, old, new: F.struct(
            F.coalesce(new["read"], old["read"]).alias("read"),
            F.coalesce(new["write"], old["write"]).alias("write"),
        ),
    )
    return F.when(given.isNull(), current).otherwise(merged)
