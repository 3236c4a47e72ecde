"""Identities made by the client, before the remote has heard of a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbflow.session import materialized


def uid_of(*natural_key: Column) -> Column:
    """A UUID-shaped identity that follows from a natural key, the same at every retry."""
    digest = F.md5(F.concat_ws(":", *natural_key))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.upper(F.concat_ws("-", *[F.substring(digest, start, length) for start, length in cuts]))


def assign_uid(df: DataFrame, natural_key: tuple[str, ...] | None = None, entity: str | None = None) -> DataFrame:
    """Give every row without a uid a new one; rows that have one keep it.

    Without a natural key the identities are random. They are written out before anyone reads them,
    since a task run a second time would draw others.
    """
    current = F.col("uid") if "uid" in df.columns else F.lit(None).cast("string")
    if natural_key is None:
        return materialized(df.withColumn("uid", F.coalesce(current, F.upper(F.uuid()))))
    parts = [F.col(c).cast("string") for c in natural_key]
    name = F.lit(entity) if entity is not None else F.col("entity")
    return df.withColumn("uid", F.coalesce(current, uid_of(name, *parts)))
