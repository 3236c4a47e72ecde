"""Per-user scope: rows of one owner are invisible to another."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F

OWNER = "owner"


def owned(table: DataFrame, owner: str) -> DataFrame:
    """Rows of one owner; on a table written by ``write_owned`` only that owner's folder is read."""
    return table.filter(F.col(OWNER) == owner).drop(OWNER)


def write_owned(table: DataFrame) -> DataFrameWriter:
    """A writer that keeps owners in folders of their own; a large owner is split over several files."""
    return table.hint("rebalance", OWNER).write.partitionBy(OWNER)


def owner_path(base: str, owner: str) -> str:
    """Where one owner's store lives below a common folder."""
    if not owner or any(c in owner for c in "/\\") or owner in (".", ".."):
        raise ValueError(f"not an owner name: {owner!r}")
    return f"{base.rstrip('/')}/{OWNER}={owner}"
