"""Integrity checks: each gives the offending rows, none stops a job by itself."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbflow.functions.refs import has_malformed, is_malformed
from ebbflow.model import KEY, EntityModel
from ebbflow.operators.push import ERROR_MALFORMED_REFERENCE

MANDATORY = ("uid", "entity", "updated_at", "status")


def duplicate_keys(table: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Keys with more than one row, and how many; counted before the shuffle."""
    return table.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def missing_mandatory(remote: DataFrame, columns: Sequence[str] = MANDATORY) -> DataFrame:
    """Remote rows without a mandatory value, once per missing column."""
    missing = F.filter(
        F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]), lambda name: name.isNotNull()
    )
    return remote.withColumn("missing", F.explode(missing))


def malformed_references(rows: DataFrame, to_one: Sequence[str] = (), arrays: Sequence[str] = ()) -> DataFrame:
    """Rows holding a reference without uid or entity, with the column's name and the error code."""
    flags = [F.when(is_malformed(F.col(c)), F.lit(c)) for c in to_one]
    flags += [F.when(has_malformed(F.col(c)), F.lit(c)) for c in arrays]
    found = F.filter(F.array(*flags), lambda name: name.isNotNull())
    return rows.withColumns({"column": F.explode(found), "code": F.lit(ERROR_MALFORMED_REFERENCE)})


def unknown_entities(references: DataFrame, model: EntityModel | Sequence[str]) -> DataFrame:
    """Entities that references name and the model lacks, with the number of references."""
    names = model.names if isinstance(model, EntityModel) else list(model)
    unknown = references.filter(F.col("entity").isNotNull() & ~F.col("entity").isin(names))
    return unknown.groupBy("entity").agg(F.count(F.lit(1)).alias("n"))
