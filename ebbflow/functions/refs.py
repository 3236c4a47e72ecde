"""References: the ``(entity, uid)`` structs that rows point at each other with."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def reference(entity: Column | str, uid: Column) -> Column:
    """A reference, or null when there is no uid."""
    name = F.lit(entity) if isinstance(entity, str) else entity
    return F.when(uid.isNotNull(), F.struct(name.alias("entity"), uid.alias("uid")))


def clean_references(references: Column) -> Column:
    """An array of references without null elements, each reduced to ``(entity, uid)``."""
    return F.transform(
        F.filter(references, lambda r: r.isNotNull()),
        lambda r: F.struct(r["entity"].alias("entity"), r["uid"].alias("uid")),
    )


def is_malformed(ref: Column) -> Column:
    """A reference that is there but lacks its uid or its entity."""
    return ref.isNotNull() & (ref["uid"].isNull() | ref["entity"].isNull())


def has_malformed(references: Column) -> Column:
    """Whether an array holds a malformed reference; null elements are not counted."""
    return F.coalesce(F.exists(references, is_malformed), F.lit(False))
