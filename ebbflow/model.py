"""Entity model: names, inheritance, relationships and the schemas they imply.

Everything here is plain Python about a model of a few dozen entities; no data passes through it.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from enum import Enum, IntEnum
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Status(IntEnum):
    """Life cycle of a row."""

    PLACEHOLDER = 1  # referenced by somebody, not yet filled
    POPULATED = 2
    DELETED = 3  # tombstone, kept so that others learn of the delete


class Stored(Enum):
    """How the remote keeps a relationship."""

    POINTER = "pointer"  # to-one: a reference column
    DERIVED = 0  # to-many that is not stored, its inverse is
    ARRAY = 1  # to-many as an array column of references
    RELATION = 2  # to-many as an edge table


class DeleteRule(Enum):
    NULLIFY = "nullify"
    CASCADE = "cascade"


REFERENCE = T.StructType([T.StructField("entity", T.StringType()), T.StructField("uid", T.StringType())])
ACCESS = T.MapType(
    T.StringType(),
    T.StructType([T.StructField("read", T.BooleanType()), T.StructField("write", T.BooleanType())]),
)

KEY = ("entity", "uid")

# Control columns of a local table: name, type, nullable, default.
LOCAL_CONTROL: tuple[tuple[str, T.DataType, bool, object], ...] = (
    ("status", T.ShortType(), False, int(Status.PLACEHOLDER)),
    ("last_modified", T.TimestampNTZType(), True, None),
    ("is_dirty", T.BooleanType(), False, False),
    ("created_remotely", T.BooleanType(), False, False),
)
LOCAL_CONTROL_NAMES = tuple(name for name, *_ in LOCAL_CONTROL)
# What the remote keeps beside the user's properties.
REMOTE_CONTROL_NAMES = ("status", "updated_at")
# Control columns a fetch never shows.
PRIVATE = LOCAL_CONTROL_NAMES


@dataclass(frozen=True)
class Attribute:
    name: str
    type: T.DataType


@dataclass(frozen=True)
class Relationship:
    name: str
    target: str
    to_many: bool = False
    inverse: str | None = None
    delete_rule: DeleteRule = DeleteRule.NULLIFY
    stored: Stored = Stored.POINTER

    def __post_init__(self) -> None:
        if self.to_many == (self.stored is Stored.POINTER):
            raise ValueError(f"relationship {self.name}: a to-many needs its stored form, a to-one is a pointer")


@dataclass(frozen=True)
class Entity:
    name: str
    parent: str | None = None
    attributes: tuple[Attribute, ...] = ()
    relationships: tuple[Relationship, ...] = ()


@dataclass(frozen=True)
class EntityModel:
    """A closed set of entities; sub-entities share the table of their root."""

    entities: tuple[Entity, ...]
    _by_name: dict[str, Entity] = field(init=False, repr=False, compare=False)

    def __post_init__(self) -> None:
        object.__setattr__(self, "_by_name", {e.name: e for e in self.entities})
        if len(self._by_name) != len(self.entities):
            raise ValueError("two entities share a name")
        for entity in self.entities:
            self.lineage(entity.name)
            for relationship in entity.relationships:
                self[relationship.target]

    def __getitem__(self, name: str) -> Entity:
        try:
            return self._by_name[name]
        except KeyError:
            raise KeyError(f"entity {name!r} is not in the model") from None

    @property
    def names(self) -> list[str]:
        return sorted(self._by_name)

    @property
    def roots(self) -> list[str]:
        return [name for name in self.names if self[name].parent is None]

    def lineage(self, name: str) -> list[str]:
        """The entity and its ancestors, root last."""
        chain: list[str] = []
        step: str | None = name
        while step is not None:
            if step in chain:
                raise ValueError(f"entity {name!r} is its own ancestor")
            chain.append(step)
            step = self[step].parent
        return chain

    def root_of(self, name: str) -> str:
        return self.lineage(name)[-1]

    def family(self, name: str) -> list[str]:
        """The entity and all entities below it."""
        return [other for other in self.names if name in self.lineage(other)]

    def attributes(self, name: str) -> list[Attribute]:
        return [a for step in reversed(self.lineage(name)) for a in self[step].attributes]

    def relationships(self, name: str) -> list[Relationship]:
        return [r for step in reversed(self.lineage(name)) for r in self[step].relationships]

    def relationship(self, entity: str, name: str) -> Relationship:
        for candidate in self.relationships(entity):
            if candidate.name == name:
                return candidate
        raise KeyError(f"entity {entity!r} has no relationship {name!r}")

    def inverse_of(self, relationship: Relationship) -> Relationship | None:
        return self.relationship(relationship.target, relationship.inverse) if relationship.inverse else None

    def read_from_remote(self, entity: str, relationship: Relationship) -> bool:
        """Whether a pull reads this relationship, or leaves it to the side that owns it."""
        if relationship not in self.relationships(entity):
            return False
        if relationship.stored is not Stored.RELATION:
            return relationship.stored is not Stored.DERIVED
        inverse = self.inverse_of(relationship)
        return inverse is None or (inverse.to_many and inverse.stored is not Stored.ARRAY)

    def property_fields(self, root: str) -> list[T.StructField]:
        """User columns of a root table, those of sub-entities included; all nullable."""
        fields: dict[str, T.StructField] = {}
        for name in self.family(root):
            for attribute in self[name].attributes:
                fields[attribute.name] = T.StructField(attribute.name, attribute.type, True)
            for relationship in self[name].relationships:
                if relationship.stored is Stored.POINTER:
                    fields[relationship.name] = T.StructField(relationship.name, REFERENCE, True)
                elif relationship.stored is Stored.ARRAY:
                    fields[relationship.name] = T.StructField(relationship.name, T.ArrayType(REFERENCE), True)
        return list(fields.values())

    def local_schema(self, root: str) -> T.StructType:
        head = [T.StructField("uid", T.StringType(), False), T.StructField("entity", T.StringType(), False)]
        control = [T.StructField(name, dtype, nullable) for name, dtype, nullable, _ in LOCAL_CONTROL]
        return T.StructType(head + control + self.property_fields(root))

    def remote_schema(self, root: str) -> T.StructType:
        head = [T.StructField("uid", T.StringType(), False), T.StructField("entity", T.StringType(), False)]
        control = [
            T.StructField("status", T.ShortType(), False),
            T.StructField("updated_at", T.TimestampNTZType(), False),
        ]
        return T.StructType(head + control + self.property_fields(root))

    def root_column(self, entity: Column) -> Column:
        """The root's name for each row's entity name, null for names outside the model."""
        pairs = [F.lit(text) for name in self.names for text in (name, self.root_of(name))]
        return F.create_map(*pairs)[entity]


def relaxed(schema: T.StructType) -> T.StructType:
    """The schema with every column nullable, so that placeholders can be stored."""
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema.fields])


def with_control(df: DataFrame, entity: str | None = None) -> DataFrame:
    """Add the control columns that are missing, with their defaults."""
    missing = {
        name: F.lit(default).cast(dtype) for name, dtype, _, default in LOCAL_CONTROL if name not in df.columns
    }
    if entity is not None and "entity" not in df.columns:
        missing["entity"] = F.lit(entity)
    return df.withColumns(missing) if missing else df


def open_evolved(parts: Sequence[DataFrame], schema: T.StructType | None = None) -> DataFrame:
    """Read tables written under older models as one table of the newest: missing columns are null."""
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if schema is None:
        return merged
    return merged.select(
        *[
            (F.col(f.name) if f.name in merged.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def user_columns(columns: Iterable[str]) -> list[str]:
    """Columns that belong to the user: no key, no control."""
    reserved = {*KEY, *LOCAL_CONTROL_NAMES, *REMOTE_CONTROL_NAMES}
    return [c for c in columns if c not in reserved]
