"""The library model of the tests, and builders of small tables."""

from __future__ import annotations

from datetime import datetime, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ebbflow.model import Attribute, DeleteRule, Entity, EntityModel, Relationship, Stored

TEXT, TIME, BYTES = T.StringType(), T.TimestampNTZType(), T.BinaryType()

FIRST = EntityModel(
    (
        Entity(
            "Author",
            attributes=(Attribute("name", TEXT),),
            relationships=(Relationship("books", "Book", True, "author", DeleteRule.CASCADE, Stored.DERIVED),),
        ),
        Entity(
            "Book",
            attributes=(Attribute("name", TEXT), Attribute("picture", BYTES)),
            relationships=(
                Relationship("author", "Author", inverse="books"),
                Relationship("pages", "Page", True, "book", DeleteRule.CASCADE, Stored.DERIVED),
            ),
        ),
        Entity("Page", relationships=(Relationship("book", "Book", inverse="pages"),)),
    )
)

LIBRARY = EntityModel(
    (
        Entity(
            "Author",
            attributes=(Attribute("name", TEXT), Attribute("photo", BYTES)),
            relationships=(
                Relationship("books", "Book", True, "author", DeleteRule.CASCADE, Stored.DERIVED),
                Relationship("magazines", "Magazine", True, "authors", stored=Stored.DERIVED),
            ),
        ),
        Entity(
            "Book",
            attributes=(Attribute("name", TEXT), Attribute("createdDate", TIME), Attribute("picture", BYTES)),
            relationships=(
                Relationship("author", "Author", inverse="books"),
                Relationship("pages", "Page", True, "book", DeleteRule.CASCADE, Stored.DERIVED),
            ),
        ),
        Entity("EBook", parent="Book", attributes=(Attribute("format", TEXT),)),
        Entity(
            "Magazine",
            attributes=(Attribute("name", TEXT),),
            relationships=(
                Relationship("authors", "Author", True, "magazines", stored=Stored.ARRAY),
                Relationship("pages", "Page", True, "magazine", stored=Stored.DERIVED),
                Relationship("publisher", "Publisher", inverse="magazines"),
            ),
        ),
        Entity(
            "Page",
            relationships=(
                Relationship("book", "Book", inverse="pages"),
                Relationship("magazine", "Magazine", inverse="pages"),
            ),
        ),
        Entity(
            "Publisher",
            attributes=(Attribute("name", TEXT),),
            relationships=(
                Relationship("magazines", "Magazine", True, "publisher", stored=Stored.DERIVED),
                Relationship("partners", "Publisher", True, "partners", stored=Stored.RELATION),
            ),
        ),
    )
)

T0 = datetime(2014, 6, 1, 10, 0, 0, 123456)


def at(seconds: float) -> datetime:
    return T0 + timedelta(seconds=seconds)


def ref(entity: str, uid: str) -> dict:
    return {"entity": entity, "uid": uid}


def table(spark: SparkSession, schema: T.StructType, rows: list[dict]) -> DataFrame:
    """A table by way of Arrow, which Spark keeps as rows of the plan instead of asking Python for them."""
    rows = [{name: row.get(name) for name in schema.names} for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=to_arrow_schema(schema)), schema)


def local(spark: SparkSession, root: str, *rows: dict) -> DataFrame:
    """Local rows; what a row leaves out is a clean, populated row the remote knows."""
    schema = LIBRARY.local_schema(root)
    base = {"entity": root, "status": 2, "last_modified": at(0), "is_dirty": False, "created_remotely": True}
    return table(spark, schema, [{**base, **row} for row in rows])


def made_here(**row) -> dict:
    """A row created locally and not pushed yet."""
    return {"last_modified": None, "is_dirty": True, "created_remotely": False, **row}


def remote(spark: SparkSession, root: str, *rows: dict) -> DataFrame:
    schema = LIBRARY.remote_schema(root)
    base = {"entity": root, "status": 2, "updated_at": at(0)}
    return table(spark, schema, [{**base, **row} for row in rows])


def empty_tables(spark: SparkSession) -> tuple[dict, dict]:
    roots = LIBRARY.roots
    return {r: local(spark, r) for r in roots}, {r: remote(spark, r) for r in roots}


def by_uid(df: DataFrame) -> dict[str, dict]:
    rows = [row.asDict(recursive=True) for row in df.collect()]
    found = {row["uid"]: row for row in rows}
    assert len(found) == len(rows), "a uid occurs twice"
    return found


def uids(df: DataFrame) -> list[str]:
    return [row["uid"] for row in df.select("uid").collect()]
