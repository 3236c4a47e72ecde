from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbflow.functions.uids import assign_uid
from ebbflow.model import Entity, EntityModel, Relationship, Stored, open_evolved, relaxed, with_control
from tests.library import FIRST, LIBRARY


def test_roots_and_families():
    assert LIBRARY.roots == ["Author", "Book", "Magazine", "Page", "Publisher"]
    assert LIBRARY.root_of("EBook") == "Book"
    assert LIBRARY.family("Book") == ["Book", "EBook"]
    assert [a.name for a in LIBRARY.attributes("EBook")] == ["name", "createdDate", "picture", "format"]


def test_a_model_is_checked():
    with pytest.raises(KeyError):
        EntityModel((Entity("A", parent="B"),))
    with pytest.raises(ValueError):
        EntityModel((Entity("A", parent="B"), Entity("B", parent="A")))
    with pytest.raises(ValueError):
        Relationship("many", "A", to_many=True)
    with pytest.raises(KeyError):
        EntityModel((Entity("A", relationships=(Relationship("b", "B"),)),))


def test_the_side_that_owns_a_relation_is_read():
    array = LIBRARY.relationship("Magazine", "authors")
    derived = LIBRARY.relationship("Author", "magazines")
    relation = LIBRARY.relationship("Publisher", "partners")
    assert LIBRARY.read_from_remote("Magazine", array)
    assert not LIBRARY.read_from_remote("Author", derived)
    assert LIBRARY.read_from_remote("Publisher", relation)
    assert not LIBRARY.read_from_remote("Author", relation)
    left = Relationship("rights", "Right", True, "lefts", stored=Stored.RELATION)
    for inverse, read in (
        (Relationship("lefts", "Left", True, "rights", stored=Stored.ARRAY), False),
        (Relationship("lefts", "Left", False, "rights"), False),
        (Relationship("lefts", "Left", True, "rights", stored=Stored.RELATION), True),
    ):
        model = EntityModel((Entity("Left", relationships=(left,)), Entity("Right", relationships=(inverse,))))
        assert model.read_from_remote("Left", left) is read


def test_control_columns_have_defaults(spark):
    rows = with_control(spark.createDataFrame([("b1", "x")], "uid string, name string"), "Book")
    row = rows.head().asDict()
    assert row == {
        "uid": "b1",
        "name": "x",
        "entity": "Book",
        "status": 1,
        "last_modified": None,
        "is_dirty": False,
        "created_remotely": False,
    }
    assert dict(rows.dtypes)["status"] == "smallint"
    kept = with_control(spark.createDataFrame([("b1", True)], "uid string, is_dirty boolean"), "Book").head()
    assert kept["is_dirty"] is True


def test_user_columns_can_be_null():
    schema = LIBRARY.local_schema("Book")
    assert all(schema[c].nullable for c in ("name", "format", "author"))
    assert not schema["status"].nullable
    assert all(f.nullable for f in relaxed(schema).fields)


def test_old_files_open_under_the_new_model(spark, tmp_path):
    old = spark.createDataFrame([("b1", "Book", "Old")], "uid string, entity string, name string")
    new = spark.createDataFrame([("b2", "EBook", "New", "PDF")], "uid string, entity string, name string, format string")
    merged = open_evolved([old, new], T.StructType(LIBRARY.local_schema("Book").fields))
    rows = {r["uid"]: r for r in merged.collect()}
    assert rows["b1"]["format"] is None and rows["b2"]["format"] == "PDF"
    assert rows["b1"]["createdDate"] is None
    assert set(FIRST.local_schema("Book").names) < set(merged.columns)


def test_root_column(spark):
    names = spark.createDataFrame([("EBook",), ("Page",), ("Nobody",)], "entity string")
    got = {r[0]: r[1] for r in names.select("entity", LIBRARY.root_column(F.col("entity"))).collect()}
    assert got == {"EBook": "Book", "Page": "Page", "Nobody": None}


def test_uids_are_kept_or_made(spark):
    rows = spark.createDataFrame([(1, "given"), (2, None), (3, None)], "key int, uid string")
    by_key = {r["key"]: r["uid"] for r in assign_uid(rows, ("key",), "Book").collect()}
    again = {r["key"]: r["uid"] for r in assign_uid(rows.repartition(3), ("key",), "Book").collect()}
    assert by_key == again and by_key[1] == "given" and len(set(by_key.values())) == 3
    random = assign_uid(rows)
    first, second = ({r["key"]: r["uid"] for r in random.collect()} for _ in range(2))
    assert first == second and len(first[2]) == 36 and first[2] != first[3]
