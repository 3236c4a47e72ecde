from __future__ import annotations

import itertools

import pytest
from pyspark.sql import functions as F

from ebbflow.functions.predicates import any_of_array, compare, refers_to, refers_to_any
from ebbflow.operators import fetch
from ebbflow.operators.fetch import Order
from ebbflow.operators.relations import edges_of_array, inverse_of_array
from ebbflow.sources.scope import owned, owner_path, write_owned
from tests.library import LIBRARY, at, by_uid, local, made_here, ref, uids


def test_visibility_truth_table(spark):
    rows, expected = [], set()
    for status, modified, remotely in itertools.product((1, 2, 3), (None, at(0)), (True, False)):
        uid = f"{status}-{modified is not None}-{remotely}"
        rows.append({"uid": uid, "status": status, "last_modified": modified, "created_remotely": remotely})
        if status == 2 and (modified is not None or not remotely):
            expected.add(uid)
    assert set(uids(fetch.visible(local(spark, "Book", *rows)))) == expected


def test_subentities_come_along(spark):
    books = local(spark, "Book", {"uid": "b1"}, {"uid": "b2"}, {"uid": "e1", "entity": "EBook", "format": "PDF"})
    found = by_uid(fetch.fetch_objects(books, LIBRARY, "Book"))
    assert set(found) == {"b1", "b2", "e1"} and found["e1"]["format"] == "PDF"
    assert set(uids(fetch.select_rows(books, LIBRARY, "Book", subentities=False))) == {"b1", "b2"}
    assert uids(fetch.select_rows(books, LIBRARY, "EBook")) == ["e1"]


def test_public_rows_hide_control_columns(spark):
    columns = fetch.fetch_objects(local(spark, "Book", {"uid": "b1"}), LIBRARY, "Book").columns
    assert {"uid", "entity", "name"} <= set(columns)
    assert not {"status", "is_dirty", "last_modified", "created_remotely"} & set(columns)


@pytest.mark.parametrize("limit", [None, 10])
def test_references_of_a_fetch_are_resolved(spark, limit):
    books = local(spark, "Book", {"uid": "b1", "author": ref("Author", "a1")}, {"uid": "b2", "author": ref("Author", "a2")})
    authors = local(spark, "Author", {"uid": "a1"}, {"uid": "a2", "status": 1})
    found = by_uid(fetch.fetch_objects(books, LIBRARY, "Book", order=[Order("uid")], limit=limit, targets={"author": authors}))
    assert found["b1"]["author"] == ref("Author", "a1") and found["b2"]["author"] is None


@pytest.mark.parametrize("limit", [None, 10])
def test_members_of_a_fetch_are_populated_targets(spark, limit):
    rows = local(spark, "Author", {"uid": "a1"}, {"uid": "a2"}, {"uid": "a3"}).select("uid", "entity")
    pairs = [("a1", f"m{i}") for i in (1, 1, 2, 3)] + [("a1", "gone"), ("a2", "gone"), ("a9", "m1"), (None, "m1"), ("a1", None)]
    edges = spark.createDataFrame([(s, "Magazine", d) for s, d in pairs], "src_uid string, dst_entity string, dst_uid string")
    targets = local(spark, "Magazine", {"uid": "m1"}, {"uid": "m2", "status": 1}, {"uid": "m3"})
    found = fetch.fetch_members(rows.unionByName(rows), edges, targets, limit).collect()
    assert sorted((r["uid"], r["members"]) for r in found if r["members"]) == [("a1", {"Magazine": ["m1", "m3"]})]
    assert sorted(r["uid"] for r in found) == ["a1", "a2", "a3"]


def test_a_large_to_many_of_a_fetch_comes_in_pages(spark):
    rows = local(spark, "Author", {"uid": "a1"}).select("uid", "entity")
    edges = spark.range(300).selectExpr("'a1' AS src_uid", "'Magazine' AS dst_entity", "'m' || id AS dst_uid")
    targets = local(spark, "Magazine", *[{"uid": f"m{i}"} for i in range(250)])
    found = fetch.fetch_members(rows, edges, targets, page_size=20).collect()
    assert len(found) > 5 and sorted(x for r in found for x in r["members"]["Magazine"]) == sorted(f"m{i}" for i in range(250))


def test_sort_limit_offset(spark):
    authors = local(spark, "Author", *[{"uid": f"a{i}", "name": f"Author#{i}"} for i in (12, 10, 13, 11)])
    down = [Order("name", descending=True)]
    assert uids(fetch.fetch_objects(authors, LIBRARY, "Author", order=down)) == ["a13", "a12", "a11", "a10"]
    for offset, uid in enumerate(["a10", "a11", "a12", "a13"]):
        page = fetch.fetch_objects(authors, LIBRARY, "Author", order=[Order("name")], limit=1, offset=offset)
        assert uids(page) == [uid]


def test_nulls_sort_first_ascending(spark):
    authors = local(spark, "Author", {"uid": "a1", "name": "x"}, {"uid": "a2", "name": None})
    assert uids(fetch.cut(authors, [Order("name")], None)) == ["a2", "a1"]
    assert uids(fetch.cut(authors, [Order("name", True)], None)) == ["a1", "a2"]


def test_count_ids_and_dictionaries(spark):
    authors = local(spark, "Author", *[{"uid": f"a{i}", "name": "ab"[i % 2]} for i in range(5)], {"uid": "x", "status": 3})
    assert fetch.fetch_count(authors, LIBRARY, "Author").head()["n"] == 5
    assert fetch.fetch_count(authors, LIBRARY, "Author", F.col("name") == "a").head()["n"] == 3
    assert fetch.fetch_ids(authors, LIBRARY, "Author", limit=2).columns == ["entity", "uid"]
    assert sorted(r[0] for r in fetch.fetch_dictionaries(authors, LIBRARY, "Author", ["name"], distinct=True).collect()) == ["a", "b"]
    grouped = fetch.fetch_dictionaries(
        authors, LIBRARY, "Author", ["name"], aggregates=[F.count(F.lit(1)).alias("n")], having=F.col("n") > 2
    )
    assert [tuple(r) for r in grouped.collect()] == [("a", 3)]


def test_positions_are_those_of_the_whole_sort(spark):
    rows = [{"uid": f"a{i:03}", "name": f"n{i % 7}" if i % 5 else None} for i in range(300)]
    table = local(spark, "Author", *rows).repartition(5)
    got = {r["uid"]: r["position"] for r in fetch.with_position(table, [Order("name", True)]).collect()}
    names = {r["uid"]: r["name"] for r in rows}
    order = sorted(names, key=lambda u: (names[u] is None, [-ord(c) for c in names[u] or ""], u))
    assert [got[u] for u in order] == list(range(1, 301))


def test_lookup_asks_the_status_only(spark):
    rows = local(spark, "Book", {"uid": "b1", "last_modified": None}, {"uid": "b2", "status": 3}, {"uid": "b3"})
    keys = spark.createDataFrame([("b1",), ("b2",)], "uid string")
    assert uids(fetch.lookup(rows, keys)) == ["b1"]
    assert uids(fetch.lookup_one(rows, "b1")) == ["b1"] and uids(fetch.lookup_one(rows, "b2")) == []
    assert uids(fetch.visible(rows)) == ["b3"]


def test_predicates_on_objects(spark):
    books = local(
        spark,
        "Book",
        {"uid": "b1", "author": ref("Author", "a1")},
        {"uid": "b2", "author": ref("Author", "a2")},
        {"uid": "b3"},
    )
    assert uids(books.filter(refers_to("author", "a1"))) == ["b1"]
    assert uids(books.filter(refers_to("author", None))) == []
    assert uids(books.filter(refers_to_any("author", ["a2", None]))) == ["b2"]
    assert uids(books.filter(refers_to_any("author", [None]))) == []
    objects = spark.createDataFrame([("a1",), ("a1",), ("a9",)], "uid string")
    assert uids(fetch.in_objects(books, "author", objects)) == ["b1"]


def test_any_member_in_objects(spark):
    authors = local(spark, "Author", *[made_here(uid=f"a{i}") for i in (1, 2, 3)])
    magazines = local(
        spark,
        "Magazine",
        {"uid": "m1", "authors": [ref("Author", "a1"), ref("Author", "a2")], "publisher": ref("Publisher", "p1")},
        {"uid": "m2", "authors": [ref("Author", "a2")], "publisher": ref("Publisher", "p1")},
        {"uid": "m3", "authors": [ref("Author", "a3")], "publisher": ref("Publisher", "p2")},
    )
    of_first = magazines.filter(refers_to("publisher", "p1"))
    found = fetch.any_in_objects(authors, inverse_of_array(magazines, "authors"), of_first)
    assert sorted(uids(found)) == ["a1", "a2"]
    assert sorted(uids(magazines.filter(any_of_array("authors", ["a2", None])))) == ["m1", "m2"]
    assert edges_of_array(magazines, "authors").count() == 4


@pytest.mark.parametrize(
    ("operator", "right", "options", "expected"),
    [
        ("==", "élan", "", ["a1"]),
        ("==", "ELAN", "cd", ["a1", "a2"]),
        ("==", "ÉLAN", "c", ["a1"]),
        ("==", "elan", "d", ["a1", "a2"]),
        ("!=", "élan", "", ["a2", "a3", "a4"]),
        ("==", None, "", ["a5"]),
        ("!=", None, "", ["a1", "a2", "a3", "a4"]),
        ("CONTAINS", "AR", "c", ["a3"]),
        ("BEGINSWITH", "e", "d", ["a1", "a2"]),
        ("ENDSWITH", "_%", "", ["a4"]),
        ("LIKE", "?_*", "", ["a4"]),
        ("LIKE", "*a*", "", ["a1", "a2", "a3"]),
        ("MATCHES", "[a-z]{5}", "", ["a3"]),
        ("LIKE", "É*N", "cd", ["a1", "a2"]),
        ("MATCHES", "CH.*", "c", ["a3"]),
        ("IN", ["elan", "chart"], "", ["a2", "a3"]),
        ("BETWEEN", ("a", "d"), "", ["a3"]),
        ("<", "d", "", ["a3", "a4"]),
        (">=", "elan", "", ["a1", "a2"]),
    ],
)
def test_comparisons(spark, operator, right, options, expected):
    names = {"a1": "élan", "a2": "elan", "a3": "chart", "a4": "1_%", "a5": None}
    table = local(spark, "Author", *[{"uid": u, "name": n} for u, n in names.items()])
    assert sorted(uids(table.filter(compare(F.col("name"), operator, right, options)))) == expected


def test_unknown_comparison():
    with pytest.raises(ValueError):
        compare(F.lit(1), "NEAR", 2)


def test_owners_do_not_see_each_other(spark, tmp_path):
    rows = local(spark, "Author", {"uid": "a1", "name": "same"}, {"uid": "a2", "name": "same"})
    rows = rows.withColumn("owner", F.when(F.col("uid") == "a1", "ann").otherwise("bob"))
    assert uids(owned(rows, "ann")) == ["a1"]
    write_owned(rows).parquet(str(tmp_path / "authors"))
    stored = owned(spark.read.parquet(str(tmp_path / "authors")), "bob")
    assert uids(stored) == ["a2"]
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(owner" in plan
    assert owner_path("/x/", "ann") == "/x/owner=ann"
    with pytest.raises(ValueError):
        owner_path("/x", "../bob")
