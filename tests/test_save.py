from __future__ import annotations

import pytest

from ebbflow.model import Entity, EntityModel, Relationship, Stored
from ebbflow.model import DeleteRule
from ebbflow.operators import save
from tests.library import LIBRARY, at, by_uid, local, made_here, ref, table, uids


def batch(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def test_insert_adds_rows_and_fills_placeholders(spark):
    books = local(
        spark,
        "Book",
        {"uid": "b1", "status": 1, "last_modified": at(3), "created_remotely": True},
        {"uid": "b2", "name": "untouched"},
    )
    new = batch(spark, "entity string, uid string, name string", ("Book", "b1", "Filled"), ("EBook", "e1", "New"))
    found = by_uid(save.insert_rows(books, new))
    for uid, name, modified in (("b1", "Filled", at(3)), ("e1", "New", None)):
        row = found[uid]
        assert (row["name"], row["status"], row["is_dirty"], row["created_remotely"]) == (name, 2, True, False)
        assert row["last_modified"] == modified
    assert found["e1"]["entity"] == "EBook"
    assert found["b2"]["is_dirty"] is False and found["b2"]["name"] == "untouched"


def test_insert_honours_absent_values(spark):
    books = local(spark, "Book", {"uid": "b1", "status": 1, "name": "old", "format": "PDF"})
    new = batch(
        spark,
        "entity string, uid string, name string, format string, present array<string>",
        ("Book", "b1", None, None, ["name"]),
        ("Book", "b2", "x", "y", ["name"]),
    )
    found = by_uid(save.insert_rows(books, new))
    assert found["b1"]["name"] is None and found["b1"]["format"] == "PDF"
    assert found["b2"]["name"] == "x"


def test_partial_update_keeps_clears_and_sets(spark):
    books = local(spark, "Book", *[{"uid": f"b{i}", "name": "old", "format": "PDF", "status": 3 if i == 3 else 2} for i in (1, 2, 3, 4)])
    new = batch(
        spark,
        "entity string, uid string, name string, format string, present array<string>",
        ("Book", "b1", "new", None, ["name"]),
        ("Book", "b2", None, None, ["name", "format"]),
        ("Book", "b3", "new", "EPUB", ["format"]),
        ("Book", "b9", "nobody", None, ["name"]),
    )
    after = save.update_rows(books, new)
    assert after.columns == books.columns
    found = by_uid(after)
    values = {u: (r["name"], r["format"], r["is_dirty"], r["status"]) for u, r in found.items()}
    assert values == {
        "b1": ("new", "PDF", True, 2),
        "b2": (None, None, True, 2),
        "b3": ("old", "EPUB", True, 3),
        "b4": ("old", "PDF", False, 2),
    }


def test_soft_delete_keeps_values(spark):
    books = local(spark, "Book", {"uid": "b1", "name": "x"}, {"uid": "b2"})
    found = by_uid(save.soft_delete(books, spark.createDataFrame([("b1",)], "uid string")))
    assert (found["b1"]["status"], found["b1"]["is_dirty"], found["b1"]["name"]) == (3, True, "x")
    assert (found["b2"]["status"], found["b2"]["is_dirty"]) == (2, False)


@pytest.mark.parametrize("remotely", [True, False])
def test_placeholders_for_unknown_references(spark, remotely):
    books = local(spark, "Book", *[{"uid": f"b{i}", "author": ref("Author", f"a{i % 2}")} for i in range(6)], {"uid": "b9"})
    magazines = local(spark, "Magazine", {"uid": "m1", "authors": [ref("Author", "a7"), ref("Author", "a1")]})
    refs = save.references_of(books, LIBRARY.relationships("Book")).unionByName(
        save.references_of(magazines, [LIBRARY.relationship("Magazine", "authors")])
    )
    made = by_uid(save.placeholders(refs, local(spark, "Author", {"uid": "a0"}), remotely))
    assert set(made) == {"a1", "a7"}
    assert made["a1"] == {
        "entity": "Author",
        "uid": "a1",
        "status": 1,
        "last_modified": None,
        "is_dirty": False,
        "created_remotely": remotely,
    }


def test_references_of_rows_without_any(spark):
    assert save.references_of(local(spark, "Author", {"uid": "a1"}), LIBRARY.relationships("Author")) is None


def library_tables(spark):
    return {
        "Author": local(spark, "Author", {"uid": "a1"}, {"uid": "a2"}),
        "Book": local(
            spark,
            "Book",
            {"uid": "b1", "author": ref("Author", "a1")},
            {"uid": "e1", "entity": "EBook", "author": ref("Author", "a1")},
            {"uid": "b2", "author": ref("Author", "a2")},
        ),
        "Magazine": local(
            spark,
            "Magazine",
            {"uid": "m1", "authors": [ref("Author", "a1"), ref("Author", "a2")]},
            {"uid": "m2", "authors": [ref("Author", "a2")]},
        ),
        "Page": local(
            spark,
            "Page",
            {"uid": "p1", "book": ref("Book", "b1")},
            {"uid": "p2", "book": ref("Book", "b2"), "magazine": ref("Magazine", "m1")},
        ),
    }


def test_cascade_reaches_every_level(spark):
    tables = library_tables(spark)
    keys = spark.createDataFrame([("a1",)], "uid string")
    found = save.gone_keys(LIBRARY, tables, {"Author": keys})
    assert {root: sorted(uids(rows)) for root, rows in found.items()} == {
        "Author": ["a1"],
        "Book": ["b1", "e1"],
        "Page": ["p1"],
    }
    after = {root: by_uid(t) for root, t in save.delete_rows(LIBRARY, tables, "Author", keys).tables.items()}
    gone = [u for rows in after.values() for u, r in rows.items() if r["status"] == 3]
    assert sorted(gone) == ["a1", "b1", "e1", "p1"]
    assert after["Book"]["b1"]["author"] == ref("Author", "a1")
    assert after["Magazine"]["m1"]["authors"] == [ref("Author", "a2")] and after["Magazine"]["m1"]["is_dirty"]
    assert not after["Magazine"]["m2"]["is_dirty"] and not after["Book"]["b2"]["is_dirty"]


def test_a_deleted_book_lets_go_of_its_author(spark):
    tables = library_tables(spark)
    after = save.delete_rows(LIBRARY, tables, "Book", spark.createDataFrame([("b2",)], "uid string")).tables
    books, authors, pages = by_uid(after["Book"]), by_uid(after["Author"]), by_uid(after["Page"])
    assert books["b2"]["status"] == 3 and books["b2"]["author"] is None
    assert books["b1"]["status"] == 2 and books["b1"]["author"] == ref("Author", "a1")
    assert all(r["status"] == 2 for r in authors.values())
    assert pages["p2"]["status"] == 3 and pages["p2"]["magazine"] is None


def test_nullify_clears_references_of_others(spark):
    tables = library_tables(spark)
    after = save.delete_rows(LIBRARY, tables, "Magazine", spark.createDataFrame([("m1",)], "uid string")).tables
    pages = by_uid(after["Page"])
    assert (pages["p2"]["magazine"], pages["p2"]["status"], pages["p2"]["is_dirty"]) == (None, 2, True)
    assert pages["p2"]["book"] == ref("Book", "b2") and not pages["p1"]["is_dirty"]


def test_removal_takes_rows_away_and_leaves_others_clean(spark):
    tables = library_tables(spark)
    after = save.delete_rows(LIBRARY, tables, "Author", spark.createDataFrame([("a1",)], "uid string"), remove=True).tables
    assert sorted(uids(after["Author"])) == ["a2"] and sorted(uids(after["Book"])) == ["b2"]
    assert sorted(uids(after["Page"])) == ["p2"]
    magazines = by_uid(after["Magazine"])
    assert magazines["m1"]["authors"] == [ref("Author", "a2")] and not magazines["m1"]["is_dirty"]


GRAPH = EntityModel(
    (
        Entity(
            "Node",
            relationships=(
                Relationship("children", "Node", True, "parent", DeleteRule.CASCADE, Stored.DERIVED),
                Relationship("parent", "Node", inverse="children"),
                Relationship("links", "Node", True, "linked", DeleteRule.CASCADE, Stored.RELATION),
                Relationship("linked", "Node", True, "links", stored=Stored.DERIVED),
                Relationship("owns", "Leaf", True, "owners", DeleteRule.CASCADE, Stored.ARRAY),
            ),
        ),
        Entity(
            "Leaf",
            relationships=(
                Relationship("owners", "Node", True, "owns", stored=Stored.DERIVED),
                Relationship("cover", "Cover", inverse="leaf", delete_rule=DeleteRule.CASCADE),
            ),
        ),
        Entity(
            "Cover",
            relationships=(
                Relationship("leaf", "Leaf", inverse="cover"),
                Relationship("tags", "Tag", True, "covers", DeleteRule.CASCADE, Stored.DERIVED),
            ),
        ),
        Entity("Tag", relationships=(Relationship("covers", "Cover", True, "tags", stored=Stored.RELATION),)),
    )
)


def graph_rows(spark, entity, *rows):
    base = {"entity": entity, "status": 2, "is_dirty": False, "created_remotely": True}
    return table(spark, GRAPH.local_schema(entity), [{**base, **r} for r in rows])


def graph_edges(spark, entity, *pairs):
    return spark.createDataFrame([(a, entity, b) for a, b in pairs], "src_uid string, dst_entity string, dst_uid string")


def graph(spark):
    to = lambda uid, entity="Node": ref(entity, uid)
    tables = {
        "Node": graph_rows(
            spark,
            "Node",
            {"uid": "n0"},
            {"uid": "n1", "parent": to("n0"), "owns": [to("l1", "Leaf"), to("ghost", "Leaf"), None]},
            {"uid": "n2", "parent": to("n1")},
            {"uid": "n3"},  # n2 -> n3 -> n4 -> n2 by links
            {"uid": "n4", "owns": [to("l2", "Leaf")]},
            {"uid": "n5", "parent": to("n5")},
            {"uid": "n6", "owns": [to("l3", "Leaf"), to("l1", "Leaf")]},
        ),
        "Leaf": graph_rows(spark, "Leaf", {"uid": "l1", "cover": to("c1", "Cover")}, {"uid": "l2"}, {"uid": "l3", "cover": to("c2", "Cover")}),
        "Cover": graph_rows(spark, "Cover", {"uid": "c1"}, {"uid": "c2"}),
        "Tag": graph_rows(spark, "Tag", {"uid": "t1"}, {"uid": "t2"}, {"uid": "n0"}),
    }
    edges = {
        "Node.links": graph_edges(spark, "Node", ("n2", "n3"), ("n3", "n4"), ("n4", "n2"), ("n4", "nowhere"), ("n6", "n3"), ("n6", "n5")),
        "Tag.covers": graph_edges(spark, "Cover", ("t1", "c1"), ("t2", "c2"), ("t2", "c1")),
    }
    return tables, edges


def one(spark, *keys):
    return spark.createDataFrame([(k,) for k in keys], "uid string")


def test_cascades_over_any_stored_form_and_in_circles(spark):
    tables, edges = graph(spark)
    found = save.gone_keys(GRAPH, tables, {"Node": one(spark, "n0", "n0")}, edges)
    assert {root: sorted(uids(rows)) for root, rows in found.items()} == {
        "Node": ["n0", "n1", "n2", "n3", "n4"],
        "Leaf": ["l1", "l2"],
        "Cover": ["c1"],
        "Tag": ["t1", "t2"],
    }
    itself = save.gone_keys(GRAPH, tables, {"Node": one(spark, "n5")}, edges)
    assert {root: uids(rows) for root, rows in itself.items()} == {"Node": ["n5"]}


def test_deletes_over_edges_leave_no_edge_behind(spark):
    tables, edges = graph(spark)
    after = save.delete_rows(GRAPH, tables, "Node", one(spark, "n0"), edges=edges)
    assert [tuple(r) for r in after.edges["Node.links"].collect()] == [("n6", "Node", "n5")]
    assert after.edges["Tag.covers"].count() == 0
    nodes = by_uid(after.tables["Node"])
    assert {u for u, r in nodes.items() if r["status"] == 3} == {"n0", "n1", "n2", "n3", "n4"}
    assert nodes["n6"]["is_dirty"] and nodes["n6"]["owns"] == [ref("Leaf", "l3")] and not nodes["n5"]["is_dirty"]
    removed = save.delete_rows(GRAPH, tables, "Node", one(spark, "n0"), remove=True, edges=edges)
    assert sorted(uids(removed.tables["Node"])) == ["n5", "n6"] and not by_uid(removed.tables["Node"])["n6"]["is_dirty"]


def test_a_long_chain_goes_whole(spark):
    rows = [{"uid": f"n{i}", **({"parent": ref("Node", f"n{i - 1}")} if i else {})} for i in range(40)]
    tables = {"Node": graph_rows(spark, "Node", *rows)}
    found = save.gone_keys(GRAPH, tables, {"Node": one(spark, "n7")})
    assert sorted(uids(found["Node"])) == sorted(f"n{i}" for i in range(7, 40))


def test_a_batch_with_members(spark):
    tables, edges = graph(spark)
    given = save.Members(one(spark, "n6", "n5"), graph_edges(spark, "Node", ("n6", "n4"), ("n6", "fresh"), ("other", "n1")))
    after = save.save_batch(GRAPH, tables, deletes={"Cover": one(spark, "c2")}, edges=edges, members={"Node.links": given})
    links = sorted((r["src_uid"], r["dst_uid"]) for r in after.edges["Node.links"].collect())
    assert links == [("n2", "n3"), ("n3", "n4"), ("n4", "n2"), ("n4", "nowhere"), ("n6", "fresh"), ("n6", "n4")]
    nodes = by_uid(after.tables["Node"])
    assert (nodes["fresh"]["status"], nodes["fresh"]["created_remotely"]) == (1, False)
    assert {u for u, r in nodes.items() if r["is_dirty"]} == {"n5", "n6"}
    assert [(r["src_uid"], r["dst_uid"]) for r in after.edges["Tag.covers"].collect()] == [("t1", "c1")]
    assert {u: r["status"] for u, r in by_uid(after.tables["Tag"]).items()} == {"t1": 2, "t2": 3, "n0": 2}


def test_batch_sizes(spark):
    tables = library_tables(spark)
    sizes = {r["entity"]: r["n"] for r in save.batch_sizes(tables["Book"], tables["Page"]).collect()}
    assert sizes == {"Book": 2, "EBook": 1, "Page": 2}
    assert made_here(uid="x")["is_dirty"]


def test_a_whole_batch(spark):
    tables = library_tables(spark)
    books = "entity string, uid string, name string, author struct<entity:string,uid:string>"
    inserts = {"Book": batch(spark, books, ("Book", "b9", "New", ("Author", "a9")), ("EBook", "e9", "New", None))}
    updates = {"Author": batch(spark, "entity string, uid string, name string, present array<string>", ("Author", "a2", "Ann", ["name"]))}
    deletes = {"Book": spark.createDataFrame([("b1",)], "uid string")}
    after = {root: by_uid(t) for root, t in save.save(LIBRARY, tables, inserts, updates, deletes).items()}
    assert after["Book"]["b9"]["is_dirty"] and after["Book"]["e9"]["status"] == 2
    assert (after["Author"]["a9"]["status"], after["Author"]["a9"]["created_remotely"]) == (1, False)
    assert after["Author"]["a2"]["name"] == "Ann" and not after["Author"]["a1"]["is_dirty"]
    assert after["Book"]["b1"]["status"] == 3 and after["Page"]["p1"]["status"] == 3
    assert set(after["Author"]) == {"a1", "a2", "a9"}
