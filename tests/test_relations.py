from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import functions as F

from ebbflow.operators import joins, relations
from tests.library import by_uid, local, ref, uids


def edge_table(spark, *pairs):
    return spark.createDataFrame([(s, "Author", d) for s, d in pairs], "src_uid string, dst_entity string, dst_uid string")


def test_to_one_keeps_populated_targets_only(spark):
    pages = local(
        spark,
        "Page",
        {"uid": "p1", "book": ref("Book", "b1")},
        {"uid": "p2", "book": ref("Book", "b2")},
        {"uid": "p3", "book": ref("Book", "missing")},
        {"uid": "p4"},
        {"uid": "p5", "book": ref("Book", "e1")},
    )
    books = local(spark, "Book", {"uid": "b1"}, {"uid": "b2", "status": 3}, {"uid": "e1", "entity": "EBook"})
    found = by_uid(relations.resolve_to_one(pages, "book", books))
    assert {u: r["book"] and (r["book"]["entity"], r["book"]["uid"]) for u, r in found.items()} == {
        "p1": ("Book", "b1"),
        "p2": None,
        "p3": None,
        "p4": None,
        "p5": ("EBook", "e1"),
    }


def test_to_many_groups_by_the_targets_entity(spark):
    books = local(
        spark,
        "Book",
        {"uid": "b1", "author": ref("Author", "a1")},
        {"uid": "e1", "entity": "EBook", "author": ref("Author", "a1")},
        {"uid": "b2", "status": 1, "author": ref("Author", "a1")},
        {"uid": "b3", "author": ref("Author", "a2")},
    )
    authors = local(spark, "Author", {"uid": "a1"}, {"uid": "a2"}, {"uid": "a3"})
    live = relations.resolve_to_many(relations.inverse_of_to_one(books, "author"), books)
    maps = {r["uid"]: r["members"] for r in relations.member_maps(authors, live).collect()}
    assert maps == {"a1": {"Book": ["b1"], "EBook": ["e1"]}, "a2": {"Book": ["b3"]}, "a3": {}}


def test_large_groups_are_paged_and_whole(spark):
    pairs = [("big", f"d{i}") for i in range(700)] + [("small", f"d{i}") for i in range(9)] + [("edge", f"d{i}") for i in range(10)]
    pages = relations.member_pages(edge_table(spark, *pairs), page_size=10).collect()
    for source, size in (("big", 700), ("small", 9), ("edge", 10)):
        mine = [r for r in pages if r["src_uid"] == source]
        assert {r["n"] for r in mine} == {size}
        assert sorted(m for r in mine for m in r["members"]) == sorted(d for s, d in pairs if s == source)
    assert [r["page"] for r in pages if r["src_uid"] == "small"] == [""]
    assert [r["page"] for r in pages if r["src_uid"] == "edge"] == [""]
    assert len([r for r in pages if r["src_uid"] == "big"]) > 100
    assert max(len(r["members"]) for r in pages) < 30


def test_salted_join_equals_the_plain_one(spark):
    rows = spark.range(3000).select(
        F.col("id").alias("row"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id") % 97).alias("k"),
    )
    targets = spark.range(0, 90, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    for how in ("left", "inner", "left_semi", "left_anti"):
        salted = joins.join_unique(rows, targets, "k", how, "row", hot_rows=500, force_salting=True)
        plain = rows.join(targets, "k", how)
        columns = plain.columns
        assert Counter(map(tuple, salted.select(columns).collect())) == Counter(map(tuple, plain.collect())), how
    found = joins.heavy_keys(rows, ["k"], hot_rows=500).collect()
    assert [r["_item"] for r in found] == [spark.sql("SELECT xxhash64(0L)").first()[0]]
    assert found[0]["_salts"] == math.ceil(1000 / 2960 * joins.pieces(rows))  # 40 rows have no key


def test_no_task_gets_more_than_twice_the_mean(spark):
    """One key holds a third of the rows, another a tenth; a twentieth has no key."""
    ids = F.col("id")
    key = F.when(ids % 3 == 0, F.lit(-1)).when(ids % 10 == 1, F.lit(-2)).when(ids % 20 == 2, F.lit(None)).otherwise(ids)
    rows = spark.range(240_000).select(ids.alias("row"), key.alias("k"))
    targets = spark.range(-2, 240_000).select(ids.alias("k"), (ids * 10).alias("v"))
    settings = {
        "spark.sql.shuffle.partitions": "24",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        for how in ("left", "left_semi"):
            joined = joins.join_unique(rows, targets, "k", how, "row", hot_rows=1000)
            sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
            assert sum(sizes) == (240_000 if how == "left" else rows.filter("k is not null").count())
            assert len(sizes) == 24 and max(sizes) <= 2 * sum(sizes) / 24
            assert "_salt" in joined._jdf.queryExecution().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_side_by_side_gives_the_same_in_both_ways(spark):
    book, key = F.lit("Book").alias("entity"), F.col("id")
    table = spark.range(200).select(book, F.concat(F.lit("b"), key).alias("uid"), key.alias("v"))
    uid = F.when(key == 0, "b2").otherwise("x").alias("uid")
    batch = spark.range(2).select(book, uid, (key * 10 + 20).alias("v"))
    columns = ["entity", "uid", "v", "_new_v", "_old", "_new"]
    expected = {("Book", f"b{i}", i, 20 if i == 2 else None, True, i == 2) for i in range(200)}
    expected.add(("Book", "x", None, 30, False, True))
    assert joins.is_small_beside(batch, table) and not joins.is_small_beside(table, batch)
    small = joins.side_by_side(table, batch, ("entity", "uid"))
    assert "FullOuter" not in small._jdf.queryExecution().optimizedPlan().toString()
    assert set(map(tuple, small.select(columns).collect())) == expected
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = joins.side_by_side(table, batch, ("entity", "uid"))
        assert "FullOuter" in large._jdf.queryExecution().optimizedPlan().toString()
        assert set(map(tuple, large.select(columns).collect())) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_inverses_and_counts(spark):
    magazines = local(
        spark,
        "Magazine",
        {"uid": "m1", "authors": [ref("Author", "a1"), None, ref("Author", "a2")]},
        {"uid": "m2", "authors": [ref("Author", "a1")]},
        {"uid": "m3", "authors": None},
    )
    inverse = relations.inverse_of_array(magazines, "authors")
    assert sorted((r["src_uid"], r["dst_uid"]) for r in inverse.collect()) == [("a1", "m1"), ("a1", "m2"), ("a2", "m1")]
    authors = local(spark, "Author", {"uid": "a1"}, {"uid": "a2"}, {"uid": "a3"})
    counts = relations.relationship_count(authors, inverse)
    assert {r["uid"]: r["n"] for r in counts.collect()} == {"a1": 2, "a2": 1, "a3": 0}


def test_edges_are_replaced_whole(spark):
    edges = edge_table(spark, ("s1", "a"), ("s1", "b"), ("s2", "a"), ("s3", "c"))
    new = edge_table(spark, ("s1", "z"))
    sources = spark.createDataFrame([("s1",), ("s3",)], "src_uid string")
    got = relations.replace_edges(edges, new, sources)
    assert sorted((r["src_uid"], r["dst_uid"]) for r in got.collect()) == [("s1", "z"), ("s2", "a")]


def test_encoded_arrays_decode_to_the_same_edges(spark):
    edges = edge_table(spark, *[("s1", f"a{i}") for i in range(40)], ("s2", "a1"))
    stored = relations.encode_array(edges, page_size=8)
    rows = stored.select(F.col("src_uid").alias("uid"), F.lit("Magazine").alias("entity"), "refs")
    back = relations.edges_of_array(rows, "refs").select("src_uid", "dst_entity", "dst_uid")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, edges.collect()))


def test_related_columns_beside_the_row(spark):
    books = local(spark, "Book", {"uid": "b1", "author": ref("Author", "a1")}, {"uid": "b2"})
    authors = local(spark, "Author", {"uid": "a1", "name": "Ann"})
    found = by_uid(relations.scan_with_related(books, "author", authors, ["name"]))
    assert found["b1"]["author_name"] == "Ann" and found["b2"]["author_name"] is None


def test_references_to_gone_rows(spark):
    gone = spark.createDataFrame([("a1",)], "uid string")
    books = local(spark, "Book", {"uid": "b1", "author": ref("Author", "a1")}, {"uid": "b2", "author": ref("Author", "a2")})
    cleared = by_uid(relations.clear_references(books, "author", gone))
    assert cleared["b1"]["author"] is None and cleared["b1"]["_cleared"]
    assert cleared["b2"]["author"] == ref("Author", "a2") and not cleared["b2"]["_cleared"]
    magazines = local(
        spark, "Magazine", {"uid": "m1", "authors": [ref("Author", "a1"), ref("Author", "a2")]}, {"uid": "m2", "authors": []}
    )
    left = by_uid(relations.remove_from_arrays(magazines, "authors", gone))
    assert left["m1"]["authors"] == [ref("Author", "a2")] and left["m1"]["_cleared"]
    assert left["m2"]["authors"] == [] and not left["m2"]["_cleared"]
    assert sorted(uids(magazines)) == ["m1", "m2"]
