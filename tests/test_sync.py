from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ebbflow.model import Attribute, Entity, EntityModel, relaxed
from ebbflow.operators import fetch, push
from ebbflow.operators.pull import collect_watermarks
from ebbflow.operators.push import Policy
from ebbflow.operators.relations import inverse_of_array, inverse_of_to_one, member_maps, resolve_to_many
from ebbflow.operators.save import delete_rows
from ebbflow.operators.sync import SyncError, sync
from tests.library import LIBRARY, TEXT, at, by_uid, empty_tables, local, made_here, ref, remote, table, uids
from tests.rowwise import sync_rows

PUSH, NOW = at(1000), at(2000)


def run(here, there, **options):
    return sync(LIBRARY, here, there, **{"push_time": PUSH, "now": NOW, **options})


def log_of(result):
    return {(r["entity"], r["uid"]): r["change"] for r in result.change_log.collect()}


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("policy", list(Policy))
@pytest.mark.parametrize("full", [True, False])
def test_agrees_with_a_sync_row_by_row(spark, seed, policy, full):
    """Random tables; remote times are distinct per key, so the order of the rows does not matter."""
    pick = random.Random(seed)
    model = EntityModel((Entity("Author", attributes=(Attribute("name", TEXT),)), Entity("Poet", parent="Author")))
    here, there = {}, {}
    for number in range(400):
        uid, entity = f"u{number:03}", pick.choice(["Author", "Poet"])
        instant = at(pick.randrange(1, 40) + number / 1000)
        if pick.random() < 0.8:
            there[uid] = {"entity": entity, "status": pick.choice([1, 2, 2, 3]), "name": f"remote{number}", "updated_at": instant}
        if pick.random() < 0.8:
            known = uid in there and pick.random() < 0.8
            here[uid] = {
                "entity": entity,
                "status": pick.choice([1, 2, 2, 3]),
                "name": f"local{number}" if pick.random() < 0.9 else None,
                "last_modified": pick.choice([None, instant, instant, at(0)]) if known else None,
                "is_dirty": pick.random() < 0.5,
                "created_remotely": known or pick.random() < 0.2,
            }
            if not here[uid]["created_remotely"]:
                there.pop(uid, None)
    marks = {"Author": at(20)}
    expected = sync_rows(here, there, policy, PUSH, NOW, marks, full)

    schema = model.local_schema("Author")
    local_table = spark.createDataFrame([tuple({"uid": u, **r}[n] for n in schema.names) for u, r in here.items()], schema)
    schema = model.remote_schema("Author")
    remote_table = spark.createDataFrame([tuple({"uid": u, **r}[n] for n in schema.names) for u, r in there.items()], schema)
    result = sync(
        model,
        {"Author": local_table},
        {"Author": remote_table},
        policy=policy,
        push_time=PUSH,
        now=NOW,
        watermarks=marks,
        full=full,
        on_error="quarantine",
    )
    without_uid = lambda rows: {u: {k: v for k, v in r.items() if k != "uid"} for u, r in rows.items()}
    assert without_uid(by_uid(result.local["Author"])) == expected[0]
    assert without_uid(by_uid(result.remote["Author"])) == expected[1]
    assert {uid: change for (_, uid), change in log_of(result).items()} == expected[2]
    assert collect_watermarks(result.watermarks, model) == expected[3]
    assert {r["uid"] for r in result.errors.collect()} == expected[4]
    sent = sum(1 for u, r in here.items() if r["is_dirty"] and u not in expected[4])
    assert sum(r["n"] for r in result.counters.collect() if r["side"] == "local") == sent


def seeded(spark, status=2):
    here, there = empty_tables(spark)
    there["Author"] = remote(spark, "Author", {"uid": "a1", "name": "Author#1", "status": status})
    there["Book"] = remote(
        spark, "Book", *[{"uid": f"b{i}", "name": f"Book#{i}", "status": status, "author": ref("Author", "a1")} for i in (1, 2)]
    )
    return here, there


@pytest.mark.parametrize("status", [1, 2])
def test_first_pull_inserts_and_second_does_nothing(spark, status):
    here, there = seeded(spark, status)
    first = run(here, there)
    assert log_of(first) == {("Author", "a1"): "inserted", ("Book", "b1"): "inserted", ("Book", "b2"): "inserted"}
    marks = collect_watermarks(first.watermarks, LIBRARY)
    assert marks == {"Author": at(0), "Book": at(0)}
    for options in ({"watermarks": marks}, {"full": True}):
        second = run(first.local, first.remote, **options)
        assert log_of(second) == {}
        assert by_uid(second.local["Book"]) == by_uid(first.local["Book"])
    visible = fetch.fetch_objects(first.local["Book"], LIBRARY, "Book").count()
    assert visible == (2 if status == 2 else 0)
    books = inverse_of_to_one(first.local["Book"], "author")
    assert [r["dst_uid"] for r in books.orderBy("dst_uid").collect()] == ["b1", "b2"]


def test_third_book_added_at_the_remote(spark):
    here, there = seeded(spark)
    first = run(here, there)
    marks = collect_watermarks(first.watermarks, LIBRARY)
    there = dict(first.remote)
    there["Book"] = there["Book"].unionByName(
        remote(spark, "Book", {"uid": "b3", "updated_at": at(5), "author": ref("Author", "a1")}), allowMissingColumns=True
    )
    there["Author"] = remote(spark, "Author", {"uid": "a1", "name": "Author#1", "updated_at": at(5)})
    second = run(first.local, there, watermarks=marks)
    assert log_of(second) == {("Author", "a1"): "updated", ("Book", "b3"): "inserted"}
    assert by_uid(second.local["Author"])["a1"]["last_modified"] == at(5)
    assert inverse_of_to_one(second.local["Book"], "author").count() == 3


def test_remote_delete_takes_the_books_along(spark):
    here, there = seeded(spark)
    first = run(here, there)
    there = {**first.remote, "Author": remote(spark, "Author", {"uid": "a1", "status": 3, "updated_at": at(9)})}
    second = run(first.local, there, watermarks=collect_watermarks(first.watermarks, LIBRARY))
    assert second.local["Author"].count() == 0 and second.local["Book"].count() == 0
    assert log_of(second)[("Author", "a1")] == "deleted"


def test_new_rows_reach_the_remote_with_their_references(spark):
    here, there = empty_tables(spark)
    here["Author"] = local(spark, "Author", made_here(uid="a1", name="Author#1"))
    here["Book"] = local(
        spark,
        "Book",
        made_here(uid="b1", author=ref("Author", "a1")),
        made_here(uid="e1", entity="EBook", format="PDF", picture=bytearray(b"\x00\xff" * 1000), createdDate=at(3)),
    )
    here["Magazine"] = local(spark, "Magazine", made_here(uid="m1", authors=[ref("Author", "a1"), ref("Author", "a2")]))
    here["Author"] = here["Author"].unionByName(local(spark, "Author", made_here(uid="a2", status=1, is_dirty=False)))
    result = run(here, there)
    books, authors = by_uid(result.remote["Book"]), by_uid(result.remote["Author"])
    assert books["b1"]["author"] == ref("Author", "a1") and authors["a1"]["status"] == 2
    assert (books["e1"]["entity"], books["e1"]["format"], books["e1"]["createdDate"]) == ("EBook", "PDF", at(3))
    assert bytes(books["e1"]["picture"]) == b"\x00\xff" * 1000
    assert authors["a2"]["status"] == 1
    assert {r["uid"] for r in by_uid(result.remote["Magazine"])["m1"]["authors"]} == {"a1", "a2"}
    for table in result.local.values():
        assert push.dirty(table).count() == 0
        assert table.filter("last_modified IS NULL OR NOT created_remotely").count() == 0
    assert collect_watermarks(result.watermarks, LIBRARY)["Book"] == PUSH
    again = run(result.local, result.remote, watermarks=collect_watermarks(result.watermarks, LIBRARY))
    assert log_of(again) == {}


@pytest.mark.parametrize(("policy", "name"), [(Policy.CLIENT_WINS, "C"), (Policy.SERVER_WINS, "D")])
def test_conflict(spark, policy, name):
    here, there = empty_tables(spark)
    here["Book"] = local(spark, "Book", {"uid": "b1", "name": "C", "is_dirty": True, "last_modified": at(1)})
    there["Book"] = remote(spark, "Book", {"uid": "b1", "name": "D", "updated_at": at(2)})
    result = run(here, there, policy=policy)
    assert by_uid(result.local["Book"])["b1"]["name"] == name
    assert by_uid(result.remote["Book"])["b1"]["name"] == name
    assert not by_uid(result.local["Book"])["b1"]["is_dirty"]


def test_pulled_references_get_placeholders(spark):
    here, there = empty_tables(spark)
    there["Book"] = remote(spark, "Book", {"uid": "b1", "author": ref("Author", "a1")})
    there["Magazine"] = remote(spark, "Magazine", {"uid": "m1", "authors": [ref("Author", "a1"), ref("Author", "a2")]})
    there["Author"] = remote(spark, "Author", {"uid": "a2", "name": "known"})
    result = run(here, there)
    authors = by_uid(result.local["Author"])
    assert (authors["a1"]["status"], authors["a1"]["created_remotely"], authors["a1"]["last_modified"]) == (1, True, None)
    assert authors["a2"]["name"] == "known"
    assert log_of(result)[("Author", "a1")] == "inserted"
    assert uids(fetch.visible(result.local["Author"])) == ["a2"]
    edges = inverse_of_array(result.local["Magazine"], "authors")
    maps = member_maps(result.local["Author"], resolve_to_many(edges, result.local["Magazine"]))
    assert {r["uid"]: r["members"] for r in maps.collect()} == {"a1": {"Magazine": ["m1"]}, "a2": {"Magazine": ["m1"]}}
    there["Author"] = there["Author"].unionByName(remote(spark, "Author", {"uid": "a1", "name": "late", "updated_at": at(7)}))
    later = run(result.local, there, watermarks=collect_watermarks(result.watermarks, LIBRARY))
    assert by_uid(later.local["Author"])["a1"]["status"] == 2 and log_of(later) == {("Author", "a1"): "updated"}


def test_cascade_reaches_the_remote(spark):
    here, there = seeded(spark)
    first = run(here, there)
    gone = delete_rows(LIBRARY, first.local, "Author", spark.createDataFrame([("a1",)], "uid string")).tables
    second = run(gone, first.remote, watermarks=collect_watermarks(first.watermarks, LIBRARY))
    assert {r["status"] for r in by_uid(second.remote["Author"]).values()} == {3}
    assert {r["status"] for r in by_uid(second.remote["Book"]).values()} == {3}
    assert second.local["Book"].filter("status = 3 AND NOT is_dirty").count() == 2


def test_nullify_reaches_the_remote(spark):
    here, there = seeded(spark)
    first = run(here, there)
    gone = delete_rows(LIBRARY, first.local, "Book", spark.createDataFrame([("b2",)], "uid string")).tables
    second = run(gone, first.remote, watermarks=collect_watermarks(first.watermarks, LIBRARY))
    books = by_uid(second.remote["Book"])
    assert (books["b1"]["status"], books["b1"]["author"]) == (2, ref("Author", "a1"))
    assert (books["b2"]["status"], books["b2"]["author"]) == (3, None)
    assert by_uid(second.remote["Author"])["a1"]["status"] == 2


def test_a_row_never_pushed_cannot_be_referred_to(spark):
    here, there = empty_tables(spark)
    here["Author"] = local(spark, "Author", made_here(uid="a1", status=3))
    here["Book"] = local(spark, "Book", made_here(uid="b1", author=ref("Author", "a1")))
    result = run(here, there)
    assert result.remote["Author"].count() == 0 and result.local["Author"].count() == 0
    assert by_uid(result.remote["Book"])["b1"]["author"] is None
    assert by_uid(result.local["Book"])["b1"]["author"] is None
    assert log_of(result)[("Author", "a1")] == "deleted"


@pytest.mark.parametrize(("copies", "code"), [(0, 201), (2, 200)])
def test_errors_stop_a_sync_or_are_set_aside(spark, copies, code):
    here, there = empty_tables(spark)
    here["Book"] = local(spark, "Book", {"uid": "b1", "is_dirty": True}, made_here(uid="b2"))
    there["Book"] = remote(spark, "Book", *[{"uid": "b1", "updated_at": at(i)} for i in range(copies)])
    with pytest.raises(SyncError) as caught:
        run(here, there)
    assert caught.value.code == code and caught.value.uid == "b1"
    result = run(here, there, on_error="quarantine")
    assert [(r["uid"], r["code"]) for r in result.errors.collect()] == [("b1", code)]
    left = by_uid(result.local["Book"])
    assert left["b1"]["is_dirty"] and not left["b2"]["is_dirty"]
    assert result.remote["Book"].count() == copies + 1
    with pytest.raises(ValueError):
        run(here, there, on_error="ignore")


def test_many_rows(spark):
    here, there = empty_tables(spark)
    here["Author"] = spark.range(1000).select(
        F.concat(F.lit("a"), "id").alias("uid"),
        F.lit("Author").alias("entity"),
        F.lit(2).cast("short").alias("status"),
        F.lit(None).cast("timestamp_ntz").alias("last_modified"),
        F.lit(True).alias("is_dirty"),
        F.lit(False).alias("created_remotely"),
        F.concat(F.lit("Author#"), "id").alias("name"),
        F.lit(None).cast("binary").alias("photo"),
    )
    result = run(here, there)
    assert result.remote["Author"].count() == result.local["Author"].count() == 1000
    assert push.dirty(result.local["Author"]).count() == 0


def partners(spark, *pairs):
    return spark.createDataFrame(
        [(s, "Publisher", d) for s, d in pairs], "src_uid string, dst_entity string, dst_uid string"
    )


def pairs_of(edges):
    return sorted((r["src_uid"], r["dst_uid"]) for r in edges.collect())


def test_edges_of_a_relation_follow_their_rows(spark):
    here, there = empty_tables(spark)
    name = "Publisher.partners"
    here["Publisher"] = local(
        spark,
        "Publisher",
        {"uid": "p1", "is_dirty": True},
        {"uid": "p2"},
        {"uid": "p3", "last_modified": at(-1)},
        made_here(uid="p4", status=3),
    )
    there["Publisher"] = remote(spark, "Publisher", {"uid": "p1"}, {"uid": "p2"}, {"uid": "p3"})
    result = sync(
        LIBRARY,
        {"Publisher": here["Publisher"]},
        {"Publisher": there["Publisher"]},
        push_time=PUSH,
        now=NOW,
        local_edges={name: partners(spark, ("p1", "p2"), ("p1", "p4"), ("p2", "p3"), ("p3", "p1"))},
        remote_edges={name: partners(spark, ("p1", "p3"), ("p2", "p1"), ("p3", "p2"), ("p3", "p9"))},
    )
    assert pairs_of(result.remote_edges[name]) == [("p1", "p2"), ("p2", "p1"), ("p3", "p2"), ("p3", "p9")]
    assert pairs_of(result.local_edges[name]) == [("p1", "p2"), ("p2", "p3"), ("p3", "p2"), ("p3", "p9")]
    publishers = by_uid(result.local["Publisher"])
    assert publishers["p9"]["status"] == 1 and "p4" not in publishers


def marks_of(result):
    return collect_watermarks(result.watermarks, LIBRARY)


@pytest.mark.parametrize("pushed, expected", [(1999, 1999), (2000, 5), (3000, 5)])
def test_own_writes_lift_the_watermark_only_below_the_bound(spark, pushed, expected):
    here, there = empty_tables(spark)
    here["Author"] = local(spark, "Author", made_here(uid="a1", name="new"))
    there["Author"] = remote(spark, "Author", {"uid": "a2", "updated_at": at(5)})
    assert marks_of(run(here, there, push_time=at(pushed)))["Author"] == at(expected)


def test_a_key_that_comes_twice_is_an_error_and_never_two_rows(spark):
    here, there = empty_tables(spark)
    there["Author"] = remote(
        spark, "Author", {"uid": "a1", "updated_at": at(1)}, {"uid": "a1", "updated_at": at(2)}, {"uid": "a2"}
    )
    with pytest.raises(SyncError) as stopped:
        run(here, there)
    assert (stopped.value.code, stopped.value.uid) == (push.ERROR_DUPLICATE_UID, "a1")
    result = run(here, there, on_error="quarantine")
    assert uids(result.local["Author"]) == ["a2"]
    assert [(r["uid"], r["code"], r["remote_rows"]) for r in result.errors.collect()] == [("a1", 200, 2)]


def test_rows_no_table_can_take_are_errors(spark):
    here, there = empty_tables(spark)
    rows = [
        {"uid": "b1", "author": ref("Author", "a1")},
        {"uid": "b2", "author": {"entity": None, "uid": "a1"}},
        {"uid": "b3", "entity": "Nowhere"},
        {"uid": "b4", "updated_at": None},
        {"uid": "b5", "status": None},
    ]
    base = {"entity": "Book", "status": 2, "updated_at": at(0)}
    there["Book"] = table(spark, relaxed(LIBRARY.remote_schema("Book")), [{**base, **row} for row in rows])
    result = run(here, there, on_error="quarantine")
    assert {r["uid"]: (r["action"], r["code"]) for r in result.errors.collect()} == {
        "b2": ("error_malformed_reference", 3),
        "b3": ("error_unknown_entity", None),
        "b4": ("error_missing_value", None),
        "b5": ("error_missing_value", None),
    }
    assert uids(result.local["Book"]) == ["b1"]
    with pytest.raises(SyncError):
        run(here, there)


def test_what_a_winning_row_refers_to_gets_a_placeholder(spark):
    here, there = empty_tables(spark)
    here["Book"] = local(spark, "Book", {"uid": "b1", "name": "C", "is_dirty": True})
    there["Book"] = remote(spark, "Book", {"uid": "b1", "name": "D", "author": ref("Author", "a5"), "updated_at": at(9)})
    result = run(here, there)
    found = by_uid(result.local["Author"])
    assert found["a5"]["status"] == 1 and log_of(result)["Author", "a5"] == "inserted"


def test_a_dropped_row_leaves_arrays_on_both_sides(spark):
    here, there = empty_tables(spark)
    here["Author"] = local(spark, "Author", made_here(uid="a1", status=3), {"uid": "a2"})
    there["Author"] = remote(spark, "Author", {"uid": "a2"})
    both = [ref("Author", "a1"), ref("Author", "a2")]
    here["Magazine"] = local(spark, "Magazine", made_here(uid="m1", authors=both))
    result = run(here, there)
    for side in (result.local, result.remote):
        assert by_uid(side["Magazine"])["m1"]["authors"] == [ref("Author", "a2")]


def test_the_log_tells_cascades_and_cleared_references(spark):
    here, there = empty_tables(spark)
    here["Author"] = local(spark, "Author", {"uid": "a1"})
    here["Book"] = local(spark, "Book", {"uid": "b1", "author": ref("Author", "a1")})
    here["Magazine"] = local(spark, "Magazine", {"uid": "m1", "authors": [ref("Author", "a1")]}, {"uid": "m2"})
    there["Author"] = remote(spark, "Author", {"uid": "a1", "status": 3, "updated_at": at(9)})
    result = run(here, there)
    assert log_of(result) == {("Author", "a1"): "deleted", ("Book", "b1"): "deleted", ("Magazine", "m1"): "updated"}
    assert not uids(result.local["Book"])


def test_edges_go_with_rows_of_their_own_root_only(spark):
    here, there = empty_tables(spark)
    here["Book"] = local(spark, "Book", {"uid": "x1"})
    here["Publisher"] = local(spark, "Publisher", {"uid": "x1"}, {"uid": "x2"}, {"uid": "x3"})
    there["Book"] = remote(spark, "Book", {"uid": "x1", "status": 3, "updated_at": at(9)})
    there["Publisher"] = remote(spark, "Publisher", {"uid": "x3", "status": 3, "updated_at": at(9)})
    edges = spark.createDataFrame(
        [("x1", "Publisher", "x2"), ("x2", "Publisher", "x3")], "src_uid string, dst_entity string, dst_uid string"
    )
    result = run(here, there, local_edges={"Publisher.partners": edges})
    assert [tuple(r) for r in result.local_edges["Publisher.partners"].collect()] == [("x1", "Publisher", "x2")]


def test_a_root_that_one_side_lacks_is_empty_there(spark):
    here, there = seeded(spark)
    del here["Book"], there["Page"]
    assert set(uids(run(here, there).local["Book"])) == {"b1", "b2"}
