from __future__ import annotations

import itertools

import pytest
from pyspark.sql import functions as F

from ebbflow.functions.acl import explode_acl, format_acl, merge_entries, merge_maps, parse_acl
from ebbflow.operators import pull, push
from ebbflow.operators.push import Policy
from tests.library import LIBRARY, at, by_uid, local, made_here, ref, remote, uids

NOW = at(1000)


def expected_action(created_remotely, status, copies, modified, policy):
    if not created_remotely:
        return "drop_local" if status == 3 else "insert_remote"
    if copies == 0:
        return "error_not_found"
    if copies == 2:
        return "error_duplicate_uid"
    if modified in (None, at(5)):
        return "update_remote"
    if policy is Policy.SERVER_WINS:
        return "overwrite_local"
    return "update_remote_drop_local" if status == 3 else "update_remote"


@pytest.mark.parametrize("policy", list(Policy))
def test_decision_table(spark, policy):
    here, there, expected = [], [], {}
    cases = itertools.product((True, False), (1, 2, 3), (0, 1, 2), (None, at(5), at(4), at(6)))
    for number, (remotely, status, copies, modified) in enumerate(cases):
        uid = f"u{number}"
        here.append({"uid": uid, "status": status, "created_remotely": remotely, "last_modified": modified, "is_dirty": True})
        there += [{"uid": uid, "updated_at": at(5)}] * copies
        expected[uid] = expected_action(remotely, status, copies, modified, policy)
    here.append({"uid": "clean", "is_dirty": False})
    plan = push.push_plan(local(spark, "Book", *here), remote(spark, "Book", *there), policy)
    assert {u: r["action"] for u, r in by_uid(plan).items()} == expected
    codes = {r["uid"]: r["code"] for r in push.push_errors(plan).collect()}
    assert codes == {u: {"error_not_found": 201, "error_duplicate_uid": 200}[a] for u, a in expected.items() if "error" in a}


def test_the_key_includes_the_entity(spark):
    here = local(spark, "Book", {"uid": "b1", "entity": "EBook", "is_dirty": True})
    plan = push.push_plan(here, remote(spark, "Book", {"uid": "b1"}), Policy.SERVER_WINS)
    assert plan.head()["action"] == "error_not_found"


def sides(spark):
    here = local(
        spark,
        "Book",
        made_here(uid="new", name="new"),
        made_here(uid="never", status=3),
        {"uid": "same", "name": "mine", "is_dirty": True, "last_modified": at(5)},
        {"uid": "tomb", "status": 3, "is_dirty": True, "last_modified": at(5)},
        {"uid": "both", "name": "C", "is_dirty": True, "last_modified": at(1)},
        {"uid": "bothdel", "name": "C", "status": 3, "is_dirty": True, "last_modified": at(1)},
        {"uid": "lost", "name": "C", "is_dirty": True},
        {"uid": "clean", "name": "A"},
    )
    there = remote(
        spark,
        "Book",
        *[{"uid": u, "name": "D", "updated_at": at(5)} for u in ("same", "tomb", "both", "bothdel", "clean")],
        {"uid": "only", "name": "theirs"},
    )
    return here, there


def state(result):
    here = {u: (r["name"], r["status"], r["is_dirty"], r["last_modified"], r["created_remotely"]) for u, r in by_uid(result.local).items()}
    there = {u: (r["name"], r["status"], r["updated_at"]) for u, r in by_uid(result.remote).items()}
    return here, there


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
@pytest.mark.parametrize("policy", list(Policy))
def test_both_sides_after_a_push(spark, policy, broadcast):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        here, there = sides(spark)
        plan = push.push_plan(here, there, policy)
        local_after, remote_after = state(push.apply_push(here, there, plan, pull.ntz(NOW)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    assert local_after["new"] == ("new", 2, False, NOW, True)
    assert "never" not in local_after and "never" not in remote_after
    assert local_after["same"] == ("mine", 2, False, NOW, True) and remote_after["same"] == ("mine", 2, NOW)
    assert local_after["tomb"] == (None, 3, False, NOW, True) and remote_after["tomb"] == (None, 3, NOW)
    assert local_after["lost"] == ("C", 2, True, at(0), True) and "lost" not in remote_after
    assert local_after["clean"] == ("A", 2, False, at(0), True) and remote_after["clean"] == ("D", 2, at(5))
    assert remote_after["new"] == ("new", 2, NOW) and remote_after["only"] == ("theirs", 2, at(0))
    if policy is Policy.CLIENT_WINS:
        assert local_after["both"] == ("C", 2, False, NOW, True) and remote_after["both"] == ("C", 2, NOW)
        assert "bothdel" not in local_after and remote_after["bothdel"] == ("C", 3, NOW)
    else:
        assert local_after["both"] == ("D", 2, False, at(5), True) and remote_after["both"] == ("D", 2, at(5))
        assert local_after["bothdel"] == ("D", 2, False, at(5), True)


def test_pushing_again_does_nothing(spark):
    here, there = sides(spark)
    here = here.filter("uid <> 'lost'")
    first = push.apply_push(here, there, push.push_plan(here, there, Policy.CLIENT_WINS), pull.ntz(NOW))
    assert push.dirty(first.local).count() == 0
    again = push.push_plan(here, first.remote, Policy.CLIENT_WINS)
    second = push.apply_push(here, first.remote, again, pull.ntz(NOW))
    assert state(second)[1] == state(first)[1]


def test_encoded_rows_carry_no_local_control(spark):
    rows = local(spark, "Book", {"uid": "b1", "status": 3, "author": ref("Author", "a1")}, {"uid": "e1", "entity": "EBook"})
    encoded = push.encode_rows(rows)
    assert not {"last_modified", "is_dirty", "created_remotely"} & set(encoded.columns)
    found = by_uid(encoded)
    assert found["b1"]["status"] == 3 and found["b1"]["author"] == ref("Author", "a1") and found["b1"]["name"] is None
    assert found["e1"]["entity"] == "EBook"


def test_placeholders_of_a_push(spark):
    authors = local(
        spark,
        "Author",
        made_here(uid="a1", status=1, is_dirty=False),
        made_here(uid="a2"),
        {"uid": "a3"},
        made_here(uid="a4", status=3),
    )
    refs = spark.createDataFrame([("Author", f"a{i}") for i in (1, 1, 2, 3, 4)], "entity string, uid string")
    plan = push.push_plan(authors, remote(spark, "Author", {"uid": "a3"}), Policy.SERVER_WINS)
    keys = push.placeholders_to_push(refs, authors, plan)
    assert uids(keys) == ["a1"]
    after = push.apply_push(authors, remote(spark, "Author", {"uid": "a3"}), plan, pull.ntz(NOW), keys)
    there, here = by_uid(after.remote), by_uid(after.local)
    assert (there["a1"]["status"], there["a1"]["updated_at"], there["a1"]["name"]) == (1, NOW, None)
    assert here["a1"]["created_remotely"] and here["a1"]["last_modified"] == NOW and here["a1"]["status"] == 1
    assert set(there) == {"a1", "a2", "a3"} and set(here) == {"a1", "a2", "a3"}


def test_references_to_dropped_rows_become_null(spark):
    books = local(spark, "Book", {"uid": "b1", "author": ref("Author", "a1")}, {"uid": "b2", "author": ref("Author", "a2")})
    dropped = spark.createDataFrame([("a1",)], "uid string")
    found = by_uid(push.without_dropped(books, ["author"], dropped))
    assert found["b1"]["author"] is None and found["b2"]["author"] == ref("Author", "a2")


ACL_TEXT = '{"ann": {"read": "true", "write": "false"}, "role:Members": {"read": true}, "role:Staff": {"write": "no"}}'


def test_access_entries(spark):
    rows = spark.createDataFrame([("b1", ACL_TEXT), ("b2", None)], "uid string, text string")
    rows = rows.withColumn("acl", parse_acl(F.col("text").cast("binary")))
    entries = {(r["kind"], r["who"]): (r["read"], r["write"]) for r in explode_acl(rows).collect()}
    assert entries == {("user", "ann"): (True, False), ("role", "Members"): (True, None), ("role", "Staff"): (None, False)}
    again = rows.select("uid", parse_acl(format_acl(F.col("acl"))).alias("acl"))
    assert sorted(map(tuple, explode_acl(again).collect()), key=str) == sorted(map(tuple, explode_acl(rows).collect()), key=str)


def test_access_entries_merge(spark):
    old = spark.createDataFrame([("b1", '{"ann": {"read": "true", "write": "true"}, "bob": {"read": "true"}}')], "uid string, text string")
    new = spark.createDataFrame([("b1", '{"ann": {"write": "false"}, "role:R": {"read": "true"}}')], "uid string, text string")
    old, new = (d.select("uid", parse_acl(F.col("text")).alias("acl")) for d in (old, new))
    expected = {("ann", True, False), ("bob", True, None), ("R", True, None)}
    flat = merge_entries(explode_acl(old), explode_acl(new))
    assert {(r["who"], r["read"], r["write"]) for r in flat.collect()} == expected
    both = old.join(new.withColumnRenamed("acl", "given"), "uid").select("uid", merge_maps(F.col("acl"), F.col("given")).alias("acl"))
    assert {(r["who"], r["read"], r["write"]) for r in explode_acl(both).collect()} == expected


def test_a_push_merges_access_entries(spark):
    here = local(spark, "Book", {"uid": "b1", "is_dirty": True}, {"uid": "b2", "is_dirty": True})
    here = here.withColumn("acl", F.when(F.col("uid") == "b1", parse_acl(F.lit('{"ann": {"write": "true"}}'))))
    there = remote(spark, "Book", {"uid": "b1"}, {"uid": "b2"}).withColumn("acl", parse_acl(F.lit('{"bob": {"read": "true"}}')))
    after = push.apply_push(here, there, push.push_plan(here, there, Policy.SERVER_WINS), pull.ntz(NOW))
    who = {(r["uid"], r["who"]) for r in explode_acl(after.remote).collect()}
    assert who == {("b1", "ann"), ("b1", "bob"), ("b2", "bob")}
    assert LIBRARY.root_of("Book") == "Book"
