from __future__ import annotations

import itertools

import pytest
from pyspark.sql import functions as F

from ebbflow.operators import changes, checks, pull, push
from ebbflow.operators.push import Policy
from tests.library import LIBRARY, at, by_uid, local, made_here, ref, remote, uids


def test_scan_bounds_are_strict(spark):
    there = remote(spark, "Book", *[{"uid": f"b{i}", "updated_at": at(i)} for i in range(5)], {"uid": "e1", "entity": "EBook", "updated_at": at(2)})
    assert sorted(uids(pull.change_scan(there, "Book", pull.ntz(at(1)), pull.ntz(at(4))))) == ["b2", "b3"]
    assert len(uids(pull.change_scan(there, "Book"))) == 5
    assert uids(pull.change_scan(there, "EBook", pull.ntz(at(1)))) == ["e1"]


def test_pages_cover_the_scan_once(spark):
    there = remote(spark, "Book", *[{"uid": f"b{i:03}", "updated_at": at(i // 3)} for i in range(250)])
    pages = [uids(pull.change_page(there, n)) for n in range(3)]
    assert [len(p) for p in pages] == [100, 100, 50]
    assert sorted(u for p in pages for u in p) == sorted(uids(there))
    last = pull.change_page(there, 0).collect()[-1]
    after = pull.change_page_after(there, F.lit(last["updated_at"]).cast("timestamp_ntz"), F.lit(last["uid"]))
    assert uids(after) == pages[1]


def test_increment_and_late_rows_split_the_feed(spark):
    there = remote(
        spark,
        "Book",
        {"uid": "tie", "updated_at": at(5)},
        {"uid": "below", "updated_at": at(4)},
        {"uid": "above", "updated_at": at(6)},
        {"uid": "now", "updated_at": at(9)},
        {"uid": "other", "entity": "EBook", "updated_at": at(1)},
    )
    marks = {"Book": at(5)}
    assert sorted(uids(pull.increment(there, marks, at(9)))) == ["above", "other"]
    assert sorted(uids(pull.late_rows(there, marks))) == ["below", "tie"]
    assert sorted(uids(pull.increment(there, marks, at(9), full=True))) == ["above", "below", "other", "tie"]
    assert sorted(uids(pull.increment(there, None, at(9)))) == ["above", "below", "other", "tie"]
    assert uids(pull.late_rows(there, {})) == []


def test_increment_reaches_the_scan(spark, tmp_path):
    remote(spark, "Book", {"uid": "b1"}).write.parquet(str(tmp_path / "r"))
    marks = {"Book": at(5), "EBook": at(3)}
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        rows = pull.increment(spark.read.parquet(str(tmp_path / "r")), marks, at(9), entities=["Book", "EBook"])
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan[plan.index("PushedFilters") : plan.index("ReadSchema")]
    assert "LessThan(updated_at,2014-06-01T10:00:09.123456)" in pushed
    assert "GreaterThan(updated_at,2014-06-01T10:00:03.123456)" in pushed


def test_watermarks_never_move_back(spark):
    old = spark.createDataFrame([("Book", at(5)), ("Page", at(7))], "entity string, watermark timestamp_ntz")
    pulled = spark.createDataFrame(
        [("Book", at(8)), ("Book", at(6)), ("EBook", at(1)), ("Page", at(2))], "entity string, updated_at timestamp_ntz"
    )
    marks = pull.collect_watermarks(pull.advance(old, pulled), LIBRARY)
    assert marks == {"Book": at(8), "Page": at(7), "EBook": at(1)}


def test_latest_version_of_a_busy_key(spark):
    feed = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("u"), F.col("id") % 50)).alias("uid"),
        F.lit("Book").alias("entity"),
        F.lit(2).alias("status"),
        (pull.ntz(at(0)) + F.make_dt_interval(secs=F.col("id") % 500)).alias("updated_at"),
        F.col("id").alias("event"),
    )
    got = {r["uid"]: r["event"] for r in pull.latest_version(feed, "event").collect()}
    best = {}
    for row in feed.collect():
        best[row["uid"]] = max(best.get(row["uid"], (at(-1), -1)), (row["updated_at"], row["event"]))
    assert got == {u: event for u, (_, event) in best.items()}


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_decision_table_and_result(spark, broadcast):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        here, there, expected = [], [], {}
        for number, (known, remote_status, same, status) in enumerate(
            itertools.product((True, False), (1, 2, 3), (True, False), (1, 2, 3))
        ):
            uid = f"u{number}"
            if known:
                here.append({"uid": uid, "name": "A", "status": status, "is_dirty": number % 2 == 0, "last_modified": at(5) if same else None})
            there.append({"uid": uid, "name": "D", "status": remote_status, "updated_at": at(5)})
            if known and same:
                expected[uid] = "skip"
            elif not known:
                expected[uid] = "ignore" if remote_status == 3 else "insert"
            else:
                expected[uid] = "delete_local" if remote_status == 3 else "update"
        here.append({"uid": "untouched", "name": "A"})
        local_table, incoming = local(spark, "Book", *here), pull.decode_rows(remote(spark, "Book", *there), LIBRARY, "Book")
        plan = by_uid(pull.pull_plan(local_table, incoming))
        assert {u: r["action"] for u, r in plan.items()} == expected
        result = pull.apply_pull(local_table, incoming)
        after, removed = by_uid(result.local), uids(result.removed)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    assert sorted(removed) == sorted(u for u, a in expected.items() if a == "delete_local")
    assert set(after) == {u for u, a in expected.items() if a not in ("ignore", "delete_local")} | {"untouched"}
    before = {r["uid"]: r for r in here}
    remote_status = {r["uid"]: r["status"] for r in there}
    for uid, row in after.items():
        action = expected.get(uid, "skip")
        if action == "skip":
            assert row["name"] == "A"
        else:
            assert (row["name"], row["status"], row["last_modified"]) == ("D", remote_status[uid], at(5))
            assert row["is_dirty"] == (before[uid]["is_dirty"] if action == "update" else False)
            assert row["created_remotely"]


def test_decoding(spark):
    there = remote(
        spark,
        "Magazine",
        {"uid": "m1", "authors": [ref("Author", "a1"), None], "publisher": ref("Publisher", "p1"), "updated_at": at(7)},
    ).withColumns({"acl": F.lit("x"), "extra": F.lit(1)})
    row = by_uid(pull.decode_rows(there, LIBRARY, "Magazine"))["m1"]
    assert row["authors"] == [ref("Author", "a1")] and row["publisher"] == ref("Publisher", "p1")
    assert row["last_modified"] == at(7) and row["status"] == 2 and "acl" not in row and "updated_at" not in row


def test_change_log_keeps_the_first_change(spark):
    pushed = spark.createDataFrame([("Book", "b1", "drop_local"), ("Book", "b2", "update_remote"), ("Book", "b3", "error_not_found")], "entity string, uid string, action string")
    pulled = spark.createDataFrame(
        [("Book", "b1", "insert"), ("Book", "b4", "insert"), ("Book", "b5", "skip"), ("EBook", "b2", "delete_local")],
        "entity string, uid string, action string",
    )
    added = spark.createDataFrame([("Book", "b4"), ("Author", "a1")], "entity string, uid string")
    log = {(r["entity"], r["uid"]): r["change"] for r in changes.change_log(pushed, pulled, added).collect()}
    assert log == {
        ("Book", "b1"): "deleted",
        ("Book", "b2"): "updated",
        ("Book", "b4"): "inserted",
        ("EBook", "b2"): "deleted",
        ("Author", "a1"): "inserted",
    }
    kinds = {r["change"]: (r["n"], r["least_uid"]) for r in changes.by_kind(changes.change_log(pushed, pulled, added)).collect()}
    assert kinds == {"deleted": (2, "b1"), "updated": (1, "b2"), "inserted": (2, "a1")}
    counts = {(r["side"], r["entity"]): r["n"] for r in changes.sync_counters(pushed, pulled).collect()}
    assert counts == {("local", "Book"): 2, ("remote", "Book"): 2, ("remote", "EBook"): 1}


def test_pending_counts(spark):
    here = local(spark, "Book", made_here(uid="b1"), {"uid": "b2"})
    into = pull.increment(remote(spark, "Book", {"uid": "b2", "updated_at": at(3)}), {"Book": at(1)}, at(9))
    counts = {(r["side"], r["entity"]): r["n"] for r in changes.pending_counts(here, into).collect()}
    assert counts == {("local", "Book"): 1, ("remote", "Book"): 1}


def test_checks(spark):
    there = remote(spark, "Book", {"uid": "b1"}, {"uid": "b1"}, {"uid": "b2"})
    assert [(r["uid"], r["n"]) for r in checks.duplicate_keys(there).collect()] == [("b1", 2)]
    damaged = there.withColumns({"status": F.lit(None).cast("short"), "updated_at": F.when(F.col("uid") == "b2", F.col("updated_at"))})
    missing = sorted((r["uid"], r["missing"]) for r in checks.missing_mandatory(damaged).collect())
    assert missing == [("b1", "status"), ("b1", "status"), ("b1", "updated_at"), ("b1", "updated_at"), ("b2", "status")]
    magazines = local(
        spark,
        "Magazine",
        {"uid": "m1", "authors": [ref("Author", None)], "publisher": ref(None, "p1")},
        {"uid": "m2", "authors": [None, ref("Author", "a1")]},
        {"uid": "m3"},
    )
    bad = checks.malformed_references(magazines, to_one=["publisher"], arrays=["authors"])
    assert sorted((r["uid"], r["column"], r["code"]) for r in bad.collect()) == [("m1", "authors", 3), ("m1", "publisher", 3)]
    refs = spark.createDataFrame([("Author", "a"), ("Ghost", "g"), ("Ghost", "h"), (None, "x")], "entity string, uid string")
    assert [tuple(r) for r in checks.unknown_entities(refs, LIBRARY).collect()] == [("Ghost", 2)]
    assert push.push_plan(local(spark, "Book", {"uid": "b1", "is_dirty": True}), there, Policy.SERVER_WINS).head()["remote_rows"] == 2
