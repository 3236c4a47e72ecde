"""The delta sync against the sync of whole tables, and what it reads and writes."""

from __future__ import annotations

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ebbflow.operators import changes
from ebbflow.operators.delta import change_set, sync_stores
from ebbflow.operators.pull import collect_watermarks
from ebbflow.operators.push import Policy
from ebbflow.operators.sync import SyncError, sync
from ebbflow.sources import changefeed
from ebbflow.sources.snapshots import SnapshotStore
from tests.library import LIBRARY, at, by_uid, local, made_here, ref, remote, uids

PARTNERS = "Publisher.partners"
EDGE = "src_uid string, dst_entity string, dst_uid string"


def partners(spark, *pairs):
    return spark.createDataFrame([(a, "Publisher", b) for a, b in pairs], EDGE)


def stores(spark, path, buckets=16, **options):
    here = SnapshotStore(spark, f"{path}/local", LIBRARY, buckets)
    there = SnapshotStore(spark, f"{path}/remote", LIBRARY, buckets, side="remote", **options)
    return here, there


def random_tables(spark, seed):
    """Rows that refer to each other on both sides, some dirty, some new, some deleted, some changed there."""
    pick = random.Random(seed)
    roots = {"Author": "a", "Book": "b", "Magazine": "m", "Page": "p", "Publisher": "u"}

    def one(root, chance=0.8):
        return ref(root, f"{roots[root]}{pick.randrange(30)}") if pick.random() < chance else None

    def values(root):
        return {
            "Author": lambda: {"name": f"n{pick.random():.3f}"},
            "Book": lambda: {"name": f"n{pick.random():.3f}", "author": one("Author")},
            "Magazine": lambda: {"authors": [one("Author", 1) for _ in range(pick.randrange(3))], "publisher": one("Publisher")},
            "Page": lambda: {"book": one("Book"), "magazine": one("Magazine", 0.3)},
            "Publisher": lambda: {"name": f"n{pick.random():.3f}"},
        }[root]()

    here, there = {}, {}
    for root, letter in roots.items():
        mine, other = [], []
        for i in range(24):
            uid, kind = f"{letter}{i}", pick.random()
            if kind < 0.15:
                mine.append({"uid": uid, **values(root), **made_here(status=pick.choice([2, 2, 3]))})
            elif kind < 0.85:
                mine.append({"uid": uid, **values(root), "is_dirty": pick.random() < 0.2, "status": pick.choice([2, 2, 2, 3])})
            if kind >= 0.15 and pick.random() < 0.95:
                changed = pick.random() < 0.3
                other.append({"uid": uid, **values(root), "updated_at": at(5 if changed else 0), "status": pick.choice([2, 2, 3]) if changed else 2})
        here[root], there[root] = local(spark, root, *mine), remote(spark, root, *other)
    links = [{(f"u{pick.randrange(30)}", f"u{pick.randrange(30)}") for _ in range(25)} for _ in range(2)]
    here[PARTNERS], there[PARTNERS] = (partners(spark, *sorted(pairs)) for pairs in links)
    return here, there


def content(store):
    rows = {root: by_uid(store.read(root)) for root in LIBRARY.roots}
    return rows, sorted(map(tuple, store.read(PARTNERS).distinct().collect()))


def bag(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()))


@pytest.mark.parametrize("seed, policy, marks", [(1, Policy.SERVER_WINS, True), (2, Policy.CLIENT_WINS, False)])
def test_a_delta_ends_like_the_whole(spark, tmp_path, seed, policy, marks):
    here, there = stores(spark, tmp_path)
    mine, other = random_tables(spark, seed)
    here.commit(mine, watermarks={e: at(1) for e in LIBRARY.names} if marks else None)
    there.commit(other)
    options = {"policy": policy, "push_time": at(20), "now": at(10), "on_error": "quarantine"}
    whole = sync(
        LIBRARY,
        here.tables(),
        there.tables(),
        watermarks=here.manifest().watermarks,
        local_edges={PARTNERS: here.read(PARTNERS)},
        remote_edges={PARTNERS: there.read(PARTNERS)},
        **options,
    )
    expected = (
        ({r: by_uid(t) for r, t in whole.local.items()}, sorted(map(tuple, whole.local_edges[PARTNERS].distinct().collect()))),
        ({r: by_uid(t) for r, t in whole.remote.items()}, sorted(map(tuple, whole.remote_edges[PARTNERS].distinct().collect()))),
    )
    log, errors = bag(whole.change_log, "entity", "change", "uid"), bag(whole.errors, "entity", "uid", "action")
    counters, reached = bag(whole.counters, "side", "entity", "n"), collect_watermarks(whole.watermarks, LIBRARY)
    done = sync_stores(here, there, **options)
    assert (content(here), content(there)) == expected
    assert bag(done.change_log, "entity", "change", "uid") == log and log
    assert bag(done.errors, "entity", "uid", "action") == errors and bag(done.counters, "side", "entity", "n") == counters
    assert here.manifest().watermarks == reached
    assert (done.local_version, done.remote_version) == (2, 2)
    # The log has the first of a row's changes, the feed what is left of all: the same rows, told by where they are.
    was = {u for root in LIBRARY.roots for u in by_uid(here.read(root, number=1))}
    now = {u for rows in content(here)[0].values() for u in rows}
    net = [(e, "inserted" if u not in was else "updated" if u in now else "deleted", u) for e, _, u in log if u in was | now]
    assert bag(changefeed.changes_between(here, 1, 2), "entity", "change", "uid") == sorted(net)


def many(spark, n):
    books = [{"uid": f"b{i}", "name": f"Book {i}", "author": ref("Author", f"a{i % 7}")} for i in range(n)]
    authors = [{"uid": f"a{i}"} for i in range(7)]
    return (
        {"Book": local(spark, "Book", *books), "Author": local(spark, "Author", *authors)},
        {"Book": remote(spark, "Book", *books), "Author": remote(spark, "Author", *authors)},
    )


def spoil(store, root, buckets):
    """Make the files of some buckets unreadable."""
    generations = store.manifest().roots[root]
    for bucket in buckets:
        for file in Path(f"{store.path}/data/{root}/g={generations[bucket]}/bucket={bucket}").glob("part*"):
            file.write_bytes(b"no table")


def test_only_touched_buckets_are_read_and_written(spark, tmp_path):
    here, there = stores(spark, tmp_path, buckets=64)
    mine, other = many(spark, 400)
    here.commit(mine, watermarks={e: at(0) for e in LIBRARY.names})
    there.commit(other)
    names = spark.createDataFrame([("b5",), ("b77",), ("b200",)], "uid string")
    touched_here, touched_there = here.touched(names.limit(2)), there.touched(names.filter("uid <> 'b77'"))
    edited = here.read("Book", touched_here).withColumns(
        {"name": F.when(F.col("uid").isin("b5", "b77"), "mine").otherwise(F.col("name")), "is_dirty": F.col("uid").isin("b5", "b77")}
    )
    here.commit({"Book": edited}, {"Book": touched_here})
    moved = there.read("Book", touched_there).withColumn("updated_at", F.when(F.col("uid") == "b200", F.lit(at(3))).otherwise(F.col("updated_at")))
    there.commit({"Book": moved.withColumn("name", F.when(F.col("uid") == "b200", "theirs").otherwise(F.col("name")))}, {"Book": touched_there})
    involved = here.touched(names)
    for store in (here, there):
        spoil(store, "Book", set(store.manifest().roots["Book"]) - involved)
    before = [store.manifest() for store in (here, there)]
    sync_stores(here, there, push_time=at(20), now=at(10))
    after = [store.manifest() for store in (here, there)]
    written = [{b for b, g in new.roots["Book"].items() if old.roots["Book"][b] != g} for old, new in zip(before, after)]
    assert written == [here.touched(names), there.touched(names.filter("uid <> 'b200'"))]
    assert [new.roots["Author"] == old.roots["Author"] for old, new in zip(before, after)] == [True, True]
    here_now, there_now = by_uid(here.read("Book", involved)), by_uid(there.read("Book", involved))
    assert [here_now[u]["name"] for u in ("b5", "b77", "b200")] == ["mine", "mine", "theirs"]
    assert [there_now[u]["name"] for u in ("b5", "b77", "b200")] == ["mine", "mine", "theirs"]
    assert not here_now["b5"]["is_dirty"] and there_now["b5"]["updated_at"] == at(20)


def test_nothing_to_do_makes_no_version(spark, tmp_path):
    here, there = stores(spark, tmp_path)
    mine, other = many(spark, 20)
    here.commit(mine, watermarks={e: at(0) for e in LIBRARY.names})
    there.commit(other)
    done = sync_stores(here, there, push_time=at(20), now=at(10))
    assert (done.local_version, done.remote_version, here.versions(), there.versions()) == (1, 1, [1], [1])


def test_an_error_leaves_both_stores_alone(spark, tmp_path):
    here, there = stores(spark, tmp_path)
    here.commit({"Book": local(spark, "Book", {"uid": "b1", "is_dirty": True})})
    there.commit({"Book": remote(spark, "Book", {"uid": "b2", "updated_at": at(1)})})
    with pytest.raises(SyncError):
        sync_stores(here, there, push_time=at(20), now=at(10))
    assert here.versions() == there.versions() == [1]
    done = sync_stores(here, there, push_time=at(20), now=at(10), on_error="quarantine")
    assert uids(done.errors) == ["b1"] and sorted(uids(here.read("Book"))) == ["b1", "b2"]


def test_rounds_of_syncs_and_their_feed(spark, tmp_path):
    """Three rounds, the changes between first and last equal to the logs put together."""
    here, there = stores(spark, tmp_path, buckets=4)
    here.commit({})
    there.commit({"Author": remote(spark, "Author", {"uid": "a1", "updated_at": at(1)}, {"uid": "a2", "updated_at": at(1)}),
                  "Book": remote(spark, "Book", {"uid": "b1", "author": ref("Author", "a1"), "updated_at": at(1)},
                                 {"uid": "b2", "author": ref("Author", "a9"), "updated_at": at(1)})})
    logs = [sync_stores(here, there, push_time=at(20), now=at(10)).change_log]
    rows = by_uid(there.read("Author"))
    there.merge({"Author": _after(spark, there, "Author", {**rows["a1"], "status": 3, "updated_at": at(30)},
                                  {"uid": "a3", "entity": "Author", "status": 2, "updated_at": at(30)})})
    here.merge({"Author": _after(spark, here, "Author", {"uid": "a8", "entity": "Author", **made_here(status=2)})})
    logs.append(sync_stores(here, there, push_time=at(50), now=at(40)).change_log)
    assert sorted(uids(here.read("Author"))) == ["a2", "a3", "a8", "a9"] and uids(here.read("Book")) == ["b2"]
    assert bag(logs[1], "entity", "change", "uid") == [
        ("Author", "deleted", "a1"), ("Author", "inserted", "a3"), ("Author", "updated", "a8"), ("Book", "deleted", "b1"),
    ]
    between = bag(changefeed.changes_between(here, 1, here.manifest().number), "entity", "change", "uid")
    saved = spark.createDataFrame([("Author", "inserted", "a8")], "entity string, change string, uid string")
    assert between == bag(changefeed.composed([logs[0], saved, logs[1]]), "entity", "change", "uid")
    assert ("Author", "inserted", "a2") in between and not any(u in ("a1", "b1") for _, _, u in between)

    feed = changefeed.write_changes(here, 1, here.manifest().number, str(tmp_path / "feed"))
    assert bag(feed, "entity", "change", "uid") == between
    assert {p.name for p in (tmp_path / "feed").glob("change=*")} == {"change=inserted"}


def _after(spark, store, root, *rows):
    schema = store.schema(root)
    data = [tuple(row.get(name) for name in schema.names) for row in rows]
    return spark.createDataFrame(data, schema).select("uid", F.struct(*schema.names).alias("after"))


# What the facts save


def test_an_increment_opens_only_files_that_can_match(spark, tmp_path):
    _, there = stores(spark, tmp_path, buckets=4, records_per_file=50)
    rows = [{"uid": f"b{i}", "updated_at": at(i)} for i in range(2000)]
    there.commit({"Book": remote(spark, "Book", *rows)})
    everything = len(there.read("Book").inputFiles())
    increment = there.changed_rows("Book", {e: at(1979) for e in LIBRARY.family("Book")}, at(5000))
    assert increment.count() == 20
    assert everything >= 40 and len(increment.inputFiles()) <= 8
    assert there.changed_rows("Book", None, at(5000)).count() == 2000
    assert there.changed_rows("Book", {"Book": at(1979)}, at(5000)).count() == 20  # not all entities have a mark


def test_untimed_rows_are_found(spark, tmp_path):
    _, there = stores(spark, tmp_path, buckets=4)
    rows = remote(spark, "Book", {"uid": "b1"}, {"uid": "b2"})
    there.commit({"Book": rows.withColumn("updated_at", F.when(F.col("uid") == "b1", F.col("updated_at")))})
    marks = {e: at(100) for e in LIBRARY.family("Book")}
    assert uids(there.changed_rows("Book", marks, at(200))) == ["b2"]


def test_dirty_rows_come_from_their_files(spark, tmp_path):
    here, _ = stores(spark, tmp_path)
    here.commit({"Book": local(spark, "Book", *[{"uid": f"b{i}", "is_dirty": i == 3} for i in range(200)])})
    found = here.dirty_rows("Book")
    assert uids(found) == ["b3"] and len(found.inputFiles()) == 1 < len(here.read("Book").inputFiles())


def scanned_rows(df):
    """Rows that the scan of a plan gave out: row groups that the Bloom filters ruled out give none."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    node = df._jdf.queryExecution().executedPlan()
    while node.children().nonEmpty():
        node = node.children().head()
    return node.metrics().apply("numOutputRows").value(), plan


def test_a_lookup_reads_what_its_keys_need(spark, tmp_path):
    here, _ = stores(spark, tmp_path, buckets=8)
    here.commit({"Book": local(spark, "Book", *[{"uid": f"b{i}"} for i in range(4000)])})
    few = here.lookup("Book", spark.createDataFrame([("b7",), ("b11",), (None,), ("nobody",)], "uid string"))
    assert sorted(uids(few)) == ["b11", "b7"]
    assert len(few.inputFiles()) < len(here.read("Book").inputFiles())
    wide = here.lookup("Book", spark.createDataFrame([(f"b{i}",) for i in range(0, 4000, 10)], "uid string"))
    assert sorted(uids(wide)) == sorted(f"b{i}" for i in range(0, 4000, 10))
    assert here.lookup("Book", spark.createDataFrame([], "uid string")).count() == 0
    absent = here.lookup("Book", spark.createDataFrame([("b12345",)], "uid string"))
    assert scanned_rows(absent)[0] == 0  # within the least and greatest key of the files: the filter ruled it out


def test_changes_by_kind_name_their_uids(spark):
    log = spark.createDataFrame([("Book", "updated", f"b{i}") for i in range(2500)] + [("Book", "deleted", "x")], "entity string, change string, uid string")
    pages = changes.uids_by_kind(log, page_size=1000).collect()
    assert sorted(u for p in pages if p["change"] == "updated" for u in p["uids"]) == sorted(f"b{i}" for i in range(2500))
    assert max(len(p["uids"]) for p in pages) <= 1300 and {(p["change"], p["n"]) for p in pages} == {("updated", 2500), ("deleted", 1)}


def test_a_change_set_shuffles_each_row_once_and_compares_maps_by_entries(spark):
    schema = "uid string, n int, m map<string,int>"
    before = spark.createDataFrame([("a", 1, {"x": 1, "y": 2}), ("b", 1, {"x": 1}), ("c", None, None), (None, 1, None), ("d", 2, {})], schema)
    after = spark.createDataFrame([("a", 1, {"y": 2, "x": 1}), ("b", 1, {"x": 2}), ("c", None, None), (None, 1, None), ("e", None, None)], schema)
    found = change_set(before, after)
    told = sorted(((r["uid"], r["change"], r["before"], r["after"]) for r in found.collect()), key=str)
    assert [t for t in told if t[0] is None] == [(None, "deleted", (None, 1, None), None), (None, "inserted", None, (None, 1, None))]
    assert [t for t in told if t[0] is not None] == [
        ("b", "updated", ("b", 1, {"x": 1}), ("b", 1, {"x": 2})),
        ("d", "deleted", ("d", 2, {}), None),
        ("e", "inserted", None, ("e", None, None)),
    ]
    nodes = [found._jdf.queryExecution().optimizedPlan()]
    while "Join" not in nodes[-1].nodeName():
        nodes.append(nodes[-1].children().apply(0))
    sides = [nodes[-1].children().apply(i) for i in range(2)]
    assert [side.output().size() for side in sides] == [2, 2]  # the key and the row
    assert ["uid" not in side.schema().apply(1).dataType().catalogString() for side in sides] == [True, True]
