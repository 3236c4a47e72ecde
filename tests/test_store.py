from __future__ import annotations

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from ebbflow.operators import pull
from ebbflow.session import materialized, shared_dir
from ebbflow.operators.sync import sync
from ebbflow.sources.snapshots import MEMBERS, Manifest, SnapshotStore
from ebbflow.streaming.pull_stream import apply_batch, apply_members, start_pull
from tests.library import FIRST, LIBRARY, at, by_uid, local, ref, remote, table, uids


@pytest.fixture
def store(spark, tmp_path):
    return SnapshotStore(spark, str(tmp_path / "store"), LIBRARY, buckets=8)


def books(spark, *numbers, **values):
    return local(spark, "Book", *[{"uid": f"b{i}", "name": f"Book#{i}", **values} for i in numbers])


def test_an_empty_store_has_empty_tables(store):
    assert store.versions() == [] and store.read("Book").count() == 0
    assert store.read("Book").columns == LIBRARY.local_schema("Book").names


def test_commit_and_read_back(spark, store):
    assert store.commit({"Book": books(spark, *range(50)), "Author": local(spark, "Author", {"uid": "a1"})}) == 1
    assert by_uid(store.read("Book")) == by_uid(books(spark, *range(50)))
    assert store.tables()["Author"].count() == 1 and store.tables()["Page"].count() == 0


def test_a_commit_writes_only_touched_buckets(spark, store):
    store.commit({"Book": books(spark, *range(50))})
    before = store.manifest().roots["Book"]
    old_reader = store.read("Book")
    touched = store.touched(books(spark, 3))
    assert len(touched) == 1
    changed = store.read("Book", touched).withColumn("name", F.when(F.col("uid") == "b3", "changed").otherwise(F.col("name")))
    store.commit({"Book": changed}, {"Book": touched})
    after = store.manifest().roots["Book"]
    assert {b for b in before if before[b] != after[b]} == touched
    now = by_uid(store.read("Book"))
    assert len(now) == 50 and now["b3"]["name"] == "changed" and now["b4"]["name"] == "Book#4"
    assert by_uid(old_reader)["b3"]["name"] == "Book#3"
    assert by_uid(store.read("Book", number=1))["b3"]["name"] == "Book#3"


def test_a_bucket_that_empties_is_forgotten(spark, store):
    store.commit({"Book": books(spark, 1)})
    touched = store.touched(books(spark, 1))
    store.commit({"Book": books(spark)}, {"Book": touched})
    assert store.manifest().roots["Book"] == {} and store.read("Book").count() == 0


def test_two_writers_cannot_make_the_same_version(spark, store):
    store.commit({"Book": books(spark, 1)})
    with pytest.raises(RuntimeError):
        store._publish(Manifest(number=1, buckets=8))


def test_reset_forgets_rows_and_positions(spark, store):
    store.commit({"Book": books(spark, 1)}, watermarks={"Book": at(5)}, batches={"Book/": 3})
    assert store.manifest().watermarks == {"Book": at(5)}
    store.reset(keep_watermarks=True)
    assert store.read("Book").count() == 0 and store.manifest().watermarks == {"Book": at(5)}
    store.reset()
    assert store.manifest().watermarks == {} and store.manifest().batches == {}


def test_expired_versions_leave_used_folders(spark, store):
    store.commit({"Book": books(spark, *range(20))})
    for number in (1, 2, 3):
        touched = store.touched(books(spark, number))
        store.commit({"Book": store.read("Book", touched)}, {"Book": touched})
    store.expire(keep=1)
    assert store.versions() == [4] and store.read("Book").count() == 20
    used = set(store.manifest().roots["Book"].values())
    assert {n.removeprefix("g=") for n in store._names(f"{store.path}/data/Book")} == used


def test_a_store_opens_under_a_newer_model(spark, tmp_path):
    old = SnapshotStore(spark, str(tmp_path / "s"), FIRST, buckets=4)
    rows = [{"uid": "b1", "entity": "Book", "status": 2, "is_dirty": False, "created_remotely": True, "name": "Old"}]
    old.commit({"Book": table(spark, FIRST.local_schema("Book"), rows)})
    new = SnapshotStore(spark, str(tmp_path / "s"), LIBRARY, buckets=4)
    row = by_uid(new.read("Book"))["b1"]
    assert row["name"] == "Old" and row["createdDate"] is None and row["format"] is None


def test_written_tables_are_the_same_for_every_reader(spark):
    rows = materialized(spark.range(100).withColumn("r", F.rand()))
    assert [tuple(r) for r in rows.orderBy("id").collect()] == [tuple(r) for r in rows.orderBy("id").collect()]
    assert shared_dir(spark) == shared_dir(spark)


# The stream


def feed_files(spark, folder, batches):
    """One file of remote books per micro-batch."""
    for number, rows in enumerate(batches):
        remote(spark, "Book", *rows).coalesce(1).write.parquet(f"{folder}/part{number}")
    return spark.readStream.schema(remote(spark, "Book").schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/part*")


def test_a_stream_of_batches_ends_like_one_pull(spark, store, tmp_path):
    pick = random.Random(5)
    clock, batches = 0, []
    for _ in range(4):
        rows = []
        for _ in range(30):
            clock += 1
            uid = "b0" if pick.random() < 0.3 else f"b{pick.randrange(25)}"
            rows.append({"uid": uid, "name": f"v{clock}", "status": pick.choice([2, 2, 2, 3]), "updated_at": at(clock)})
        batches.append(rows)
    known = books(spark, *range(0, 40, 3), last_modified=at(-1))
    store.commit({"Book": known})
    query = start_pull(feed_files(spark, tmp_path / "feed", batches), store, "Book", str(tmp_path / "checkpoint"))
    query.awaitTermination()

    expected = known
    for rows in batches:
        incoming = pull.decode_rows(pull.latest_version(remote(spark, "Book", *rows)), LIBRARY, "Book")
        expected = materialized(pull.apply_pull(expected, incoming).local)
    assert by_uid(store.read("Book")) == by_uid(expected)
    assert list(store.manifest().batches.values()) == [len(batches) - 1] and store.manifest().watermarks == {"Book": at(clock)}
    assert len(store.versions()) == 1 + len(batches)

    again = start_pull(feed_files_again(spark, tmp_path / "feed"), store, "Book", str(tmp_path / "checkpoint"))
    again.awaitTermination()
    assert len(store.versions()) == 1 + len(batches)


def feed_files_again(spark, folder):
    return spark.readStream.schema(remote(spark, "Book").schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/part*")


def test_a_batch_delivered_twice_is_applied_once(spark, store):
    rows = remote(spark, "Book", {"uid": "b1", "updated_at": at(1)})
    assert apply_batch(store, "Book", rows, 0) and not apply_batch(store, "Book", rows, 0)
    assert store.versions() == [1]


def test_rows_in_mixed_order_end_the_same(spark, store):
    book = lambda uid, n, status=2: remote(spark, "Book", {"uid": uid, "status": status, "updated_at": at(n), "name": f"v{n}"})
    for number, (uid, n, status) in enumerate([("b1", 9, 2), ("b2", 3, 2), ("b1", 4, 2), ("b2", 8, 3), ("b2", 5, 2), ("b3", 7, 3), ("b3", 6, 2)]):
        assert apply_batch(store, "Book", book(uid, n, status), number)
    assert {u: r["name"] for u, r in by_uid(store.read("Book")).items()} == {"b1": "v9"}
    assert uids(spark.read.parquet(f"{store.path}/late/Book/stream=/batch=2")) == ["b1"]
    assert store.manifest().watermarks == {"Book": at(9)}
    apply_batch(store, "Book", book("b2", 10), 7)
    assert sorted(uids(store.read("Book"))) == ["b1", "b2"]


def final(store):
    rows = store.read("Book", clock=True).drop("is_dirty", "created_remotely")
    gone = store.read("Book.gone", clock=True).select("uid", "last_modified", "_tie_number", "_digest")
    return sorted(map(str, rows.collect())), sorted(map(str, gone.collect()))


def test_any_cut_and_order_of_a_feed_ends_the_same(spark, tmp_path):
    """Versions with the same time, some with the same tie break too, and deletes among them."""
    pick = random.Random(11)
    rows = [
        {"uid": f"b{pick.randrange(6)}", "name": f"v{i}", "status": pick.choice([2, 2, 3]), "updated_at": at(pick.randrange(5))}
        for i in range(60)
    ]
    ties = [i % 3 for i in range(60)]
    ends = []
    for number, cuts in enumerate(([60], [20, 60], [7, 60])):
        order = list(range(60))
        pick.shuffle(order)
        store = SnapshotStore(spark, str(tmp_path / f"s{number}"), LIBRARY, buckets=4)
        for i, (start, end) in enumerate(zip([0, *cuts], cuts)):
            some = order[start:end]
            batch = remote(spark, "Book", *[{**rows[j], "uid": rows[j]["uid"], "format": str(ties[j])} for j in some])
            apply_batch(store, "Book", batch.withColumn("tie", F.col("format").cast("int")).drop("format"), i, tie_break="tie")
        ends.append(final(store))
    assert ends[0] == ends[1] == ends[2] and ends[0][0] and ends[0][1]


def test_of_versions_with_one_time_the_tie_break_decides(spark, store):
    def version(name, tie):
        return remote(spark, "Book", {"uid": "b1", "name": name, "updated_at": at(1)}).withColumn("tie", F.lit(tie))

    for number, (name, tie) in enumerate([("v2", 2), ("v1", 1), ("v10", 10), ("v10", 10)]):
        apply_batch(store, "Book", version(name, tie), number, tie_break="tie")
    assert by_uid(store.read("Book"))["b1"]["name"] == "v10"
    assert spark.read.parquet(f"{store.path}/late/Book/stream=/batch=1").count() == 1
    assert spark.read.parquet(f"{store.path}/late/Book/stream=/batch=3").count() == 0


def test_a_version_that_a_pull_has_read_is_not_read_again(spark, store):
    store.commit({"Book": books(spark, 1, last_modified=at(1), is_dirty=True)})
    apply_batch(store, "Book", remote(spark, "Book", {"uid": "b1", "name": "remote", "updated_at": at(1)}), 0)
    assert by_uid(store.read("Book"))["b1"]["name"] == "Book#1"


def test_deletions_are_forgotten_behind_the_slowest_stream(spark, store):
    def batch(*rows):
        return remote(spark, "Book", *[{"uid": u, "status": s, "updated_at": at(t)} for u, s, t in rows])

    day = timedelta(seconds=10)
    others = [f"c{i}" for i in range(30)]  # in every bucket
    apply_batch(store, "Book", batch(("b1", 3, 1), ("b2", 2, 1), *[(u, 2, 51) for u in others]), 0, stream="a", keep_deleted=day)
    apply_batch(store, "Book", batch(("b3", 2, 2), *[(u, 2, 1) for u in others]), 0, stream="slow", keep_deleted=day)
    assert uids(store.read("Book.gone")) == ["b1"]  # the slow stream may still bring an older version
    apply_batch(store, "Book", batch(("d", 2, 60)), 1, stream="slow", keep_deleted=day)
    apply_batch(store, "Book", batch(("b1", 2, 0), ("b2", 2, 3), *[(u, 2, 61) for u in others]), 1, stream="a", keep_deleted=day)
    now = by_uid(store.read("Book"))
    assert "b1" not in now and now["b2"]["last_modified"] == at(3)
    assert uids(store.read("Book.gone")) == []
    assert uids(spark.read.parquet(f"{store.path}/late/Book/stream=a/batch=1")) == ["b1"]


def test_rows_with_faults_of_their_own_are_errors(spark, store):
    rows = remote(
        spark,
        "Book",
        {"uid": "b1", "updated_at": at(1)},
        {"uid": "b2", "updated_at": at(1), "author": {"entity": None, "uid": "a1"}},
        {"uid": "b3", "updated_at": at(1), "author": ref("Ghost", "g1")},
        {"uid": "b4", "updated_at": at(1)},
    ).withColumn("status", F.when(F.col("uid") != "b4", F.col("status")))
    apply_batch(store, "Book", rows, 0)
    assert uids(store.read("Book")) == ["b1"]
    found = spark.read.parquet(f"{store.path}/errors/Book/stream=/batch=0")
    assert {r["uid"]: r["fault"] for r in found.collect()} == {
        "b2": "error_malformed_reference", "b3": "error_unknown_target", "b4": "error_missing_value",
    }


def test_a_removal_in_the_stream_takes_edges_along(spark, store):
    pairs = [("u1", "u2"), ("u2", "u3"), ("u3", "u1"), ("u4", "u3")]
    edges = spark.createDataFrame([(a, "Publisher", b) for a, b in pairs], "src_uid string, dst_entity string, dst_uid string")
    store.commit({"Publisher": local(spark, "Publisher", *[{"uid": f"u{i}"} for i in range(1, 5)]), "Publisher.partners": edges})
    apply_batch(store, "Publisher", remote(spark, "Publisher", {"uid": "u3", "status": 3, "updated_at": at(2)}), 0)
    assert sorted(uids(store.read("Publisher"))) == ["u1", "u2", "u4"]
    assert [(r["src_uid"], r["dst_uid"]) for r in store.read("Publisher.partners").collect()] == [("u1", "u2")]


def members(spark, *rows):
    """uid, second, uids of members."""
    data = [(u, at(t), [ref("Publisher", m) for m in found]) for u, t, found in rows]
    return spark.createDataFrame(data, MEMBERS)


def links(store):
    return sorted((r["src_uid"], r["dst_uid"]) for r in store.read("Publisher.partners").collect())


def test_rows_and_members_in_any_order_end_like_a_pull(spark, tmp_path):
    """Two orders of the same rows and members, against the sync that reads all at once."""
    versions = [("u1", 1, ["u2"]), ("u2", 1, ["u1", "u9"]), ("u1", 5, ["u2", "u3"]), ("u3", 2, []), ("u2", 4, ["u3"]), ("u4", 3, ["u4"])]
    steps = [("row", i) for i in range(len(versions))] + [("members", i) for i in range(len(versions))]
    found = []
    for number in range(2):
        store = SnapshotStore(spark, str(tmp_path / f"s{number}"), LIBRARY, buckets=2)
        random.Random(number).shuffle(steps)
        counts = {"row": 0, "members": 0}
        for start in range(0, len(steps), 6):
            for kind in ("row", "members"):
                some = [versions[i] for k, i in steps[start : start + 6] if k == kind]
                if kind == "row" and some:
                    batch = remote(spark, "Publisher", *[{"uid": u, "name": f"{u}@{t}", "updated_at": at(t)} for u, t, _ in some])
                    apply_batch(store, "Publisher", batch, counts[kind])
                elif some:
                    apply_members(store, "Publisher.partners", members(spark, *some), counts[kind])
                counts[kind] += 1
        found.append((links(store), {u: (r["name"], r["status"]) for u, r in by_uid(store.read("Publisher")).items()}))
        assert store.read("Publisher.partners.waiting").count() == 0
    there = remote(spark, "Publisher", *[{"uid": u, "name": f"{u}@{t}", "updated_at": at(t)} for u, t, _ in versions[2:]])
    edges = spark.createDataFrame([(u, "Publisher", m) for u, t, ms in versions[2:] for m in ms], "src_uid string, dst_entity string, dst_uid string")
    whole = sync(LIBRARY, {"Publisher": local(spark, "Publisher")}, {"Publisher": there}, push_time=at(20), now=at(10),
                 remote_edges={"Publisher.partners": edges})
    expected = sorted((r["src_uid"], r["dst_uid"]) for r in whole.local_edges["Publisher.partners"].collect())
    rows = {u: (r["name"], r["status"]) for u, r in by_uid(whole.local["Publisher"]).items()}
    for edges_found, rows_found in found:
        assert edges_found == expected
        # A version that was there for a while may have left a placeholder for what it referred to.
        assert {u: r for u, r in rows_found.items() if u in rows} == rows and set(rows_found) <= {*rows, "u9"}


def test_members_wait_for_their_version(spark, store):
    row = lambda t, status=2: remote(spark, "Publisher", {"uid": "u1", "status": status, "updated_at": at(t)})
    apply_members(store, "Publisher.partners", members(spark, ("u1", 3, ["u2"])), 0)
    assert links(store) == [] and uids(store.read("Publisher")) == []
    apply_batch(store, "Publisher", row(1), 0)
    assert links(store) == []
    apply_batch(store, "Publisher", row(3), 1)
    assert links(store) == [("u1", "u2")] and {u: r["status"] for u, r in by_uid(store.read("Publisher")).items()} == {"u1": 2, "u2": 1}
    assert apply_members(store, "Publisher.partners", members(spark, ("u1", 1, ["u7"])), 1)
    assert not apply_members(store, "Publisher.partners", members(spark, ("u1", 3, [])), 1)
    assert links(store) == [("u1", "u2")]
    assert spark.read.parquet(f"{store.path}/late/Publisher.partners/stream=/batch=1").count() == 1
    faulty = spark.createDataFrame([("u1", at(9), [{"entity": None, "uid": "x"}]), (None, at(1), [])], MEMBERS)
    apply_members(store, "Publisher.partners", faulty, 2)
    assert spark.read.parquet(f"{store.path}/errors/Publisher.partners/stream=/batch=2").count() == 2


def test_rows_that_no_table_can_take_are_errors(spark, store):
    rows = remote(spark, "Book", {"uid": "b1", "updated_at": at(1)}, {"uid": "x", "entity": "Ghost"}, {"uid": "b2", "updated_at": at(1)})
    rows = rows.withColumn("updated_at", F.when(F.col("uid") != "b2", F.col("updated_at")))
    apply_batch(store, "Book", rows, 0)
    assert uids(store.read("Book")) == ["b1"]
    assert sorted(uids(spark.read.parquet(f"{store.path}/errors/Book/stream=/batch=0"))) == ["b2", "x"]


def test_streams_count_their_batches_apart(spark, store):
    one = remote(spark, "Book", {"uid": "b1", "updated_at": at(1)})
    assert apply_batch(store, "Author", remote(spark, "Author", {"uid": "a1", "updated_at": at(1)}), 0)
    assert apply_batch(store, "Book", one, 0) and apply_batch(store, "Book", one, 0, stream="other")
    assert not apply_batch(store, "Book", one, 0)
    store.reset()
    assert apply_batch(store, "Book", one, 0) and uids(store.read("Book")) == ["b1"]


def test_a_stream_follows_references_and_delete_rules(spark, store):
    store.commit(
        {
            "Author": local(spark, "Author", {"uid": "a1"}),
            "Book": local(spark, "Book", *[{"uid": f"b{i}", "author": ref("Author", "a1")} for i in range(6)], {"uid": "z"}),
            "Page": local(spark, "Page", {"uid": "p1", "book": ref("Book", "b1")}, {"uid": "p2"}),
            "Magazine": local(spark, "Magazine", {"uid": "m1", "authors": [ref("Author", "a1"), ref("Author", "a9")]}),
        }
    )
    apply_batch(store, "Book", remote(spark, "Book", {"uid": "n1", "author": ref("Author", "a7"), "updated_at": at(1)}), 0)
    authors = by_uid(store.read("Author"))
    assert (authors["a7"]["status"], authors["a7"]["created_remotely"]) == (1, True) and "a1" in authors
    apply_batch(store, "Author", remote(spark, "Author", {"uid": "a1", "status": 3, "updated_at": at(2)}), 0)
    assert sorted(uids(store.read("Book"))) == ["n1", "z"] and uids(store.read("Page")) == ["p2"]
    assert by_uid(store.read("Magazine"))["m1"]["authors"] == [ref("Author", "a9")]
    assert uids(store.read("Author")) == ["a7"]
