"""The shape of the plans that decide whether a job survives large tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ebbflow.model import KEY
from ebbflow.operators import fetch, joins, pull, push, relations
from ebbflow.operators.push import Policy
from tests.library import LIBRARY, at


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """A local and a remote table of books, as files."""
    folder = tmp_path_factory.mktemp("plans")
    ids = spark.range(20000)
    key = [F.concat(F.lit("b"), F.sha1(F.col("id").cast("string"))).alias("uid"), F.lit("Book").alias("entity")]
    name = F.sha2(F.col("id").cast("string"), 256).alias("name")
    author = F.struct(F.lit("Author").alias("entity"), F.concat(F.lit("a"), F.col("id") % 50).alias("uid")).alias("author")
    status = F.lit(2).cast("short").alias("status")
    ids.select(
        *key, status, pull.ntz(at(0)).alias("last_modified"), (F.col("id") < 20).alias("is_dirty"),
        F.lit(True).alias("created_remotely"), name, author,
    ).coalesce(1).write.parquet(str(folder / "local"))
    ids.select(*key, status, (pull.ntz(at(0)) + F.make_dt_interval(secs=F.col("id"))).alias("updated_at"), name, author).write.parquet(
        str(folder / "remote")
    )
    return spark.read.parquet(str(folder / "local")), spark.read.parquet(str(folder / "remote"))


@pytest.fixture
def threshold(spark):
    """Small enough that only small batches are broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "500KB")
    yield joins.broadcast_limit(spark.range(1))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sizes_are_read_in_any_unit(spark):
    for text, size in (("60KB", 61440), ("10485760", 10485760), ("10MB", 10485760), ("1g", 1 << 30), ("-1", -1), ("12b", 12)):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", text)
        assert joins.broadcast_limit(spark.range(1)) == size
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")


def test_the_size_of_a_plan_is_known(spark, stored):
    assert joins.estimated_bytes(spark.range(10).select("id")) == 80
    assert joins.fits_broadcast(spark.range(10)) and joins.estimated_bytes(stored[0]) > 500_000


def test_a_push_plan_shuffles_each_side_once(stored, threshold):
    local, remote = stored
    plan = plan_of(push.push_plan(local, remote, Policy.SERVER_WINS))
    assert plan.count("Exchange hashpartitioning") == 2
    assert "name" not in plan and "author" not in plan


def test_a_full_pull_shuffles_each_side_once(stored, threshold):
    local, remote = stored
    incoming = pull.decode_rows(pull.increment(remote, None, at(1e6), full=True), LIBRARY, "Book")
    plan = plan_of(pull.apply_pull(local, incoming).local)
    assert plan.count("Exchange hashpartitioning") == 2 and "FullOuter" in plan


def test_a_small_increment_leaves_the_table_where_it_is(spark, stored, threshold, tmp_path):
    local, remote = stored
    pull.decode_rows(pull.increment(remote, {"Book": at(19900)}, at(1e6)), LIBRARY, "Book").coalesce(1).write.parquet(str(tmp_path / "i"))
    incoming = spark.read.parquet(str(tmp_path / "i"))
    assert joins.fits_broadcast(incoming) and not joins.fits_broadcast(local)
    result = pull.apply_pull(local, incoming).local
    assert "FullOuter" not in plan_of(result)
    branch = plan_of(result).split("SortMergeJoin")[0]
    assert "BroadcastHashJoin" in branch and "Exchange hashpartitioning" not in branch
    assert result.count() == 20000 and result.filter(F.col("last_modified") > pull.ntz(at(19900))).count() == 99


def test_a_small_push_leaves_the_remote_where_it_is(spark, stored, threshold, tmp_path):
    local, remote = stored
    push.dirty(local).coalesce(1).write.parquet(str(tmp_path / "d"))
    pending = spark.read.parquet(str(tmp_path / "d"))
    plan = plan_of(push.push_plan(pending, remote, Policy.CLIENT_WINS))
    assert "LeftSemi" in plan and "BroadcastHashJoin" in plan


def test_a_fetch_reads_only_what_it_shows(stored):
    local, _ = stored
    rows = fetch.fetch_objects(local, LIBRARY, "Book", F.col("name") > "f").select("uid", "name")
    rows.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = plan_of(rows)
    rows.sparkSession.conf.unset("spark.sql.maxMetadataStringLength")
    scan = plan[plan.index("FileScan") :]
    assert "author" not in scan[: scan.index("Batched")]
    assert "EqualTo(status,2)" in plan and "GreaterThan(name,f)" in plan
    assert "TakeOrderedAndProject" in plan_of(fetch.cut(local, [fetch.Order("name")], limit=10, offset=5).select("uid"))


def test_a_page_of_rows_looks_for_its_targets_only(stored, threshold):
    local, _ = stored
    targets = local.withColumn("uid", F.concat(F.lit("a"), F.substring("name", 1, 2)))
    plan = plan_of(fetch.fetch_objects(local, LIBRARY, "Book", order=[fetch.Order("name")], limit=10, targets={"author": targets}))
    assert "LeftSemi" in plan and "_salt" not in plan


def test_large_targets_are_joined_with_salt(stored, threshold):
    local, _ = stored
    plan = plan_of(relations.resolve_to_one(local, "author", local))
    assert "_salt" in plan and "SortMergeJoin" in plan
    few = local.limit(5)
    assert "_salt" not in plan_of(relations.resolve_to_one(local, "author", few))
    assert KEY == ("entity", "uid")
