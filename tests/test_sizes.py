"""Steps whose tasks must not grow with the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbflow.model import DeleteRule, Entity, EntityModel, Relationship, Stored
from ebbflow.operators import cascades, joins

TREE = EntityModel(
    (
        Entity(
            "Node",
            relationships=(
                Relationship("parent", "Node", inverse="children"),
                Relationship("children", "Node", True, "parent", DeleteRule.CASCADE, Stored.DERIVED),
            ),
        ),
    )
)


def test_a_walk_spreads_what_it_finds_by_the_size_of_the_edges(spark, tmp_path, monkeypatch):
    """Adaptive execution would put these rows into one partition, and into few however large they are."""
    ids = spark.range(4000)
    parent = F.when(F.col("id") > 0, F.struct(F.lit("Node").alias("entity"), F.format_string("n%d", F.col("id") % 40).alias("uid")))
    ids.select(F.format_string("n%d", "id").alias("uid"), F.lit("Node").alias("entity"), parent.alias("parent")).write.parquet(
        str(tmp_path / "nodes")
    )
    nodes = spark.read.parquet(str(tmp_path / "nodes"))
    seen, write = [], cascades._written

    def written(parts):
        seen.append({root: rows.rdd.getNumPartitions() for root, rows in parts.items()})
        return write(parts)

    monkeypatch.setattr(cascades, "_written", written)
    monkeypatch.setattr(joins, "PARTITION_BYTES", 1000)
    keys = spark.createDataFrame([("n1",)], "uid string")
    found = cascades.taken_along(TREE, {"Node": nodes}, {"Node": keys})["Node"]
    assert found.count() == 100 and found.distinct().count() == 100
    assert seen[1]["Node"] >= 8


def test_partitions_follow_what_is_read_and_not_the_product_of_a_join(spark, tmp_path, monkeypatch):
    spark.range(1000).withColumn("x", F.col("id") % 7).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    joined = rows.join(rows.withColumnRenamed("x", "y"), "id", "left")
    assert joins.read_bytes(joined) <= 2 * joins.estimated_bytes(rows) < joins.estimated_bytes(joined)
    monkeypatch.setattr(joins, "PARTITION_BYTES", 1000)
    assert joins.partitions(rows) == -(-joins.estimated_bytes(rows) // 1000)
    assert joins.spread(rows, "id").rdd.getNumPartitions() == joins.partitions(rows)


def test_a_micro_batch_of_a_large_feed_is_more_than_one_file(spark, tmp_path, monkeypatch):
    """One file is read, and its versions reduced, by one task."""
    from ebbflow.plans import streaming

    spark.range(3000).withColumn("x", F.col("id") % 7).write.parquet(str(tmp_path / "feed"))
    rows = spark.read.parquet(str(tmp_path / "feed"))
    assert streaming.dealt(rows, "id", str(tmp_path / "small")) == 1
    assert len(list((tmp_path / "small").glob("*.parquet"))) == streaming.BATCHES
    monkeypatch.setattr(streaming, "FILE_BYTES", joins.estimated_bytes(rows) // 5)
    files = streaming.dealt(rows, "id", str(tmp_path / "large"))
    assert files == 2 and len(list((tmp_path / "large").glob("*.parquet"))) == 2 * streaming.BATCHES
    assert spark.read.parquet(str(tmp_path / "large")).exceptAll(rows).isEmpty()
