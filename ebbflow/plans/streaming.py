"""The query of the stream: two feeds, each in files of mixed order, pulled into an empty store."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbflow.operators import joins
from ebbflow.plans.registry import query
from ebbflow.plans.shapes import BUYERS, FEED, FEED_MODEL, as_buyers, as_feed, table, with_ctes
from ebbflow.session import shared_dir
from ebbflow.sources.snapshots import SnapshotStore
from ebbflow.streaming.pull_stream import start_pull

#: Micro-batches that a feed is dealt out over.
BATCHES = 3
#: Bytes of a feed to a file: a micro-batch has as many files, and so tasks that read it, as its size asks for.
FILE_BYTES = 1 << 20


def dealt(rows: DataFrame, tie: str, path: str) -> int:
    """Write a feed in any order of time, versions of a row in several files; the number of files to a micro-batch."""
    size = joins.estimated_bytes(rows) or 0
    files = max(1, min(-(-size // (FILE_BYTES * BATCHES)), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    rows.repartition(BATCHES * files, F.xxhash64(tie)).write.parquet(path)
    return files


@query(
    with_ctes(
        FEED,
        BUYERS,
        body="""SELECT uid, entity, updated_at AS last_modified, event_id, value FROM (SELECT * FROM feed
    QUALIFY row_number() OVER (PARTITION BY entity, uid ORDER BY updated_at DESC, event_id DESC) = 1)
WHERE status <> 3
UNION ALL SELECT uid, entity, updated_at, order_key, price FROM (SELECT * FROM buyers
    QUALIFY row_number() OVER (PARTITION BY uid ORDER BY updated_at DESC, order_key DESC) = 1)
WHERE status <> 3""",
    )
)
def stream_pull(spark: SparkSession, sf_dir: str) -> DataFrame:
    home = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    store = SnapshotStore(spark, f"{home}/store", FEED_MODEL, buckets=8)
    feeds = {"Event": (as_feed(table(spark, sf_dir, "events")), "event_id"), "Buyer": (as_buyers(table(spark, sf_dir, "orders")), "order_key")}
    for root, (rows, tie) in feeds.items():
        files = dealt(rows, tie, f"{home}/{root}")
        feed = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(f"{home}/{root}")
        start_pull(feed, store, root, f"{home}/checkpoint-{root}", tie_break=tie).awaitTermination()
    events = store.read("Event").select("uid", "entity", "last_modified", "event_id", "value")
    buyers = store.read("Buyer").select("uid", "entity", "last_modified", F.col("order_key").alias("event_id"), F.col("price").alias("value"))
    return events.unionByName(buyers)
