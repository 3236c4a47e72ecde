"""The two joins everything else is made of, safe when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot from this many rows on, if it also holds more than a piece of all rows.
HOT_ROWS = 1_000_000
# Pieces of the rows that fall to one shuffle partition on average: a hot key gets as many salts as it fills pieces.
PIECES = 8
# Pieces that all rows are cut in at most, which bounds the sketch; keys below one piece are left to AQE's skewed joins.
MOST_PIECES = 2048


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of the plan, or None where the session cannot tell."""
    if not hasattr(df, "_jdf"):
        return None
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def broadcast_limit(df: DataFrame) -> int:
    """The session's broadcast threshold in bytes."""
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()
    for suffix, factor in (("kb", 1 << 10), ("mb", 1 << 20), ("gb", 1 << 30), ("k", 1 << 10), ("m", 1 << 20), ("g", 1 << 30), ("b", 1)):
        if text.endswith(suffix):
            return int(text[: -len(suffix)]) * factor
    return int(text)


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the estimated size is within the session's broadcast threshold."""
    size = estimated_bytes(df)
    return size is not None and size <= broadcast_limit(df)


def is_small_beside(batch: DataFrame, table: DataFrame) -> bool:
    """Whether a batch can be broadcast and the table is so much larger that reading it again beats a shuffle."""
    size, beside = estimated_bytes(batch), estimated_bytes(table)
    return size is not None and size <= broadcast_limit(batch) and 4 * size <= beside


def pieces(rows: DataFrame) -> int:
    return min(PIECES * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), MOST_PIECES)


#: Estimated bytes of rows to a partition where a step says how many there are.
PARTITION_BYTES = 4 << 20
# What Catalyst says of rows whose size it cannot tell is far above this.
UNKNOWN_BYTES = 1 << 50


def read_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate, but no more than all that the plan reads: the estimate of a join is a product."""
    size = estimated_bytes(df)
    if size is None:
        return None
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return min(size, sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())))


def spread(rows: DataFrame, *columns: str) -> DataFrame:
    """The rows by the given columns over partitions in proportion to their size, no fewer than the session's.

    Adaptive execution puts small partitions together till they fill a share of the cluster, by their compressed size,
    so a task's sorts and hash tables would grow with the input; a given number it leaves as it is.
    """
    return rows.repartition(partitions(rows), *columns)


def partitions(rows: DataFrame) -> int:
    least, size = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), read_bytes(rows)
    known = size is not None and size < UNKNOWN_BYTES
    return max(least, -(-size // PARTITION_BYTES) if known else 0)


def _has_key(key: Sequence[str]) -> Column:
    return reduce(and_, [F.col(name).isNotNull() for name in key])


def heavy_keys(rows: DataFrame, key: Sequence[str], hot_rows: int | None = None) -> DataFrame:
    """``_item``, the hash of a hot key, and ``_salts``, in proportion to its rows.

    One pass with a sketch of frequent items, a bounded one from each task; the keys themselves are not shuffled. A
    key is hot if it fills more than one of the ``pieces`` of all rows, so there are no more than that many.
    """
    n = pieces(rows)
    items = rows.filter(_has_key(key)).select(F.xxhash64(*key).alias("_item"))
    top = F.expr(f"approx_top_k(_item, {n}, {4 * n})").alias("_top")
    sketch = items.agg(F.count(F.lit(1)).alias("_all"), top)
    found = sketch.select("_all", F.explode("_top").alias("_found"))
    share = F.col("_found.count") * F.lit(n) / F.col("_all")
    hot = (F.col("_found.count") >= (HOT_ROWS if hot_rows is None else hot_rows)) & (share > 1)
    return found.filter(hot).select(F.col("_found.item").alias("_item"), F.ceil(share).cast("int").alias("_salts"))


def join_unique(
    rows: DataFrame,
    targets: DataFrame,
    key: str | Sequence[str],
    how: str,
    spread_by: str | Sequence[str],
    *,
    hot_rows: int | None = None,
    force_salting: bool = False,
    sized: bool = False,
) -> DataFrame:
    """Join many rows to targets that have at most one row per key (left, inner, semi or anti).

    Small targets are left to Spark, which broadcasts them. Otherwise both sides are shuffled, and rows of a hot
    key, or with no key at all, are spread by ``spread_by``, a column of ``rows`` with many values, over as many
    salts as their share of all rows asks for; only the targets of hot keys are copied, once per salt. ``sized``
    shuffles to partitions in proportion to the rows, see ``spread``.
    """
    key = [key] if isinstance(key, str) else list(key)
    spread = [spread_by] if isinstance(spread_by, str) else list(spread_by)
    if not force_salting and fits_broadcast(targets):
        return rows.join(targets, key, how)

    hot = F.broadcast(heavy_keys(rows, key, hot_rows))  # a row for each piece at most
    item = F.xxhash64(*key)
    salts = F.when(_has_key(key), F.coalesce("_salts", F.lit(1))).otherwise(F.lit(pieces(rows)))
    salted_rows = (
        rows.withColumn("_item", item)
        .join(hot, "_item", "left")
        .withColumn("_salt", F.pmod(F.xxhash64(*spread), salts).cast("int"))
        .drop("_item", "_salts")
    )
    copies = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    salted_targets = (
        targets.withColumn("_item", item).join(hot, "_item", "left").withColumn("_salt", F.explode(copies)).drop("_item", "_salts")
    )
    if sized:
        salted_rows = salted_rows.repartition(partitions(rows), *key, "_salt")
    return salted_rows.join(salted_targets, [*key, "_salt"], how).drop("_salt")


def narrowed(table: DataFrame, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """The rows of a table that a small batch can meet, found without a shuffle; of a large batch, all."""
    if not is_small_beside(batch.select(*key), table):
        return table
    return table.join(F.broadcast(batch.select(*key)), list(key), "left_semi")


def prefixed(df: DataFrame, prefix: str, key: Sequence[str]) -> DataFrame:
    """Every column but the key under a prefix; plain columns, so that pruning still works."""
    return df.select(*key, *[F.col(c).alias(prefix + c) for c in df.columns if c not in key])


def side_by_side(table: DataFrame, batch: DataFrame, key: Sequence[str], prefix: str = "_new_") -> DataFrame:
    """Full outer join of a table with a batch, both unique on the key.

    The batch's columns carry ``prefix``; ``_old`` and ``_new`` tell which sides are there. A batch within
    the broadcast threshold, beside a much larger table, leaves the table where it is; any other shuffles
    both sides once.
    """
    old = table.withColumn("_old", F.lit(True))
    new = prefixed(batch, prefix, key).withColumn("_new", F.lit(True))
    if is_small_beside(batch, table):
        touched = old.join(F.broadcast(new), list(key), "left")
        added = new.join(narrowed(table.select(*key), batch, key), list(key), "left_anti")
        both = touched.unionByName(added, allowMissingColumns=True)
    else:
        both = old.join(new, list(key), "full")
    return both.withColumns({c: F.coalesce(F.col(c), F.lit(False)) for c in ("_old", "_new")})
