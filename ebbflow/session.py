"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

_own_dirs: dict[str, str] = {}

T = TypeVar("T")

#: Jobs that a step hands to Spark at a time; each is planned by the driver and shares the executors with the others.
AT_ONCE = 6


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Settings for a session of our own (tests, bench); a cluster's session is left as it is."""
    return (
        builder.config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir`` where the cluster names one.

    Only a session on one machine may fall back to a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _own_dirs:
        _own_dirs[application] = tempfile.mkdtemp(prefix="ebbflow-")
    return _own_dirs[application]


def materialized(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Write the rows to the shared folder once, so that several readers see the same rows.

    A written table cuts the lineage as a checkpoint does, outlives executors, and can be read by column
    and by partition; its size is known, so joins with it are planned by that and not by an estimate.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    writer = df.write if partition_by is None else df.write.partitionBy(partition_by)
    writer.parquet(path)
    types = df.schema
    return spark.read.schema(types).parquet(path).select(*df.columns)


def together(jobs: Mapping[str, Callable[[], T]]) -> dict[str, T]:
    """Independent jobs run side by side; small ones cost little but their planning, which then overlaps."""
    if len(jobs) < 2:
        return {name: job() for name, job in jobs.items()}
    with ThreadPoolExecutor(AT_ONCE) as pool:
        running = {name: pool.submit(job) for name, job in jobs.items()}
        return {name: job.result() for name, job in running.items()}


def materialized_all(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Every table written once, side by side."""
    return together({name: (lambda rows=rows: materialized(rows)) for name, rows in tables.items()})


def materialized_parts(df: DataFrame, column: str) -> dict[str, DataFrame]:
    """The rows written by the values of a text column, which is a name; each value's rows without it.

    The values are read from the folders that were written, not from the rows.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.partitionBy(column).parquet(path)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    names = [s.getPath().getName() for s in folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(folder)]
    kinds = df.drop(column).schema
    values = sorted(n.removeprefix(f"{column}=") for n in names if n.startswith(f"{column}="))
    return {value: spark.read.schema(kinds).parquet(f"{path}/{column}={value}") for value in values}
