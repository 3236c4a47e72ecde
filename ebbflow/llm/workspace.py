"""Intermediate tables of one run of an operator, below the shared folder, deleted together when the result stands."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession

from ebbflow.llm.common import drop, run_folder


class Workspace:
    """``with Workspace(spark, "name") as work``: tables kept through ``work.keep`` go when the block ends, and the
    driver forgets the shuffles that made them, whose files on the executors go then."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.folder = run_folder(spark, name)
        self._tables = 0
        self._paths: dict[int, tuple[DataFrame, str]] = {}

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_: object) -> None:
        drop(self.spark, self.folder)
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def keep(self, rows: DataFrame) -> DataFrame:
        """The rows written once and read again, which cuts the lineage."""
        path = f"{self.folder}/{self._tables}"
        self._tables += 1
        rows.write.option("compression", "zstd").parquet(path)
        kept = self.spark.read.schema(rows.schema).parquet(path)
        self._paths[id(kept)] = (kept, path)
        return kept

    def drop(self, kept: DataFrame | None) -> None:
        """A kept table that no later step reads."""
        if kept is not None and id(kept) in self._paths:
            drop(self.spark, self._paths.pop(id(kept))[1])
