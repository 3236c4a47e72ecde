"""What several operators of this subpackage share: tables, folds, the shared folder and files in it."""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StructType

from ebbflow.session import materialized, shared_dir

__all__ = ["drop", "fold", "materialized", "one_row_per_id", "open_in", "open_out", "run_folder", "scratch", "table", "tokenizer_file", "tokenizer_pattern", "with_position"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: Column, parts: int) -> Column:
    """crc32 of the key as text, modulo ``parts``; null for a null key."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(parts))


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder of this run below the shared one."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def scratch(df: DataFrame, name: str, codec: str = "zstd") -> tuple[DataFrame, str]:
    """The rows written once below the shared folder and read again; also the path, for ``drop``."""
    spark = df.sparkSession
    path = run_folder(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop(spark: SparkSession, path: str) -> None:
    """Delete a folder of this run that no later step reads."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def one_row_per_id(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, of an id that comes more than once the row with the least text (a null last), then the least
    of its other columns. Rows without an id stay. Where no id repeats, which the ids alone tell, nothing moves."""
    twice = docs.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    twice = materialized(twice.filter("_n > 1").select(key))
    if twice.isEmpty():
        return docs
    rest = [c for c in docs.columns if c != key]
    order = F.struct(F.col(text).isNull(), F.col(text), F.to_json(F.struct(*rest)))
    one = docs.join(twice, key, "left_semi").groupBy(key).agg(F.min_by(F.struct(*rest), order).alias("_row"))
    one = one.select(key, *[F.col("_row").getField(c).alias(c) for c in rest]).select(*docs.columns)
    return docs.join(twice, key, "left_anti").select(*docs.columns).unionByName(one)


def integers_as_text(df: DataFrame) -> DataFrame:
    """Whole numbers as text, on the way into pandas, which makes floats of them beside a null."""
    whole = [f.name for f in df.schema.fields if isinstance(f.dataType, IntegralType)]
    return df.withColumns({name: F.col(name).cast("string") for name in whole}) if whole else df


def integers_again(df: DataFrame, schema: StructType) -> DataFrame:
    """The way back: columns that are whole numbers in ``schema`` get its types."""
    whole = {f.name: F.col(f.name).cast(f.dataType) for f in schema.fields if isinstance(f.dataType, IntegralType) and f.name in df.columns}
    return df.withColumns(whole) if whole else df


def _located(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri.removeprefix("file:"))


def open_out(uri: str):
    """A writable binary file in the shared store, from a task; parents are made."""
    store, path = _located(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    return store.open_output_stream(path, compression=None)


def open_in(uri: str):
    """A seekable binary file of the shared store."""
    store, path = _located(uri)
    return store.open_input_file(path)


def tokenizer_file(name: str) -> str:
    """The place of a public vocabulary file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer_pattern() -> str:
    """The pattern that cuts texts before the merges of the rank files."""
    import public_tokenizers

    return public_tokenizers.PATTERN


def with_position(rows: DataFrame, *keys: str) -> DataFrame:
    """Each row's place in the order of the keys, nulls first, from 1: range partitions are sorted and written;
    a row's place is that in its partition plus the sizes of the partitions before, one number each."""
    order = [F.asc_nulls_first(k) for k in keys]
    numbered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = materialized(numbered.withColumn("_slot", F.monotonically_increasing_id()))
    slots = numbered.withColumns({"_part": F.shiftright("_slot", 33), "_slot": F.col("_slot").bitwiseAND((1 << 33) - 1)})
    sizes = slots.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    return (
        slots.join(F.broadcast(starts), "_part")  # one row per partition
        .withColumn("position", F.col("_start") + F.col("_slot") + 1)
        .drop("_part", "_slot", "_start")
    )
