"""Versions of a store's tables in one folder: data first, then the manifest that makes it current.

    <path>/data/<root>/g=<generation>/bucket=<n>/*.parquet
    <path>/versions/<number>.json

Rows are spread over buckets by uid. A commit writes new folders for the buckets it touched and never
changes a folder that a reader may be using; the manifest tells which generation each bucket is at. One writer at a
time.

The manifest also keeps facts of every file: rows, dirty rows, and the least and greatest time. A scan for dirty rows or
for changes since a time opens only the files that can hold some. Files of a remote store are cut in the order of
their time, so that what changed last lies together. A file holds up to ``records_per_file`` rows, which bounds the
number of facts by rows over that number plus the buckets. Parquet keeps a Bloom filter of the keys of a local
store's row groups, by which a lookup of a few keys leaves out row groups of the buckets it opens.

Edge tables (src_uid, dst_entity, dst_uid) of relationships stored as relations are tables of a store as well, named
``Entity.relationship`` and spread by ``src_uid``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbflow.model import ACCESS, REFERENCE, EntityModel, Stored, relaxed
from ebbflow.operators import pull
from ebbflow.operators.joins import fits_broadcast
from ebbflow.session import together


#: Beside a root's table: keys of rows that the remote deleted, and when, for streams that see older rows later.
GONE = ".gone"


#: Beside an edge table: members that came before the version of their source that has them.
WAITING = ".waiting"

MEMBERS = T.StructType(
    [
        T.StructField("src_uid", T.StringType()),
        T.StructField("updated_at", T.TimestampNTZType()),
        T.StructField("members", T.ArrayType(REFERENCE)),
    ]
)

EDGES = T.StructType([T.StructField(name, T.StringType()) for name in ("src_uid", "dst_entity", "dst_uid")])

#: What a stream keeps of a version's clock beside its time.
CLOCK = T.StructType(
    [
        T.StructField("_tie_number", T.DecimalType(38, 9)),
        T.StructField("_tie_text", T.StringType()),
        T.StructField("_digest", T.StringType()),
    ]
)

#: Keys that a lookup names one by one to the Bloom filters; more are found by their buckets.
NAMED_KEYS = 50


@dataclass(frozen=True)
class FileFacts:
    """What a commit knows of a file it wrote; times are null where no row has one."""

    name: str
    rows: int
    dirty: int
    untimed: int
    least: datetime | None
    greatest: datetime | None

    def dumps(self) -> list:
        times = [None if t is None else t.isoformat(timespec="microseconds") for t in (self.least, self.greatest)]
        return [self.name, self.rows, self.dirty, self.untimed, *times]

    @staticmethod
    def loads(raw: list) -> FileFacts:
        return FileFacts(*raw[:4], *[None if t is None else datetime.fromisoformat(t) for t in raw[4:]])


@dataclass
class Manifest:
    """``batches``: the last micro-batch applied, by root and stream; ``positions``: the greatest time each of them
    has seen; ``files``: facts by table and bucket."""

    number: int = 0
    batches: dict[str, int] = field(default_factory=dict)
    buckets: int = 0
    roots: dict[str, dict[int, str]] = field(default_factory=dict)
    watermarks: dict[str, datetime] = field(default_factory=dict)
    files: dict[str, dict[int, list[FileFacts]]] = field(default_factory=dict)
    positions: dict[str, datetime] = field(default_factory=dict)

    def dumps(self) -> str:
        return json.dumps(
            {
                "number": self.number,
                "batches": self.batches,
                "buckets": self.buckets,
                "roots": self.roots,
                "watermarks": {e: at.isoformat(timespec="microseconds") for e, at in self.watermarks.items()},
                "positions": {d: at.isoformat(timespec="microseconds") for d, at in self.positions.items()},
                "files": {t: {b: [f.dumps() for f in facts] for b, facts in at.items()} for t, at in self.files.items()},
            }
        )

    @staticmethod
    def loads(text: str) -> Manifest:
        raw = json.loads(text)
        return Manifest(
            number=raw["number"],
            batches=raw["batches"],
            buckets=raw["buckets"],
            roots={root: {int(b): g for b, g in at.items()} for root, at in raw["roots"].items()},
            watermarks={e: datetime.fromisoformat(at) for e, at in raw["watermarks"].items()},
            positions={d: datetime.fromisoformat(at) for d, at in raw.get("positions", {}).items()},
            files={
                t: {int(b): [FileFacts.loads(f) for f in facts] for b, facts in at.items()}
                for t, at in raw.get("files", {}).items()
            },
        )


class SnapshotStore:
    """Read and commit the root and edge tables of a model below ``path``, a folder all executors share.

    ``side`` is ``"local"`` or ``"remote"`` and decides the columns of root tables.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        model: EntityModel,
        buckets: int = 64,
        side: str = "local",
        records_per_file: int = 1_000_000,
    ) -> None:
        if side not in ("local", "remote"):
            raise ValueError("side is 'local' or 'remote'")
        self.spark = spark
        self.path = path.rstrip("/")
        self.model = model
        self.side = side
        self._buckets = buckets
        self._records_per_file = records_per_file

    # Tables

    def is_edges(self, name: str) -> bool:
        return "." in name and not name.endswith((GONE, WAITING))

    def key_of(self, name: str) -> str:
        """The column by which a table's rows are spread."""
        return "src_uid" if self.is_edges(name) or name.endswith(WAITING) else "uid"

    def time_of(self, name: str) -> str | None:
        if self.is_edges(name) or name.endswith(WAITING):
            return None
        return "updated_at" if self.side == "remote" else "last_modified"

    def schema(self, name: str) -> T.StructType:
        if self.is_edges(name):
            return EDGES
        if name.endswith(WAITING):
            return MEMBERS
        root = name.removesuffix(GONE)
        if self.side == "local":
            return relaxed(self.model.local_schema(root))
        return relaxed(self.model.remote_schema(root).add("acl", ACCESS))

    def edge_names(self) -> list[str]:
        """Names of the edge tables that the model can have."""
        return [
            f"{entity}.{r.name}"
            for entity in self.model.names
            for r in self.model[entity].relationships
            if r.stored is Stored.RELATION
        ]

    # Files, through the file system the path belongs to

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        fs = self._fs()
        if not fs.exists(self._path(folder)):
            return []
        return [status.getPath().getName() for status in fs.listStatus(self._path(folder))]

    def versions(self) -> list[int]:
        names = self._names(f"{self.path}/versions")
        return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json"))

    def manifest(self, number: int | None = None) -> Manifest:
        """The current version's manifest, or an earlier one's."""
        if number is None:
            numbers = self.versions()
            if not numbers:
                return Manifest(buckets=self._buckets)
            number = numbers[-1]
        stream = self._fs().open(self._path(f"{self.path}/versions/{number:012d}.json"))
        try:
            return Manifest.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, manifest: Manifest) -> None:
        fs = self._fs()
        final = self._path(f"{self.path}/versions/{manifest.number:012d}.json")
        if fs.exists(final):
            raise RuntimeError(f"version {manifest.number} was committed by another writer")
        draft = self._path(f"{self.path}/versions/.{manifest.number:012d}.{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        out.write(bytearray(manifest.dumps(), "utf-8"))
        out.close()
        if not fs.rename(draft, final):
            raise RuntimeError(f"version {manifest.number} was committed by another writer")

    # Rows

    def bucket_of(self, uid: Column | None = None, buckets: int | None = None) -> Column:
        column = F.col("uid") if uid is None else uid
        return F.pmod(F.xxhash64(column), F.lit(self.manifest().buckets if buckets is None else buckets)).cast("int")

    def touched(self, keys: DataFrame) -> set[int]:
        """Buckets that hold the given uids: at most as many as there are buckets."""
        return {row[0] for row in keys.select(self.bucket_of().alias("bucket")).distinct().collect()}

    def read(
        self, root: str, buckets: Iterable[int] | None = None, number: int | None = None, clock: bool = False
    ) -> DataFrame:
        """A table, or some of its buckets; columns that older files lack are null. ``clock`` adds the clocks that a
        stream keeps with its rows."""
        at = self.manifest(number).roots.get(root, {})
        wanted = at if buckets is None else [b for b in buckets if b in at]
        return self._opened(root, [f"g={at[b]}/bucket={b}" for b in sorted(wanted)], clock)

    def _opened(self, name: str, paths: list[str], clock: bool = False) -> DataFrame:
        """Rows of folders or files below a table's own folder."""
        schema = self.schema(name)
        if clock:
            schema = T.StructType([*schema.fields, *CLOCK.fields])
        if not paths:
            return self.spark.createDataFrame([], schema)
        base = f"{self.path}/data/{name}"
        reader = self.spark.read.schema(schema).option("basePath", base)
        return reader.parquet(*[f"{base}/{path}" for path in paths]).select(*schema.names)

    def _where(self, name: str, holds: Callable[[FileFacts], bool]) -> DataFrame:
        """Rows of the files whose facts pass; buckets without facts, of older commits, are read whole."""
        manifest = self.manifest()
        facts = manifest.files.get(name, {})
        paths = []
        for bucket, generation in sorted(manifest.roots.get(name, {}).items()):
            folder = f"g={generation}/bucket={bucket}"
            if bucket in facts:
                paths += [f"{folder}/{file.name}" for file in facts[bucket] if holds(file)]
            else:
                paths.append(folder)
        return self._opened(name, paths)

    def dirty_rows(self, root: str) -> DataFrame:
        """Rows to be pushed, from the files that hold some."""
        return self._where(root, lambda file: file.dirty > 0).filter("is_dirty")

    def changed_rows(
        self, root: str, watermarks: Mapping[str, datetime] | None, now: datetime, full: bool = False
    ) -> DataFrame:
        """Rows of a pull's increment, and rows without a time, from the files that can hold some."""
        family = self.model.family(root)
        lowest = None
        if watermarks and not full and all(entity in watermarks for entity in family):
            lowest = min(watermarks[entity] for entity in family)

        def holds(file: FileFacts) -> bool:
            if file.untimed:
                return True
            return file.least is not None and file.least < now and (lowest is None or file.greatest > lowest)

        rows = self._where(root, holds)
        return pull.increment(rows, watermarks, now, full, family).unionByName(rows.filter(F.col("updated_at").isNull()))

    def touched_all(self, keys: Mapping[str, DataFrame]) -> dict[str, set[int]]:
        """Buckets that hold the given uids, by table, found in one job."""
        touched: dict[str, set[int]] = {name: set() for name in keys}
        if not keys:
            return touched
        buckets = self.manifest().buckets
        parts = [rows.select(F.lit(name).alias("name"), self.bucket_of(buckets=buckets).alias("bucket")) for name, rows in keys.items()]
        for row in reduce(DataFrame.unionByName, parts).distinct().collect():
            touched[row["name"]].add(row["bucket"])
        return touched

    def lookup_all(self, keys: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        """Rows of the given keys, ``uid`` columns by table, from their buckets only; one job finds all buckets."""
        touched, found = self.touched_all(keys), {}
        for name, rows in keys.items():
            column = self.key_of(name)
            wanted = rows.select(F.col("uid").alias(column)).distinct()
            wanted = F.broadcast(wanted) if fits_broadcast(wanted) else wanted
            found[name] = self.read(name, touched[name]).join(wanted, column, "left_semi")
        return found

    def lookup(self, name: str, keys: DataFrame) -> DataFrame:
        """Rows of the given keys, a ``uid`` column, from their buckets only.

        Up to ``NAMED_KEYS`` keys are named to the scan, whose Bloom filters then leave out row groups.
        """
        column = self.key_of(name)
        keys = keys.select(F.col("uid").alias(column)).distinct()
        few = [row[0] for row in keys.limit(NAMED_KEYS + 1).collect()]
        if not few:
            return self.read(name, [])
        if len(few) <= NAMED_KEYS:
            buckets = self.touched(self.spark.createDataFrame([(k,) for k in few], "uid string"))
            named = [F.col(column).isNull() if key is None else F.col(column) == key for key in few]
            return self.read(name, buckets).filter(reduce(or_, named))
        rows = self.read(name, self.touched(keys.select(F.col(column).alias("uid"))))
        return rows.join(F.broadcast(keys) if fits_broadcast(keys) else keys, column, "left_semi")

    def tables(self) -> dict[str, DataFrame]:
        return {root: self.read(root) for root in self.model.roots}

    def commit(
        self,
        tables: Mapping[str, DataFrame],
        touched: Mapping[str, Iterable[int]] | None = None,
        watermarks: Mapping[str, datetime] | None = None,
        batches: Mapping[str, int] | None = None,
        positions: Mapping[str, datetime] | None = None,
    ) -> int:
        """Write tables and make them current; the new version's number.

        With ``touched`` a table holds all rows of those buckets and other buckets stay; without, it
        replaces the root as a whole.
        """
        current = self.manifest()
        number = current.number + 1
        roots, files = dict(current.roots), dict(current.files)
        generations = {root: f"{number:012d}-{uuid.uuid4().hex[:8]}" for root in tables}
        folders = {root: f"{self.path}/data/{root}/g={generation}" for root, generation in generations.items()}
        together(
            {root: (lambda root=root: self._write(root, tables[root], folders[root], current.buckets)) for root in tables}
        )
        for root, folder in list(folders.items()):
            names = self._names(folder)
            written = {int(n.removeprefix("bucket=")): generations[root] for n in names if n.startswith("bucket=")}
            replaced = touched.get(root) if touched is not None else None
            kept = {} if replaced is None else {b: g for b, g in roots.get(root, {}).items() if b not in set(replaced)}
            roots[root] = {**kept, **written}
            files[root] = {b: facts for b, facts in files.get(root, {}).items() if b in kept}
            if not written:
                del folders[root]
        for root, bucket, facts in self._facts(folders):
            files[root].setdefault(bucket, []).append(facts)
        self._publish(
            Manifest(
                number=number,
                batches={**current.batches, **(batches or {})},
                buckets=current.buckets,
                roots=roots,
                watermarks={**current.watermarks, **(watermarks or {})},
                files=files,
                positions={**current.positions, **(positions or {})},
            )
        )
        return number

    def _write(self, name: str, table: DataFrame, folder: str, buckets: int) -> None:
        key = self.key_of(name)
        rows = table.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
        order = [c for c in ("updated_at", "entity", key) if c in table.columns]
        writer = rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", *order).write.partitionBy("bucket")
        writer = writer.option("maxRecordsPerFile", self._records_per_file)
        if self.side == "local":
            writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
            writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
        writer.parquet(folder)

    def _facts(self, folders: Mapping[str, str]) -> list[tuple[str, int, FileFacts]]:
        """Facts of all files just written, in one job over their few control columns; a row per file comes back."""
        parts = []
        for name, folder in folders.items():
            time = self.time_of(name)
            kinds = self.schema(name)
            wanted = [c for c in ("is_dirty", time) if c in kinds.names] if time else [self.key_of(name)]
            fields = [kinds[c] for c in wanted] + [T.StructField("bucket", T.IntegerType())]
            rows = self.spark.read.schema(T.StructType(fields)).parquet(folder)
            at = F.col(time) if time else F.lit(None).cast("timestamp_ntz")
            dirty = F.col("is_dirty") if "is_dirty" in wanted else F.lit(False)
            parts.append(
                rows.select(
                    F.lit(name).alias("name"),
                    "bucket",
                    F.col("_metadata.file_name").alias("file"),
                    F.coalesce(dirty, F.lit(False)).cast("long").alias("dirty"),
                    at.alias("at"),
                    F.lit(1 if time else 0).alias("timed"),
                )
            )
        if not parts:
            return []
        found = reduce(DataFrame.unionByName, parts).groupBy("name", "bucket", "file")
        found = found.agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum("dirty").alias("dirty"),
            F.sum(F.when(F.col("at").isNull(), F.col("timed")).otherwise(0)).alias("untimed"),
            F.min("at").alias("least"),
            F.max("at").alias("greatest"),
        )
        return [
            (r["name"], r["bucket"], FileFacts(r["file"], r["rows"], r["dirty"], r["untimed"], r["least"], r["greatest"]))
            for r in found.orderBy("name", "bucket", "file").collect()
        ]

    def merge(
        self,
        changes: Mapping[str, DataFrame],
        watermarks: Mapping[str, datetime] | None = None,
    ) -> int:
        """Copy on write: buckets that hold changed keys are written anew with the changes, all others stay.

        A change of a root table has ``uid`` and ``after``, the new row as a struct, null where the row goes. One of an
        edge table has ``uid``, the source, and ``after``, its members as an array of structs.
        """
        tables, touched = {}, self.touched_all(changes)
        for name, rows in changes.items():
            if not touched[name]:
                continue
            key, clock = self.key_of(name), not self.is_edges(name) and self.side == "local"
            keys = rows.select(F.col("uid").alias(key))
            held = self.read(name, touched[name], clock=clock)
            kept = held.join(keys, key, "left_anti").select(*held.columns)
            if self.is_edges(name):
                new = rows.select("uid", F.explode("after").alias("_member")).select(
                    F.col("uid").alias("src_uid"), "_member.dst_entity", "_member.dst_uid"
                )
            else:
                new = rows.filter(F.col("after").isNotNull()).select("after.*")
            tables[name] = kept.unionByName(new, allowMissingColumns=True)
        return self.commit(tables, touched, watermarks=watermarks)

    def reset(self, keep_watermarks: bool = False) -> int:
        """Start empty. The sync positions and the numbers of micro-batches go too, or the next pull would miss all
        that was read before."""
        current = self.manifest()
        watermarks = current.watermarks if keep_watermarks else {}
        self._publish(
            Manifest(current.number + 1, buckets=current.buckets, watermarks=watermarks)
        )
        return current.number + 1

    def expire(self, keep: int = 2) -> None:
        """Delete all but the last ``keep`` versions, and the folders that none of those uses."""
        numbers = self.versions()
        kept = [self.manifest(n) for n in numbers[-keep:]]
        fs = self._fs()
        for number in numbers[:-keep]:
            fs.delete(self._path(f"{self.path}/versions/{number:012d}.json"), False)
        for root in [*self.model.roots, *[top + GONE for top in self.model.roots]] + [
            name for edges in self.edge_names() for name in (edges, edges + WAITING)
        ]:
            used = {g for m in kept for g in m.roots.get(root, {}).values()}
            for name in self._names(f"{self.path}/data/{root}"):
                if name.removeprefix("g=") not in used:
                    fs.delete(self._path(f"{self.path}/data/{root}/{name}"), True)
