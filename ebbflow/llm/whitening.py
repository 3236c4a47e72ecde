"""Whitening of embeddings by a bidiagonal qd solver.

Entries become whole numbers x, so sums and deviations are exact. Tasks reduce the centred rows of their partition,
block by block, to one triangular factor by QR; factors are stacked and reduced again, 64 to one, until a single one
is left, as wide as the vectors and no larger however many there are. Its bidiagonal form gives the singular values
and directions (``bidiagonal.py``). The covariance of the whitened rows, which tells how far they are from white,
comes together the same way: counts, means and centred products of blocks, merged 64 to one.

Defined cases: rows whose vector is null, or holds a null or an entry that is not finite, take no part. Where
vectors differ in length, those of the most frequent length take part (the longest of equally frequent ones).
Repeated rows count as often as they are there; a null id stays null. Components without variance, to rounding, are
left out, so a single vector, or equal ones, give no rows. Empty tables give no rows. Other columns are never read.
A deviation that a long cannot hold ends the job with an ArithmeticError.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbflow.llm.bidiagonal import EPS, bidiagonalised, right_singular_vectors
from ebbflow.llm.workspace import Workspace

#: x = floor(SCALE * c) + OFFSET
SCALE, OFFSET = 64, 1_000_000
#: Parts that one task merges.
MERGED = 64
#: Rows that a task reduces at a time.
BLOCK = 4096

_PART = "part long, n long, body binary"
_OUT = T.StructType(
    [
        T.StructField("component", T.IntegerType()),
        T.StructField("n", T.LongType()),
        T.StructField("deviation", T.LongType()),
        *[T.StructField(name, T.DoubleType()) for name in ("whitened", "explained", "identity_error")],
    ]
)


@dataclass(frozen=True)
class Whitening:
    """``directions`` has a column per component; ``variances`` fall; ``trace`` is the whole variance."""

    n: int
    sums: np.ndarray
    directions: np.ndarray
    variances: np.ndarray
    trace: float

    @property
    def components(self) -> int:
        return len(self.variances)


def sound(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """Rows whose vector is there and holds finite numbers only."""
    entry = F.forall(column, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vectors.filter(F.col(column).isNotNull() & entry)


def _matrix(vectors: pa.Array) -> np.ndarray:
    """The whole numbers of a batch of vectors of one length, a row each."""
    flat = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), float)
    return (np.floor(SCALE * flat) + OFFSET).astype(np.int64).reshape(len(vectors), -1)


def _sums(vectors: DataFrame, work: Workspace) -> DataFrame:
    """size, place, sum, n: exact sums by length and dimension, one row of each from a task before the shuffle."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, tuple[np.ndarray, int]] = {}
        for part in parts:
            rows = part.column(0)
            sizes = np.asarray(rows.value_lengths().to_numpy(zero_copy_only=False))
            for size in np.unique(sizes).tolist():
                own = rows.filter(pa.array(sizes == size))
                old, n = totals.get(size, (np.zeros(size, np.int64), 0))
                totals[size] = (old + _matrix(own).sum(axis=0), n + len(own)) if size else (old, n + len(own))
        for size, (total, n) in totals.items():
            columns = [np.full(size, size), np.arange(size), total, np.full(size, n)]
            names = ["size", "place", "sum", "n"]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names)

    partial = vectors.select("vector").mapInArrow(batches, "size long, place long, sum long, n long")
    return work.keep(partial.groupBy("size", "place").agg(F.sum("sum").alias("sum"), F.sum("n").alias("n")))


def _whole(parts: DataFrame, merge: Callable[[list[tuple[int, bytes]]], tuple[int, bytes]], work: Workspace) -> tuple[int, bytes]:
    """Partial results, a row per task, merged ``MERGED`` to one until a single one is left."""

    def merged(group: pd.DataFrame) -> pd.DataFrame:
        ordered = group.sort_values("part")
        n, body = merge(list(zip(ordered["n"].tolist(), ordered["body"].tolist())))
        return pd.DataFrame({"part": [int(ordered["part"].iloc[0]) // MERGED], "n": [n], "body": [body]})

    parts = work.keep(parts)
    left = parts.agg(F.max("part")).first()[0]
    while left > 0:
        parts = work.keep(parts.groupBy(F.shiftright("part", MERGED.bit_length() - 1).alias("_group")).applyInPandas(merged, _PART))
        left //= MERGED
    row = parts.first()
    return row["n"], row["body"]


def _blocks(parts: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for part in parts:
        for start in range(0, part.num_rows, BLOCK):
            yield _matrix(part.column(0).slice(start, BLOCK))


def fit(vectors: DataFrame, work: Workspace, components: int = 32) -> Whitening | None:
    """Learn from all rows; ``vectors`` has a sound ``vector`` column. None where there is nothing to learn from."""
    sums = _sums(vectors, work)
    size = sums.groupBy("size").agg(F.max("n").alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    if size is None:
        return None
    own = sorted(sums.filter(F.col("size") == size["size"]).collect())  # a row per dimension
    n, total = size["n"], np.array([r["sum"] for r in own])
    width = len(total)

    def factors(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = np.zeros((0, width)), 0
        for block in _blocks(parts):
            held = np.linalg.qr(np.vstack([held, (n * block - total) / n]), mode="r")
            rows += len(block)
        if rows:
            yield _part(rows, held.tobytes())

    def stacked(group: list[tuple[int, bytes]]) -> tuple[int, bytes]:
        together = np.vstack([np.frombuffer(body).reshape(-1, width) for _, body in group])
        return sum(rows for rows, _ in group), np.linalg.qr(together, mode="r").tobytes()

    _, body = _whole(of_width(vectors, width).select("vector").mapInArrow(factors, _PART), stacked, work)
    factor = np.zeros((width, width))
    rows = np.frombuffer(body).reshape(-1, width)
    factor[: len(rows)] = rows
    diagonal, above, right = bidiagonalised(factor)
    squares, inner = right_singular_vectors(diagonal, above)
    solid = squares > (max(n, width) * EPS) ** 2 * max(squares[0], np.finfo(float).tiny)
    kept = min(components, int(solid.sum()))
    directions = right @ inner[:, :kept]
    directions *= np.sign(directions[np.abs(directions).argmax(axis=0), np.arange(kept)])
    return Whitening(n, total, directions, squares[:kept] / n, float(squares.sum() / n))


def of_width(vectors: DataFrame, width: int) -> DataFrame:
    return vectors.filter(F.size("vector") == width)


def _part(n: int, body: bytes) -> pa.RecordBatch:
    number = TaskContext.get().partitionId()
    return pa.RecordBatch.from_arrays(
        [pa.array([number], pa.int64()), pa.array([n], pa.int64()), pa.array([body], pa.binary())], ["part", "n", "body"]
    )


def _whitened(block: np.ndarray, model: Whitening) -> tuple[np.ndarray, np.ndarray]:
    """Whitened rows, and the exact deviations n*x - S."""
    off = model.n * block - model.sums
    return off / model.n @ model.directions / np.sqrt(model.variances), off


def identity_error(vectors: DataFrame, model: Whitening, work: Workspace) -> float:
    """The largest entry, in size, of the whitened rows' covariance minus the identity."""
    width, shape = model.components, (model.components, model.components)

    def unpacked(body: bytes) -> tuple[np.ndarray, np.ndarray]:
        numbers = np.frombuffer(body)
        return numbers[:width], numbers[width:].reshape(shape)

    def merged(group: list[tuple[int, bytes]]) -> tuple[int, bytes]:
        rows, mean, products = 0, np.zeros(width), np.zeros(shape)
        for n, body in group:
            own_mean, own = unpacked(body)
            apart = own_mean - mean
            products = products + own + np.outer(apart, apart) * (rows * n / (rows + n))
            mean = mean + apart * (n / (rows + n))
            rows += n
        return rows, np.concatenate([mean, products.ravel()]).tobytes()

    def moments(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, bytes]] = []
        for block in _blocks(parts):
            white = _whitened(block, model)[0]
            mean = white.mean(axis=0)
            white = white - mean
            body = np.concatenate([mean, (white.T @ white).ravel()]).tobytes()
            held = [merged([*held, (len(block), body)])]
        if held:
            yield _part(*held[0])

    rows, body = _whole(of_width(vectors, len(model.sums)).select("vector").mapInArrow(moments, _PART), merged, work)
    return float(np.abs(unpacked(body)[1] / rows - np.eye(width)).max())


def transform(vectors: DataFrame, model: Whitening, error: float, key: str = "vec_id") -> DataFrame:
    """key, component, n, deviation, whitened, explained, identity_error: a row per vector and component."""
    numbers = np.arange(1, model.components + 1, dtype=np.int32)
    explained = model.variances / model.trace
    schema = T.StructType([vectors.schema[key], *_OUT.fields])

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for start in range(0, part.num_rows, BLOCK):
                own = part.slice(start, BLOCK)
                white, off = _whitened(_matrix(own.column(1)), model)
                if float(np.abs(off).max()) ** 2 * off.shape[1] >= 2.0**63:
                    raise ArithmeticError("a deviation does not fit a long")
                rows, times = white.shape
                columns = [
                    own.column(0).take(pa.array(np.repeat(np.arange(rows), times))),
                    pa.array(np.tile(numbers, rows)),
                    pa.array(np.full(rows * times, model.n)),
                    pa.array(np.repeat((off * off).sum(axis=1), times)),
                    pa.array(white.ravel()),
                    pa.array(np.tile(explained, rows)),
                    pa.array(np.full(rows * times, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return of_width(vectors, len(model.sums)).select(key, "vector").mapInArrow(batches, schema)


def whiten(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", components: int = 32) -> DataFrame:
    """Learn from all vectors and whiten them all; see ``transform`` for the columns."""
    spark = vectors.sparkSession
    rows = sound(vectors.select(key, F.col(column).cast("array<double>").alias("vector")), "vector")
    with Workspace(spark, "whitening") as work:
        model = fit(rows, work, components)
        if model is None or not model.components:
            return spark.createDataFrame([], T.StructType([vectors.schema[key], *_OUT.fields]))
        error = identity_error(rows, model, work)
    return transform(rows, model, error, key)
