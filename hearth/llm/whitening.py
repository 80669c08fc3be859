"""Operator 12: whitening of embeddings with distributed block matrices.

Components become integers, so that what is fitted is exact up to the centring.  Rows are packed
where they are read into blocks of rows, which get consecutive numbers, and so every row
an index; the first row of each distinct vector is the fit list.  Centred fit rows (zeros for
the others) are the row blocks of a ``BlockMatrix``; its transpose times itself is the
scatter, a matrix of the vectors' own width, which is decomposed on the driver.  The centred
blocks of the whole table, as a ``BlockMatrix`` too, times the whitening matrix are the projections.

The middle dimension of the transposed product (the rows) is split, so each task multiplies
a few row blocks and sums of products are merged.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import Scratch, reach_workers, tidied

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
#: Rows and columns of a block; row blocks that one task multiplies.
BLOCK_ROWS, BLOCK_COLS, BLOCKS_A_TASK = 1_024, 1_024, 8


@dataclass
class Whitening:
    """What was fitted: rows of the fit list, sums, and the components with a variance above
    rounding, by falling eigenvalue (columns of ``axes``)."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    axes: np.ndarray
    explained: np.ndarray


def integer_vectors(vectors: DataFrame, scale: float, shift: int, key: str, vector: str) -> DataFrame:
    """``vec_id, x`` of the rows with a vector of finite components, as long as most of them (the
    shorter length on a tie)."""
    v = F.col("v")
    rows = (vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
            .where(v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))))
    widths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("v") == (widths["d"] if widths else 0)).select(
        "vec_id", F.transform(v, lambda c: F.floor(c * F.lit(float(scale))) + F.lit(shift)).alias("x"))


def numbered_blocks(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """``block, ids, x``: the rows ``vec_id, x`` in blocks of up to BLOCK_ROWS, each from one partition, as the
    raw integers of its vectors one after another.  A block's number is its place in its partition plus the blocks
    of earlier partitions (one row a partition reaches the driver)."""
    size = BLOCK_ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, held = TaskContext.get().partitionId(), 0, []

        def block() -> pa.RecordBatch:
            ids, x = (pa.concat_arrays([h.column(i) for h in held]) for i in (0, 1))
            return pa.record_batch({"part": pa.array([part], pa.int32()), "at": pa.array([at], pa.int32()),
                                    "ids": pa.array([ids.to_pylist()], pa.list_(pa.int64())),
                                    "x": pa.array([x.flatten().to_numpy().astype("<i8").tobytes()], pa.binary())})

        for batch in batches:
            lo = 0
            while lo < batch.num_rows:
                held.append(batch.slice(lo, size - sum(h.num_rows for h in held)))
                lo += held[-1].num_rows
                if sum(h.num_rows for h in held) == size:
                    yield block()
                    at, held = at + 1, []
        if held:
            yield block()

    packed = scratch.write(rows.select("vec_id", "x").mapInArrow(tidied(run), "part int, at int, ids array<long>, x binary")).df
    sizes = sorted(packed.groupBy("part").count().collect())
    before = np.cumsum([0, *(r["count"] for r in sizes)]).tolist()
    starts = rows.sparkSession.createDataFrame([(r["part"], b) for r, b in zip(sizes, before)], "part int, _before long")
    return packed.join(F.broadcast(starts), "part").select((F.col("_before") + F.col("at")).alias("block"), "ids", "x")


def first_places(blocks: DataFrame, width: int) -> DataFrame:
    """``block, places``: where the first row of each distinct vector stands, by the index of rows.  Vectors
    meet as digests, a hot one counted before it is shuffled."""
    size = BLOCK_ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                raw = batch.column(1)[i].as_buffer().to_pybytes()
                rows = len(raw) // (8 * width)
                yield pa.record_batch({
                    "index": pa.array(batch.column(0)[i].as_py() * size + np.arange(rows)),
                    "digest": pa.array([hashlib.sha256(raw[r * 8 * width:(r + 1) * 8 * width]).digest() for r in range(rows)], pa.binary())})

    firsts = blocks.select("block", "x").mapInArrow(tidied(run), "index long, digest binary").groupBy("digest").agg(F.min("index").alias("index"))
    # at most BLOCK_ROWS places a block
    return firsts.groupBy(F.floor(F.col("index") / size).alias("block")).agg(
        F.collect_list((F.col("index") % size).cast("int")).alias("places"))


def _vectors(raw: bytes, width: int) -> np.ndarray:
    return np.frombuffer(raw, "<i8").reshape(-1, width)


def column_sums(blocks: DataFrame, width: int) -> tuple[int, np.ndarray]:
    """How many fit rows there are and the exact sum of each entry (one row an entry reaches the driver)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(width, np.int64), 0
        for batch in batches:
            for i in range(batch.num_rows):
                places = batch.column(1)[i].as_py()
                total += _vectors(batch.column(0)[i].as_buffer(), width)[places].sum(axis=0)
                n += len(places)
        yield pa.record_batch({"at": pa.array(np.arange(-1, width), pa.int32()), "part": pa.array(np.concatenate([[n], total]))})

    parts = (blocks.where("places is not null").select("x", "places").mapInArrow(tidied(run), "at int, part long")
             .groupBy("at").agg(F.sum("part").alias("total")))
    n, *total = [r.total for r in sorted(parts.collect())] or [0] * (width + 1)
    return n, np.array(total, np.int64)


def block_matrix(blocks: DataFrame, count: int, width: int, n: int, sums: np.ndarray, fitted: bool) -> BlockMatrix:
    """The centred rows of ``count`` blocks as row blocks of full height; with ``fitted``, rows outside of the fit
    list are zeros, as is what fills a block up."""
    tall, wide = BLOCK_ROWS, min(BLOCK_COLS, width)

    def run(row) -> list:
        x = _vectors(bytes(row["x"]), width)
        full = np.zeros((tall, width))
        if fitted:
            full[row["places"]] = (n * x[row["places"]] - sums) / n
        else:
            full[:len(x)] = (n * x - sums) / n
        return [((row["block"], j // wide), Matrices.dense(tall, len(range(j, min(j + wide, width))), full[:, j:j + wide].ravel(order="F")))
                for j in range(0, width, wide)]

    rows = blocks.where("places is not null") if fitted else blocks
    return BlockMatrix(rows.select("block", "x", "places").rdd.flatMap(run), tall, wide, count * tall, width)


def scatter(rows: BlockMatrix) -> np.ndarray:
    """The transpose times the matrix, with the middle dimension split over tasks (an argument that the Scala
    method has and the Python one lacks)."""
    splits = max(1, -(-rows.numRows() // (BLOCK_ROWS * BLOCKS_A_TASK)))
    model = rows.transpose()._java_matrix_wrapper.call("multiply", rows._java_matrix_wrapper._java_model, splits)
    width = rows.colsPerBlock
    return BlockMatrix(model, width, width).toLocalMatrix().toArray()


def fit(blocks: DataFrame, count: int, width: int, components: int) -> Whitening:
    """Fits the fit list of ``blocks(block, x, places)``, ``count`` of them."""
    n, sums = column_sums(blocks, width)
    covariance = scatter(block_matrix(blocks, count, width, n, sums, True)) / n
    values, axes = np.linalg.eigh((covariance + covariance.T) / 2)
    values, axes = values[::-1], axes[:, ::-1]
    trace = covariance.trace()
    sure = int(np.count_nonzero(values > max(values[0], 0) * len(values) * np.finfo(float).eps))
    kept = min(components, sure)
    return Whitening(n, sums, values[:kept], axes[:, :kept], values[:kept] / trace if kept else values[:0])


def project(blocks: DataFrame, count: int, width: int, model: Whitening) -> DataFrame:
    """``block, z``: the rows of each block times the whitening matrix, as raw numbers row by row."""
    spark = blocks.sparkSession
    left = block_matrix(blocks, count, width, model.n, model.sums, False)
    matrix, tall, wide = model.axes / np.sqrt(model.values), left.colsPerBlock, len(model.values)
    parts = [((i // tall, 0), Matrices.dense(len(p), wide, p.ravel(order="F")))
             for i in range(0, len(matrix), tall) for p in (matrix[i:i + tall],)]
    right = BlockMatrix(spark.sparkContext.parallelize(parts, 1), tall, wide)
    rows = left.multiply(right).blocks.map(lambda b: (b[0][0], bytearray(np.ascontiguousarray(b[1].toArray()).tobytes())))
    return spark.createDataFrame(rows, "block long, z binary")


def rows_of(blocks: DataFrame, width: int, wide: int, model: Whitening) -> DataFrame:
    """``vec_id, deviation, fitted, whitened`` of each row of ``blocks(ids, x, places, z)``."""
    n, sums = model.n, model.sums

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, x = batch.column(0)[i].values, _vectors(batch.column(1)[i].as_buffer(), width)
                reach = np.abs(n * x - sums).max(axis=1).astype(float)
                if (reach * reach * width >= 2.0**63).any():
                    raise OverflowError("a deviation beyond 64 bits")
                z = np.frombuffer(batch.column(3)[i].as_buffer()).reshape(-1, wide)[:len(x)]
                fitted = np.zeros(len(x), bool)
                fitted[batch.column(2)[i].as_py() or []] = True
                yield pa.record_batch({
                    "vec_id": ids, "deviation": pa.array(((n * x - sums) ** 2).sum(axis=1)), "fitted": pa.array(fitted),
                    "whitened": pa.ListArray.from_arrays(pa.array(np.arange(0, z.size + 1, wide), pa.int32()), pa.array(z.ravel()))})

    return blocks.select("ids", "x", "places", "z").mapInArrow(tidied(run), "vec_id long, deviation long, fitted boolean, whitened array<double>")


def identity_error(rows: DataFrame, n: int, wide: int) -> float:
    """Largest entry, by size, of the covariance of ``rows(whitened)`` minus the identity; the
    means come first, and tasks sum products of centred rows (``wide`` squared numbers each)."""

    def summed(mean: np.ndarray | None) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = 0.0
            for batch in batches:
                z = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, wide)
                total = total + (z.sum(axis=0) if mean is None else ((z - mean).T @ (z - mean)).ravel())
            if np.ndim(total):
                yield pa.record_batch({"at": pa.array(np.arange(len(total)), pa.int32()), "part": pa.array(total)})

        parts = rows.select("whitened").mapInArrow(tidied(run), "at int, part double").groupBy("at").agg(F.sum("part").alias("total"))
        return np.array([r.total for r in sorted(parts.collect())]) / n

    return float(np.abs(summed(summed(None)).reshape(wide, wide) - np.eye(wide)).max())


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: float = SCALE, shift: int = SHIFT,
           key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for each row of
    ``vectors`` and component.

    Rows whose vector is null or empty, holds null or non-finite entries or has another length
    than most are dropped; null and repeated keys are kept, and equal vectors are fitted once.  Components
    whose eigenvalue is rounding only (fewer distinct vectors than dimensions, constant entries) are left out, so a table
    of one distinct vector, like an empty one, gives no rows.  Integers beyond 64 bits fail: ``deviation`` holds
    while n times an entry's distance from its mean stays under 2^31 or so."""
    spark, scratch = vectors.sparkSession, Scratch(vectors.sparkSession)
    reach_workers(spark)
    rows = integer_vectors(vectors, scale, shift, key, vector)
    empty = spark.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    raw = numbered_blocks(rows, scratch)
    some = raw.select(F.octet_length("x") / F.size("ids") / 8).first()
    if some is None:
        return empty
    width = int(some[0])
    blocks = scratch.write(raw.join(first_places(raw, width), "block", "left")).df
    count = blocks.count()
    model = fit(blocks, count, width, components)
    if not len(model.values):
        return empty
    done = scratch.write(rows_of(blocks.join(project(blocks, count, width, model), "block"), width, len(model.values), model)).df
    error = identity_error(done.where("fitted"), model.n, len(model.values))
    share = F.array(*[F.lit(float(e)) for e in model.explained])
    return (done.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
                    share[F.col("at")].alias("explained"), F.lit(error).alias("identity_error")))
