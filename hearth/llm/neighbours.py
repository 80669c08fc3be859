"""Operator 4: approximate nearest neighbours by multi-index hashing.

*Codes.*  A rotation learnt on a bounded sample (iterative quantisation: centred principal
axes, turned so that signs lose least) gives every vector a binary code.  *Radius.*  On the
sample, the Hamming distances between vectors and their true nearest neighbours show the
radius that holds ``hold`` of them; in the full table neighbours are nearer, so it holds more.
*Index.*  Codes are cut into substrings of 16 bits, each with a table of buckets.  Codes within
radius r differ from the query's by at most r / m in one of m substrings (pigeonhole), so the
buckets that near in each table hold every code within the radius; their rows' full codes
are compared, and those within the radius are ranked by the cosine of the floats.

Every row is indexed, in blocks of ``block_rows`` inside tasks; queries are broadcast in
blocks of ``query_bytes``.  A task sends the best few rows of each query, never pairs.
Queries that find fewer than asked within the radius are asked again with the whole length of
the code as radius, which is an exact search.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearth.llm.common import reach_workers, tidied, Scratch

BITS = 64
PIECE = 16
SAMPLE = 4_096
TRIED = 512
HOLD = 0.98
ROUNDS = 30
BLOCK_ROWS = 65_536
QUERY_BYTES = 16 << 20
_ONES = np.array([bin(i).count("1") for i in range(1 << 8)], np.uint8)
_ONES = (_ONES[np.arange(1 << 16) & 255] + _ONES[np.arange(1 << 16) >> 8]).astype(np.uint8)


@dataclass
class Coder:
    """Vector -> binary code, as pieces of 16 bits."""

    mean: np.ndarray
    turn: np.ndarray

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        bits = (unit - self.mean) @ self.turn > 0
        return np.packbits(bits, axis=1, bitorder="little").view("<u2")


def fit_coder(sample: np.ndarray, bits: int = BITS, rounds: int = ROUNDS) -> Coder:
    """Learns the rotation.  Codes longer than the vectors take several rotations, each from
    its own start; shorter ones the first principal axes."""
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    mean, d = unit.mean(axis=0), sample.shape[1]
    _, _, axes = np.linalg.svd(unit - mean, full_matrices=True)
    rng, turns, left = np.random.default_rng(7), [], bits
    while left:
        w = min(left, d)
        flat = (unit - mean) @ axes[:w].T
        turn = np.linalg.qr(rng.normal(size=(w, w)))[0]
        for _ in range(rounds):
            u, _, v = np.linalg.svd(np.sign(flat @ turn).T @ flat)
            turn = (u @ v).T
        turns.append(axes[:w].T @ turn)
        left -= w
    return Coder(mean, np.concatenate(turns, axis=1))


def fit_radius(sample: np.ndarray, coder: Coder, k: int, hold: float = HOLD) -> int:
    """The Hamming radius that holds ``hold`` of the true neighbours within the sample."""
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    codes, tried = coder.codes(sample), min(TRIED, len(sample))
    if len(sample) <= k:
        return coder.turn.shape[1]
    near = unit[:tried] @ unit.T
    near[np.arange(tried), np.arange(tried)] = -2
    top = np.argpartition(-near, k - 1, axis=1)[:, :k]
    away = _ONES[codes[:tried, None, :] ^ codes[top]].sum(axis=2)
    return int(np.quantile(away, hold, method="higher"))


class Block:
    """Index of one block of rows."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, coder: Coder) -> None:
        self.ids, self.vectors, self.norms = ids, vectors, np.linalg.norm(vectors, axis=1)
        self.codes = coder.codes(vectors)
        self.tables = []
        for j in range(self.codes.shape[1]):
            order = np.argsort(self.codes[:, j], kind="stable")
            keys, start = np.unique(self.codes[order, j], return_index=True)
            self.tables.append((order, keys, start, np.diff(np.append(start, len(order)))))

    def nearest(self, query: int, vector: np.ndarray, code: np.ndarray, radius: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the ``k`` nearest rows within the radius, but for the query's own."""
        marked = np.zeros(len(self.ids), bool)
        each = radius // len(code)
        for (order, keys, start, size), piece in zip(self.tables, code):
            hit = np.flatnonzero(_ONES[keys ^ piece] <= each)
            lens = size[hit]
            marked[order[np.repeat(start[hit] - np.cumsum(lens) + lens, lens) + np.arange(lens.sum())]] = True
        rows = np.flatnonzero(marked)
        rows = rows[_ONES[self.codes[rows] ^ code].sum(axis=1, dtype=np.int64) <= radius]
        rows = rows[self.ids[rows] != query]
        score = self.vectors[rows] @ vector / (self.norms[rows] * np.linalg.norm(vector))
        if len(rows) > k:
            best = score >= np.partition(score, len(rows) - k)[len(rows) - k]
            rows, score = rows[best], score[best]
        order = np.lexsort((self.ids[rows], -score))[:k]
        return self.ids[rows[order]], score[order]


def usable(ids: pa.Array, lists: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of the rows that take part: with an id, ``dims`` finite components
    and not all of them zero."""
    ok = ids.is_valid().to_numpy(zero_copy_only=False) & lists.is_valid().to_numpy(zero_copy_only=False)
    size = lists.value_lengths().fill_null(0).to_numpy()
    at = np.flatnonzero(ok & (size == dims))
    flat = lists.take(pa.array(at)).flatten()
    vectors = flat.cast(pa.float64()).fill_null(float("nan")).to_numpy().reshape(len(at), dims) if len(at) else np.empty((0, dims))
    good = np.isfinite(vectors).all(axis=1)
    norm = np.linalg.norm(np.where(good[:, None], vectors, 0), axis=1)
    good &= (norm > 0) & np.isfinite(norm)
    return ids.take(pa.array(at[good])).to_numpy(), vectors[good]


def _search(rows: DataFrame, ids: np.ndarray, vectors: np.ndarray, coder: Coder, radius: int, k: int, dims: int,
            block_rows: int) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast((ids, vectors, coder.codes(vectors), coder))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, floats, codes, coder = shared.value
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def answer() -> pa.RecordBatch:
            block = Block(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), coder)
            found = [block.nearest(q, v, c, radius, k) for q, v, c in zip(asked, floats, codes)]
            return pa.record_batch({"query_id": pa.array(np.repeat(asked, [len(f[0]) for f in found])),
                                    "vec_id": pa.array(np.concatenate([f[0] for f in found])),
                                    "score": pa.array(np.concatenate([f[1] for f in found]))})

        for batch in batches:
            for lo in range(0, batch.num_rows, block_rows):
                part = batch.slice(lo, block_rows)
                held.append(usable(part.column(0), part.column(1), dims))
                if sum(len(h[0]) for h in held) >= block_rows:
                    yield answer()
                    held = []
        if any(len(h[0]) for h in held):
            yield answer()

    return rows.mapInArrow(tidied(run), "query_id long, vec_id long, score double")


def _query_blocks(queries: DataFrame, dims: int, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    ids: list[int] = []
    lists: list[list[float]] = []
    for row in queries.toLocalIterator():
        ids.append(row[0])
        lists.append(row[1])
        if len(ids) * dims * 8 >= limit:
            yield usable(pa.array(ids, pa.int64()), pa.array(lists, pa.list_(pa.float64())), dims)
            ids, lists = [], []
    if ids:
        yield usable(pa.array(ids, pa.int64()), pa.array(lists, pa.list_(pa.float64())), dims)


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, k: int, bits: int = BITS, hold: float = HOLD, sample_rows: int = SAMPLE,
                       block_rows: int = BLOCK_ROWS, query_bytes: int = QUERY_BYTES,
                       key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``queries`` the ``k`` rows of ``vectors``
    with the largest cosine found, ties to the smaller id; rows of the query's own id are no
    candidates.

    Null, zero, null-holding and non-finite vectors, those of another length than most have,
    and rows with a null id take no part on either side.  A repeated row is found as often as it
    stands; a repeated query is answered once.  Fewer candidates than ``k`` are all returned.
    """
    spark, scratch = vectors.sparkSession, Scratch(vectors.sparkSession)
    reach_workers(spark)
    vectors, queries = (x.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v")) for x in (vectors, queries))
    sizes = vectors.where("v is not null and size(v) > 0").groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if sizes is None:
        return empty
    dims = sizes["d"]
    drawn = vectors.where(F.size("v") == dims).orderBy(F.xxhash64("id"), "id").limit(sample_rows).collect()
    ids, sample = usable(pa.array([r.id for r in drawn], pa.int64()), pa.array([r.v for r in drawn], pa.list_(pa.float64())), dims)
    if not len(ids):
        return empty
    coder = fit_coder(sample, bits)
    radius = fit_radius(sample, coder, k, hold)
    queries = queries.where(F.size("v") == dims).dropDuplicates(["id"])
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def ask(asked: DataFrame, radius: int) -> DataFrame:
        found = None
        for ids, floats in _query_blocks(asked, dims, query_bytes):
            if len(ids):
                part = _search(vectors, ids, floats, coder, radius, k, dims, block_rows)
                found = part if found is None else found.union(part)
        if found is None:
            return empty
        ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        return scratch.write(ranked.select("query_id", "rank", "vec_id", "score")).df

    first = ask(queries, radius)
    enough = first.groupBy("query_id").count().where(F.col("count") >= k).select(F.col("query_id").alias("id"))
    rest = ask(queries.join(enough, "id", "left_anti"), bits)
    return first.join(enough.withColumnRenamed("id", "query_id"), "query_id", "left_semi").union(rest)
