"""Operator 13: exact top-k search by inner product, term at a time.

Vectors are sparse integer rows: a term is a component, its weight floor(``scale`` * x), and
zeros aren't stored.  Candidates are packed into blocks, each with a postings list a term
(places and weights); queries are packed into blocks of rows of (term, weight).  Every block of
queries meets every block of candidates, which the task is about: no pair of vectors becomes a
row.  There each term of the queries scatters query weight times posting weights into dense
arrays of scores, one a query; a partition selection leaves the ``k`` best of each array, and
Spark merges them over the blocks, a part before and the rest after one small shuffle.

Blocks are written tables.  Spark broadcasts the queries' blocks if they are under its own
limit, and reads both sides partition by partition if not; nothing passes the driver whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearth.llm.common import Scratch, reach_workers, tidied

SCALE = 256
#: Rows of a block; queries whose score arrays are held at once.
BLOCK_ROWS, QUERY_ROWS, TILE = 4_096, 512, 32
_BLOCK = "ids binary, width int, kind string, ends binary, places binary, weights binary, peak double"


def _kind(peak: int) -> str:
    return next((k for k, top in (("<i2", 1 << 15), ("<i4", 1 << 31)) if peak < top), "<i8")


@dataclass
class Block:
    """Rows of one block in ascending order of id.  ``lists[t]`` has the places (of rows, for
    postings; None stands for all of them) and weights of term ``t``."""

    ids: np.ndarray
    lists: list[tuple[np.ndarray | None, np.ndarray]]
    peak: int

    @staticmethod
    def pack(ids: np.ndarray, lengths: np.ndarray, flat: np.ndarray) -> dict:
        """The block of rows whose weights stand one after another in ``flat``."""
        order = np.argsort(ids, kind="stable")
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        starts = np.cumsum(lengths) - lengths
        row, term = np.repeat(place, lengths), np.arange(len(flat)) - np.repeat(starts, lengths)
        used = np.flatnonzero(flat)
        by = used[np.lexsort((row[used], term[used]))]
        width = int(lengths.max(initial=0))
        peak = max(abs(int(flat.min(initial=0))), abs(int(flat.max(initial=0))))
        return {"ids": ids[order].tobytes(), "width": width, "kind": _kind(peak), "peak": float(peak),
                "ends": np.searchsorted(term[by], np.arange(width), "right").astype("<i8").tobytes(),
                "places": row[by].astype("<i4").tobytes(), "weights": flat[by].astype(_kind(peak)).tobytes()}

    @classmethod
    def read(cls, ids: bytes, kind: str, ends: bytes, places: bytes, weights: bytes, peak: float) -> "Block":
        own, end = np.frombuffer(ids, "<i8"), np.frombuffer(ends, "<i8")
        place, weight = np.frombuffer(places, "<i4"), np.frombuffer(weights, kind)
        lists = [(None if b - a == len(own) else place[a:b], weight[a:b]) for a, b in zip([0, *end[:-1].tolist()], end.tolist())]
        return cls(own, lists, int(peak))


def accumulate(queries: Block, lo: int, hi: int, docs: Block, kind: type) -> np.ndarray:
    """Scores of the queries at ``lo`` to ``hi`` (rows) with every row of ``docs``, term at a time."""
    score = np.zeros((hi - lo, len(docs.ids)), kind)
    for (who, query), (places, posting) in zip(queries.lists, docs.lists):
        if not len(posting):
            continue
        if who is None:
            who, query = np.arange(lo, hi), query[lo:hi]
        else:
            a, b = np.searchsorted(who, (lo, hi))
            who, query = who[a:b], query[a:b]
        if len(who):
            weight, posting = query.astype(kind), posting.astype(kind)
            if places is not None:
                score[np.ix_(who - lo, places)] += weight[:, None] * posting
            elif len(who) == hi - lo:
                score += weight[:, None] * posting
            else:
                score[who - lo] += weight[:, None] * posting
    return score


def select(score: np.ndarray, own: tuple[int, int], k: int) -> np.ndarray:
    """Places of the ``k`` largest of ``score`` outside ``own``, ties to the smaller place."""
    if own[0] < own[1]:
        outside = np.r_[0:own[0], own[1]:len(score)]
        return outside[select(score[outside], (0, 0), k)]
    if len(score) <= k:
        return np.arange(len(score))
    least = np.partition(score, len(score) - k)[len(score) - k]
    above = np.flatnonzero(score > least)
    return np.concatenate([above, np.flatnonzero(score == least)[:k - len(above)]])


def best_of(queries: Block, docs: Block, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query id, ids, scores) of each query's ``k`` best in one block, without rows of its own id."""
    bound = queries.peak * docs.peak * min(len(queries.lists), len(docs.lists))
    kind = np.int32 if bound < 1 << 31 else np.int64 if bound < 1 << 63 else object
    for lo in range(0, len(queries.ids), TILE):
        hi = min(lo + TILE, len(queries.ids))
        score = accumulate(queries, lo, hi, docs, kind)
        left, right = (np.searchsorted(docs.ids, queries.ids[lo:hi], side) for side in ("left", "right"))
        for i in range(hi - lo):
            at = select(score[i], (left[i], right[i]), k)
            yield int(queries.ids[lo + i]), docs.ids[at], score[i, at]


def _packed(rows: DataFrame, block_rows: int) -> DataFrame:
    """``rows(id, w)`` as blocks, each from rows of one partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def block() -> pa.RecordBatch:
            lists = pa.concat_arrays([b.column(1) for b in held])
            made = Block.pack(np.concatenate([b.column(0).to_numpy() for b in held]), lists.value_lengths().to_numpy(),
                              lists.flatten().to_numpy())
            return pa.record_batch({n: pa.array([v], pa.int32() if n == "width" else None) for n, v in made.items()})

        for batch in batches:
            lo = 0
            while lo < batch.num_rows:
                part = batch.slice(lo, block_rows - sum(b.num_rows for b in held))
                held.append(part)
                lo += part.num_rows
                if sum(b.num_rows for b in held) == block_rows:
                    yield block()
                    held = []
        if held:
            yield block()

    columns = [c.split()[0] for c in _BLOCK.split(", ")]
    return rows.mapInArrow(tidied(lambda b: (x.select(columns) for x in run(b))), _BLOCK)


def integer_rows(vectors: DataFrame, scale: float, key: str, vector: str) -> DataFrame:
    """``id, w`` of the rows that take part: with a key and finite components only."""
    v = F.col("v")
    return (vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
            .where(F.col("id").isNotNull() & v.isNotNull() & F.forall(v, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))))
            .select("id", F.transform(v, lambda x: F.floor(x * F.lit(float(scale)))).alias("w")))


def top_k(vectors: DataFrame, queries: DataFrame, k: int, scale: float = SCALE, key: str = "vec_id", vector: str = "embedding",
          block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``queries`` the ``k`` rows of ``vectors`` with
    the largest integer inner product, ties to the smaller id; rows of the query's own id are no
    candidates.

    Vectors that are null or hold null or non-finite components, and rows with a null key, take no part on
    either side; a shorter vector has no weight beyond its end, an empty one scores 0.  A repeated row is found as often
    as it stands; of several queries with one id the smallest vector is asked.  Fewer candidates
    than ``k`` are all returned, an empty table gives no row.  A score beyond 64 bits fails."""
    spark, scratch = vectors.sparkSession, Scratch(vectors.sparkSession)
    reach_workers(spark)
    docs = scratch.write(_packed(integer_rows(vectors, scale, key, vector), block_rows)).df
    asked = scratch.write(integer_rows(queries, scale, key, vector).groupBy("id").agg(F.min("w").alias("w"))).df
    # the number of blocks follows the counted queries
    parts = max(1, -(-asked.count() // query_rows))
    names = {c: f"q_{c}" for c in docs.columns}
    blocks = scratch.write(_packed(asked.repartition(parts), query_rows).withColumnsRenamed(names)).df

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                own, other = (Block.read(*(row[p + n] for n in ("ids", "kind", "ends", "places", "weights", "peak"))) for p in ("q_", ""))
                found = list(best_of(own, other, k))
                yield pa.record_batch({
                    "query_id": pa.array(np.repeat([f[0] for f in found], [len(f[1]) for f in found]).astype(np.int64)),
                    "vec_id": pa.array(np.concatenate([f[1] for f in found])),
                    "score": pa.array([int(s) for f in found for s in f[2]], pa.int64())})

    # a row is a block of each side
    best = docs.crossJoin(blocks).mapInArrow(tidied(run), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
